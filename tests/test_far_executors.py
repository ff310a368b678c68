"""Models fit and predict where the workers do not have the package."""

from executors import run_far


def test_models_need_no_package_on_the_workers(tmp_path):
    said = run_far(
        """
        rows = [(i, [float(i % 10), float(i % 7)], i % 2) for i in range(300)]
        table = spark.createDataFrame(rows, "row_id long, features array<float>, label int")
        for limits in ({}, {"broadcast_bytes": 0, "block_bytes": 2000}):
            model = pl.fit_knn(table, 3, **limits)
            assert model.predict(table).count() == 300 and model.neighbors(table).count() == 900
            model.unpersist()
        model = pl.lloyd(table, [[0.0, 0.0], [9.0, 6.0]], 3)
        assert sum(r.n_rows for r in pl.cluster_sizes(model.predict(table)).collect()) == 300
        assert pl.fit_kmeans(table, 4).predict(table).count() == 300
        assert pl.fit_random_forest(table, 3, 4).predict(table).count() == 300
        print("done")
        """,
        tmp_path,
    )
    assert said.strip().endswith("done")


def test_grown_forests_need_no_package_on_the_workers(tmp_path):
    said = run_far(
        """
        from plumbline.operators import forest
        forest.DRAWN_VALUES = 0
        rows = [(i % 50, [float(i % 2), float(i % 3)], i % 2) for i in range(300)]
        table = spark.createDataFrame(rows, "row_id long, features array<float>, label int")
        model = pl.fit_random_forest(table, 3, 4)
        assert type(model).__name__ == "GrownForestModel" and model.predict(table).filter("label = prediction").count() == 300
        print("done")
        """,
        tmp_path,
    )
    assert said.strip().endswith("done")
