import math

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.sources import labelled_csv


@pytest.fixture
def csv(tmp_path):
    def write(text, name="data.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def rows(table):
    return [(r.row_id, list(r.features), r.label) for r in table.rows.orderBy("row_id").collect()]


def test_booleans_and_sibling_label(spark, csv):
    path = csv("a,b,is_malicious,attack_type\n1.5,True,True,dos\n-2,False,False,none\n3e1,True,7,x\n")
    table = pl.load_labelled_csv(spark, path, "is_malicious")
    assert table.feature_names == ["a", "b"]
    assert rows(table) == [(0, [1.5, 1.0], 1), (1, [-2.0, 0.0], 0), (2, [30.0, 1.0], 7)]


def test_other_sibling_and_explicit_exclusion(spark, csv):
    path = csv("a,is_malicious,attack_type,extra\n1,1,b,9\n2,0,a,9\n")
    table = pl.load_labelled_csv(spark, path, "attack_type", text_label=True)
    assert table.feature_names == ["a", "extra"]
    table = pl.load_labelled_csv(spark, path, "is_malicious", exclude=["attack_type", "extra"])
    assert table.feature_names == ["a"]


@pytest.mark.parametrize("cell", ["bad", "1.5f", " 1 ", "1e40", "-1e40", "1_0", "+nan", "0x10", ""])
def test_bad_feature_fails(spark, csv, cell):
    table = pl.load_labelled_csv(spark, csv(f"a,b,y\n1,2,0\n{cell},3,1\n"), "y")
    with pytest.raises(Exception, match="invalid feature in column 'a'"):
        table.rows.collect()


@pytest.mark.parametrize("cell", ["1.0", "x", "3000000000", " 1", ""])
def test_bad_label_fails(spark, csv, cell):
    table = pl.load_labelled_csv(spark, csv(f"a,y\n1,0\n2,{cell}\n"), "y")
    with pytest.raises(Exception, match="invalid label in column 'y'"):
        table.rows.collect()


def test_special_numbers_are_kept(spark, csv):
    text = "a,y\nNaN,0\ninf,1\n-Infinity,2\n+Inf,3\n.5,4\n5.,5\n0x1p-2,6\n1e-60,7\n"
    found = [r[1][0] for r in rows(pl.load_labelled_csv(spark, csv(text), "y"))]
    assert math.isnan(found[0])
    assert found[1:] == [math.inf, -math.inf, math.inf, 0.5, 5.0, 0.25, 0.0]


@pytest.mark.parametrize("line", ["1", "1,2,3,4"])
def test_ragged_rows_fail(spark, csv, line):
    table = pl.load_labelled_csv(spark, csv(f"a,b,y\n1,2,0\n{line}\n3,4,1\n"), "y")
    for action in (table.rows.count, table.rows.select("label").collect):
        with pytest.raises(Exception, match="wrong number of fields"):
            action()


def test_blank_lines_are_skipped(spark, csv):
    table = pl.load_labelled_csv(spark, csv("a,y\n1,0\n\n2,1\n\n"), "y")
    assert rows(table) == [(0, [1.0], 0), (1, [2.0], 1)]


def test_quotes(spark, csv):
    path = csv('a,"y"\n"1","say ""hi"", you"\n2,b\n')
    table = pl.load_labelled_csv(spark, path, "y", text_label=True)
    assert rows(table) == [(0, [1.0], 0), (1, [2.0], 1)]
    assert {r.class_name for r in table.class_names.collect()} == {'say "hi", you', "b"}


def test_quoted_line_break(spark, csv):
    path = csv('a,y,note\n1,0,"two\nlines"\n2,1,x\n')
    table = pl.load_labelled_csv(spark, path, "y", exclude=["note"], multi_line=True)
    assert rows(table) == [(0, [1.0], 0), (1, [2.0], 1)]


@pytest.mark.parametrize(
    "text, message",
    [
        ("", "empty dataset"),
        ("a,y\n", "empty dataset"),
        ("a,b\n1,2\n", "label column 'y' not found"),
        ("a,a,y\n1,2,0\n", "duplicate column names"),
    ],
)
def test_bad_files(spark, csv, text, message):
    with pytest.raises(ValueError, match=message):
        pl.load_labelled_csv(spark, csv(text), "y")


def test_unreadable_path(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path.*not.*exist"):
        pl.load_labelled_csv(spark, str(tmp_path / "none.csv"), "y")


def test_odd_column_names(spark, csv):
    table = pl.load_labelled_csv(spark, csv("a.b,`c`,the label\n1,2,0\n"), "the label")
    assert table.feature_names == ["a.b", "`c`"]
    assert rows(table) == [(0, [1.0, 2.0], 0)]


def test_first_seen_labels(spark, csv):
    table = pl.load_labelled_csv(spark, csv("a,kind\n1,b\n2,a\n3,b\n4,c\n"), "kind", text_label=True)
    assert [r[2] for r in rows(table)] == [0, 1, 0, 2]
    names = {r.class_id: r.class_name for r in table.class_names.collect()}
    assert names == {0: "b", 1: "a", 2: "c"}


def test_max_rows(spark, csv):
    path = csv("a,y\n" + "".join(f"{i},{i % 2}\n" for i in range(20)))
    assert [r[0] for r in rows(pl.load_labelled_csv(spark, path, "y", max_rows=7))] == list(range(7))
    assert pl.load_labelled_csv(spark, path, "y", max_rows=0).rows.count() == 20
    assert pl.load_labelled_csv(spark, path, "y", max_rows=99).rows.count() == 20


def test_file_order_over_many_files_and_splits(spark, tmp_path):
    for part, (low, high) in enumerate([(0, 500), (500, 503), (503, 2000)]):
        lines = "".join(f"{i},{i % 3}\n" + ("\n" if i % 50 == 0 else "") for i in range(low, high))
        (tmp_path / f"part-{part}.csv").write_text("a,y\n" + lines)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        table = pl.load_labelled_csv(spark, str(tmp_path), "y")
        assert table.rows.rdd.getNumPartitions() > 5
        found = table.rows.select("row_id", F.col("features")[0].alias("a")).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((r.row_id, int(r.a)) for r in found) == [(i, i) for i in range(2000)]


def test_positions_do_not_depend_on_how_files_are_packed(spark, tmp_path, monkeypatch):
    for part in range(8):
        lines = "".join(f"{100 * part + i},0\n" for i in range(100))
        (tmp_path / f"part-{part}.csv").write_text("a,y\n" + lines)
    monkeypatch.setattr(labelled_csv, "TAKEN_CELLS", 0)
    keys = ["spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k) for k in keys]
    table = pl.load_labelled_csv(spark, str(tmp_path), "y")
    capped = pl.load_labelled_csv(spark, str(tmp_path), "y", max_rows=150)
    try:
        for k, value in zip(keys, ("1", "300")):
            spark.conf.set(k, value)
        found = table.rows.select("row_id", F.col("features")[0].alias("a")).collect()
        first = capped.rows.select("row_id", F.col("features")[0].alias("a")).collect()
    finally:
        for k, value in zip(keys, before):
            spark.conf.set(k, value)
    assert sorted((r.row_id, int(r.a)) for r in found) == [(i, i) for i in range(800)]
    assert sorted((r.row_id, int(r.a)) for r in first) == [(i, i) for i in range(150)]


def test_bad_cells_name_their_row(spark, csv):
    table = pl.load_labelled_csv(spark, csv("a,b,y\n1,2,0\n3,x,1\n"), "y")
    with pytest.raises(Exception, match="invalid feature in column 'b': 'x', row 1"):
        table.rows.collect()
    table = pl.load_labelled_csv(spark, csv("a,y\n1,0\n2,0\n3,?\n", "other.csv"), "y")
    with pytest.raises(Exception, match="invalid label in column 'y': '\\?', row 2"):
        table.rows.collect()


@pytest.mark.parametrize("max_rows", [-1, 7])
def test_rejects_beside_the_rows(spark, csv, max_rows):
    lines = ["1,2,0", "x,y,0", "3,4,1.5", "5,6", "7,True,1", "8,,2", "nan,inf,3", "z,z,z"]
    table = pl.load_labelled_csv(spark, csv("a,b,y\n" + "\n".join(lines) + "\n"), "y", max_rows, rejects=True)
    found = rows(table)
    assert [r[0] for r in found] == [0, 4, 6] and found[1] == (4, [7.0, 1.0], 1)
    listed = sorted((r.row_id, r.column or "", r.cell or "") for r in table.rejects.collect())
    expected = [(1, "a", "x"), (1, "b", "y"), (2, "y", "1.5"), (3, "", "5,6"), (5, "b", "")]
    assert listed == expected + ([] if max_rows > 0 else [(7, "a", "z"), (7, "b", "z"), (7, "y", "z")])
    assert all(r.file.endswith("data.csv") for r in table.rejects.collect())
    none = pl.load_labelled_csv(spark, csv("a,y\n1,0\n", "good.csv"), "y", rejects=True)
    assert none.rejects.count() == 0 and rows(none) == [(0, [1.0], 0)]


def test_rejects_of_text_labels(spark, csv):
    table = pl.load_labelled_csv(spark, csv("a,y\n?,u\n2,v\n3,w\n"), "y", text_label=True, rejects=True)
    assert [(r[0], r[2]) for r in rows(table)] == [(1, 0), (2, 1)]
    assert [(r.row_id, r.column, r.cell) for r in table.rejects.collect()] == [(0, "a", "?")]


def test_a_small_cap_reads_the_first_split_only(spark, csv):
    """One file of many splits: ten rows take tasks over its first split alone."""
    path = csv("a,y\n" + "".join(f"{i},{i % 3}\n" for i in range(40_000)))
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(k) for k in keys]
    for k, value in zip(keys, ("4096", "1")):
        spark.conf.set(k, value)
    context = spark.sparkContext
    try:
        assert spark.read.csv(path).rdd.getNumPartitions() > 50
        context.setJobGroup("cap", "a small cap")
        table = pl.load_labelled_csv(spark, path, "y", max_rows=10)
        found = rows(table)
        status = context.statusTracker()
        stages = [s for j in status.getJobIdsForGroup("cap") for s in status.getJobInfo(j).stageIds]
        tasks = [status.getStageInfo(s).numTasks for s in stages if status.getStageInfo(s)]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, value in zip(keys, before):
            spark.conf.set(k, value)
    assert found == [(i, [float(i)], i % 3) for i in range(10)]
    assert max(tasks) <= 8, tasks
