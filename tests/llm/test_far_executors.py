"""Every query of the subpackage where the workers do not have the package."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from executors import run_far  # noqa: E402


def test_queries_need_no_package_on_the_workers(tmp_path):
    said = run_far(
        """
        from plumbline.llm.queries import QUERIES
        for name, query in QUERIES.items():
            query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
            print(name)
        """,
        tmp_path,
    )
    assert len(said.split()) == 13
