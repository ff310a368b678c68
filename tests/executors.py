"""Runs a script whose Python workers cannot import the package."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

START = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import plumbline as pl
spark = pl.build_session("far", cpus=2, shuffle_partitions=2)
spark.sparkContext.setLogLevel("ERROR")
def package_is_missing(_):
    try:
        import plumbline
    except ModuleNotFoundError:
        yield True
    else:
        yield False
assert spark.sparkContext.parallelize([0], 1).mapPartitions(package_is_missing).collect() == [True]
"""


def run_far(script, folder):
    """The script's standard output; the folder is empty and the search path without the package."""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYTHONSAFEPATH")}
    # The script is no file of the repository, so the workers' first search path is not it either.
    whole = START + textwrap.dedent(script)
    done = subprocess.run([sys.executable, "-c", whole], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout
