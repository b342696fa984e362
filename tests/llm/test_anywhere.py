"""All queries on executors that cannot import this repository, started from another folder."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from grovemart.llm.queries import QUERIES

REPO = Path(__file__).resolve().parents[2]
RUN = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g") \
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def importable(rows):
    import importlib.util
    yield importlib.util.find_spec("grovemart") is not None

assert spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect() == [False]
import __spark_entry__ as contract
done = {}
for name in sys.argv[3:]:
    try:
        done[name] = contract.queries()[name](spark, "/root/testdata/sf0.001").count()
    except Exception as error:
        done[name] = str(error)[-300:]
print("DONE" + json.dumps(done))
"""


@pytest.fixture(scope="module")
def done(tmp_path_factory):
    folder = tmp_path_factory.mktemp("elsewhere")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = [*QUERIES, "pipeline"]
    run = subprocess.run([sys.executable, "-c", RUN, str(REPO), str(folder / "shared"), *names], cwd=folder, env=env, capture_output=True, text=True, timeout=900)
    lines = [line for line in run.stdout.splitlines() if line.startswith("DONE")]
    assert lines, run.stderr[-2000:]
    return json.loads(lines[0][4:])


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_runs(done, name):
    assert isinstance(done[name], int) and done[name] > 0, done[name]
