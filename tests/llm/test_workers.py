"""The queries run where workers cannot import the package: everything they need travels with the job."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()

def importable(_):
    try:
        import featureflow
        return [True]
    except ModuleNotFoundError:
        return [False]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect() == [False]
from featureflow.llm.queries import QUERIES
for name, query in QUERIES.items():
    assert query(spark, "/root/testdata/sf0.001").count() > 0, name
import corpus_pipeline
assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
print("every query ran")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT.format(repo=str(REPO)))
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, capture_output=True, text=True, timeout=600, check=False)
    assert "every query ran" in done.stdout, done.stderr[-3000:]
