"""Queries run where the executors' Python cannot import the library."""

import os
import subprocess
import sys

import pytest

pytest.importorskip("larder.llm")

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
def importable(batches):
    import importlib.util
    for batch in batches:
        yield batch.slice(0, int(importlib.util.find_spec("larder") is not None))
assert spark.range(4).mapInArrow(importable, "id long").count() == 0
sys.path.insert(0, sys.argv[1])
from larder.llm.queries import QUERIES
for name in sys.argv[2:]:
    print(name, len(QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
"""
NAMES = ["op2_kneser_ney_toxicity", "op4_log_bilinear_scores", "op9_simhash_decontamination", "op12_byte_bpe_round_trip", "op13_ranked_search"]


def test_queries_without_the_package_on_executors(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, REPO, *NAMES], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    assert [line.split()[0] for line in run.stdout.splitlines() if line.startswith("op")] == NAMES
