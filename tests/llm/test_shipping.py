"""Models reach tasks that cannot import the package."""

import subprocess
import sys
from pathlib import Path

import pytest

from pitlane.llm.topk import top_k

ROOT = Path(__file__).resolve().parents[2]
# The driver finds the package by sys.path, which its Python workers do not inherit.
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, sys.argv[1])

def missing(_):
    try:
        import pitlane
        return False
    except ImportError:
        return True

assert all(spark.sparkContext.parallelize(range(2), 2).map(missing).collect())
from pitlane.llm import decontam, pii, quality, toxicity
rows = [(i, f"word{i} mail a{i}@b.org and some more text here {'idiot scum' if i % 2 else 'fine day'} " * 3, "s", "en") for i in range(40)]
docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
items = spark.createDataFrame([(1, rows[3][1][:120])], "item_id long, text string")
assert toxicity.score(docs, toxicity.train(docs, labels)).count() == 40
assert toxicity.keep_clean(docs, toxicity.train(docs, labels)).count() <= 40
assert quality.classify(docs, quality.train(docs, labels)).count() == 40
assert pii.scan(docs, pii.train(docs)).count() == 40
assert decontam.find_items(docs, items).where("contaminated").count() >= 1
assert decontam.keep_clean(docs, items).count() < 40
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    script = tmp_path / "alone.py"
    script.write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(script), str(ROOT)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "all ran" in out.stdout, out.stderr[-3000:]


def test_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(5, [1e10, 1.0]), (6, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceed a long"):
        top_k(df, df, 1).collect()
