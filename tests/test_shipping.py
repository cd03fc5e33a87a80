import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from wordloom.operators import communities, labelling, pages
from wordloom.plans.stub import stub_labeller
records = pages.extract_pages(spark.createDataFrame([(1, "<title>t</title>")], "page_id bigint, html string"))
assert pages.articles(records).first().Title == "t"
batch = spark.createDataFrame([(0, "kata")], "batch_id bigint, word string")
assert "kata" in labelling.responses(labelling.word_lists(batch), stub_labeller).first().response
pairs = spark.createDataFrame([("x", "y")], "a string, b string")
assert communities.themes(pairs).count() == 2
print("workers fine")
"""


def test_workers_need_no_installed_package(tmp_path):
    """Started elsewhere, Python workers cannot import the package by its path."""
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "workers fine" in done.stdout, done.stderr[-2000:]
