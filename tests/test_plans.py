"""What the physical plans must look like, so that queries stay fit for large tables."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.operators import lexicon, network
from wordloom.operators.numbering import collect_in_parts
from wordloom.plans.queries import QUERIES
from wordloom.sources.workspace import staged

SF = "/root/testdata/sf0.001"


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", [
    "tokens", "word_freq", "hapax_words", "positive_views",
    "api_page_extracts", "pages_to_messages", "label_rows", "usable_words", "lexicon_nodes", "lexicon_edges",
    "pos_counts", "word_sentiment", "lookup_words", "neighbours_out", "word_profile", "neighbour_sets",
    "network_edges", "components", "repair_lexicon",
])
def test_no_python_no_cross_join_no_single_task(spark, capsys, name):
    plan = plan_of(QUERIES[name](spark, SF), capsys)
    for word in ("Python", "ArrowEval", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert word not in plan, plan


def test_word_counts_read_one_column_and_count_before_the_shuffle(spark, capsys):
    plan = plan_of(QUERIES["word_freq"](spark, SF), capsys)
    assert "ReadSchema: struct<text:string>" in plan
    assert plan.index("functions=[count(1)]") < plan.index("hashpartitioning(word") < plan.index("partial_count(1)")


def test_reports_take_the_top_without_a_full_sort(spark, capsys):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_words"](spark, SF), capsys)


def test_relation_filter_reaches_the_scan(spark, capsys):
    edges = staged(spark.createDataFrame([("a", "SYNONYM", "b")], "src string, rel string, dst string"), "edges")
    keys = spark.createDataFrame([("a",)], "word string")
    for df in (network.network_edges(edges, "SYNONYM"), lexicon.neighbours_out(keys, edges, "SYNONYM")):
        plan = plan_of(df, capsys)
        assert "EqualTo(rel,SYNONYM)" in plan
    assert "max_by" in plan_of(QUERIES["lexicon_nodes"](spark, SF), capsys)


@pytest.fixture
def small_thresholds(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def hub_edges(spark):
    """60,000 edges, a third of them from one word."""
    ids = spark.range(60_000, numPartitions=8)
    hub = F.col("id") % 3 == 0
    return staged(ids.select(
        F.when(hub, "hub").otherwise(F.format_string("w%05d", F.col("id") % 7001)).alias("src"),
        F.lit("SYNONYM").alias("rel"),
        F.format_string("x%05d", "id").alias("dst"),
    ), "hub-edges")


def test_a_hub_is_split_in_the_lookup(spark, small_thresholds, hub_edges, capsys):
    keys = hub_edges.select(F.col("src").alias("word"))
    nodes = staged(keys.distinct().withColumn("pos", F.lit("p")), "nodes")
    found = lexicon.lookup_words(keys, nodes).groupBy().agg(F.count("*").alias("n"))
    assert found.collect()[0].n == 60_000
    assert "skew=true" in plan_of(found, capsys)


def test_results_with_a_hub_are_whole(spark, small_thresholds, hub_edges):
    lists = collect_in_parts(hub_edges, ["src"], "dst", 1000, broadcast_keys=0)
    assert lists.agg(F.sum(F.size("values"))).first()[0] == 60_000
    assert lists.where("src = 'hub'").count() == 20
    assert lists.agg(F.max(F.size("values"))).first()[0] == 1000
    pairs = hub_edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    parts = network.components(pairs).groupBy("component").agg(F.count("*").alias("n"))
    assert parts.orderBy(F.desc("n")).first().n == 20_001
    hub = spark.createDataFrame([("hub",), ("none",)], "word string")
    empty = spark.createDataFrame([], "word string, frequency bigint")
    profile = lexicon.word_profile(hub, empty, empty.withColumnRenamed("frequency", "sentiment"), hub_edges)
    assert rows_of(profile.groupBy("word").agg(F.count("*"), F.sum(F.size(F.split("synonyms", ", "))))) == [
        ("hub", 20, 20_000), ("none", 1, 1)]
