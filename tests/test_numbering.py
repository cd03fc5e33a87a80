import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.operators.numbering import batches, collect_in_parts, number_rows


def test_numbers_are_dense_and_follow_the_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.concat(F.lit("w"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("word"))
    numbered = number_rows(df.repartition(5), "word").orderBy("word").collect()
    assert [row.row_number for row in numbered] == list(range(1, 5001))


def test_descending_and_empty(spark):
    df = spark.range(3).withColumnRenamed("id", "n")
    assert rows_of(number_rows(df, F.desc("n"))) == [(0, 3), (1, 2), (2, 1)]
    assert number_rows(df.where("false"), "n").count() == 0


def test_every_word_is_in_one_full_batch(spark):
    for total, sizes in ((160, [80, 80]), (1000, [80] * 12 + [40]), (1, [1])):
        df = spark.range(total).select(F.format_string("w%04d", "id").alias("word"))
        rows = batches(df).collect()
        assert len({row.word for row in rows}) == len(rows) == total
        assert [sum(r.batch_id == b for r in rows) for b in range(len(sizes))] == sizes


@pytest.mark.parametrize("broadcast_keys", [0, 10])
def test_lists_of_one_hot_key_are_cut_into_parts(spark, broadcast_keys):
    hot = spark.range(2500).select(F.lit("hot").alias("k"), F.format_string("v%05d", "id").alias("v"))
    few = spark.createDataFrame([("cold", "b"), ("cold", "a"), ("cold", "a")], "k string, v string")
    result = collect_in_parts(hot.union(hot).union(few), ["k"], "v", 1000, broadcast_keys).collect()
    lists = {(row.k, row.part): row["values"] for row in result}
    assert lists["cold", 0] == ["a", "b"]
    assert [len(lists["hot", part]) for part in range(3)] == [1000, 1000, 500]
    assert sum((lists["hot", part] for part in range(3)), []) == [f"v{i:05d}" for i in range(2500)]
    assert len(lists) == 4
