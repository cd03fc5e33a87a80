"""Every query against its SQL counterpart in a second engine, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v

    return sorted(columns), sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_point.ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = entry_point.queries()[name](spark, SF)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    wanted = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(result.columns, [tuple(row) for row in result.collect()]) == wanted


def test_themes_refine_the_components_and_raise_modularity(spark):
    from wordloom.operators.network import modularity
    from wordloom.plans import fixture

    themes = entry_point.queries()["planted_themes"](spark, SF)
    components = entry_point.queries()["planted_components"](spark, SF)
    assert themes.count() == components.count() == themes.join(components, "word").count()
    sizes = sorted(r["count"] for r in components.groupBy("component").count().collect())
    assert sizes[-2] > 1000  # the hub and the linked cliques
    pairs = fixture.planted_pairs(spark, SF)
    by_theme = modularity(pairs, themes, "theme").first()[0]
    assert by_theme > modularity(pairs, components, "component").first()[0] + 0.1


def test_titles_are_the_same_from_both_readers(spark):
    sf_dir = "/root/testdata/sf0.1"
    flat = entry_point.queries()["page_titles"](spark, sf_dir).toDF("AID", "flat")
    both = entry_point.queries()["page_fields"](spark, sf_dir).join(flat, "AID")
    assert both.count() == 2500 and both.where("flat != Title").count() == 0


def test_every_query_has_sql():
    assert set(entry_point.QUERIES) == set(entry_point.ORACLE)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10


def test_positive_views_keeps_large_numbers(spark, tmp_path):
    rows = [(1, "view", '{"k": 3000000000}'), (2, "view", '{"k": 5}'), (3, "view", '{"k": 0}'), (4, "error", '{"k": 7}')]
    spark.createDataFrame(rows, "event_id bigint, event_type string, props string").write.parquet(str(tmp_path / "events.parquet"))
    found = entry_point.queries()["positive_views"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [(1, 3000000000), (2, 5)]
