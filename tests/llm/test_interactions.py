"""Order effects of filters against applying them one by one, in every order."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import by_id, edge_rows, prose
from wordloom.llm import interactions, queries

LABELS = "doc_id bigint, quality int, toxic int, kept string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
    }


def brute(docs, labels):
    """Every order applied step by step to the rows themselves."""
    rows = []
    for doc_id, text, part in docs:
        text = text or ""
        copy = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs)
        good, toxic = (any(l[0] is not None and l[0] == doc_id and l[i] == 1 for l in labels) for i in (1, 2))
        rows.append((part or "", {**fails(text), "E": copy}, good, toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed, left = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
                out[part, "".join(order), step] = (
                    len(left), len(removed), sum(r[1][f] for r in own) - len(removed),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed))
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def random_docs(seed, n):
    rnd = random.Random(seed)
    texts = [prose(s, rnd.choice([5, 199, 200, 201, 300])) for s in range(12)]
    texts += [t + rnd.choice([" #", " |", " QQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQ", " a" * 400]) for t in texts] + ["", None, " \n"]
    return [(rnd.choice([None, *range(n)]), rnd.choice(texts), rnd.choice(["x", "y", "", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_every_order_applied_to_the_rows(spark, seed):
    docs = random_docs(seed, 120)
    rnd = random.Random(seed)
    labels = [(rnd.choice([None, *range(120)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None]), "z") for _ in range(90)]
    found = interactions.audit(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"),
                               spark.createDataFrame(labels, LABELS))
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, labels)


def test_edge_rows_and_clashing_names(spark, edge_docs):
    labels = spark.createDataFrame([(6, 1, 1, "z"), (2, None, None, None), (None, 1, 1, None), (6, 0, 0, "y")], LABELS)
    docs = [(r[0], r[1], r[2]) for r in edge_rows()]
    found = interactions.audit(edge_docs, labels)
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, [(6, 1, 1), (6, 0, 0)])


def test_a_repeated_row_is_no_copy_of_itself(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, "a", "y"), (None, "a", "x")], "doc_id bigint, text string, lang string")
    cells = interactions.cells(interactions.failures(docs, filters={"A": "words > 5"}), spark.createDataFrame([], LABELS), 2)
    assert by_id(cells.select("part", "mask", "n")) == [("x", 0, 3), ("y", 2, 1)]


def test_empty_table(spark, no_docs):
    assert interactions.audit(no_docs, spark.createDataFrame([], LABELS)).count() == 0


def test_other_filters_and_their_limits(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a", "x")], "doc_id bigint, text string, lang string")
    found = interactions.audit(docs, spark.createDataFrame([], LABELS), filters={"W": "words < 2"}, duplicate="Z")
    assert by_id(found.where("step = 1").select("filter_order", "kept", "removed")) == [("WZ", 1, 1), ("ZW", 2, 0)]
    for bad in ({"WW": "words < 2"}, {x: "words < 2" for x in "ABCDFGHI"}, {"E": "words < 2"}):
        with pytest.raises(ValueError):
            interactions.audit(docs, docs, filters=bad)


def test_walk_equals_counting_each_subset():
    rng = np.random.default_rng(3)
    mask, weights = np.arange(32), rng.integers(0, 50, (32, 3))
    states = interactions.subset_states(mask, weights, 5)
    for subset in range(32):
        assert (states[subset] == weights[mask & subset == 0].sum(axis=0)).all()


def test_query_equals_sql(spark, sf_dir):
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = queries.QUERIES["op11_filter_interactions"](spark, sf_dir)
    wanted = duck.execute(queries.ORACLE["op11_filter_interactions"])
    assert [d[0] for d in wanted.description] == found.columns
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted.fetchall())
