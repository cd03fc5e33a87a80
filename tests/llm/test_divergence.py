"""Distances between sources against exact arithmetic on plain counts."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import edge_rows, prose
from wordloom.llm import divergence, queries

SCHEMA = "text string, lang string, source string, value bigint, rank string, term string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, least, most):
    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in holders[lang].items() if n >= least)
        own = sorted(s for l, s in groups if l == lang)
        whole = Counter()
        for s in own:
            whole.update(counts[lang, s])

        def share(counter):
            below = sum(counter[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // below for t in kept}

        p, q = {s: share(counts[lang, s]) for s in own}, share(whole)
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def random_docs(seed, n, sources):
    rnd = random.Random(seed)
    extra = ["é", "ÉA", "你好", "x1y", "A-b", "Zz", "\x7f", "\U0001F600"]
    return [(" ".join([prose(rnd.randrange(40), rnd.randrange(30)), *rnd.sample(extra, 3)]), rnd.choice(["p", "q", None]),
             f"s{rnd.randrange(sources)}") for _ in range(n)]


@pytest.mark.parametrize("seed, sources, cells", [(1, 3, 1 << 21), (2, 7, 20), (3, 4, 1)])
def test_equals_exact_counts_at_any_block_size(spark, seed, sources, cells):
    docs = random_docs(seed, 150, sources)
    table = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], SCHEMA)
    assert rows(divergence.audit(table, 3, 4, cells)) == brute(docs, 3, 4)


def test_many_sources_take_several_stripes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_STRIPE", 4)
    monkeypatch.setattr(divergence, "_BROADCAST_ROWS", 0)  # every join by shuffle
    docs = random_docs(5, 200, 11)
    table = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], SCHEMA)
    assert rows(divergence.audit(table, 2, 3, 50)) == brute(docs, 2, 3)


def test_counts_flushed_early_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_ENTRIES", 5)
    docs = random_docs(6, 80, 3)
    table = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], SCHEMA)
    assert rows(divergence.audit(table, 2, 3)) == brute(docs, 2, 3)


def test_edge_rows_with_languages_without_kept_terms(spark, edge_docs):
    docs = [(r[1], r[2], r[3]) for r in edge_rows()]
    for least in (1, 3, 1000):
        assert rows(divergence.audit(edge_docs, least, 50)) == brute(docs, least, 50)


def test_empty_table(spark, no_docs):
    assert rows(divergence.audit(no_docs)) == []


def test_shares_are_exact_beyond_double_precision(spark):
    cases = [(0, 1, 1), (7 * 10**14, 9 * 10**14, 10**9), (3, 7, 0), (8 * 10**15, 8 * 10**15, 0), (123456789012, 987654321098765, 54321)]
    table = spark.createDataFrame(cases, "n bigint, size bigint, terms bigint")
    found = [r[0] for r in table.select(F.expr(divergence.share("n", "size", "terms"))).collect()]
    wanted = [1 + 10**9 * (n + 5) // (size + 5 * terms) for n, size, terms in cases]
    assert found == wanted
    assert [int(divergence.shares(np.array([n]), size, terms)[0]) for n, size, terms in cases] == wanted


def test_run_distance_equals_columns_written_out():
    rng = np.random.default_rng(4)
    for _ in range(50):
        width = int(rng.integers(1, 12))
        lengths = rng.integers(1, 6, width)
        full, coded = [], []
        for _ in range(2):
            column = rng.integers(0, 3, width)
            places = np.flatnonzero(column)
            coded.append(divergence.column_runs(places, column[places], width))
            full.append(np.repeat(column, lengths))
            assert (np.diff(coded[-1][1]) != 0).all()
        assert divergence.run_distance(*coded, np.append(0, np.cumsum(lengths))) == np.abs(full[0] - full[1]).sum()


def test_query_equals_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = queries.QUERIES["op13_source_divergence"](spark, sf_dir)
    wanted = duck.execute(queries.ORACLE["op13_source_divergence"])
    assert [d[0] for d in wanted.description] == found.columns
    assert rows(found) == sorted(wanted.fetchall())
