import random
import re
import time
from collections import defaultdict

import pytest

from tests.llm.conftest import edge_rows
from wordloom.llm import packing, queries


def plain_best_fit(sizes, sources, clusters, capacity):
    """Every bin is looked at for every piece: the least room that fits without a conflict, the oldest bin in a tie."""
    bins = []
    placed = [None] * len(sizes)
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(capacity - used - sizes[piece], b) for b, (used, s, c) in enumerate(bins)
                if used + sizes[piece] <= capacity and used < capacity
                and (sources[piece] is None or sources[piece] not in s) and (clusters[piece] is None or clusters[piece] not in c)]
        if fits:
            b = min(fits)[1]
        else:
            b = len(bins)
            bins.append([0, set(), set()])
        placed[piece] = (b, bins[b][0])
        bins[b][0] += sizes[piece]
        bins[b][1].add(sources[piece])
        bins[b][2].add(clusters[piece])
    return placed


@pytest.mark.parametrize("seed", range(6))
def test_equals_plain_best_fit(seed):
    rnd = random.Random(seed)
    n = 300
    sizes = [rnd.choice((1, 5, 50, 100)) if seed % 2 else rnd.randrange(1, 101) for _ in range(n)]
    sources = [rnd.choice([None, "hot", "hot", *"abcdefgh"]) for _ in range(n)]
    clusters = [rnd.choice([None, *range(60)]) for _ in range(n)]
    assert packing.best_fit(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def test_search_goes_on_to_the_tightest_compatible_bin():
    # Bins after the first three pieces have 10, 20 and 30 left; the first two hold source a.
    placed = packing.best_fit([90, 80, 70, 10], ["a", "a2", "b", "a"], [None, "k", None, "k"], 100)
    assert placed[3] == (2, 70)


def test_no_pieces():
    assert packing.best_fit([], [], [], 10) == []


def whole(rows, capacity, docs):
    """Every token of every row once; bins not overfull, pieces side by side, no conflict."""
    sizes = sorted((str(i), len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1) for i, t in docs)
    starts = defaultdict(list)
    for r in rows:
        starts[str(r.doc_id)].append((r.piece, r.start, r.n_tokens))
    assert sorted((i, sum(n for *_, n in p)) for i, p in starts.items()) == sorted(
        (i, sum(n for j, n in sizes if j == i)) for i in {i for i, _ in sizes})
    assert all(start == piece * capacity and 1 <= n <= capacity for p in starts.values() for piece, start, n in p)
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append((r.offset, r.n_tokens))
    for inside in bins.values():
        at = 0
        for offset, n in sorted(inside):
            assert offset == at
            at += n
        assert at <= capacity
    return bins


@pytest.mark.parametrize("group_rows", [7, 16_384])
def test_edge_rows(edge_docs, group_rows):
    rows = packing.pack(edge_docs, capacity=1000, group_rows=group_rows).collect()
    assert set(packing.pack(edge_docs).columns) == {"bin_id", "offset", "doc_id", "piece", "start", "n_tokens"}
    bins = whole(rows, 1000, [(r[0], r[1]) for r in edge_rows()])
    sources = {r[0]: r[3] for r in edge_rows() if r[0] is not None}
    inside = defaultdict(list)
    for r in rows:
        if sources.get(r.doc_id):
            inside[r.bin_id].append(sources[r.doc_id])
    assert all(len(s) == len(set(s)) for s in inside.values()) and len(bins) >= 250


def test_empty_table_and_missing_source(spark, no_docs):
    assert packing.pack(no_docs).collect() == []
    docs = spark.createDataFrame([(i, "a b c") for i in range(10)], "doc_id bigint, text string")
    assert len({r.bin_id for r in packing.pack(docs, capacity=8).collect()}) == 10  # all are copies
    assert len({r.bin_id for r in packing.pack(docs, capacity=8, cluster="doc_id").collect()}) == 5


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = queries.op9_best_fit_packing(spark, sf_dir).collect()
    bins = whole(rows, 2048, [(r.doc_id, r.text) for r in docs])
    sources = {r.doc_id: (r.source, " ".join(r.text.split())) for r in docs}
    inside = defaultdict(list)
    for r in rows:
        inside[r.bin_id].append(sources[r.doc_id])
    assert all(len({s for s, _ in own}) == len(own) == len({t for _, t in own}) for own in inside.values())
    filled = sum(n for own in bins.values() for _, n in own) / (2048 * len(bins))
    assert filled > 0.9


def test_one_source_for_a_whole_group_takes_no_square():
    """No bin is compatible for any piece; the search sees that of all of them at once."""
    pick, n = random.Random(3), 16_384
    sizes = [pick.randint(1, 2047) for _ in range(n)]
    start = time.process_time()
    placed = packing.best_fit(sizes, ["s"] * n, [None] * n, 2048)
    assert time.process_time() - start < 5 and sorted(b for b, _ in placed) == list(range(n))


def test_texts_that_differ_in_white_space_alone_are_apart(spark):
    rows = [(1, "a b", "s1"), (2, "a b\n", "s2"), (3, "\t a \r\n b", "s3"), (4, "a c", "s4")]
    found = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), 100).collect()
    bins = {r.doc_id: r.bin_id for r in found}
    assert len({bins[1], bins[2], bins[3]}) == 3 and bins[4] in {bins[1], bins[2], bins[3]}
