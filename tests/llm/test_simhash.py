import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import edge_rows, prose
from wordloom.llm import queries, simhash


def brute_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fingerprints, distance=4):
    """Smallest id reachable, by repeated passes over all pairs."""
    reach = [min([i for i, f in zip(ids, fingerprints) if f == own and i is not None], default=None) for own in fingerprints]
    near = [[j for j, g in enumerate(fingerprints) if bin(f ^ g).count("1") <= distance] for f in fingerprints]
    changed = True
    while changed:
        changed = False
        for i, around in enumerate(near):
            best = min([reach[j] for j in around if reach[j] is not None], default=None)
            if best != reach[i]:
                reach[i], changed = best, True
    return reach


def as_rows(ids, fingerprints, components):
    return sorted(zip(map(str, ids), [f"{f:016x}" for f in fingerprints], map(str, components)))


def result_rows(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_fingerprints_of_blocks_equal_those_of_the_whole():
    text = prose(5, 3000)
    sums = [simhash._bit_sums(simhash._shingles(text.encode(), 4))]
    joined = list(simhash._shingles(text.encode(), 4))
    words = text.split()
    assert joined == [" ".join(words[i:i + 4]).encode() for i in range(len(words) - 3)]
    assert sums[0][1] == len(joined)
    for t in (text, "A b", "", " ", None, "one two three four", "É b C d e"):
        assert simhash.fingerprint(t.encode() if t is not None else None) % (1 << 64) == brute_fingerprint(t)


def test_long_texts_are_cut_between_words(monkeypatch):
    import wordloom.llm.common as common

    blocks = list(common.word_blocks(prose(6, 500).encode(), 64))
    assert len(blocks) > 10 and [w for b in blocks for w in b] == prose(6, 500).encode().split()


def test_edge_rows(spark, edge_docs):
    rows = edge_rows()
    fingerprints = [brute_fingerprint(r[1]) for r in rows]
    wanted = as_rows([r[0] for r in rows], fingerprints, brute_components([r[0] for r in rows], fingerprints))
    assert result_rows(simhash.near_duplicates(edge_docs)) == wanted


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.without_near_duplicates(no_docs).columns == no_docs.columns


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fingerprints = [brute_fingerprint(r.text) for r in docs]
    wanted = as_rows([r.doc_id for r in docs], fingerprints, brute_components([r.doc_id for r in docs], fingerprints))
    assert result_rows(queries.op5_simhash_dedup(spark, sf_dir)) == wanted


def clustered(n, seed=1):
    """Random fingerprints, groups around some of them, chains of single bits, and neighbours of bit 63."""
    rnd = random.Random(seed)
    out = set()
    for _ in range(n):
        base = rnd.getrandbits(64)
        out.add(base)
        for _ in range(rnd.choice((0, 0, 1, 12))):
            base ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6)))
            out.add(base)
    return sorted(out)


@pytest.mark.parametrize("bucket_rows", [4096, 20])
def test_links_connect_as_all_pairs_do(spark, bucket_rows):
    values = clustered(300)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    from wordloom.operators.network import star_links

    links = simhash.near_links(fps, 4, bucket_rows)
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= 4 for a, b in links.collect())
    centre = {r.id: r.centre for r in star_links(links).collect()}
    assert [centre.get(v, v) for v in signed] == brute_components(signed, values)


def test_hot_bucket_is_cut_and_loses_nothing(spark):
    """Values that agree in most parts, so every bucket is hot."""
    rnd = random.Random(4)
    values = sorted({sum(1 << b for b in rnd.sample(range(12), 6)) ^ (rnd.getrandbits(1) << 40) for _ in range(400)})
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    from wordloom.operators.network import star_links

    centre = {r.id: r.centre for r in star_links(simhash.near_links(fps, 4, 50)).collect()}
    assert [centre.get(v, v) for v in values] == brute_components(values, values)


@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_thresholds_cover_every_distance(distance):
    shares = [np.array([0.001, 0.01, 0.1] + [0.1] * 20) for _ in range(3)]
    _, thresholds = simhash.allot(1000, [22, 21, 21], shares, distance)
    assert sum(t + 1 for t in thresholds) == distance + 1


def test_correlated_bits_share_a_part():
    strength = np.full((64, 64), 0.01)
    for a, b in ((0, 63), (0, 31), (31, 63)):
        strength[a, b] = strength[b, a] = 0.9
    parts = simhash.group_bits(strength, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({0, 31, 63} <= set(p) for p in parts)


def test_distance_shares_are_exact_within_a_block(spark):
    values = [3, 5, 6, 7, 100, 2 ** 40]
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    (share,) = simhash.distance_shares(fps, [list(range(8))])
    wanted = np.bincount([bin((a ^ b) & 255).count("1") for a in values for b in values], minlength=9) / 36
    assert np.allclose(share, wanted)


def test_one_row_of_a_group_stays_with_its_columns(spark, edge_docs):
    kept = simhash.without_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    groups = {r.component_id for r in simhash.near_duplicates(edge_docs).collect()}
    assert ids == sorted(map(str, groups))
