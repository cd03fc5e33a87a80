import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.operators import communities as C
from wordloom.operators import network as N
from wordloom.sources.files import rows
from wordloom.sources.workspace import RoundTables


def edge_table(spark, *pairs, rel="SYNONYM"):
    return rows(spark, [(a, rel, b) for a, b in pairs], "src string, rel string, dst string")


def pair_table(spark, pairs):
    return rows(spark, list(pairs), "a string, b string").repartition(4)


def random_graph(seed, size, count):
    pick = random.Random(seed)
    names = [f"w{i:03d}" for i in range(size)]
    return sorted({tuple(sorted(pick.sample(names, 2))) for _ in range(count)})


def union_find(pairs):
    root = {w: w for pair in pairs for w in pair}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    return sorted((w, find(w)) for w in root)


def quality(pairs, group):
    m = len(pairs)
    degree, inside = {}, {}
    for a, b in pairs:
        for w in (a, b):
            degree[group[w]] = degree.get(group[w], 0) + 1
        if group[a] == group[b]:
            inside[group[a]] = inside.get(group[a], 0) + 1
    return sum(inside.get(g, 0) / m - (d / (2 * m)) ** 2 for g, d in degree.items())


def brute_force_themes(pairs):
    """Try every linked pair of groups at every step and merge the best."""
    m = len(pairs)
    groups = [frozenset((w,)) for w in sorted({w for pair in pairs for w in pair})]
    while True:
        best = None
        for x, y in combinations(groups, 2):
            links = sum((a in x and b in y) or (a in y and b in x) for a, b in pairs)
            if links:
                dx, dy = (sum((a in g) + (b in g) for a, b in pairs) for g in (x, y))
                key = (dx * dy - 2 * m * links, *sorted((max(x), max(y))))
                if key[0] <= 0 and (best is None or key < best[0]):
                    best = key, x, y
        if best is None:
            return sorted((w, min(g)) for g in groups for w in g)
        groups = [g for g in groups if g not in best[1:]] + [best[1] | best[2]]


def test_neighbours_come_from_both_ends(spark):
    edges = edge_table(spark, ("a", "b"), ("b", "a"), ("c", "a"))
    assert rows_of(N.neighbour_sets(edges, "SYNONYM")) == [("a", 0, ["b", "c"]), ("b", 0, ["a"]), ("c", 0, ["a"])]
    assert N.neighbour_sets(edges, "ANTONYM").count() == 0


def test_limit_counts_words_not_edges(spark):
    edges = edge_table(spark, ("a", "x"), ("a", "y"), ("b", "z"), ("c", "d"))
    assert rows_of(N.network_edges(edges, "SYNONYM", limit=2)) == [("a", "x"), ("a", "y"), ("b", "z")]
    assert rows_of(N.neighbour_sets(edges, "SYNONYM", limit=1)) == [("a", 0, ["x", "y"])]


def test_network_is_simple_and_undirected(spark):
    edges = edge_table(spark, ("a", "b"), ("b", "a"), ("b", "b"), ("c", "b"))
    assert rows_of(N.network_edges(edges, "SYNONYM")) == [("a", "b"), ("b", "c")]


@pytest.mark.parametrize("pairs", [
    random_graph(1, 60, 45) + [("c", "c"), ("b", "a"), ("a", "b")],
    [(f"w{i + 1:03d}", f"w{i:03d}") for i in range(60)] + [("z", f"x{i:03d}") for i in range(50)],
])
def test_components_equal_union_find(spark, pairs):
    assert rows_of(N.components(pair_table(spark, pairs))) == union_find([pair for pair in pairs if pair[0] != pair[1]])


def test_modularity(spark):
    pairs = random_graph(5, 20, 40)
    group = {w: w[:3] for pair in pairs for w in pair}
    members = rows(spark, list(group.items()), "word string, g string")
    assert N.modularity(pair_table(spark, pairs), members, "g").first()[0] == pytest.approx(quality(pairs, group))


def themed(spark, pairs):
    return C.themes(pair_table(spark, pairs)).collect()


def test_themes_are_numbered_by_size(spark):
    pairs = [("x", "y"), ("a", "b"), ("b", "c"), ("a", "c")]
    assert sorted((r.theme_id, r.theme, r.word) for r in themed(spark, pairs)) == [
        (0, "a", "a"), (0, "a", "b"), (0, "a", "c"), (1, "x", "x"), (1, "x", "y")]
    assert themed(spark, []) == []


def cliques(count, size):
    inside = [(f"c{part:02d}w{a:02d}", f"c{part:02d}w{b:02d}") for part in range(count) for a in range(size) for b in range(a + 1, size)]
    return inside + [(f"c{part:02d}w{size - 1:02d}", f"c{part + 1:02d}w00") for part in range(count - 1)]


def test_linked_cliques_are_a_theme_each(spark):
    found = {row.word: row.theme for row in themed(spark, cliques(12, 9))}
    assert found == {w: w[:3] + "w00" for w in found} and len(found) == 108


def test_small_networks_equal_brute_force_in_quality(spark):
    """Merging many pairs at once takes another order than one at a time; it ends at least nearly as well."""
    for seed in range(3):
        pairs = random_graph(seed, 14, 22)
        found = {row.word: row.theme for row in themed(spark, pairs)}
        assert quality(pairs, found) >= quality(pairs, dict(brute_force_themes(pairs))) - 0.06


def test_a_component_has_the_same_themes_whatever_stands_beside_it(spark):
    """Only the number of edges counts: a large component and small ones of as many edges in all."""
    own = [("a" + a, "a" + b) for a, b in random_graph(3, 20, 40)]
    star = [("z", f"z{i:02d}") for i in range(30)]
    apart = [(f"y{i:02d}", f"y{i:02d}b") for i in range(30)]
    with_star, with_pairs = ({r.word: r.theme for r in themed(spark, own + rest)} for rest in (star, apart))
    assert {w: t for w, t in with_star.items() if w[0] == "a"} == {w: t for w, t in with_pairs.items() if w[0] == "a"}


@pytest.mark.parametrize("pairs", [
    random_graph(11, 60, 90),
    [("hub", f"w{i:03d}") for i in range(200)],
    [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(64)],
    sorted({(f"c{part}{a}", f"c{part}{b}") for part in range(5) for a, b in random_graph(part, 8, 22)}
           | {(f"c{part}w000", f"c{part + 1}w001") for part in range(4)}),
])
def test_merging_in_rounds_ends_where_no_merge_helps(spark, pairs):
    found = {row.word: row.theme for row in C.merge_in_rounds(pair_table(spark, pairs)).collect()}
    assert set(found) == {w for pair in pairs for w in pair}
    assert all(theme == min(w for w, t in found.items() if t == theme) for theme in set(found.values()))
    reached = quality(pairs, found)
    assert reached >= quality(pairs, {w: w for w in found})
    for x, y in {tuple(sorted((found[a], found[b]))) for a, b in pairs if found[a] != found[b]}:
        merged = {w: x if t == y else t for w, t in found.items()}
        assert quality(pairs, merged) < reached + 1e-12


def test_integer_links_are_connected(spark):
    from wordloom.sources.files import rows as table
    pairs = table(spark, [(1, 2), (3, 2), (7, 7), (-5, 9), (9, 8), (2, 1)], "a bigint, b bigint")
    assert rows_of(N.star_links(pairs)) == [(-5, -5), (1, 1), (2, 1), (3, 1), (8, -5), (9, -5)]
    assert N.star_links(pairs.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_moving_single_words_never_lowers_modularity(spark, seed):
    pairs = random_graph(seed, 40, 90)
    merged = {r.word: r.theme for r in C.merge_in_rounds(pair_table(spark, pairs)).collect()}
    moved = {r.word: r.theme for r in C.themes(pair_table(spark, pairs), moving=True).collect()}
    reached = quality(pairs, moved)
    assert set(moved) == set(merged) and reached >= quality(pairs, merged) - 1e-12
    assert all(theme == min(w for w, t in moved.items() if t == theme) for theme in set(moved.values()))
    for word in moved:  # no single move helps any more
        for theme in {moved[a if b == word else b] for a, b in pairs if word in (a, b)}:
            assert quality(pairs, moved | {word: theme}) < reached + 1e-12


def test_moving_undoes_an_early_merge(spark):
    """Two cliques, each with a word that was put into the other's theme."""
    pairs = cliques(4, 8)
    wrong = {w: w[:3] for pair in pairs for w in pair} | {"c00w03": "c01", "c01w04": "c00", "c02w00": "c01", "c02w01": "c01", "c02w02": "c01"}
    start = rows(spark, list(wrong.items()), "word string, theme string")
    found = {r.word: r.theme for r in C.move_in_rounds(pair_table(spark, pairs), start).collect()}
    assert quality(pairs, found) > quality(pairs, wrong) and found == {w: w[:3] + "w00" for w in wrong}


def test_tables_of_rounds_have_files_of_a_bounded_number_of_rows(spark):
    """Repetitive rows take few bytes, so files of many rows would be read by one task."""
    store = RoundTables(spark, rows_a_file=1000)
    table = store(spark.range(10_000).selectExpr("'same' AS x", "id % 2 AS y").coalesce(1), "links")
    sizes = table.groupBy(F.input_file_name().alias("file")).count().collect()
    assert table.count() == 10_000 and max(r["count"] for r in sizes) <= 1000
