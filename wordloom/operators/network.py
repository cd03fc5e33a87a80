"""Synonym and antonym networks as edge tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.numbering import collect_in_parts, ordered_ids
from wordloom.sources.workspace import RoundTables, staged


def both_ways(edges: DataFrame, rel: str) -> DataFrame:
    """``(word, neighbour)`` of one relation, each edge seen from both ends in a single scan."""
    ends = F.array(
        F.struct(F.col("src").alias("word"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("word"), F.col("src").alias("neighbour")),
    )
    return edges.where(F.col("rel") == rel).select(F.inline(ends))


def _first_words(pairs: DataFrame, limit: int | None) -> DataFrame:
    if limit is None:
        return pairs
    first = pairs.select("word").distinct().orderBy("word").limit(limit)
    return pairs.join(first, "word", "left_semi")


def neighbour_sets(edges: DataFrame, rel: str, limit: int | None = None, part_size: int = 1000) -> DataFrame:
    """``(word, part, neighbours)``: distinct neighbours in either direction, sorted.

    ``limit`` keeps the first words, not edges. Neighbours beyond ``part_size`` continue in further parts.
    """
    pairs = staged(_first_words(both_ways(edges, rel), limit), "neighbour-pairs")  # read up to three times below
    return collect_in_parts(pairs, ["word"], "neighbour", part_size).withColumnRenamed("values", "neighbours")


def network_edges(edges: DataFrame, rel: str, limit: int | None = None) -> DataFrame:
    """Undirected simple graph ``(a, b)``, ``a < b``, of the first ``limit`` words and their neighbours."""
    pairs = edges.where(F.col("rel") == rel).select(F.col("src").alias("word"), F.col("dst").alias("neighbour"))
    if limit is not None:
        pairs = _first_words(both_ways(edges, rel), limit)
    return (
        pairs.select(F.least("word", "neighbour").alias("a"), F.greatest("word", "neighbour").alias("b"))
        .where("a != b").distinct()
    )


def _ends(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """Each pair seen from both ends, in a single scan."""
    return pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias(x), F.col("b").alias(y)), F.struct(F.col("b").alias(x), F.col("a").alias(y)))))


def _large_star(pairs: DataFrame, store: RoundTables) -> DataFrame:
    """Link every larger neighbour of a node to the smallest among the node and its neighbours."""
    around = _ends(pairs, "u", "v")
    smallest = around.groupBy("u").agg(F.min("v").alias("_min")).select("u", F.least("u", "_min").alias("m"))
    smallest = store(smallest, "smallest")
    return around.where("v > u").join(smallest, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(pairs: DataFrame, store: RoundTables) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; pairs are ``a < b``."""
    smallest = store(pairs.groupBy("b").agg(F.min("a").alias("m")), "smallest")
    linked = pairs.join(smallest, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a != b")
    return linked.unionByName(smallest.select(F.col("m").alias("a"), "b")).distinct()


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node is either a centre or linked to exactly one centre."""
    roles = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(0).alias("up")), F.struct(F.col("b").alias("node"), F.lit(1).alias("up")))))
    counts = roles.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("centre"))
    return counts.where((F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("centre") == 0))).isEmpty()


def star_links(pairs: DataFrame, files: int | None = None) -> DataFrame:
    """``(id, centre)`` of every number in undirected pairs ``(a, b)`` of numbers; the centre is the smallest reachable.

    Alternating large-star and small-star steps: the number of rounds grows with the logarithm of the longest
    path, and a hub costs one minimum per round instead of a list of its neighbours. Every step and its minima are
    written to the shared folder, so a lost executor never sets a round back, no plan grows with the rounds, and the
    joins shuffle both sides themselves, which is what lets Spark split the partition of a hub. ``files`` bounds the
    files of each written table, for a caller that knows about how many rows there are.
    """
    store = RoundTables(pairs.sparkSession, files)
    stars = store(pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "stars")
    while True:
        stars = store(_large_star(stars, store), "stars")
        stars = store(_small_star(stars, store), "stars")
        if _are_stars(stars):
            break
    store.finish("stars")
    centres = stars.select(F.col("a").alias("id"), F.col("a").alias("centre")).distinct()
    return stars.select(F.col("b").alias("id"), F.col("a").alias("centre")).unionByName(centres)


def components(pairs: DataFrame) -> DataFrame:
    """``(word, component)`` for undirected pairs ``(a, b)``; a component is named by its smallest word.

    The rounds of :func:`star_links` work on numbers that keep the order of the words and make for short shuffle rows
    and hash aggregation.
    """
    words = pairs.where("a != b").select(F.explode(F.array("a", "b")).alias("word")).distinct()
    ids = ordered_ids(words, "word")

    def id_of(column: str) -> DataFrame:
        return ids.select(F.col("word").alias(column), F.col("id").alias(f"{column}_id"))

    numbered = pairs.where("a != b").join(id_of("a"), "a").join(id_of("b"), "b")
    linked = star_links(numbered.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))
    names = ids.select(F.col("id").alias("centre"), F.col("word").alias("component"))
    return linked.join(ids, "id").join(names, "centre").select("word", "component")


def added_to_components(stored: DataFrame, new_pairs: DataFrame) -> DataFrame:
    """``(word, component)`` of the words whose component changes when ``new_pairs`` join a graph of known components.

    The known components are contracted to their names, and only the new pairs between different ones go through the star
    steps; a word that is not known is a component of its own. As a component is named by its smallest word, the
    smallest name of joined ones is theirs. Pairs can be added, not taken away.
    """
    names = stored.select("word", "component")

    def contracted(pairs: DataFrame, end: str) -> DataFrame:
        known = names.select(F.col("word").alias(end), F.col("component").alias("_name"))
        return pairs.join(known, end, "left").withColumn(f"_{end}", F.coalesce("_name", end)).drop("_name")

    pairs = new_pairs.where("a != b").select("a", "b").distinct()
    between = staged(contracted(contracted(pairs, "a"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("a").alias("_first"), F.col("b").alias("_second")), "new-pairs")
    joined = staged(components(between.where("a != b").select("a", "b").distinct()), "joined-components")
    renamed = joined.select(F.col("word").alias("component"), F.col("component").alias("_new")).where("component != _new")
    moved = names.join(renamed, "component").select("word", F.col("_new").alias("component"))
    fresh = between.select(F.explode(F.array("_first", "_second")).alias("word")).distinct().join(names, "word", "left_anti")
    return moved.unionByName(fresh.join(joined, "word", "left").select("word", F.coalesce("component", "word").alias("component")))


def modularity(pairs: DataFrame, membership: DataFrame, group: str) -> DataFrame:
    """``(modularity)`` of a partition: sum over groups of L/m - (d/2m)^2."""
    groups = membership.select("word", F.col(group).alias("g"))
    inner = F.col("ga") == F.col("gb")
    # Every edge has two ends, so d counts edge ends and inside counts each inner edge twice.
    per_group = (
        pairs.join(groups.toDF("a", "ga"), "a").join(groups.toDF("b", "gb"), "b")
        .select(F.inline(F.array(F.struct(F.col("ga").alias("g"), inner.alias("inner")),
                                 F.struct(F.col("gb").alias("g"), inner.alias("inner")))))
        .groupBy("g").agg(F.count("*").alias("d"), F.count_if("inner").alias("inside"))
    )
    ends_total = F.sum("d")
    # sum(d)^2 is constant, so one aggregate gives all three sums.
    return per_group.agg(
        (F.sum("inside") / ends_total
         - F.sum(F.col("d").cast("double") * F.col("d")) / (ends_total.cast("double") * ends_total)).alias("modularity")
    )
