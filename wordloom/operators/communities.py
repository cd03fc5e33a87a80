"""Themes: communities of a word network found by greedy modularity merging.

Merging two linked groups x and y changes modularity in proportion to ``2 m links(x, y) - degree(x) degree(y)`` with
``m`` edges in the whole network. That is an integer, so ties and stopping are exact, and it never involves a group
that is not linked to x or y, so merges that do not touch can happen together.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.numbering import number_rows
from wordloom.sources.workspace import RoundTables, staged


def _both_ends(*carried: str) -> Column:
    def end(x: str, y: str) -> Column:
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"), *[F.col(c).alias(c) for c in carried])

    return F.inline(F.array(end("x", "y"), end("y", "x")))


def _big(column: str) -> Column:
    """Wide enough for products of two edge counts."""
    return F.col(column).cast("decimal(19,0)")


def _merge_round(links: DataFrame, degrees: DataFrame, total: int, store: RoundTables) -> DataFrame:
    """``(x, root)`` for the groups that change in this round; empty when no merge helps.

    Every group looks at its best partner; ties are broken by hash, so that along a path of equals many pairs choose
    each other and not only the first. Such pairs merge, and groups whose choice is in such a pair may join it if
    they gain at least half of what the pair gains; else they wait, as better merges of their partner come first.
    Joining is decided per pair on nested subsets of the followers (all, about a half, a quarter, ...): the largest
    subset under which modularity does not fall joins. Subset sums are aggregates over at most 64 levels, so a hub
    with any number of followers is no problem for one task.
    """
    dx = degrees.select(F.col("g").alias("x"), F.col("degree").alias("dx"))
    dy = degrees.select(F.col("g").alias("y"), F.col("degree").alias("dy"))
    twice = F.lit(2 * total).cast("decimal(19,0)")
    scored = (
        links.join(dx, "x").join(dy, "y")
        .withColumn("loss", _big("dx") * _big("dy") - twice * _big("n"))
        .where("loss <= 0")
    )
    lo, hi = F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")
    ends = scored.withColumn("h", F.xxhash64(lo, hi)).select(_both_ends("n", "loss", "h"))
    # One struct is both the order and what is kept, which makes for short rows in the sort and the shuffle.
    best = ends.groupBy("x").agg(F.min(F.struct("loss", "h", lo, hi, "n")).alias("b"))
    best = best.select("x", F.when(F.col("b.lo") == F.col("x"), F.col("b.hi")).otherwise(F.col("b.lo")).alias("y"), "b.n", "b.loss")
    best = store(best, "best")
    choice = best.select(F.col("x").alias("y"), F.col("y").alias("back"))
    # Written, so that the next join on the same column shuffles anew and Spark can split a hub's partition.
    decided = store(best.join(choice, "y").withColumn("mutual", F.col("back") == F.col("x")), "decided")
    pairs = decided.where("mutual").select("x", F.least("x", "y").alias("root"), "n", "loss")
    joined = pairs.select(F.col("x").alias("y"), "root", F.col("loss").alias("pair_loss"))
    level = F.length(F.regexp_extract(F.bin(F.xxhash64("x")), "0*$", 0))
    followers = decided.where("NOT mutual").select("x", "y", "n", "loss").join(joined, "y").where(
        "2 * loss <= pair_loss").select("x", "root", "n", level.alias("level"))
    # A pair's edge is seen from both members; it counts once.
    weight = F.when(F.col("level").isNull(), F.col("n") / 2).otherwise(F.col("n"))
    sums = (
        followers.unionByName(pairs.drop("loss").withColumn("level", F.lit(None).cast("int")))
        .join(dx, "x").groupBy("root", "level")
        .agg(F.sum(weight).cast("bigint").alias("n"), F.sum("dx").alias("d"),
             F.sum(_big("dx") * _big("dx")).alias("d2"))
    )
    # Nulls, the pair itself, come first; then the smallest subsets.
    upto = Window.partitionBy("root").orderBy(F.col("level").desc_nulls_first())
    running = sums.select("root", "level", *[F.sum(c).over(upto).alias(c) for c in ("n", "d", "d2")])
    loss = (_big("d") * _big("d") - F.col("d2")) / 2 - twice * _big("n")
    accepted = running.where(F.col("level").isNotNull() & (loss <= 0)).groupBy("root").agg(F.min("level").alias("from"))
    accepted = store(accepted, "accepted")
    joining = followers.join(accepted, "root").where("level >= from").select("x", "root")
    return pairs.select("x", "root").unionByName(joining)


def merge_in_rounds(pairs: DataFrame) -> DataFrame:
    """``(word, theme)`` by merging many pairs of linked groups per round, whatever the size of a component.

    A theme is named by its smallest word. Modularity never falls, and at the end no merge would raise it.
    """
    store = RoundTables(pairs.sparkSession, rows_a_file=500_000)
    links = store(pairs.toDF("x", "y").withColumn("n", F.lit(1).cast("bigint")), "links")
    total = links.count()
    degrees = links.select(_both_ends("n")).groupBy(F.col("x").alias("g")).agg(F.sum("n").alias("degree"))
    degrees = store(degrees, "degrees")
    groups = degrees.select(F.col("g").alias("word"), F.col("g").alias("theme"))
    while True:
        moves = store(_merge_round(links, degrees, total, store), "moves")
        if moves.isEmpty():
            break

        def moved(df: DataFrame, column: str) -> DataFrame:
            target = moves.select(F.col("x").alias(column), F.col("root").alias("_root"))
            return df.join(target, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")

        contracted = moved(moved(links, "x"), "y").where("x != y")
        contracted = contracted.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        links = store(contracted.agg(F.sum("n").alias("n")), "links")
        degrees = store(moved(degrees, "g").groupBy("g").agg(F.sum("degree").alias("degree")), "degrees")
        groups = store(moved(groups, "theme"), "groups")
    names = store(groups.groupBy("theme").agg(F.min("word").alias("name")), "names")
    # Without any merge the groups are read from the degrees.
    store.finish("groups", "names", "degrees")
    return groups.join(names, "theme").select("word", F.col("name").alias("theme"))


def _move_round(around: DataFrame, ends: DataFrame, groups: DataFrame, total: int, store: RoundTables) -> DataFrame:
    """``(word, theme)`` of the words that change their theme in this round; empty when no single move helps.

    A word's gain from theme c to theme t is ``2 m (links to t - links to c) - k (D_t - D_c + k)``, with its degree k and the
    themes' degrees D. Of all moves at a theme the best counts, and a pair of themes acts if that is the same move for
    both: then no theme is in two pairs, and gains of different pairs add up. All words with a gain between the two may go
    along, on nested subsets (all, about a half, a quarter, ...): k of several words together costs
    ``K^2 - sum k^2`` more, links between them cost less, so the largest subset whose gains outweigh that goes; else
    the best word alone.
    """
    own = groups.select("word", F.col("theme").alias("c"))
    size = store(groups.join(ends, "word").groupBy("theme").agg(F.sum("k").alias("d")), "theme-degrees")
    seen = around.join(groups.select(F.col("word").alias("v"), F.col("theme").alias("t")), "v")
    links = store(seen.groupBy("word", "t").agg(F.count("*").alias("n")), "theme-links")
    at_home = links.join(own, "word").where("t = c").select("word", F.col("n").alias("home"))
    away = links.join(own, "word").where("t != c").join(at_home, "word", "left").join(ends, "word")
    away = away.join(size.select(F.col("theme").alias("t"), F.col("d").alias("dt")), "t").join(
        size.select(F.col("theme").alias("c"), F.col("d").alias("dc")), "c")
    twice = F.lit(2 * total).cast("decimal(19,0)")
    gain = twice * (_big("n") - F.coalesce(_big("home"), F.lit(0))) - _big("k") * (_big("dt") - _big("dc") + _big("k"))
    order = F.struct(-F.col("gain"), F.xxhash64("word", "c", "t"), "word", "t")
    # A word takes part with its best move only.
    best = away.withColumn("gain", gain).where("gain > 0").groupBy("word").agg(
        F.min_by(F.struct("c", "t", "k", "gain"), F.struct(-F.col("gain"), "t")).alias("b")).select("word", "b.*")
    moves = store(best, "single-moves")
    top = F.min_by(F.struct("word", "c", "t"), order).alias("top")
    at_theme = moves.select("word", "c", "t", "gain", F.explode(F.array("c", "t")).alias("theme")).groupBy("theme").agg(top)
    chosen = at_theme.groupBy("top").agg(F.count("*").alias("sides")).where("sides = 2").select(
        F.col("top.c").alias("c"), F.col("top.t").alias("t"), F.col("top.word").alias("leader"))
    chosen = store(chosen, "theme-pairs")
    level = F.length(F.regexp_extract(F.bin(F.xxhash64("word", F.lit(7))), "0*$", 0)).alias("level")
    going = store(moves.join(chosen, ["c", "t"]).select("word", "c", "t", "k", "gain", "leader", level), "going")
    sums = going.groupBy("c", "t", "level").agg(
        F.sum("gain").alias("gain"), F.sum(_big("k")).alias("k"), F.sum(_big("k") * _big("k")).alias("k2"))
    upto = Window.partitionBy("c", "t").orderBy(F.desc("level"))
    running = sums.select("c", "t", "level", *[F.sum(x).over(upto).alias(x) for x in ("gain", "k", "k2")])
    accepted = running.where("gain > k * k - k2").groupBy("c", "t").agg(F.min("level").alias("from"))
    return going.join(accepted, ["c", "t"], "left").where("level >= from OR from IS NULL AND word = leader").select(
        "word", F.col("t").alias("theme"))


def move_in_rounds(pairs: DataFrame, grouped: DataFrame) -> DataFrame:
    """``(word, theme)`` after single words moved between themes until no move raises modularity, which never falls.

    Merging is never undone, so an early merge can leave a word on the wrong side; this mends it. Moves run in rounds over
    pairs of themes that have none in common. A theme is named by its smallest word; one that loses all its words is gone.
    """
    store = RoundTables(pairs.sparkSession, rows_a_file=500_000)
    around = store(pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("v")), F.struct(F.col("b").alias("word"), F.col("a").alias("v"))))), "around")
    total = around.count() // 2
    ends = store(around.groupBy("word").agg(F.count("*").alias("k")), "word-degrees")
    groups = store(grouped.select("word", "theme"), "groups")
    while True:
        moves = store(_move_round(around, ends, groups, total, store), "moves")
        if moves.isEmpty():
            break
        groups = store(groups.join(moves.withColumnRenamed("theme", "_theme"), "word", "left").select(
            "word", F.coalesce("_theme", "theme").alias("theme")), "groups")
    names = store(groups.groupBy("theme").agg(F.min("word").alias("name")), "names")
    store.finish("groups", "names")
    return groups.join(names, "theme").select("word", F.col("name").alias("theme"))


def themes(pairs: DataFrame, moving: bool = False) -> DataFrame:
    """``(theme_id, theme, word)``: every word of the network in one theme, the largest themes first.

    ``pairs`` are distinct undirected edges ``(a, b)``. With ``moving``, single words move between the merged themes where
    that raises modularity.
    """
    grouped = staged(merge_in_rounds(pairs), "themes")
    if moving:
        grouped = staged(move_in_rounds(pairs, grouped), "moved-themes")
    ranked = number_rows(grouped.groupBy("theme").agg(F.count("*").alias("n")), F.desc("n"), "theme", name="rank")
    return grouped.join(ranked, "theme").select((F.col("rank") - 1).alias("theme_id"), "theme", "word")
