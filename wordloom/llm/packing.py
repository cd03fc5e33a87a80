"""Conflict-constrained best-fit packing of documents into sequences of equal capacity.

Documents are cut into pieces of at most the capacity. Groups of pieces, as many as the input needs, are packed on their
own: by falling size, each piece goes to the bin with the least room that still fits it and in which neither its source nor
its duplicate cluster is yet. Bins lie ordered by the room left and carry a bitmap of sources and one of clusters; the
search starts at the tightest bin that fits and goes on to its successors until one is compatible.
"""

from bisect import insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import grouped_batches, quoted
from wordloom.sources.workspace import staged

#: Bin numbers leave this many to each group.
_BINS_A_GROUP = 1 << 32


class _Bins:
    """Open bins ordered by the room left, then by number, with what all bins of a stretch of rooms have in common.

    A binary tree over the rooms holds the bits that every bin below a node has, of sources and of clusters. The search for
    the tightest compatible bin passes over a whole stretch if all its bins hold the piece's source, or its cluster; only
    in a stretch that may have a compatible bin does it go from bin to bin.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.at_room: list[list[int]] = [[] for _ in range(self.leaves)]
        # All bits, of no bin: the lowest bit is that of no source, so nothing is looked for in an empty stretch.
        self.all_sources, self.all_clusters = [-1] * (2 * self.leaves), [-1] * (2 * self.leaves)

    def open(self) -> int:
        self.sources.append(0)
        self.clusters.append(0)
        return len(self.sources) - 1

    def _set(self, room: int) -> None:
        node, sources, clusters = room + self.leaves, -1, -1
        for number in self.at_room[room]:
            sources &= self.sources[number]
            clusters &= self.clusters[number]
        while node:
            if self.all_sources[node] == sources and self.all_clusters[node] == clusters:
                return
            self.all_sources[node], self.all_clusters[node] = sources, clusters
            beside, node = node ^ 1, node >> 1
            sources, clusters = sources & self.all_sources[beside], clusters & self.all_clusters[beside]

    def put(self, number: int, room: int) -> None:
        insort(self.at_room[room], number)
        self._set(room)

    def take(self, size: int, source: int, cluster: int) -> tuple[int, int] | None:
        """``(bin, room)`` of the tightest compatible bin, which is taken out; None if there is none."""
        node = size + self.leaves
        while True:
            if self.all_sources[node] & (source | 1) or self.all_clusters[node] & cluster:
                while node & 1:
                    node >>= 1
                if not node:
                    return None
                node += 1
            elif node < self.leaves:
                node *= 2
            else:
                room = node - self.leaves
                for number in self.at_room[room]:
                    if not (self.sources[number] & source or self.clusters[number] & cluster):
                        self.at_room[room].remove(number)
                        self._set(room)
                        return number, room
                while node & 1:
                    node >>= 1
                if not node:
                    return None
                node += 1


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """``(bin, offset)`` of each piece. Null sources and clusters are compatible with everything.

    Pieces of equal size are packed in the order given. A piece of the whole capacity fills a bin of its own.
    """
    source_bits = {s: 2 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    repeated = [c for c, n in Counter(c for c in clusters if c is not None).items() if n > 1]
    cluster_bits = {c: 1 << i for i, c in enumerate(repeated)}
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    bins = _Bins(capacity)
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        source, cluster = source_bits.get(sources[piece], 0), cluster_bits.get(clusters[piece], 0)
        chosen, room = bins.take(size, source, cluster) or (bins.open(), capacity)
        placed[piece] = (chosen, capacity - room)
        bins.sources[chosen] |= source
        bins.clusters[chosen] |= cluster
        if room > size:
            bins.put(chosen, room - size)
    return placed


def pieces(docs: DataFrame, capacity: int, doc_id: str, text: str, source: str, cluster: str | None) -> DataFrame:
    """``(doc_id, piece, start, n_tokens, source, cluster)``: a text's words and one end mark, cut at ``capacity``."""
    body = quoted(text)
    words = F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+"))
    where = quoted(source).cast("string") if source in docs.columns else F.lit(None).cast("string")
    same = F.xxhash64(F.trim(F.regexp_replace(body, r"[\x20\x09-\x0D]+", " ")))
    sized = docs.select(
        quoted(doc_id).alias("doc_id"), (F.coalesce(words, F.lit(0)).cast("bigint") + 1).alias("_all"), where.alias("source"),
        (F.when(body.isNotNull(), same) if cluster is None else quoted(cluster)).alias("cluster"))
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_all") - 1) / capacity))
    cut = sized.select("*", F.explode(parts).alias("piece")).withColumn("start", F.col("piece") * capacity)
    return cut.select("doc_id", "piece", "start", F.least(F.col("_all") - F.col("start"), F.lit(capacity)).alias("n_tokens"), "source", "cluster")


def pack(docs: DataFrame, capacity: int = 2048, group_rows: int = 16_384, doc_id: str = "doc_id", text: str = "text",
         source: str = "source", cluster: str | None = None) -> DataFrame:
    """``(bin_id, offset, doc_id, piece, start, n_tokens)``: every token of every row of ``docs`` in exactly one place.

    A row is its words and one end mark, so null and empty texts have one token. Pieces start at the token ``start`` of
    their document and at ``offset`` in their bin. No bin holds two pieces of one source or of one duplicate cluster;
    ``cluster`` names a column of cluster ids, by default texts that differ in white space alone are duplicates. Null
    sources, clusters and texts are in no conflict. Repeated rows are packed each; an empty table has no bins. A missing
    source column counts as null. Groups have about ``group_rows`` pieces, dealt by hash, so no task depends on the input's
    size; each group leaves a few bins open, which is all that packing in groups costs.
    """
    # The row numbers are written with the rows, so a repeated task deals the same pieces to the same groups.
    cut = staged(pieces(docs, capacity, doc_id, text, source, cluster).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-cut.count() // group_rows))

    def run(batches):
        for group, parts in grouped_batches(batches, "_group"):
            table = pa.Table.from_batches(list(parts))
            placed = best_fit(*(table[c].to_pylist() for c in ("n_tokens", "source", "cluster")), capacity)
            yield from table.select(["doc_id", "piece", "start", "n_tokens"]).add_column(
                0, "bin_id", pa.array([group * _BINS_A_GROUP + b for b, _ in placed], pa.int64())).add_column(
                1, "offset", pa.array([o for _, o in placed], pa.int64())).to_batches()

    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int"))
    ordered = dealt.repartitionById(groups, F.col("_group")).sortWithinPartitions("_group", F.desc("n_tokens"), "_row")
    kind = dict(cut.dtypes)["doc_id"]
    return ordered.mapInArrow(run, f"bin_id bigint, offset bigint, doc_id {kind}, piece bigint, start bigint, n_tokens bigint")
