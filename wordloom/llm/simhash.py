"""SimHash near-dedup by the generalised pigeonhole principle.

Two fingerprints within ``distance`` bits differ in at most ``t_i`` bits of at least one part i, whatever the parts,
as long as the ``t_i + 1`` add up to ``distance + 1``. Bits that go together are put into the same part, the ``t_i``
are allotted by dynamic programming on candidate counts estimated from histograms of all fingerprints, and the number
of parts is the one with the lowest estimated cost. A fingerprint is filed under its own bits of each part and probed
under every value within ``t_i`` of them; what meets in a bucket is compared bit by bit.
"""

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import byte_texts, map_batches, word_blocks
from wordloom.operators.network import star_links
from wordloom.sources.workspace import files_for, staged

BITS = 64
SEED = 42
_HASHES_AT_ONCE = 1 << 14


def _bit_sums(shingles: Iterator[bytes]) -> tuple[np.ndarray, int]:
    """How many of the shingles' hashes have each bit set, and the number of hashes."""
    digest, sums, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0
    while True:
        block = [digest(s, SEED) for _, s in zip(range(_HASHES_AT_ONCE), shingles)]
        if not block:
            return sums, n
        bits = np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int32)
        n += len(block)


def _shingles(text: bytes | None, width: int) -> Iterator[bytes]:
    """Runs of ``width`` words joined by one space; all words of a shorter text as one."""
    carried: list[bytes] = []
    seen = False
    for words in word_blocks(text.lower() if text else text):
        words = carried + words
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        if len(words) >= width:
            seen, joined = True, b" ".join(words)
            starts = np.concatenate(([0], ends[:-1] + 1))
            for a, b in zip(starts.tolist(), ends[width - 1:].tolist()):
                yield joined[a:b]
        carried = words[max(0, len(words) - width + 1):] if len(words) >= width else words
    if not seen and carried:
        yield b" ".join(carried)


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """The 64-bit SimHash of a text as a signed number; 0 without words."""
    sums, n = _bit_sums(_shingles(text, width))
    return int(np.packbits(sums * 2 > n, bitorder="little").view("<i8")[0]) if n else 0


def with_fingerprints(docs: DataFrame, width: int = 4, text: str = "text", name: str = "_fp",
                      keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the fingerprint of the whole text of each row as a bigint. Null, empty and blank texts give 0."""
    place = docs.columns.index(text)

    def work():
        return lambda batch: [pa.array([fingerprint(t, width) for t in byte_texts(batch.column(place))], pa.int64())]

    return map_batches(docs, work, f"`{name}` bigint", keep)


# --- Statistics over all fingerprints: bounded tables whatever the number of fingerprints


def _columns(values: np.ndarray) -> np.ndarray:
    """One row of 64 bits a value; column b is bit b."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlations(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and the 64 x 64 absolute correlations of their bits, from counts over all of them."""

    def count(batches):
        together, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            bits = _columns(batch.column(0).to_numpy()).astype(np.float32)
            together += np.rint(bits.T @ bits).astype(np.int64)
            n += len(bits)
        i, j = np.triu_indices(BITS)
        places, sums = np.append(i * BITS + j, -1), np.append(together[i, j], n)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(sums, pa.int64())], ["place", "n"])

    rows = fps.select("fp").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    sums = {place: n for place, n in rows.collect()}  # at most 2,081 rows
    n = sums.pop(-1, 0)
    if not n:
        return 0, np.zeros((BITS, BITS))
    both = np.zeros((BITS, BITS))
    for place, s in sums.items():
        both[place // BITS, place % BITS] = both[place % BITS, place // BITS] = s / n
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return n, np.abs((both - np.outer(mean, mean)) / np.outer(spread, spread))


def group_bits(correlations: np.ndarray, parts: int) -> list[list[int]]:
    """Bits 0..63 in ``parts`` parts of nearly equal width; each part takes in the bit most correlated with it."""
    left, out = set(range(BITS)), []
    strength = correlations - np.diag(np.diag(correlations))
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        first = max(sorted(left), key=lambda b: strength[b, sorted(left)].sum())
        part, pull = [first], strength[first].copy()
        left.remove(first)
        while len(part) < width:
            best = max(sorted(left), key=lambda b: pull[b])
            part.append(best)
            left.remove(best)
            pull += strength[best]
        out.append(part)
    return out


_HISTOGRAM_BITS = 11


def _blocks(part: list[int]) -> list[list[int]]:
    n = -(-len(part) // _HISTOGRAM_BITS)
    return [part[i::n] for i in range(n)]


def distance_shares(fps: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """For each part, the share of all pairs of fingerprints at 0, 1, 2, ... differing bits.

    Each part is cut into blocks of at most 11 bits, whose 2,048 values are counted over all fingerprints. The pairs
    of a block by distance follow exactly from its histogram (a Walsh-Hadamard transform); blocks of a part are taken as
    independent.
    """
    blocks = [(p, b) for p, part in enumerate(parts) for b in _blocks(part)]

    def count(batches):
        sums = np.zeros((len(blocks), 1 << _HISTOGRAM_BITS), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy()
            for k, (_, bits) in enumerate(blocks):
                short = np.zeros(len(values), np.int64)
                for place, bit in enumerate(bits):
                    short |= ((values >> bit) & 1) << place
                sums[k] += np.bincount(short, minlength=1 << _HISTOGRAM_BITS)
        k, v = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(v, pa.int64()), pa.array(sums[k, v])], ["k", "v", "n"])

    counted = fps.select("fp").mapInArrow(count, "k bigint, v bigint, n bigint").groupBy("k", "v").agg(F.sum("n").alias("n"))
    histograms = [np.zeros(1 << len(bits)) for _, bits in blocks]
    for row in counted.collect():  # at most 2,048 rows a block
        histograms[row.k][row.v] = row.n
    shares = [np.ones(1) for _ in parts]
    for (p, bits), histogram in zip(blocks, histograms):
        spectrum = histogram / max(histogram.sum(), 1)
        for step in range(len(bits)):
            pairs = spectrum.reshape(-1, 2, 1 << step)
            spectrum = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(-1)
        spectrum = spectrum * spectrum
        for step in range(len(bits)):
            pairs = spectrum.reshape(-1, 2, 1 << step)
            spectrum = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(-1)
        apart = np.bitwise_count(np.arange(len(spectrum)))
        by_distance = np.bincount(apart, weights=np.maximum(spectrum, 0) / len(spectrum), minlength=len(bits) + 1)
        shares[p] = np.convolve(shares[p], by_distance)
    return shares


#: What a filed or probed row costs against one comparison of two fingerprints.
ROW_COST = 50.0


def allot(n: int, widths: list[int], shares: list[np.ndarray], distance: int) -> tuple[float, list[int]]:
    """The cheapest thresholds ``t_i >= -1`` whose ``t_i + 1`` add up to ``distance + 1``, and their estimated cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, share in zip(widths, shares):
        cost = [0.0]
        for t in range(distance + 1):
            probes = n * (1 + sum(comb(width, k) for k in range(1, t + 1)))
            cost.append(ROW_COST * probes + n * n / 2 * float(share[:t + 1].sum()))
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for more in range(distance + 2 - used):
                if more <= width and (used + more not in step or spent + cost[more] < step[used + more][0]):
                    step[used + more] = (spent + cost[more], [*chosen, more - 1])
        best = step
    return best[distance + 1]


def plan(fps: DataFrame, distance: int, choices: range = range(2, 8)) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of every part that is searched, by the lowest estimated cost over the numbers of parts."""
    n, correlations = bit_correlations(fps)
    grouped = [group_bits(correlations, m) for m in choices]
    shares = iter(distance_shares(fps, [part for parts in grouped for part in parts]))
    plans = []
    for parts in grouped:
        cost, thresholds = allot(n, [len(p) for p in parts], [next(shares) for _ in parts], distance)
        plans.append((cost, [(bits, t) for bits, t in zip(parts, thresholds) if t >= 0]))
    return min(plans, key=lambda p: p[0])[1]


# --- Buckets


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; counted on unsigned numbers, as numpy counts the bits of a negative one's absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row r repeated ``counts[r]`` times, with the numbers 0, 1, ... within each row."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def _all_links(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distance: int) -> Iterator[np.ndarray]:
    """Links between all values of each run; ``sizes`` are small."""
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start = np.repeat(starts, sizes)
    cuts = np.searchsorted(np.cumsum(place), np.arange(0, place.sum() + 1, 1 << 20)[1:])
    for rows in np.split(np.arange(len(place)), cuts):
        if len(rows):
            which, before = _expand(place[rows])
            a, b = values[(start + place)[rows][which]], values[start[rows][which] + before]
            near = (_apart(a, b) <= distance) & (a != b)
            yield np.stack([a[near], b[near]])


def spanning_links(values: np.ndarray, distance: int, rows_at_once: int = 64) -> np.ndarray:
    """Links that connect the distinct ``values`` just as all links within ``distance`` would, without listing those.

    A breadth-first walk: the values reached last are compared with those not reached yet, so a dense group of n takes
    about n comparisons and n - 1 links.
    """
    left, found = np.unique(values), []
    while len(left):
        edge, left = left[:1], left[1:]
        while len(edge) and len(left):
            reached = []
            for at in range(0, len(edge), rows_at_once):
                block = edge[at:at + rows_at_once]
                near = _apart(block[:, None], left[None, :]) <= distance
                hit = near.any(axis=0)
                found.append(np.stack([block[near[:, hit].argmax(axis=0)], left[hit]]))
                reached.append(left[hit])
                left = left[~hit]
            edge = np.concatenate(reached)
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


_LARGE_RUN = 128


def _bucket_links(keys: np.ndarray, values: np.ndarray, distance: int) -> Iterator[np.ndarray]:
    """Links of all runs of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(starts, len(keys)))
    small = (sizes > 1) & (sizes <= _LARGE_RUN)
    if small.any():
        rows, more = _expand(sizes[small])
        yield from _all_links(values[starts[small][rows] + more], np.cumsum(sizes[small]) - sizes[small], sizes[small], distance)
    for start, size in zip(starts[sizes > _LARGE_RUN], sizes[sizes > _LARGE_RUN]):
        yield spanning_links(values[start:start + size], distance)


def bucket_links(filed: DataFrame, distance: int) -> DataFrame:
    """``(a, b)`` from rows ``(key, fp)`` that are partitioned and sorted by key."""

    def run(batches):
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(last: bool):
            nonlocal keys, values
            cut = len(keys) if last else int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                for found in _bucket_links(keys[:cut], values[:cut], distance):
                    if found.size:
                        yield pa.RecordBatch.from_arrays([pa.array(found.min(axis=0)), pa.array(found.max(axis=0))], ["a", "b"])
                keys, values = keys[cut:], values[cut:]

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            values = np.concatenate([values, batch.column(1).to_numpy()])
            yield from links(False)
        yield from links(True)

    return filed.mapInArrow(run, "a bigint, b bigint")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _masks(bits: list[int], threshold: int) -> list[int]:
    """What turns a value into each one within ``threshold`` bits of it: 0 first, the value itself."""
    return [_signed(sum(1 << b for b in flipped)) for k in range(threshold + 1) for flipped in combinations(bits, k)]


def filed_and_probed(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(key, fp)``: each fingerprint under its own value of every part and under every value within the threshold."""
    def keys(part: int, bits: list[int], threshold: int):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        flips = F.array(*[F.lit(m).cast("bigint") for m in _masks(bits, threshold)])
        return F.transform(flips, lambda flip: F.xxhash64(F.lit(part), own.bitwiseXOR(flip)))

    wanted = [keys(part, bits, t) for part, (bits, t) in enumerate(parts)]
    return fps.select(F.explode(F.concat(*wanted)).alias("key"), "fp")


def near_links(fps: DataFrame, distance: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """``(a, b)``, a < b: links that connect the distinct fingerprints ``fp`` as all pairs within ``distance`` bits do.

    Buckets above ``bucket_rows`` are cut into blocks by the fingerprints' hash; every pair of blocks is a bucket of
    its own, so all pairs still meet and no task gets a whole hot bucket.
    """
    parts = plan(fps, distance)
    filed = filed_and_probed(fps, parts)
    hot = staged(filed.groupBy("key").count().where(F.col("count") > bucket_rows)
                 .select("key", F.ceil(F.col("count") / bucket_rows).alias("_blocks")), "hot-buckets")
    if not hot.isEmpty():
        # Every row of a hot bucket goes to each pair of blocks that has its own block.
        own = F.pmod(F.xxhash64("fp", F.lit(1)), "_blocks")
        others = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1),
                             lambda o: F.xxhash64("key", F.least(own, o), F.greatest(own, o)))
        filed = filed.join(hot, "key", "left").select(
            F.explode(F.when(F.col("_blocks").isNull(), F.array("key")).otherwise(others)).alias("key"), "fp")
    dealt = filed.repartition("key").sortWithinPartitions("key")
    return bucket_links(dealt, distance)


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for each row of ``docs``.

    Fingerprints at ``distance`` or fewer differing bits link; ``component_id`` is the smallest id reachable, the own
    one included. Texts without a word have fingerprint 0 and link with each other like any others. Repeated rows come
    out repeated. A null id is never the smallest; ``component_id`` is null only where all reachable ids are. An empty
    table gives an empty result. Other columns are not read, so their names cannot clash.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = staged(with_fingerprints(own, width, keep=["doc_id"]), "fingerprints")
    groups = fingerprint_groups(rows, distance)
    return rows.join(groups, "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprint_groups(rows: DataFrame, distance: int) -> DataFrame:
    """``(_fp, component_id)`` of each fingerprint in rows of ``doc_id`` and ``_fp``."""
    fps = staged(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    links = near_links(fps.select("fp"), distance)
    # Short rows, no more than there are fingerprints (links of a bucket span it): few files while these are few.
    files = files_for(fps.count())
    linked = staged(star_links(links, files).coalesce(files), "linked-fingerprints")
    firsts = linked.join(fps.withColumnRenamed("fp", "id"), "id")
    smallest = staged(firsts.groupBy("centre").agg(F.min("first").alias("smallest")).coalesce(files), "component-firsts")
    named = staged(linked.join(smallest, "centre").select(F.col("id").alias("fp"), "smallest").coalesce(files), "named")
    return staged(fps.join(named, "fp", "left").select(
        F.col("fp").alias("_fp"), F.coalesce("smallest", "first").alias("component_id")).coalesce(files), "fingerprint-groups")


def without_near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, doc_id: str = "doc_id",
                            text: str = "text") -> DataFrame:
    """One row of each group that :func:`near_duplicates` finds, with the columns of ``docs``, whatever they are called.

    That is the first row with the group's smallest id; of groups without any id, one row for each fingerprint stays.
    Only ids and fingerprints are shuffled until the rows to keep are known.
    """
    own = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, own.columns))
    # The row numbers are written with the fingerprints, so that they cannot shift when a task is repeated.
    marked = staged(with_fingerprints(own.withColumnRenamed(names[text], "text"), width, "text").withColumn(
        "_row", F.monotonically_increasing_id()).withColumnRenamed("text", names[text]), "marked")
    rows = marked.select(F.col(names[doc_id]).alias("doc_id"), "_fp", "_row")
    groups = fingerprint_groups(rows, distance)
    firsts = rows.join(groups, "_fp").groupBy(
        F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("_fp"))).alias("group")).agg(
        F.min_by("_row", F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("_row"))
    return marked.join(firsts.select("_row"), "_row", "left_semi").select(*own.columns).toDF(*docs.columns)
