"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import map_batches, quoted, remainder, slices
from wordloom.sources.workspace import staged

_ROWS_AT_ONCE = 256
_CHARS_AT_ONCE = 1 << 18
_SCALE = np.uint64(0x9E3779B97F4A7C15)

UNKNOWN = "und"


@dataclass(frozen=True)
class Grams:
    """n-grams of one to ``longest`` lower-case characters, hashed into ``2 ** bits`` buckets."""

    longest: int = 3
    bits: int = 14


def _pieces(texts: list[str | None], longest: int) -> Iterator[tuple[int, str, int]]:
    """``(row, piece, own)``: whole texts, lower-cased and with white space as single spaces, long ones in pieces.

    A piece goes on for ``longest - 1`` characters behind its ``own`` ones, so that every n-gram starts in exactly one.
    """
    for row, text in enumerate(texts):
        plain = " ".join((text or "").lower().split())
        for start in range(0, len(plain), _CHARS_AT_ONCE):
            yield row, plain[start:start + _CHARS_AT_ONCE + longest - 1], min(_CHARS_AT_ONCE, len(plain) - start)


def gram_counts(texts: list[str | None], grams: Grams) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sparse counts ``(row, bucket, n)`` of a few texts at a time; a row can come up in several blocks."""
    block: list[tuple[int, str, int]] = []
    size = 0
    for piece in _pieces(texts, grams.longest):
        block.append(piece)
        size += len(piece[1]) + 1
        if size >= _CHARS_AT_ONCE:
            yield _count(block, grams)
            block, size = [], 0
    if block:
        yield _count(block, grams)


def _count(block: list[tuple[int, str, int]], grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("\n".join(piece for _, piece, _ in block).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(piece) + 1 for _, piece, _ in block])
    lengths[-1] -= 1
    rows = np.repeat(np.array([row for row, _, _ in block], np.int64), lengths)
    owned = np.ones(len(codes), bool)
    for end, (_, piece, own) in zip(np.cumsum(lengths), block):
        if own < len(piece):
            owned[end - (len(piece) - own) - (end < len(codes)):end] = False
    shift = np.uint64(64 - grams.bits)
    sums, n = None, int(rows[-1]) + 1 if len(rows) else 0
    inside = codes != 10  # the line feed between texts; white space within them has become a space
    keys, mixed, whole = [], np.zeros(len(codes), np.uint64), inside
    for length in range(1, min(grams.longest, len(codes)) + 1):
        left = len(codes) - length + 1
        mixed = mixed[:left] * _SCALE + codes[length - 1:] + np.uint64(length)
        whole = whole[:left] & inside[length - 1:]
        bucket = ((mixed * _SCALE) >> shift).astype(np.int64)
        starts = whole & owned[:left]
        keys.append((rows[:left][starts] << grams.bits) | bucket[starts])
    keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    base = int(block[0][0]) << grams.bits
    span = ((n << grams.bits) - base) if n else 0
    if 0 < span <= 8 * max(len(keys), 1):
        sums = np.bincount(keys - base, minlength=1)
        found = np.flatnonzero(sums)
        keys, counts = found + base, sums[found]
    else:
        keys, counts = np.unique(keys, return_counts=True)
    return keys >> grams.bits, keys & ((1 << grams.bits) - 1), counts


@dataclass
class Block:
    """Log probabilities of some languages: ``logs[bucket, language]``."""

    languages: list[str]
    prior: np.ndarray
    logs: np.ndarray
    grams: Grams


@dataclass
class Model:
    """What was learnt: the languages by name, their shares of the rows and the written table of counts.

    The matrix of log probabilities is made in blocks of ``at_once`` languages, so neither the driver nor a task holds more
    than ``2 ** bits`` times so many numbers, whatever the number of languages.
    """

    languages: list[str]
    prior: np.ndarray
    counts: DataFrame
    grams: Grams
    smoothing: float
    at_once: int

    def blocks(self) -> Iterator[Block]:
        for start in range(0, len(self.languages), self.at_once):
            names = self.languages[start:start + self.at_once]
            place = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("lang")) - 1
            own = self.counts.where((F.col("lang") >= names[0]) & (F.col("lang") <= names[-1]) & (F.col("bucket") >= 0))
            own = own.select(place.cast("int").alias("place"), "bucket", "n").toPandas()
            sums = np.full((1 << self.grams.bits, len(names)), self.smoothing)
            sums[own["bucket"].to_numpy(), own["place"].to_numpy()] += own["n"].to_numpy()
            logs = np.log(sums) - np.log(sums.sum(axis=0, keepdims=True))
            yield Block(names, self.prior[start:start + self.at_once], logs, self.grams)


def fit(docs: DataFrame, grams: Grams = Grams(), smoothing: float = 0.5, at_once: int = 256,
        text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows of ``docs`` that have a text and a language.

    Tasks add up dense counts of at most ``at_once`` languages at a time and send the non-zero ones. The summed counts stay
    a table; the driver gets the names of the languages with their numbers of rows.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        rows_of: dict[str, int] = {}

        def sent():
            for name, own in sums.items():
                hit = np.flatnonzero(own)
                buckets, n = np.append(hit, -1), np.append(own[hit], rows_of[name])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(buckets), pa.string()), pa.array(buckets), pa.array(n)], ["lang", "bucket", "n"])
            sums.clear()
            rows_of.clear()

        for batch in batches:
            for part in (batch.slice(i, _ROWS_AT_ONCE) for i in range(0, batch.num_rows, _ROWS_AT_ONCE)):
                texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
                for name in set(langs):
                    if name not in sums and len(sums) >= at_once:
                        yield from sent()
                    own = sums.setdefault(name, np.zeros(1 << grams.bits, np.int64))
                    mine = [t for t, x in zip(texts, langs) if x == name]
                    rows_of[name] = rows_of.get(name, 0) + len(mine)
                    for _, buckets, n in gram_counts(mine, grams):
                        np.add.at(own, buckets, n)
        yield from sent()

    summed = known.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    summed = staged(summed, "language-counts")
    rows = sorted((r.lang, r.n) for r in summed.where("bucket = -1").select("lang", "n").collect())
    prior = np.array([n for _, n in rows], np.float64)
    return Model([name for name, _ in rows], np.log(np.maximum(prior, 1)) - np.log(max(prior.sum(), 1)), summed, grams, smoothing, at_once)


def _scores(texts: list[str | None], block: Block) -> np.ndarray:
    scores = np.tile(block.prior, (len(texts), 1))
    for rows, buckets, n in gram_counts(texts, block.grams):
        cuts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, np.int64)
        if len(cuts):
            scores[rows[cuts]] += np.add.reduceat(block.logs[buckets] * n[:, None], cuts, axis=0)
    return scores


def _best(docs: DataFrame, block: Block, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and, of the block's languages, ``name`` of the first best one, its log probability ``top`` and the sum ``whole``
    of all as logarithm; nulls for texts without a letter."""
    place = docs.columns.index(text)
    names, prior, grams = np.array(block.languages, object), block.prior, block.grams
    matrix = docs.sparkSession.sparkContext.broadcast(block.logs)

    def work():
        known = Block(list(names), prior, matrix.value, grams)

        def each(batch):
            found, tops, wholes, blanks = [], [], [], []
            for part in slices(batch.column(place), _ROWS_AT_ONCE):
                texts = part.to_pylist()
                scores = _scores(texts, known)
                top = scores.max(axis=1)
                found.append(names[scores.argmax(axis=1)])
                tops.append(top)
                wholes.append(top + np.log(np.exp(scores - top[:, None]).sum(axis=1)))
                blanks += [not (t and any(map(str.isalpha, t))) for t in texts]
            blank = np.array(blanks, bool)
            return [pa.array(np.concatenate(x), kind, mask=blank)
                    for x, kind in ((found, pa.string()), (tops, pa.float64()), (wholes, pa.float64()))]

        return each

    return map_batches(docs, work, "name string, top double, whole double", keep)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with ``lang_pred`` and ``score``, the posterior of that language.

    Only the text is read. Null texts and texts without a letter get ``und`` with score 0, and so does every text if
    there was nothing to learn from. Among languages with equal scores the first by name is taken. Very long texts are
    counted in overlapping pieces. Repeated rows come out repeated; an empty table stays empty. Each block of languages of
    the model is a pass over the texts; of several, which need the texts written once, the best and the sums are put
    together by row.
    """
    kept = [quoted(c) for c in (docs.columns if keep is None else keep)]
    rows = docs.select(F.struct(*kept).alias("kept"), quoted(text).alias("text"))
    if not model.languages:
        return rows.select("kept.*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if len(model.languages) <= model.at_once:
        found = _best(rows, next(model.blocks()), "text", ["kept"]).withColumn("sum", F.exp(F.col("whole") - F.col("top")))
    else:
        rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "language-rows")
        parts = None
        for number, block in enumerate(model.blocks()):
            part = _best(rows.select("row", "text"), block, "text", ["row"]).withColumn("first", F.lit(-number))
            parts = part if parts is None else parts.unionByName(part)
        # Each row has one entry a block, so the lists are as long as there are blocks.
        merged = parts.groupBy("row").agg(F.max(F.struct("top", "first", "name")).alias("best"), F.collect_list("whole").alias("wholes"))
        whole = F.aggregate("wholes", F.lit(0.0), lambda total, one: total + F.exp(one - F.col("best.top")))
        found = rows.select("row", "kept").join(merged, "row").select("kept", "best.name", "best.top", whole.alias("sum"))
    return found.select("kept.*", F.coalesce("name", F.lit(UNKNOWN)).alias("lang_pred"),
                        F.coalesce(F.when(F.col("name").isNotNull(), 1 / F.col("sum")), F.lit(0.0)).alias("score"))


def identify(docs: DataFrame, grams: Grams = Grams(), doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learn from the rows whose crc32 of the id, modulo 4, is not 2.

    A null id is in no fold: it is predicted, not learnt from, and ``held_out`` is false.
    """
    model = fit(docs.where(remainder(doc_id, 4) != 2), grams)
    own = docs.select(F.col(doc_id).alias("doc_id"), "text",
                      F.coalesce(remainder(doc_id, 4) == 2, F.lit(False)).alias("held_out"))
    return predict(own, model, keep=["doc_id", "held_out"])
