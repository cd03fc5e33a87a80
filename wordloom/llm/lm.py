"""Language-model scoring with a class bigram model over Brown classes.

The exchange algorithm puts words into classes so that the class bigrams of the training texts gain likelihood. It starts
with a core: the most frequent words one by one, all others by their signature (ending, digits, other characters). Then
every word with enough occurrences is a unit of its own: a Spark table holds which classes stand around each, tasks score
the moves of its rows, and a round of moves stays only if the likelihood of the training texts has risen. Rarer and unseen
words go with their signature, so every word has a class. A word's probability is that of its class after the class before
it, times its own within its class by its exact count.

Counts come from all training texts: they grow with the input and stay in Spark. Words beyond the most frequent ones,
which are broadcast, get their counts by a join.
"""

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import byte_texts, map_batches, remainder, slices, word_blocks
from wordloom.sources.workspace import RoundTables, files_for, staged

_WORDS_AT_ONCE = 150_000


@dataclass(frozen=True)
class Spec:
    """``head`` most frequent words of up to ``longest`` bytes are broadcast with their counts.

    The core is the first ``single`` of them and ``signatures`` signatures; ``sweeps`` passes over it give the classes to
    start from. Words of ``least`` occurrences then move on their own, in up to ``rounds`` rounds, whatever the number of
    texts. Beyond the head they are known by their 64-bit hashes, of which ``block`` are broadcast at once: more take a pass
    over the texts a block. A unit of the core and a class a word, five bytes, are broadcast for all of them.
    ``delta`` is added to every word count, ``alpha`` class counts to the transitions from each class.
    """

    head: int = 200_000
    longest: int = 64
    single: int = 4096
    signatures: int = 4096
    classes: int = 64
    least: int = 20
    block: int = 1 << 23
    sweeps: int = 3
    rounds: int = 3
    delta: float = 0.1
    alpha: float = 20.0


# --- counting


def word_counts(texts: DataFrame, wanted: Column | None = None) -> DataFrame:
    """``(word, c)`` of the column ``text`` with A-Z lower-cased, for all words or those that ``wanted`` holds for.

    Tasks add up before they shuffle, in tables of bounded size.
    """

    def run(batches):
        counts: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                                              pa.array(counts.values(), pa.int64())], ["word", "c"])
            counts.clear()

        for batch in batches:
            for text in byte_texts(batch.column(0)):
                for words in word_blocks(text.lower() if text else text):
                    counts.update(words)
                if len(counts) > _WORDS_AT_ONCE:
                    yield from out()
        yield from out()

    counts = texts.select("text").mapInArrow(run, "word string, c bigint")
    return (counts if wanted is None else counts.where(wanted)).groupBy("word").agg(F.sum("c").alias("c"))


def head_words(vocabulary: DataFrame, spec: Spec) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words of bounded length and their counts: at most ``spec.head``, by falling count.

    All words from some count on. It is found on a histogram of the counts' logarithms, a few hundred rows, so the
    vocabulary is neither sorted nor gathered.
    """
    short = vocabulary.where(F.octet_length("word") <= spec.longest).withColumn("step", F.floor(8 * F.log2("c")))
    room, lowest = spec.head, None
    for step, n in sorted(short.groupBy("step").count().collect(), reverse=True):
        if n > room:
            break
        room, lowest = room - n, step
    rows = [] if lowest is None else short.where(F.col("step") >= lowest).select("word", "c").collect()
    rows.sort(key=lambda r: (-r.c, r.word))
    return [r.word.encode() for r in rows], np.array([r.c for r in rows], np.float64)


def signature(word: bytes, spec: Spec) -> int:
    """The group in which a word without a place of its own is exchanged: by its ending and the kinds of its characters."""
    kinds = (not word.isascii()) + 2 * (not word.isalpha()) + 4 * any(48 <= b <= 57 for b in word) + 8 * min(len(word) // 6, 3)
    return zlib.crc32(bytes([kinds]) + word[-3:]) % spec.signatures


class Numbers:
    """Words as numbers: frequent words by their place, others by that of their hash in ``own`` or else by their signature.

    ``own`` are all hashes or a block of them, of which the first has the place ``start``.
    """

    def __init__(self, words: list[bytes], own: np.ndarray, spec: Spec, start: int = 0):
        self.spec, self.own, self.start, self.places, self.rare = spec, own, start, {w: i for i, w in enumerate(words)}, {}

    def of_text(self, text: bytes | None) -> tuple[np.ndarray, Counter]:
        parts, rest = [np.zeros(0, np.int32)], Counter()
        for words in word_blocks(text.lower() if text else text):
            numbers = np.fromiter(map(self.places.get, words, [-1] * len(words)), np.int32, len(words))
            others = np.flatnonzero(numbers < 0)
            if len(others):
                own = [words[i] for i in others.tolist()]
                numbers[others] = self.rare_numbers(own)
                rest.update(own)
            parts.append(numbers)
        return np.concatenate(parts), rest

    def rare_numbers(self, words: list[bytes]) -> list[int]:
        if len(self.rare) > _WORDS_AT_ONCE:
            self.rare.clear()
        new = list({w for w in words if w not in self.rare})
        hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in new], np.uint64)
        at = np.minimum(np.searchsorted(self.own, hashes), max(len(self.own) - 1, 0))
        known = self.own[at] == hashes if len(self.own) else np.zeros(len(new), bool)
        first = self.spec.head + self.spec.signatures + self.start
        self.rare.update((w, first + i if k else self.spec.head + signature(w, self.spec))
                         for w, i, k in zip(new, at.tolist(), known.tolist()))
        return [self.rare[w] for w in words]


def hash_blocks(own: np.ndarray, spec: Spec) -> list[tuple[int, np.ndarray]]:
    """``(place of the first, hashes)`` of each block; without hashes there is one empty block."""
    return [(start, own[start:start + spec.block]) for start in range(0, max(len(own), 1), spec.block)]


def numbered_texts(docs: DataFrame, head: list[bytes], own: np.ndarray, spec: Spec, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with ``ids``, a number for each word, and ``rest``, the words outside ``head`` with counts.

    One pass a block of ``own``. A word that is in no block so far has the number of its signature, which is below those of
    all hashes, so the larger number of two passes is right.
    """
    *blocks, last = hash_blocks(own, spec)
    texts = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    for start, hashes in blocks:
        ids = _numbering(texts, head, hashes, spec, start, "_ids array<int>", [c for c in texts.columns if c != "_ids"])
        texts = staged(ids, "numbered-block")
    return _numbering(texts, head, last[1], spec, last[0], "ids array<int>, rest array<struct<word:string,n:bigint>>", keep)


def _numbering(docs: DataFrame, head: list[bytes], hashes: np.ndarray, spec: Spec, start: int, fields: str, keep: list[str]) -> DataFrame:
    """One pass of :func:`numbered_texts`; ``_ids`` are the numbers of the passes before."""
    place, before = docs.columns.index("text"), docs.columns.index("_ids") if "_ids" in docs.columns else None
    shared = docs.sparkSession.sparkContext.broadcast((head, hashes))

    def work():
        numbers = Numbers(*shared.value, spec, start)

        def each(batch):
            ids, rest = zip(*map(numbers.of_text, byte_texts(batch.column(place))))
            if before is not None:
                found = np.maximum(np.concatenate(ids), batch.column(before).flatten().to_numpy())
                ids = np.split(found, np.cumsum([len(i) for i in ids])[:-1])
            if "rest" not in fields:
                return [_lists(ids, pa.int32())]
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in rest]))).astype(np.int32)
            words = pa.array([w for r in rest for w in r], pa.binary()).cast(pa.string())
            counts = pa.array([n for r in rest for n in r.values()], pa.int64())
            pairs = pa.StructArray.from_arrays([words, counts], ["word", "n"])
            return [_lists(ids, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pairs)]

        return each

    return map_batches(docs, work, fields, keep)


def _lists(arrays, kind) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), kind))


def own_words(vocabulary: DataFrame, counts: np.ndarray, least: int, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, signatures)`` of the words outside the head that occur ``least`` times, by rising hash.

    ``counts`` are those of the head, which holds all shorter words from its lowest count on. Two words of one hash would
    move as one; counts go by words, so these stay exact.
    """
    in_head = (F.octet_length("word") <= spec.longest) & (F.col("c") >= int(counts.min())) if len(counts) else F.lit(False)
    others = vocabulary.where((F.col("c") >= least) & ~in_head).select("word", F.xxhash64("word").alias("hash"))

    def work():
        return lambda batch: [pa.array([signature(w, spec) for w in byte_texts(batch.column(0))], pa.int32())]

    pairs = map_batches(others, work, "signature int", ["hash"]).toArrow()
    hashes, first = np.unique(pairs["hash"].to_numpy().astype(np.int64).view(np.uint64), return_index=True)
    return hashes, pairs["signature"].to_numpy()[first].astype(np.int32)


# --- exchange of the core


def _with_ends(batch: pa.Array, end: int) -> np.ndarray:
    """The numbers of all texts of a batch in a row, each text followed by ``end``."""
    lengths = np.diff(batch.offsets.to_numpy())
    values = batch.flatten().to_numpy()
    out = np.full(len(values) + len(lengths), end, np.int64)
    out[np.arange(len(values)) + np.repeat(np.arange(len(lengths)), lengths)] = values
    return out


_CELLS_A_ROW = 1 << 12


def context_counts(training: DataFrame, unit_of: np.ndarray, class_of: np.ndarray, classes: int) -> np.ndarray:
    """``[unit, side, class]``: how often a class stands before (0) and after (1) a unit, over all training texts.

    The end of a text is the last unit, in a class of its own; a text begins after one. Each task adds up one table, whose
    size does not depend on the input, and sends its non-zero cells; Spark adds those up.
    """
    units, end = len(class_of), len(unit_of) - 1
    shape = (units, 2, classes)
    shared = training.sparkSession.sparkContext.broadcast((unit_of, class_of))

    def run(batches):
        unit_of, class_of = shared.value
        sums = np.zeros(units * 2 * classes, np.int64)
        for batch in (part for whole in batches for part in slices(whole, 1024)):
            row = unit_of[_with_ends(batch.column(0), end)]
            if not len(row):
                continue
            before = np.concatenate(([units - 1], row[:-1]))
            for start in range(0, len(row), 1 << 20):
                u, v = before[start:start + (1 << 20)], row[start:start + (1 << 20)]
                sums += np.bincount((v * 2) * classes + class_of[u], minlength=len(sums))
                sums += np.bincount((u * 2 + 1) * classes + class_of[v], minlength=len(sums))
        for start in range(0, len(sums), _CELLS_A_ROW):
            part = sums[start:start + _CELLS_A_ROW]
            cells = np.flatnonzero(part)
            if len(cells):
                yield pa.RecordBatch.from_arrays([pa.array([start // _CELLS_A_ROW]), pa.array([cells.astype("<u2").tobytes()]),
                                                  pa.array([part[cells].astype("<i8").tobytes()])], ["part", "cells", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells, n in zip(*(column.to_pylist() for column in batch.columns)):
                own = sums.setdefault(part, np.zeros(_CELLS_A_ROW, np.int64))
                own[np.frombuffer(cells, "<u2")] += np.frombuffer(n, "<i8")
        for part, own in sums.items():
            cells = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([cells.astype("<u2").tobytes()]),
                                              pa.array([own[cells].astype("<i8").tobytes()])], ["part", "cells", "n"])

    ddl = "part bigint, cells binary, n binary"
    summed = training.select("ids").mapInArrow(run, ddl).repartition("part").mapInArrow(add, ddl)
    counts = np.zeros(units * 2 * classes, np.int64)
    for part, cells, n in summed.collect():  # one table of fixed size
        counts[part * _CELLS_A_ROW + np.frombuffer(cells, "<u2").astype(np.int64)] = np.frombuffer(n, "<i8")
    return counts.reshape(shape)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def class_bigrams(counts: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """``[before, class]`` from the classes before each unit."""
    bigrams = np.zeros((counts.shape[2], counts.shape[2]))
    np.add.at(bigrams.T, class_of, counts[:, 0, :].astype(np.float64))
    return bigrams


def likelihood(bigrams: np.ndarray) -> float:
    """The part of the training likelihood that depends on the classes."""
    return float(_xlogx(bigrams).sum() - _xlogx(bigrams.sum(axis=0)).sum() - _xlogx(bigrams.sum(axis=1)).sum())


def exchange(counts: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """One sweep over the units by falling frequency: each moves to the class with the highest gain in likelihood.

    The class bigrams follow every move; the classes around a unit are those at the start of the sweep.
    """
    class_of, bigrams = class_of.copy(), class_bigrams(counts, class_of)
    left, right = counts[:, 0, :].astype(np.float64), counts[:, 1, :].astype(np.float64)
    total, last = left.sum(axis=1), counts.shape[2] - 1
    for unit in np.argsort(-total, kind="stable"):
        if unit == len(class_of) - 1 or not total[unit]:
            continue
        own, before, after, n = class_of[unit], left[unit], right[unit], total[unit]
        bigrams[:, own] -= before
        bigrams[own, :] -= after
        # Where a unit stands beside its own class, a cell loses both sides; what was taken twice is put back as zero.
        np.maximum(bigrams, 0, out=bigrams)
        rows, columns, now = bigrams.sum(axis=1), bigrams.sum(axis=0), _xlogx(bigrams)
        gain = ((_xlogx(bigrams + after) - now).sum(axis=1) + (_xlogx(bigrams + before[:, None]) - now).sum(axis=0)
                - (_xlogx(rows + n) - _xlogx(rows)) - (_xlogx(columns + n) - _xlogx(columns)))
        gain[last] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= gain[own]:
            best = int(own)
        class_of[unit] = best
        bigrams[:, best] += before
        bigrams[best, :] += after
    return class_of


# --- exchange of all words with enough occurrences

_UNITS_A_ROW = 64
_DENSE_UNITS = 4096
_KEYS_AT_ONCE = 1 << 20
_CONTEXT_DDL = "part int, cells binary, n binary"


class _Cells:
    """Counts by key: the lowest keys in an array, the others as sorted keys, of which a bounded number is held."""

    def __init__(self, dense: int):
        self.dense, self.keys, self.n = np.zeros(dense, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> None:
        low = keys < len(self.dense)
        self.dense += np.bincount(keys[low], minlength=len(self.dense))
        self.waiting.append(keys[~low])

    def held(self) -> int:
        """How many rare keys are held, after those that came in have been counted if they are many."""
        if sum(map(len, self.waiting)) > _KEYS_AT_ONCE:
            self._count()
        return len(self.keys)

    def _count(self) -> None:
        keys, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        self.keys, inverse = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        sums = np.zeros(len(self.keys), np.int64)
        np.add.at(sums, inverse, np.concatenate([self.n, n]))
        self.n, self.waiting = sums, []

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys in order and their counts; nothing is held afterwards."""
        self._count()
        low = np.flatnonzero(self.dense)
        keys, n = np.concatenate([low, self.keys]), np.concatenate([self.dense[low], self.n])
        self.dense[:] = 0
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return keys, n


def _packed(keys: np.ndarray, n: np.ndarray, cells_a_row: int):
    """Batches of rows ``(part, cells, n)``; ``keys`` are in order."""
    parts = keys // cells_a_row
    starts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(parts) else np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(parts))
    cells = (keys - parts * cells_a_row).astype("<u2")
    n = n.astype("<i8")
    for at in range(0, len(starts), 1024):
        some = list(zip(starts[at:at + 1024].tolist(), stops[at:at + 1024].tolist()))
        yield pa.RecordBatch.from_arrays([
            pa.array(parts[starts[at:at + 1024]], pa.int32()), pa.array([cells[a:b].tobytes() for a, b in some], pa.binary()),
            pa.array([n[a:b].tobytes() for a, b in some], pa.binary())], ["part", "cells", "n"])


def _unpacked(batches):
    """``(part, cells, n)`` of each row."""
    for batch in batches:
        for part, cells, n in zip(*(column.to_pylist() for column in batch.columns)):
            yield part, np.frombuffer(cells, "<u2").astype(np.int64), np.frombuffer(n, "<i8")


def unit_contexts(training: DataFrame, merged: np.ndarray, class_of: np.ndarray, classes: int) -> DataFrame:
    """``(part, cells, n)``: for each number, how often each class stands before and after it in the training texts.

    A row holds the non-zero cells of 64 numbers, ``[number, side, class]`` counted through. The first numbers stand for
    those in ``merged``; the last is the end of a text. Tasks add up before they shuffle and hold a bounded number of cells.
    """
    if 2 * classes * _UNITS_A_ROW > 1 << 16:
        raise ValueError("too many classes for two bytes a cell")
    end, cells_a_row = len(class_of) - 1, 2 * classes * _UNITS_A_ROW
    shared = training.sparkSession.sparkContext.broadcast((merged, class_of))

    def run(batches):
        merged, class_of = shared.value
        counts = _Cells(_DENSE_UNITS * 2 * classes)
        for batch in (part for whole in batches for part in slices(whole, 1024)):
            row = _with_ends(batch.column(0), end)
            head = np.flatnonzero(row < len(merged))
            row[head] = merged[row[head]]
            before = np.concatenate(([end], row[:-1]))
            for start in range(0, len(row), 1 << 18):
                u, v = before[start:start + (1 << 18)], row[start:start + (1 << 18)]
                counts.add(v * (2 * classes) + class_of[u])
                counts.add(u * (2 * classes) + classes + class_of[v])
                if counts.held() > _KEYS_AT_ONCE:
                    yield from _packed(*counts.taken(), cells_a_row)
        yield from _packed(*counts.taken(), cells_a_row)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        last = None
        for part, cells, n in _unpacked(batches):
            if part != last and last is not None:
                yield from _packed(*_nonzero(last, sums.pop(last), cells_a_row), cells_a_row)
            last = part
            np.add.at(sums.setdefault(part, np.zeros(cells_a_row, np.int64)), cells, n)
        if last is not None:
            yield from _packed(*_nonzero(last, sums.pop(last), cells_a_row), cells_a_row)

    sent = training.select("ids").mapInArrow(run, _CONTEXT_DDL)
    return sent.repartition("part").sortWithinPartitions("part").mapInArrow(add, _CONTEXT_DDL)


def _nonzero(part: int, sums: np.ndarray, cells_a_row: int) -> tuple[np.ndarray, np.ndarray]:
    cells = np.flatnonzero(sums)
    return part * cells_a_row + cells, sums[cells]


def summed_bigrams(contexts: DataFrame, class_of: np.ndarray, classes: int) -> np.ndarray:
    """``[before, class]`` over all rows of :func:`unit_contexts`, for the classes that these were counted with."""
    shared = contexts.sparkSession.sparkContext.broadcast(class_of)

    def run(batches):
        sums = np.zeros(classes * classes, np.int64)
        for part, cells, n in _unpacked(batches):
            side = (cells // classes) % 2 == 0
            own = shared.value[part * _UNITS_A_ROW + cells[side] // (2 * classes)].astype(np.int64)
            np.add.at(sums, (cells[side] % classes) * classes + own, n[side])
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(sums[hit])], ["cell", "n"])

    out = np.zeros(classes * classes)
    for cell, n in contexts.mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    return out.reshape(classes, classes)


def best_classes(unit: np.ndarray, side: np.ndarray, other: np.ndarray, n: np.ndarray, own: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The class of each of ``len(own)`` units that gains most likelihood, by its cells in order of units.

    Gains are those against ``bigrams``: what a unit takes away from its own class, or brings to another one.
    """
    classes = len(bigrams)
    here = np.arange(classes)[None, :] == own[unit][:, None]
    table = np.where((side == 0)[:, None], bigrams[other], bigrams.T[other])
    less = np.where(here, np.maximum(table - n[:, None], 0), table)
    gain = _xlogx(less + n[:, None]) - _xlogx(less)
    starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    sums = np.zeros((len(own), classes))
    sums[unit[starts]] = np.add.reduceat(gain, starts, axis=0)
    at_home = np.arange(classes)[None, :] == own[:, None]
    for k, totals in ((0, bigrams.sum(axis=0)), (1, bigrams.sum(axis=1))):
        mine = np.bincount(unit[side == k], weights=n[side == k], minlength=len(own))[:, None]
        less = np.where(at_home, np.maximum(totals[None, :] - mine, 0), totals[None, :])
        sums -= _xlogx(less + mine) - _xlogx(less)
    sums[:, -1] = -np.inf
    best = sums.argmax(axis=1)
    stay = sums[np.arange(len(own)), np.minimum(own, classes - 2)] >= sums[np.arange(len(own)), best]
    return np.where(stay | (own == classes - 1), own, best)


def moved(contexts: DataFrame, class_of: np.ndarray, bigrams: np.ndarray, turn: int) -> np.ndarray:
    """The classes after the moves of one half of the numbers, by hash; the halves take turns, so that neighbours seldom
    leave for each other's classes at once. Moves do not depend on how the rows lie in tasks."""
    classes = len(bigrams)
    shared = contexts.sparkSession.sparkContext.broadcast((class_of, bigrams))

    def run(batches):
        class_of, bigrams = shared.value
        for part, cells, n in _unpacked(batches):
            first = part * _UNITS_A_ROW
            own = class_of[first:first + _UNITS_A_ROW].astype(np.int64)
            best = best_classes(cells // (2 * classes), (cells // classes) % 2, cells % classes, n.astype(np.float64), own, bigrams)
            mixed = (np.arange(first, first + len(own)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            best = np.where((mixed + np.uint64(turn)) % np.uint64(2) == 0, best, own)
            if (best != own).any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([best.astype(np.uint8).tobytes()])], ["part", "own"])

    out = class_of.copy()
    for part, own in contexts.mapInArrow(run, "part int, own binary").toLocalIterator():
        out[part * _UNITS_A_ROW:part * _UNITS_A_ROW + len(own)] = np.frombuffer(own, np.uint8)
    return out


def exchanged(training: DataFrame, merged: np.ndarray, class_of: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all numbers and their bigrams after rounds of moves; the last round that lost likelihood is undone.

    It ends after ``spec.rounds`` rounds, or when a round gains under a ten-thousandth.
    """
    tables = RoundTables(training.sparkSession, files_for(len(class_of)))
    best = None
    for turn in range(spec.rounds + 1):
        contexts = tables(unit_contexts(training, merged, class_of, spec.classes + 1), "contexts")
        bigrams = summed_bigrams(contexts, class_of, spec.classes + 1)
        gain = likelihood(bigrams)
        if best is not None and gain <= best[0]:
            break
        settled = best is not None and gain - best[0] < 1e-4 * abs(best[0])
        best = gain, class_of, bigrams
        if settled or turn == spec.rounds:
            break
        class_of = moved(contexts, class_of, bigrams, turn)
        class_of[:len(merged)] = class_of[merged]
    tables.finish()
    return best[1], best[2]


# --- model


@dataclass
class Model:
    spec: Spec
    head: list[bytes]
    head_counts: np.ndarray
    end_count: int
    tokens: int
    kinds: int
    class_of: np.ndarray
    transitions: np.ndarray
    class_tokens: np.ndarray
    class_kinds: np.ndarray

    @property
    def base_denominator(self) -> float:
        return self.tokens + 0.1 * (self.kinds + 1)


def _class_kinds(vocabulary: DataFrame, head: list[bytes], own: np.ndarray, spec: Spec, class_of: np.ndarray) -> np.ndarray:
    """``[class, (words, tokens)]`` over the whole vocabulary, in one pass a block of ``own``: over the words from its first
    hash to the next block's."""
    blocks = hash_blocks(own, spec)
    # Hashes rise as unsigned numbers; with the highest bit turned, signed ones have that order.
    place = F.xxhash64("word").bitwiseXOR(F.lit(-(1 << 63)))
    bounds = [int(hashes[0]) - (1 << 63) for _, hashes in blocks[1:]]
    out = np.zeros((int(class_of.max()) + 1, 2), np.int64)
    for i, (start, hashes) in enumerate(blocks):
        rows = vocabulary.select("word", "c")
        if i > 0:
            rows = rows.where(place >= bounds[i - 1])
        if i < len(bounds):
            rows = rows.where(place < bounds[i])
        out += _block_kinds(rows, head, hashes, spec, start, class_of)
    return out


def _block_kinds(vocabulary: DataFrame, head: list[bytes], hashes: np.ndarray, spec: Spec, start: int, class_of: np.ndarray) -> np.ndarray:
    shared = vocabulary.sparkSession.sparkContext.broadcast((head, hashes, class_of))
    classes = int(class_of.max()) + 1

    def run(batches):
        head, hashes, class_of = shared.value
        numbers, sums = Numbers(head, hashes, spec, start), np.zeros((classes, 2), np.int64)
        for batch in (part for whole in batches for part in slices(whole, 4096)):
            words = batch.column(0).cast(pa.binary()).to_pylist()
            places = np.fromiter((numbers.places.get(w, -1) for w in words), np.int64, len(words))
            others = np.flatnonzero(places < 0)
            places[others] = numbers.rare_numbers([words[i] for i in others.tolist()])
            k = class_of[places]
            np.add.at(sums[:, 0], k, 1)
            np.add.at(sums[:, 1], k, batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["k", "v", "n"])

    out = np.zeros((classes, 2), np.int64)
    rows = vocabulary.mapInArrow(run, "k bigint, v bigint, n bigint")
    for k, v, n in rows.groupBy("k").agg(F.sum("v"), F.sum("n")).collect():
        out[k] = v, n
    return out


def core_classes(training: DataFrame, words: list[bytes], signatures: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """``(merged, class_of)``: the numbers that the head's words would have by their signatures, and a class for each number."""
    single = min(spec.single, len(words))
    merged = np.full(spec.head, spec.head, np.int64)
    merged[:len(words)] = [spec.head + signature(w, spec) for w in words]
    unit_of = np.empty(spec.head + spec.signatures + len(signatures) + 1, np.int32)
    unit_of[:spec.head] = merged - spec.head + spec.single
    unit_of[:single] = np.arange(single)
    unit_of[spec.head:spec.head + spec.signatures] = spec.single + np.arange(spec.signatures)
    unit_of[spec.head + spec.signatures:-1] = spec.single + signatures
    unit_of[-1] = units = spec.single + spec.signatures
    class_of = (np.arange(units + 1) % spec.classes).astype(np.int32)
    class_of[-1] = spec.classes
    for _ in range(spec.sweeps):
        class_of = exchange(context_counts(training, unit_of, class_of, spec.classes + 1), class_of)
    return merged, class_of[unit_of].astype(np.uint8)


def train(training: DataFrame, vocabulary: DataFrame, words: list[bytes], counts: np.ndarray, own_hashes: np.ndarray,
          signatures: np.ndarray, texts: int, least: int, spec: Spec) -> Model:
    """``training`` has the numbered texts, ``texts`` of them; ``words`` are the frequent words in order, ``own_hashes`` and
    ``signatures`` those of :func:`own_words`."""
    kinds, tokens = vocabulary.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    merged, class_of = core_classes(training, words, signatures, spec)
    own = np.flatnonzero(counts >= least)
    merged[own] = own
    class_of[:spec.head] = class_of[merged]
    best, best_bigrams = exchanged(training, merged, class_of, spec)
    share = best_bigrams.sum(axis=0) + 1
    share = share / share.sum()
    transitions = (best_bigrams + spec.alpha * share) / (best_bigrams.sum(axis=1, keepdims=True) + spec.alpha)
    per_class = _class_kinds(vocabulary, words, own_hashes, spec, best)
    class_kinds, class_tokens = np.zeros(spec.classes), np.zeros(spec.classes)
    class_kinds[:len(per_class)], class_tokens[:len(per_class)] = per_class[:spec.classes, 0], per_class[:spec.classes, 1]
    return Model(spec, words, counts, texts, int(tokens) + texts, int(kinds) + bool(texts), best,
                 transitions, class_tokens, class_kinds)


def head_scores(numbered: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """What of each text's scores does not need the counts of words outside the head.

    ``n_tokens``; ``head_known`` and ``head_logs``, the number and summed log10(c + 0.1) of known tokens of the head, the
    end included; ``class_logs``, the log10 of the transitions over the emissions' denominators.
    """
    spec, end, rest = model.spec, len(model.class_of) - 1, len(model.head)
    # Numbers outside the head share a place of zeros; the last place is the end's.
    logs, known, emitted = np.zeros(rest + 2), np.zeros(rest + 2, np.int64), np.zeros(rest + 2)
    logs[:rest], logs[-1] = np.log10(model.head_counts + 0.1), np.log10(model.end_count + 0.1)
    known[:rest], known[-1] = 1, model.end_count > 0
    emitted[:rest] = np.log10(model.head_counts + spec.delta)
    denominators = np.append(np.log10(model.class_tokens + spec.delta * (model.class_kinds + 1)), 0.0)
    steps = np.log10(model.transitions) - denominators[None, :]
    place = numbered.columns.index("ids")
    shared = numbered.sparkSession.sparkContext.broadcast((logs, known, emitted, steps, model.class_of))

    def work():
        logs, known, emitted, steps, class_of = shared.value

        def each(batch):
            ids = batch.column(place)
            row = _with_ends(ids, end)
            own = class_of[row]
            before = np.concatenate((class_of[end:], own[:-1]))
            at = np.where(row == end, rest + 1, np.minimum(row, rest))
            starts = np.concatenate(([0], np.cumsum(np.diff(ids.offsets.to_numpy()) + 1)))[:-1]
            sums = [np.add.reduceat(values, starts) for values in (
                np.ones(len(row), np.int64), known[at], logs[at], emitted[at] + steps[before, own])]
            return [pa.array(s) for s in sums]

        return each

    return map_batches(numbered, work, "n_tokens bigint, head_known bigint, head_logs double, class_logs double", keep)


def score(docs: DataFrame, spec: Spec = Spec(), fold=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row for each row of ``docs``.

    Rows for which ``fold`` (a condition) holds are held out; the default is a crc32 of the id, modulo 10, of 0. Rows with
    a null id are neither held out nor learnt from. Null and empty texts have one token, the end. Repeated rows are
    learnt from as often as they come; without any row to learn from all counts are 0. ``base_score`` adds up log10 of
    (c + 0.1) / (N + 0.1 (V + 1)); ``score`` is the class model's log10 probability of the text.
    """
    fold = remainder("doc_id", 10) == 0 if fold is None else fold
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = own.withColumn("held_out", fold)
    vocabulary = staged(word_counts(own.where("NOT held_out")), "vocabulary")
    words, counts = head_words(vocabulary, spec)
    own_hashes, signatures = own_words(vocabulary, counts, spec.least, spec)
    # The row numbers are written with the rows, so they cannot shift when a task is repeated.
    numbered = staged(numbered_texts(own, words, own_hashes, spec, ["doc_id", "held_out"])
                      .withColumn("_row", F.monotonically_increasing_id()), "numbered-texts")
    training = numbered.where("NOT held_out")
    model = train(training, vocabulary, words, counts, own_hashes, signatures, training.count(), spec.least, spec)

    parts = head_scores(numbered.drop("rest"), model, ["_row", "doc_id", "held_out"])
    rest = numbered.select("_row", F.explode("rest").alias("r")).select("_row", "r.word", "r.n")
    counted = rest.join(vocabulary, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = staged(counted.groupBy("_row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("n") * F.log10(c + 0.1)).alias("rest_logs"),
        F.sum(F.col("n") * F.log10(c + spec.delta)).alias("rest_emitted")), "rare-sums")
    nothing = {"rest_known": 0, "rest_logs": 0.0, "rest_emitted": 0.0}
    return parts.join(sums, "_row", "left").fillna(nothing).select(
        "doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("head_known") + F.col("rest_known")).alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_logs") + F.col("rest_logs") - F.col("n_tokens") * float(np.log10(model.base_denominator))).alias("base_score"),
        (F.col("class_logs") + F.col("rest_emitted")).alias("score"))
