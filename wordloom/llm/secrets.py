"""Secret scans: patterns propose candidates, a random forest removes the false positives among them.

The forest sees a candidate's length, the transitions between kinds of characters, how much of it dictionary words cover,
the path it stands under and the words beside it. It is trained on labelled findings; some come from rules that are sure
on their own, others can be given as a table.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import forest, lm
from wordloom.llm.common import map_batches, quoted, texts
from wordloom.llm.lm import head_words, word_counts
from wordloom.sources.workspace import staged

# Possessive, and only from the start of a run: long runs cost their length once.
_RUN = re.compile(r"(?<![A-Za-z0-9_+/=.-])[A-Za-z0-9_+/=.-]{12,}+")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_REACH = 60

#: Values that tell by their form alone that they are secrets: fixed formats of public services.
_FORM = r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}+|xox[abp]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35})"
_FORMS = re.compile(_FORM + r"\Z")
_FORM_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){_FORM}(?![A-Za-z0-9])")
_KEY_NAME = r"(?:secret|token|passw(?:or)?d|api_?key|access_?key|auth|credential|private_?key)\w{0,20}[\"']?\s{0,3}"
_KEY = re.compile(_KEY_NAME + r"(?:=|:|=>)\s{0,3}[\"'`]?\Z", re.I)
_KEY_ASSIGNS = re.compile(_KEY_NAME + r"(?:=>|=|:)\s{0,3}([\"'`]?)", re.I)
_QUOTED = re.compile(r"[^\"'`\n]*+(?=[\"'`])")
_BARE = re.compile(r"[^\s\"'`,;]*+")
_HARMLESS_KEY = re.compile(r"(?:commit|sha1|sha256|md5|checksum|digest|hash|version|uuid|revision|example|sample|dummy)\W{0,6}\Z", re.I)
_PLACEHOLDER = re.compile(r"x{4,}|0{6,}|1234567|example|changeme|placeholder|your[_-]", re.I)
_ASSIGNED = re.compile(r"(?:=|:|=>)\s{0,3}[\"'`]?\Z")
_LAST_WORD = re.compile(r"([A-Za-z_][A-Za-z0-9_-]{0,40})[^A-Za-z0-9_]{0,8}\Z")

Candidate = tuple[int, int]


def candidates(text: str) -> Iterator[Candidate]:
    """``(start, end)`` of what could be a secret: runs of key characters that have a digit or both cases; key blocks.

    A trailing full stop stays outside, and ``name=value`` is cut behind its first ``=``.
    """
    for found in _RUN.finditer(text):
        start, end = found.span()
        while end > start and text[end - 1] in ".-/":
            end -= 1
        cut = text.find("=", start, end)
        if 0 < cut - start < 40 and end - cut > 12 and text[start].isalpha():
            start = cut + 1
        value = text[start:end]
        if end - start >= 12 and (any(c.isdigit() for c in value) or (value != value.lower() and value[1:] != value[1:].lower() and not value.isupper())):
            yield start, end
    at, closing = 0, 0
    while found := _BLOCK.search(text, at):
        closing = text.find("-----END", found.end()) if closing >= 0 else -1
        if closing >= 0:
            at = (text.find("-----", closing + 5) + 5) if text.find("-----", closing + 5) >= 0 else len(text)
        else:  # an open block ends where the next one begins; no closing mark can follow any more
            following = text.find("-----BEGIN ", found.end())
            at = following if following >= 0 else len(text)
        yield found.start(), at


def proposed(text: str) -> list[Candidate]:
    """All candidates by place: those of :func:`candidates`, values of a fixed form, and whatever a key name is assigned.

    An assigned value may have any length and case; it ends at its quote, or else before a blank, comma or semicolon.
    Candidates may overlap.
    """
    found = {*candidates(text), *(m.span() for m in _FORM_INSIDE.finditer(text))}
    at = 0
    while key := _KEY_ASSIGNS.search(text, at):
        start = key.end()
        value = (_QUOTED.match(text, start) if key[1] else None) or _BARE.match(text, start)
        end = at = value.end()
        while not key[1] and end > start and text[end - 1] in ".)]}>":
            end -= 1
        if end > start:
            found.add((start, end))
    return sorted(found)


def _kinds(value: str) -> np.ndarray:
    codes = np.frombuffer(value.encode("utf-32-le"), "<u4")
    return np.select([(codes >= 48) & (codes <= 57), (codes >= 97) & (codes <= 122), (codes >= 65) & (codes <= 90)], [0, 1, 2], 3)


def _entropy(value: str) -> float:
    _, n = np.unique(np.frombuffer(value.encode("utf-32-le"), "<u4"), return_counts=True)
    return float(-(n / n.sum() * np.log2(n / n.sum())).sum())


def coverage(value: str, dictionary: frozenset[str], shortest: int = 4, longest: int = 12) -> float:
    """The share of characters inside dictionary words, taken greedily from the left, the longest first."""
    lowered, at, inside = value.lower(), 0, 0
    while at < len(lowered):
        size = next((n for n in range(min(longest, len(lowered) - at), shortest - 1, -1) if lowered[at:at + n] in dictionary), 0)
        inside += size
        at += size or 1
    return inside / max(len(lowered), 1)


_HASHED = 8
FEATURES = 10 + 16 + 1 + 3 + 6 + 2 * _HASHED


def features(value: str, path: str, before: str, after: str, dictionary: frozenset[str]) -> np.ndarray:
    """Numbers that describe a candidate, whole values whatever their length: see the module."""
    out = np.zeros(FEATURES)
    kinds = _kinds(value)
    n = max(len(value), 1)
    shares = np.bincount(kinds, minlength=4) / n
    hexadecimal = sum(map(value.count, "0123456789abcdefABCDEF")) / n
    out[:10] = [np.log1p(len(value)), len(value) in (32, 40, 64), _entropy(value), hexadecimal, *shares,
                len(set(value)) / n, bool(_PLACEHOLDER.search(value))]
    steps = np.bincount(kinds[:-1] * 4 + kinds[1:], minlength=16)
    out[10:26] = steps / max(steps.sum(), 1)
    out[26] = coverage(value, dictionary)
    name = path.lower()
    out[27:30] = [zlib.crc32(name.encode()) % 64, name.count("/"), any(t in name for t in ("test", "example", "doc"))]
    word = _LAST_WORD.search(before)
    out[30:36] = [bool(_ASSIGNED.search(before)), before[-1:] in "\"'`" and bool(before), after[:1] in "\"'`" and bool(after),
                  bool(_KEY.search(before)), bool(_HARMLESS_KEY.search(before)), len(before.split()[-1]) if before.split() else 0]
    if word:
        out[36 + zlib.crc32(word[1].lower().encode()) % _HASHED] = 1
    following = after.split()
    if following:
        out[36 + _HASHED + zlib.crc32(following[0].lower().encode()) % _HASHED] = 1
    return out


def sure_label(value: str, before: str) -> int | None:
    """1 or 0 where a rule is sure by itself, else None: this makes labelled findings from raw text."""
    if value.startswith("-----BEGIN") or _FORMS.match(value):
        return 1
    if _PLACEHOLDER.search(value) or _HARMLESS_KEY.search(before) or not any(c.isalpha() for c in value):
        return 0
    mixed = len(value) >= 16 and _entropy(value) >= 3.0 and any(c.isdigit() for c in value)
    if _KEY.search(before) and mixed:
        return 1
    return 0 if not _ASSIGNED.search(before) and not mixed else None


def dictionary_words(docs: DataFrame, words: int = 20_000) -> frozenset[str]:
    """The most frequent words of 4 to 12 letters over all texts: at most ``words``."""
    # Read twice and never again: kept by the executors instead of written; lost parts are counted anew.
    counts = word_counts(docs, F.col("word").rlike(r"^\p{L}{4,12}$")).persist(StorageLevel.DISK_ONLY)
    found, _ = head_words(counts, lm.Spec(head=words))
    counts.unpersist()
    return frozenset(w.decode() for w in found)


def _row_findings(text: str | None) -> list[tuple[int, int, str, str, str]]:
    if not text:
        return []
    return [(a, b, text[a:b], text[max(0, a - _REACH):a], text[b:b + _REACH]) for a, b in proposed(text)]


def findings(docs: DataFrame) -> DataFrame:
    """``(value, path, before, after, label)`` of all candidates of ``text`` under ``path``; the label can be null."""
    ddl = "value string, path string, before string, after string, label int"

    def run(batches):
        for batch in batches:
            rows = [(v, p or "", before, after, sure_label(v, before))
                    for t, p in zip(texts(batch.column(0)), texts(batch.column(1))) for _, _, v, before, after in _row_findings(t)]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate([pa.string()] * 4 + [pa.int32()])]
            yield pa.RecordBatch.from_arrays(columns, ["value", "path", "before", "after", "label"])

    return docs.select("text", "path").mapInArrow(run, ddl)


class Scanner:
    """Scores candidates with a forest; what it removes is no secret."""

    def __init__(self, trees: forest.Forest, dictionary: frozenset[str], threshold: float):
        self.trees, self.dictionary, self.threshold = trees, dictionary, threshold

    def __call__(self, rows: list[str | None], paths: list[str | None]) -> list[list[tuple[int, int, float]]]:
        """``(start, end, probability)`` of every candidate of each text."""
        found = [_row_findings(t) for t in rows]
        x = [features(v, p or "", before, after, self.dictionary) for each, p in zip(found, paths) for _, _, v, before, after in each]
        scores = iter(self.trees.probability(np.array(x)) if x else ())
        return [[(a, b, float(next(scores))) for a, b, *_ in each] for each in found]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def train(docs: DataFrame, labelled: DataFrame | None = None, most_findings: int = 20_000,
          spec: forest.Spec = forest.Spec()) -> tuple[forest.Forest, frozenset[str]]:
    """A forest from labelled findings, and the dictionary it uses.

    ``labelled`` has the columns of :func:`findings`; by default those of ``docs`` that a rule is sure of. Equal findings
    count once. Up to ``most_findings`` of each class are learnt from, the first by their hash: the only sample taken.
    """
    dictionary = dictionary_words(docs)
    known = (findings(docs) if labelled is None else labelled).where("label IS NOT NULL").dropDuplicates(["value", "before", "after"])
    known = staged(known.withColumn("order", F.xxhash64("value", "before", "after")), "labelled-findings")
    words = docs.sparkSession.sparkContext.broadcast(dictionary)

    def described(batches):
        for batch in batches:
            columns = [[v or "" for v in texts(batch.column(i))] for i in range(4)]
            x = [features(*row, words.value).tolist() for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(4)], ["x", "label"])

    # Values can be long, what describes them is not: that is all the driver gets.
    chosen = [known.where(F.col("label") == label).orderBy("order").limit(most_findings) for label in (0, 1)]
    rows = [r for some in chosen for r in some.select("value", "path", "before", "after", "label").mapInArrow(
        described, "x array<double>, label int").collect()]
    words.unpersist()
    x = np.array([r.x for r in rows]).reshape(len(rows), FEATURES)
    return forest.fit(docs.sparkSession, x, np.array([r.label for r in rows], np.int64), spec), dictionary


def _prepared(docs: DataFrame, text: str, path: str, keep: dict[str, str]) -> DataFrame:
    where = quoted(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    return docs.select(quoted(text).alias("text"), where.alias("path"), *[quoted(c).alias(name) for name, c in keep.items()])


def scan(docs: DataFrame, threshold: float = 0.5, labelled: DataFrame | None = None, text: str = "text", path: str = "source",
         keep: dict[str, str] | None = None, spec: forest.Spec = forest.Spec()) -> DataFrame:
    """``keep`` columns (new name: name; by default all but the text) with ``candidates``, an array of
    ``struct<start, end, probability>``, and ``secrets``, those whose probability reaches ``threshold``.

    Positions are code points, the end exclusive; spans may overlap. Texts and values of any length count whole. Null and empty texts have empty arrays; a null path is an empty one.
    If no finding of one of the classes is known, nothing can be learnt and no candidate is removed. Repeated rows come out
    repeated, an empty table stays empty.
    """
    keep = {c: c for c in docs.columns if c != text} if keep is None else keep
    own = _prepared(docs, text, path, {f"_k{i}": c for i, c in enumerate(keep.values())})
    trees, dictionary = train(own.select("text", "path"), labelled, spec=spec)
    kept = [f"_k{i}" for i in range(len(keep))]
    shared = docs.sparkSession.sparkContext.broadcast((vars(trees), dictionary))
    floor = threshold if len(trees.roots) else 0.0

    def work():
        arrays, words = shared.value
        scanner = Scanner(forest.Forest(**arrays), words, floor)

        def each(batch):
            out = []
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out += scanner(part.column(0).to_pylist(), part.column(1).to_pylist())
            rows = [[{"start": a, "end": b, "probability": p} for a, b, p in r] for r in out]
            return [pa.array(rows, _SPANS)]

        return each

    found = map_batches(own, work, "candidates array<struct<start:bigint,end:bigint,probability:double>>", kept)
    return found.select(*[F.col(k).alias(name) for k, name in zip(kept, keep)], "candidates",
                        F.filter("candidates", lambda c: c["probability"] >= floor).alias("secrets"))


def redacted(docs: DataFrame, mark: str = "<SECRET>", threshold: float = 0.5, text: str = "text", path: str = "source",
             n_chars: str = "n_chars", labelled: DataFrame | None = None, spec: forest.Spec = forest.Spec()) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; all rows stay, and so do texts without secrets.

    ``n_chars``, if there is such a column, is the new length of a changed text.
    """
    names = {f"_k{i}": c for i, c in enumerate(docs.columns)}
    own = _prepared(docs, text, path, names)
    trees, dictionary = train(own.select("text", "path"), labelled, spec=spec)
    shared = docs.sparkSession.sparkContext.broadcast((vars(trees), dictionary))
    floor = threshold if len(trees.roots) else 0.0

    def work():
        arrays, words = shared.value
        scanner = Scanner(forest.Forest(**arrays), words, floor)

        def each(batch):
            out = []
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = part.column(0).to_pylist()
                for t, spans in zip(rows, scanner(rows, part.column(1).to_pylist())):
                    pieces, at = [], 0
                    for a, b, p in sorted(spans):
                        if p >= floor:
                            if a >= at:
                                pieces += [t[at:a], mark]
                            at = max(at, b)  # what overlaps shares a mark
                    out.append(None if t is None or not pieces else "".join([*pieces, t[at:]]))
            return [pa.array(out, pa.string())]

        return each

    found = map_batches(own, work, "_clean string", ["text", *names])
    kinds = dict(docs.dtypes)
    columns = []
    for k, c in names.items():
        if c == text:
            columns.append(F.coalesce("_clean", k).alias(c))
        elif c == n_chars:
            columns.append(F.when(F.col("_clean").isNotNull(), F.char_length("_clean").cast(kinds[c])).otherwise(F.col(k)).alias(c))
        else:
            columns.append(F.col(k).alias(c))
    return found.select(*columns)
