"""Quality classifier by co-training on two views of a document.

The text view sees words and word shapes, the metadata view everything else: source, language and length. Each is a naive
Bayes classifier, so one pass that adds up bounded tables trains both. Labelled documents start them; then, round by
round, each view labels the unlabelled documents that it is sure of and the other view learns from those. A fold of
labelled documents that no training sees calibrates each view, and the calibrated views are combined to score all documents.
"""

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import BLOCK_BYTES, byte_texts, map_batches, quoted, remainder, word_blocks
from wordloom.sources.workspace import staged

_WORDS_KEPT = 200_000


@dataclass(frozen=True)
class Spec:
    """``text_buckets`` and ``meta_buckets`` are the hashed features of the views.

    A view labels a document for the other one from a calibrated probability of ``sure`` (or 1 - ``sure``) on.
    Pseudo-labelled documents of a class count together at most ``pseudo_share`` times the labelled ones.
    """

    text_buckets: int = 1 << 13
    meta_buckets: int = 1 << 10
    rounds: int = 3
    sure: float = 0.98
    pseudo_share: float = 1.0
    smoothing: float = 1.0
    calibration_folds: int = 5


# --- views


_KINDS = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_SAME = re.compile(rb"(.)\1+", re.S)


def _shape(word: bytes) -> bytes:
    """Runs of upper, lower, digit and other characters of the whole word; marks stand for themselves."""
    return _SAME.sub(rb"\1", word.translate(_KINDS))


class _Places(dict):
    """Words by number; a new word gets the next number and its two buckets. Holds a bounded number of words."""

    def __init__(self, half: int):
        self.half = half
        self.buckets = np.zeros((2, _WORDS_KEPT + BLOCK_BYTES), np.int32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.buckets[:, number] = zlib.crc32(word.lower()) % self.half, self.half + zlib.crc32(_shape(word)) % (self.half - 4)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _WORDS_KEPT:
            self.clear()
        return self.buckets[:, np.fromiter(map(self.__getitem__, words), np.int64, len(words))].reshape(-1)


class TextView:
    """Hashed words and word shapes of a text; words that repeat the one before, lines that repeat an earlier one."""

    def __init__(self, spec: Spec):
        self.size, self.places = spec.text_buckets, _Places(spec.text_buckets // 2)

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """``(bucket, n)``; empty for texts without words."""
        sums, again, count = np.zeros(self.size, np.int64), 0, 0
        for words in word_blocks(text):
            sums += np.bincount(self.places.of(words), minlength=self.size)
            again += sum(map(eq, words, words[1:]))
            count += len(words)
        if not count:
            return np.zeros(0, np.uint16), np.zeros(0, np.uint32)
        lines = Counter(line for line in text.split(b"\n") if line and not line.isspace())
        repeats = sum(n - 1 for n in lines.values())
        # The last four buckets: words and lines that repeat and that do not, so that the shares are features too.
        sums[-4:] = again, count - again, repeats, sum(lines.values()) - repeats
        buckets = np.flatnonzero(sums)
        return buckets.astype(np.uint16), sums[buckets].astype(np.uint32)


def meta_places(source: str | None, lang: str | None, n_chars: int | None, spec: Spec) -> list[int]:
    """One bucket each for the source, the language and the length in half octaves; null has its own bucket."""
    length = "null" if n_chars is None else str(int(2 * np.log2(max(n_chars, 0) + 1)))
    parts = (f"source {source}", f"lang {lang}", f"length {length}")
    return [zlib.crc32(p.encode()) % spec.meta_buckets for p in parts]


# --- models


@dataclass
class View:
    """``counts[y]``: summed features of documents of class y. ``weights`` are the log odds of good by feature."""

    counts: np.ndarray
    smoothing: float
    weights: np.ndarray = field(init=False)

    def __post_init__(self):
        smooth = self.counts + self.smoothing
        logs = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
        self.weights = logs[1] - logs[0]


@dataclass
class Calibration:
    """Probability of good: sigmoid of ``slope * score + offset``."""

    slope: float = 0.0
    offset: float = 0.0

    def logit(self, scores: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * scores + self.offset, -30, 30)


def calibrate(scores: np.ndarray, good: np.ndarray, weights: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> Calibration:
    """Logistic regression of the label on one score by Newton steps, weakly held to zero slope."""
    if not weights.sum():
        return Calibration()
    x = np.stack([scores, np.ones(len(scores))], axis=1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (good - p)) - ridge * beta
        curvature = (x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return Calibration(*map(float, beta))


@dataclass
class Model:
    spec: Spec
    text: View
    meta: View
    text_calibration: Calibration
    meta_calibration: Calibration
    prior_logit: float

    def text_score(self, buckets: np.ndarray, n: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The mean log odds of each row's features; 0 for rows without any."""
        sums = _segment_sums(self.text.weights[buckets] * n, starts, stops)
        return sums / np.maximum(_segment_sums(n.astype(np.float64), starts, stops), 1)

    def meta_score(self, places: np.ndarray) -> np.ndarray:
        return self.meta.weights[places].sum(axis=1)

    def logits(self, batch: "Features") -> tuple[np.ndarray, np.ndarray]:
        text = self.text_calibration.logit(self.text_score(batch.buckets, batch.n, batch.starts, batch.stops))
        # A text without a word says nothing; its view falls back on the share of good documents.
        text = np.where(batch.stops > batch.starts, text, self.prior_logit)
        return text, self.meta_calibration.logit(self.meta_score(batch.places))

    def combined(self, batch: "Features") -> np.ndarray:
        text, meta = self.logits(batch)
        return 1 / (1 + np.exp(-np.clip(text + meta - self.prior_logit, -30, 30)))


def _segment_sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Sums of adjoining segments, each by itself, so that a row's score does not depend on the rows beside it."""
    out, filled = np.zeros(len(starts)), stops > starts
    if filled.any():
        out[filled] = np.add.reduceat(values, starts[filled])
    return out


@dataclass
class Features:
    buckets: np.ndarray
    n: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    places: np.ndarray


#: Sparse features as bytes: buckets are two-byte, numbers four-byte integers.
_FEATURES_DDL = "buckets binary, n binary, places array<int>"


def _bytes(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([a.nbytes for a in arrays]))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(arrays), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(arrays))])


def _features(batch: pa.RecordBatch, columns: list[int], view: TextView, spec: Spec) -> list[pa.Array]:
    text, source, lang, n_chars = (batch.column(c) for c in columns)
    buckets, n = zip(*map(view, byte_texts(text)))
    places = [meta_places(s, g, c, spec) for s, g, c in zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist())]
    return [_bytes(buckets), _bytes(n), pa.array(places, pa.list_(pa.int32()))]


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all rows of a binary column, one row after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].view(kind)


def _read(buckets: pa.Array, n: pa.Array, places: pa.Array) -> Features:
    sizes = pc.binary_length(buckets).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    stops = np.cumsum(sizes)
    return Features(_numbers(buckets, "<u2"), _numbers(n, "<u4"), stops - sizes, stops,
                    places.flatten().to_numpy().reshape(len(buckets), -1))


def _views(docs: DataFrame, keep: dict[str, str]) -> DataFrame:
    """The columns the views see, of the types they expect, and those of ``keep`` by their new names.

    A column that the table lacks is null. All names are new, so that columns of ``docs`` cannot clash with them.
    """
    kinds = {"text": "string", "source": "string", "lang": "string", "n_chars": "bigint"}
    return docs.select(*[(quoted(c) if c in docs.columns else F.lit(None)).cast(k).alias(f"_{c}") for c, k in kinds.items()],
                       *[quoted(c).alias(name) for name, c in keep.items()])


def featurised(docs: DataFrame, spec: Spec, keep: list[str]) -> DataFrame:
    columns = [docs.columns.index(c) for c in ("_text", "_source", "_lang", "_n_chars")]

    def work():
        view = TextView(spec)
        return lambda batch: _features(batch, columns, view, spec)

    return map_batches(docs, work, _FEATURES_DDL, keep)


# --- training


def _sums(features: DataFrame, model: Model | None, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Feature sums ``[weight kind, class, bucket]`` of both views, from one pass over all documents.

    Kind 0: labelled training documents, for both views. Kind 1: unlabelled documents that the *other* view is sure of.
    A text counts as one document whatever its length. The last bucket counts documents.
    """
    text_size, meta_size = spec.text_buckets + 1, spec.meta_buckets + 1
    cells = 4 * (text_size + meta_size)

    def run(batches):
        text, meta = np.zeros((4, text_size)), np.zeros((4, meta_size))
        for batch in batches:
            part = _read(*(batch.column(i) for i in (1, 2, 3)))
            label = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            if model is None:
                of_text = of_meta = np.full(len(label), -1)
            else:
                p_text, p_meta = (1 / (1 + np.exp(-x)) for x in model.logits(part))
                of_text, of_meta = (np.where(p >= spec.sure, 1, np.where(p <= 1 - spec.sure, 0, -1)) for p in (p_text, p_meta))
            # 0, 1: bad and good by label; 2, 3: bad and good by the other view; 4: neither, nor the calibration fold.
            for_text, for_meta = (
                np.where(label == 2, 4, np.where(label >= 0, label, np.where(other >= 0, other + 2, 4))) for other in (of_meta, of_text))
            share = part.n / np.maximum(np.repeat(_segment_sums(part.n.astype(np.float64), part.starts, part.stops), part.stops - part.starts), 1)
            owner = np.repeat(for_text, part.stops - part.starts)
            filled = part.stops > part.starts
            for kind in range(4):
                mine = owner == kind
                if mine.any():
                    text[kind, :-1] += np.bincount(part.buckets[mine], weights=share[mine], minlength=text_size - 1)
                text[kind, -1] += (filled & (for_text == kind)).sum()
                rows = for_meta == kind
                if rows.any():
                    meta[kind, :-1] += np.bincount(part.places[rows].reshape(-1), minlength=meta_size - 1)
                meta[kind, -1] += rows.sum()
        flat = np.concatenate([text.reshape(-1), meta.reshape(-1)])
        hit = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(flat[hit])], ["cell", "x"])

    summed = features.select("label", "buckets", "n", "places").mapInArrow(run, "cell bigint, x double")
    flat = np.zeros(cells)
    # Whole millionths add up alike in any order.
    for cell, x in summed.groupBy("cell").agg(F.sum(F.round(F.col("x") * 1e6).cast("bigint"))).collect():  # of fixed size
        flat[cell] = x / 1e6
    return flat[:4 * text_size].reshape(2, 2, -1), flat[4 * text_size:].reshape(2, 2, -1)


def _view(sums: np.ndarray, spec: Spec) -> View:
    """Labelled and pseudo-labelled documents together; the latter of a class count at most their share."""
    labelled, pseudo = sums[0], sums[1]
    most = spec.pseudo_share * labelled[:, -1:]
    scale = np.minimum(1.0, most / np.maximum(pseudo[:, -1:], 1))
    return View((labelled + scale * pseudo)[:, :-1], spec.smoothing)


_BINS = 400


def _calibrations(features: DataFrame, model: Model) -> tuple[Calibration, Calibration]:
    """Each view's calibration from the labelled fold that no training sees; its scores are counted in narrow bins."""

    def run(batches):
        sums: Counter = Counter()
        for batch in batches:
            part = _read(*(batch.column(i) for i in (1, 2, 3)))
            good = batch.column(0).to_numpy()
            scores = (model.text_score(part.buckets, part.n, part.starts, part.stops), model.meta_score(part.places))
            filled = (part.stops > part.starts, np.ones(len(good), bool))
            for view in (0, 1):
                bins = np.rint(np.clip(scores[view], -20, 20) * _BINS).astype(np.int64)
                sums.update(zip([view] * int(filled[view].sum()), bins[filled[view]].tolist(), good[filled[view]].tolist()))
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)),
                                          pa.array([sums[k] for k in keys], pa.int64())], ["view", "bin", "good", "n"])

    held = features.where("label = 2").select("held", "buckets", "n", "places")
    rows = held.mapInArrow(run, "view bigint, bin bigint, good bigint, n bigint").groupBy("view", "bin", "good").agg(F.sum("n")).collect()
    out = []
    for view in (0, 1):
        own = np.array([r[1:] for r in rows if r[0] == view], np.float64).reshape(-1, 3)
        out.append(calibrate(own[:, 0] / _BINS, own[:, 1], own[:, 2]))
    return out[0], out[1]


def _with_labels(docs: DataFrame, labels: DataFrame, spec: Spec) -> DataFrame:
    """``label`` 0 bad, 1 good, 2 calibration fold (its label in ``held``), null unlabelled.

    Several labels of one id count as the majority, none in a tie.
    """
    share = F.avg("quality")
    once = labels.select(F.col("doc_id").alias("_keep_id"), "quality").where("_keep_id IS NOT NULL AND quality IS NOT NULL")
    once = once.groupBy("_keep_id").agg(F.when(share > 0.5, 1).when(share < 0.5, 0).alias("good"))
    # Written first, so that the join shuffles both sides itself and Spark can split a hot id. Labels grow with the
    # documents, so they are never broadcast.
    joined = docs.join(staged(once, "labels").hint("merge"), "_keep_id", "left")
    folded = remainder("_keep_id", spec.calibration_folds) == 0
    return joined.select(
        *docs.columns, F.when(F.col("good").isNotNull() & folded, 2).otherwise(F.col("good")).cast("int").alias("label"),
        F.col("good").cast("bigint").alias("held"))


def train(docs: DataFrame, labels: DataFrame, spec: Spec = Spec(), doc_id: str = "doc_id") -> tuple[Model, DataFrame]:
    """The model, and the features of all documents with their ids in ``_keep_id``: both views after ``spec.rounds`` rounds of exchanging labels over all documents.

    Without labelled documents of both classes nothing can be learnt: every document then gets the same score.
    """
    features = featurised(_views(docs, {"_keep_id": doc_id}), spec, ["_keep_id"])
    features = staged(_with_labels(features, labels, spec), "labelled-features")
    model = None
    for _ in range(spec.rounds + 1):
        text, meta = _sums(features, model, spec)
        known = text[0, :, -1] + 1e-9
        prior = float(np.log(meta[0, 1, -1] + 1) - np.log(meta[0, 0, -1] + 1))
        model = Model(spec, _view(text, spec), _view(meta, spec), Calibration(), Calibration(), prior)
        if known.min() < 1:
            model.text_calibration = model.meta_calibration = Calibration(0.0, prior)
            break
        model.text_calibration, model.meta_calibration = _calibrations(features, model)
    return model, features


def _scores(df: DataFrame, model: Model, read, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``p_text``, ``p_meta`` and ``score``; ``read`` makes a function from a batch to features."""
    shared = df.sparkSession.sparkContext.broadcast((model.text.weights, model.meta.weights))
    rest = (model.spec, model.text_calibration, model.meta_calibration, model.prior_logit)

    def work():
        (text, meta), (spec, of_text, of_meta, prior) = shared.value, rest
        known, features = Model(spec, _Weights(text), _Weights(meta), of_text, of_meta, prior), read()

        def each(batch):
            part = features(batch)
            p_text, p_meta = (1 / (1 + np.exp(-x)) for x in known.logits(part))
            return [pa.array(x) for x in (p_text, p_meta, known.combined(part))]

        return each

    return map_batches(df, work, "p_text double, p_meta double, score double", keep)


def scored_features(features: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Scores from features that are written already."""
    columns = [features.columns.index(c) for c in ("buckets", "n", "places")]

    def read():
        return lambda batch: _read(*(batch.column(c) for c in columns))

    return _scores(features, model, read, keep)


def scored(docs: DataFrame, model: Model, keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` (by new name) with the scores, straight from the texts."""
    own, spec = _views(docs, keep), model.spec
    columns = [own.columns.index(c) for c in ("_text", "_source", "_lang", "_n_chars")]

    def read():
        view = TextView(spec)
        return lambda batch: _read(*_features(batch, columns, view, spec))

    return _scores(own, model, read, list(keep))


@dataclass
class _Weights:
    weights: np.ndarray


def classify(docs: DataFrame, labels: DataFrame, spec: Spec = Spec(), threshold: float = 0.5, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, p_text, p_meta, score, kept)``, a row for each row of ``docs``.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad); documents without a label, or with a null id, are
    unlabelled. ``kept`` says whether ``score``, the probability of good, reaches ``threshold``. Null and empty texts are
    judged by their metadata, null metadata has its own features. An empty table gives an empty result.
    """
    model, features = train(docs, labels, spec, doc_id)
    return scored_features(features, model, ["_keep_id"]).select(
        F.col("_keep_id").alias("doc_id"), "p_text", "p_meta", "score", (F.col("score") >= threshold).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, spec: Spec = Spec(), threshold: float = 0.5, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, with their own columns, whatever those are called."""
    model, _ = train(docs, labels, spec, doc_id)
    kept = {f"_keep{i}": c for i, c in enumerate(docs.columns)}
    return scored(docs, model, kept).where(F.col("score") >= threshold).select(*kept).toDF(*docs.columns)
