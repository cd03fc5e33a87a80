"""Byte-pair encoding and decoding with a given vocabulary file.

A partition merges all its new words together. An index maps each pair of neighbouring symbols to every place where it
occurs; the active pairs are taken by ascending rank, all places of a pair are merged, and only the lists of the pairs
beside them change. The cost follows the number of merges, not words times ranks.
"""

import heapq
import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from wordloom.llm.common import map_batches


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


_SYMBOL_BITS = 24


class Vocabulary:
    """A word-end BPE vocabulary: normalising steps, word pattern, special tokens, ranks of pairs and texts of ids.

    Only what such a file can hold is read: NFC, one replacement, lower case; a pattern whose matches are words, written
    as bytes; pairs by rank; special tokens found in the raw text. Anything else is refused, never passed over.
    """

    def __init__(self, text: str):
        spec = json.loads(text)
        steps = spec["normalizer"]["normalizers"]
        split, as_bytes = spec["pre_tokenizer"]["pretokenizers"]
        model = spec["model"]
        known = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"
            and as_bytes["type"] == "ByteLevel" and not as_bytes["add_prefix_space"] and not as_bytes["use_regex"]
            and model["type"] == "BPE" and spec["decoder"] is None
            and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
            and all(t["special"] and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
        )
        if not known:
            raise ValueError("a vocabulary of another kind: it takes steps that this reader does not have")
        self.pattern = split["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([ids.get(s, -1) for s in symbols], np.int32)
        self.final = np.array([ids.get(s + end, -1) for s in symbols], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: By rank: the two symbols of a pair and what they become.
        self.left, self.right = [ids[a] for a, _ in merges], [ids[b] for _, b in merges]
        self.merged = [ids[a + b] for a, b in merges]
        keys = np.array(self.left, np.int64) << _SYMBOL_BITS | np.array(self.right, np.int64)
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[self.by_key], -1)
        #: Ranks whose merge can bring up a pair of lower rank.
        first_use: dict[int, int] = {}
        for rank, pair in enumerate(zip(self.left, self.right)):
            for symbol in pair:
                first_use.setdefault(symbol, rank)
        self.early = {r for r, m in enumerate(self.merged) if first_use.get(m, r) < r}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for text, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = text


    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 if it never merges."""
        keys = left.astype(np.int64) << _SYMBOL_BITS | right
        at = np.searchsorted(self.keys[:-1], keys)
        return np.where(self.keys[at] == keys, self.by_key[np.minimum(at, len(self.by_key) - 1)], -1)


def _text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _leftmost(at: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """Of ordered places of a pair of equal symbols, every second one in each chain of overlapping places."""
    chained = np.concatenate(([False], follower[:-1] == at[1:]))
    starts = np.flatnonzero(~chained)
    return (np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))) % 2 == 0


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and how many each word has; all words are merged together over one index of pairs.

    All symbols lie in one row; ``after`` and ``before`` link the living symbols of a word, -1 at its ends. Where a merge
    can bring up a pair of lower rank, only the first place in each word is merged at a time, so that the lower rank has
    its turn before the next place, as it would if each word were merged alone.
    """
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    last = np.cumsum(sizes) - 1
    symbol = vocabulary.inner[data]
    symbol[last] = vocabulary.final[data[last]]
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    owner, symbol = owner[symbol >= 0], symbol[symbol >= 0]
    after, before = np.arange(1, len(symbol) + 1, dtype=np.int32), np.arange(-1, len(symbol) - 1, dtype=np.int32)
    border = np.flatnonzero(np.diff(owner, append=-1))
    after[border] = -1
    before[border[:-1] + 1] = -1
    before[:1] = -1

    first = np.flatnonzero(after >= 0)
    rank = vocabulary.ranks(symbol[first], symbol[first + 1])
    first, rank = first[rank >= 0], rank[rank >= 0]
    order = np.argsort(rank, kind="stable")
    first, rank = first[order], rank[order]
    cuts = np.flatnonzero(np.diff(rank, prepend=-1))
    listed = dict(zip(rank[cuts].tolist(), np.split(first, cuts[1:]) if len(cuts) else []))
    added: dict[int, list[int]] = defaultdict(list)
    active = list(listed)
    heapq.heapify(active)
    waiting = set(active)
    while active:
        now = heapq.heappop(active)
        waiting.discard(now)
        at = listed.pop(now, None)
        more = added.pop(now, None)
        if more:
            at = np.unique(np.array(more) if at is None else np.concatenate([at, more]))
        follower = after[at]
        same = (symbol[at] == vocabulary.left[now]) & (follower >= 0) & (symbol[follower] == vocabulary.right[now])
        at, follower = at[same], follower[same]
        if vocabulary.left[now] == vocabulary.right[now] and len(at) > 1:
            chosen = _leftmost(at, follower)
            at, follower = at[chosen], follower[chosen]
        if now in vocabulary.early and len(at) > 1:
            earliest = np.diff(owner[at], prepend=-1) > 0
            if not earliest.all():
                added[now] += at[~earliest].tolist()
                heapq.heappush(active, now)
                waiting.add(now)
                at, follower = at[earliest], follower[earliest]
        if not len(at):
            continue
        beyond = after[follower]
        symbol[at], symbol[follower], after[at] = vocabulary.merged[now], -1, beyond
        behind = beyond >= 0
        before[beyond[behind]] = at[behind]
        ahead = before[at]
        left = np.concatenate([at[behind], ahead[ahead >= 0]])
        if not len(left):
            continue
        found = vocabulary.ranks(symbol[left], symbol[after[left]])
        hit = found >= 0
        for place, new in zip(left[hit].tolist(), found[hit].tolist()):
            added[new].append(place)
            if new not in waiting:
                waiting.add(new)
                heapq.heappush(active, new)
    alive = symbol >= 0
    return symbol[alive], np.bincount(owner[alive], minlength=len(words))


_KEPT = 200_000
_CHARS_AT_ONCE = 2 << 20

#: White space to Python, but not to the patterns of vocabulary files.
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")


class Encoder:
    """Texts to ids; keeps the ids of chunks between white space already seen in this partition, up to a bound.

    No word holds white space, so a chunk's words do not depend on the chunks beside it, and it does not matter that
    the vocabulary has white space replaced by a space first.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words_or_breaks = regex.compile(f"{vocabulary.pattern}|\n")
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}  # of a chunk's ids in the arrays below
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def chunks(self, text: str) -> list[str]:
        """Normalised chunks between white space."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # character by character: a capital sigma at the end of a word becomes the plain one
                text = text.replace("Σ", "σ")
        text = text.lower()
        return regex.split(r"\s+", text) if _SEPARATORS.search(text) else text.split()

    def pieces(self, text: str | None) -> Iterator[tuple[int | None, list[str]]]:
        """Chunks between special tokens, each list followed by the special token's id."""
        text, start = text or "", 0
        if any(token in text for token in self.vocabulary.special):
            for found in self.special.finditer(text):
                yield self.vocabulary.special[found[0]], self.chunks(text[start:found.start()])
                start = found.end()
        yield None, self.chunks(text[start:])

    def learn(self, chunks: list[str]) -> None:
        """The ids of chunks not seen before: all their words are merged together."""
        numbers: dict[str, int] = {"\n": 0}
        found = self.words_or_breaks.findall("\n".join(chunks))
        which = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
        ids, sizes = merge_words([w.encode() for w in numbers][1:], self.vocabulary)
        sizes = np.concatenate(([0], sizes))
        own = sizes[which]
        chunk = np.cumsum(which == 0)
        counts = np.bincount(chunk, weights=own, minlength=len(chunks)).astype(np.int64)
        self.ids = np.concatenate([self.ids, ids[_spans((np.cumsum(sizes) - sizes)[which], own)]])
        self.sizes = np.concatenate([self.sizes, counts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places.update(zip(chunks, range(len(self.places), len(self.sizes))))

    def encode(self, rows: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after the other, and how many each row has."""
        cut = [list(self.pieces(text)) for text in rows]
        if len(self.places) > _KEPT:
            self._forget()
        new = set().union(*(chunks for pieces in cut for _, chunks in pieces)).difference(self.places)
        new.discard("")
        if new:
            self.learn(list(new))
        special = list(self.vocabulary.special.values())
        # Special tokens are chunks with places of their own, after those of the texts.
        store = np.concatenate([self.ids, np.array(special, np.int32)])
        starts = np.concatenate([self.starts, len(self.ids) + np.arange(len(special))])
        sizes = np.concatenate([self.sizes, np.ones(len(special), np.int64)])
        place = {i: len(self.sizes) + k for k, i in enumerate(special)}
        of, ids, counts = self.places.__getitem__, [], []
        for pieces in cut:
            which: list[int] = []
            for token, chunks in pieces:
                which.extend(map(of, filter(None, chunks)))
                if token is not None:
                    which.append(place[token])
            own = np.array(which, np.int64)
            ids.append(store[_spans(starts[own], sizes[own])])
            counts.append(len(ids[-1]))
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array(counts, np.int64)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _portions(values: pa.Array, chars: int = _CHARS_AT_ONCE) -> Iterator[pa.Array]:
    """Slices of a string array of about ``chars`` bytes each, at least one row."""
    ends = np.cumsum(pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(values):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + chars)))
        yield values.slice(start, stop - start)
        start = stop


def encode(df: DataFrame, vocabulary: str, text: str = "text", name: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``name``, array<int>: the ids of the whole text of each row.

    ``vocabulary`` is the path of a vocabulary file that the driver can read; its text, of fixed size, is broadcast. No special tokens are added; those that stand in the text are found. Null and empty texts and texts without
    a word have an empty list. Rows are independent: repeated rows come out repeated, an empty table stays empty.
    """
    place = df.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(_text(vocabulary))

    def work():
        encoder = Encoder(Vocabulary(shared.value))

        def each(batch):
            encoded = [encoder.encode(part.to_pylist()) for part in _portions(batch.column(place))]
            offsets = np.concatenate(([0], np.cumsum(np.concatenate([n for _, n in encoded])))).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([ids for ids, _ in encoded])))]

        return each

    return map_batches(df, work, f"`{name}` array<int>", keep, rows=None)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``name``: the tokens of the ids joined by a space, special tokens included.

    That is what a vocabulary file without a decoder says. A null or empty list gives an empty text; null ids and
    ids outside the vocabulary are left out.
    """
    place = df.columns.index(ids)
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(_text(vocabulary)).tokens)

    def work():
        tokens = np.array(shared.value, dtype=object)

        def each(batch):
            lists = batch.column(place)
            out = []
            for row in range(len(lists)):
                numbers = lists[row].values.drop_null().to_numpy() if lists[row].is_valid else np.zeros(0, np.int32)
                out.append(" ".join(tokens[numbers[(numbers >= 0) & (numbers < len(tokens))]].tolist()))
            return [pa.array(out, pa.string())]

        return each

    return map_batches(df, work, f"`{name}` string", keep)
