"""SentencePiece encoding and decoding with a given vocabulary of merge type.

Every distinct chunk of a partition (a run of spaces and what follows up to the next space) is merged once over an agenda
of its neighbouring symbol pairs: the best score comes first, the leftmost place among equal scores. Chunks of ordinary
length keep their agendas side by side in arrays and all take their best entry at a time; a long chunk has a heap of its own.
The ids of a chunk are checked against the sentencepiece library, all new chunks of an Arrow batch in one call.
"""

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from wordloom.llm.bpe import _portions, _spans
from wordloom.llm.common import map_batches

SPACE = "▁"  # fixed value: how a space is written inside pieces

# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGES = 2

_SYMBOL_BITS = 16
_NEVER = 1 << 30


class Vocabulary:
    """Pieces, scores and byte pieces of a model file of merge type with byte fallback and without normalising.

    What such a file can say beyond that (rewriting characters, dropping spaces, pieces that the user defined) is refused,
    never passed over.
    """

    def __init__(self, model: bytes):
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        steps, kinds = spec.normalizer_spec, {p.type for p in spec.pieces}
        known = (
            spec.trainer_spec.model_type == _MERGES and spec.trainer_spec.byte_fallback
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and not steps.precompiled_charsmap and steps.add_dummy_prefix and steps.escape_whitespaces
            and not steps.remove_extra_whitespaces and not spec.denormalizer_spec.precompiled_charsmap
            and kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        )
        if not known:
            raise ValueError("a model of another kind: it takes steps that this reader does not have")
        normal = [(i, p.piece, p.score) for i, p in enumerate(spec.pieces) if p.type == _NORMAL]
        self.ids = {piece: i for i, piece, _ in normal}
        #: What a merge into a piece costs; the lowest is taken first, equal scores have equal costs.
        ranks = {score: rank for rank, score in enumerate(sorted({score for *_, score in normal}, reverse=True))}
        self.cost = {piece: ranks[score] for _, piece, score in normal}
        self.bytes = [0] * 256
        #: By id: the bytes that a piece stands for; a byte piece's own byte.
        self.surface = [b""] * len(spec.pieces)
        self.is_byte = np.zeros(len(spec.pieces), bool)
        for i, p in enumerate(spec.pieces):
            if p.type == _NORMAL:
                self.surface[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == _UNKNOWN:
                self.surface[i] = spec.trainer_spec.unk_surface.encode()
            elif p.type == _BYTE:
                byte = int(p.piece[1:-1], 16)
                self.bytes[byte], self.surface[i], self.is_byte[i] = i, bytes([byte]), True
        self.leading = np.array([p.type == _NORMAL and p.piece.startswith(SPACE) for p in spec.pieces])
        self.control = np.array([p.type == _CONTROL for p in spec.pieces])
        self.begin, self.end = spec.trainer_spec.bos_id, spec.trainer_spec.eos_id
        #: A piece with a space after another character would join chunks: texts are then merged whole.
        self.whole = any(a != SPACE and b == SPACE for _, piece, _ in normal for a, b in zip(piece, piece[1:]))
        self._pairs()

    def _pairs(self) -> None:
        """Symbols are piece ids; characters that are only part of pieces come after them, others have none."""
        letters = sorted({c for piece in self.ids for c in piece})
        symbols = dict(self.ids)
        for c in letters:
            symbols.setdefault(c, len(self.surface) + len(symbols) - len(self.ids))
        self.letters = np.array([ord(c) for c in letters], np.int64)
        self.letter_symbols = np.array([symbols[c] for c in letters], np.int32)
        self.spelled = {symbols[c]: c for c in letters if c not in self.ids}
        halves = [
            (symbols[piece[:cut]] << _SYMBOL_BITS | symbols[piece[cut:]], self.cost[piece], i)
            for piece, i in self.ids.items() for cut in range(1, len(piece)) if piece[:cut] in symbols and piece[cut:] in symbols
        ]
        if len(symbols) + len(self.surface) >= 1 << _SYMBOL_BITS:
            raise ValueError(f"more than {1 << _SYMBOL_BITS} pieces and characters")
        keys, costs, results = np.array(sorted(halves) + [(0, _NEVER, 0)], np.int64).T
        self.keys, self.costs, self.results = keys[:-1].astype(np.uint32), costs.astype(np.int32), results.astype(np.int32)

    def symbols(self, text: str) -> np.ndarray:
        """A symbol for each character; a character of no piece is written as minus its code point, less one."""
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, self.letter_symbols[at], -codes - 1).astype(np.int32)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in ``costs`` and ``results``; the last one says that it never merges."""
        keys = left.astype(np.uint32) << _SYMBOL_BITS | right.astype(np.uint32)
        at = np.searchsorted(self.keys, keys)
        found = (left >= 0) & (right >= 0) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys)
        return np.where(found, at, len(self.keys)).astype(np.int32)


def merged(chunk: str, cost: dict[str, float]) -> list[str]:
    """The symbols of one chunk when no pair of neighbours is a piece any more.

    The agenda holds ``(cost, place, pair)``. An entry is out of date if the pair no longer stands at its place.
    """
    symbols = list(chunk)
    size = len(symbols)
    agenda = [(cost[pair], place, pair) for place, pair in enumerate(map(str.__add__, symbols, symbols[1:])) if pair in cost]
    if not agenda:
        return symbols
    heapq.heapify(agenda)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    while agenda:
        _, left, pair = heapq.heappop(agenda)
        right = after[left]
        if right == size or not symbols[left] or symbols[left] + symbols[right] != pair:
            continue
        symbols[left], symbols[right] = pair, ""
        beyond = after[left] = after[right]
        if beyond < size:
            before[beyond] = left
            longer = pair + symbols[beyond]
            if longer in cost:
                heapq.heappush(agenda, (cost[longer], left, longer))
        ahead = before[left]
        if ahead >= 0:
            longer = symbols[ahead] + pair
            if longer in cost:
                heapq.heappush(agenda, (cost[longer], ahead, longer))
    return [s for s in symbols if s]


def merged_together(text: str, sizes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of many chunks, one after the other, and the chunk of each: as :func:`merged`, for all at once.

    ``text`` has the chunks one after the other, ``sizes`` their characters.

    The agendas lie side by side, an entry at the left symbol of its pair. In each round every chunk takes its best entry,
    the leftmost of equal ones, and the entries of the pairs beside it are made anew.
    """
    symbol = vocabulary.symbols(text)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def entries(places: np.ndarray) -> np.ndarray:
        after = np.minimum(places + 1, len(symbol) - 1)
        inside = (places + 1 < len(symbol)) & (owner[after] == owner[places])
        return np.where(inside, vocabulary.pairs(symbol[places], symbol[after]), len(vocabulary.keys))

    agenda = entries(np.arange(len(symbol)))
    done = []
    while len(symbol):
        cost = vocabulary.costs[agenda]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(starts, append=len(owner))
        best = np.repeat(np.minimum.reduceat(cost, starts), sizes)
        open_ = best < _NEVER
        done.append((symbol[~open_], owner[~open_]))
        top = np.flatnonzero(open_ & (cost == best))
        top = top[np.diff(owner[top], prepend=-1) > 0]
        symbol[top] = vocabulary.results[agenda[top]]
        open_[top + 1] = False
        at = np.cumsum(open_) - 1
        symbol, owner, agenda, top = symbol[open_], owner[open_], agenda[open_], at[top]
        if len(symbol):
            touched = np.concatenate([top, top[top > 0] - 1])
            agenda[touched] = entries(touched)
    symbol, owner = (np.concatenate([part[i] for part in done] or [np.zeros(0, np.int32)]) for i in (0, 1))
    order = np.argsort(owner, kind="stable")
    return symbol[order], owner[order]


_KEPT = 300_000
_BYTES_AT_ONCE = 8 << 20
_LONG = 64  # characters of a chunk with a heap of its own
_TOGETHER = 256  # chunks that the library gets as one text
_CHUNKS = re.compile(" *[^ ]+| +")
_IRREGULAR = f"{SPACE}|  |^ | $|^$"  # texts whose chunks are not what lies between their spaces


class Encoder:
    """Texts to ids; keeps the ids of chunks seen in this partition, up to a bound, and which the library has otherwise.

    A chunk is named by its characters without its first space, which every chunk has: the model puts one before a text.
    """

    def __init__(self, vocabulary: Vocabulary, library: sentencepiece.SentencePieceProcessor | None):
        self.vocabulary, self.library = vocabulary, library
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.unequal = np.zeros(0, bool)

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text with spaces beside each other or at its ends."""
        text = text.replace(SPACE, " ")
        return [chunk[1:] for chunk in _CHUNKS.findall(" " + text)] if text else []

    def ids_of(self, symbols: list[str]) -> list[int]:
        ids: list[int] = []
        for symbol in symbols:
            known = self.vocabulary.ids.get(symbol)
            ids += self.bytes_of(symbol) if known is None else [known]
        return ids

    def bytes_of(self, character: str) -> list[int]:
        return [self.vocabulary.bytes[b] for b in character.encode()]

    def ids_of_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks one after the other, and how many each has."""
        text = SPACE + SPACE.join(chunks).replace(" ", SPACE) if chunks else ""
        ids, owner = merged_together(text, np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1, self.vocabulary)
        characters = np.flatnonzero((ids < 0) | (ids >= len(self.vocabulary.surface)))
        if len(characters):
            spelled = [self.bytes_of(self.vocabulary.spelled[c] if c >= 0 else chr(-c - 1)) for c in ids[characters].tolist()]
            sizes = np.ones(len(ids), np.int64)
            sizes[characters] = [len(some) for some in spelled]
            starts = np.cumsum(sizes) - sizes
            ids, owner = np.repeat(ids, sizes), np.repeat(owner, sizes)
            ids[_spans(starts[characters], sizes[characters])] = [i for some in spelled for i in some]
        return ids, np.bincount(owner, minlength=len(chunks))

    def learn(self, chunks: list[str]) -> None:
        long = [chunk for chunk in chunks if len(chunk) >= _LONG]
        chunks = [chunk for chunk in chunks if len(chunk) < _LONG]
        ids, sizes = self.ids_of_all(chunks)
        heaps = [self.ids_of(merged(SPACE + chunk.replace(" ", SPACE), self.vocabulary.cost)) for chunk in long]
        chunks += long
        ids = np.concatenate([ids, np.array([i for one in heaps for i in one], np.int32)])
        sizes = np.concatenate([sizes, np.array(list(map(len, heaps)), np.int64)])
        self.places.update(zip(chunks, range(len(self.places), len(self.places) + len(chunks))))
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.unequal = np.concatenate([self.unequal, self.compared(chunks, ids, np.cumsum(sizes))])

    def compared(self, chunks: list[str], ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each chunk, whether the library has other ids; it gets many chunks as one text, and if these differ, each alone."""
        unequal = np.zeros(len(chunks), bool)
        if self.library is None:
            return unequal
        starts = np.append(0, ends)
        groups = [range(i, min(i + _TOGETHER, len(chunks))) for i in range(0, len(chunks), _TOGETHER)]
        # A chunk with further spaces, or of a space alone, would join the one beside it.
        groups = [part for group in groups for part in (
            [group] if all(chunks[i] and " " not in chunks[i] for i in group) else [range(i, i + 1) for i in group])]
        theirs = self.library.encode([" ".join(chunks[group.start:group.stop]) for group in groups], num_threads=1)
        for group, found in zip(groups, theirs):
            if found == ids[starts[group.start]:starts[group.stop]].tolist():
                continue
            for i in group:
                own = self.library.encode(chunks[i] or SPACE)  # a text of one space has a second one put before it
                mine = ids[starts[i]:starts[i + 1]].tolist()
                unequal[i] = own != mine if chunks[i] else self.library.decode(mine) != ""
        return unequal

    def places_of(self, chunks: pa.Array) -> np.ndarray:
        """The place of each chunk among those kept; new ones are merged."""
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.places) > _KEPT:
            self._forget()
        new = [chunk for chunk in distinct if chunk not in self.places]
        if new:
            self.learn(new)
        places = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        return places[coded.indices.to_numpy()] if len(distinct) else places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each between begin and end; how many each has; whether the library differs."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False) | self.vocabulary.whole
        cut = pc.split_pattern(texts, " ")
        if odd.any():
            alone = self.vocabulary.whole
            rows = [([text.replace(SPACE, " ")] if alone and text else self.chunks(text)) if o else None
                    for text, o in zip(texts.to_pylist(), odd.tolist())]
            cut = pc.if_else(pa.array(odd), pa.array(rows, pa.list_(pa.string())), cut)
        counts = pc.list_value_length(cut).to_numpy().astype(np.int64)
        places = self.places_of(cut.flatten())
        sizes, row = self.sizes[places], np.repeat(np.arange(len(counts)), counts)
        own = np.bincount(row, weights=sizes, minlength=len(counts)).astype(np.int64)
        ends = np.cumsum(own + 2)
        ids = np.empty(ends[-1] if len(ends) else 0, np.int32)
        ids[ends - own - 2], ids[ends - 1] = self.vocabulary.begin, self.vocabulary.end
        ids[_spans(ends - own - 1, own)] = self.ids[_spans(self.starts[places], sizes)]
        unequal = np.zeros(len(counts), bool)
        unequal[row[self.unequal[places]]] = True
        return ids, own + 2, unequal


class Decoder:
    """Ids to text: control pieces say nothing, the space put before the text goes, byte pieces are read as UTF-8."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        ends = np.cumsum(counts)
        return pa.array([self.decode(ids[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())], pa.string())

    def decode(self, ids: np.ndarray) -> str:
        v = self.vocabulary
        ids = ids[(ids >= 0) & (ids < len(v.surface))]
        ids = ids[~v.control[ids]]
        if not len(ids):
            return ""
        parts = [v.surface[i] for i in ids.tolist()]
        if v.leading[ids[0]]:
            parts[0] = parts[0][1:]
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return "".join(self._runs(ids, parts))

    def _runs(self, ids: np.ndarray, parts: list[bytes]) -> Iterator[str]:
        """Runs of byte pieces and others apart; each byte that belongs to no character is a replacement character."""
        of_bytes = self.vocabulary.is_byte[ids]
        cuts = np.flatnonzero(np.diff(of_bytes)) + 1
        for run in np.split(np.arange(len(ids)), cuts):
            data = b"".join(parts[i] for i in run)
            if not of_bytes[run[0]]:
                yield data.decode()
                continue
            while data:
                for size in range(1, 5):
                    try:
                        yield data[:size].decode()
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    size = 1
                    yield "�"
                data = data[size:]


def _model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _mapped(df: DataFrame, model: str, text: str, fields: str, keep: list[str] | None, check: bool, decoded: bool) -> DataFrame:
    place = df.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(_model(model))

    def work():
        vocabulary = Vocabulary(shared.value)
        encoder = Encoder(vocabulary, sentencepiece.SentencePieceProcessor(model_proto=shared.value) if check else None)
        decoder = Decoder(vocabulary)

        def each(batch):
            parts, texts = [], [pa.array([], pa.string())]
            for part in _portions(batch.column(place), _BYTES_AT_ONCE):
                parts.append(encoder.encode(part))
                if decoded:
                    texts.append(decoder.decode_all(*parts[-1][:2]))
            ids, counts, unequal = map(np.concatenate, zip(*parts))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(unequal)]
            return columns + [pa.concat_arrays(texts)] if decoded else columns

        return each

    return map_batches(df, work, fields, keep, rows=None)


def encode(df: DataFrame, model: str, text: str = "text", name: str = "ids", keep: list[str] | None = None,
           check: bool = True) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``name``, array<int>: begin, the ids of the whole text of each row, end.

    ``model`` is the path of a model file that the driver can read; its bytes, of fixed size, are broadcast. Null and empty
    texts have begin and end alone. With ``check``, ``<name>_unequal`` says whether the sentencepiece library has other ids
    for any chunk of the text (it is false without). Rows are independent: repeated rows come out repeated, an empty table
    stays empty, a very long text costs memory in proportion to it and time in proportion times its logarithm. Other
    columns may have any name but the added ones.
    """
    return _mapped(df, model, text, f"`{name}` array<int>, `{name}_unequal` boolean", keep, check, False)


def round_trip(df: DataFrame, model: str, text: str = "text", keep: list[str] | None = None, check: bool = True) -> DataFrame:
    """Like :func:`encode`, with ``decoded`` besides ``ids`` and ``ids_unequal``: the text of the ids, in the same pass."""
    return _mapped(df, model, text, "ids array<int>, ids_unequal boolean, decoded string", keep, check, True)


def decode(df: DataFrame, model: str, ids: str = "ids", name: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``name``: the text of the ids.

    Begin and end say nothing; null and empty lists give an empty text; null ids and ids that the model does not have are
    left out; bytes that are no UTF-8 become replacement characters one by one.
    """
    place = df.columns.index(ids)
    shared = df.sparkSession.sparkContext.broadcast(_model(model))

    def work():
        decoder = Decoder(Vocabulary(shared.value))

        def each(batch):
            lists = batch.column(place)
            return [pa.array([
                decoder.decode(row.values.drop_null().to_numpy() if row.is_valid else np.zeros(0, np.int32)) for row in lists
            ], pa.string())]

        return each

    return map_batches(df, work, f"`{name}` string", keep)
