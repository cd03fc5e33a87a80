"""Reading tables, walking over long texts and Arrow plumbing shared by the operators."""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

#: Texts above this size are walked over in blocks.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(values, rows: int = 256) -> Iterator:
    """An Arrow array or batch in slices, so that Python objects exist for a few rows at a time."""
    size = values.num_rows if isinstance(values, pa.RecordBatch) else len(values)
    for start in range(0, size, rows):
        yield values.slice(start, rows)


def byte_texts(values: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string array, without decoding them."""
    for part in slices(values):
        yield from part.cast(pa.large_binary()).to_pylist()


def texts(values: pa.Array) -> Iterator[str | None]:
    for part in slices(values):
        yield from part.to_pylist()


def word_blocks(text: bytes | None, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size: very long texts are cut at white space, never inside a word."""
    if not text:
        return
    if len(text) <= size:
        yield text.split()
        return
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + size)
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def map_batches(df: DataFrame, work: Callable, fields: str, keep: list[str] | None = None,
                rows: int | None = 1024) -> DataFrame:
    """``keep`` columns of ``df`` as they are, then the columns of ``fields`` that ``work`` makes of each batch.

    ``work`` is called once a task and returns a function from a record batch to a list of Arrow arrays. It gets at most
    ``rows`` rows at a time, which bounds what it holds as Python objects.
    """
    kept = df.columns if keep is None else keep
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([df.schema[c] for c in kept] + list(added))
    places = [df.columns.index(c) for c in kept]

    def run(batches):
        each = work()
        for whole in batches:
            for batch in slices(whole, rows or max(whole.num_rows, 1)):
                columns = [batch.column(i) for i in places] + each(batch)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def grouped_batches(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[int | tuple, Iterator[pa.RecordBatch]]]:
    """Batches by runs of a column, or of several, as they come; the key of a run of several is a tuple."""
    def cut():
        for batch in batches:
            keys = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in columns]
            new = np.logical_or.reduce([values[1:] != values[:-1] for values in keys])
            starts = np.flatnonzero(np.concatenate(([True], new))) if batch.num_rows else []
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows) if batch.num_rows else []):
                key = tuple(int(values[a]) for values in keys)
                yield key if len(key) > 1 else key[0], batch.slice(int(a), int(b - a))

    pieces = cut()
    piece = next(pieces, None)
    while piece is not None:
        key = piece[0]

        def same():
            nonlocal piece
            while piece is not None and piece[0] == key:
                yield piece[1]
                piece = next(pieces, None)

        yield key, same()
        while piece is not None and piece[0] == key:
            piece = next(pieces, None)


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % modulus
