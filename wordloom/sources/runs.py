"""A log of runs: each adds keyed rows, a run that comes again replaces its own, and levels of runs are merged.

Runs have any names; their order is that in which they first came. Ten segments of one level are merged into one of the next,
so what a reader lists grows with the logarithm of the runs. Merging is a sum of counts, the last value by the order of
runs, or the union of sketches of distinct values.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.sources import manifest

_FANOUT = 10
_ATTEMPTS = 20
_ORDER = "_order"  # of the run that wrote a value, stored beside it


class RunLog:
    """The log at ``path`` of rows ``(key, value)``; ``how`` is ``"sum"``, ``"last"`` or ``"sketch"``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, how: str = "sum", keep_seconds: float = 86_400.0):
        self.spark, self.path, self.how, self.keep_seconds = spark, path, how, keep_seconds
        self.schema = T.StructType.fromDDL(schema)
        self.key, self.value = self.schema.names
        self.stored = T.StructType([*self.schema, T.StructField(_ORDER, T.LongType())])

    def _commit(self, change: Callable[[dict], list[str] | None]) -> bool:
        """Apply ``change`` to what the last version says; again on the next one if another writer was first.

        It returns the folders that nothing reads any more, or None where there is nothing to change.
        """
        for _ in range(_ATTEMPTS):
            said = manifest.latest(self.spark, self.path)
            gone = change(said)
            if gone is None:
                return False
            outdated = manifest.retire(said, gone, self.keep_seconds)
            try:
                manifest.commit(self.spark, self.path, said)
            except manifest.Conflict:
                continue
            manifest.delete(self.spark, outdated)
            return True
        raise manifest.Conflict(f"{self.path} changed {_ATTEMPTS} times meanwhile")

    def write(self, df: DataFrame, run_id: str | int, compact: bool = True) -> None:
        """Store a run's rows, one a key. The same run again replaces them, unless it has been merged: then it adds nothing."""
        name = str(run_id)
        if _contains(manifest.latest(self.spark, self.path).get("merged", []), name):
            return
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(folder)

        def add(said: dict) -> list[str]:
            if _contains(said.get("merged", []), name):
                return [folder]
            segments = said.setdefault("segments", [])
            own = next((s for s in segments if s["run"] == name), None)
            if own is not None:
                before, own["folder"] = own["folder"], folder
                return [before]
            said["next"] = said.get("next", 0) + 1
            segments.append({"run": name, "folder": folder, "level": 0, "order": said["next"] - 1})
            return []

        self._commit(add)
        if compact:
            self.compact()

    def _rows(self, segments: list[dict]) -> DataFrame:
        """Rows with the order of the run they come from. Merged segments store it; of a run it is in the log."""
        merged = [s["folder"] for s in segments if s["level"]]
        parts = [self.spark.read.schema(self.stored).parquet(*merged)] if merged else []
        parts += [self.spark.read.schema(self.schema).parquet(s["folder"]).withColumn(_ORDER, F.lit(s["order"]).cast("bigint"))
                  for s in segments if not s["level"]]
        rows = self.spark.createDataFrame([], self.stored)
        for part in parts:
            rows = rows.unionByName(part)
        return rows

    def _merged(self, rows: DataFrame) -> DataFrame:
        value = {"sum": F.sum, "sketch": F.hll_union_agg, "last": lambda c: F.max_by(c, _ORDER)}[self.how](self.value)
        return rows.groupBy(self.key).agg(value.alias(self.value), F.max(_ORDER).alias(_ORDER))

    def read(self) -> DataFrame:
        """One row a key over all runs; none if nothing was stored."""
        return self._merged(self._rows(self.segments())).select(*self.schema.names)

    def segments(self) -> list[dict]:
        """What a reader has to list: at most ten a level."""
        return manifest.latest(self.spark, self.path).get("segments", [])

    def compact(self, everything: bool = False) -> None:
        """Merge each level with ten segments into one of the next; with ``everything`` all segments into one.

        The merged rows count once the version that names them is there. A merge that breaks off leaves the segments as
        they were; one that another writer has overtaken is dropped. The merged files are deleted ``keep_seconds`` later.
        """
        while True:
            segments = self.segments()
            if everything:
                chosen = segments if len(segments) > 1 or any(s["level"] == 0 for s in segments) else []
                level = max((s["level"] for s in segments), default=0) or 1
            else:
                full = [n for n in sorted({s["level"] for s in segments}) if sum(s["level"] == n for s in segments) >= _FANOUT]
                chosen = [s for s in segments if full and s["level"] == full[0]]
                level = full[0] + 1 if full else 0
            if not chosen:
                return
            folder = f"{self.path}/data/{uuid.uuid4().hex}"
            self._merged(self._rows(chosen)).select(*self.stored.names).write.parquet(folder)

            def swap(said: dict) -> list[str]:
                folders = {s["folder"] for s in chosen}
                now = said.get("segments", [])
                if not folders <= {s["folder"] for s in now}:  # replaced or merged by another writer
                    return [folder]
                said["segments"] = [s for s in now if s["folder"] not in folders] + [
                    {"run": None, "folder": folder, "level": level, "order": max(s["order"] for s in chosen)}]
                said["merged"] = _joined(said.get("merged", []), [s["run"] for s in chosen if s["run"] is not None])
                return list(folders)

            self._commit(swap)
            if everything:
                return


def _contains(ranges: list, name: str) -> bool:
    """Whether a run is among the merged ones: names, and ranges of numbers."""
    number = int(name) if name.isdecimal() and str(int(name)) == name else None
    return any(entry == name if isinstance(entry, str) else number is not None and entry[0] <= number <= entry[1] for entry in ranges)


def _joined(ranges: list, names: list[str]) -> list:
    """The merged runs with ``names``: neighbouring numbers are one range, so a stream's batches take one entry."""
    texts = {entry for entry in ranges if isinstance(entry, str)}
    spans = [entry for entry in ranges if not isinstance(entry, str)]
    for name in names:
        if name.isdecimal() and str(int(name)) == name:
            spans.append([int(name), int(name)])
        else:
            texts.add(name)
    joined: list = []
    for low, high in sorted(spans):
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    return sorted(texts) + joined
