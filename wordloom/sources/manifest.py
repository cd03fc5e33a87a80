"""Versions of a stored table: one small file says which data files count, and a new version is the appearance of its file."""

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_KEPT = 20  # versions whose files stay


class Conflict(Exception):
    """Another writer made the next version first; the change has to be worked out again from that version."""


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder, files = _files(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))


def latest(spark: SparkSession, path: str) -> dict:
    """What the last complete version says; version 0 says nothing."""
    versions = _versions(spark, path)
    if not versions:
        return {"version": 0}
    file, files = _files(spark, f"{path}/versions/{versions[-1]:012d}.json")
    stream = files.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, said: dict) -> dict:
    """Make ``said`` the version after ``said["version"]``; raises :class:`Conflict` if that one exists.

    The file is written under another name and renamed, so it is there as a whole or not at all: a writer that breaks off
    before leaves the version before. Files of versions long past are deleted.
    """
    said = {**said, "version": said["version"] + 1}
    number = said["version"]
    final, files = _files(spark, f"{path}/versions/{number:012d}.json")
    draft, _ = _files(spark, f"{path}/versions/.draft-{number}-{time.time_ns()}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(said).encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(final.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(final), plain)
    except Py4JJavaError as problem:
        files.delete(draft, False)
        if "FileAlreadyExists" not in str(problem.java_exception):
            raise
        raise Conflict(f"version {number} of {path} exists") from None
    delete(spark, [f"{path}/versions/{v:012d}.json" for v in _versions(spark, path) if v <= number - _KEPT])
    return said


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders; missing ones are no error."""
    for path in paths:
        target, files = _files(spark, path)
        files.delete(target, True)


def retire(said: dict, folders: list[str], keep_seconds: float) -> list[str]:
    """Note in ``said`` that ``folders`` are read by no later version; returns those noted ``keep_seconds`` ago or earlier.

    The returned ones are to be deleted once ``said`` is committed. Until then a reader of an older version finds them.
    """
    now = time.time()
    waiting = said.get("retired", []) + [[folder, now] for folder in folders]
    said["retired"] = [entry for entry in waiting if entry[1] > now - keep_seconds]
    return [folder for folder, since in waiting if since <= now - keep_seconds]
