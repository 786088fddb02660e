"""A log of table versions that two writers can share: one small file for each number, written only if it is not there.

The file with the highest number tells what is current. A writer puts its file in place by a rename that fails if the name
is taken, so of two writers with the same number one gets to know that it was second.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class StateConflict(RuntimeError):
    """Another run has written the state since it was read."""


def _log(folder: str) -> str:
    return folder.rstrip("/") + "/versions"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop library, for whatever scheme the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all versions, in order. One listing of one folder."""
    fs, p = _hadoop(spark, _log(folder))
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def entry(spark: SparkSession, folder: str, number: int) -> dict[str, Any]:
    """What version ``number`` says."""
    fs, p = _hadoop(spark, f"{_log(folder)}/{number:020d}.json")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def latest(spark: SparkSession, folder: str) -> tuple[int, dict[str, Any]]:
    """(number, what it says) of the current version; (0, {}) before the first one."""
    numbers = entries(spark, folder)
    return (numbers[-1], entry(spark, folder, numbers[-1])) if numbers else (0, {})


def commit(spark: SparkSession, folder: str, number: int, said: dict[str, Any]) -> bool:
    """Make ``said`` version ``number``; False if there is one of that number already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, place = _hadoop(spark, f"{_log(folder)}/{number:020d}.json")
    if fs.exists(place):
        return False
    _, draft = _hadoop(spark, f"{_log(folder)}/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.writeBytes(json.dumps(said, ensure_ascii=True))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(draft, place, options)
    except Exception as error:  # only a name that is taken means that another was first
        fs.delete(draft, False)
        if fs.exists(place):
            return False
        raise error
    return True
