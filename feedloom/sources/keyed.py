"""Tables kept by key: bucketed files, of which a change writes only the buckets that it touches.

A bucket's folder holds one folder for each version of that bucket, and the log (``versions``) names the version of every
bucket, so a reader sees one state of the whole table, a lost run changes nothing, and two writers of different buckets both
get through. Buckets are those of a Spark table (``clustered by``), so a join or aggregate on the key reads the table where
it lies: only the other side is shuffled, and two tables with the same keys and buckets are compared without a shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import cut
from . import versions
from .versions import StateConflict

BUCKETS = 64
_BUCKET, _VERSION = "_bucket", "_version"


@dataclass(frozen=True)
class Head:
    """A state of the table: its number, the version of each bucket (None: no rows), and the last change of each writer."""

    number: int
    buckets: tuple[str | None, ...]
    done: dict[str, str] = field(default_factory=dict)


class KeyedTable:
    """The table at ``folder``, with one row or more for each key. ``buckets`` counts when it is first written: choose it so
    that a bucket is some hundred MB; later the stored number holds."""

    def __init__(self, spark: SparkSession, folder: str, schema: str | T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), list(keys)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        _, said = versions.latest(spark, folder)
        self.buckets = len(said["buckets"]) if said else buckets

    def head(self) -> Head:
        number, said = versions.latest(self.spark, self.folder)
        return Head(number, tuple(said["buckets"]), said["done"]) if said else Head(0, (None,) * self.buckets)

    def bucket(self) -> Column:
        """The bucket of a row, as the table's writer counts it."""
        return F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _table(self) -> str:
        """The table's name in the session, declared over the folder at first use."""
        name = "keyed_" + hashlib.md5(f"{self.folder}|{self.schema.json()}|{self.keys}|{self.buckets}".encode()).hexdigest()
        quoted = ", ".join(f"`{k}`" for k in self.keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"create table if not exists {name} ({columns}, {_BUCKET} int, {_VERSION} string) using parquet partitioned by ({_BUCKET}, {_VERSION}) "
            f"clustered by ({quoted}) sorted by ({quoted}) into {self.buckets} buckets location '{self.folder}/data'")
        return name

    def read(self, head: Head | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Rows of a state, by default the current one; ``only`` those of some buckets."""
        head = self.head() if head is None else head
        held = [(i, v) for i, v in enumerate(head.buckets) if v is not None and (only is None or i in set(only))]
        names = [f.name for f in self.schema.fields]
        if not held:
            return self.spark.createDataFrame([], self.schema)
        name = self._table()
        parts = " ".join(f"partition ({_BUCKET}={i}, {_VERSION}='{v}')" for i, v in held)
        self.spark.sql(f"alter table {name} add if not exists {parts}")
        wanted = dict(held)
        current = F.array(*[F.lit(wanted.get(i)) for i in range(self.buckets)])
        return self.spark.table(name).filter(F.element_at(current, F.col(_BUCKET) + 1) == F.col(_VERSION)).select(*[f"`{n}`" for n in names])

    def _write(self, rows: DataFrame, version: str) -> None:
        laid = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        laid = laid.withColumn(_BUCKET, self.bucket()).withColumn(_VERSION, F.lit(version))
        # dealt as the table is bucketed, so each task writes the files of its buckets
        laid = laid.repartition(self.buckets, *self.keys).sortWithinPartitions(_BUCKET, *self.keys)
        laid.write.insertInto(self._table())  # a version's folders are new, so nothing is overwritten

    def _written(self, version: str, touched: Sequence[int]) -> dict[int, str | None]:
        fs, p = versions._hadoop(self.spark, f"{self.folder}/data/{_BUCKET}=*/{_VERSION}={version}")
        found = fs.globStatus(p) or []
        have = {int(s.getPath().getParent().getName().split("=")[1]) for s in found}
        return {b: version if b in have else None for b in touched}

    def replace(self, rows: DataFrame, *, writer: str = "", name: str = "") -> Head:
        """The whole table anew."""
        return self._change(lambda head: (rows, range(self.buckets)), writer, name)

    def change(self, changes: DataFrame, fn: Callable[[DataFrame, DataFrame], DataFrame], *, writer: str = "", name: str = "") -> Head:
        """``fn(old rows, changes)`` in place of the rows of all buckets that a key of ``changes`` is in.

        A change of the same ``name`` as the writer's last one is not made again. Where another run has changed one of the
        buckets in the meantime, ``fn`` is asked again with the rows that are there then.
        """
        marked = cut(changes.withColumn(_BUCKET, self.bucket()))
        touched = sorted(r[0] for r in marked.select(_BUCKET).distinct().collect())  # one number for a bucket at most
        return self._change(lambda head: (fn(self.read(head, touched), marked.drop(_BUCKET)), touched), writer, name)

    def upsert(self, rows: DataFrame, *, order: Sequence[Column] = (), writer: str = "", name: str = "") -> Head:
        """Put ``rows`` in, one for each key: the first by ``order`` of the old and the new ones, without an order the new one."""
        from ..operators.relational import first_per_key

        newest = list(order) or [F.desc("_new")]

        def merged(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
            return first_per_key(both, self.keys, newest).drop("_new")

        return self.change(rows, merged, writer=writer, name=name)

    def _change(self, make: Callable[[Head], tuple[DataFrame, Sequence[int]]], writer: str, name: str, tries: int = 8) -> Head:
        for _ in range(tries):
            head = self.head()
            if name and head.done.get(writer) == name:
                return head
            rows, touched = make(head)
            version = uuid.uuid4().hex
            self._write(rows, version)
            new = self._written(version, touched)
            base = head
            while True:
                done = base.done | ({writer: name} if name else {})
                after = Head(base.number + 1, tuple(new.get(i, v) for i, v in enumerate(base.buckets)), done)
                if versions.commit(self.spark, self.folder, after.number, {"buckets": list(after.buckets), "done": done}):
                    return after
                base = self.head()
                if any(base.buckets[b] != head.buckets[b] for b in touched):
                    break  # another run got there first: from the start
        raise StateConflict(f"{self.folder} was changed by others {tries} times in a row")

    def drop_old(self, keep: int = 1) -> int:
        """Delete the files of bucket versions that none of the last ``keep`` states names; how many there were."""
        numbers = versions.entries(self.spark, self.folder)[-keep:]
        named = {(i, v) for n in numbers for i, v in enumerate(versions.entry(self.spark, self.folder, n)["buckets"])}
        fs, p = versions._hadoop(self.spark, f"{self.folder}/data/{_BUCKET}=*/{_VERSION}=*")
        gone = 0
        for s in fs.globStatus(p) or []:
            part = lambda path: path.getName().split("=")[1]
            if (int(part(s.getPath().getParent())), part(s.getPath())) not in named:
                gone += bool(fs.delete(s.getPath(), True))
        return gone
