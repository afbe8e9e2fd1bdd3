"""Tables with committed versions: edits that persist, readers that keep theirs.

A table is a folder. ``data/`` holds immutable Parquet folders, ``versions/``
one small JSON manifest for each version. Rows are dealt to a fixed number of
buckets by a hash of the table's key, and a manifest names, for each bucket,
its folders, its row count and a sum of its row hashes; its size depends on the
number of buckets, not on the rows. A reader takes the newest manifest and
reads what it names, so later commits don't change what it sees.

An edit rewrites only the buckets that hold rows it changes; an insert adds a
folder to each bucket and rewrites nothing. A commit publishes the next
manifest under its number, which only one writer can do: a manifest is written
whole under another name and then linked or renamed, failing if the number is
taken. The writer that loses looks at what was committed since it read. If no
bucket that its edit depends on was touched, its changes are moved onto the
newer version, otherwise the edit starts again from there.

The bucket hashes make two versions comparable without reading them: buckets
of equal count and hash are taken as equal, and only the others are read by
``changes``.
"""

from __future__ import annotations

import dataclasses
import json
import os
import time
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.joins import broadcast_if_small
from bidmill.operators.snapshots import delete_where, update_where

BUCKETS = 16
BUCKET = "_bucket"
HASH_RANGE = 2 ** 64
RETRIES = 20


class Conflict(Exception):
    """Another writer committed rows that this edit had read."""


@dataclasses.dataclass(frozen=True)
class Part:
    """What a version holds of one bucket."""
    folders: tuple[str, ...] = ()
    rows: int = 0
    hash: int = 0

    def plus(self, other: Part) -> Part:
        return Part(self.folders + other.folders, self.rows + other.rows,
                    (self.hash + other.hash) % HASH_RANGE)

    def same_rows(self, other: Part) -> bool:
        return (self.rows, self.hash) == (other.rows, other.hash)


@dataclasses.dataclass(frozen=True)
class Manifest:
    version: int
    operation: str
    schema: str
    keys: tuple[str, ...]
    buckets: int
    parts: dict[int, Part]
    touched: tuple[int, ...]
    notes: dict[str, int] = dataclasses.field(default_factory=dict)   # the writer's own

    def text(self) -> str:
        own = dataclasses.asdict(self)
        own["parts"] = {str(b): dataclasses.asdict(p) for b, p in self.parts.items()}
        return json.dumps(own)

    @staticmethod
    def of(text: str) -> Manifest:
        own = json.loads(text)
        own["parts"] = {int(b): Part(tuple(p["folders"]), p["rows"], p["hash"])
                        for b, p in own["parts"].items()}
        own["keys"], own["touched"] = tuple(own["keys"]), tuple(own["touched"])
        return Manifest(**own)

    def part(self, bucket: int) -> Part:
        return self.parts.get(bucket, Part())

    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _columns(m: Manifest) -> list[Column]:
    return [F.col(f"`{c}`") for c in m.columns().fieldNames()]


def _typed(rows: DataFrame, m: Manifest) -> DataFrame:
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                         for f in m.columns()])


class _Files:
    """The few calls on Spark's file systems that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.io = spark._jvm.org.apache.commons.io.IOUtils
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, place: str):
        return self.jvm.Path(place)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        if not self.fs.exists(place):
            return []
        return [f.getPath().getName() for f in self.fs.listStatus(place)]

    def read(self, place: str) -> str:
        stream = self.fs.open(self.path(place))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, text: str, place: str) -> bool:
        """Write ``place`` whole, or not at all if it is there already."""
        draft = f"{place}.{uuid.uuid4().hex}.draft"
        out = self.fs.create(self.path(draft))
        out.write(bytearray(text.encode()))
        out.close()
        uri = self.fs.makeQualified(self.path(draft)).toUri()
        try:
            if uri.getScheme() == "file":
                # a local rename replaces its target; a link does not
                os.link(uri.getPath(), self.fs.makeQualified(self.path(place)).toUri().getPath())
            else:
                options = self.gateway.new_array(getattr(self.jvm, "Options$Rename"), 0)
                self.jvm.FileContext.getFileContext(uri, self.conf).rename(
                    self.path(draft), self.path(place), options)
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            return False
        finally:
            self.delete(draft)

    def delete(self, place: str) -> None:
        self.fs.delete(self.path(place), True)


class VersionedTable:
    """One table; see the module's text. Buckets may not be renamed or
    redealt, so ``buckets`` is chosen when the table is made."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, path)

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS,
               notes: dict[str, int] | None = None) -> VersionedTable:
        """Version 1 from the rows of ``df``."""
        if BUCKET in df.columns:
            raise ValueError(f"{BUCKET} is the table's own column")
        table = cls(df.sparkSession, path)
        made = Manifest(1, "create", df.schema.json(), tuple(keys), buckets, {}, (), notes or {})
        parts = table._write(df, made)
        made = dataclasses.replace(made, parts=parts, touched=tuple(sorted(parts)))
        if not table.files.publish(made.text(), table._place(1)):
            raise Conflict(f"{path} is a table already")
        return table

    # --- versions ------------------------------------------------------------

    def _place(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/versions")
                      if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            version = max(self.versions())
        return Manifest.of(self.files.read(self._place(version)))

    def history(self) -> list[tuple[int, str, int, int]]:
        """(version, operation, buckets touched, rows) of the kept versions."""
        held = (self.manifest(v) for v in self.versions())
        return [(m.version, m.operation, len(m.touched), sum(p.rows for p in m.parts.values()))
                for m in held]

    # --- reading --------------------------------------------------------------

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of a version (the newest), or of some of its buckets."""
        return self._rows(self.manifest(version), buckets).drop(BUCKET)

    def _rows(self, m: Manifest, buckets: list[int] | None = None) -> DataFrame:
        schema = m.columns().add(BUCKET, T.IntegerType())
        folders = [self._folder(f) for b, p in sorted(m.parts.items())
                   if buckets is None or b in buckets for f in p.folders]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _folder(self, name: str) -> str:
        """A clone names the folders of its origin by their whole path."""
        return name if name.startswith("/") or ":" in name else f"{self.path}/data/{name}"

    def bucket_of(self, m: Manifest) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in m.keys]), F.lit(m.buckets)).cast("int")

    def _write(self, df: DataFrame, m: Manifest) -> dict[int, Part]:
        """Write rows by bucket; a large bucket is split over tasks."""
        name = uuid.uuid4().hex
        out = df.select("*", self.bucket_of(m).alias(BUCKET)).withColumn("b", F.col(BUCKET))
        out.hint("rebalance", "b").write.partitionBy("b").parquet(f"{self.path}/data/{name}")
        found = [n for n in self.files.names(f"{self.path}/data/{name}") if n.startswith("b=")]
        if not found:
            return {}
        # one row for each bucket
        row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
        schema = T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        sums = self.spark.read.schema(schema).parquet(
            *[f"{self.path}/data/{name}/{n}" for n in found]).groupBy(BUCKET).agg(
                F.count(F.lit(1)).alias("n"), F.sum(row_hash).alias("h")).collect()
        return {r[BUCKET]: Part((f"{name}/b={r[BUCKET]}",), r["n"], int(r["h"]) % HASH_RANGE)
                for r in sums}

    # --- commits --------------------------------------------------------------

    def _commit(self, base: Manifest, operation: str, replaced: dict[int, Part] | None = None,
                added: dict[int, Part] | None = None, read: set[int] | None = None,
                notes: dict[str, int] | None = None) -> Manifest:
        """Publish the next version. ``read`` has the buckets that the edit
        depends on (None: all of them); if one was touched since, Conflict."""
        replaced, added = replaced or {}, added or {}
        seen, head = base.version, base
        while True:
            held = self.versions()
            if held[-1] == head.version:
                parts = {b: p for b, p in {**head.parts, **replaced}.items() if p.folders}
                for b, p in added.items():
                    parts[b] = parts.get(b, Part()).plus(p)
                made = dataclasses.replace(
                    head, version=head.version + 1, operation=operation, parts=parts,
                    touched=tuple(sorted({*replaced, *added})),
                    notes={**head.notes, **(notes or {})})
                if self.files.publish(made.text(), self._place(made.version)):
                    return made
                held = self.versions()
            for v in range(seen + 1, held[-1] + 1):
                if v < held[0]:
                    raise Conflict(f"version {v} has expired")
                head = self.manifest(v)
                if read is None or set(head.touched) & read:
                    raise Conflict(f"version {v} ({head.operation}) changed what this edit read")
            seen = held[-1]

    def attempts(self, attempt: Callable[[Manifest], Any]):
        """``attempt`` on the newest version, again for each conflict."""
        for k in range(RETRIES):
            try:
                return attempt(self.manifest())
            except Conflict:
                time.sleep(0.02 * (k + 1))
        raise Conflict(f"{self.path}: {RETRIES} attempts failed")

    def edit(self, change: Callable[[DataFrame], DataFrame], operation: str,
             where: Column | None = None, keys: DataFrame | None = None,
             base: Manifest | None = None, serial: bool = False,
             notes: dict[str, int] | None = None) -> Manifest:
        """Replace the rows of some buckets by ``change`` of them: the buckets
        that hold a row with ``where``, or those of the given ``keys``, or all.
        With ``base`` one attempt on that version. A ``serial`` edit depends on
        the whole table, another one on the buckets that it rewrites."""
        def attempt(m: Manifest) -> Manifest:
            if keys is not None:
                hits = keys.select(self.bucket_of(m).alias(BUCKET))
            else:
                hits = self._rows(m) if where is None else self._rows(m).where(where)
            # at most one row for each bucket
            hit = sorted(r[0] for r in hits.select(BUCKET).distinct().collect())
            if not hit and not notes:
                return m
            rows = change(self._rows(m, hit).drop(BUCKET)).select(*_columns(m))
            new = self._write(rows, m)
            replaced = {b: new.get(b, Part()) for b in {*hit, *new}}
            return self._commit(m, operation, replaced, read=None if serial else {*replaced},
                                notes=notes)
        return attempt(base) if base else self.attempts(attempt)

    def update(self, column: str, value: Column, where: Column) -> Manifest:
        """UPDATE SET column = value WHERE .."""
        return self.edit(lambda df: update_where(df, where, column, value), "update", where=where)

    def delete(self, where: Column) -> Manifest:
        """DELETE WHERE ..; rows where the condition is NULL stay."""
        return self.edit(lambda df: delete_where(df, where), "delete", where=where)

    def insert(self, rows: DataFrame, unique: bool = False) -> Manifest:
        """Add rows (by column name); nothing is rewritten. ``unique`` leaves out
        rows whose key the table has, and repeats of a key; without it no insert
        conflicts with anything."""
        def attempt(m: Manifest) -> Manifest:
            new = _typed(rows, m)
            if unique:
                new = new.dropDuplicates(list(m.keys)).join(
                    self._rows(m).select(*m.keys), list(m.keys), "left_anti")
            added = self._write(new, m)
            return self._commit(m, "insert", added=added, read={*added} if unique else set())
        return self.attempts(attempt)

    def insert_with_ids(self, rows: DataFrame, id_col: str) -> Manifest:
        """Add rows under ids above all ids of the table (K10, K11): increasing,
        unique whatever other writers do, not gap-free, made inside each task."""
        def attempt(m: Manifest) -> Manifest:
            last = self._rows(m).agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
            stamped = rows.withColumn(id_col, last + F.monotonically_increasing_id() + 1)
            return self._commit(m, "insert", added=self._write(_typed(stamped, m), m))
        return self.attempts(attempt)

    def replace(self, rows: DataFrame) -> Manifest:
        """A new snapshot of all rows; buckets that stay the same keep their
        folders, the new copies of them are deleted."""
        m = self.manifest()
        new = self._write(_typed(rows, m), m)
        changed = {b: new.get(b, Part()) for b in {*m.parts, *new}
                   if not m.part(b).same_rows(new.get(b, Part()))}
        made = self._commit(m, "replace", changed)
        for b in {*new} - {*changed}:
            self.files.delete(self._folder(new[b].folders[0]))
        return made

    def clone(self, path: str) -> VersionedTable:
        """A table of its own that starts from this one's newest rows, without
        a copy of them; this one must not expire them meanwhile."""
        m = self.manifest()
        parts = {b: dataclasses.replace(p, folders=tuple(map(self._folder, p.folders)))
                 for b, p in m.parts.items()}
        table = VersionedTable(self.spark, path)
        made = dataclasses.replace(m, version=1, operation="clone", parts=parts,
                                   touched=tuple(sorted(parts)))
        if not table.files.publish(made.text(), table._place(1)):
            raise Conflict(f"{path} is a table already")
        return table

    # --- two versions -----------------------------------------------------------

    def changed_buckets(self, old: int, new: int) -> list[int]:
        a, b = self.manifest(old), self.manifest(new)
        return sorted(k for k in {*a.parts, *b.parts} if not a.part(k).same_rows(b.part(k)))

    def _both(self, old: int, new: int) -> tuple[Manifest, Manifest]:
        a, b = self.manifest(old), self.manifest(new)
        if (a.schema, a.keys, a.buckets) != (b.schema, b.keys, b.buckets):
            raise ValueError("the versions differ in schema, keys or buckets")
        return a, b

    def read_keys(self, version: int, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; buckets that hold none of them aren't read."""
        m = self.manifest(version)
        which = [r[0] for r in keys.select(self.bucket_of(m).alias(BUCKET)).distinct().collect()]
        return self._rows(m, which).drop(BUCKET).join(
            broadcast_if_small(keys.select(*m.keys).distinct()), list(m.keys), "left_semi")

    def changes(self, old: int, new: int) -> DataFrame:
        """One pass over the buckets that differ: keys, change (``new``,
        ``deleted`` or ``changed``) and the old and new row. Keys are unique."""
        a, b = self._both(old, new)
        which = self.changed_buckets(old, new)

        def side(m: Manifest, name: str) -> DataFrame:
            return self._rows(m, which).select(*m.keys, F.struct(*_columns(m)).alias(name))
        both = side(a, "old").join(side(b, "new"), list(a.keys), "full")
        kind = (F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "deleted")
                .otherwise("changed"))
        return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(
            *a.keys, kind.alias("change"), "old", "new")

    def changed_keys(self, old: int, new: int) -> DataFrame:
        """Keys, which need not be unique, whose rows differ between versions."""
        a, b = self._both(old, new)
        which = self.changed_buckets(old, new)
        rows = self._rows(a, which).withColumn("_sign", F.lit(-1)).unionByName(
            self._rows(b, which).withColumn("_sign", F.lit(1)))
        row_hash = F.xxhash64(*_columns(a)).cast("decimal(20,0)") * F.col("_sign")
        return rows.groupBy(*a.keys).agg(F.sum("_sign").alias("_n"), F.sum(row_hash).alias("_h")) \
            .where((F.col("_n") != 0) | (F.col("_h") != 0)).select(*a.keys)

    # --- space --------------------------------------------------------------------

    def expire(self, keep: int) -> list[str]:
        """Delete all but the newest ``keep`` versions and the folders that only
        those held; returns the folders. Readers of older versions must be done."""
        if keep < 1:
            raise ValueError("a table keeps at least one version")
        held = self.versions()
        manifests = {v: self.manifest(v) for v in held}

        def folders(versions: list[int]) -> set[str]:
            return {f for v in versions for p in manifests[v].parts.values() for f in p.folders}
        gone = sorted(f for f in folders(held[:-keep]) - folders(held[-keep:])
                      if self._folder(f) != f)      # not those of a clone's origin
        for v in held[:-keep]:
            self.files.delete(self._place(v))
        for f in gone:
            self.files.delete(self._folder(f))
        return gone
