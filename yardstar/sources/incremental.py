"""Incremental extraction: changed partitions only, merged by key and row hash into versions of a staging table.

A table is described by its key and by the column that says when a row was
last changed. Each extract reads the source's rows from the high-water mark of
the one before, less an overlap for late commits; compares their hashes with
those stored; and writes only the buckets of keys in which something changed.
A version is a list of bucket folders, so it shares what has not changed with
the versions before. Deletions leave no trace in changed rows: they are found
by comparing keys, in the extracts that ask for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from yardstar.sources.store import Store

BUCKET, HASH, SEEN = "__bucket", "__hash", "__seen"


@dataclass(frozen=True)
class Tracked:
    """How one table is followed: its key, its change column, the overlap read again, and its buckets."""

    name: str
    key: Sequence[str]
    changed_at: str
    overlap: str = "INTERVAL 1 DAY"
    buckets: int = 64


@dataclass(frozen=True)
class Extracted:
    """What one extract found: rows by kind of change, and the buckets it wrote."""

    version: str
    inserted: int
    updated: int
    deleted: int
    buckets: tuple[int, ...]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns, by name, so their order doesn't matter; maps and structs count by their JSON."""
    parts = []
    for name in sorted(df.columns):
        kind = df.schema[name].dataType.typeName()
        c = F.col(f"`{name}`")
        parts += [c.isNotNull(), F.to_json(F.struct(c)) if kind in ("map", "struct", "array", "variant") else c]
    return F.xxhash64(*parts)


class StagingTable:
    """The versions of one tracked table in a store."""

    def __init__(self, store: Store, tracked: Tracked, schema: StructType):
        self.store = store
        self.tracked = tracked
        self.schema = schema
        self.spark = store.spark
        self._stored = StructType([*schema.fields]).add(HASH, "long").add(BUCKET, "integer")

    # -- reading -----------------------------------------------------------------
    def _entry(self) -> dict | None:
        return self.store.entry(self.tracked.name)

    def _rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Stored rows, of the given buckets only if any are named."""
        entry = self._entry()
        parts = entry["parts"] if entry else {}
        paths = [parts[str(b)] for b in (range(self.tracked.buckets) if buckets is None else buckets) if str(b) in parts]
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*(f"{self.store.root}/{p}" for p in paths))

    def current(self) -> DataFrame:
        """All rows of the newest version."""
        return self._rows().select(*self.schema.fieldNames())

    # -- extracting ----------------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.tracked.key), F.lit(self.tracked.buckets)).cast("int")

    def extract(self, source: DataFrame, find_deleted: bool = False) -> Extracted:
        """Merge what has changed in ``source`` into a new version and publish it.

        Rows from the mark less the overlap on are read, as a filter that
        reaches the source; rows without a change time are always read. A key
        that comes twice counts once, with its latest change, then the highest
        row hash. A row whose hash is the stored one changes nothing. With
        ``find_deleted`` the source's keys alone are read as well, and stored
        keys that it no longer has are dropped. NULLs are values of a key.

        A first extract reads everything. An extract that finds nothing
        publishes no version. Two extracts at once: the second to publish
        fails, and what it wrote is never read.
        """
        t = self.tracked
        entry = self._entry()
        mark = entry["mark"] if entry else None
        read = source.select(*self.schema.fieldNames())
        if mark is not None:
            since = F.expr(f"CAST('{mark}' AS TIMESTAMP_NTZ) - {t.overlap}")
            read = read.where((F.col(t.changed_at) >= since) | F.col(t.changed_at).isNull())
        read = read.withColumn(HASH, row_hash(read)).withColumn(BUCKET, self._bucket())
        read = self._once(read)
        version = self.store.begin()
        # Written once: the comparison, the mark and the merge read the same rows.
        read = self.store.write(read, f"{t.name}_lido", version)
        buckets = [r[0] for r in read.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
        stored = self._rows(buckets)
        same = self._same(read, stored)
        touched = read.join(stored.select(*(F.col(k).alias(f"__s_{k}") for k in t.key), F.col(HASH).alias("__old")), same, "left")
        changes = touched.where(F.col("__old").isNull() | (F.col("__old") != F.col(HASH)))
        changes = self.store.write(
            changes.select(*self._stored.fieldNames(), F.col("__old").isNull().alias("__new")), f"{t.name}_mudou", version
        )
        gone = self._gone(source, version) if find_deleted else None
        found = changes.groupBy(BUCKET).agg(F.count_if("__new").alias("new"), F.count_if(~F.col("__new")).alias("old"))
        by_bucket = {r[0]: (r["new"], r["old"]) for r in found.collect()}  # one row a bucket
        dropped = {} if gone is None else {r[0]: r[1] for r in gone.groupBy(BUCKET).count().collect()}
        dirty = sorted(set(by_bucket) | set(dropped))
        latest = read.agg(F.max(t.changed_at)).first()[0]
        latest = max(filter(None, (mark, None if latest is None else latest.isoformat(sep=" "))), default=None)
        result = Extracted(
            version, sum(v[0] for v in by_bucket.values()), sum(v[1] for v in by_bucket.values()), sum(dropped.values()), tuple(dirty)
        )
        if not dirty and entry is not None:
            return result
        parts = dict(entry["parts"]) if entry else {}
        if dirty:
            path = f"{version}/{t.name}"
            self._merge(changes, gone, dirty).write.partitionBy(SEEN).parquet(f"{self.store.root}/{path}")
            parts |= {str(b): f"{path}/{SEEN}={b}" for b in dirty}
            if dropped:  # a bucket may have lost its last row
                there = self.spark.read.schema(StructType([*self._stored.fields]).add(SEEN, "integer"))
                left = {r[0] for r in there.parquet(f"{self.store.root}/{path}").select(SEEN).distinct().collect()}
                parts = {b: p for b, p in parts.items() if int(b) not in dirty or int(b) in left}
        self.store.commit(t.name, {"version": version, "mark": latest, "parts": parts}, entry)
        return result

    def _same(self, a: DataFrame, stored: DataFrame) -> Column:
        same = F.lit(True)
        for k in self.tracked.key:
            same = same & a[k].eqNullSafe(F.col(f"__s_{k}"))
        return same

    def _once(self, read: DataFrame) -> DataFrame:
        """One row for each key: the latest change, then the highest hash; NULL change times are the earliest."""
        t = self.tracked
        rest = [c for c in read.columns if c not in t.key and c not in (HASH, BUCKET)]
        order = F.struct(F.col(t.changed_at).alias("__c"), F.col(HASH).alias("__h"))
        kept = F.max_by(F.struct(*rest, HASH, BUCKET), order) if rest else F.first(F.struct(HASH, BUCKET))
        return read.groupBy(*t.key).agg(kept.alias("__r")).select(*t.key, "__r.*").select(*read.columns)

    def _gone(self, source: DataFrame, version: str) -> DataFrame:
        """Keys that are stored and that the source no longer has, with their bucket; only keys are read and shuffled."""
        t = self.tracked
        there = source.select(*(F.col(k).alias(f"__s_{k}") for k in t.key)).distinct()
        mine = self._rows().select(*t.key, BUCKET)
        return self.store.write(mine.join(there, self._same(mine, there), "left_anti"), f"{t.name}_sumiu", version)

    def _merge(self, changes: DataFrame, gone: DataFrame | None, dirty: Sequence[int]) -> DataFrame:
        """The new rows of the dirty buckets: what stays as it is, and what changed."""
        t = self.tracked
        old = self._rows(dirty)
        out = changes.select(*t.key) if gone is None else changes.select(*t.key).unionByName(gone.select(*t.key))
        out = out.select(*(F.col(k).alias(f"__s_{k}") for k in t.key))
        kept = old.join(out, self._same(old, out), "left_anti")
        rows = kept.unionByName(changes.select(*kept.columns)).withColumn(SEEN, F.col(BUCKET))
        return rows.hint("rebalance", BUCKET)
