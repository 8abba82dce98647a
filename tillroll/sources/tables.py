"""Layered table store on Parquet (S-5, S-6, S-7, S-10, S-11).

Layers are folders under one root (``raw``, ``marts``, ``audit``, ``landing``).
Upserted tables are versioned: every write goes to a new ``vNNNNNN`` folder and
the version becomes current only after all its files are there and its
``_SUCCESS`` was written; readers pick the newest committed version each time they
ask. A failed or killed write therefore never exposes half a table, and a rerun is
idempotent. Append-only audit tables use plain Parquet appends.

Several stores may write one table. A version is made from a base version and
commits only if nothing else was committed since: of the writers of one base, one
creates the base's ``_next`` file, and the others start again from the new version
(``upsert``, appending ``load``, ``truncate``) or fail (``write``). So no batch is lost.

A table that batches have been upserted into is split by a hash of its key into
buckets, folders of about ``bucket_bytes`` each. An upsert reads and writes the
buckets of its keys alone; the new version refers to the other buckets where they
are.
"""

from __future__ import annotations

import datetime as dt
import math
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.calendar import utc
from tillroll.operators.joins import fits_broadcast
from tillroll.sources import fs

PART = "_part"
# A tagged version holds a whole validated batch, partitioned by STATUS;
# plain reads see only its valid rows (partition pruning), without tag columns.
STATUS = "_status"
TAG_COLUMNS = ("_reasons", "_reason", "_raw")
# in a version that was appended to: the names of the earlier folders it includes
PARTS = "_parts.txt"
# bucket folders of a version, and a file with the number of buckets
BUCKET = "_bucket"
BUCKETS = "_buckets.txt"
BUCKET_BYTES = 128 << 20
MOST_BUCKETS = 4096
_TRIES = 20


class ConcurrentWriteError(RuntimeError):
    """Another writer committed a version of the table in the meantime."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str, bucket_bytes: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_bytes = int(bucket_bytes or spark.conf.get("tillroll.store.bucketBytes", str(BUCKET_BYTES)))
        # committed versions are immutable: what is known of them stays true. Which
        # one is current is looked up anew.
        self._frames: dict[str, DataFrame] = {}
        self._layouts: dict[str, tuple[list[str], int]] = {}

    # -- paths -------------------------------------------------------------
    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _numbers(self, layer: str, name: str) -> list[int]:
        """Numbers of all version folders, committed or not, ascending."""
        return sorted(int(d[1:]) for d in fs.list_dirs(self.spark, self.path(layer, name)) if d.startswith("v") and d[1:].isdigit())

    def _version_path(self, layer: str, name: str, v: int) -> str:
        return f"{self.path(layer, name)}/v{v:06d}"

    def _committed(self, layer: str, name: str, v: int) -> bool:
        return fs.exists(self.spark, f"{self._version_path(layer, name, v)}/_SUCCESS")

    def versions(self, layer: str, name: str) -> list[int]:
        return [v for v in self._numbers(layer, name) if self._committed(layer, name, v)]

    def current_version(self, layer: str, name: str) -> int:
        """The newest committed version, 0 if there is none."""
        return next((v for v in reversed(self._numbers(layer, name)) if self._committed(layer, name, v)), 0)

    def current_path(self, layer: str, name: str) -> str | None:
        v = self.current_version(layer, name)
        return self._version_path(layer, name, v) if v else None

    def exists(self, layer: str, name: str) -> bool:
        return self.current_version(layer, name) > 0

    # -- read / write ------------------------------------------------------
    def _layout(self, version_path: str) -> tuple[list[str], int]:
        """The data folders of a version, oldest first, and its number of buckets
        (0: not in buckets). Bucket folders are listed one by one."""
        if version_path not in self._layouts:
            listed, buckets = f"{version_path}/{PARTS}", f"{version_path}/{BUCKETS}"
            earlier = fs.read_text(self.spark, listed).split() if fs.exists(self.spark, listed) else []
            base = version_path.rsplit("/", 1)[0]
            parts = [f"{base}/{v}" for v in earlier]
            n = int(fs.read_text(self.spark, buckets)) if fs.exists(self.spark, buckets) else 0
            own = [d for d in fs.list_dirs(self.spark, version_path) if d.startswith(f"{BUCKET}=")]
            parts += [f"{version_path}/{d}" for d in own] if n else [version_path]
            self._layouts[version_path] = (parts, n)
        return self._layouts[version_path]

    def folders(self, layer: str, name: str) -> list[str]:
        """The data folders of the current version (none if there is none)."""
        p = self.current_path(layer, name)
        return self._layout(p)[0] if p is not None else []

    def _folder(self, path: str) -> DataFrame:
        df = self.spark.read.parquet(path)
        if self.is_tagged(path):
            df = df.filter(F.col(STATUS) == "valid")
        return df.drop(STATUS, *TAG_COLUMNS)

    def _read_parts(self, parts: Sequence[str]) -> DataFrame:
        tagged = [f for f in parts if f"/{BUCKET}=" not in f and self.is_tagged(f)]
        plain = [f for f in parts if f not in tagged]
        frames = [self._folder(f) for f in tagged]
        if plain:
            # folders of one table differ in columns only where a batch was appended
            mixed = len(plain) > 1 and any(f"/{BUCKET}=" not in f for f in plain)
            frames.append(self.spark.read.option("mergeSchema", mixed).parquet(*plain).drop(*TAG_COLUMNS))
        df = frames[0]
        for more in frames[1:]:
            df = df.unionByName(more, allowMissingColumns=True)
        return df

    def read(self, layer: str, name: str) -> DataFrame:
        p = self.current_path(layer, name)
        if p is None:
            raise FileNotFoundError(f"no committed version of {layer}.{name} under {self.root}")
        return self._read_version(p)

    def _read_version(self, p: str) -> DataFrame:
        if p not in self._frames:
            self._frames[p] = self._read_parts(self._layout(p)[0])
        return self._frames[p]

    def is_tagged(self, version_path: str) -> bool:
        return any(d.startswith(f"{STATUS}=") for d in fs.list_dirs(self.spark, version_path))

    def read_batch(self, layer: str, name: str) -> DataFrame:
        """The whole tagged batch of the current version (valid and rejected
        rows, with ``_status`` and the tag columns)."""
        p = self.current_path(layer, name)
        if p is None or not self.is_tagged(p):
            raise FileNotFoundError(f"{layer}.{name} has no tagged current version")
        return self.spark.read.parquet(p)

    def write(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), parts: Sequence[str] = (),
              base: int | None = None, buckets: int = 0) -> str:
        """Write ``df`` as the next version of ``layer.name`` (replace semantics);
        ``parts`` are earlier folders that the version includes. ``base`` is the version
        that ``df`` was made from (None: the current one); raises ConcurrentWriteError
        if another version was committed after it. ``buckets``: ``df`` has the column
        BUCKET, and the version is in so many."""
        table = self.path(layer, name)
        if base is None:
            base = self.current_version(layer, name)
        # a folder left by a failed or an unfinished attempt is skipped
        v = max([base, *self._numbers(layer, name)]) + 1
        while not fs.create_new(self.spark, f"{table}/v{v:06d}/_writer"):
            v += 1
        target = self._version_path(layer, name, v)
        # before the commit: a version without its lists is never visible
        if parts:
            fs.write_text(self.spark, f"{target}/{PARTS}", "\n".join(f.removeprefix(f"{table}/") for f in parts))
        if buckets:
            fs.write_text(self.spark, f"{target}/{BUCKETS}", str(buckets))
        w = df.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if buckets:
            w = w.partitionBy(BUCKET)
        elif partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target)
        if not self._commit(layer, name, base, v):
            fs.delete(self.spark, target)
            raise ConcurrentWriteError(f"{layer}.{name}: a version after v{base:06d} was committed meanwhile")
        return target

    def _commit(self, layer: str, name: str, base: int, v: int) -> bool:
        """Make version ``v`` the successor of ``base``; False if that has another."""
        claim = f"{self.path(layer, name)}/_next/{base:06d}"
        if fs.create_new(self.spark, claim):
            fs.write_text(self.spark, claim, str(v))
            fs.write_text(self.spark, f"{self._version_path(layer, name, v)}/_SUCCESS", "")
            return True
        for _ in range(100):  # the other writer has its files and needs moments
            if self.current_version(layer, name) > base:
                return False
            time.sleep(0.1)
        # it died between the claim and the mark: its files are complete, so the mark
        # can be set for it
        other = fs.read_text(self.spark, claim).strip()
        if not other:
            raise ConcurrentWriteError(f"{claim} was left by a writer that died; delete it and run again")
        if fs.exists(self.spark, f"{self._version_path(layer, name, int(other))}/_writer"):
            fs.write_text(self.spark, f"{self._version_path(layer, name, int(other))}/_SUCCESS", "")
            return False
        raise ConcurrentWriteError(f"{claim} names a version that is gone; delete it and run again")

    def _retried(self, attempt: Callable[[], DataFrame]) -> DataFrame:
        """``attempt`` until no other writer came between its read and its commit."""
        for _ in range(_TRIES - 1):
            try:
                return attempt()
            except ConcurrentWriteError:
                time.sleep(0.05)
        return attempt()

    def append(self, df: DataFrame, layer: str, name: str, part: str | None = None) -> None:
        """Append rows. Concurrent writers must use distinct ``part`` values:
        each job commits under its own folder."""
        target = self.path(layer, name) + (f"/{PART}={part}" if part else "")
        df.write.mode("append").parquet(target)

    def read_appended(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        p = self.path(layer, name)
        if not fs.exists(self.spark, p):
            if schema is None:
                raise FileNotFoundError(p)
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.parquet(p)
        return df.drop(PART) if PART in df.columns else df

    # -- raw-layer loads ---------------------------------------------------
    def load(self, df: DataFrame, name: str, if_exists: str = "append", layer: str = "raw") -> DataFrame:
        """S-6: append to or replace a table; returns the new table. An empty
        batch changes nothing. An append writes the batch alone: the new version
        refers to the folders of the one before."""
        if if_exists not in ("append", "replace"):
            raise ValueError("if_exists must be 'append' or 'replace'")

        def attempt() -> DataFrame:
            base = self.current_version(layer, name)
            if base and df.isEmpty():
                return self.read(layer, name)
            before = self._layout(self._version_path(layer, name, base))[0] if base and if_exists == "append" else []
            return self._read_version(self.write(df, layer, name, parts=before, base=base))

        return self._retried(attempt)

    def truncate(self, name: str, layer: str = "raw") -> None:
        """S-7: the next version is empty, same schema."""
        def attempt() -> DataFrame:
            base = self.current_version(layer, name)
            if not base:
                raise FileNotFoundError(f"no committed version of {layer}.{name} under {self.root}")
            schema = self._read_version(self._version_path(layer, name, base)).schema
            return self._read_version(self.write(self.spark.createDataFrame([], schema), layer, name, base=base))

        self._retried(attempt)

    def upsert(
        self,
        batch: DataFrame,
        name: str,
        pk: Sequence[str],
        table_schema: T.StructType,
        run_ts: dt.datetime,
        layer: str = "raw",
        order: str | None = None,
    ) -> DataFrame:
        """S-5: insert new keys, update existing ones; only columns present in
        the batch are overwritten (a null *in* the batch does overwrite).

        Of rows that repeat a key the last wins, by the batch column ``order`` or
        else by position in the batch's scan. An empty batch makes no new version.
        ``created_at`` keeps the first load time, ``updated_at`` is bumped on
        every write of the row. Returns the new table version (lazy read).

        Of a table in buckets only those of the batch's keys are read and written.
        A table that isn't, or has outgrown its buckets, is dealt into buckets by this
        write (one bucket: none). If another writer commits meanwhile, the batch is
        merged again, into that writer's version.
        """
        pk = list(pk)
        cols = [f.name for f in table_schema.fields]
        present = [c for c in cols if c in batch.columns]
        rest = [c for c in present if c not in pk]
        last = F.col(order) if order else F.monotonically_increasing_id()
        # one row per key; repeated keys combine before the shuffle
        src = (
            batch.select(*present, last.alias("_last")).groupBy(*pk)
            .agg(F.max_by(F.struct(F.lit(True).alias("_row"), *rest), "_last").alias("_w"))
            .select(*pk, *[F.col(f"_w.{c}").alias(c) for c in rest])
        )

        def attempt() -> DataFrame:
            base = self.current_version(layer, name)
            if base and batch.isEmpty():
                return self.read(layer, name)
            if not base:
                return self._read_version(self.write(self._first(src, table_schema, utc(run_ts)), layer, name, base=0))
            parts, buckets = self._layout(self._version_path(layer, name, base))
            mine, others = parts, []
            if buckets and all(f"/{BUCKET}=" in f for f in parts):
                touched = src.select(bucket_of(pk, buckets).alias(BUCKET)).distinct()
                hit = {f"{BUCKET}={r[0]}" for r in touched.collect()}  # MOST_BUCKETS at most
                mine = [f for f in parts if f.rsplit("/", 1)[-1] in hit]
                others = [f for f in parts if f not in mine]
            size = sum(fs.size(self.spark, f) for f in mine)
            if not others or size > 4 * self.bucket_bytes * len(mine) and buckets < MOST_BUCKETS:
                # all of it anyway, or its buckets are too large by now
                size += sum(fs.size(self.spark, f) for f in others)
                mine, others = parts, []
                wanted = min(MOST_BUCKETS, math.ceil(size / self.bucket_bytes))
                buckets = wanted if wanted > 1 else 0
            new = self._merged(self._read_parts(mine), src, pk, table_schema, utc(run_ts)) if mine else self._first(src, table_schema, utc(run_ts))
            if buckets:
                new = new.withColumn(BUCKET, bucket_of(pk, buckets)).repartition(BUCKET)
            return self._read_version(self.write(new, layer, name, parts=others, base=base, buckets=buckets))

        return self._retried(attempt)

    @staticmethod
    def _first(src: DataFrame, schema: T.StructType, ts: Column) -> DataFrame:
        return src.select(
            *[F.col(f.name) if f.name in src.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
            ts.alias("created_at"), ts.alias("updated_at"))

    @staticmethod
    def _merged(target: DataFrame, src: DataFrame, pk: list[str], schema: T.StructType, ts: Column) -> DataFrame:
        """The rows of ``target`` with ``src`` (one row per key) merged in."""
        cols = [f.name for f in schema.fields]
        present = [c for c in cols if c in src.columns]
        keys = src.select(*pk)
        if fits_broadcast(keys):
            # small batch: both passes over the target are map-only joins
            # against the broadcast batch keys; the target is never shuffled
            kept = target.join(F.broadcast(keys), pk, "left_anti")
            old = target.join(F.broadcast(keys), pk, "left_semi").select(*pk, *[c for c in cols if c not in present], "created_at")
            merged = src.join(old, pk, "left").select(
                *[F.col(c) for c in cols],
                F.coalesce(F.col("created_at"), ts).alias("created_at"),
                ts.alias("updated_at"),
            )
            return kept.select(*cols, "created_at", "updated_at").unionByName(merged)
        # large batch: one full outer join, one shuffle per side
        s_ = src.select(*[F.col(c).alias(f"_n_{c}") if c not in pk else F.col(c) for c in present],
                        F.lit(True).alias("_in_batch"))
        j = target.join(s_, pk, "full_outer")
        hit = F.col("_in_batch").isNotNull()
        return j.select(
            *[
                F.col(c) if c in pk
                else (F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)) if c in present else F.col(c)).alias(c)
                for c in cols
            ],
            F.coalesce(F.col("created_at"), ts).alias("created_at"),
            F.when(hit, ts).otherwise(F.col("updated_at")).alias("updated_at"),
        )

    # -- retention -----------------------------------------------------------
    def expire(self, layer: str, name: str, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` versions, except folders that a kept
        version refers to; returns the versions of which nothing is left. Readers of
        an older version must be done."""
        if keep < 1:
            raise ValueError("keep must be 1 or more")
        kept = self.versions(layer, name)[-keep:]
        needed = {f for v in kept for f in self._layout(self._version_path(layer, name, v))[0]}
        gone = []
        for v in self._numbers(layer, name):
            p = self._version_path(layer, name, v)
            if v in kept or p in needed or not (self._committed(layer, name, v) or fs.exists(self.spark, f"{p}/_expired")):
                continue  # an uncommitted folder may be a writer at work
            self._frames.pop(p, None)
            if not any(f.startswith(f"{p}/") for f in needed):
                fs.delete(self.spark, p)
                gone.append(v)
                continue
            # no whole version any more: of its buckets those stay that a kept one refers to
            fs.write_text(self.spark, f"{p}/_expired", "")
            fs.delete(self.spark, f"{p}/_SUCCESS")
            for d in fs.list_dirs(self.spark, p):
                if d.startswith(f"{BUCKET}=") and f"{p}/{d}" not in needed:
                    fs.delete(self.spark, f"{p}/{d}")
        return gone


def bucket_of(pk: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*pk), F.lit(buckets))
