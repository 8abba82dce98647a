"""Copies of bronze tables that are bucketed and sorted on one column.

Several plans meet orders, order lines and payments on ``order_id``: the fact, the
orphan checks, the relationship tests, the per-order models. Each would shuffle
both sides anew. A clustered copy is written once for a table version (one shuffle);
Spark then knows that rows of one id lie in one bucket, so joins and groupings on
the column between copies with the same number of buckets need no exchange.

A copy is a Parquet folder beside the version, and a table of the session catalog
that tells Spark its buckets. A version is immutable, so is its copy.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources import fs
from tillroll.sources.tables import TableStore

DATABASE = "tillroll_clustered"
_LOCK = threading.Lock()


#: buckets aren't made smaller than this, as long as every core has one
LEAST_BYTES = 32 << 20


def bucket_count(spark: SparkSession, size: int | None = None) -> int:
    """As many buckets as a shuffle has partitions, which is sized to the data; fewer
    where the largest table, of ``size`` bytes, is small for that."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size is None:
        return parts
    return min(parts, max(spark.sparkContext.defaultParallelism, -(-size // LEAST_BYTES)))


def _place(store: TableStore, version_path: str, column: str, buckets: int) -> tuple[str, str]:
    path = f"{store.root}/clustered/{version_path.removeprefix(store.root + '/')}-{column}-{buckets}"
    return path, f"{DATABASE}.t_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _register(spark: SparkSession, path: str, table: str, column: str, buckets: int) -> None:
    """The table over a finished copy, in a session that doesn't have it."""
    with _LOCK:
        if spark.catalog.tableExists(table):
            return
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
                  f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{path}'")


def cluster(store: TableStore, layer: str, name: str, column: str, buckets: int | None = None) -> DataFrame:
    """The current version of ``layer.name``, bucketed and sorted on ``column``;
    written unless its copy is there. One task writes one bucket, so a bucket is one
    file; null values of the column share a bucket."""
    spark = store.spark
    n = buckets or bucket_count(spark)
    version = store.current_path(layer, name)
    if version is None:
        raise FileNotFoundError(f"no committed version of {layer}.{name} under {store.root}")
    path, table = _place(store, version, column, n)
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        rows = store.read(layer, name).repartition(n, column).sortWithinPartitions(column)
        rows.write.bucketBy(n, column).sortBy(column).option("path", path).mode("overwrite").saveAsTable(table)
    _register(spark, path, table, column, n)
    return spark.table(table)


def clustered(store: TableStore, layer: str, name: str, column: str, buckets: int | None = None) -> DataFrame | None:
    """The clustered copy of the current version if it was written, else None."""
    version = store.current_path(layer, name)
    if version is None:
        return None
    n = buckets or bucket_count(store.spark)
    path, table = _place(store, version, column, n)
    if not fs.exists(store.spark, f"{path}/_SUCCESS"):
        return None
    _register(store.spark, path, table, column, n)
    return store.spark.table(table)


def drop(store: TableStore) -> None:
    """Delete all copies of a store and their tables."""
    spark, base = store.spark, f"{store.root}/clustered"
    for layer in fs.list_dirs(spark, base):
        for name in fs.list_dirs(spark, f"{base}/{layer}"):
            for d in fs.list_dirs(spark, f"{base}/{layer}/{name}"):
                path = f"{base}/{layer}/{name}/{d}"
                spark.sql(f"DROP TABLE IF EXISTS {DATABASE}.t_{hashlib.sha256(path.encode()).hexdigest()[:24]}")
    fs.delete(spark, base)
