"""Written tables in the cluster's shared folder: they cut lineage, survive a
lost executor, and keep a narrow copy of what later steps read again."""

from __future__ import annotations

import gc
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import shared_dir

_SHIPPED: dict[str, str] = {}


def own_folder(spark: SparkSession) -> str:
    """The folder of this application: no other session's tables lie in it."""
    return f"{shared_dir(spark)}/tillroll-llm/{spark.sparkContext.applicationId}"


def folder(spark: SparkSession, name: str) -> str:
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex[:16]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete every table that this application wrote through this subpackage; call
    it when the results that were derived from them have been stored."""
    delete(spark, own_folder(spark))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when the driver
    collects the objects that stand for them, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Temporary:
    """``written`` for tables that are deleted when they have been used: by ``drop`` or
    at the end of a ``with`` block. After each write the shuffle files that made the
    table are freed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> "Temporary":
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = folder(self.spark, name)
        df.write.parquet(path)
        free_shuffles(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                delete(self.spark, self.paths.pop(name))

    def __exit__(self, *_) -> None:
        self.drop(*list(self.paths))
        free_shuffles(self.spark)


def ready(spark: SparkSession) -> None:
    """What operators with Python tasks need: this package on every executor, and
    Arrow batches of a few MB, so that long texts can't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    sc = spark.sparkContext
    if _SHIPPED.get(sc.applicationId) is None:
        root = pathlib.Path(__file__).resolve().parents[1]
        name = pathlib.Path(tempfile.mkdtemp(prefix="tillroll-code-")) / "tillroll-code.zip"
        with zipfile.ZipFile(name, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(name))  # Spark itself copies it to the executors
        _SHIPPED[sc.applicationId] = str(name)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for own use that clash with none of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
