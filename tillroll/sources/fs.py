"""Small file-system calls through Hadoop's FileSystem API, so paths work on
any store the cluster mounts (HDFS, object stores, local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists. Atomic where the file system's own
    creation is (HDFS, local disks): of several callers one gets True."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        return bool(fs.createNewFile(p))
    except Exception:  # noqa: BLE001 - some file systems raise instead
        if fs.exists(p):
            return False
        raise


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Files, bytes and time of ``path``: changes when its content is replaced. Two
    calls to the file system, whatever the number of files; a folder's own time moves
    when a file of it is added, removed or replaced."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return "absent"
    content = fs.getContentSummary(p)
    return f"{content.getFileCount()}:{content.getLength()}:{fs.getFileStatus(p).getModificationTime()}"


def first_non_blank(spark: SparkSession, path: str) -> bytes:
    """The first byte of a file that isn't white space or a byte order mark (b"" if
    there is none), however far in it lies."""
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isDirectory():
        files = [s.getPath() for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        if not files:
            return b""
        p = sorted(files, key=lambda x: str(x))[0]
    stream = fs.open(p)
    try:
        while True:
            b = stream.read()
            if b < 0:
                return b""
            if bytes([b]) not in (b" ", b"\t", b"\n", b"\r", b"\xef", b"\xbb", b"\xbf"):
                return bytes([b])
    finally:
        stream.close()
