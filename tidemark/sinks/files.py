"""Small file-system helpers over the Hadoop API (local, HDFS and object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_dirs(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names of the ``<prefix>..`` directories under ``root``."""
    fs, p, _ = _fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def glob_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the directories that match ``pattern``."""
    fs, p, _ = _fs(spark, pattern)
    return sorted(str(st.getPath().toString()) for st in fs.globStatus(p) or [] if st.isDirectory())


def list_batches(spark: SparkSession, root: str, prefix: str = "batch=") -> list[int]:
    """Ids of complete ``<prefix><id>`` directories (``_SUCCESS`` present) under ``root``."""
    fs, _, jvm = _fs(spark, root)
    return [int(name[len(prefix):]) for name in list_dirs(spark, root, prefix)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/_SUCCESS"))]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` if missing (a stream may start before its topic has data)."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        fs.mkdirs(p)


def newest_file(spark: SparkSession, path: str) -> int:
    """Time (ms) of the newest file under ``path``; 0 if there is none."""
    fs, p, _ = _fs(spark, path)
    newest = 0
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            newest = max(newest, files.next().getModificationTime())
    return newest
