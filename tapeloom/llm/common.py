"""What the operators of this folder share: code shipping, the shared folder, words and hashes."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tapeloom.shipping import ship

ship(__name__)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, a new local one if the master is local, else an error: executors of a cluster do not share a local folder."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="tapeloom-")
        spark.sparkContext.setCheckpointDir(f"file://{where}")
        where = spark.sparkContext.getCheckpointDir()
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, executors may go."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Deletes ``written`` tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for f in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def per_process(key: str, make):
    """``make()`` once for each Python worker process, which serves many tasks."""
    held = sys.__dict__.setdefault("_tapeloom_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


#: A-Z to a-z and nothing else.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8; bytes.split() cuts at just these six characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class WordHash(dict):
    """XXH64 of words, remembered; forgets all when it has grown to ``most`` words."""

    def __init__(self, seed: int = 0, most: int = 150_000):
        import xxhash

        self._of, self.seed, self.most = xxhash.xxh64_intdigest, seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = self._of(word, self.seed)
        return h
