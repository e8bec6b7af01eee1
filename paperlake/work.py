"""Tables written to the shared folder, so that lineage is cut and executors may be lost."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list = []


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: spark.checkpoint.dir. Where that is unset a local session (tests, one machine) gets
    a folder of its own; on a cluster it must be named."""
    conf = spark.sparkContext.getConf()
    d = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="paperlake-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


class Work:
    """Named intermediate tables of one query. They are deleted when nothing reads them any more, at the latest at
    the end of the driver (results are read lazily, so not before)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/paperlake/{name}-{uuid.uuid4().hex[:12]}"
        _made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back: the plan above starts from files."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables nothing reads any more."""
        for name in names:
            delete(self.spark, self.path(name))


def delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


@atexit.register
def _clear() -> None:
    """What is left of the tables of this driver; a session that has already ended keeps its folder's own rules."""
    for w in _made:
        try:
            delete(w.spark, w.root)
        except Exception:  # noqa: BLE001  (the session is gone)
            return
