"""Session settings and the few helpers that every operator shares."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "synaxis", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings this library assumes (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one set on the context.

    Only a local master, where every task runs on this machine, may do without: it gets a folder of
    its own. Any other raises, as tables written to one machine's disk cannot be read from another.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return configured or current.get()
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {sc.master} share")
    path = configured or os.path.join(tempfile.gettempdir(), f"synaxis-checkpoint-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(path)
    return path


def _drop_at_exit() -> None:
    for spark, path in _LEFT:
        try:
            drop_path(spark, path)
        except Exception:  # the session may already be gone
            pass


_LEFT: list[tuple[SparkSession, str]] = []
atexit.register(_drop_at_exit)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with the file system that owns it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that owns it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def file_signature(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, last change) of a table's path, by which a changed table is told from an unchanged one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return (0, 0, 0)
    n = size = changed = 0
    walk = fs.listFiles(target, True)
    while walk.hasNext():
        f = walk.next()
        n, size, changed = n + 1, size + f.getLen(), max(changed, f.getModificationTime())
    return (n, size, changed)


class Cut:
    """A DataFrame written once as a Parquet table in the shared checkpoint folder.

    Reading it back has no lineage beyond the files, so a lost executor costs only the
    tasks it ran. ``drop`` removes the table when a later one has replaced it; what is
    left is removed when the driver ends.
    """

    def __init__(self, df: DataFrame, *by: str):
        """Write ``df``, in folders by the columns ``by`` if any are given."""
        spark = df.sparkSession
        self.path = f"{checkpoint_dir(spark)}/synaxis-{uuid.uuid4().hex}"
        self._spark = spark
        df.write.partitionBy(*by).parquet(self.path) if by else df.write.parquet(self.path)
        _LEFT.append((spark, self.path))
        self._schema = df.schema
        self.df = self.read()

    def read(self) -> DataFrame:
        """The table as a DataFrame of its own."""
        return self._spark.read.schema(self._schema).parquet(self.path)

    def drop(self) -> None:
        drop_path(self._spark, self.path)
        _LEFT[:] = [x for x in _LEFT if x[1] != self.path]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, without lineage."""
    return Cut(df).df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q(name: str):
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
