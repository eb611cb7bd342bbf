"""Session settings, the shared working folder, and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_dirs: dict[str, str] = {}


def build_session(app: str = "peopleflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Nothing here is required: every operator also runs on a session made elsewhere.
    Keyword names use ``__`` for the dots of a Spark setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors share one disk, may leave it unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="peopleflow-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path not used before, in the shared folder, grouped by application."""
    app = spark.conf.get("spark.app.id", "local")
    return f"{shared_dir(spark)}/peopleflow-{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table; ``options`` are the writer's.

    Cuts the lineage, survives the loss of executors, and keeps the columnar scan (pruning,
    pushdown) for whatever reads it next.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove what this application staged, once no result built on it is needed."""
    app = spark.conf.get("spark.app.id", "local")
    _delete(spark, f"{shared_dir(spark)}/peopleflow-{app}")


def unstage(df: DataFrame) -> None:
    """Remove the staged tables that ``df`` reads, once nothing else does; other files stay."""
    spark = df.sparkSession
    own = f"/peopleflow-{spark.conf.get('spark.app.id', 'local')}/"
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if own in folder:
            _delete(spark, folder)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


def child_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own on the same cluster, with this one's settings and some more.

    What is built on it keeps them, and nothing else is touched.
    """
    own = spark.newSession()
    for name, value in (dict(spark.conf.getAll) | settings).items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply settings for the length of a block and put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table in executor storage while several reports read it."""
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist()
