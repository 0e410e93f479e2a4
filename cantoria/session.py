"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: weakref.WeakSet = weakref.WeakSet()
_OWN: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the queries are tested under."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cantoria")
    defaults = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        # timers of streams need it
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shipped(spark: SparkSession) -> None:
    """Sends this package's sources to the Python workers, once for each Spark context."""
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(to, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(to))
    _SHIPPED.add(context)


def shared_folder(spark: SparkSession) -> str:
    """The folder for files that all executors read: spark.checkpoint.dir. Only a local session that names none gets one of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    if context not in _OWN:
        _OWN[context] = tempfile.mkdtemp(prefix="cantoria-")
    return _OWN[context]


def checkpointed(df, eager: bool = True):
    """Cuts the lineage in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager)


def written(df):
    """The rows as Parquet in the shared folder, for what is read several times: made once, where a checkpoint makes its last stage twice, and by columns."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, *columns):
    """Dealt by the columns over as many tasks as the session shuffles to, four a core at least: for rows that are small and work that isn't, which adaptive execution would put into a few tasks."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *columns)
