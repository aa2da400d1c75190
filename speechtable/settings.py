"""Session facts the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Intermediate folders of this process, for ``clean_up``.
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster in spark.checkpoint.dir.

    Where the session names none, a local session (unit tests) gets a folder of its own, a cluster one below the warehouse;
    a warehouse on a machine's own disk is refused, since every executor would write to another one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named is None:
        named = _fallback(spark.sparkContext.master, spark.conf.get("spark.sql.warehouse.dir"))
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def _fallback(master: str, warehouse: str) -> str:
    if master.startswith("local"):
        return tempfile.mkdtemp(prefix="speechtable-")
    if "://" not in warehouse or warehouse.startswith("file:"):
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors reach; the warehouse {warehouse} is on one machine")
    return f"{warehouse.rstrip('/')}/speechtable-intermediate"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clean_up(spark: SparkSession) -> int:
    """Delete the intermediate folders this process has made so far; tables read from them can no longer be computed."""
    done = 0
    while _MADE:
        target = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        done += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return done


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several later steps scan: a Python stage below them would run once per scan,
    since nothing can be pruned out of it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless the session already did."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_speechtable_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="speechtable-")) / "speechtable.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    context._speechtable_shipped = True
