"""Written intermediate tables: lineage cuts that outlive executors.

The folder is the one the cluster names in ``spark.checkpoint.dir``; on a cluster that names none, an error is raised, for
executors share no temporary folder. Only a local session (tests, a laptop) gets one under the system's temporary folder. The
tables of an application are removed when it ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for the tables of this application."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='loomline-')}"
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(_remove, base.removeprefix("file://"))
    path = f"{base.rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    if path not in _made:
        _made.add(path)
        atexit.register(_end, spark)
    return path


#: Folders that will be removed when this driver ends.
_made: set[str] = set()


def _end(spark: SparkSession) -> None:
    try:
        clear(spark)
    except Exception:  # noqa: BLE001 - the session may have ended before; then whoever owns the folder removes it
        return


def _remove(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove every table this application has written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
