"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made in each open :func:`scratch`, the innermost last.
_OPEN: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a session on one machine (tests) gets a temporary folder; on a cluster, where such a
    folder would scatter tables over the executors' own disks, this raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="docmill-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return a scan of it.

    It cuts lineage without the second computation that ``checkpoint()`` costs, and survives lost executors. Tables lie in a
    folder of the application, so what a stopped job leaves can be told apart; :func:`drop_stored` and :func:`scratch`
    remove them earlier.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/docmill-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    path = f"{folder}/{name}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if _OPEN:
        _OPEN[-1].append(folder)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def drop_stored(spark: SparkSession, df: DataFrame) -> None:
    """Remove the files of a table made by :func:`stored` that nothing needs any more."""
    for path in {f.rsplit("/", 2)[0] for f in df.inputFiles()}:
        if "/docmill-" in path:
            _delete(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes at its end every table that was stored inside, but those given to the function that it yields."""
    made: list[str] = []
    _OPEN.append(made)

    def keep(df: DataFrame) -> DataFrame:
        kept = {part for file in df.inputFiles() for part in file.split("/")}
        made[:] = [folder for folder in made if folder.rsplit("/", 1)[1] not in kept]
        return df

    try:
        yield keep
    finally:
        _OPEN.pop()
        for folder in made:
            _delete(spark, folder)


def clean(spark: SparkSession) -> None:
    """Remove all tables that this application stored."""
    _delete(spark, f"{shared_dir(spark)}/docmill-{spark.sparkContext.applicationId}")
