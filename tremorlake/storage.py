"""Folders on the storage all executors share, through the file system Spark itself uses."""

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, without hidden entries; none where there is no folder."""
    place, files = _open(spark, path)
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _open(spark, path)
    return files.exists(place)


def mark(spark: SparkSession, path: str) -> None:
    """Make a folder, if it is not there."""
    place, files = _open(spark, path)
    files.mkdirs(place)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Give a folder another name on the same storage; false where that name is taken."""
    place, files = _open(spark, path)
    target, _ = _open(spark, to)
    return not files.exists(target) and files.rename(place, target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    place, files = _open(spark, path)
    files.delete(place, True)
