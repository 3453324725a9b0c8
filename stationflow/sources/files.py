"""Small text files on the shared file system, through Hadoop's API.

For a few hundred bytes of bookkeeping; rows belong in tables. Paths may be on any
file system Spark reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no folder."""
    place, files = _place(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; readers see all of it or none.

    It gets its name only when it is complete. A file of that name is another writer's:
    it stays, and this raises.
    """
    place, files = _place(spark, path)
    draft, _ = _place(spark, f"{place.getParent().toString()}/.{place.getName()}-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise FileExistsError(f"another writer has written {path}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; one that is gone already is fine."""
    place, files = _place(spark, path)
    files.delete(place, True)
