"""Small files that appear whole or not at all, for manifests and versions.

They hold what the driver decides (a version number, a folder name, a count), never
rows. A file is written under a hidden name and then renamed without overwriting, so
of several writers of one name exactly one succeeds.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, origin: str, target: str) -> bool:
    """Rename without overwriting; False if the target is there already."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, target).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(_path(spark, origin), _path(spark, target), options)
    except Exception as error:
        if _system(spark, target).exists(_path(spark, target)):
            return False
        raise error
    return True


def publish_once(spark: SparkSession, path: str, content: dict) -> bool:
    """Write a JSON file unless one of that name exists; tells whether this call wrote it."""
    parent, _, name = path.rpartition("/")
    hidden = f"{parent}/.{name}-{uuid.uuid4().hex}"
    system = _system(spark, path)
    stream = system.create(_path(spark, hidden), False)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    if _rename(spark, hidden, path):
        return True
    system.delete(_path(spark, hidden), False)
    return False


def move_folder(spark: SparkSession, origin: str, target: str) -> bool:
    """Give a written folder its name; False if the name is taken, then the folder stays."""
    _system(spark, target).mkdirs(_path(spark, target.rpartition("/")[0]))
    return _rename(spark, origin, target)


def read_published(spark: SparkSession, path: str) -> dict | None:
    """Content of a published file, None if there is none."""
    system = _system(spark, path)
    if not system.exists(_path(spark, path)):
        return None
    stream = system.open(_path(spark, path))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder without hidden ones, sorted; none if the folder does not exist."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in system.listStatus(_path(spark, folder))]
    return sorted(name for name in names if name[0] not in "._")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds."""
    _system(spark, path).delete(_path(spark, path), True)
