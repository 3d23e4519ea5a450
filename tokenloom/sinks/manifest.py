"""Sets of files that change as a whole.

What belongs to a set is named in a small file below ``_versions``; data goes into folders of its own and is never written over.
A new version is written aside and then renamed, which either happens or does not, and never replaces a version that another writer
has made meanwhile. Readers follow the highest version, so they see the old set until the new one is complete, and a job that dies at
any point leaves the old set in place. Folders that no version needs any more stay until :func:`remove_unused` is called.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"(\d{10})\.json")


class Conflict(RuntimeError):
    """Another writer has made the version meanwhile."""


def file_system(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _folder(root: str) -> str:
    # readers of data skip names that begin with an underscore
    return f"{root.rstrip('/')}/_versions"


def versions(spark: SparkSession, root: str) -> list[int]:
    place, files = file_system(spark, _folder(root))
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(m[1]) for m in map(_NAME.fullmatch, names) if m)


def current(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest version; 0 and nothing if there is none."""
    found = versions(spark, root)
    if not found:
        return 0, {}
    place, files = file_system(spark, f"{_folder(root)}/{found[-1]:010d}.json")
    stream = files.open(place)
    try:
        return found[-1], json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Make ``version`` the newest one; raises :class:`Conflict` if it exists."""
    folder = _folder(root)
    aside, files = file_system(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = files.create(aside, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    _publish(spark, aside, f"{folder}/{version:010d}.json")


def _publish(spark: SparkSession, aside, target: str) -> None:
    """Rename without replacing."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        aside.toUri() if aside.toUri().getScheme() else file_system(spark, target)[1].getUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    only = spark.sparkContext._gateway.new_array(kinds, 1)
    only[0] = kinds.NONE
    try:
        context.rename(aside, jvm.org.apache.hadoop.fs.Path(target), only)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            raise Conflict(target) from error
        raise


def remove_unused(spark: SparkSession, root: str) -> list[str]:
    """Delete data folders that the newest version does not name, and older versions; no job may be writing or reading them."""
    version, content = current(spark, root)
    used = set(_named(content))
    place, files = file_system(spark, root)
    gone = []
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("set-") and name not in used:
            files.delete(status.getPath(), True)
            gone.append(name)
    for old in versions(spark, root):
        if old < version:
            files.delete(file_system(spark, f"{_folder(root)}/{old:010d}.json")[0], False)
    return sorted(gone)


def _named(content) -> list[str]:
    """All strings in a version; those that are folders of it are kept."""
    if isinstance(content, dict):
        return [name for value in content.values() for name in _named(value)]
    return [content] if isinstance(content, str) else []


def new_folder() -> str:
    return f"set-{uuid.uuid4().hex}"
