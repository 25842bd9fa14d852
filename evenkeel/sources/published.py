"""Outputs that change from one whole state to the next: versions in folders, and a small file that names the current one.

A writer fills a new folder, then a manifest in it with the name and size of every file and the rows of every table, and
only then points ``_current`` at the folder, by one rename. Until that a reader finds the state before, whatever became
of the writer; it checks the files of the folder it is sent to against the manifest. Other versions go after the switch.

One writer at a time is assumed. A folder without ``_current`` is read as it is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
MANIFEST = "_manifest.json"
PREFIX = "version-"


class _Files:
    """The few file operations that Spark has no public call for, on whatever file system the path is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.configuration = spark._jsc.hadoopConfiguration()
        self.root = self.path(path)
        self.system = self.root.getFileSystem(self.configuration)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.path(name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Renames a file over another one, which readers see at once or not at all."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.configuration)
        kinds = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(kinds.OVERWRITE.getClass(), 1)
        options[0] = kinds.OVERWRITE
        context.rename(self.path(source), self.path(target), options)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.system.listStatus(self.path(name))]

    def sizes(self, name: str) -> dict[str, int]:
        """Sizes of all files below a folder but the manifest and checksums, by their path in it."""
        base = self.system.getFileStatus(self.path(name)).getPath().toUri().getPath().rstrip("/")
        found, files = {}, self.system.listFiles(self.path(name), True)
        while files.hasNext():
            status = files.next()
            inside = status.getPath().toUri().getPath()[len(base) + 1 :]
            if inside != MANIFEST and not inside.rsplit("/", 1)[-1].startswith("."):
                found[inside] = status.getLen()
        return found

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


@dataclass(frozen=True)
class Published:
    """A whole version: its folder, and the rows of its tables by their path in it."""

    folder: str
    rows: Mapping[str, int]


def publish(spark: SparkSession, path: str, write: Callable[[str], None], tables: tuple[str, ...] = ()) -> Published:
    """Lets ``write`` fill a folder and makes it the state of ``path``. ``tables`` are the Parquet tables in it, whose rows
    are counted for the manifest; "" is the folder itself."""
    files, name = _Files(spark, path), f"{PREFIX}{uuid.uuid4().hex}"
    folder = f"{path}/{name}"
    write(folder)
    rows = {t: spark.read.parquet(f"{folder}/{t}" if t else folder).count() for t in tables}
    files.write(f"{folder}/{MANIFEST}", json.dumps({"files": files.sizes(folder), "rows": rows}))
    pointer = f"{path}/_{uuid.uuid4().hex}.next"
    files.write(pointer, name)
    files.replace(pointer, f"{path}/{POINTER}")
    for other in files.names(path):
        if other not in (name, POINTER) and not other.startswith(f".{POINTER}"):
            files.delete(f"{path}/{other}")
    return Published(folder, rows)


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: that of the current version, checked against its manifest, or ``path`` if none was published."""
    version = published(spark, path)
    return version.folder if version else path


def published(spark: SparkSession, path: str) -> Published | None:
    files = _Files(spark, path)
    if not files.exists(f"{path}/{POINTER}"):
        return None
    folder = f"{path}/{files.read(f'{path}/{POINTER}').strip()}"
    manifest = json.loads(files.read(f"{folder}/{MANIFEST}"))
    found = files.sizes(folder)
    wrong = sorted(f for f, size in manifest["files"].items() if found.get(f) != size)
    if wrong:
        raise ValueError(f"{folder} lacks {len(wrong)} files or has them in another size, the first is {wrong[0]}")
    return Published(folder, manifest["rows"])


def publish_parquet(df: DataFrame, path: str) -> Published:
    """A table as the state of ``path``."""
    return publish(df.sparkSession, path, lambda folder: df.write.parquet(folder), tables=("",))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))
