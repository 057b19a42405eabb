"""Sets of tables that readers see whole: versioned folders and one marker, written last.

A set is written to a folder of its own. Publishing it writes a marker file with the next number, under a temporary
name first, and renames it, which either happens or does not. Readers take the folder that the highest marker names,
so they find the old set until that moment and the new one after it, never a mixture. Two runs that publish at the
same time cannot take the same number: the rename onto an existing marker fails, and the later one tries the next.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_MARKERS, _SETS = "_published", "_versions"


class Versions:
    """The versions under a folder, on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        uri = self._path("").toUri()
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(uri).getFileSystem(conf)
        qualified = self._fs.makeQualified(self._hadoop.Path(uri))
        self._context = self._hadoop.FileContext.getFileContext(qualified.toUri(), conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def new_folder(self) -> str:
        """Where a new set is to be written. Nothing is made before the first table."""
        return f"{self.root}/{_SETS}/{uuid4().hex}"

    def _markers(self) -> list[int]:
        folder = self._path(_MARKERS)
        if not self._fs.exists(folder):
            return []
        names = (status.getPath().getName() for status in self._fs.listStatus(folder))
        return sorted(int(name) for name in names if re.fullmatch(r"\d+", name))

    def _folder_of(self, marker: int) -> str:
        path = self._path(f"{_MARKERS}/{marker:010d}")
        stream = self._fs.open(path)
        try:
            name = bytearray(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.root}/{_SETS}/{name}"

    def current(self) -> str:
        """The folder of the published set."""
        markers = self._markers()
        if not markers:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return self._folder_of(markers[-1])

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.current()}/{table}")

    def publish(self, folder: str, tables: Sequence[str], keep: int = 2) -> None:
        """Make the set in `folder` the current one, then drop all but the last `keep` sets.

        Every table must have been written to its end: its job left the writer's mark of success.
        """
        for table in tables:
            if not self._fs.exists(self._hadoop.Path(f"{folder}/{table}/_SUCCESS")):
                raise FileNotFoundError(f"{folder}/{table} is not complete")
        written = self._path(f"{_MARKERS}/.{uuid4().hex}")
        stream = self._fs.create(written)
        try:
            stream.write(bytearray(folder.rsplit("/", 1)[1].encode()))
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        while True:
            number = max(self._markers(), default=0) + 1
            target = self._path(f"{_MARKERS}/{number:010d}")
            try:
                self._context.rename(self._fs.makeQualified(written), self._fs.makeQualified(target), options)
                break
            except Exception as error:
                if "FileAlreadyExists" not in str(error):
                    raise
        self._drop_old(keep)

    def _drop_old(self, keep: int) -> None:
        """Drop the markers before the last `keep` and the sets they name; readers of the others go on."""
        for number in self._markers()[:-keep]:
            self.discard(self._folder_of(number))
            self._fs.delete(self._path(f"{_MARKERS}/{number:010d}"), False)

    def discard(self, folder: str) -> None:
        """Delete a set that is not to be published."""
        self._fs.delete(self._hadoop.Path(folder), True)
