"""Tables that are replaced in one step.

Every load writes a folder of its own. It becomes the table by one small commit file, created under
the next number; readers take the folder that the commit with the highest number names, and keep it:
a load that is killed before its commit leaves the old table as it was, and a reader that was opened
before a commit finishes on the files it began with. The last ``keep`` versions stay; older ones
are removed with the commit that makes them superfluous.

The commit is an exclusive create, so of two loads that end at the same time one is refused. A
commit file counts once its last character, a line break, has been written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hearth.session import create_file, file_names, read_file, remove_folder

_COMMITS = "_commits"


class ConcurrentLoad(RuntimeError):
    """Another load became the table meanwhile."""


class VersionedTable:
    """A table under the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        if keep < 1:
            raise ValueError("at least one version stays")
        self._spark, self.root, self._keep = spark, root.rstrip("/"), keep

    def _commits(self) -> list[tuple[int, str]]:
        """(number, folder) of all commits, in order."""
        folder = f"{self.root}/{_COMMITS}"
        found = []
        for name in file_names(self._spark, folder):
            if name.isdigit() and (text := read_file(self._spark, f"{folder}/{name}")).endswith("\n"):
                found.append((int(name), text.strip()))
        return sorted(found)

    def current(self) -> str | None:
        """Folder of the present version; None before the first load."""
        commits = self._commits()
        return f"{self.root}/{commits[-1][1]}" if commits else None

    def versions(self) -> list[str]:
        """Folders of the versions that can be read, oldest first."""
        return [f"{self.root}/{folder}" for _, folder in self._commits()]

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """A snapshot of the present version."""
        folder = self.current()
        if folder is None:
            raise FileNotFoundError(f"{self.root} has not been loaded")
        reader = self._spark.read if schema is None else self._spark.read.schema(schema)
        return reader.parquet(folder)

    def load(self, df: DataFrame, check: Callable[[], None] | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace all rows by ``df`` (which may read this table) and return the new version.
        ``check`` runs once the rows are written: if it raises, nothing is published."""
        before = self._commits()
        folder = f"v-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{folder}"
        try:
            writer = df.write.partitionBy(*partition_by) if partition_by else df.write
            writer.parquet(path)
            if check is not None:
                check()
            number = before[-1][0] + 1 if before else 1
            if not create_file(self._spark, f"{self.root}/{_COMMITS}/{number:020d}", f"{folder}\n"):
                raise ConcurrentLoad(self.root)
        except BaseException:
            remove_folder(self._spark, path, self.root)
            raise
        self._remove_superfluous()
        return self._spark.read.schema(df.schema).parquet(path)

    def _remove_superfluous(self) -> None:
        for number, folder in self._commits()[:-self._keep]:
            remove_folder(self._spark, f"{self.root}/{folder}", self.root)
            remove_folder(self._spark, f"{self.root}/{_COMMITS}/{number:020d}", self.root)
