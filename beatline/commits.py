"""A folder of numbered commits, each a small file that only one writer can create."""

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Commits that stay; older ones are deleted when a new one is added.
KEPT_COMMITS = 100


class CommitConflict(RuntimeError):
    """Another writer has added the commit."""


class CommitLog:
    """Commits ``1, 2, ...`` of a folder; the one with the highest number counts.

    A commit is claimed by creating its file, which fails if the file is there, and counts once it has been written
    to its end; a file that a crashed writer left unfinished is passed over.  The store must refuse to create a file that is there,
    as HDFS does; on a store that only overwrites, two writers at the same moment are not told apart.
    """

    def __init__(self, spark: SparkSession, folder: str, kept: int = KEPT_COMMITS) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.folder, self.kept = folder.rstrip("/"), max(kept, 2)
        root = self._path(self.folder)
        self._files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _place(self, number: int):
        return self._path(f"{self.folder}/{number:020d}.json")

    def numbers(self) -> list[int]:
        root = self._path(self.folder)
        if not self._files.exists(root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(root)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def read(self, number: int) -> dict | None:
        """The content of a commit; None if it is unfinished or gone."""
        try:
            stream = self._files.open(self._place(number))
        except Py4JJavaError:
            return None
        try:
            return json.loads(bytes(stream.readAllBytes()) or b"null")
        except ValueError:
            return None
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict | None]:
        """Number and content of the last finished commit; (0, None) before the first."""
        for number in reversed(self.numbers()):
            content = self.read(number)
            if content is not None:
                return number, content
        return 0, None

    def add(self, content: dict, after: int | None = None) -> int:
        """Add the next commit and return its number.

        ``after`` is the number on which the content is based; if anyone has added a commit since, this one is refused.
        """
        numbers = self.numbers()
        last = numbers[-1] if numbers else 0
        if after is not None and last > after and self.newest()[0] > after:
            raise CommitConflict(f"{self.folder}: commit {last} was added after {after}")
        try:
            stream = self._files.create(self._place(last + 1), False)
        except Py4JJavaError as error:
            if self._files.exists(self._place(last + 1)):
                raise CommitConflict(f"{self.folder}: another writer added commit {last + 1}") from error
            raise
        try:
            stream.write(json.dumps(content).encode())
        finally:
            stream.close()
        for number in numbers:
            if number <= last + 1 - self.kept:
                self._files.delete(self._place(number), False)
        return last + 1

    def delete_beside(self, keep: set[str]) -> None:
        """Delete folders beside the commits whose names are not among those to keep."""
        for status in self._files.listStatus(self._path(self.folder)):
            if status.isDirectory() and status.getPath().getName() not in keep:
                self._files.delete(status.getPath(), True)
