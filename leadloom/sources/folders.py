"""Several results in one folder, all of them or none.

publish() writes every part into a staged folder first; a failure there leaves the former results as they were. Then a journal is
put in place by one rename, which is the commit: from then on the staged parts are the results, and moving them to their names is
finished by whoever comes next if it breaks off. recover() does that, and clears what a run left that never came to its commit.
One writer at a time is assumed; renames of a file are atomic where the store's are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

JOURNAL = "_commit.json"
STAGED = "_staged-"


class Store:
    """The file system of a folder, in any store that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.files.exists(self.path(path))

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.files.listStatus(self.path(folder))] if self.exists(folder) else []

    def remove(self, path: str) -> None:
        self.files.delete(self.path(path), True)

    def move(self, old: str, new: str) -> None:
        if not self.files.rename(self.path(old), self.path(new)):
            raise OSError(f"{old} could not be moved to {new}")

    def write(self, path: str, text: str) -> None:
        stream = self.files.create(self.path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, path: str) -> str:
        stream = self.files.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def recover(spark: SparkSession, folder: str) -> bool:
    """Bring a folder to one of its two states: finish a commit that broke off, else clear what was staged. Whether there was a commit."""
    store = Store(spark, folder)
    committed = store.exists(f"{folder}/{JOURNAL}")
    if committed:
        journal = json.loads(store.read(f"{folder}/{JOURNAL}"))
        for name in journal["parts"]:
            staged, final = f"{folder}/{journal['staged']}/{name}", f"{folder}/{name}"
            if store.exists(staged):  # else it was moved before
                store.remove(final)
                store.move(staged, final)
    for name in store.names(folder):
        if name.startswith(STAGED) or name == f"{JOURNAL}.new":
            store.remove(f"{folder}/{name}")
    if committed:
        store.remove(f"{folder}/{JOURNAL}")
    return committed


def publish(spark: SparkSession, folder: str, parts: dict[str, Callable[[str], None]], check: Callable[[str], None] | None = None, more: tuple[str, ...] = ()) -> None:
    """Write parts (name, what writes to a path) and put them in the place of the former ones together.

    check gets the staged folder before the commit; if it raises, nothing changes. more: names of parts that check writes there.
    """
    recover(spark, folder)
    store, staged = Store(spark, folder), f"{STAGED}{uuid.uuid4().hex}"
    try:
        for name, write in parts.items():
            write(f"{folder}/{staged}/{name}")
        if check is not None:
            check(f"{folder}/{staged}")
    except BaseException:
        store.remove(f"{folder}/{staged}")
        raise
    store.write(f"{folder}/{JOURNAL}.new", json.dumps({"staged": staged, "parts": [*parts, *more]}))
    store.move(f"{folder}/{JOURNAL}.new", f"{folder}/{JOURNAL}")
    recover(spark, folder)
