"""Months of a table replaced all at once, through a journal.

New files are written to a hidden folder ``_staged-...`` inside the table, where readers of
the table do not look.  Then a journal, ``_swap.json``, is renamed into place: it names the
files that come and the files that go, and is the moment at which the months change.  What
follows only carries it out: files are moved in, old ones deleted, the staged folder and
the journal removed.

A driver lost before the journal leaves the old months, and a hidden folder.  Lost after it,
:func:`current_files` (which ``sources.read_months`` uses) shows the new months, wherever their files
are, and the next writer finishes first (:func:`settle`).  Every step may be repeated.  File names
are unique, so a file is never taken for another.

One writer at a time works on a table.  All calls go through the file system that Spark uses
for the path.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

JOURNAL = "_swap.json"
_THREADS = 16


class Folder:
    """A table's folder; names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def months(self, below: str = "") -> list[str]:
        """Partitions ``year=/month=``, relative to ``below``."""
        prefix = f"{below}/" if below else ""
        found = self._fs.globStatus(self._at(f"{prefix}year=*/month=*")) or []
        return sorted("/".join(s.getPath().toString().split("/")[-2:]) for s in found)

    def files(self, name: str) -> list[str]:
        """Data files in a partition, none where it is not there."""
        if not self.exists(name):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(name)) if s.isFile()]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The whole file appears under its name, or nothing does."""
        draft = f"_draft-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(draft, name)

    def move(self, old: str, new: str) -> None:
        if not self._fs.rename(self._at(old), self._at(new)):
            raise OSError(f"{self.root}: cannot rename {old} to {new}")

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def stage_name() -> str:
    return f"_staged-{uuid.uuid4().hex}"


def _pending(folder: Folder) -> dict | None:
    text = folder.read(JOURNAL)
    return None if text is None else json.loads(text)


def publish(spark: SparkSession, path: str, staged: str, emptied: list[str] = ()) -> None:
    """The months found in the folder ``staged`` replace those of the table; ``emptied`` ones go."""
    folder = Folder(spark, path)
    if folder.exists(JOURNAL):
        raise OSError(f"{path}: another replacement is not finished")
    come = {month: folder.files(f"{staged}/{month}") for month in folder.months(staged)}
    go = {month: folder.files(month) for month in sorted({*come, *emptied})}
    folder.publish(JOURNAL, json.dumps({"staged": staged, "come": come, "go": go}))


def settle(spark: SparkSession, path: str) -> None:
    """Carry out a published replacement, if there is one."""
    folder = Folder(spark, path)
    journal = _pending(folder)
    if journal is None:
        return
    staged, moves, deletes = journal["staged"], [], []
    for month, names in journal["come"].items():
        folder.make(month)
        waiting = set(folder.files(f"{staged}/{month}"))
        moves += [(f"{staged}/{month}/{n}", f"{month}/{n}") for n in names if n in waiting]
    for month, names in journal["go"].items():
        there = set(folder.files(month))
        deletes += [f"{month}/{n}" for n in names if n in there]
    with ThreadPoolExecutor(_THREADS) as pool:
        list(pool.map(lambda pair: folder.move(*pair), moves))
        list(pool.map(folder.delete, deletes))
    for month in journal["go"]:
        if folder.exists(month) and not folder.files(month):
            folder.delete(month)
    folder.delete(staged)
    folder.delete(JOURNAL)


def current_files(spark: SparkSession, path: str) -> tuple[list[str], str, list[str]] | None:
    """What the table is while a replacement is published but not carried out.

    (partitions and files in place, the staged folder, files in it), as full paths; None if nothing is pending.
    """
    folder = Folder(spark, path)
    journal = _pending(folder)
    if journal is None:
        return None
    come, go, staged = journal["come"], journal["go"], journal["staged"]
    placed = [month for month in folder.months() if month not in go]
    for month, names in go.items():
        placed += [f"{month}/{n}" for n in folder.files(month) if n not in names]
    waiting = []
    for month, names in come.items():
        there = set(folder.files(f"{staged}/{month}"))
        waiting += [f"{staged}/{month}/{n}" for n in names if n in there]
    root = folder.root
    return [f"{root}/{p}" for p in placed], f"{root}/{staged}", [f"{root}/{p}" for p in waiting]
