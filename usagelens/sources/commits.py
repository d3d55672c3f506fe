"""The commit log of a star: which written folders count, in order.

    <root>/commits/<seq>.json             what one write added
    <root>/commits/<seq>.snapshot.json    all that counts up to seq, one in SNAPSHOT_EVERY commits

A commit is a rename to a name that must not exist yet. Of two writers that read the same log, the second gets a
`CommitConflictError` and has changed nothing that readers see; it may run again. Readers open the newest snapshot
and the commits after it, at most SNAPSHOT_EVERY + 1 files however long the log is; older files are removed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from usagelens.schemas import CommitConflictError

SNAPSHOT_EVERY = 32
#: A reader whose listing is overtaken by a clean-up lists again.
ATTEMPTS = 5


@dataclass(frozen=True)
class Entry:
    """A folder that counts, below its version: the rows of `table` that belong to `part`."""

    version: str
    table: str
    part: str
    folder: str
    #: What was counted while the folder was written: JSON of name to number, or nothing.
    counts: str = ""


@dataclass(frozen=True)
class Log:
    seq: int  # of the newest commit, 0 before the first
    entries: tuple[Entry, ...]

    @property
    def version(self) -> str | None:
        """The newest version with events."""
        return next((e.version for e in reversed(self.entries) if e.table == "events"), None)

    def of(self, version: str | None, table: str) -> list[Entry]:
        return [e for e in self.entries if e.version == version and e.table == table]

    def parts(self, version: str | None, table: str = "events") -> list[str]:
        return [e.part for e in self.of(version, table)]


class Folder:
    """A folder in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = self._hadoop.Path(path)
        self._fs = self._path.getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(self._path, name)

    def names(self) -> list[str]:
        if not self._fs.exists(self._path):
            return []
        return [x.getPath().getName() for x in self._fs.listStatus(self._path)]

    def read(self, name: str) -> str | None:
        """The file's text; None if it is gone."""
        try:
            stream = self._fs.open(self._at(name))
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a whole file under a new name; False if there is one already."""
        hidden = self._at(f"_{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._hadoop.FileContext.getFileContext(self._path.toUri(), self._conf).rename(hidden, self._at(name), options)
        except Py4JJavaError as e:
            self._fs.delete(hidden, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def remove_path(spark: SparkSession, path: str) -> None:
    parent, _, name = path.rstrip("/").rpartition("/")
    Folder(spark, parent).delete(name)


def _file(seq: int, snapshot: bool = False) -> str:
    return f"{seq:012d}{'.snapshot' if snapshot else ''}.json"


def _numbered(names: list[str]) -> tuple[list[int], list[int]]:
    """The numbers of commits and of snapshots, ascending; hidden and half-written files are no part of either."""
    files = [n for n in names if n[:1].isdigit() and n.endswith(".json")]
    snapshots = sorted(int(n.split(".")[0]) for n in files if n.endswith(".snapshot.json"))
    commits = sorted(int(n.split(".")[0]) for n in files if not n.endswith(".snapshot.json"))
    return commits, snapshots


def _read(folder: Folder) -> Log | None:
    commits, snapshots = _numbered(folder.names())
    base = snapshots[-1] if snapshots else 0
    wanted = [_file(base, snapshot=True)] if base else []
    later = [c for c in commits if c > base]
    texts = [folder.read(n) for n in [*wanted, *map(_file, later)]]
    if None in texts:
        return None
    entries: list[Entry] = []
    for found in map(json.loads, texts):
        entries = [e for e in entries if e.version not in found.get("dropped", [])]
        entries += [Entry(**e) for e in found["entries"]]
    return Log(later[-1] if later else base, tuple(entries))


def read_log(spark: SparkSession, root: str) -> Log:
    """All that counts at `root` now; empty where nothing was written yet."""
    folder = Folder(spark, f"{root}/commits")
    for _ in range(ATTEMPTS):
        if (log := _read(folder)) is not None:
            return log
    raise CommitConflictError(f"the log at {root} changes faster than it can be read")


def commit(spark: SparkSession, root: str, log: Log, entries: list[Entry], dropped: tuple[str, ...] = ()) -> Log:
    """Make `entries` count, all of them or none, as the commit after `log`, the log they were decided on."""
    folder, seq = Folder(spark, f"{root}/commits"), log.seq + 1
    text = json.dumps({"entries": [asdict(e) for e in entries], "dropped": list(dropped)})
    # The listing tells a writer that was away so long that the file of its number is cleaned up already.
    newest = max([0, *sum(_numbered(folder.names()), [])])
    if newest != log.seq or not folder.create(_file(seq), text):
        raise CommitConflictError(f"another writer committed to {root} meanwhile: nothing was changed, run this again")
    kept = tuple(e for e in log.entries if e.version not in dropped)
    log = Log(seq, (*kept, *entries))
    if seq % SNAPSHOT_EVERY == 0:
        _snapshot(folder, log)
    return log


def _snapshot(folder: Folder, log: Log) -> None:
    folder.create(_file(log.seq, snapshot=True), json.dumps({"entries": [asdict(e) for e in log.entries]}))
    commits, snapshots = _numbered(folder.names())
    # The snapshot before stays for readers that have listed it already.
    for seq in snapshots[:-2]:
        folder.delete(_file(seq, snapshot=True))
    for seq in commits:
        if len(snapshots) > 1 and seq <= snapshots[-2]:
            folder.delete(_file(seq))
