"""A4, F1: which input a load consumed, and after which load.

<warehouse>/_inputs/<number>.json   one object per completed load, in order

A load is named by its input and by the load completed before it:

* files are identified by position (path, size, modification time), so the same
  file handed in again right after its load is a replay and changes nothing, and
  the same lines in another file, or the same file after another load, are a new
  load;
* other message logs are identified by their lines, and every completed call is a
  load of its own.

Either way a load that died half-way gets its name again when it is repeated, and
its committed segments are skipped. Only the newest entry is read; an entry is
written under a name of its own and then renamed, which fails if another load
completed in between (that one then goes first).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import SparkSession

from sluice.session import FileExists, list_names, read_text, write_new

FOLDER = "_inputs"


def file_positions(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int, int]]:
    """(path, size, modification time) of every file under the given paths, folders and patterns, by path."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = {}
    for text in [paths] if isinstance(paths, str) else paths:
        pattern = jvm.org.apache.hadoop.fs.Path(text)
        fs = pattern.getFileSystem(conf)
        pending = list(fs.globStatus(pattern) or [])
        if not pending:
            raise FileNotFoundError(text)
        while pending:
            status = pending.pop()
            name = status.getPath().getName()
            if name.startswith((".", "_")):
                continue
            if status.isDirectory():
                pending.extend(fs.listStatus(status.getPath()))
            else:
                found[status.getPath().toString()] = (int(status.getLen()), int(status.getModificationTime()))
    return [(path, *found[path]) for path in sorted(found)]


def identity(positions: list[tuple[str, int, int]]) -> str:
    return "files-" + hashlib.sha256(json.dumps(positions).encode()).hexdigest()[:32]


class InputLedger:
    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.folder = spark, f"{warehouse.rstrip('/')}/{FOLDER}"

    def head(self) -> dict | None:
        """The newest entry."""
        numbers = [int(n.removesuffix(".json")) for n in list_names(self.spark, self.folder) if n.endswith(".json")]
        if not numbers:
            return None
        return json.loads(read_text(self.spark, f"{self.folder}/{max(numbers):012d}.json"))

    def name(self, source: str) -> str:
        """The name of a load of this input, after all completed loads."""
        head = self.head()
        before = head["load_id"] if head else ""
        return "load-" + hashlib.sha256(f"{before}\n{source}".encode()).hexdigest()[:24]

    def consumed_last(self, source: str) -> dict | None:
        """The entry of the last completed load if this was its input."""
        head = self.head()
        return head if head and head["source"] == source else None

    def complete(self, load_id: str, source: str) -> None:
        """Enter a completed load (once, if it is the newest already)."""
        while True:
            head = self.head()
            if head and head["load_id"] == load_id:
                return
            number = head["number"] + 1 if head else 0
            entry = {"number": number, "load_id": load_id, "source": source, "after": head["load_id"] if head else None,
                     "completed_at": dt.datetime.now(dt.timezone.utc).isoformat()}
            try:
                write_new(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(entry, sort_keys=True))
                return
            except FileExists:  # another load completed first
                continue
