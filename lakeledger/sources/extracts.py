"""Manifest of full extracts: which there are, when they were taken, what became of each.

An extract is a sub-folder of the landing folder, or the landing folder itself when
the files lie in it.  It is complete once it holds its mark; until then it waits.  Each
gets a number when it is first seen, in the order of its instant, and a manifest
entry ``<base>/extract=<number>``: folder, instant, state.  So work is cut along
extracts, not along whatever files a micro-batch happens to hold.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .snapshots import _fs, numbered

ENTRY = "number int, folder string, at string, state string, n_rows long"
WAITING, REFUSED = "waiting", "refused"
_INSTANT = re.compile(r"(?:^|=)(\d{4}-\d{2}-\d{2})(?:[T_ ](\d{2})[:-]?(\d{2})[:-]?(\d{2}))?$")


@dataclass
class Extract:
    number: int
    folder: str
    at: str      # instant, as text of a timestamp
    state: str = WAITING
    n_rows: int | None = None


def instant_of(name: str, modified_ms: int) -> str:
    """The instant in a folder's name (``at=2024-01-31`` or ``2024-01-31T10:00:00``), else its mark's time."""
    m = _INSTANT.search(name)
    if m:
        return f"{m[1]} {m[2] or '00'}:{m[3] or '00'}:{m[4] or '00'}"
    return dt.datetime.fromtimestamp(modified_ms / 1000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def complete_extracts(spark: SparkSession, landing: str, mark: str = "_SUCCESS") -> list[tuple[str, str]]:
    """(folder, instant) of the extracts under ``landing`` that are complete; none if there is no such folder."""
    jvm, p, fs = _fs(spark, landing)
    if not fs.exists(p):
        return []
    found = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            m = jvm.org.apache.hadoop.fs.Path(st.getPath(), mark)
            if fs.exists(m):
                found.append((st.getPath().toString(), instant_of(name, fs.getFileStatus(m).getModificationTime())))
    if not found and fs.exists(jvm.org.apache.hadoop.fs.Path(p, mark)):
        when = fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(p, mark)).getModificationTime()
        found.append((fs.resolvePath(p).toString(), instant_of(p.getName(), when)))
    return sorted(found, key=lambda x: (x[1], x[0]))


class Manifest:
    """The entries under ``base``; an entry is one small file that is written whole."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def entries(self) -> list[Extract]:
        if not numbered(self.spark, self.base, "extract="):
            return []
        rows = self.spark.read.schema(ENTRY).parquet(f"{self.base}/extract=*").collect()  # a row per extract
        return sorted((Extract(*r) for r in rows), key=lambda e: e.number)

    def put(self, e: Extract) -> None:
        (self.spark.createDataFrame([(e.number, e.folder, e.at, e.state, e.n_rows)], ENTRY).coalesce(1)
             .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.base}/extract={e.number}"))

    def discover(self, landing: str, mark: str = "_SUCCESS", late: str = "refuse",
                 at: Callable[[int], str] | None = None) -> list[Extract]:
        """Enter the complete extracts not yet known; returns all entries.

        ``at(number)`` gives an extract's instant (default: from its name or mark).
        One that is older than a known one is late: ``refuse`` keeps it as refused,
        so that it is seen and never applied; ``place`` takes it, and whoever applies
        it builds the history again from all extracts.
        """
        if late not in ("refuse", "place"):
            raise ValueError("late must be refuse or place")
        known = self.entries()
        folders = {e.folder for e in known}
        for folder, when in complete_extracts(self.spark, landing, mark):
            if folder in folders:
                continue
            number = known[-1].number + 1 if known else 0
            e = Extract(number, folder, at(number) if at else when)
            newest = max((k.at for k in known if k.state != REFUSED), default="")
            if e.at < newest and late == "refuse":
                e.state = REFUSED
            self.put(e)
            known.append(e)
        return known


__all__ = ["Extract", "Manifest", "complete_extracts", "instant_of", "REFUSED", "WAITING"]
