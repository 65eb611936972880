"""What has landed: snapshots listed from the store, and jobs that wait until their inputs are there."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lotscout.sources.manifest import Table

LANDED = "{levels}, part string, n_files int, n_bytes long, complete boolean"


@dataclass(frozen=True)
class Need:
    """An input: its name and place, its levels, and the partitions that it must have, if known."""

    name: str
    base: str
    levels: tuple[str, ...]
    parts: tuple[str, ...] = ()


def _files(store, folder, found: list) -> bool:
    """Data files below a folder; whether a success mark stands in it or in a folder below."""
    marked = False
    for status in store.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory():
            marked |= not name.startswith(("_", ".")) and _files(store, status.getPath(), found)
        elif name == "_SUCCESS":
            marked = True
        elif name.endswith(".parquet") and status.getLen() > 0:
            found.append(status.getLen())
    return marked


def landed(spark: SparkSession, base: str, levels: Sequence[str]) -> DataFrame:
    """Snapshots of a table and their partitions, with files and bytes; complete if a success mark says so.

    Only names are listed. In a table with a manifest what it names is complete, as nothing is named
    before it is written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    table = Table(spark, base)
    store = path(table.base).getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    manifest = table.current()
    for part in manifest.parts if manifest else ():
        at = tuple(part.value(level) for level in levels)
        found: list[int] = []
        if part.folder is not None:
            _files(store, path(f"{table.base}/{part.folder}"), found)
        split = "/".join(str(v) for _, v in part.split)
        rows.append((*at, split or None, len(found), sum(found), True))

    def walk(folder: str, at: tuple[int, ...]) -> None:
        names = [s.getPath().getName() for s in store.listStatus(path(folder)) if s.isDirectory()]
        if len(at) == len(levels):
            parts = [n for n in names if "=" in n and not n.startswith((".", "_"))]
            whole: list[int] = []
            marked = _files(store, path(folder), whole)
            for name in parts or [None]:
                found = []
                own = _files(store, path(f"{folder}/{name}" if name else folder), found)
                rows.append((*at, name.split("=", 1)[1] if name else None, len(found), sum(found), marked or own))
            return
        for name in names:
            level, _, value = name.partition("=")
            if level == levels[len(at)] and value.isdigit():
                walk(f"{folder}/{name}", (*at, int(value)))

    if store.exists(path(table.base)):
        walk(table.base, ())
    schema = LANDED.format(levels=", ".join(f"{level} int" for level in levels))
    return spark.createDataFrame(rows, schema)


def lacking(spark: SparkSession, needs: Iterable[Need], upto: dict[str, int]) -> list[str]:
    """What is missing: inputs without a complete snapshot up to a stamp, or partitions of the newest one."""
    out = []
    for need in needs:
        bound = tuple(upto[level] for level in need.levels)
        found: dict[tuple, set] = {}
        for r in landed(spark, need.base, need.levels).collect():  # one row per partition of a snapshot
            at = tuple(r[level] for level in need.levels)
            if at <= bound and r["complete"] and r["n_files"] > 0:
                found.setdefault(at, set()).add(r["part"])
        if not found:
            out.append(f"{need.name}: no snapshot up to {bound}")
            continue
        newest = max(found)
        out += [f"{need.name} {newest}: no {part}" for part in need.parts if part not in found[newest]]
    return out


def require(spark: SparkSession, needs: Iterable[Need], upto: dict[str, int]) -> None:
    """Refuse a job whose inputs lack, with all that is missing."""
    missing = lacking(spark, needs, upto)
    if missing:
        raise ValueError("inputs lack: " + "; ".join(missing))
