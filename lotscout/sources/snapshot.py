"""Latest-snapshot scans and snapshot writes over year=/month=[/week=] directories."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotscout.sources.manifest import Table

LEVELS = ("year", "month", "week")


def latest_snapshot(
    df: DataFrame, levels: Sequence[str] = LEVELS, where: Column | None = None
) -> DataFrame:
    """Rows of the newest snapshot: the largest year, its largest month, its largest week.

    The maximum is a one-row scalar subquery, so on partition columns Spark prunes the directories
    before the scan. `where` restricts both the rows and what counts as newest.
    """
    if where is not None:
        df = df.filter(where)
    newest = df.agg(F.max(F.struct(*levels))).scalar()
    at_newest = [F.col(c) == newest[c] for c in levels]
    return df.filter(reduce(Column.__and__, at_newest))


def read_latest(
    spark: SparkSession,
    base: str,
    levels: Sequence[str] = LEVELS,
    upto: dict[str, int] | None = None,
) -> DataFrame:
    """Read the newest snapshot below `base`, not after `upto` if that is given.

    It is found in the table's manifest, or from directory names, level by level, so no file of
    another snapshot is opened or listed. A missing level or an empty table is an error.
    """
    bound = None if upto is None else tuple(upto[level] for level in levels)
    table = Table(spark, base)
    committed = table.newest(levels, upto=bound)
    path = _newest(spark, base.rstrip("/"), list(levels), bound)
    if path is None and not committed:
        raise ValueError(f"no snapshot in {base}" + ("" if bound is None else f" up to {bound}"))
    parts = [] if path is None else path.split("/")[-len(levels) :]
    landed = tuple(int(part.partition("=")[2]) for part in parts)
    if committed and tuple(committed[0].value(level) for level in levels) >= landed:
        return table.read(committed)
    at = [F.col(c) == int(part.partition("=")[2]) for c, part in zip(levels, parts)]
    return spark.read.option("basePath", base).parquet(path).filter(reduce(Column.__and__, at))


def _newest(
    spark: SparkSession, base: str, levels: list[str], bound: tuple[int, ...] | None
) -> str | None:
    """The directory with the largest level values within the bound; the walk goes back if a
    directory has no snapshot that is early enough."""
    if not levels:
        return base
    level, folder = levels[0], _folder(spark, base)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []
    found = {int(n.split("=", 1)[1]): n for n in names if n.startswith(f"{level}=") and n.split("=", 1)[1].isdigit()}
    if names and not found and not all(n.startswith(("_", ".")) for n in names):
        raise ValueError(f"no {level} partition in {base}")
    for value in sorted(found, reverse=True):
        if bound is not None and value > bound[0]:
            continue
        rest = bound[1:] if bound is not None and value == bound[0] else None
        path = _newest(spark, f"{base}/{found[value]}", levels[1:], rest)
        if path is not None:
            return path
    return None


def _folder(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a written folder in the place of another one, which is only then deleted."""
    new, place = _folder(spark, fresh), _folder(spark, path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    old = _folder(spark, f"{path.rpartition('/')[0]}/_old-{uuid.uuid4().hex}")
    fs.mkdirs(place.getParent())
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"cannot put {fresh} in place of {path}")
    if had:
        fs.delete(old, True)


def _beside(path: str) -> str:
    """A fresh path next to `path` that readers of the table do not see."""
    return f"{path.rpartition('/')[0]}/_new-{uuid.uuid4().hex}"


def snapshot_path(base: str, values: dict[str, int | str]) -> str:
    """base/year=YYYY/month=MM[/week=WW] with two-digit months and weeks; text values as they are."""
    return "/".join([base, *(f"{k}={v:02d}" if isinstance(v, int) else f"{k}={v}" for k, v in values.items())])


def write_snapshot(
    df: DataFrame,
    base: str,
    values: dict[str, int | str],
    partition: Sequence[str] = ("region",),
    may_be_empty: bool = False,
) -> str:
    """Overwrite one snapshot directory, partitioned inside it, for readers that know directories only.

    It is put in place by two renames; `manifest.Table` needs none.

    The rebalance hint gathers each region into few files and splits a region that outgrows one
    task, so neither tiny files nor one hot writer appear. An empty snapshot is an error unless
    expected: it has no files, so readers of the newest snapshot would fall back to an older one.
    The rows are written beside the snapshot, checked there and then put in its place, so that a
    failed or empty run leaves an earlier snapshot as it was.
    """
    path = snapshot_path(base.rstrip("/"), values)
    fresh, spark = _beside(path), df.sparkSession
    out = df.drop(*values).hint("rebalance", *partition)
    out.write.partitionBy(*partition).parquet(fresh)
    if not may_be_empty and spark.read.schema(out.schema).parquet(fresh).isEmpty():
        folder = _folder(spark, fresh)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        raise ValueError(f"no rows for {path}")
    _swap_in(spark, fresh, path)
    return path


def replace_snapshots(df: DataFrame, base: str, keys: Sequence[str] = LEVELS) -> None:
    """Replace, in `base`, exactly the snapshots whose key values occur in `df`.

    Replays are idempotent. Without keys the whole table is replaced; no rows means no change.
    The table is partitioned by the keys alone, so a region missing from the new rows is gone
    afterwards, as with delete-then-insert.
    """
    if keys:
        writer = df.hint("rebalance", *keys).write.partitionBy(*keys)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(base)
        return
    base, spark = base.rstrip("/"), df.sparkSession
    fresh = _beside(base)
    df.write.parquet(fresh)
    if spark.read.schema(df.schema).parquet(fresh).isEmpty():
        folder = _folder(spark, fresh)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    else:
        _swap_in(spark, fresh, base)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; a cluster session is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_FOLDER, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="lotscout-")
    spark.conf.set(_OWN_FOLDER, own)
    return own


_OWN_FOLDER = "lotscout.local.folder"


_JOB: ContextVar[str] = ContextVar("job", default="")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, below a folder of this application and, if there is one, job."""
    app = spark.conf.get("spark.app.id")
    return f"{shared_folder(spark)}/lotscout/{app}/{_JOB.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def stage_folder(spark: SparkSession):
    """Stages written inside go to a folder that is removed at the end, also after an error."""
    name = f"job-{uuid.uuid4().hex}/"
    path = new_path(spark, name).partition(name)[0] + name
    token = _JOB.set(_JOB.get() + name)
    try:
        yield
    finally:
        _JOB.reset(token)
        folder = _folder(spark, path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    For a stage used more than once: it is computed once, later scans prune its columns, and a
    lost executor costs a re-read instead of the whole lineage.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
