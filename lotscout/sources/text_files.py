"""Delimited register files: fixed columns, all strings, mixed charsets."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotscout.sources.snapshot import stage_table

KOREAN_CHARSET = "x-windows-949"  # superset of euc-kr
BOM = "\ufeff"
QUOTE = '"'


@contextmanager
def java_charsets(spark: SparkSession):
    """Spark 4 decodes only a short list of charsets unless told to ask the JVM."""
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_lines(spark: SparkSession, paths: str | Sequence[str], quoted: bool = False) -> DataFrame:
    """(file_path, file_name, line, header) of text files in UTF-8 or the Korean charset.

    The choice is made per file: UTF-8 if every line of it is valid UTF-8. Files stay splittable,
    because a line break byte never occurs inside a character of either charset. The choices are
    written, one row per file, so that they can be broadcast and the text is not shuffled. Blank
    lines and a leading byte order mark are dropped. `header` is the first line of the file.

    With `quoted`, line breaks inside double quotes belong to the record, as one line feed each
    (see `records`); quotes stand around whole fields and are doubled inside them.
    """
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    # within a block, lines come in their order
    filled = F.length(F.regexp_replace("value", BOM, "")) > 0
    first = F.when((F.col("block") == 0) & filled, F.col("place"))
    # a quote byte never occurs inside a character of either charset
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    blocks = raw.withColumn("place", F.monotonically_increasing_id()).groupBy("file_path", "block").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.min_by("value", first).alias("head"),
        F.sum(quotes if quoted else F.lit(0)).alias("quotes"),
        F.bool_or((quotes if quoted else F.lit(0)) % 2 == 1).alias("breaks"),
    )
    blocks = stage_table(blocks, "text-blocks")  # one row per block of a file
    files = blocks.groupBy("file_path").agg(
        F.bool_and("utf8").alias("utf8"), F.min_by("head", F.when(F.col("head").isNotNull(), F.col("block"))).alias("head")
    )

    def text(column: str) -> Column:
        decoded = F.decode(F.col(column).cast("binary"), KOREAN_CHARSET)
        decoded = F.when(F.col("utf8"), F.col(column)).otherwise(decoded)
        return F.regexp_replace(decoded, f"^{BOM}", "")

    if quoted and not blocks.where("breaks").isEmpty():
        raw = records(raw, blocks)
    with java_charsets(spark):
        files = stage_table(files.select("file_path", "utf8", text("head").alias("header")), "charsets")
        lines = raw.join(files, "file_path").select(
            "file_path", "file_name", text("value").alias("line"), "header"
        )
    return lines.filter(F.length("line") > 0)


# What a piece of a block is: a whole record, the end of a record that began in an earlier block,
# the beginning of one that goes on in a later block, or a stretch of one that does both.
WHOLE, END, BEGINNING, MIDDLE = range(4)


def records(raw: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines of `raw` put together to records, which end where the quotes so far are even in number.

    The number of quotes in each block of a file (`blocks`) tells, summed over the blocks before,
    which blocks begin inside quotes; those are named to the tasks, all others need nothing. A
    task joins the lines of its blocks in the order they come, so the text is not shuffled. Only
    the pieces at the edges of blocks that a record reaches over are gathered, at most two a block.
    """
    spark = raw.sparkSession
    upto = Window.partitionBy("file_path").orderBy("block")
    state = blocks.select(
        "file_path", "block", "quotes", F.sum("quotes").over(upto).alias("upto"),
        F.lead("block").over(upto).isNull().alias("is_last"),
    )
    state = stage_table(
        state.select(
            "file_path", "block", ((F.col("upto") - F.col("quotes")) % 2 == 1).alias("inside"),
            (F.col("upto") % 2 == 1).alias("open"), "is_last",
        ).where("inside or open"),
        "open-blocks",
    )
    # blocks at whose edges a record is open: at most one row per block
    edges = {(r["file_path"], r["block"]): r for r in state.collect()}
    endless = sorted(path for (path, _), r in edges.items() if r["open"] and r["is_last"])
    if endless:
        raise ValueError(f"quotes are not closed in {endless}")
    inside = frozenset(key for key, r in edges.items() if r["inside"])

    schema = "file_path string, file_name string, block long, value binary, piece int"
    binary = raw.withColumn("value", F.col("value").cast("binary"))
    joined = binary.mapInArrow(_joined_lines(spark.sparkContext.broadcast((inside, None))), schema)
    whole = joined.where(F.col("piece") == WHOLE)
    if inside:
        pieces = binary.mapInArrow(_joined_lines(spark.sparkContext.broadcast((inside, frozenset(edges)))), schema)
        pieces = pieces.where(F.col("piece") != WHOLE).withColumn("is_begin", F.col("piece") == BEGINNING)
        # an end comes before a beginning of the same block
        place = Window.partitionBy("file_path").orderBy("block", "is_begin")
        pieces = pieces.withColumn("record", F.sum(F.col("is_begin").cast("int")).over(place))
        ordered = F.array_sort(F.collect_list(F.struct("block", "is_begin", F.col("value").cast("string").alias("value"))))
        whole_again = pieces.groupBy("file_path", "file_name", "record").agg(ordered.alias("parts"))
        value = F.array_join(F.transform("parts", lambda p: p["value"]), "\n").cast("binary")
        whole = whole.select("file_path", "file_name", "value").unionByName(
            whole_again.select("file_path", "file_name", value.alias("value"))
        )
    return whole.select("file_path", "file_name", F.col("value").cast("string").alias("value"))


def _joined_lines(told: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function over lines in file order: whole records and pieces of the blocks in a partition.

    `told` has the blocks that begin inside quotes, and the only blocks of interest or None for all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, only = told.value
        key, name, odd, begun, held = None, None, 0, False, []

        def rest() -> Iterator[pa.RecordBatch]:
            if key is not None and odd:
                value = pa.array([b"\n".join(held)], pa.binary())
                yield _records(key, name, value, [BEGINNING if begun else MIDDLE])

        for batch in batches:
            paths, names, blocks = (batch.column(i).to_pylist() for i in range(3))
            values = batch.column(3)
            counts = pc.fill_null(pc.count_substring(values, QUOTE.encode()), 0).to_numpy(zero_copy_only=False)
            cuts = [i for i in range(1, len(paths)) if blocks[i] != blocks[i - 1] or paths[i] != paths[i - 1]]
            for a, b in zip([0, *cuts], [*cuts, len(paths)]):
                if a == b:
                    continue
                if (paths[a], blocks[a]) != key:
                    yield from rest()
                    key, name, held = (paths[a], blocks[a]), names[a], []
                    odd = int(key in inside)
                    begun = not odd
                if only is not None and key not in only:
                    odd = 0
                    continue
                after = (odd + np.cumsum(counts[a:b])) % 2
                ends = np.flatnonzero(after == 0) + 1
                if len(ends):
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]), pa.int32()), values.slice(a, int(ends[-1]))
                    )
                    joined = pc.binary_join(lists, b"\n")
                    kinds = [WHOLE] * len(ends)
                    if held:
                        first = b"\n".join([*held, joined[0].as_py()])
                        joined = pa.concat_arrays([pa.array([first], pa.binary()), joined.slice(1)])
                    kinds[0] = WHOLE if begun else END
                    yield _records(key, name, joined, kinds)
                    begun, held = True, []
                    held += values.slice(a + int(ends[-1]), b - a - int(ends[-1])).to_pylist()
                else:
                    held += values.slice(a, b - a).to_pylist()
                odd = int(after[-1])
        yield from rest()

    return run


def _records(key: tuple[str, int], name: str, values: pa.Array, kinds: list[int]) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key[0]] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
            values, pa.array(kinds, pa.int32()),
        ],
        names=["file_path", "file_name", "block", "value", "piece"],
    )


def string_fields(line: Column, columns: Sequence[str], sep: str = "|", trim: bool = False) -> Column:
    """Struct of string fields of a line; a line with another number of fields is an error."""
    spaces = str(trim).lower()
    strip = {"ignoreLeadingWhiteSpace": spaces, "ignoreTrailingWhiteSpace": spaces}
    schema = ", ".join(f"`{name}` string" for name in columns)
    # a quote inside quotes is doubled
    return F.from_csv(line, schema, {"sep": sep, "mode": "FAILFAST", "escape": QUOTE, **strip})


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    region: Column | None = None,
    sep: str = "|",
    blank_as_null: bool = False,
    header: bool = False,
    quoted: bool = False,
) -> DataFrame:
    """Delimited files as all-string columns, plus a region taken from the file name.

    With `header`, the first line of each file names its fields, in an order of its own; a file
    with unknown, lacking or repeated names is an error. Lines that repeat the header are skipped.
    A record is one line, and a line break inside quotes is an error, as it leaves too few fields;
    with `quoted` the record goes on to the line where its quotes are closed.
    """
    lines = read_lines(spark, paths, quoted)
    if header:
        lines = lines.filter(F.col("line") != F.col("header"))
    # a projection of its own, so that each line is parsed once and not once per column
    row = string_fields(F.col("line"), columns, sep).alias("row")
    extra = [] if region is None else [region.alias("region")]
    extra_names = ["region"] if extra else []
    if header:
        title = string_fields(F.col("header"), columns, sep, trim=True)
        names = F.transform(F.array(*(title.getField(c) for c in columns)), F.trim).alias("names")
        lines = lines.select(row, names, *extra)
        values = F.array(*(F.col("row").getField(c) for c in columns))
        wrong = F.raise_error(F.concat(F.lit("unexpected header: "), F.array_join("names", sep, "")))
        same = F.array_sort("names") == F.array_sort(F.array(*map(F.lit, columns)))
        by_name = F.when(same, F.map_from_arrays("names", values)).otherwise(wrong.cast("map<string,string>"))
        lines = lines.select(by_name.alias("row"), *extra_names)
    else:
        lines = lines.select(row, *extra)
    fields = [F.col("row").getField(name) for name in columns]
    if not blank_as_null:
        fields = [F.coalesce(field, F.lit("")) for field in fields]
    named = [field.alias(name) for field, name in zip(fields, columns)]
    return lines.select(*named, *extra_names)


def header_columns(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> list[str]:
    """Column names in the first line of one of the files. One line reaches the driver."""
    line = spark.read.text(paths).select(F.col("value").cast("binary").alias("value")).first()
    raw = bytes(line["value"])
    try:
        text = raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = raw.decode("cp949")
    return [name.strip() for name in next(csv.reader([text], delimiter=sep, skipinitialspace=True))]
