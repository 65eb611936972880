"""Removal of repeated blocks of lines, found through content-defined boundaries.

Lines that are not blank are taken in pairs of neighbours. A rolling hash over the hashes of a pair's
two lines makes a boundary of every pair that has the least hash among any `reach` pairs in a row. What
is a boundary depends on the lines next to it alone, so an inserted line moves no other boundary, and
of `reach` + 1 lines in a row two copies have the same boundary, whatever stands around them.

A chunk is a maximal run of pairs that all occur before, in the same document or another one. It goes
if a boundary lies in it and its lines have `min_chars` characters; blank lines between its lines
go with it. The places of all pairs are compared by hash with partial aggregation first, and a
pair counts only after its text has been compared with that of its first place. So a repeated block
of `reach` + 1 lines or more goes whole, and blocks of two or three lines go if they have a boundary.

Texts meet their marks in one shuffle; only documents with a repeated pair are touched again.

Defined results: a null text stays null and has no lines; a single line stays; everything is judged on
the input, so of a block that overlaps itself less than one copy may stay; the first place is the
smallest (doc_id, text digest, line), null ids last; rows with the same doc_id and text are one
document and get the same answer. Other columns are kept, whatever they are called, but for `n_chars`,
which follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotscout.llm.native import let
from lotscout.sources.snapshot import stage_table

# Weight of the rolling hash and its modulus; products stay far below 2**63.
WEIGHT, MODULUS = 31, 1_000_003
KEY = ["id_null", "id", "digest"]
_PLACES = "array<struct<k:int,first:int,last:int,mark:bigint,own:int,next:int,is_boundary:boolean>>"


def _filled(text: Column) -> Column:
    """(place, body) of the lines that are not blank."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("place"), x.alias("body")))
    return F.filter(lines, lambda line: F.trim(line["body"]) != "")


def _body(lines: Column, k: Column) -> Column:
    """Text of the pair that begins with line k of the filled ones."""
    return F.concat(F.get(lines, k)["body"], F.lit("\n"), F.get(lines, k + 1)["body"])


def _pairs(text: Column, reach: int) -> Column:
    """Array of the pairs of a text: number, first and last line, hash, lengths, whether a boundary."""

    def rolled(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x["body"]), 1, 7), 16, 10).cast("long"))
        ones = F.slice(hashes, 1, F.size(hashes) - 1)
        return F.zip_with(ones, F.slice(hashes, 2, F.size(hashes) - 1), lambda a, b: (a * WEIGHT + b) % MODULUS)

    def least(hashes: Column) -> Column:
        last = F.greatest(F.size(hashes) - reach, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda j: F.array_min(F.slice(hashes, j + 1, reach)))

    def described(lines: Column, hashes: Column, minima: Column) -> Column:
        def pair(h: Column, k: Column) -> Column:
            start = F.greatest(k - (reach - 1), F.lit(0))
            here, there = F.get(lines, k), F.get(lines, k + 1)
            return F.struct(
                k.alias("k"), here["place"].alias("first"), there["place"].alias("last"),
                F.xxhash64(_body(lines, k)).alias("mark"), F.length(here["body"]).alias("own"),
                F.length(there["body"]).alias("next"),
                F.array_contains(F.slice(minima, start + 1, k - start + 1), h).alias("is_boundary"),
            )

        return F.transform(hashes, pair)

    def of_lines(lines: Column) -> Column:
        found = let(rolled(lines), lambda hashes: let(least(hashes), lambda minima: described(lines, hashes, minima)))
        return F.when(F.size(lines) > 1, found).otherwise(F.array().cast(_PLACES))

    return let(_filled(text), of_lines)


def drop_repeated_chunks(docs: DataFrame, reach: int = 3, min_chars: int = 40) -> DataFrame:
    """`docs` with texts cut, and n_lines, n_removed (lines), n_chunks_removed."""
    added = ["n_lines", "n_removed", "n_chunks_removed"]
    own = [c for c in docs.columns if c not in added]
    # other columns of the caller are carried as one struct, so that no name can clash
    others = F.struct(F.lit(0).alias("_none"), *(F.col(c) for c in own if c not in ("text", "n_chars")))
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").isNull().alias("id_null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.md5(F.coalesce(text, F.lit(""))).alias("digest"), text.alias("text"), others.alias("row"),
    )

    pairs = rows.where(F.col("text").isNotNull()).select(*KEY, F.inline(_pairs(F.col("text"), reach)))
    pairs = stage_table(pairs, "line-pairs")
    here = F.struct(*KEY, "k")
    # repeated rows are one document
    firsts = pairs.groupBy("mark").agg(F.min(here).alias("place"), F.max(here).alias("other")).where("place != other")
    firsts = stage_table(firsts.select("mark", F.col("place").alias("first_place")), "first-pairs")
    marked = pairs.join(firsts, "mark").withColumn("is_first", here == F.col("first_place")).drop("first_place")
    marks = marked.groupBy(*KEY).agg(F.collect_set(F.struct("k", "mark", "is_first")).alias("marks"))
    marks = stage_table(marks, "pair-marks")
    met = stage_table(rows.join(marks, KEY, "left"), "marked-texts")

    touched = met.where(F.col("marks").isNotNull())
    lines = let(
        _filled(F.col("text")),
        lambda lines: F.transform(
            "marks", lambda m: F.struct(m["k"].alias("k"), m["mark"].alias("mark"), m["is_first"].alias("is_first"),
                                        _body(lines, m["k"]).alias("body"))
        ),
    )
    bodies = touched.dropDuplicates(KEY).select(*KEY, F.inline(lines))
    bodies = stage_table(bodies, "marked-pairs")
    kept = bodies.where("is_first").select("mark", F.col("body").alias("first_body"))
    same = bodies.where(~F.col("is_first")).join(kept, "mark").where(F.col("body") == F.col("first_body"))
    again = pairs.dropDuplicates([*KEY, "k"]).join(same.select(*KEY, "k"), [*KEY, "k"])
    # runs of pairs; the pairs of one document at most meet
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy("k"))
    runs = again.withColumn("run", F.col("k") - nth).groupBy(*KEY, "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("is_boundary").alias("is_chunk"),
        (F.sum(F.col("own") + 1) + F.max_by("next", "k")).alias("chars"),
    )
    runs = runs.where(F.col("is_chunk") & (F.col("chars") >= min_chars))
    gone = stage_table(runs.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("gone")), "gone-lines")

    none = F.lit(0).cast("long")
    cut = touched.drop("marks").join(gone, KEY, "left").withColumn("lines", F.split("text", "\n"))
    spans = F.coalesce("gone", F.array().cast("array<struct<first:int,last:int>>"))
    stays = F.filter(
        "lines", lambda _, i: ~F.exists(spans, lambda s: (s["first"] <= i) & (i <= s["last"]))
    )
    cut = cut.withColumn("stays", stays).select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stays")).cast("long").alias("n_removed"),
        F.size(spans).cast("long").alias("n_chunks_removed"), F.array_join("stays", "\n").alias("new_text"),
    )
    whole = met.where(F.col("marks").isNull()).select(
        "row",
        F.coalesce(F.size(F.split("text", "\n")).cast("long"), none).alias("n_lines"),
        none.alias("n_removed"), none.alias("n_chunks_removed"),
        F.col("text").alias("new_text"),
    )
    out = cut.unionByName(whole)
    changed = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    columns = [(changed[c] if c in changed else F.col("row")[c]).alias(c) for c in own]
    counts = [F.when(F.col("new_text").isNull(), none).otherwise(F.col(c)).alias(c) for c in added]
    return out.select(*columns, *counts)
