"""Quality rules: repetition counts, and how far a document's make-up is from its language's.

Two histograms describe a document: characters by class, and common words of its language with one
cell for all other words. The reference of a language is the sum over all its documents. A
document is dropped if the Jensen-Shannon distance of either histogram is above its limit. Short
documents are exempt from each test they have too few characters or words for, as their
histograms say little.

Defined results: a null text is empty and fails the base rule; documents without a language, or of
one without a word list, share one reference per language value and take the character test only.
Each row of the input gives one row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.llm.native import js_distance, long, words
from lotscout.sources.snapshot import stage_table

# Common words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "as", "with", "be"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}
SYMBOLS = r"[^#*$%&|<>]+"  # all but the counted characters
MIN_WORDS, MAX_REPEATED = 50, 0.5


def _only(text: Column, others: str) -> Column:
    """Number of characters left when runs of others are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _forms(lang: str) -> list[str]:
    return sorted({form for w in COMMON[lang] for form in (w, w.capitalize())})


def _common_counts(lang: Column) -> Column:
    """Counts of the common words of the document's language."""
    counts = F.array().cast("array<double>")
    for name, listed in COMMON.items():
        cells = F.transform(
            F.array(*map(F.lit, listed)), lambda c: F.size(F.filter("common", lambda w: w == c)).cast("double")
        )
        counts = F.when(lang == name, cells).otherwise(counts)
    return counts


def _common_words(lang: Column) -> Column:
    chosen = F.array().cast("array<string>")
    for name in COMMON:
        mine = F.filter(F.col("words"), lambda w: w.isin(_forms(name)))
        chosen = F.when(lang == name, F.transform(mine, lambda w: F.lower(w))).otherwise(chosen)
    return chosen


def _repeated_places(order: Column) -> Column:
    """Places of windows that the text has twice, from windows sorted by hash and place."""

    def twin(x: Column, i: Column) -> Column:
        before = F.get(order, i - 1)["hash"]
        after = F.get(order, i + 1)["hash"]
        return F.coalesce(x["hash"] == before, F.lit(False)) | F.coalesce(x["hash"] == after, F.lit(False))

    return F.sort_array(F.transform(F.filter(order, twin), lambda x: x["at"]))


def document_measures(docs: DataFrame) -> DataFrame:
    """Counts and histograms of every document, from one pass over the texts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("*", words(F.col("text")).alias("words"), lines.alias("lines"))
    rows = rows.select(
        "doc_id", "lang", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _only(F.col("text"), SYMBOLS).alias("n_symbols"),
        _only(F.col("text"), r"[^\p{L}]+").alias("n_letters"),
        _only(F.col("text"), r"[^\p{Lu}]+").alias("n_upper"),
        _only(F.col("text"), r"[^0-9]+").alias("n_digits"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        _common_words(F.col("lang")).alias("common"),
    )
    hashes = F.col("hashes")
    window = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )
    rows = rows.withColumn(
        "windows", F.when(F.col("n_words") >= 3, window).otherwise(F.array().cast("array<long>"))
    )
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    has_twins = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("order", F.when(has_twins, F.sort_array(placed)))
    rows = rows.withColumn(
        "twins", F.when(F.col("order").isNotNull(), _repeated_places(F.col("order")))
    )
    twins = F.col("twins")
    spread = F.transform(twins, lambda p, i: F.least(F.coalesce(F.get(twins, i + 1) - p, F.lit(3)), F.lit(3)))
    repeated = F.aggregate(spread, long(0), lambda s, x: s + x)
    plain = F.col("n_chars") - F.col("n_letters") - F.col("n_digits") - F.col("n_symbols")
    spaces = F.col("n_chars") - F.col("word_chars")
    classes = [
        F.col("n_letters") - F.col("n_upper"), F.col("n_upper"), F.col("n_digits"), F.col("n_symbols"),
        spaces, F.greatest(plain - spaces, long(0)),
    ]
    common = _common_counts(F.col("lang"))
    return rows.select(
        "doc_id", "lang", "n_words", "n_chars", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("twins").isNull(), long(0)).otherwise(repeated).alias("n_repeat_words"),
        F.array(*classes).cast("array<double>").alias("classes"),
        F.concat(common, F.array((F.col("n_words") - F.size("common")).cast("double"))).alias("vocabulary"),
    )


def references(measures: DataFrame) -> DataFrame:
    """One row per language: the two histograms summed over all its documents."""
    widest = max(len(v) for v in COMMON.values()) + 1

    def summed(column: str, cells: int) -> Column:
        sums = F.array(*(F.sum(F.get(F.col(column), F.lit(i))) for i in range(cells)))
        return F.filter(sums, lambda x: x.isNotNull()).alias(f"{column}_reference")

    return measures.groupBy("lang").agg(summed("classes", 6), summed("vocabulary", widest))


def judge(
    docs: DataFrame,
    max_class_distance: float = 0.28,
    max_word_distance: float = 0.315,
    min_chars: int = 200,
    min_judged_words: int = 100,
) -> DataFrame:
    """Measures, base rule, distances and verdict of every document."""
    measures = stage_table(document_measures(docs), "quality-measures")
    known = measures.join(references(measures), "lang")
    known = known.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))).alias(
            "base_failed"
        ),
        js_distance(F.col("classes"), F.col("classes_reference")).alias("class_distance"),
        js_distance(F.col("vocabulary"), F.col("vocabulary_reference")).alias("word_distance"),
    )
    far = ((F.col("n_chars") >= min_chars) & (F.col("class_distance") > max_class_distance)) | (
        (F.col("n_words") >= min_judged_words) & (F.col("word_distance") > max_word_distance)
    )
    return known.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance",
    )
