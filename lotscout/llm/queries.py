"""Registered queries of the operators over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotscout.llm.features import is_training
from lotscout.session import tuned

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function of (spark, sf_dir) under its own name."""

    def register(run: Run) -> Run:
        RUNS[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


@query()
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.substring_dedup import remove_repeated_passages

    return remove_repeated_passages(table(spark, sf_dir, "documents"), with_text=False)


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


@query()
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.decontaminate import find_benchmark

    found = find_benchmark(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near",
    )


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents"))


@query(
    """
    WITH doc AS (
      SELECT doc_id, text, md5(coalesce(text, '')) AS digest, count(*) AS copies FROM documents GROUP BY ALL
    ), line AS (
      SELECT doc_id, digest, unnest(string_split(text, chr(10))) AS body,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM doc WHERE text IS NOT NULL
    ), filled AS (
      SELECT *, ('0x' || substr(md5(body), 1, 7))::BIGINT AS h, row_number() OVER (PARTITION BY doc_id, digest ORDER BY i) AS k
      FROM line WHERE trim(body, ' ') <> ''
    ), pair AS (
      SELECT doc_id, digest, k, i AS first, lead(i) OVER w AS last, body, lead(body) OVER w AS next,
        (31 * h + lead(h) OVER w) % 1000003 AS r, count(*) OVER (PARTITION BY doc_id, digest) - 1 AS n
      FROM filled WINDOW w AS (PARTITION BY doc_id, digest ORDER BY k)
    ), least AS (
      SELECT *, CASE WHEN k <= greatest(n - 2, 1) THEN min(r) OVER (PARTITION BY doc_id, digest ORDER BY k
        ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) END AS m FROM pair WHERE next IS NOT NULL
    ), judged AS (
      SELECT *, coalesce(r = m, false) OR coalesce(r = lag(m) OVER w, false) OR coalesce(r = lag(m, 2) OVER w, false) AS is_boundary,
        row_number() OVER (PARTITION BY body, next ORDER BY doc_id NULLS LAST, digest, k) > 1 AS again
      FROM least WINDOW w AS (PARTITION BY doc_id, digest ORDER BY k)
    ), run AS (
      SELECT doc_id, digest, min(first) AS first, max(last) AS last FROM (
        SELECT *, k - row_number() OVER (PARTITION BY doc_id, digest ORDER BY k) AS run FROM judged WHERE again
      ) GROUP BY doc_id, digest, run
      HAVING bool_or(is_boundary) AND sum(length(body) + 1) + max_by(length(next), k) >= 40
    ), cut AS (
      SELECT l.doc_id, l.digest, count(*) AS n_lines, count(r.first) AS n_removed, count(DISTINCT r.first) AS n_chunks_removed,
        coalesce(string_agg(l.body, chr(10) ORDER BY l.i) FILTER (r.first IS NULL), '') AS kept
      FROM line l LEFT JOIN run r ON l.doc_id IS NOT DISTINCT FROM r.doc_id AND l.digest = r.digest AND l.i BETWEEN r.first AND r.last
      GROUP BY l.doc_id, l.digest
    ), whole AS (
      SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
        coalesce(n_chunks_removed, 0)::BIGINT AS n_chunks_removed, sha256(kept) AS kept_sha256, unnest(range(copies)) AS copy
      FROM doc d LEFT JOIN cut c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.digest = c.digest AND d.text IS NOT NULL
    )
    SELECT doc_id, n_lines, n_removed, n_chunks_removed, kept_sha256 FROM whole
    """
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.line_dedup import drop_repeated_chunks

    cut = drop_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_chunks_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.pii import KINDS, find_personal_data, listed

    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(f"n_{kind}" for kind in KINDS),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def _verdict(rows: DataFrame, limit: float) -> DataFrame:
    held_out = F.coalesce(~is_training(F.col("doc_id")), F.lit(False))
    return rows.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"),
        *(c for c in rows.columns if c not in ("doc_id", "score")),
    )


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.quality_classifier import scored, trained

    docs = table(spark, sf_dir, "documents")
    return _verdict(scored(docs, trained(docs, table(spark, sf_dir, "labels")), ["doc_id"]), 0.5)


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.toxicity import scored, trained

    docs = table(spark, sf_dir, "documents")
    return _verdict(scored(docs, trained(docs, table(spark, sf_dir, "labels")), ["doc_id"]), 0.7)


@query()
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.mixing import mixed

    return mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.suffix_dedup import remove_repeated_bytes

    return remove_repeated_bytes(table(spark, sf_dir, "documents"), with_bytes=False)


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.tokenizer_links import align

    found = align(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query()
def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotscout.llm.context_mixing import score_texts

    return score_texts(table(spark, sf_dir, "documents"))
