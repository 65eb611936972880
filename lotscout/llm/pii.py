"""Personal data: patterns, and terms that give away whom a passage is about.

Pattern matches (mail, address, card, phone) are mentions of protected entities, on three levels: the
value itself; the values linked with it, which share a mail domain, a network, a card issuer or a dialling
code; and all values of its kind. For terms written near mentions, corpus counts tell how strongly a
term reveals an entity: with n(t, e) documents that have t near e, n(t) documents that have t anywhere
and n(e) documents that have e, of N,
p(e|t) = n(t, e) / n(t), and the information gained is log2(p(e|t) N / n(e)) bits. A term that
exceeds both thresholds, with enough joint documents for the estimate, is disclosing: above
`remove_at` it is removed wherever it stands in the corpus, below it is generalised.

Terms meet documents through buckets of their hashes: the set of buckets has a fixed size limit and
thins the words of all texts before the join that decides. Counts are aggregated before they are
shuffled, and no entity's documents are gathered.

Defined results: a null text is empty; rows with one doc_id and text are one document and get the
same answer; documents with a null id take part like any other. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.llm.native import let, places
from lotscout.sources.snapshot import stage_table

# What counts as a match. Runs are taken whole (possessive), which finds the same
# matches as trying shorter ones would, in linear time.
MAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ADDRESS_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"

KINDS = ("email", "ip", "card", "phone")
GENERALISED, REMOVED = "generalised", "removed"
LETTER = r"[\p{L}\p{M}\p{Nd}]"
TERM = LETTER + "++"  # words of any length
BUCKETS = 1 << 20  # of term hashes; bounds what is broadcast at about a million integers
KEY = ["id_null", "id", "digest"]
SPAN = "struct<kind:string,first:long,last:long>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def checked(digits: Column) -> Column:
        def weighted(c: Column, i: Column) -> Column:
            d = c.cast("int")
            twice = d * 2
            return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

        each = F.transform(F.split(F.reverse(digits), ""), weighted)
        return F.aggregate(each, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0

    return let(_digits(value), checked)


def _matches(text: Column) -> Column:
    """Array of (kind, first, last, value), by kind and then place."""
    rules = [
        ("email", MAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        ("ip", ADDRESS, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(ADDRESS_PARTS)),
        ("card", CARD, text.rlike(r"[0-9][\x20-]?[0-9]"), _luhn),
        ("phone", PHONE, text.rlike(r"\+[0-9]"), lambda v: F.length(_digits(v)).between(9, 15)),
    ]
    found = []
    for kind, pattern, possible, valid in rules:
        good = F.filter(places(text, pattern), lambda m: valid(m["value"]))
        named = F.transform(
            good,
            lambda m: F.struct(
                F.lit(kind).alias("kind"), m["first"].alias("first"), m["last"].alias("last"), m["value"].alias("value")
            ),
        )
        empty = F.array().cast("array<struct<kind:string,first:long,last:long,value:string>>")
        found.append(F.when(possible, named).otherwise(empty))
    return F.concat(*found)


def listed(spans: Column) -> Column:
    """Spans as kind:first:last, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))), ","
    )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), doc_id.isNull().alias("id_null"), F.coalesce(doc_id, F.lit(0)).alias("id"),
        F.xxhash64(text).alias("digest"), text.alias("text"),
    )


def _entities(m: Column) -> Column:
    """The entities that a match mentions: its value, the values linked with it, its kind."""
    kind, value = m["kind"], F.lower(m["value"])
    digits = _digits(value)
    linked = (
        F.when(kind == "email", F.substring_index(value, "@", -1))
        .when(kind == "ip", F.substring_index(value, ".", 3))
        .otherwise(F.substring(digits, F.lit(1), F.when(kind == "card", 6).otherwise(4)))
    )
    exact = F.when(kind == "email", value).when(kind == "ip", value).otherwise(digits)
    return F.array(F.concat(kind, F.lit("="), exact), F.concat(kind, F.lit("~"), linked), kind)


def _near(text: Column, match: Column, reach: int) -> Column:
    """Text before and after a match, without the match and without words that the reach cuts."""
    # one character more on either side tells whether a word goes on there
    size = F.least(match["first"], F.lit(reach + 1)).cast("int")
    before = F.substring(text, (match["first"] - size + 1).cast("int"), size)
    after = F.substring(text, (match["last"] + 1).cast("int"), F.lit(reach + 1))
    before = F.when(size > reach, F.regexp_replace(before, f"(?s)^(?:{LETTER}+|.)", "")).otherwise(before)
    after = F.when(F.length(after) > reach, F.regexp_replace(after, f"(?s)(?:{LETTER}+|.)$", "")).otherwise(after)
    return F.concat_ws("\n", before, after)


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _thinned(words: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows of `words` whose term may be among `terms`: at most BUCKETS small rows are broadcast."""
    buckets = terms.select(_bucket(F.col("term")).alias("bucket")).distinct()
    return words.withColumn("bucket", _bucket(F.col("term"))).join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")


def disclosing_terms(
    rows: DataFrame, mentions: DataFrame, min_joint: int, min_probability: float, min_bits: float, remove_at: float
) -> DataFrame:
    """(term, kind) of the terms that exceed the thresholds for some entity."""
    near = mentions.select(
        *KEY, "entity", F.explode(F.array_distinct(F.regexp_extract_all("near", F.lit(TERM), F.lit(0)))).alias("term")
    ).distinct()
    near = stage_table(near, "pii-near")
    joint = near.groupBy("entity", "term").agg(F.count("*").alias("n_joint")).where(F.col("n_joint") >= min_joint)
    # a term has at least as many documents as it has near any entity, so this loses no term
    around = near.select(*KEY, "term").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    joint = joint.join(around, "term").where(F.col("n_joint") >= min_probability * F.col("n_near"))
    joint = stage_table(joint, "pii-joint")
    of_entity = mentions.select(*KEY, "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    words = rows.select(F.explode(_terms(F.col("text"))).alias("term"))
    of_term = _thinned(words, joint.select("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    documents = rows.agg(F.count("*").alias("n")).scalar()
    scored = joint.join(of_term, "term").join(of_entity, "entity")
    probability = F.col("n_joint") / F.col("n_term")
    scored = scored.select(
        "term", probability.alias("p"), F.log2(probability * documents / F.col("n_entity")).alias("bits")
    )
    scored = scored.where((F.col("p") >= min_probability) & (F.col("bits") >= min_bits))
    kind = F.when(F.max("p") >= remove_at, F.lit(REMOVED)).otherwise(F.lit(GENERALISED))
    return scored.groupBy("term").agg(kind.alias("kind"))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))


def find_personal_data(
    docs: DataFrame,
    reach: int = 48,
    min_joint: int = 3,
    min_probability: float = 0.5,
    min_bits: float = 4.0,
    remove_at: float = 0.9,
) -> DataFrame:
    """doc_id, key, n_email, n_ip, n_card, n_phone, base and spans (arrays of kind, first, last)."""
    rows = _keyed(docs)
    matched = rows.withColumn("matches", _matches(F.col("text")))
    mention = F.transform(
        "matches", lambda m: F.struct(*(m[c].alias(c) for c in ("kind", "first", "last", "value")), _near(F.col("text"), m, reach).alias("near"))
    )
    base = stage_table(matched.select("doc_id", *KEY, mention.alias("mentions")), "pii-base")
    mentions = base.select(*KEY, F.explode("mentions").alias("m"))
    mentions = mentions.select(*KEY, F.explode(_entities(F.col("m"))).alias("entity"), "m.near")
    terms = disclosing_terms(rows, mentions, min_joint, min_probability, min_bits, remove_at)
    terms = stage_table(terms, "pii-terms")

    words = rows.select(*KEY, F.explode(_terms(F.col("text"))).alias("term"))
    having = _thinned(words, terms).join(terms, "term")
    having = having.groupBy(*KEY).agg(F.collect_set(F.struct("term", "kind")).alias("terms"))
    having = stage_table(having, "pii-having")
    added = rows.join(having, KEY).select(*KEY, _term_spans(F.col("text"), F.col("terms")).alias("added"))
    added = stage_table(added.dropDuplicates(KEY), "pii-added")

    out = base.join(added, KEY, "left")
    plain = F.transform("mentions", lambda m: F.struct(m["kind"].alias("kind"), m["first"].alias("first"), m["last"].alias("last")))
    none = F.array().cast(f"array<{SPAN}>")
    counts = [
        F.size(F.filter("mentions", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return out.select(
        "doc_id", *KEY, *counts, plain.alias("base"), F.concat(plain, F.coalesce("added", none)).alias("spans")
    )


def _term_spans(text: Column, terms: Column) -> Column:
    """Places of whole terms, by kind and then place."""
    parts = []
    for kind in (GENERALISED, REMOVED):
        mine = F.transform(F.filter(terms, lambda t: t["kind"] == kind), lambda t: t["term"])
        pattern = F.concat(F.lit(f"(?<!{LETTER})(?:"), F.array_join(mine, "|"), F.lit(f")(?!{LETTER})"))
        spans = F.transform(
            places(text, pattern),
            lambda m: F.struct(F.lit(kind).alias("kind"), m["first"].alias("first"), m["last"].alias("last")),
        )
        parts.append(F.when(F.size(mine) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.concat(*parts)


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind; a removed term leaves nothing behind."""
    spans = found.select(*KEY, "spans").dropDuplicates(KEY)
    rows = _keyed(docs).join(spans, KEY, "left")
    ordered = F.sort_array(
        F.transform("spans", lambda s: F.struct(s["first"].alias("first"), (-s["last"]).alias("minus_last"), s["kind"].alias("kind")))
    )

    def step(done: Column, s: Column) -> Column:
        last = -s["minus_last"]
        size = s["first"] - done["at"]
        mark = F.when(s["kind"] == REMOVED, F.lit("")).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        piece = F.substring(F.col("text"), (done["at"] + 1).cast("int"), size.cast("int"))
        grown = F.struct(last.alias("at"), F.concat(done["parts"], F.array(piece, mark)).alias("parts"))
        return F.when(size >= 0, grown).otherwise(
            F.struct(F.greatest(done["at"], last).alias("at"), done["parts"].alias("parts"))
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    walked = let(
        F.aggregate(F.coalesce(ordered, F.array().cast("array<struct<first:long,minus_last:long,kind:string>>")), start, step),
        lambda w: F.concat(F.array_join(w["parts"], ""), F.substring(F.col("text"), (w["at"] + 1).cast("int"), F.length("text"))),
    )
    return rows.select("doc_id", walked.alias("text"))
