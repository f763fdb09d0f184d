"""Queries of this subpackage's operators over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synaxis.llm import groups, leaks, packing, spamlines, variants
from synaxis.session import read_table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every record of the match pairs."""
    return groups.group_records(read_table(spark, sf_dir, "entity_resolution_matches"), "id_l", "id_r")


def p7_contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of alias rows that name the same contractor."""
    return variants.contractor_pairs(read_table(spark, sf_dir, "contractor_aliases"), "alias_id", "vat", "canonical_name")


def p7_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alias row's class of equal records, and how many other classes name the same contractor."""
    return variants.contractor_members(read_table(spark, sf_dir, "contractor_aliases"), "alias_id", "vat", "canonical_name").withColumnRenamed("id", "alias_id")


def p7_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered organisations of awards that carry no tax id and a differently typed name."""
    awards = read_table(spark, sf_dir, "auction").filter("organizationVatNumber is null")
    return variants.organisation_links(read_table(spark, sf_dir, "entities"), "org_id", "name", awards, "row_id", "organization.value")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links between name variants."""
    alias = p7_contractors(spark, sf_dir).select(F.lit("alias").alias("side"), "key_a", "key_b")
    return alias.unionByName(p7_organisations(spark, sf_dir).select(F.lit("organisation").alias("side"), "key_a", "key_b"))


CAPACITY = 8192


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, or piece of a larger one, with its container."""
    # ByT5: one token per UTF-8 byte and one end mark per document; a null text is an empty one
    tokens = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    return packing.pack(read_table(spark, sf_dir, "documents"), F.col("doc_id"), tokens, CAPACITY)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that had to be cut."""
    cut_items = p8_containers(spark, sf_dir).filter("n_pieces > 1")
    return cut_items.select(F.col("item").alias("doc_id")).distinct()


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a packing must hold: tokens and documents placed, documents in pieces, containers over capacity, and waste.

    ``within_bound``: no more than 1 % and two containers above what the tokens alone need.
    """
    placed = p8_containers(spark, sf_dir)
    fill = placed.groupBy("container").agg(F.sum("length").cast("long").alias("filled"), F.count(F.lit(1)).alias("n"))
    per = fill.agg(F.sum("filled").alias("n_tokens"), F.count(F.lit(1)).alias("n_containers"), F.count_if(F.col("filled") > CAPACITY).alias("n_over"), F.sum("n").alias("n_placed"))
    items = placed.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.max("n_pieces").alias("n_pieces"), F.count_distinct("start").alias("n_starts"))
    whole = items.agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("n_pieces") > 1).alias("n_cut"), F.count_if((F.col("n") != F.col("n_pieces")) | (F.col("n_starts") != F.col("n"))).alias("n_torn"))
    both = per.unionByName(whole, allowMissingColumns=True).agg(*[F.sum(c).cast("long").alias(c) for c in (*per.columns, *whole.columns)])
    least = F.ceil(F.col("n_tokens") / CAPACITY)
    return both.select("n_tokens", "n_placed", "n_docs", "n_cut", "n_over", "n_torn", (F.col("n_containers") <= least * 1.01 + 2).alias("within_bound"))


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every evaluation item in every document that holds a passage of it, with its place."""
    documents, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items")
    return leaks.leaks(documents, "doc_id", "text", items, "item_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the evaluation items they leak."""
    return p9_passages(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that remain when all that leak an item are removed."""
    documents = read_table(spark, sf_dir, "documents")
    return documents.join(p9_found(spark, sf_dir).select("doc_id"), "doc_id", "left_anti").select("doc_id", "lang", "source")


def p9_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unbroken run of 13 or more equal words of a document and an item, with its places."""
    documents, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items")
    return leaks.verbatim(documents, "doc_id", "text", items, "item_id", "text", 13)


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of every document's words by kind of line."""
    return spamlines.line_shares(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mostly keyword, link, tag or product lines."""
    return spamlines.stuffed(p10_shares(spark, sf_dir)).select("doc_id")


QUERIES = {
    "p3_found": p3_found,
    "p10_found": p10_found,
    "p10_shares": p10_shares,
    "p7_contractors": p7_contractors,
    "p7_found": p7_found,
    "p7_members": p7_members,
    "p7_organisations": p7_organisations,
    "p8_checks": p8_checks,
    "p8_containers": p8_containers,
    "p8_found": p8_found,
    "p9_clean": p9_clean,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p9_verbatim": p9_verbatim,
}

P3_SQL = """WITH RECURSIVE e AS (SELECT id_l AS a, id_r AS b FROM entity_resolution_matches WHERE id_l IS NOT NULL AND id_r IS NOT NULL UNION SELECT id_r, id_l FROM entity_resolution_matches WHERE id_l IS NOT NULL AND id_r IS NOT NULL),
    v AS (SELECT id_l AS a FROM entity_resolution_matches WHERE id_l IS NOT NULL UNION SELECT id_r FROM entity_resolution_matches WHERE id_r IS NOT NULL),
    reach AS (SELECT a, a AS b FROM v UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
    SELECT a AS record_id, min(b) AS group_id FROM reach GROUP BY 1"""

P8_SQL = "SELECT doc_id FROM documents WHERE strlen(text) + 1 > 8192"

P8_CHECKS_SQL = """SELECT cast(sum(n) AS BIGINT) AS n_tokens, cast(sum((n + 8191) // 8192) AS BIGINT) AS n_placed, count(*) AS n_docs, count(*) FILTER (n > 8192) AS n_cut,
    cast(0 AS BIGINT) AS n_over, cast(0 AS BIGINT) AS n_torn, true AS within_bound FROM (SELECT strlen(coalesce(text, '')) + 1 AS n FROM documents)"""


def _grams(table: str, key: str, n: int) -> str:
    return f"""SELECT {key}, p, array_to_string(w[p:p + {n - 1}], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - {n - 2})) AS p
    FROM (SELECT {key}, regexp_extract_all(text, '[{leaks.LETTERS}]+') AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= {n})"""


P9_VERBATIM_SQL = f"""WITH d AS ({_grams("documents", "doc_id", 13)}), t AS ({_grams("eval_items", "item_id", 13)}),
    j AS (SELECT doc_id, item_id, d.p AS dp, t.p AS tp FROM d JOIN t ON d.g = t.g),
    r AS (SELECT *, dp - row_number() OVER (PARTITION BY doc_id, item_id, dp - tp ORDER BY dp) AS island FROM j)
    SELECT doc_id, item_id, cast(min(dp) - 1 AS INT) AS first_word, cast(min(tp) - 1 AS INT) AS item_word, cast(count(*) + 12 AS INT) AS n_words FROM r GROUP BY doc_id, item_id, dp - tp, island"""

ORACLE: dict[str, str] = {"p9_verbatim": P9_VERBATIM_SQL, "p3_found": P3_SQL, "p8_checks": P8_CHECKS_SQL, "p8_found": P8_SQL}
