"""Queries of the general training-data operators over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synaxis.functions.scalars import VALUE_CAP, normalize_vat, to_day, to_number
from synaxis.operators import drift, heavy_keys, nested, quality, spikes
from synaxis.plans import problems_sql
from synaxis.session import cut, q, read_table

AMOUNT = "totalCostWithoutVAT"
VAT = "organizationVatNumber"
OBJECTS = "objectDetailsList"
MEMBERS = "contractingDataDetails.contractingMembersDataList"


def _drift(spark: SparkSession, sf_dir: str):
    raw = read_table(spark, sf_dir, "contract_raw")
    values = cut(drift.path_values(raw))
    return raw, values, drift.changes(values, drift.file_order(raw))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of a file's fields against the previous file of its feed."""
    return _drift(spark, sf_dir)[2].select("file_name", "field_path", "change_kind", "old_path")


def p1_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw contract records in one typed table."""
    raw, values, found = _drift(spark, sf_dir)
    return drift.consistent_table(raw, drift.consistent_types(values, found))


def p1_failed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.failed_casts(p1_table(spark, sf_dir))


def _rules() -> list[quality.ColumnRule]:
    amount, vat, kind = q(AMOUNT), q(VAT), quality.list_kind_udf(q(OBJECTS))
    number = to_number(amount)
    return [
        quality.ColumnRule(AMOUNT, quality.amount_well_formed(amount), quality.text_form(amount), number),
        quality.ColumnRule(VAT, quality.vat_well_formed(vat), quality.text_form(vat), F.lit(None).cast("double")),
        quality.ColumnRule(OBJECTS, kind == "well formed", kind, F.lit(None).cast("double")),
    ]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ill-formed values and departing loads of three columns of the awards."""
    return quality.findings(read_table(spark, sf_dir, "auction"), "row_id", "load_id", _rules())


def p2_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ill-formed values alone, each with the form it has."""
    cells = quality.observe(read_table(spark, sf_dir, "auction"), "row_id", "load_id", _rules())
    return cells.filter("violates").select("column_name", "row_id", F.when(F.col("column_name") == OBJECTS, F.col("form")).alias("kind"))


def p2_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the three columns over all loads."""
    return quality.profile(cut(quality.observe(read_table(spark, sf_dir, "auction"), "row_id", "load_id", _rules())))


def _registered(spark: SparkSession, sf_dir: str, act: str, value: str) -> DataFrame:
    """Rows of an act table with the nine-digit tax id of a registered organisation."""
    registry = read_table(spark, sf_dir, "entities").select(q("vat").alias("vat")).distinct()
    rows = read_table(spark, sf_dir, act).select(
        "row_id",
        normalize_vat(q(VAT)).alias("vat"),
        q(value).alias("v"),
        to_day(q("submissionDate")).alias("day"),
        F.when(
            q("_source_month").between(1, 12) & q("_source_year").between(1, 9999),
            F.make_date("_source_year", "_source_month", F.lit(1)),
        ).alias("month"),
    )
    return rows.filter("v is not null").join(registry, "vat", "left_semi")


def p4_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged amounts and bid counts with the reasons."""
    v = F.col("v")
    measurements = (
        ("auction", "totalCostWithVAT", (v <= 0) | (v > VALUE_CAP), spikes.Limits(min_run=8)),
        ("contract", "bidsSubmitted", (v < 1) | (v != F.floor(v)) | (v >= 300_000), spikes.Limits(min_run=12)),
    )
    found = [
        spikes.implausible(
            _registered(spark, sf_dir, act, column), F.col("vat"), F.col("row_id"), v, F.col("day"), F.col("month"), impossible, limits,
            read_table(spark, sf_dir, act).count(),  # from the footers
        ).select(F.lit(act).alias("act"), F.col("pos").alias("row_id"), F.array_join("reasons", ",").alias("reasons"))
        for act, column, impossible, limits in measurements
    ]
    return found[0].unionByName(found[1])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implausible amounts and bid counts."""
    return p4_reasons(spark, sf_dir).select("act", "row_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax ids that hold at least 2 % of all awards."""
    return heavy_keys.heavy(p5_profile(spark, sf_dir)).select(F.col("vat"))


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per organisation: rows, amounts and upward steps in order of arrival."""
    auction = read_table(spark, sf_dir, "auction")
    result = heavy_keys.per_key(
        auction, normalize_vat(q("organizationVatNumber")), q("row_id"), q("totalCostWithVAT")
    )
    measures = ("n", "n_values", "low", "high", "first_v", "last_v", "n_up", "n_all")
    return result.select(F.col("k").alias("vat"), *measures)


CPV_CHAIN = nested.Chain(OBJECTS, ("object", "cpv"), ("cpvs",), "key")
MEMBER_CHAIN = nested.Chain(MEMBERS, ("member",), (), "vatNumber")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object, cpv and member of every award, with its place."""
    return nested.child_rows(read_table(spark, sf_dir, "auction"), "row_id", [CPV_CHAIN, MEMBER_CHAIN])


def p6_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf path below the repeated nodes of both lists, with its types and counts."""
    auction = read_table(spark, sf_dir, "auction")
    parts = [nested.leaf_paths(auction, c).select(F.lit(c).alias("column_name"), "*") for c in (OBJECTS, MEMBERS)]
    return parts[0].unionByName(parts[1])


def p6_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = nested.Chain(OBJECTS, ("object",))
    leaves = ["quantity", "costWithoutVAT", "shortDescription", "units.key", "units.value"]
    return nested.child_table(read_table(spark, sf_dir, "auction"), "row_id", chain, leaves).withColumnRenamed("p0", "pos")


def p6_cpvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nested.child_table(read_table(spark, sf_dir, "auction"), "row_id", CPV_CHAIN, ["key", "value"])
    return out.withColumnsRenamed({"p0": "pos", "p1": "sub_pos"})


def p6_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = ["vatNumber", "name", "country.key", "greekVatNumber"]
    out = nested.child_table(read_table(spark, sf_dir, "auction"), "row_id", MEMBER_CHAIN, leaves)
    return out.withColumnRenamed("p0", "pos")


ORACLE = problems_sql.ORACLE

QUERIES = {
    "p1_found": p1_found,
    "p1_table": p1_table,
    "p1_failed_casts": p1_failed_casts,
    "p2_found": p2_found,
    "p2_profile": p2_profile,
    "p2_violations": p2_violations,
    "p4_found": p4_found,
    "p4_reasons": p4_reasons,
    "p5_found": p5_found,
    "p5_profile": p5_profile,
    "p6_found": p6_found,
    "p6_leaves": p6_leaves,
    "p6_objects": p6_objects,
    "p6_cpvs": p6_cpvs,
    "p6_members": p6_members,
}
