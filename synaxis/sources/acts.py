"""Act tables to one clean shape: deduplicated, dots renamed, amounts, dates and tax ids normalised."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synaxis.functions import scalars as S
from synaxis.session import Cut, exists, file_signature, q, read_table


def dedupe(df: DataFrame, key: str, order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key, the last (or first) in ``order``; rows with a null key all survive, as they are.

    Rows without a key take no part in the ranking, so they never meet in one task.
    """
    direction = F.desc if keep == "last" else F.asc
    w = Window.partitionBy(q(key)).orderBy(*[direction(c) for c in order])
    kept = df.filter(q(key).isNotNull()).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return kept.unionByName(df.filter(q(key).isNull()))


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a target schema: missing columns become typed nulls, others are cast, the rest dropped."""
    have = set(df.columns)
    return df.select(
        *[(q(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    )


def union_aligned(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Union of frames whose columns differ, in the target schema; no frames give an empty one."""
    out = None
    for frame in frames:
        part = align(frame, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = SparkSession.getActiveSession().createDataFrame([], schema)
    return out


def load_files(spark: SparkSession, pattern: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Monthly files by glob: merged schema, year and month from the file name, missing columns null.

    File names are ``<entity>_<YYYY>_<MM>.parquet``; the name and the row's place in the file are
    kept as ``_file`` and ``_row`` so that "last" has one meaning.
    """
    df = spark.read.option("mergeSchema", True).parquet(pattern)
    name = F.col("_metadata.file_name")
    extra = [
        F.regexp_extract(name, r"_(\d{4})_(\d{2})\.parquet$", 1).try_cast("int").alias("_source_year"),
        F.regexp_extract(name, r"_(\d{4})_(\d{2})\.parquet$", 2).try_cast("int").alias("_source_month"),
        name.alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    ]
    wanted = columns if columns is not None else df.columns
    have = set(df.columns)
    return df.select(*[q(c) if c in have else F.lit(None).cast("string").alias(c) for c in wanted], *extra)


def act_value(without: Column, with_vat: Column) -> Column:
    """Amount of an act: without tax, else with; implausibly large ones null, without falling back."""
    return S.sanitize_value(F.coalesce(S.to_number(without), S.to_number(with_vat)))


def array_text(text: Column) -> Column:
    """The text where it is a JSON array, else null (bad JSON, objects and scalars)."""
    return F.when(F.json_array_length(text) >= 0, text)


def first_cpv(text: Column) -> Column:
    """(key, value) of the first code of the first object, null where there is none."""
    array = array_text(text)
    return F.struct(
        F.get_json_object(array, "$[0].cpvs[0].key").alias("key"), F.get_json_object(array, "$[0].cpvs[0].value").alias("value")
    )


def first_member(text: Column) -> Column:
    """(vat, name) of the first contractor, null where there is none."""
    array = array_text(text)
    return F.struct(F.get_json_object(array, "$[0].vatNumber").alias("vat"), F.get_json_object(array, "$[0].name").alias("name"))


def name_counts(frames: Sequence[DataFrame]) -> DataFrame:
    """(name, vat, n): how often each name comes with each valid tax id, over several act tables."""
    parts = [
        f.select(q("organization.value").alias("name"), S.normalize_vat(q("organizationVatNumber")).alias("vat")) for f in frames
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("name is not null and vat is not null").groupBy("name", "vat").agg(F.count(F.lit(1)).alias("n"))


def build_resolver(counts: DataFrame, min_share: float = 0.9) -> DataFrame:
    """(name, vat): the tax id that holds at least ``min_share`` of a name's rows; unique per name."""
    total = F.sum("n").over(Window.partitionBy("name"))
    return counts.withColumn("share", F.col("n") / total).filter(F.col("share") >= min_share).select("name", "vat")


_WRITTEN: dict[tuple[str, str, str], tuple[tuple, Cut]] = {}


def written(spark: SparkSession, sf_dir: str, kind: str, tables: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """A table made from others once per application, kept in the shared folder, and made anew when their files change."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    signature = tuple(file_signature(spark, f"{sf_dir}/{t}.parquet") for t in tables)
    if key not in _WRITTEN or _WRITTEN[key][0] != signature or not exists(spark, _WRITTEN[key][1].path):
        _WRITTEN[key] = (signature, Cut(build()))
    return _WRITTEN[key][1].read()


NAMED = ("auction", "contract", "notice")


def resolver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The organisations' names with their tax ids; written once, so that its true size decides how it is joined."""
    return written(spark, sf_dir, "resolver", NAMED, lambda: build_resolver(name_counts([read_table(spark, sf_dir, t) for t in NAMED])))


def resolve(df: DataFrame, names: DataFrame) -> DataFrame:
    """Fill a missing ``vat`` by the exact organisation name; the own one always wins.

    Only rows without a tax id look for their name. Where the join is no broadcast the others go by a hash of
    their own instead, so that no hot name draws them together.
    """
    lookup = names.select(F.col("name").alias("__name"), F.col("vat").alias("__vat"))
    by = F.when(F.col("vat").isNull(), F.col("org_name")).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*[c for c in df.columns if c in ("row_id", "vat", "org_name")]).cast("string")))
    return df.withColumn("__by", by).join(lookup, F.col("__by") == F.col("__name"), "left").withColumn("vat", F.coalesce("vat", "__vat")).drop("__vat", "__name", "__by")


def _base() -> list[Column]:
    return [
        F.col("row_id"),
        q("referenceNumber").alias("ref"),
        q("organization.value").alias("org_name"),
        S.normalize_vat(q("organizationVatNumber")).alias("vat"),
        S.normalize_vat(q("organizationVatNumber")).alias("own_vat"),
        q("_source_year").alias("year"),
        q("_source_month").alias("month"),
        q("submissionDate").alias("submitted"),
    ]


def _clean(spark: SparkSession, sf_dir: str, table: str, columns: list[Column]) -> DataFrame:
    """Rows of an act table in the clean shape; what is needed of the JSON texts is taken before the rows are shuffled."""
    df = read_table(spark, sf_dir, table).select(*_base(), *columns)
    return resolve(dedupe(df, "ref", ["row_id"]), resolver(spark, sf_dir))


def auctions(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """Awards, one row per reference number, with first code and first contractor taken from the JSON.

    Without the raw JSON texts (``raw``) the table is written once.
    """
    members = q("contractingDataDetails.contractingMembersDataList")
    columns = [
        q("procedureType.key").alias("proc_key"),
        q("procedureType.value").alias("proc_value"),
        q("contractType.value").alias("contract_type"),
        act_value(q("totalCostWithoutVAT"), q("totalCostWithVAT")).alias("value"),
        q("signedDate").alias("signed"),
        q("noticeRefNo").alias("notice_ref"),
        S.is_cancelled(q("cancelled")).alias("cancelled"),
        q("typeOfContractingAuthority").alias("authority"),
        q("classificationOfPublicLawOrganization.value").alias("classification"),
        q("nutsCode.key").alias("nuts_code"),
        q("nutsCode.value").alias("nuts_name"),
        q("nutsCity").alias("nuts_city"),
        first_cpv(q("objectDetailsList")).alias("cpv"),
        first_member(members).alias("member"),
    ]
    if raw:
        return _clean(spark, sf_dir, "auction", [*columns, q("objectDetailsList").alias("objects"), members.alias("members")])
    return written(spark, sf_dir, "auctions", NAMED, lambda: _clean(spark, sf_dir, "auction", columns))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = q("contractingDataDetails.contractingMembersDataList")
    columns = [
        q("procedureType.key").alias("proc_key"),
        q("procedureType.value").alias("proc_value"),
        F.coalesce(q("bidsSubmitted"), q("contract.bidsSubmitted")).alias("bids"),
        act_value(q("totalCostWithoutVAT"), q("totalCostWithVAT")).alias("value"),
        first_member(members).alias("member"),
        F.json_array_length(members).alias("n_members"),
    ]
    return written(spark, sf_dir, "contracts", NAMED, lambda: _clean(spark, sf_dir, "contract", columns))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        q("typeOfProcedure.key").alias("proc_key"),
        S.sanitize_value(F.coalesce(q("totalCostWithoutVAT"), q("totalCostWithVAT"), q("budget"))).alias("estimate"),
        S.to_day(q("submissionDate")).alias("submitted_day"),
        S.to_day(q("finalSubmissionDate")).alias("final_day"),
    ]
    return written(spark, sf_dir, "notices", NAMED, lambda: _clean(spark, sf_dir, "notice", columns))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [S.sanitize_value(q("totalCostWithoutVAT")).alias("value")]
    return written(spark, sf_dir, "payments", (*NAMED, "payment"), lambda: _clean(spark, sf_dir, "payment", columns))
