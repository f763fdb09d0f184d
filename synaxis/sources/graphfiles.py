"""Vertex and edge tables of the award graph, their bulk-import files, and the checks of a loaded copy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synaxis.functions import scalars as S
from synaxis.sources.files import write_csv

# Headers of the bulk-import files.
VERTEX_HEADERS = {
    "organization": {"vat": "vat:ID(Organization)", "name": "name"},
    "contractor": {"vat": "vat:ID(Contractor)", "name": "name"},
    "award": {"ref": "adam:ID(Award)", "amount": "amount_ex_vat:double", "day": "date:date", "year": "source_year:int", "month": "source_month:int", "cancelled": "cancelled:boolean"},
    "cpv": {"code": "code:ID(CPV)"},
    "nuts": {"code": "code:ID(Nuts)", "name": "name"},
}
EDGE_HEADERS = {
    "issued": (":START_ID(Organization)", ":END_ID(Award)"),
    "won_by": (":START_ID(Award)", ":END_ID(Contractor)"),
    "classified_as": (":START_ID(Award)", ":END_ID(CPV)"),
    "located_in": (":START_ID(Award)", ":END_ID(Nuts)"),
    "awards_to": (":START_ID(Organization)", ":END_ID(Contractor)", "total_amount_ex_vat:double", "n_awards:int"),
}


def _placed(auctions: DataFrame) -> DataFrame:
    return auctions.select(
        "ref", "vat", "org_name", "year", "month", "cancelled", F.col("value").alias("amount"), S.plausible_day(S.to_day(F.col("signed"))).alias("day"),
        F.col("member.vat").alias("contractor"), F.col("member.name").alias("contractor_name"), F.col("cpv.key").alias("cpv"), "nuts_code", "nuts_name", "row_id",
    )


def vertices(auctions: DataFrame) -> dict[str, DataFrame]:
    """Tables of organisations, contractors, awards, codes and regions; one row per key, attributes of its first row."""
    a = _placed(auctions)

    def first(key: str, name: str | None, as_key: str) -> DataFrame:
        rows = a.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(as_key))
        return rows.agg(F.min_by(name, "row_id").alias("name")) if name else a.filter(F.col(key).isNotNull()).select(F.col(key).alias(as_key)).distinct()

    return {
        "organization": first("vat", "org_name", "vat"),
        "contractor": first("contractor", "contractor_name", "vat"),
        "award": a.filter("ref is not null").select("ref", "amount", "day", "year", "month", "cancelled"),
        "cpv": first("cpv", None, "code"),
        "nuts": first("nuts_code", "nuts_name", "code"),
    }


def edges(auctions: DataFrame) -> dict[str, DataFrame]:
    """Tables of the five kinds of edges; an edge needs both ends."""
    a = _placed(auctions)

    def pair(x: str, y: str) -> DataFrame:
        return a.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("a"), F.col(y).alias("b"))

    total = F.round(F.coalesce(F.sum("amount"), F.lit(0.0)), 2)
    awards_to = a.filter("vat is not null and contractor is not null").groupBy(F.col("vat").alias("a"), F.col("contractor").alias("b")).agg(total.alias("amount"), F.count(F.lit(1)).alias("n"))
    return {"issued": pair("vat", "ref"), "won_by": pair("ref", "contractor"), "classified_as": pair("ref", "cpv"), "located_in": pair("ref", "nuts_code"), "awards_to": awards_to}


def write_graph(auctions: DataFrame, path: str) -> None:
    """One CSV folder with typed headers for each vertex and edge table."""
    for name, table in vertices(auctions).items():
        write_csv(table.withColumnsRenamed(VERTEX_HEADERS[name]), f"{path}/{name}")
    for name, table in edges(auctions).items():
        write_csv(table.toDF(*EDGE_HEADERS[name]), f"{path}/rel_{name}")


def read_vertices(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A vertex table as its files have it; ids stay text."""
    types = {"amount": "double", "day": "date", "year": "int", "month": "int", "cancelled": "boolean"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in VERTEX_HEADERS[name])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(f"{path}/{name}")


def load_checks(spark: SparkSession, staged: dict[str, DataFrame], loaded: dict[str, DataFrame], hub: str, hub_year: int, sample: int = 20, tolerance: float = 1e-6) -> DataFrame:
    """(check_no, name, n_checked, n_off): six comparisons of a loaded copy with what was staged.

    Row counts; amounts by year within a relative tolerance (at least 1); names of some organisations and
    fields of some awards, chosen by hash; the share of valid tax ids within half a point; the amount of one
    organisation in one year.
    """

    def counted(of: dict[str, DataFrame], name: str, column: str) -> DataFrame:
        return of[name].agg(F.count(F.lit(1)).alias(column)).withColumn("what", F.lit(name))

    kinds = ("organization", "contractor", "award")
    union = lambda of, c: reduce(DataFrame.unionByName, [counted(of, k, c) for k in kinds])
    checks = [union(staged, "s").join(union(loaded, "l"), "what").agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(F.col("s") != F.col("l")).alias("n_off"))]

    by_year = lambda of, c: of["award"].filter("day is not null").groupBy(F.year("day").alias("y")).agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias(c))
    off = F.abs(F.coalesce("l", F.lit(0.0)) - F.col("s")) > F.greatest(F.lit(1.0), F.abs("s") * tolerance)
    checks.append(by_year(staged, "s").join(by_year(loaded, "l"), "y", "left").agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(off).alias("n_off")))

    def some(name: str, key: str, fields: list[str]) -> DataFrame:
        chosen = staged[name].filter(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(sample)
        other = loaded[name].select(key, F.struct(*fields).alias("other"), F.lit(True).alias("there"))
        same = [F.col(f).eqNullSafe(F.col(f"other.{f}")) if f != "amount" else F.coalesce(F.abs(F.col(f) - F.col(f"other.{f}")) < 1e-6, F.col(f).isNull() & F.col(f"other.{f}").isNull()) for f in fields]
        joined = chosen.join(other, key, "left")
        return joined.agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(~(F.coalesce("there", F.lit(False)) & reduce(lambda x, y: x & y, same))).alias("n_off"))

    checks.append(some("organization", "vat", ["name"]))
    checks.append(some("award", "ref", ["amount", "day", "cancelled"]))

    share = lambda of, c: of["organization"].agg((100.0 * F.avg(S.vat_checksum(F.col("vat")).cast("double"))).alias(c)).withColumn("k", F.lit(1))
    checks.append(share(staged, "s").join(share(loaded, "l"), "k").agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(~F.coalesce(F.abs(F.col("s") - F.col("l")) < 0.5, F.lit(False))).alias("n_off")))

    def of_hub(of: dict[str, DataFrame], c: str) -> DataFrame:
        won = of["issued"].filter(F.col("a") == hub).select(F.col("b").alias("ref"))
        rows = of["award"].filter((F.col("year") == hub_year) & ~F.col("cancelled")).join(won, "ref", "left_semi")
        return rows.agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias(c)).withColumn("k", F.lit(1))

    checks.append(of_hub(staged, "s").join(of_hub(loaded, "l"), "k").agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(off).alias("n_off")))
    names = ("counts", "amounts by year", "organisations", "awards", "valid tax ids", "one organisation")
    return reduce(DataFrame.unionByName, [c.select(F.lit(i).alias("check_no"), F.lit(n).alias("name"), "n_checked", "n_off") for i, (n, c) in enumerate(zip(names, checks, strict=True), 1)])
