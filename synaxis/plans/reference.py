"""The engine's own queries over the act tables, each with its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from synaxis.functions import scalars as S
from synaxis.operators import aggregates as A
from synaxis.operators import windows as W
from synaxis.plans import sqltext as X
from synaxis.session import q, read_table
from synaxis.sources import acts, graphfiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its inventory id and, where it has one, its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


_DIRECT = "coalesce(proc_key = '6', false)"
_COMPETITIVE = "NOT coalesce(proc_key IN ('6','12','18'), false)"


def _note(n: str, k: int) -> str:
    return f"CASE WHEN {n} < {k} THEN 'ανεπαρκή δεδομένα (N<{k})' END"


# ---------------------------------------------------------------- sources, sets


@query("src02_dedupe_last", f'SELECT row_id, "referenceNumber" AS ref, _source_year AS year FROM {X.dedupe("auction")}')
def src02(spark, d):
    df = acts.dedupe(read_table(spark, d, "auction"), "referenceNumber", ["row_id"])
    return df.select("row_id", q("referenceNumber").alias("ref"), q("_source_year").alias("year"))


@query(
    "src04_load_months",
    """WITH want AS (SELECT y, m FROM range(2020, 2027) t(y), range(1, 13) s(m) WHERE y < 2026 OR m <= 6),
    have AS (SELECT _source_year AS y, _source_month AS m, count(*) AS n FROM auction GROUP BY 1, 2)
    SELECT cast(w.y AS INT) AS year, cast(w.m AS INT) AS month, coalesce(n, 0) AS n_rows, n IS NULL AS missing FROM want w LEFT JOIN have h ON w.y = h.y AND w.m = h.m""",
)
def src04(spark, d):
    month = F.explode(F.sequence(F.lit("2020-01-01").cast("date"), F.lit("2026-06-01").cast("date"), F.expr("interval 1 month")))
    want = spark.range(1).select(month.alias("first")).select(F.year("first").alias("year"), F.month("first").alias("month"))
    have = read_table(spark, d, "auction").groupBy(q("_source_year").alias("year"), q("_source_month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return want.join(have, ["year", "month"], "left").select("year", "month", F.coalesce("n", F.lit(0)).alias("n_rows"), F.col("n").isNull().alias("missing"))


_ENTITIES = ("auction", "contract", "notice")


@query(
    "src05_latest_complete_month",
    "SELECT min(ym) // 100 AS year, min(ym) % 100 AS month FROM ("
    + " UNION ALL ".join(f"SELECT max(_source_year * 100 + _source_month) AS ym FROM {t}" for t in _ENTITIES)
    + ")",
)
def src05(spark, d):
    parts = [
        read_table(spark, d, t).agg(F.max(F.struct(q("_source_year").alias("year"), q("_source_month").alias("month"))).alias("ym")) for t in _ENTITIES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(F.min("ym").alias("ym")).select("ym.year", "ym.month")


@query("src07_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS n FROM {t}" for t in (*_ENTITIES, "payment")))
def src07(spark, d):
    parts = [read_table(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("entity"), "n") for t in (*_ENTITIES, "payment")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "src09_date_windows",
    """SELECT cast(s AS DATE) AS window_from, cast(least(s + INTERVAL 179 DAY, TIMESTAMP '2026-06-30') AS DATE) AS window_to
    FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2026-06-30', INTERVAL 180 DAY) t(s)""",
)
def src09(spark, d):
    return date_windows(spark, "2020-01-01", "2026-06-30", 180)


def date_windows(spark: SparkSession, first: str, last: str, days: int) -> DataFrame:
    """Inclusive windows of ``days`` that cover [first, last] without overlap; an inverted range is an error."""
    if first > last:
        raise ValueError("the range ends before it begins")
    start = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval {days} days")))
    return spark.range(1).select(start.alias("window_from")).select(
        "window_from", F.least(F.date_add("window_from", days - 1), F.lit(last).cast("date")).alias("window_to")
    )


@query(
    "src11_flatten",
    """SELECT file_name, line_no, payload->>'referenceNumber' AS ref, coalesce(payload->>'organization.value', payload->'organization'->>'value') AS org_name,
    payload->'procedureType'->>'key' AS proc_key FROM contract_raw""",
)
def src11(spark, d):
    p = F.col("payload")
    return read_table(spark, d, "contract_raw").select(
        "file_name",
        "line_no",
        F.get_json_object(p, "$.referenceNumber").alias("ref"),
        F.coalesce(F.get_json_object(p, "$['organization.value']"), F.get_json_object(p, "$.organization.value")).alias("org_name"),
        F.get_json_object(p, "$.procedureType.key").alias("proc_key"),
    )


@query(
    "set01_union_aligned",
    """SELECT 'auction' AS entity, row_id, "organization.value" AS org_name, "noticeRefNo" AS notice_ref FROM auction
    UNION ALL SELECT 'contract', row_id, "organization.value", NULL FROM contract UNION ALL SELECT 'payment', row_id, "organization.value", NULL FROM payment""",
)
def set01(spark, d):
    out = None
    for t in ("auction", "contract", "payment"):
        df = read_table(spark, d, t)
        part = df.select(F.lit(t).alias("entity"), "row_id", q("organization.value").alias("org_name"), *([q("noticeRefNo").alias("notice_ref")] if t == "auction" else []))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@query(
    "set02_distinct_vertices",
    X.acts("auctions") + " SELECT vat, org_name FROM (SELECT *, row_number() OVER (PARTITION BY vat ORDER BY row_id) AS rn FROM auctions WHERE vat IS NOT NULL) WHERE rn = 1",
)
def set02(spark, d):
    rows = acts.auctions(spark, d).filter("vat is not null")
    return rows.groupBy("vat").agg(F.min_by("org_name", "row_id").alias("org_name"))


@query(
    "set03_both_directions",
    X.acts("auctions") + """, e AS (SELECT vat AS a, member_vat AS b, count(*) AS n FROM auctions WHERE vat IS NOT NULL AND member_vat IS NOT NULL GROUP BY 1, 2)
    SELECT a AS src, b AS dst, n FROM e UNION ALL SELECT b, a, n FROM e""",
)
def set03(spark, d):
    e = edges(acts.auctions(spark, d)).select(F.col("vat").alias("src"), F.col("contractor").alias("dst"), F.col("n_awards").alias("n"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))


@query(
    "set04_name_difference",
    'SELECT DISTINCT "organization.value" AS org_name FROM contract WHERE "organization.value" IS NOT NULL EXCEPT SELECT name FROM entities',
)
def set04(spark, d):
    names = read_table(spark, d, "contract").select(q("organization.value").alias("org_name")).filter("org_name is not null").distinct()
    return names.join(read_table(spark, d, "entities").select(F.col("name").alias("org_name")), "org_name", "left_anti")


@query("set05_target_vats", "SELECT DISTINCT " + X.vat("vat") + " AS vat FROM contractor_aliases WHERE " + X.vat("vat") + " IS NOT NULL")
def set05(spark, d):
    return read_table(spark, d, "contractor_aliases").select(S.normalize_vat(F.col("vat")).alias("vat")).filter("vat is not null").distinct()


# ---------------------------------------------------------------- scalar functions


@query(
    "fn01_02_vat",
    f'SELECT row_id, {X.vat(chr(34) + "organizationVatNumber" + chr(34))} AS vat, {X.checksum(X.vat(chr(34) + "organizationVatNumber" + chr(34)))} AS valid FROM auction',
)
def fn01(spark, d):
    v = S.normalize_vat(q("organizationVatNumber"))
    return read_table(spark, d, "auction").select("row_id", v.alias("vat"), S.vat_checksum(v).alias("valid"))


@query(
    "fn03_06_amounts",
    f"""SELECT row_id, {X.num('"totalCostWithoutVAT"')} AS amount, {X.capped(f'coalesce({X.num(chr(34) + "totalCostWithoutVAT" + chr(34))}, "totalCostWithVAT")')} AS value FROM auction""",
)
def fn03(spark, d):
    return read_table(spark, d, "auction").select(
        "row_id", S.to_number(q("totalCostWithoutVAT")).alias("amount"), acts.act_value(q("totalCostWithoutVAT"), q("totalCostWithVAT")).alias("value")
    )


@query(
    "fn07_08_18_31_dates",
    """WITH t AS (SELECT row_id, try_cast(try_cast("signedDate" AS TIMESTAMP) AS DATE) AS signed, try_cast(try_cast("submissionDate" AS TIMESTAMP) AS DATE) AS submitted,
    _source_year AS y, _source_month AS m FROM auction)
    SELECT row_id, CASE WHEN year(signed) BETWEEN 1900 AND 9999 THEN signed END AS signed_day, submitted - signed AS days,
    (y * 12 + m) - (year(signed) * 12 + month(signed)) AS lag_months FROM t""",
)
def fn07(spark, d):
    signed, submitted = S.to_day(q("signedDate")), S.to_day(q("submissionDate"))
    return read_table(spark, d, "auction").select(
        "row_id",
        S.plausible_day(signed).alias("signed_day"),
        F.date_diff(submitted, signed).cast("long").alias("days"),
        ((q("_source_year") * 12 + q("_source_month")) - (F.year(signed) * 12 + F.month(signed))).cast("long").alias("lag_months"),
    )


@query(
    "fn09_11_flags",
    """SELECT row_id, coalesce(lower(trim(cancelled)) = 'true', false) AS cancelled, coalesce("procedureType.key" = '6', false) AS direct,
    NOT coalesce("procedureType.key" IN ('6','12','18'), false) AS competitive FROM auction""",
)
def fn09(spark, d):
    key = q("procedureType.key")
    return read_table(spark, d, "auction").select(
        "row_id", S.is_cancelled(q("cancelled")).alias("cancelled"), A.direct(key).alias("direct"), A.competitive(key).alias("competitive")
    )


# Contract types of works and studies, and the day from which limits changed.
WORKS_AND_STUDIES = ("Έργα", "Μελέτες", "Τεχνικές ή λοιπές συναφείς υπηρεσίες")
LIMIT_CHANGE = "2021-06-01"
_WORKS_SQL = ", ".join(f"'{t}'" for t in WORKS_AND_STUDIES)


def limit_table(spark: SparkSession) -> DataFrame:
    """A dimension of limits valid from a day on, for works and for all else; the look-up is a range join."""
    rows = [
        ("1900-01-01", "2021-05-31", "pre-2021-06", False, 20000.0), ("1900-01-01", "2021-05-31", "pre-2021-06", True, 20000.0),
        ("2021-06-01", "9999-12-31", "2021-06+", False, 30000.0), ("2021-06-01", "9999-12-31", "2021-06+", True, 60000.0),
    ]
    return spark.createDataFrame(rows, "a string, b string, period string, works boolean, lim double").select(
        F.to_date("a").alias("valid_from"), F.to_date("b").alias("valid_to"), "period", "works", "lim"
    )


def with_limit(rows: DataFrame, day: str, kind: str) -> DataFrame:
    """Add ``period`` and ``lim`` of a row's day and contract type; both null where the day is."""
    works = F.coalesce(F.col(kind).isin(*WORKS_AND_STUDIES), F.lit(False))
    limits = F.broadcast(limit_table(rows.sparkSession))  # four rows
    inside = (F.col("__works") == F.col("works")) & F.col(day).between(F.col("valid_from"), F.col("valid_to"))
    return rows.withColumn("__works", works).join(limits, inside, "left").drop("__works", "works", "valid_from", "valid_to")


def _limit_sql(day: str, kind: str) -> str:
    return f"""CASE WHEN {day} IS NULL THEN NULL WHEN {day} < DATE '{LIMIT_CHANGE}' THEN 20000.0 WHEN {kind} IN ({_WORKS_SQL}) THEN 60000.0 ELSE 30000.0 END::DOUBLE"""


def _period_sql(day: str) -> str:
    return f"CASE WHEN {day} IS NULL THEN NULL WHEN {day} < DATE '{LIMIT_CHANGE}' THEN 'pre-2021-06' ELSE '2021-06+' END"


@query(
    "fn12_14_range_lookup",
    f"""WITH t AS (SELECT row_id, "contractType.value" AS kind, try_cast(try_cast("submissionDate" AS TIMESTAMP) AS DATE) AS day FROM auction)
    SELECT row_id, {_period_sql("day")} AS period, {_limit_sql("day", "kind")} AS lim FROM t""",
)
def fn12(spark, d):
    rows = read_table(spark, d, "auction").select("row_id", q("contractType.value").alias("kind"), S.to_day(q("submissionDate")).alias("day"))
    return with_limit(rows, "day", "kind").select("row_id", "period", "lim")


@query(
    "fn15_digits",
    """SELECT row_id, CASE WHEN "totalCostWithoutVAT" > 0 THEN try_cast(regexp_extract(printf('%.2f', "totalCostWithoutVAT"), '[1-9]') AS INT) END AS d1,
    CASE WHEN "totalCostWithoutVAT" >= 10 THEN try_cast(substr(cast(cast(floor("totalCostWithoutVAT") AS BIGINT) AS VARCHAR), 2, 1) AS INT) END AS d2 FROM payment""",
)
def fn15(spark, d):
    v = q("totalCostWithoutVAT")
    return read_table(spark, d, "payment").select("row_id", F.when(v > 0, S.first_digit(v)).alias("d1"), S.first_two_second_digit(v).alias("d2"))


@query(
    "fn19_21_json_first",
    f"""SELECT row_id, json_extract_string({X.json_array('"objectDetailsList"')}, '$[0].cpvs[0].key') AS cpv_key,
    json_extract_string({X.json_array('"contractingDataDetails.contractingMembersDataList"')}, '$[0].name') AS member_name,
    "objectDetailsList" IS NOT NULL AND "objectDetailsList" <> '' AND (NOT json_valid("objectDetailsList") OR lower("objectDetailsList") = 'nan') AS failed FROM auction""",
)
def fn19(spark, d):
    objects = q("objectDetailsList")
    return read_table(spark, d, "auction").select(
        "row_id",
        acts.first_cpv(objects)["key"].alias("cpv_key"),
        acts.first_member(q("contractingDataDetails.contractingMembersDataList"))["name"].alias("member_name"),
        (objects.isNotNull() & (objects != "") & F.try_parse_json(objects).isNull()).alias("failed"),
    )


@query(
    "fn22_any_valid_cpv",
    f"""WITH c AS (SELECT row_id, unnest(from_json(json_extract({X.json_array('"objectDetailsList"')}, '$[*].cpvs[*].key'), '["VARCHAR"]')) AS k FROM auction),
    ok AS (SELECT DISTINCT row_id FROM c WHERE regexp_full_match(trim(k), '[0-9]{{8}}(-[0-9])?'))
    SELECT a.row_id, ok.row_id IS NOT NULL AS has_cpv FROM auction a LEFT JOIN ok ON a.row_id = ok.row_id""".replace("from_json(json_extract", "(json_extract_string").replace(""", '["VARCHAR"]'))""", "))"),
)
def fn22(spark, d):
    return read_table(spark, d, "auction").select("row_id", any_cpv(q("objectDetailsList")).alias("has_cpv"))


def any_cpv(objects: Column) -> Column:
    """Whether any nested code of an object list has the form of one."""
    keys = F.from_json(acts.array_text(objects), "array<struct<cpvs:string>>")
    cpvs = F.transform(keys, lambda o: F.from_json(acts.array_text(o["cpvs"]), "array<struct<key:string>>"))
    ok = F.exists(F.flatten(F.filter(cpvs, lambda c: c.isNotNull())), lambda c: F.trim(c["key"]).rlike(r"^[0-9]{8}(-[0-9])?$"))
    return F.coalesce(ok, F.lit(False))


# Marks of a legal person in a name, in Greek and Latin letters.
LEGAL_MARKS = (
    "Α.Ε", "ΑΕ ", "ΑΝΩΝΥΜ", "Ε.Π.Ε", "ΕΠΕ ", "Ι.Κ.Ε", "ΙΚΕ ", "Ο.Ε", "ΟΕ ", "Ε.Ε", "ΕΕ ", "ΟΜΟΡΡΥΘΜ", "ΕΤΕΡΟΡΡΥΘΜ", "ΚΟΙΝΟΠΡΑΞΙΑ", "ΣΥΝΕΤΑΙΡΙΣΜΟΣ",
    "ΕΤΑΙΡ", "ΝΠΔΔ", "Ν.Π.Δ.Δ", "ΝΠΙΔ", "Ν.Π.Ι.Δ", "ΔΗΜΟΣ", "ΠΕΡΙΦΕΡΕΙΑ", "ΥΠΟΥΡΓΕΙΟ", "ΟΡΓΑΝΙΣΜΟΣ", "ΙΔΡΥΜΑ", "ΣΥΛΛΟΓΟΣ", "ΕΝΩΣΗ", "ΙΝΣΤΙΤΟΥΤΟ",
    "ΝΟΣΟΚΟΜΕΙΟ", "ΠΑΝΕΠΙΣΤΗΜΙΟ", "ΕΠΙΧΕΙΡΗΣΗ", "LTD", "GMBH", "S.A.", "SA ", "PLC", "INC", "CORP", "LLC", "SRL", "S.R.L", "B.V", "N.V", "SPA", "S.P.A",
    "CO.", "COMPANY", "GROUP",
)
_MARK_SQL = " OR ".join(f"contains(' ' || upper(canonical_name) || ' ', '{m}')" for m in LEGAL_MARKS)


@query(
    "fn23_26_names",
    f"""SELECT alias_id, ({_MARK_SQL}) AS legal, {X.norm_name("canonical_name")} AS norm,
    {X.norm_name(X.plain("canonical_name"))} AS norm_plain, array_to_string(string_split({X.norm_name("canonical_name")}, ' ')[1:4], ' ') AS prefix FROM contractor_aliases""",
)
def fn23(spark, d):
    name = F.col("canonical_name")
    padded = F.concat(F.lit(" "), F.upper(name), F.lit(" "))
    legal = padded.rlike("|".join(m.replace(".", r"\.") for m in LEGAL_MARKS))
    norm = S.normalize_name(name)
    return read_table(spark, d, "contractor_aliases").select(
        "alias_id", legal.alias("legal"), norm.alias("norm"), S.normalize_greek(name).alias("norm_plain"), S.name_prefix(norm).alias("prefix")
    )


# Beginnings of the names of municipalities and regions, and words of bodies that only begin so.
LOCAL_KINDS = (("ΔΗΜΟΣ ", "dimos"), ("ΠΕΡΙΦΕΡΕΙΑ ", "perifereia"))
NOT_LOCAL = (
    "ΝΠΔΔ", "ΝΟΜΙΚΟ ΠΡΟΣΩΠΟ", "ΑΝΩΝΥΜΗ", "ΕΤΑΙΡΕΙΑ", "ΕΠΙΧΕΙΡΗΣΗ", "ΣΧΟΛΙΚΗ", "ΔΕΥΑ", "ΛΙΜΕΝΙΚΟ", "ΟΡΓΑΝΙΣΜΟΣ", "ΤΑΜΕΙΟ", "ΚΟΙΝΩΦΕΛΗΣ", "ΙΔΡΥΜΑ",
    "ΚΕΝΤΡΟ", "ΜΟΝΑΔΑ",
)


def local_kind(norm: Column) -> tuple[Column, Column]:
    """(kind, why not) of a normalised name: a municipality or region, or a body whose name only begins so."""
    begun = F.coalesce(*[F.when(norm.startswith(b), k) for b, k in LOCAL_KINDS])
    reason = F.when(begun.isNotNull(), F.coalesce(*[F.when(norm.contains(w), F.lit(f"non_ota_keyword:{w}")) for w in NOT_LOCAL]))
    return F.when(reason.isNull(), begun), reason


def _kind_sql(n: str) -> tuple[str, str]:
    begun = "CASE " + " ".join(f"WHEN starts_with({n}, '{b}') THEN '{k}'" for b, k in LOCAL_KINDS) + " END"
    reason = f"CASE WHEN ({begun}) IS NULL THEN NULL " + " ".join(f"WHEN contains({n}, '{w}') THEN 'non_ota_keyword:{w}'" for w in NOT_LOCAL) + " END"
    return f"CASE WHEN ({reason}) IS NULL THEN {begun} END", reason


def leadership(before: Column, after: Column) -> Column:
    """Whether the head changed between two normalised names: unknown where one is missing or only the last name agrees."""
    last = lambda c: F.substring_index(c, " ", -1)
    missing = (F.coalesce(before, F.lit("")) == "") | (F.coalesce(after, F.lit("")) == "")
    return F.when(missing, "unknown").when(before == after, "false").when(last(before) == last(after), "unknown").otherwise("true")


@query(
    "fn27_28_classify",
    f"""WITH t AS (SELECT org_id, coalesce({X.norm_name(X.plain("name"))}, '') AS n, coalesce(lag({X.norm_name(X.plain("name"))}) OVER (ORDER BY org_id), '') AS p FROM entities)
    SELECT org_id, {_kind_sql("n")[0]} AS kind, {_kind_sql("n")[1]} AS reason,
    CASE WHEN p = '' OR n = '' THEN 'unknown' WHEN n = p THEN 'false' WHEN split_part(n, ' ', -1) = split_part(p, ' ', -1) THEN 'unknown' ELSE 'true' END AS changed FROM t""",
)
def fn27(spark, d):
    rows = read_table(spark, d, "entities").select("org_id", F.coalesce(S.normalize_greek(F.col("name")), F.lit("")).alias("n"))
    before = rows.select((F.col("org_id") + 1).alias("org_id"), F.col("n").alias("p"))  # ids are dense
    kind, reason = local_kind(F.col("n"))
    return rows.join(before, "org_id", "left").select("org_id", kind.alias("kind"), reason.alias("reason"), leadership(F.col("p"), F.col("n")).alias("changed"))


@query(
    "fn33_38_ids",
    """SELECT row_id, regexp_full_match("referenceNumber", '[0-9]{2}(REQ|PROC|AWRD|SYMV|PAY)[0-9]+') AS id_ok,
    nullif(regexp_extract("referenceNumber", '^[0-9]{2}([A-Z]+)', 1), '') AS kind, left("procedureType.key", 1) AS k1 FROM auction""",
)
def fn33(spark, d):
    ref = q("referenceNumber")
    return read_table(spark, d, "auction").select(
        "row_id", ref.rlike("^[0-9]{2}(REQ|PROC|AWRD|SYMV|PAY)[0-9]+$").alias("id_ok"),
        F.nullif(F.regexp_extract(ref, "^[0-9]{2}([A-Z]+)", 1), F.lit("")).alias("kind"), F.left(q("procedureType.key"), F.lit(1)).alias("k1"),
    )


# ---------------------------------------------------------------- joins


@query("jn01_resolve", X.acts("auctions") + " SELECT row_id, own_vat, vat FROM auctions")
def jn01(spark, d):
    return acts.auctions(spark, d).select("row_id", "own_vat", "vat")


@query(
    "agg10_resolver",
    "WITH " + X.RESOLVER + " SELECT name, vat FROM resolver",
)
def agg10(spark, d):
    return acts.resolver(spark, d)


@query(
    "jn10_semi_top_contractors",
    X.acts("auctions")
    + """, top AS (SELECT member_vat, sum(value) AS v FROM auctions WHERE member_vat IS NOT NULL GROUP BY 1 ORDER BY round(sum(value), 2) DESC NULLS LAST, 1 LIMIT 50)
    SELECT row_id, member_vat FROM auctions WHERE member_vat IN (SELECT member_vat FROM top)""",
)
def jn10(spark, d):
    a = acts.auctions(spark, d).withColumn("member_vat", F.col("member.vat"))
    top = a.filter("member_vat is not null").groupBy("member_vat").agg(F.round(F.sum("value"), 2).alias("v")).orderBy(F.desc_nulls_last("v"), "member_vat").limit(50)
    return a.join(top, "member_vat", "left_semi").select("row_id", "member_vat")


@query(
    "jn11_alias_name",
    X.acts("auctions")
    + """, one AS (SELECT vat AS v, min(canonical_name) AS alias FROM contractor_aliases WHERE vat IS NOT NULL GROUP BY 1)
    SELECT member_vat, coalesce(alias, m) AS name FROM (SELECT member_vat, min(member_name) AS m FROM auctions WHERE member_vat IS NOT NULL GROUP BY 1) x LEFT JOIN one ON member_vat = v""",
)
def jn11(spark, d):
    one = read_table(spark, d, "contractor_aliases").filter("vat is not null").groupBy(F.col("vat").alias("member_vat")).agg(F.min("canonical_name").alias("alias"))
    a = acts.auctions(spark, d).filter("member.vat is not null").groupBy(F.col("member.vat").alias("member_vat")).agg(F.min("member.name").alias("m"))
    return a.join(one, "member_vat", "left").select("member_vat", F.coalesce("alias", "m").alias("name"))


# Months of which the register lost its awards, and the windows compared with the same months of other years.
LOST_MONTHS = ("2021-02-01", "2025-08-01")
WINDOWS = (("PRE", 2023, 4, 9), ("LAME", 2023, 10, 12), ("POST", 2024, 1, 6), ("PLACEBO", 2022, 4, 9))
BASELINE_YEARS = (2021, 2022, 2025)
MONTH_SQL = {"signed": "cast(date_trunc('month', try_cast(signed AS TIMESTAMP)) AS DATE)", "source": "make_date(year, month, 1)"}


def _panel_sql(mode: str) -> str:
    lost = "m.month IN (" + ", ".join(f"DATE '{m}'" for m in LOST_MONTHS) + ")" if mode == "source" else "false"
    measures = ", ".join(f"CASE WHEN {lost} THEN NULL ELSE coalesce({c}, {z}) END AS {c}" for c, z in (("n_total", 0), ("n_direct", 0), ("value_total", "0.0"), ("value_direct", "0.0")))
    return (
        X.acts("auctions")
        + f""", base AS (SELECT vat, {MONTH_SQL[mode]} AS month, count(*) AS n_total, count(*) FILTER ({_DIRECT}) AS n_direct, round(coalesce(sum(value), 0), 2) AS value_total,
    round(coalesce(sum(value) FILTER ({_DIRECT}), 0), 2) AS value_direct FROM auctions
    WHERE vat IN (SELECT vat FROM entities WHERE {_kind_sql("(" + X.norm_name(X.plain("name")) + ")")[0]} IS NOT NULL) AND NOT cancelled AND {MONTH_SQL[mode]} IS NOT NULL GROUP BY 1, 2),
    months AS (SELECT cast(m AS DATE) AS month FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2026-06-01', INTERVAL 1 MONTH) t(m)),
    panel AS (SELECT v.vat, m.month, {measures} FROM (SELECT DISTINCT vat FROM base) v CROSS JOIN months m LEFT JOIN base b ON b.vat = v.vat AND b.month = m.month)"""
    )


_PANEL = _panel_sql("signed")
_SHARES_SQL = "round(100.0 * n_direct / nullif(n_total, 0), 4) AS da_count_pct, CASE WHEN value_total > 0 THEN round(100.0 * value_direct / value_total, 4) END AS da_value_pct"


def panel(spark: SparkSession, d: str, mode: str = "signed") -> DataFrame:
    """Grid of municipalities and regions by month, by signature or by source month, with zeros where nothing happened.

    Lost months are null by source month. An unknown mode is an error. The grid side is organisations only.
    """
    months = {"signed": F.trunc(S.to_day(F.col("signed")), "month"), "source": F.make_date("year", "month", F.lit(1))}
    if mode not in months:
        raise ValueError(f"unknown mode {mode}")
    chosen = read_table(spark, d, "entities").filter(local_kind(S.normalize_greek(F.col("name")))[0].isNotNull()).select("vat").distinct()
    direct = A.direct(F.col("proc_key"))
    rows = acts.auctions(spark, d).join(chosen, "vat", "left_semi").filter("not cancelled").withColumn("month", months[mode]).filter("month is not null")
    base = rows.groupBy("vat", "month").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(direct).alias("n_direct"),
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value_total"), F.round(F.coalesce(F.sum(F.when(direct, F.col("value"))), F.lit(0.0)), 2).alias("value_direct"),
    )
    every = F.explode(F.sequence(F.lit("2020-01-01").cast("date"), F.lit("2026-06-01").cast("date"), F.expr("interval 1 month")))
    grid = base.select("vat").distinct().withColumn("month", every)
    out = grid.join(base, ["vat", "month"], "left").na.fill(0, ["n_total", "n_direct"]).na.fill(0.0, ["value_total", "value_direct"])
    if mode == "source":
        lost = F.col("month").isin(*[F.lit(m).cast("date") for m in LOST_MONTHS])
        out = out.withColumns({c: F.when(~lost, F.col(c)) for c in ("n_total", "n_direct", "value_total", "value_direct")})
    return out


def _with_shares(p: DataFrame) -> DataFrame:
    return p.withColumn("da_count_pct", S.pct(F.col("n_direct"), F.nullif(F.col("n_total"), F.lit(0)), 4)).withColumn(
        "da_value_pct", F.when(F.col("value_total") > 0, S.pct(F.col("value_direct"), F.col("value_total"), 4))
    )


@query("jn13_agg24_panel", _PANEL + f" SELECT vat, month, n_total, n_direct, value_total, value_direct, {_SHARES_SQL} FROM panel")
def jn13(spark, d):
    return _with_shares(panel(spark, d))


@query("fn34_panel_by_source", _panel_sql("source") + f" SELECT vat, month, n_total, n_direct, value_total, value_direct, {_SHARES_SQL} FROM panel")
def fn34(spark, d):
    return _with_shares(panel(spark, d, "source"))


_YEARS_SQL = ", ".join(map(str, BASELINE_YEARS))


@query(
    "agg25_window_ratio",
    _PANEL
    + ", w AS (SELECT * FROM (VALUES " + ", ".join(f"('{w}', {y}, {a}, {b})" for w, y, a, b in WINDOWS) + f""") t(win, y, a, b))
    SELECT vat, win, round(avg(n_direct) FILTER (year(month) = y) / nullif(avg(n_direct) FILTER (year(month) IN ({_YEARS_SQL})), 0), 6) AS ratio
    FROM panel JOIN w ON month(month) BETWEEN a AND b GROUP BY 1, 2""",
)
def agg25(spark, d):
    wanted = [F.when(F.month("month").between(a, b), F.struct(F.lit(w).alias("win"), F.lit(y).alias("y"))) for w, y, a, b in WINDOWS]
    rows = panel(spark, d).select("vat", "month", "n_direct", F.inline(F.array_compact(F.array(*wanted))))
    usual = F.year("month").isin(*BASELINE_YEARS)
    ratio = F.try_divide(F.avg(F.when(F.year("month") == F.col("y"), F.col("n_direct"))), F.avg(F.when(usual, F.col("n_direct"))))
    return rows.groupBy("vat", "win").agg(F.round(ratio, 6).alias("ratio"))


@query("agg26_baseline_gate", _PANEL + f" SELECT vat, cast(sum(n_direct) AS BIGINT) AS n FROM panel WHERE year(month) IN ({_YEARS_SQL}) GROUP BY 1 HAVING sum(n_direct) >= 30")
def agg26(spark, d):
    return panel(spark, d).filter(F.year("month").isin(*BASELINE_YEARS)).groupBy("vat").agg(F.sum("n_direct").alias("n")).filter("n >= 30")


@query(
    "win09_cap",
    X.acts("auctions") + " SELECT vat, round(quantile_cont(value, 0.99), 4) AS p99, count(value) AS n FROM auctions WHERE vat IS NOT NULL AND value IS NOT NULL GROUP BY 1",
)
def win09(spark, d):
    rows = acts.auctions(spark, d).filter("vat is not null and value is not null")
    caps = A.bounded_quantile(rows, ["vat"], "value", 0.99)
    return rows.groupBy("vat").agg(F.count("value").alias("n")).join(caps, "vat").select("vat", F.round("quantile", 4).alias("p99"), "n")


@query(
    "jn16_candidate_pairs",
    f"""WITH t AS (SELECT alias_id AS id, vat, array_to_string(string_split({X.norm_name("canonical_name")}, ' ')[1:4], ' ') AS p FROM contractor_aliases)
    SELECT l.id AS id_l, r.id AS id_r FROM t l JOIN t r ON l.vat = r.vat AND l.id < r.id UNION SELECT l.id, r.id FROM t l JOIN t r ON l.p = r.p AND l.id < r.id""",
)
def jn16(spark, d):
    t = read_table(spark, d, "contractor_aliases").select(F.col("alias_id").alias("id"), "vat", S.name_prefix(S.normalize_name(F.col("canonical_name"))).alias("p"))
    other = t.select(F.col("id").alias("id_r"), "vat", "p")

    def block(key: str) -> DataFrame:
        return t.select(F.col("id").alias("id_l"), key).join(other.select("id_r", key), key).filter("id_l < id_r").select("id_l", "id_r")

    return block("vat").unionByName(block("p")).distinct()


@query(
    "jn17_missing_vat_names",
    """WITH m AS (SELECT CASE WHEN vat_l IS NULL THEN id_l ELSE id_r END AS id, CASE WHEN vat_l IS NULL THEN name_l ELSE name_r END AS name, coalesce(vat_l, vat_r) AS v
    FROM entity_resolution_matches WHERE jw_score >= 0.999 AND (vat_l IS NULL) <> (vat_r IS NULL))
    SELECT id, min(name) AS name, min(v) AS vat FROM m GROUP BY 1 HAVING count(DISTINCT v) = 1""",
)
def jn17(spark, d):
    """Records without a tax id that a nearly identical name links to exactly one."""
    m = read_table(spark, d, "entity_resolution_matches").filter((F.col("jw_score") >= 0.999) & (F.col("vat_l").isNull() != F.col("vat_r").isNull()))
    side = lambda c: F.when(F.col("vat_l").isNull(), F.col(f"{c}_l")).otherwise(F.col(f"{c}_r"))
    one = m.groupBy(side("id").alias("id")).agg(F.min(side("name")).alias("name"), F.min(F.coalesce("vat_l", "vat_r")).alias("vat"), F.count_distinct(F.coalesce("vat_l", "vat_r")).alias("k"))
    return one.filter("k = 1").select("id", "name", "vat")


@query(
    "jn20_resume_targets",
    "SELECT DISTINCT a.vat FROM contractor_aliases a WHERE a.vat IS NOT NULL AND NOT EXISTS (SELECT 1 FROM entities e WHERE e.vat = a.vat)",
)
def jn20(spark, d):
    return read_table(spark, d, "contractor_aliases").select("vat").filter("vat is not null").distinct().join(read_table(spark, d, "entities"), "vat", "left_anti")


@query(
    "jn22_manifest_merge",
    """WITH u AS (SELECT _source_year AS year, _source_month AS month, 'old' AS origin, 1 AS pr FROM notice WHERE _source_year < 2023
    UNION ALL SELECT _source_year, _source_month, 'new', 2 FROM auction)
    SELECT year, month, origin FROM (SELECT DISTINCT *, row_number() OVER (PARTITION BY year, month ORDER BY pr) AS rn FROM (SELECT DISTINCT * FROM u)) WHERE rn = 1""",
)
def jn22(spark, d):
    key = [q("_source_year").alias("year"), q("_source_month").alias("month")]
    old = read_table(spark, d, "notice").filter(q("_source_year") < 2023).select(*key, F.lit("old").alias("origin"), F.lit(1).alias("pr")).distinct()
    new = read_table(spark, d, "auction").select(*key, F.lit("new").alias("origin"), F.lit(2).alias("pr")).distinct()
    return old.unionByName(new).groupBy("year", "month").agg(F.min_by("origin", "pr").alias("origin"))


@query(
    "jn23_completeness_audit",
    """WITH a AS (SELECT _source_year AS y, _source_month AS m, count(*) AS n FROM auction GROUP BY 1, 2), b AS (SELECT _source_year AS y, _source_month AS m, count(*) AS e FROM contract GROUP BY 1, 2)
    SELECT b.y AS year, b.m AS month, coalesce(n, 0) AS n_file, e AS n_expected, coalesce(n, 0) >= e AS complete FROM b LEFT JOIN a ON a.y = b.y AND a.m = b.m""",
)
def jn23(spark, d):
    def count(t: str, name: str) -> DataFrame:
        return read_table(spark, d, t).groupBy(q("_source_year").alias("year"), q("_source_month").alias("month")).agg(F.count(F.lit(1)).alias(name))

    joined = count("contract", "n_expected").join(count("auction", "n"), ["year", "month"], "left")
    n = F.coalesce("n", F.lit(0))
    return joined.select("year", "month", n.alias("n_file"), "n_expected", (n >= F.col("n_expected")).alias("complete"))


@query(
    "jn26_compare",
    X.acts("auctions")
    + """, a AS (SELECT _source_year AS y, count(DISTINCT coalesce("referenceNumber", row_id::VARCHAR)) AS n, coalesce(sum("totalCostWithVAT"), 0) AS v FROM auction GROUP BY 1), b AS (SELECT year AS y, count(*) AS n, coalesce(sum(value), 0) AS v FROM auctions GROUP BY 1)
    SELECT coalesce(a.y, b.y) AS year, a.n AS n_left, b.n AS n_right, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff, round(a.v, 2) AS sum_left, round(b.v, 2) AS sum_right,
    abs(coalesce(a.v, 0) - coalesce(b.v, 0)) <= greatest(1.0, abs(a.v) * 0.05) AS close FROM a FULL JOIN b ON a.y = b.y""",
)
def jn26(spark, d):
    """Acts and amounts as delivered against the clean table, by year, amounts within a tolerance."""
    act = F.coalesce(q("referenceNumber"), F.col("row_id").cast("string"))
    a = read_table(spark, d, "auction").groupBy(q("_source_year").alias("year")).agg(F.count_distinct(act).alias("n_left"), F.coalesce(F.sum("totalCostWithVAT"), F.lit(0.0)).alias("a"))
    b = acts.auctions(spark, d).groupBy("year").agg(F.count(F.lit(1)).alias("n_right"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("b"))
    zero = lambda c, z: F.coalesce(c, F.lit(z))
    return a.join(b, "year", "full_outer").select(
        "year", "n_left", "n_right", (zero("n_left", 0) - zero("n_right", 0)).alias("diff"), F.round("a", 2).alias("sum_left"), F.round("b", 2).alias("sum_right"),
        (F.abs(zero("a", 0.0) - zero("b", 0.0)) <= F.greatest(F.lit(1.0), F.abs("a") * 0.05)).alias("close"),
    )


# ---------------------------------------------------------------- aggregations

_DA = f"""SELECT vat, org_name, year, n_total, n_direct, round(100.0 * n_direct / n_total, 2) AS da_count_pct, value_total, value_direct,
    round(100.0 * value_direct / nullif(value_total, 0), 2) AS da_value_pct FROM (
    SELECT vat, year, count(*) AS n_total, count(*) FILTER ({_DIRECT}) AS n_direct, round(coalesce(sum(value), 0), 2) AS value_total,
    round(coalesce(sum(value) FILTER ({_DIRECT}), 0), 2) AS value_direct FROM auctions WHERE vat IS NOT NULL GROUP BY 1, 2) a
    JOIN (SELECT vat AS v2, year AS y2, org_name FROM (SELECT vat, year, org_name, row_number() OVER (PARTITION BY vat, year ORDER BY count(*) DESC, org_name) AS rn
    FROM auctions WHERE vat IS NOT NULL AND org_name IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1) m ON vat = v2 AND year = y2"""


@query("agg01_direct_share", X.acts("auctions") + " " + _DA.replace(" JOIN (", " LEFT JOIN ("))
def agg01(spark, d):
    return A.direct_share(acts.auctions(spark, d))


@query(
    "agg02_national_rollup",
    X.acts("auctions") + f" SELECT year, count(*) AS n, count(*) FILTER ({_DIRECT}) AS n_direct, round(100.0 * count(*) FILTER ({_DIRECT}) / count(*), 2) AS pct FROM auctions GROUP BY ROLLUP (year)",
)
def agg02(spark, d):
    direct = F.count_if(A.direct(F.col("proc_key")))
    return acts.auctions(spark, d).rollup("year").agg(F.count(F.lit(1)).alias("n"), direct.alias("n_direct"), S.pct(direct, F.count(F.lit(1))).alias("pct"))


_HHI = f"""per AS (SELECT vat, year, member_vat AS c, sum(value) AS v, count(*) AS n, count(*) FILTER (n_members > 1) AS multi FROM contracts
    WHERE vat IS NOT NULL AND member_vat IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2, 3),
    sh AS (SELECT *, v / sum(v) OVER (PARTITION BY vat, year) AS s, sum(v) OVER (PARTITION BY vat, year) AS total FROM per),
    hhi AS (SELECT vat, year, n_contracts, CASE WHEN n_contracts >= 10 THEN h END AS hhi, CASE WHEN n_contracts >= 10 THEN t END AS top1_share,
    CASE WHEN n_contracts >= 10 THEN round(100.0 * m / n_contracts, 2) END AS pct_multi_member, {_note("n_contracts", 10)} AS note FROM (
    SELECT vat, year, cast(sum(n) AS BIGINT) AS n_contracts, round(sum(s * s), 4) AS h, round(max(s), 4) AS t, sum(multi) AS m FROM sh WHERE total > 0 GROUP BY 1, 2))"""


@query("agg03_concentration", X.acts("contracts") + ", " + _HHI + " SELECT * FROM hhi")
def agg03(spark, d):
    return A.concentration(acts.contracts(spark, d))


_SB = f"""sb AS (SELECT vat, year, n_competitive, n_with_bids, n_single_bid, CASE WHEN n_with_bids >= 5 THEN round(100.0 * n_single_bid / n_with_bids, 2) END AS single_bid_pct,
    round(100.0 * n_with_bids / n_competitive, 1) AS coverage_pct, n_bids_outliers, {_note("n_with_bids", 5)} AS note FROM (
    SELECT vat, year, count(*) AS n_competitive, count(*) FILTER (coalesce(bids BETWEEN 1 AND 100, false)) AS n_with_bids, count(*) FILTER (bids = 1) AS n_single_bid,
    count(*) FILTER (bids IS NOT NULL AND NOT bids BETWEEN 1 AND 100) AS n_bids_outliers FROM contracts WHERE vat IS NOT NULL AND year * 100 + month >= 202504 AND {_COMPETITIVE} GROUP BY 1, 2))"""


@query("agg04_single_bids", X.acts("contracts") + ", " + _SB + " SELECT * FROM sb")
def agg04(spark, d):
    return A.single_bids(acts.contracts(spark, d))


def _digit_sql(expr: str, cond: str, lo: int, expected: str, size: str, name: str) -> str:
    return f"""{name} AS (SELECT vat, period, round(avg(abs(x)), 5) AS mad_{name}, round(sum(x * x / p) * max(total), 2) AS chi2_{name} FROM (
    SELECT s.vat, s.period, p, {size} AS total, coalesce(n, 0) / {size}::DOUBLE - p AS x FROM sizes s CROSS JOIN (SELECT d, {expected} AS p FROM range({lo}, 10) r(d)) e
    LEFT JOIN (SELECT vat, period, {expr} AS dd, count(*) AS n FROM both_levels WHERE {cond} GROUP BY 1, 2, 3) c ON c.vat = s.vat AND c.period = s.period AND c.dd = e.d WHERE {size} >= 300) GROUP BY 1, 2)"""


_BENFORD = (
    X.acts("payments")
    + """, rows_ AS (SELECT vat, year, value FROM payments WHERE vat IS NOT NULL),
    both_levels AS (SELECT vat, cast(year AS VARCHAR) AS period, value FROM rows_ UNION ALL SELECT vat, 'all', value FROM rows_),
    sizes AS (SELECT vat, period, count(*) AS n_rows, count(*) FILTER (value > 0) AS n_amounts, count(*) FILTER (value >= 10) AS n2 FROM both_levels GROUP BY 1, 2), """
    + _digit_sql("try_cast(regexp_extract(printf('%.2f', value), '[1-9]') AS INT)", "value > 0", 1, "log10(1 + 1.0 / d)", "n_amounts", "d1")
    + ", "
    + _digit_sql("try_cast(substr(cast(cast(floor(value) AS BIGINT) AS VARCHAR), 2, 1) AS INT)", "value >= 10", 0, "(SELECT sum(log10(1 + 1.0 / (10 * k + d))) FROM range(1, 10) q(k))", "n2", "d2")
    + f""" SELECT s.vat, s.period, n_amounts, mad_d1, mad_d2, chi2_d1, chi2_d2,
    CASE WHEN mad_d1 <= 0.006 THEN 'close' WHEN mad_d1 <= 0.012 THEN 'acceptable' WHEN mad_d1 <= 0.015 THEN 'marginal' WHEN mad_d1 IS NOT NULL THEN 'nonconformity' END AS band_d1,
    CASE WHEN mad_d2 <= 0.008 THEN 'close' WHEN mad_d2 <= 0.010 THEN 'acceptable' WHEN mad_d2 <= 0.012 THEN 'marginal' WHEN mad_d2 IS NOT NULL THEN 'nonconformity' END AS band_d2,
    round(100.0 * n_amounts / n_rows, 1) AS coverage_pct, {_note("n_amounts", 300)} AS note
    FROM sizes s LEFT JOIN d1 ON d1.vat = s.vat AND d1.period = s.period LEFT JOIN d2 ON d2.vat = s.vat AND d2.period = s.period"""
)


@query("agg05_digit_tests", _BENFORD)
def agg05(spark, d):
    return A.digit_tests(acts.payments(spark, d))


@query(
    "agg06_bunching",
    X.acts("auctions")
    + f""", t AS (SELECT vat, value, {_period_sql("day")} AS period, {_limit_sql("day", "contract_type")} AS lim FROM (
    SELECT *, try_cast(try_cast(submitted AS TIMESTAMP) AS DATE) AS day FROM auctions) WHERE vat IS NOT NULL AND value IS NOT NULL AND day IS NOT NULL)
    SELECT vat, period, n_below, n_above, CASE WHEN n_below >= 5 AND n_above >= 5 THEN round(n_below * 1.0 / n_above, 3) END AS density_ratio,
    CASE WHEN n_below < 5 OR n_above < 5 THEN 'ανεπαρκή δεδομένα (ζώνη<5)' END AS note FROM (
    SELECT vat, period, count(*) FILTER (value < lim) AS n_below, count(*) FILTER (value >= lim) AS n_above FROM t WHERE value BETWEEN lim * 0.8 AND lim * 1.2 GROUP BY 1, 2)""",
)
def agg06(spark, d):
    rows = acts.auctions(spark, d).withColumn("day", S.to_day(F.col("submitted")))
    return A.bunching(with_limit(rows, "day", "contract_type"), F.col("lim"))


_DR = f"""dr AS (SELECT vat, year, n_linked, CASE WHEN n_linked >= 5 THEN med END AS median_discount_pct, CASE WHEN n_linked >= 5 THEN round(100.0 * near / n_linked, 2) END AS pct_near_zero_discount,
    {_note("n_linked", 5)} AS note FROM (SELECT vat, year, count(*) AS n_linked, round(median(pct), 2) AS med, count(*) FILTER (abs(pct) <= 1.0) AS near FROM (
    SELECT a.vat, a.year, 100 * (n.estimate - a.value) / n.estimate AS pct FROM auctions a JOIN notices n ON a.notice_ref = n.ref WHERE a.vat IS NOT NULL AND a.value IS NOT NULL AND n.estimate > 0) GROUP BY 1, 2))"""


@query("agg07_jn02_discounts", X.acts("auctions", "notices") + ", " + _DR + " SELECT * FROM dr")
def agg07(spark, d):
    return A.discounts(acts.notices(spark, d), acts.auctions(spark, d))


_DL = f"""dl AS (SELECT vat, year, n_notices, CASE WHEN n_notices >= 5 THEN med END AS median_deadline_days, round(100.0 * n_notices / n_all, 1) AS coverage_pct, {_note("n_notices", 5)} AS note FROM (
    SELECT vat, year, count(*) FILTER (days >= 0) AS n_notices, count(*) AS n_all, round(median(days) FILTER (days >= 0), 1) AS med FROM (
    SELECT vat, year, final_day - submitted_day AS days FROM notices WHERE vat IS NOT NULL AND {_COMPETITIVE}) GROUP BY 1, 2))"""


@query("agg08_deadlines", X.acts("notices") + ", " + _DL + " SELECT * FROM dl")
def agg08(spark, d):
    return A.deadlines(acts.notices(spark, d))


_COMPOSITE = (
    X.acts("auctions", "contracts", "notices")
    + f", da AS ({_DA.replace(' JOIN (', ' LEFT JOIN (')}), {_HHI}, {_SB}, {_DR}, {_DL}"
    + """, fl AS (SELECT vat, year, 1 - (rank() OVER (PARTITION BY year ORDER BY median_deadline_days) + (count(*) OVER (PARTITION BY year, median_deadline_days) - 1) / 2.0) / count(*) OVER (PARTITION BY year) AS deadline_flag
    FROM dl WHERE median_deadline_days IS NOT NULL),
    j AS (SELECT da.vat, da.year, da.n_total, n_contracts, n_linked, n_notices, n_with_bids, da_count_pct / 100 AS flag_da_count, da_value_pct / 100 AS flag_da_value, hhi AS flag_hhi,
    pct_near_zero_discount / 100 AS flag_discount, deadline_flag, single_bid_pct / 100 AS flag_single_bid FROM da LEFT JOIN hhi USING (vat, year) LEFT JOIN dr USING (vat, year)
    LEFT JOIN dl USING (vat, year) LEFT JOIN fl USING (vat, year) LEFT JOIN sb USING (vat, year)),
    k AS (SELECT *, (flag_da_count IS NOT NULL)::INT + (flag_da_value IS NOT NULL)::INT + (flag_hhi IS NOT NULL)::INT + (flag_discount IS NOT NULL)::INT + (deadline_flag IS NOT NULL)::INT + (flag_single_bid IS NOT NULL)::INT AS n_flags FROM j)
    SELECT vat, year, n_total, n_contracts, n_linked, n_notices, n_with_bids, round((coalesce(flag_da_count, 0) + coalesce(flag_da_value, 0) + coalesce(flag_hhi, 0) + coalesce(flag_discount, 0)
    + coalesce(deadline_flag, 0) + coalesce(flag_single_bid, 0)) / nullif(n_flags, 0) + 1e-9, 4) AS score, n_flags FROM k"""
)


def composite(spark: SparkSession, d: str) -> DataFrame:
    """All indicators of an organisation and year side by side, and the mean of their flags."""
    auctions, contracts, notices = acts.auctions(spark, d), acts.contracts(spark, d), acts.notices(spark, d)
    keys = ["vat", "year"]
    dl = A.deadlines(notices)
    flag = dl.filter("median_deadline_days is not null").select(*keys, A.average_rank_percentile("median_deadline_days", "year").alias("deadline_flag"))
    joined = (
        A.direct_share(auctions)
        .join(A.concentration(contracts).drop("note"), keys, "left")
        .join(A.discounts(notices, auctions).drop("note"), keys, "left")
        .join(dl.drop("note", "coverage_pct"), keys, "left")
        .join(flag, keys, "left")
        .join(A.single_bids(contracts).drop("note", "coverage_pct"), keys, "left")
    )
    parts = {
        "flag_da_count": F.col("da_count_pct") / 100, "flag_da_value": F.col("da_value_pct") / 100, "flag_hhi": F.col("hhi"),
        "flag_discount": F.col("pct_near_zero_discount") / 100, "deadline_flag": F.col("deadline_flag"), "flag_single_bid": F.col("single_bid_pct") / 100,
    }
    score, n = A.composite(parts)
    return joined.withColumns({k: v for k, v in parts.items() if k != "deadline_flag"}).withColumn("score", score).withColumn("n_flags", n)


_COMPOSITE_CTE = _COMPOSITE[: _COMPOSITE.rindex("SELECT vat, year, n_total, n_contracts")] + ", comp AS (" + _COMPOSITE[_COMPOSITE.rindex("SELECT vat, year, n_total, n_contracts") :] + ")"


@query("agg09_jn03_composite", _COMPOSITE)
def agg09(spark, d):
    return composite(spark, d).select("vat", "year", "n_total", "n_contracts", "n_linked", "n_notices", "n_with_bids", "score", "n_flags")


_REGISTRY_FIELDS = ("authority", "classification", "nuts_code", "nuts_city")


def _mode_sql(f: str) -> str:
    return f"""m_{f} AS (SELECT vat, {f} FROM (SELECT vat, {f}, row_number() OVER (PARTITION BY vat ORDER BY count(*) DESC, {f}) AS rn FROM every WHERE {f} IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)"""


_NO_FIELDS = ", ".join(f"NULL AS {f}" for f in _REGISTRY_FIELDS)


@query(
    "agg11_12_registry",
    X.acts("auctions", "contracts", "notices")
    + f""", every AS (SELECT vat, org_name, year, {", ".join(_REGISTRY_FIELDS)} FROM auctions WHERE vat IS NOT NULL UNION ALL SELECT vat, org_name, year, {_NO_FIELDS} FROM contracts WHERE vat IS NOT NULL
    UNION ALL SELECT vat, org_name, year, {_NO_FIELDS} FROM notices WHERE vat IS NOT NULL), """
    + ", ".join(_mode_sql(f) for f in ("org_name", *_REGISTRY_FIELDS))
    + ", g AS (SELECT vat, count(*) AS n_records, min(year) AS first_year, max(year) AS last_year FROM every GROUP BY 1)"
    + " SELECT g.*, org_name, "
    + ", ".join(_REGISTRY_FIELDS)
    + " FROM g LEFT JOIN m_org_name USING (vat) "
    + " ".join(f"LEFT JOIN m_{f} USING (vat)" for f in _REGISTRY_FIELDS),
)
def agg11(spark, d):
    """The registry of organisations from awards, contracts and notices; the fields that only awards have from these."""
    shape = ["vat", "org_name", "year"]
    rows = acts.auctions(spark, d).select(*shape, *_REGISTRY_FIELDS)
    for t in (acts.contracts, acts.notices):
        rows = rows.unionByName(t(spark, d).select(*shape), allowMissingColumns=True)
    return rows.filter("vat is not null").groupBy("vat").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), *[F.mode(f, True).alias(f) for f in ("org_name", *_REGISTRY_FIELDS)]
    )


_QUALITY_TABLES = (("auction", True), ("contract", False), ("notice", False), ("payment", False))
_OWN_VAT = X.vat(chr(34) + "organizationVatNumber" + chr(34))


def _quality_sql(t: str, objects: bool) -> str:
    amount = X.capped(f"coalesce({X.num(chr(34) + 'totalCostWithoutVAT' + chr(34))}" + (f", {X.num(chr(34) + 'totalCostWithVAT' + chr(34))})" if t != "payment" else ")"))
    cpv = "(row_id IN (SELECT row_id FROM cpv_ok))::INT" if objects else "NULL::INT"
    return f"""SELECT '{t}' AS entity, _source_year AS year, ("referenceNumber" IS NOT NULL)::INT AS a, (try_cast("submissionDate" AS TIMESTAMP) IS NOT NULL)::INT AS b,
    ({_OWN_VAT} IS NOT NULL)::INT AS c, ({X.checksum(_OWN_VAT)})::INT AS k, coalesce({amount} > 0, false)::INT AS m, {cpv} AS p FROM {t}"""


_CPV_OK_SQL = f"""cpv_c AS (SELECT row_id, unnest(json_extract_string({X.json_array('"objectDetailsList"')}, '$[*].cpvs[*].key')) AS k FROM auction),
    cpv_ok AS (SELECT DISTINCT row_id FROM cpv_c WHERE regexp_full_match(trim(k), '[0-9]{{8}}(-[0-9])?'))"""
_QUALITY_SHARES = (("a", "pct_ref"), ("b", "pct_date"), ("c", "pct_vat"), ("k", "pct_checksum"), ("m", "pct_amount"), ("p", "pct_cpv"))


@query(
    "agg13_14_completeness",
    f"WITH {_CPV_OK_SQL}, u AS (" + " UNION ALL ".join(_quality_sql(t, o) for t, o in _QUALITY_TABLES) + ") SELECT entity, year, count(*) AS n, "
    + ", ".join(f"round(100.0 * sum({c}) / nullif(count({c}), 0), 2) AS {p}" for c, p in _QUALITY_SHARES)
    + ", CASE WHEN coalesce(entity, 'auction') = 'auction' THEN CASE year WHEN 2021 THEN '2021-02' WHEN 2025 THEN '2025-08' ELSE '' END ELSE '' END AS gaps FROM u GROUP BY GROUPING SETS ((entity, year), (year), ())",
)
def agg13(spark, d):
    """Shares of usable references, dates, tax ids, amounts and codes by entity and year, by year and in all, with the lost months."""
    out = None
    for t, objects in _QUALITY_TABLES:
        v = S.normalize_vat(q("organizationVatNumber"))
        amount = acts.act_value(q("totalCostWithoutVAT"), q("totalCostWithVAT")) if t != "payment" else S.sanitize_value(q("totalCostWithoutVAT"))
        part = read_table(spark, d, t).select(
            F.lit(t).alias("entity"), q("_source_year").alias("year"), q("referenceNumber").isNotNull().alias("a"),
            S.to_timestamp(q("submissionDate")).isNotNull().alias("b"), v.isNotNull().alias("c"), S.vat_checksum(v).alias("k"),
            F.coalesce(amount > 0, F.lit(False)).alias("m"), (any_cpv(q("objectDetailsList")) if objects else F.lit(None).cast("boolean")).alias("p"),
        )
        out = part if out is None else out.unionByName(part)
    n = F.count(F.lit(1))
    measures = [n.alias("n"), *[S.pct(F.count_if(c), F.nullif(F.count(c), F.lit(0))).alias(p) for c, p in _QUALITY_SHARES]]
    sets = out.groupingSets([[F.col("entity"), F.col("year")], [F.col("year")], []], F.col("entity"), F.col("year")).agg(*measures)
    lost = F.concat_ws(",", *[F.when(F.col("year") == int(m[:4]), m[:7]) for m in LOST_MONTHS])
    return sets.withColumn("gaps", F.when(F.coalesce("entity", F.lit("auction")) == "auction", lost).otherwise(""))


@query(
    "agg15_overview",
    X.acts("auctions")
    + f" SELECT vat, year, count(*) AS n_total, count(*) FILTER ({_DIRECT}) AS n_direct, round(100.0 * count(*) FILTER ({_DIRECT}) / count(*), 1) AS da_pct, round(coalesce(sum(value), 0), 2) AS value_total, count(DISTINCT member_vat) AS n_contractors FROM auctions WHERE vat IS NOT NULL GROUP BY 1, 2",
)
def agg15(spark, d):
    n, direct = F.count(F.lit(1)), F.count_if(A.direct(F.col("proc_key")))
    return acts.auctions(spark, d).filter("vat is not null").groupBy("vat", "year").agg(
        n.alias("n_total"), direct.alias("n_direct"), S.pct(direct, n, 1).alias("da_pct"),
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value_total"), F.count_distinct("member.vat").alias("n_contractors"),
    )


_CONTRACTOR = f"{X.vat('member_vat')}"


@query(
    "agg16_17_contractor_index",
    X.acts("auctions")
    + f", t AS (SELECT *, {_CONTRACTOR} AS cv FROM auctions) SELECT cv AS contractor, count(*) AS n_awards, round(coalesce(sum(value), 0), 2) AS value_total, count(DISTINCT vat) AS n_orgs, min(year) AS first_year, max(year) AS last_year FROM t WHERE cv IS NOT NULL GROUP BY 1",
)
def agg16(spark, d):
    rows = acts.auctions(spark, d).withColumn("contractor", S.normalize_vat(F.col("member.vat"))).filter("contractor is not null")
    return rows.groupBy("contractor").agg(
        F.count(F.lit(1)).alias("n_awards"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value_total"), F.count_distinct("vat").alias("n_orgs"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
    )


@query(
    "agg17_contractor_years",
    X.acts("auctions")
    + f", t AS (SELECT *, {_CONTRACTOR} AS cv FROM auctions) SELECT cv AS contractor, year, count(*) AS n_awards, round(coalesce(sum(value), 0), 2) AS value_total, count(DISTINCT vat) AS n_orgs FROM t WHERE cv IS NOT NULL GROUP BY 1, 2",
)
def agg17(spark, d):
    """A contractor's profile year by year."""
    rows = acts.auctions(spark, d).withColumn("contractor", S.normalize_vat(F.col("member.vat"))).filter("contractor is not null")
    return rows.groupBy("contractor", "year").agg(F.count(F.lit(1)).alias("n_awards"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value_total"), F.count_distinct("vat").alias("n_orgs"))


@query(
    "agg18_member_frequencies",
    X.acts("auctions")
    + f""", m AS (SELECT year, unnest(json_extract({X.json_array("members")}, '$[*]')) AS e FROM auctions),
    t AS (SELECT year, {X.vat("e->>'vatNumber'")} AS vat, e->>'name' AS name FROM m WHERE json_type(e) = 'OBJECT')
    SELECT vat, name, count(*) AS n, min(year) AS first_year, max(year) AS last_year FROM t WHERE name IS NOT NULL GROUP BY 1, 2""",
)
def agg18(spark, d):
    rows = acts.auctions(spark, d, raw=True).select("year", F.explode(F.from_json(acts.array_text(F.col("members")), "array<struct<vatNumber:string,name:string>>")).alias("e"))
    t = rows.select("year", S.normalize_vat(F.col("e.vatNumber")).alias("vat"), F.col("e.name").alias("name")).filter("name is not null")
    return t.groupBy("vat", "name").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@query(
    "agg19_alias_list",
    """WITH t AS (SELECT vat, canonical_name AS name, sum(n_total) AS n, max(last_year) AS last_year, min(first_year) AS first_year FROM contractor_aliases WHERE vat IS NOT NULL AND canonical_name IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY vat ORDER BY last_year DESC NULLS LAST, n DESC NULLS LAST, name) AS rn FROM t)
    SELECT vat, max(name) FILTER (rn = 1) AS canonical, array_to_string(list(name ORDER BY rn), '; ') AS names, count(*) AS n_names, cast(sum(n) AS BIGINT) AS n_total FROM r GROUP BY 1""",
)
def agg19(spark, d):
    t = read_table(spark, d, "contractor_aliases").filter("vat is not null and canonical_name is not null").groupBy("vat", F.col("canonical_name").alias("name")).agg(
        F.sum("n_total").alias("n"), F.max("last_year").alias("last_year")
    )
    entry = F.struct((-F.coalesce("last_year", F.lit(-1))).alias("y"), (-F.coalesce("n", F.lit(-1))).alias("k"), "name")
    return t.groupBy("vat").agg(F.sort_array(F.collect_list(entry)).alias("l"), F.count(F.lit(1)).alias("n_names"), F.sum("n").alias("n_total")).select(
        "vat", F.get("l", F.lit(0))["name"].alias("canonical"), F.array_join(F.transform("l", lambda e: e["name"]), "; ").alias("names"), "n_names", "n_total"
    )


def edges(auctions: DataFrame) -> DataFrame:
    """(vat, contractor, n_awards, amount): aggregated award edges."""
    rows = auctions.filter("vat is not null and member.vat is not null")
    return rows.groupBy("vat", F.col("member.vat").alias("contractor")).agg(
        F.count(F.lit(1)).alias("n_awards"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("amount")
    )


_EDGES = "edges AS (SELECT vat, member_vat AS contractor, count(*) AS n_awards, round(coalesce(sum(value), 0), 2) AS amount FROM auctions WHERE vat IS NOT NULL AND member_vat IS NOT NULL GROUP BY 1, 2)"


@query("agg20_award_edges", X.acts("auctions") + ", " + _EDGES + " SELECT * FROM edges")
def agg20(spark, d):
    return edges(acts.auctions(spark, d))


_BAD_JSON = "{0} IS NOT NULL AND {0} <> '' AND (NOT json_valid({0}) OR lower({0}) = 'nan')"
_FAILURES_SQL = f"""f AS (SELECT year, month, vat, own_vat, member_vat, cpv_key, cancelled, raw_vat IS NOT NULL AND own_vat IS NULL AS bad_vat, {_BAD_JSON.format("objects")} AS bad_objects, {_BAD_JSON.format("members")} AS bad_members,
    signed IS NOT NULL AND coalesce(year(try_cast(signed AS TIMESTAMP)) < 1900, true) AS bad_date FROM (SELECT a.*, r."organizationVatNumber" AS raw_vat FROM auctions a JOIN auction r ON a.row_id = r.row_id)),
    g AS (SELECT *, bad_vat::INT + bad_objects::INT + bad_members::INT + bad_date::INT AS n_bad FROM f)"""
FAILURES = ("bad_vat", "bad_objects", "bad_members", "bad_date")


def parse_failures(spark: SparkSession, d: str) -> DataFrame:
    """Awards with what could not be read of each: the tax id, both lists, the signature's date (before 1900 counts)."""
    rows = acts.auctions(spark, d, raw=True)
    raw = read_table(spark, d, "auction").select("row_id", q("organizationVatNumber").alias("raw_vat"))
    bad_json = lambda c: F.col(c).isNotNull() & (F.col(c) != "") & F.try_parse_json(c).isNull()
    out = rows.join(raw, "row_id").withColumns(
        {
            "bad_vat": F.col("raw_vat").isNotNull() & F.col("own_vat").isNull(), "bad_objects": bad_json("objects"), "bad_members": bad_json("members"),
            "bad_date": F.col("signed").isNotNull() & F.coalesce(F.year(S.to_timestamp(F.col("signed"))) < 1900, F.lit(True)),
        }
    )
    return out.withColumn("n_bad", sum((F.col(c).cast("int") for c in FAILURES[1:]), F.col(FAILURES[0]).cast("int")))


@query(
    "agg21_month_quality",
    X.acts("auctions") + f""", {_FAILURES_SQL} SELECT year, month, count(*) AS n, {", ".join(f"count(*) FILTER ({c}) AS {c}" for c in FAILURES)}, cast(sum(n_bad) AS BIGINT) AS n_failures,
    round(100.0 * sum(n_bad) / count(*), 4) AS failure_pct, sum(n_bad) / count(*) > 0.005 AS over_limit FROM g GROUP BY 1, 2""",
)
def agg21(spark, d):
    n, bad = F.count(F.lit(1)), F.sum("n_bad")
    return parse_failures(spark, d).groupBy("year", "month").agg(
        n.alias("n"), *[F.count_if(c).alias(c) for c in FAILURES], bad.alias("n_failures"), S.pct(bad, n, 4).alias("failure_pct"), (bad / n > 0.005).alias("over_limit")
    )


@query(
    "agg22_load_report",
    X.acts("auctions") + f""", {_FAILURES_SQL} SELECT count(*) AS n, cast(sum(n_bad) AS BIGINT) AS n_failures, round(100.0 * sum(n_bad) / count(*), 4) AS failure_pct, count(*) FILTER (cancelled) AS n_cancelled,
    round(100.0 * count(vat) / count(*), 2) AS pct_org_resolved, round(100.0 * count({X.vat("member_vat")}) / count(*), 2) AS pct_contractor_resolved, round(100.0 * count(cpv_key) / count(*), 2) AS pct_cpv_present FROM g""",
)
def agg22(spark, d):
    n = F.count(F.lit(1))
    return parse_failures(spark, d).agg(
        n.alias("n"), F.sum("n_bad").alias("n_failures"), S.pct(F.sum("n_bad"), n, 4).alias("failure_pct"), F.count_if("cancelled").alias("n_cancelled"), S.pct(F.count("vat"), n).alias("pct_org_resolved"),
        S.pct(F.count(S.normalize_vat(F.col("member.vat"))), n).alias("pct_contractor_resolved"), S.pct(F.count("cpv.key"), n).alias("pct_cpv_present"),
    )


@query(
    "agg23_lag_audit",
    X.acts("auctions")
    + f""", t AS (SELECT year, (year * 12 + month) - (year(s) * 12 + month(s)) AS lag FROM (SELECT *, try_cast(signed AS TIMESTAMP) AS s FROM auctions WHERE {_DIRECT}) WHERE year(s) BETWEEN 2019 AND 2026)
    SELECT year, count(*) AS n, median(lag) AS p50, quantile_cont(lag, 0.9) AS p90, quantile_cont(lag, 0.99) AS p99, count(*) FILTER (lag > 3) AS late, count(*) FILTER (lag < 0) AS negative FROM t GROUP BY ROLLUP (year)""",
)
def agg23(spark, d):
    s = S.to_timestamp(F.col("signed"))
    rows = acts.auctions(spark, d).filter(A.direct(F.col("proc_key"))).filter(F.year(s).between(2019, 2026))
    lag = (F.col("year") * 12 + F.col("month")) - (F.year(s) * 12 + F.month(s))
    return rows.select("year", lag.alias("lag")).rollup("year").agg(
        F.count(F.lit(1)).alias("n"), F.percentile("lag", F.lit(0.5)).alias("p50"), F.percentile("lag", F.lit(0.9)).alias("p90"), F.percentile("lag", F.lit(0.99)).alias("p99"),
        F.count_if(F.col("lag") > 3).alias("late"), F.count_if(F.col("lag") < 0).alias("negative"),
    )


@query(
    "agg28_win10_checksums",
    f"""WITH u AS (SELECT id_l AS id, vat_l AS v FROM entity_resolution_matches UNION ALL SELECT id_r, vat_r FROM entity_resolution_matches),
    o AS (SELECT id, min(v) AS v FROM u GROUP BY 1)
    SELECT id, v AS vat, CASE WHEN v IS NULL THEN 'missing' WHEN {X.checksum("v")} THEN 'valid' ELSE 'invalid' END AS state, CASE WHEN v IS NOT NULL THEN count(*) OVER (PARTITION BY v) END AS n_same FROM o""",
)
def agg28(spark, d):
    m = read_table(spark, d, "entity_resolution_matches")
    u = m.select(F.inline(F.array(F.struct(F.col("id_l").alias("id"), F.col("vat_l").alias("vat")), F.struct(F.col("id_r").alias("id"), F.col("vat_r").alias("vat")))))
    one = u.groupBy("id").agg(F.min("vat").alias("vat"))
    state = F.when(F.col("vat").isNull(), "missing").when(S.vat_checksum(F.col("vat")), "valid").otherwise("invalid")
    counts = one.filter("vat is not null").groupBy("vat").agg(F.count(F.lit(1)).alias("n_same"))
    return one.withColumn("state", state).join(counts, "vat", "left").select("id", "vat", "state", "n_same")


@query(
    "agg29_weighted_average",
    X.acts("auctions") + f", da AS ({_DA.replace(' JOIN (', ' LEFT JOIN (')}) SELECT year, round(sum(da_count_pct * n_total) / sum(n_total), 4) AS weighted FROM da WHERE da_count_pct IS NOT NULL GROUP BY ROLLUP (year)",
)
def agg29(spark, d):
    rows = A.direct_share(acts.auctions(spark, d)).filter("da_count_pct is not null")
    return rows.rollup("year").agg(F.round(F.sum(F.col("da_count_pct") * F.col("n_total")) / F.sum("n_total"), 4).alias("weighted"))


@query(
    "agg30_31_by_type",
    "SELECT coalesce(org_type, 'Άγνωστο') AS org_type, count(*) AS n, cast(sum(n_records) AS BIGINT) AS n_records, median(n_records) AS med FROM entities GROUP BY 1 ORDER BY n_records DESC, org_type LIMIT 6",
)
def agg30(spark, d):
    return (
        read_table(spark, d, "entities").groupBy(F.coalesce("org_type", F.lit("Άγνωστο")).alias("org_type"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_records").alias("n_records"), F.median("n_records").alias("med"))
        .orderBy(F.desc("n_records"), "org_type").limit(6)
    )


@query("agg33_missing_share", X.acts("payments") + " SELECT count(*) AS n, round(100.0 * sum((vat IS NULL)::INT) / count(*), 4) AS pct_missing FROM payments")
def agg33(spark, d):
    return acts.payments(spark, d).agg(F.count(F.lit(1)).alias("n"), S.pct(F.count_if(F.col("vat").isNull()), F.count(F.lit(1)), 4).alias("pct_missing"))


# ---------------------------------------------------------------- windows


@query(
    "win01_average_rank",
    X.acts("notices")
    + ", "
    + _DL
    + """ SELECT vat, year, round(1 - (rank() OVER (PARTITION BY year ORDER BY median_deadline_days) + (count(*) OVER (PARTITION BY year, median_deadline_days) - 1) / 2.0) / count(*) OVER (PARTITION BY year), 6) AS pr
    FROM dl WHERE median_deadline_days IS NOT NULL""",
)
def win01(spark, d):
    rows = A.deadlines(acts.notices(spark, d)).filter("median_deadline_days is not null")
    return rows.select("vat", "year", F.round(A.average_rank_percentile("median_deadline_days", "year"), 6).alias("pr"))


@query(
    "win02_group_percentile",
    """SELECT org_id, org_type, n_records, CASE WHEN count(*) OVER (PARTITION BY org_type) >= 20 THEN round(100.0 * cume_dist() OVER (PARTITION BY org_type ORDER BY n_records), 1) END AS percentile FROM entities WHERE n_records IS NOT NULL""",
)
def win02(spark, d):
    rows = read_table(spark, d, "entities").filter("n_records is not null").select("org_id", "org_type", "n_records")
    return W.group_percentile(rows, "n_records", ["org_type"])


@query(
    "win03_size_thirds",
    """WITH t AS (SELECT org_id, org_type, row_number() OVER (PARTITION BY org_type ORDER BY n_records, vat) AS r, count(*) OVER (PARTITION BY org_type) AS n FROM entities)
    SELECT org_id, CASE WHEN n < 60 THEN NULL WHEN r <= n // 3 + (n % 3 = 2)::INT THEN 'S' WHEN r <= 2 * (n // 3) + (n % 3 = 2)::INT THEN 'M' ELSE 'L' END AS third FROM t""",
)
def win03(spark, d):
    return W.size_thirds(read_table(spark, d, "entities"), "org_type", "n_records", "vat").select("org_id", "third")


@query(
    "win04_05_histogram",
    """WITH r AS (SELECT org_type, min(n_records) AS lo, max(n_records) AS hi, count(*) AS n FROM entities WHERE n_records IS NOT NULL GROUP BY 1),
    r2 AS (SELECT org_type, lo, CASE WHEN hi = lo THEN lo + 1 ELSE hi END AS hi, n FROM r),
    c AS (SELECT e.org_type, cast(least(floor((e.n_records - lo) / (hi - lo)::DOUBLE * 12), 11) AS INT) AS bin, count(*) AS cnt FROM entities e JOIN r2 ON e.org_type = r2.org_type WHERE n_records IS NOT NULL GROUP BY 1, 2)
    SELECT r2.org_type, lo, hi, n, cast(b AS INT) AS bin, coalesce(cnt, 0) AS count FROM r2 CROSS JOIN range(12) g(b) LEFT JOIN c ON c.org_type = r2.org_type AND c.bin = b WHERE r2.org_type IS NOT NULL""",
)
def win04(spark, d):
    rows = read_table(spark, d, "entities").filter("org_type is not null")
    return W.histogram(rows, "n_records", ["org_type"])


@query(
    "win06_name_share",
    "WITH " + X.COUNTS + " SELECT name, vat, n, round(n * 1.0 / sum(n) OVER (PARTITION BY name), 6) AS share FROM counts",
)
def win06(spark, d):
    counts = acts.name_counts([read_table(spark, d, t) for t in ("auction", "contract", "notice")])
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("name")), 6))


@query(
    "win08_adjust_p",
    """WITH t AS (SELECT org_id, (n_records % 97) / 97.0::DOUBLE AS p FROM entities), r AS (SELECT *, row_number() OVER (ORDER BY p, org_id) AS k, count(*) OVER () AS n FROM t)
    SELECT org_id, round(greatest(least(min(p * n / k) OVER (ORDER BY k DESC ROWS UNBOUNDED PRECEDING), 1.0), 0.0), 9) AS adjusted FROM r""",
)
def win08(spark, d):
    rows = read_table(spark, d, "entities").select("org_id", ((F.col("n_records") % 97) / F.lit(97.0)).alias("p"))
    return W.adjust_p_values(rows, "p", "org_id").select("org_id", F.round("adjusted", 9).alias("adjusted"))


# Bands of the similarity of audited pairs, right-closed, the first closed on both sides.
BANDS = ((0.5, 0.7), (0.7, 0.85), (0.85, 0.95), (0.95, 1.001))
_BAND_SQL = "CASE " + " ".join(f"WHEN jw_score >{'=' if i == 0 else ''} {a} AND jw_score <= {b} THEN '{a}-{min(b, 1.0)}'" for i, (a, b) in enumerate(BANDS)) + " END"
_PAIRS_SQL = f"""m AS (SELECT id_l, id_r, max(jw_score) AS jw_score, coalesce(min(vat_l) = min(vat_r), false) AS same_vat FROM entity_resolution_matches GROUP BY 1, 2),
    s AS (SELECT *, {_BAND_SQL} AS band, md5(id_l || '-' || id_r || '-42') AS h FROM m)"""


def _scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    m = read_table(spark, d, "entity_resolution_matches").groupBy("id_l", "id_r").agg(
        F.max("jw_score").alias("jw_score"), F.coalesce(F.min("vat_l") == F.min("vat_r"), F.lit(False)).alias("same_vat")
    )
    score = F.col("jw_score")
    band = F.coalesce(*[F.when((score >= a if i == 0 else score > a) & (score <= b), f"{a}-{min(b, 1.0)}") for i, (a, b) in enumerate(BANDS)])
    return m.withColumn("band", band).withColumn("h", F.md5(F.concat_ws("-", "id_l", "id_r", F.lit("42"))))


def audit_sample(pairs: DataFrame, size: int) -> DataFrame:
    """``size`` pairs: a quarter per band, 70 % of it of unequal tax ids where there are as many, then any others.

    Rows are ordered by a seeded hash, the same on any cluster; a stratum is pruned to its quota before it is
    shuffled, and the rest to ``size``.
    """
    per_band = size // len(BANDS)
    n_diff = int(per_band * 0.7)
    top = W.top_k(pairs.filter("band is not null"), ["band", "same_vat"], [F.col("h"), F.col("id_l"), F.col("id_r")], per_band)
    taken = top.filter((F.col("same_vat") == F.lit(False)) & (F.col("rank") <= n_diff)).groupBy("band").agg(F.count(F.lit(1)).alias("k"))
    quota = F.when(F.col("same_vat"), per_band - F.coalesce("k", F.lit(0))).otherwise(n_diff)
    chosen = top.join(taken, "band", "left").filter(F.col("rank") <= quota).drop("rank", "k").withColumn("part", F.lit(0))
    rest = pairs.join(chosen.select("id_l", "id_r"), ["id_l", "id_r"], "left_anti").orderBy("h", "id_l", "id_r").limit(size).withColumn("part", F.lit(1))
    return chosen.unionByName(rest).orderBy("part", "h", "id_l", "id_r").limit(size).drop("part")


@query(
    "win11_stratified_sample",
    f"""WITH {_PAIRS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY band, same_vat ORDER BY h, id_l, id_r) AS rn FROM s WHERE band IS NOT NULL),
    k AS (SELECT band, least(count(*) FILTER (NOT same_vat), 35) AS k FROM r GROUP BY 1), c AS (SELECT id_l, id_r, band, same_vat, h, 0 AS part FROM r JOIN k USING (band) WHERE rn <= CASE WHEN same_vat THEN 50 - k ELSE 35 END),
    e AS (SELECT id_l, id_r, band, same_vat, h, 1 AS part FROM s WHERE (id_l, id_r) NOT IN (SELECT (id_l, id_r) FROM c))
    SELECT id_l, id_r, band, same_vat FROM (SELECT * FROM c UNION ALL SELECT * FROM e) ORDER BY part, h, id_l, id_r LIMIT 200""",
)
def win11(spark, d):
    return audit_sample(_scored_pairs(spark, d).filter("id_l is not null and id_r is not null"), 200).select("id_l", "id_r", "band", "same_vat")


def independent_sample(pairs: DataFrame, size: int) -> DataFrame:
    """``size`` pairs, half of equal and half of unequal tax ids; either side fills up what the other lacks."""
    top = W.top_k(pairs, ["same_vat"], [F.col("h"), F.col("id_l"), F.col("id_r")], size)
    first = top.withColumn("part", F.when(F.col("rank") <= F.when(F.col("same_vat"), size // 2).otherwise(size - size // 2), 0).otherwise(1))
    return first.orderBy("part", "h", "id_l", "id_r").limit(size).drop("rank", "part")


@query(
    "win12_independent_sample",
    f"""WITH {_PAIRS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY same_vat ORDER BY h, id_l, id_r) AS rn FROM s)
    SELECT id_l, id_r, same_vat FROM r WHERE rn <= 30 ORDER BY CASE WHEN rn <= 15 THEN 0 ELSE 1 END, h, id_l, id_r LIMIT 30""",
)
def win12(spark, d):
    return independent_sample(_scored_pairs(spark, d).filter("id_l is not null and id_r is not null"), 30).select("id_l", "id_r", "same_vat")


# ---------------------------------------------------------------- top-k


@query(
    "top01_cpv",
    X.acts("auctions")
    + """, g AS (SELECT vat, cpv_key, cpv_value, round(coalesce(sum(value), 0), 2) AS v FROM auctions WHERE vat IS NOT NULL AND cpv_key IS NOT NULL AND cpv_value IS NOT NULL GROUP BY 1, 2, 3)
    SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY vat ORDER BY v DESC, cpv_key, cpv_value) AS INT) AS rank FROM g) WHERE rank <= 10""",
)
def top01(spark, d):
    g = acts.auctions(spark, d).filter("vat is not null and cpv.key is not null and cpv.value is not null").groupBy("vat", F.col("cpv.key").alias("cpv_key"), F.col("cpv.value").alias("cpv_value")).agg(
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("v")
    )
    return W.top_k(g, ["vat"], [F.desc("v"), F.col("cpv_key"), F.col("cpv_value")], 10)


@query(
    "top02_contractors",
    X.acts("auctions") + ", " + _EDGES + """ SELECT * FROM (SELECT vat, contractor, amount, round(100 * amount / nullif(sum(amount) OVER (PARTITION BY vat), 0), 1) AS share,
    cast(row_number() OVER (PARTITION BY vat ORDER BY amount DESC, contractor) AS INT) AS rank FROM edges) WHERE rank <= 10""",
)
def top02(spark, d):
    return top_contractors(edges(acts.auctions(spark, d)), 10, 100, 1)


def top_contractors(e: DataFrame, k: int, unit: int, digits: int) -> DataFrame:
    """The first contractors of each organisation by amount, with their share of its whole amount.

    Rows are pruned to the first ``k`` before they are joined with the totals.
    """
    top = W.top_k(e.drop("n_awards"), ["vat"], [F.desc("amount"), F.col("contractor")], k)
    totals = e.groupBy("vat").agg(F.sum("amount").alias("total"))
    return top.join(totals, "vat").select("vat", "contractor", "amount", F.round(F.try_divide(unit * F.col("amount"), F.col("total")), digits).alias("share"), "rank")


@query(
    "top03_recent",
    X.acts("auctions")
    + """ SELECT vat, row_id, day, rank FROM (SELECT vat, row_id, day, cast(row_number() OVER (PARTITION BY vat ORDER BY day DESC, row_id DESC) AS INT) AS rank FROM (
    SELECT *, try_cast(try_cast(submitted AS TIMESTAMP) AS DATE) AS day FROM auctions WHERE vat IS NOT NULL) WHERE day IS NOT NULL) WHERE rank <= 50""",
)
def top03(spark, d):
    rows = acts.auctions(spark, d).filter("vat is not null").select("vat", "row_id", S.to_day(F.col("submitted")).alias("day")).filter("day is not null")
    return W.top_k(rows, ["vat"], [F.desc("day"), F.desc("row_id")], 50)


@query(
    "top05_global",
    X.acts("auctions")
    + " SELECT member_vat AS contractor, round(sum(value), 2) AS v FROM auctions WHERE member_vat IS NOT NULL AND value IS NOT NULL GROUP BY 1 ORDER BY v DESC, 1 LIMIT 5000",
)
def top05(spark, d):
    rows = acts.auctions(spark, d).filter("member.vat is not null and value is not null")
    return rows.groupBy(F.col("member.vat").alias("contractor")).agg(F.round(F.sum("value"), 2).alias("v")).orderBy(F.desc("v"), "contractor").limit(5000)


@query(
    "top06_07_latest_year",
    X.acts("auctions") + f", da AS ({_DA.replace(' JOIN (', ' LEFT JOIN (')}) SELECT vat, year, n_total FROM (SELECT *, row_number() OVER (PARTITION BY vat ORDER BY year DESC) AS rn FROM da WHERE n_total >= 5) WHERE rn = 1",
)
def top06(spark, d):
    rows = A.direct_share(acts.auctions(spark, d)).filter("n_total >= 5")
    return rows.groupBy("vat").agg(F.max(F.struct("year", "n_total")).alias("x")).select("vat", "x.year", "x.n_total")


@query(
    "top09_11_search",
    f"""WITH t AS (SELECT org_id, vat, name, CASE WHEN starts_with(vat, '50') THEN 0 WHEN starts_with({X.norm_name(X.plain("name"))}, 'ΔΗΜΟΣ ΒΑ') THEN 1 WHEN contains({X.norm_name(X.plain("name"))}, 'ΚΑΣΤΡΟΥ') THEN 2 END AS score FROM entities)
    SELECT org_id, score FROM t WHERE score IS NOT NULL ORDER BY score, org_id LIMIT 8""",
)
def top09(spark, d):
    n = S.normalize_greek(F.col("name"))
    score = F.when(F.col("vat").startswith("50"), 0).when(n.startswith("ΔΗΜΟΣ ΒΑ"), 1).when(n.contains("ΚΑΣΤΡΟΥ"), 2)
    return read_table(spark, d, "entities").select("org_id", score.alias("score")).filter("score is not null").orderBy("score", "org_id").limit(8)


@query(
    "top12_compare_medians",
    """SELECT org_id, n_records, (SELECT median(n_records) FROM entities) AS med, CASE WHEN n_records > 2 * (SELECT median(n_records) FROM entities) THEN 'high' WHEN n_records > 1.4 * (SELECT median(n_records) FROM entities) THEN 'raised' ELSE 'usual' END AS level FROM entities WHERE org_id IN (1, 2, 3, 5)""",
)
def top12(spark, d):
    e = read_table(spark, d, "entities")
    med = e.agg(F.median("n_records")).scalar()
    level = F.when(F.col("n_records") > 2 * F.col("med"), "high").when(F.col("n_records") > 1.4 * F.col("med"), "raised").otherwise("usual")
    return e.filter(F.col("org_id").isin(1, 2, 3, 5)).withColumn("med", med).select("org_id", "n_records", "med", level.alias("level"))


# ---------------------------------------------------------------- graph


@query(
    "gr01_exclusive_pairs",
    X.acts("auctions") + ", " + _EDGES + """, s AS (SELECT *, round(amount / nullif(sum(amount) OVER (PARTITION BY contractor), 0), 4) AS share_c, round(amount / nullif(sum(amount) OVER (PARTITION BY vat), 0), 4) AS share_o FROM edges)
    SELECT vat, contractor, amount, share_c, share_o FROM s WHERE amount >= 10000 AND (share_c >= 0.5 OR share_o >= 0.5)""",
)
def gr01(spark, d):
    e = edges(acts.auctions(spark, d))

    def share(of: str):
        return F.round(F.try_divide("amount", F.sum("amount").over(Window.partitionBy(of))), 4)

    s = e.withColumn("share_c", share("contractor")).withColumn("share_o", share("vat"))
    return s.filter("amount >= 10000 and (share_c >= 0.5 or share_o >= 0.5)").drop("n_awards")


@query(
    "gr02_bridges",
    X.acts("auctions")
    + """, o AS (SELECT DISTINCT member_vat AS contractor, left(cpv_key, 2) AS division, vat FROM auctions WHERE vat IS NOT NULL AND member_vat IS NOT NULL AND cpv_key IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY contractor, division ORDER BY vat) AS rn FROM o)
    SELECT contractor, division, count(*) AS n_orgs, array_to_string(list(vat ORDER BY vat) FILTER (rn <= 10), ',') AS sample FROM r GROUP BY 1, 2 HAVING count(*) >= 5""",
)
def gr02(spark, d):
    rows = acts.auctions(spark, d).filter("vat is not null and member.vat is not null and cpv.key is not null")
    orgs = rows.select(F.col("member.vat").alias("contractor"), F.left(F.col("cpv.key"), F.lit(2)).alias("division"), "vat").distinct()
    many = orgs.groupBy("contractor", "division").agg(F.count(F.lit(1)).alias("n_orgs")).filter("n_orgs >= 5")
    first = W.top_k(orgs, ["contractor", "division"], [F.col("vat")], 10).groupBy("contractor", "division").agg(F.array_join(F.array_sort(F.collect_list("vat")), ",").alias("sample"))
    return many.join(first, ["contractor", "division"])


@query(
    "gr03_win07_jn25_new_winners",
    X.acts("auctions")
    + """, y AS (SELECT DISTINCT vat, year, member_vat AS c FROM auctions WHERE vat IS NOT NULL AND member_vat IS NOT NULL),
    f AS (SELECT *, min(year) OVER (PARTITION BY vat, c) AS first FROM y), o AS (SELECT vat, min(year) AS org_first FROM auctions WHERE vat IS NOT NULL GROUP BY 1)
    SELECT f.vat, f.year, count(*) AS n_contractors, count(*) FILTER (first = f.year) AS n_new, round(count(*) FILTER (first = f.year) * 1.0 / count(*), 4) AS rate, f.year = min(org_first) AS left_censored
    FROM f JOIN o USING (vat) GROUP BY f.vat, f.year HAVING count(*) >= 5""",
)
def gr03(spark, d):
    a = acts.auctions(spark, d).filter("vat is not null")
    first = F.min("year").over(Window.partitionBy("vat", "c"))
    y = a.filter("member.vat is not null").select("vat", "year", F.col("member.vat").alias("c")).distinct().withColumn("first", first)
    orgs = a.groupBy("vat").agg(F.min("year").alias("org_first"))
    g = y.groupBy("vat", "year").agg(F.count(F.lit(1)).alias("n_contractors"), F.count_if(F.col("first") == F.col("year")).alias("n_new")).filter("n_contractors >= 5")
    return g.join(orgs, "vat").select(
        "vat", "year", "n_contractors", "n_new", F.round(F.col("n_new") / F.col("n_contractors"), 4).alias("rate"), (F.col("year") == F.col("org_first")).alias("left_censored")
    )


@query(
    "gr04_top08_ego",
    X.acts("auctions") + ", " + _EDGES + """ SELECT vat, contractor, amount, share, rank FROM (SELECT vat, contractor, amount, round(amount / nullif(sum(amount) OVER (PARTITION BY vat), 0), 4) AS share,
    cast(row_number() OVER (PARTITION BY vat ORDER BY amount DESC, contractor) AS INT) AS rank FROM edges) WHERE rank <= 30""",
)
def gr04(spark, d):
    return top_contractors(edges(acts.auctions(spark, d)), 30, 1, 4)


def alternation(rows: DataFrame, by: list[str], min_years: int) -> DataFrame:
    """Groups with exactly two contractors (column c) ever, each in at least ``min_years`` years."""
    pairs = rows.groupBy(*by, "c").agg(F.count_distinct("year").alias("years"))
    g = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("years").alias("least"), F.min("c").alias("first_c"), F.max("c").alias("second_c"))
    return g.filter((F.col("n") == 2) & (F.col("least") >= min_years)).select(*by, "first_c", "second_c")


def _alternation_sql(by: str, where: str, years: int) -> str:
    return X.acts("auctions") + f""", t AS (SELECT *, left(cpv_key, 4) AS market, nuts_code FROM auctions), p AS (SELECT {by}, member_vat AS c, count(DISTINCT year) AS years FROM t WHERE vat IS NOT NULL AND member_vat IS NOT NULL{where} GROUP BY ALL)
    SELECT {by}, min(c) AS first_c, max(c) AS second_c FROM p GROUP BY {by} HAVING count(*) = 2 AND min(years) >= {years}"""


def _won(spark: SparkSession, d: str) -> DataFrame:
    rows = acts.auctions(spark, d).filter("vat is not null and member.vat is not null")
    return rows.select("vat", "year", F.col("member.vat").alias("c"), F.left(F.col("cpv.key"), F.lit(4)).alias("market"))


@query("gr05_alternation", _alternation_sql("vat", "", 3))
def gr05(spark, d):
    return alternation(_won(spark, d), ["vat"], 3)


@query("gr05_alternation_in_market", _alternation_sql("vat, market", " AND market IS NOT NULL", 1))
def gr05_market(spark, d):
    """The same within an organisation's markets (four digits of the code), of any number of years."""
    return alternation(_won(spark, d).filter("market is not null"), ["vat", "market"], 1)


_KEYS_SQL = {
    "organization.vat": "SELECT vat AS k FROM (SELECT DISTINCT vat, 1 FROM auctions WHERE vat IS NOT NULL)", "contractor.vat": "SELECT DISTINCT member_vat AS k FROM auctions WHERE member_vat IS NOT NULL",
    "award.ref": "SELECT ref AS k FROM auctions WHERE ref IS NOT NULL", "cpv.code": "SELECT DISTINCT cpv_key AS k FROM auctions WHERE cpv_key IS NOT NULL", "nuts.code": "SELECT DISTINCT nuts_code AS k FROM auctions WHERE nuts_code IS NOT NULL",
}


@query(
    "gr11_unique_keys",
    X.acts("auctions") + " " + " UNION ALL ".join(f"SELECT '{n}' AS key, coalesce(cast(sum(c) AS BIGINT), 0) AS n, count(*) FILTER (c > 1) AS n_repeated FROM (SELECT k, count(*) AS c FROM ({t}) GROUP BY 1)" for n, t in _KEYS_SQL.items()),
)
def gr11(spark, d):
    """The five keys that must be unique, over the vertex tables as they are written."""
    out = None
    for name, table in graphfiles.vertices(acts.auctions(spark, d)).items():
        key = table.columns[0]
        per = table.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
        part = per.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 1).alias("n_repeated")).select(F.lit(f"{name}.{key}").alias("key"), "n", "n_repeated")
        out = part if out is None else out.unionByName(part)
    return out
