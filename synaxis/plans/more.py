"""Profiles, record linkage, graph algorithms, plans over listings and the stream; registered beside the rest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synaxis.functions import scalars as S
from synaxis.operators import aggregates as A
from synaxis.operators import graph as G
from synaxis.operators import linkage as L
from synaxis.operators import windows as W
from synaxis.plans import reference as R
from synaxis.plans import sqltext as X
from synaxis.plans.reference import _DA, _EDGES, _HHI, query
from synaxis.session import checkpoint_dir, q, read_table
from synaxis.sources import acts, graphfiles
from synaxis.sources.files import keyed_json
from synaxis.streaming.incremental import windowed_counts

_DA_CTE = f", da AS ({_DA.replace(' JOIN (', ' LEFT JOIN (')})"
VALUE = "round(coalesce(sum(value), 0), 2)"


# ---------------------------------------------------------------- sources, profiles


@query(
    "src03_slim",
    X.acts("auctions") + " SELECT row_id, vat, year, proc_key, value, cpv_key, member_vat, try_cast(try_cast(submitted AS TIMESTAMP) AS DATE) AS day FROM auctions",
)
def src03(spark, d):
    return acts.auctions(spark, d).select(
        "row_id", "vat", "year", "proc_key", "value", F.col("cpv.key").alias("cpv_key"), F.col("member.vat").alias("member_vat"), S.to_day(F.col("submitted")).alias("day")
    )


_BENFORD_CTE = X.PAYMENTS + ", " + R._BENFORD.split(", rows_ AS", 1)[1].join(["rows_ AS", ""])
_BENFORD_BODY = _BENFORD_CTE[: _BENFORD_CTE.rindex(" SELECT s.vat, s.period")] + ", benford AS (" + _BENFORD_CTE[_BENFORD_CTE.rindex(" SELECT s.vat, s.period") :] + ")"
_MERGED = R._COMPOSITE_CTE + ", " + _BENFORD_BODY
_SIDES = ("hhi", "median_discount_pct", "single_bid_pct", "median_deadline_days", "score", "mad_d1")


@query(
    "jn04_indicator_merge",
    _MERGED + """, e AS (SELECT vat, min(org_type) AS org_type, min(nuts_city) AS nuts_city FROM entities GROUP BY 1)
    SELECT da.vat, da.year, da.n_total, da.da_count_pct, hhi.hhi, dr.median_discount_pct, sb.single_bid_pct, dl.median_deadline_days, comp.score, b.mad_d1, e.org_type, e.nuts_city FROM da
    LEFT JOIN hhi USING (vat, year) LEFT JOIN dr USING (vat, year) LEFT JOIN sb USING (vat, year) LEFT JOIN dl USING (vat, year) LEFT JOIN comp USING (vat, year)
    LEFT JOIN benford b ON b.vat = da.vat AND b.period = cast(da.year AS VARCHAR) LEFT JOIN e ON e.vat = da.vat""",
)
def jn04(spark, d):
    """All yearly indicators of an organisation side by side, with its registry entry; each side may be missing."""
    return merged_indicators(spark, d).select("vat", "year", "n_total", "da_count_pct", *_SIDES, "org_type", "nuts_city")


def merged_indicators(spark, d) -> DataFrame:
    registry = read_table(spark, d, "entities").groupBy("vat").agg(F.min("org_type").alias("org_type"), F.min("nuts_city").alias("nuts_city"))
    digits = A.digit_tests(acts.payments(spark, d)).filter("period <> 'all'").select("vat", F.col("period").cast("int").alias("year"), "mad_d1")
    return R.composite(spark, d).join(digits, ["vat", "year"], "left").join(registry, "vat", "left")


@query(
    "jn05_group_lookup",
    X.acts("auctions") + _DA_CTE + " SELECT da.vat, da.year, e.org_type AS grp, da.da_count_pct FROM da JOIN entities e ON da.vat = e.vat WHERE e.org_type IS NOT NULL",
)
def jn05(spark, d):
    groups = read_table(spark, d, "entities").filter("org_type is not null").select("vat", F.col("org_type").alias("grp"))
    return A.direct_share(acts.auctions(spark, d)).join(groups, "vat").select("vat", "year", "grp", "da_count_pct")


_NEW_WINNERS = R.ORACLE["gr03_win07_jn25_new_winners"]
_NWR_CTES = _NEW_WINNERS[len(X.acts("auctions")) + 2 : _NEW_WINNERS.rindex("SELECT f.vat, f.year")].strip()
_NWR = f"{_NWR_CTES}, nwr AS ({_NEW_WINNERS[_NEW_WINNERS.rindex('SELECT f.vat, f.year'):]})"


def _listed(v: str, digits: int | None = None) -> str:
    return f"array_to_string(list(year || ':' || {v} ORDER BY year) FILTER ({v} IS NOT NULL), ',')"


@query(
    "jn06_agg34_profile",
    _MERGED + f""", {_NWR.replace("f AS (", "fw AS (").replace("FROM f JOIN o", "FROM fw f JOIN ow").replace(" o AS (", " ow AS (")}, m AS (SELECT da.vat, da.year, da.n_total, cast(round(da_count_pct * 100) AS BIGINT) AS da, cast(round(hhi * 10000) AS BIGINT) AS h, cast(round(single_bid_pct * 100) AS BIGINT) AS s,
    cast(round(median_discount_pct * 100) AS BIGINT) AS r, cast(round(median_deadline_days * 10) AS BIGINT) AS d, cast(round(score * 10000) AS BIGINT) AS c, cast(round(mad_d1 * 100000) AS BIGINT) AS b FROM da
    LEFT JOIN hhi USING (vat, year) LEFT JOIN dr USING (vat, year) LEFT JOIN sb USING (vat, year) LEFT JOIN dl USING (vat, year) LEFT JOIN comp USING (vat, year) LEFT JOIN benford x ON x.vat = da.vat AND x.period = cast(da.year AS VARCHAR)),
    p AS (SELECT vat, cast(sum(n_total) AS BIGINT) AS n, max(year) AS latest, {", ".join(f"coalesce({_listed(v)}, '') AS {n}" for v, n in (("da", "direct"), ("h", "hhi"), ("s", "single_bid"), ("r", "discount"), ("d", "deadline"), ("c", "composite"), ("b", "digits")))} FROM m GROUP BY 1),
    w AS (SELECT vat, array_to_string(list(year || ':' || cast(round(rate * 1000) AS BIGINT) || CASE WHEN left_censored THEN 'c' ELSE '' END ORDER BY year), ',') AS new_winners FROM nwr GROUP BY 1)
    SELECT p.*, coalesce(new_winners, '') AS new_winners FROM p LEFT JOIN w USING (vat)""",
)
def jn06(spark, d):
    """Profiles with a map from year to value for each indicator and for new winners, here written as lists.

    Values are whole numbers of their last digit (2,500 is 25.00 %, 300 new winners of a thousand are 30.0);
    ``c`` marks a first year, in which every winner is new.
    """
    p = profiles(merged_indicators(spark, d), R.QUERIES["gr03_win07_jn25_new_winners"](spark, d))

    def listed(column: str, scale: int):
        whole = F.transform(column, lambda e: F.concat_ws(":", e["year"], F.round(e["v"] * scale).cast("long")))
        return F.array_join(whole, ",")

    winners = F.array_join(F.transform("new_winners", lambda e: F.concat(F.concat_ws(":", e["year"], F.round(e["v"] * 1000).cast("long")), F.when(e["left_censored"], "c").otherwise(""))), ",")
    return p.select("vat", "n", "latest", *[listed(k, s).alias(k) for k, (_, s) in PROFILE_MAPS.items()], F.coalesce(winners, F.lit("")).alias("new_winners"))


#: The maps of a profile: column of the merged indicators, and how many of its last digit make one.
PROFILE_MAPS = {
    "direct": ("da_count_pct", 100), "hhi": ("hhi", 10000), "single_bid": ("single_bid_pct", 100), "discount": ("median_discount_pct", 100), "deadline": ("median_deadline_days", 10),
    "composite": ("score", 10000), "digits": ("mad_d1", 100000),
}


def profiles(merged: DataFrame, winners: DataFrame) -> DataFrame:
    """Nested documents: per organisation, for each indicator, the (year, v) entries that it has, in order; a dozen each."""
    def entries(column: str):
        return F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), F.struct("year", F.col(column).alias("v")))))

    maps = merged.groupBy("vat").agg(F.sum("n_total").alias("n"), F.max("year").alias("latest"), *[entries(c).alias(k) for k, (c, _) in PROFILE_MAPS.items()])
    new = winners.groupBy("vat").agg(F.array_sort(F.collect_list(F.struct("year", F.col("rate").alias("v"), "left_censored"))).alias("new_winners"))
    return maps.join(new, "vat", "left")


@query(
    "jn07_link_coverage",
    X.acts("auctions", "notices") + _DA_CTE
    + """, l AS (SELECT a.vat, a.year, count(*) AS n_linked FROM auctions a JOIN notices n ON a.notice_ref = n.ref WHERE a.vat IS NOT NULL AND a.value IS NOT NULL AND n.estimate > 0 GROUP BY 1, 2)
    SELECT da.vat, da.year, round(100.0 * n_linked / n_total, 1) AS coverage, coalesce(100.0 * n_linked / n_total < 20, true) AS insufficient FROM da LEFT JOIN l USING (vat, year)""",
)
def jn07(spark, d):
    auctions = acts.auctions(spark, d)
    linked = A.discounts(acts.notices(spark, d), auctions).select("vat", "year", "n_linked")
    share = F.try_divide(100.0 * F.col("n_linked"), F.col("n_total"))
    return A.direct_share(auctions).join(linked, ["vat", "year"], "left").select("vat", "year", F.round(share, 1).alias("coverage"), F.coalesce(share < 20, F.lit(True)).alias("insufficient"))


@query(
    "jn08_28_known_or_warned",
    f"SELECT alias_id, {X.vat('a.vat')} IN (SELECT vat FROM entities) AS profiled FROM contractor_aliases a WHERE {X.vat('a.vat')} IS NOT NULL",
)
def jn08(spark, d):
    known = read_table(spark, d, "entities").select("vat", F.lit(True).alias("known")).distinct()
    rows = read_table(spark, d, "contractor_aliases").select("alias_id", S.normalize_vat(F.col("vat")).alias("vat")).filter("vat is not null")
    return rows.join(known, "vat", "left").select("alias_id", F.coalesce("known", F.lit(False)).alias("profiled"))


@query(
    "jn09_network_card",
    X.acts("auctions") + ", " + _EDGES + f""", {_NWR}, e2 AS (SELECT vat, contractor, row_number() OVER (PARTITION BY vat ORDER BY amount DESC, contractor) AS rn FROM edges),
    e3 AS (SELECT vat, array_to_string(list(contractor ORDER BY rn), ',') AS neighbours FROM e2 WHERE rn <= 30 GROUP BY 1), w AS (SELECT vat, count(*) AS n_years, round(100 * max(rate), 1) AS highest FROM nwr GROUP BY 1)
    SELECT coalesce(e3.vat, w.vat) AS vat, neighbours, n_years, highest FROM e3 FULL JOIN w ON e3.vat = w.vat""",
)
def jn09(spark, d):
    """An organisation's first thirty contractors and its rates of new winners; either may be missing."""
    top = R.QUERIES["gr04_top08_ego"](spark, d).groupBy("vat").agg(F.array_sort(F.collect_list(F.struct("rank", "contractor"))).alias("l"))
    near = top.select("vat", F.array_join(F.transform("l", lambda e: e["contractor"]), ",").alias("neighbours"))
    rates = R.QUERIES["gr03_win07_jn25_new_winners"](spark, d).groupBy("vat").agg(F.count(F.lit(1)).alias("n_years"), F.round(100 * F.max("rate"), 1).alias("highest"))
    return near.join(rates, "vat", "full_outer")


@query("jn12_membership", "SELECT row_id FROM auction WHERE " + X.vat('"organizationVatNumber"') + " IN (SELECT vat FROM entities WHERE org_type = 'ΟΤΑ Α ΒΑΘΜΟΥ')")
def jn12(spark, d):
    chosen = read_table(spark, d, "entities").filter("org_type = 'ΟΤΑ Α ΒΑΘΜΟΥ'").select("vat")
    return read_table(spark, d, "auction").select("row_id", S.normalize_vat(q("organizationVatNumber")).alias("vat")).join(chosen, "vat", "left_semi").select("row_id")


_LOCAL_SQL = R._kind_sql("n")


@query(
    "jn15_official_names_exact",
    f"""WITH e AS (SELECT DISTINCT {X.norm_name(X.plain("name"))} AS n FROM entities), c AS (SELECT DISTINCT {X.norm_name(X.plain('"organization.value"'))} AS n FROM contract WHERE "organization.value" IS NOT NULL),
    o AS (SELECT n FROM e WHERE {_LOCAL_SQL[0]} IS NOT NULL)
    SELECT n AS name, {_LOCAL_SQL[0]} AS kind, {_LOCAL_SQL[1]} AS reason, n IN (SELECT n FROM o) AS exact FROM c WHERE {_LOCAL_SQL[0]} IS NOT NULL OR {_LOCAL_SQL[1]} IS NOT NULL""",
)
def jn15_exact(spark, d):
    """Names that begin as a municipality or region, with the official name where one is equal."""
    names, official = _local_names(spark, d)
    known = official.select("name", F.lit(True).alias("known"))
    return names.join(known, "name", "left").select("name", "kind", "reason", F.coalesce("known", F.lit(False)).alias("exact"))


def _local_names(spark, d) -> tuple[DataFrame, DataFrame]:
    kind, reason = R.local_kind(F.col("name"))
    typed = read_table(spark, d, "contract").filter("`organization.value` is not null").select(S.normalize_greek(q("organization.value")).alias("name")).distinct()
    official = read_table(spark, d, "entities").select(S.normalize_greek(F.col("name")).alias("name")).distinct()
    return typed.select("name", kind.alias("kind"), reason.alias("reason")).filter("kind is not null or reason is not null"), official.filter(kind.isNotNull())


@query("jn15_er03_official_names")
def jn15(spark, d):
    """The same with the closest official name where none is equal: ``exact``, ``fuzzy``, ``missing``, or ``excluded``."""
    names, official = _local_names(spark, d)
    return L.match_official(names, official)


@query(
    "jn18_19_not_yet_sampled",
    """SELECT DISTINCT id_l, id_r FROM entity_resolution_matches m WHERE NOT EXISTS (SELECT 1 FROM entity_resolution_matches s WHERE s.id_l = m.id_l AND s.id_r = m.id_r AND s.jw_score >= 0.9)""",
)
def jn18(spark, d):
    m = read_table(spark, d, "entity_resolution_matches")
    return m.select("id_l", "id_r").distinct().join(m.filter("jw_score >= 0.9").select("id_l", "id_r"), ["id_l", "id_r"], "left_anti")


@query(
    "jn19_top_up",
    f"WITH {R._PAIRS_SQL}, c AS (SELECT id_l, id_r FROM s ORDER BY h, id_l, id_r LIMIT 100) SELECT id_l, id_r FROM s WHERE (id_l, id_r) NOT IN (SELECT (id_l, id_r) FROM c) ORDER BY h, id_l, id_r LIMIT 50",
)
def jn19(spark, d):
    """Fifty more pairs beside a sample of a hundred, by row id and never one twice."""
    pairs = R._scored_pairs(spark, d).filter("id_l is not null and id_r is not null")
    order = ["h", "id_l", "id_r"]
    sampled = pairs.orderBy(*order).limit(100).select("id_l", "id_r")
    return pairs.join(sampled, ["id_l", "id_r"], "left_anti").orderBy(*order).limit(50).select("id_l", "id_r")


@query(
    "jn21_audit_targets",
    """WITH months AS (SELECT y, m FROM range(2026, 2027) a(y), range(4, 7) b(m)), ent AS (SELECT unnest(['auction', 'contract', 'notice']) AS entity),
    extra AS (SELECT DISTINCT 'auction' AS entity, _source_year AS y, _source_month AS m FROM auction WHERE _source_year = 2020),
    u AS (SELECT entity, y, m FROM ent CROSS JOIN months UNION SELECT * FROM extra)
    SELECT entity, cast(y AS INT) AS year, cast(m AS INT) AS month FROM u WHERE NOT (entity = 'auction' AND ((y = 2020 AND m = 2) OR (y = 2026 AND m = 5)))""",
)
def jn21(spark, d):
    recent = spark.range(1).select(F.explode(F.array(*[F.lit(e) for e in ("auction", "contract", "notice")])).alias("entity")).select(
        "entity", F.lit(2026).alias("year"), F.explode(F.sequence(F.lit(4), F.lit(6))).alias("month")
    )
    failed = read_table(spark, d, "auction").filter("_source_year = 2020").select(F.lit("auction").alias("entity"), q("_source_year").alias("year"), q("_source_month").alias("month"))
    gaps = spark.createDataFrame([("auction", 2020, 2), ("auction", 2026, 5)], "entity string, year int, month int")
    return recent.unionByName(failed).distinct().join(F.broadcast(gaps), ["entity", "year", "month"], "left_anti")


@query(
    "jn24_award_path",
    X.acts("auctions") + " SELECT vat, member_vat AS contractor, cpv_key, count(*) AS n FROM auctions WHERE vat IS NOT NULL AND member_vat IS NOT NULL AND cpv_key IS NOT NULL GROUP BY 1, 2, 3",
)
def jn24(spark, d):
    rows = acts.auctions(spark, d).filter("vat is not null and member.vat is not null and cpv.key is not null")
    return rows.groupBy("vat", F.col("member.vat").alias("contractor"), F.col("cpv.key").alias("cpv_key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "jn14_cap_join",
    R._PANEL + """ , c AS (SELECT vat, round(quantile_cont(value_total, 0.99), 4) AS cap FROM panel GROUP BY 1) SELECT p.vat, p.month, p.value_total, c.cap FROM panel p JOIN c ON p.vat = c.vat""",
)
def jn14(spark, d):
    p = R.panel(spark, d).select("vat", "month", "value_total")
    return p.join(p.groupBy("vat").agg(F.round(F.percentile("value_total", F.lit(0.99)), 4).alias("cap")), "vat")


def audit_label() -> tuple[Column, Column]:
    """(label, reason) of a matched pair: a match only by an equal tax id, or an equal name where one is missing."""
    given = lambda c: F.coalesce(~F.trim(F.col(c)).isin("", "nan"), F.lit(False))
    left, right, same_name = given("vat_l"), given("vat_r"), F.coalesce(F.col("jw_score") >= 0.999, F.lit(False))
    reason = (
        F.when(left & right & (F.col("vat_l") == F.col("vat_r")), "same tax id").when((left != right) & same_name, "same name, one tax id missing")
        .when(left & right & same_name, "same name, different tax ids").when(~left & ~right & same_name, "same name, both tax ids missing").otherwise("different names")
    )
    return F.when(reason.isin("same tax id", "same name, one tax id missing"), "match").otherwise("uncertain"), reason


_GIVEN = "coalesce(trim({0}) NOT IN ('', 'nan'), false)"
_LABELS = f"""labels AS (SELECT *, CASE WHEN reason IN ('same tax id', 'same name, one tax id missing') THEN 'match' ELSE 'uncertain' END AS label FROM (SELECT id_l, id_r, vat_l, vat_r, jw_score,
    CASE WHEN l AND r AND vat_l = vat_r THEN 'same tax id' WHEN l <> r AND n THEN 'same name, one tax id missing' WHEN l AND r AND n THEN 'same name, different tax ids'
    WHEN NOT l AND NOT r AND n THEN 'same name, both tax ids missing' ELSE 'different names' END AS reason FROM (
    SELECT *, {_GIVEN.format("vat_l")} AS l, {_GIVEN.format("vat_r")} AS r, coalesce(jw_score >= 0.999, false) AS n FROM entity_resolution_matches)))"""


@query(
    "agg27_precision",
    f"""WITH {_LABELS} SELECT count(*) AS n, count(*) FILTER (label = 'match') AS n_match, count(*) FILTER (label = 'uncertain') AS n_uncertain,
    round(count(*) FILTER (label = 'match') * 1.0 / nullif(count(*) FILTER (label <> 'uncertain'), 0), 4) AS precision, round(count(*) FILTER (label = 'match') * 1.0 / count(*), 4) AS precision_conservative,
    count(*) FILTER (vat_l <> vat_r AND jw_score >= 0.999) AS n_ambiguous, count(*) FILTER (vat_l <> vat_r AND jw_score >= 0.999 AND label = 'match') AS n_violations FROM labels""",
)
def agg27(spark, d):
    label, _ = audit_label()
    rows = read_table(spark, d, "entity_resolution_matches").withColumn("label", label)
    n, match = F.count(F.lit(1)), F.count_if(F.col("label") == "match")
    ambiguous = (F.col("vat_l") != F.col("vat_r")) & (F.col("jw_score") >= 0.999)
    return rows.agg(
        n.alias("n"), match.alias("n_match"), F.count_if(F.col("label") == "uncertain").alias("n_uncertain"),
        F.round(F.try_divide(match, F.count_if(F.col("label") != "uncertain")), 4).alias("precision"), F.round(F.try_divide(match, n), 4).alias("precision_conservative"),
        F.count_if(ambiguous).alias("n_ambiguous"), F.count_if(ambiguous & (F.col("label") == "match")).alias("n_violations"),
    )


@query(
    "agg32_period",
    X.acts("auctions") + f" SELECT vat, cast(sum(n) AS BIGINT) AS n_total, round(sum(v), 2) AS value_total, cast(sum(c) AS BIGINT) AS contractors FROM (SELECT vat, year, count(*) AS n, {VALUE} AS v, count(DISTINCT member_vat) AS c FROM auctions WHERE vat IS NOT NULL AND year BETWEEN 2021 AND 2023 GROUP BY 1, 2) GROUP BY 1",
)
def agg32(spark, d):
    rows = R.QUERIES["agg15_overview"](spark, d).filter(F.col("year").between(2021, 2023))
    return rows.groupBy("vat").agg(F.sum("n_total").alias("n_total"), F.round(F.sum("value_total"), 2).alias("value_total"), F.sum("n_contractors").alias("contractors"))


@query(
    "top04_contractor_orgs",
    X.acts("auctions") + ", " + _EDGES + """ SELECT * FROM (SELECT contractor, vat, amount, cast(row_number() OVER (PARTITION BY contractor ORDER BY amount DESC, vat) AS INT) AS rank FROM edges) WHERE rank <= 10""",
)
def top04(spark, d):
    return W.top_k(R.edges(acts.auctions(spark, d)).select("contractor", "vat", "amount"), ["contractor"], [F.desc("amount"), F.col("vat")], 10)


@query(
    "top04_contractor_recent",
    X.acts("auctions") + f""" SELECT contractor, row_id, day, rank FROM (SELECT contractor, row_id, day, cast(row_number() OVER (PARTITION BY contractor ORDER BY day DESC, row_id DESC) AS INT) AS rank FROM (
    SELECT {X.vat("member_vat")} AS contractor, row_id, try_cast(try_cast(submitted AS TIMESTAMP) AS DATE) AS day FROM auctions) WHERE contractor IS NOT NULL AND day IS NOT NULL) WHERE rank <= 50""",
)
def top04_recent(spark, d):
    rows = acts.auctions(spark, d).select(S.normalize_vat(F.col("member.vat")).alias("contractor"), "row_id", S.to_day(F.col("submitted")).alias("day"))
    return W.top_k(rows.filter("contractor is not null and day is not null"), ["contractor"], [F.desc("day"), F.desc("row_id")], 50)


@query(
    "top09_group_table",
    X.acts("auctions") + _DA_CTE + """, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vat ORDER BY year DESC) AS rn FROM da WHERE n_total >= 5) WHERE rn = 1)
    SELECT e.org_id, e.vat, l.da_value_pct FROM entities e LEFT JOIN l USING (vat) WHERE e.org_type = 'ΟΤΑ Α ΒΑΘΜΟΥ' AND contains(upper(e.name), 'ΔΗΜΟΣ') ORDER BY l.da_value_pct DESC NULLS LAST, e.org_id LIMIT 500""",
)
def top09_table(spark, d):
    """The table of organisations: one group, a search, sorted with nulls last, the first 500."""
    latest = A.direct_share(acts.auctions(spark, d)).filter("n_total >= 5").groupBy("vat").agg(F.max_by("da_value_pct", "year").alias("da_value_pct"))
    rows = read_table(spark, d, "entities").filter("org_type = 'ΟΤΑ Α ΒΑΘΜΟΥ'").filter(F.upper("name").contains("ΔΗΜΟΣ")).select("org_id", "vat")
    return rows.join(latest, "vat", "left").orderBy(F.desc_nulls_last("da_value_pct"), "org_id").limit(500).select("org_id", "vat", "da_value_pct")


@query(
    "top10_table_view",
    X.acts("auctions") + f""", t AS (SELECT {X.vat('member_vat')} AS contractor, count(*) AS n, min(member_name) AS name FROM auctions WHERE {X.vat('member_vat')} IS NOT NULL GROUP BY 1)
    SELECT contractor, n FROM t WHERE contains(upper(name), 'ΜΕΤΑΦΟΡΕΣ') ORDER BY n DESC, contractor LIMIT 500""",
)
def top10(spark, d):
    t = acts.auctions(spark, d).groupBy(S.normalize_vat(F.col("member.vat")).alias("contractor")).agg(F.count(F.lit(1)).alias("n"), F.min("member.name").alias("name"))
    return t.filter("contractor is not null").filter(F.upper("name").contains("ΜΕΤΑΦΟΡΕΣ")).orderBy(F.desc("n"), "contractor").limit(500).select("contractor", "n")


@query(
    "top13_invalid_vats",
    f"SELECT vat, count(*) AS n FROM contractor_aliases WHERE vat IS NOT NULL AND NOT {X.checksum('vat')} GROUP BY 1 ORDER BY n DESC, vat LIMIT 15",
)
def top13(spark, d):
    rows = read_table(spark, d, "contractor_aliases").filter(F.col("vat").isNotNull() & ~S.vat_checksum(F.col("vat")))
    return rows.groupBy("vat").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "vat").limit(15)


DISTRIBUTED = ("da_count_pct", "hhi", "single_bid_pct", "median_discount_pct", "median_deadline_days", "score")


def _distribution_sql() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS indicator, org_type, year, {c}::DOUBLE AS v FROM sides WHERE org_type IS NOT NULL AND {c} IS NOT NULL" for c in DISTRIBUTED)
    return (
        _MERGED
        + f""", reg AS (SELECT vat, min(org_type) AS org_type FROM entities GROUP BY 1), sides AS (SELECT da.year, org_type, da.da_count_pct, hhi.hhi, sb.single_bid_pct, dr.median_discount_pct, dl.median_deadline_days, comp.score FROM da
    LEFT JOIN hhi USING (vat, year) LEFT JOIN dr USING (vat, year) LEFT JOIN sb USING (vat, year) LEFT JOIN dl USING (vat, year) LEFT JOIN comp USING (vat, year) LEFT JOIN reg ON reg.vat = da.vat), v AS ({long}),
    r AS (SELECT indicator, org_type, year, min(v) AS lo, CASE WHEN max(v) = min(v) THEN min(v) + 1 ELSE max(v) END AS hi, count(*) AS n FROM v GROUP BY 1, 2, 3),
    c AS (SELECT v.indicator, v.org_type, v.year, cast(least(floor((v - lo) / (hi - lo) * 12), 11) AS INT) AS bin, count(*) AS cnt FROM v JOIN r ON v.indicator = r.indicator AND v.org_type = r.org_type AND v.year = r.year GROUP BY 1, 2, 3, 4)
    SELECT r.indicator, r.org_type, r.year, lo, hi, n, cast(b AS INT) AS bin, coalesce(cnt, 0) AS count FROM r CROSS JOIN range(12) g(b) LEFT JOIN c ON c.indicator = r.indicator AND c.org_type = r.org_type AND c.year = r.year AND c.bin = b"""
    )


@query(
    "win05_distributions",
    _distribution_sql(),
)
def win05(spark, d):
    """Twelve-bin distributions of the six indicators by organisation type and year."""
    m = merged_indicators(spark, d).filter("org_type is not null").select("org_type", "year", *[F.col(c).cast("double").alias(c) for c in DISTRIBUTED])
    return W.histogram(m.unpivot(["org_type", "year"], list(DISTRIBUTED), "indicator", "v"), "v", ["indicator", "org_type", "year"])


_SCALED = ", da AS (" + _DA.replace(" JOIN (", " LEFT JOIN (") + ")"


@query(
    "win13_scaled_years",
    X.acts("auctions") + _SCALED + """ SELECT vat, year, round((da_count_pct - min(da_count_pct) OVER w) / coalesce(nullif(max(da_count_pct) OVER w - min(da_count_pct) OVER w, 0), 1), 4) AS height,
    round(value_total / greatest(max(value_total) OVER w, 1), 4) AS bar, round(value_direct / greatest(max(value_total) OVER w, 1), 4) AS bar_direct FROM da WINDOW w AS (PARTITION BY vat)""",
)
def win13(spark, d):
    """Heights of an organisation's years for a line (least to largest) and for stacked bars (of the largest total)."""
    rows = A.direct_share(acts.auctions(spark, d)).select("vat", "year", "da_count_pct", "value_total", "value_direct")
    ends = rows.groupBy("vat").agg(F.min("da_count_pct").alias("lo"), F.max("da_count_pct").alias("hi"), F.greatest(F.max("value_total"), F.lit(1.0)).alias("top"))
    span = F.coalesce(F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)), F.lit(1.0))
    return rows.join(ends, "vat").select(
        "vat", "year", F.round((F.col("da_count_pct") - F.col("lo")) / span, 4).alias("height"), F.round(F.col("value_total") / F.col("top"), 4).alias("bar"), F.round(F.col("value_direct") / F.col("top"), 4).alias("bar_direct")
    )


# ---------------------------------------------------------------- record linkage


@query(
    "er02_jaro_winkler",
    # over tax ids, as DuckDB's function counts the bytes of a text and not its letters
    """SELECT DISTINCT vat_l, vat_r, round(jaro_winkler_similarity(vat_l, vat_r), 6) AS jw FROM entity_resolution_matches WHERE vat_l IS NOT NULL AND vat_r IS NOT NULL""",
)
def er02(spark, d):
    pairs = read_table(spark, d, "entity_resolution_matches").select("vat_l", "vat_r").filter("vat_l is not null and vat_r is not null").distinct()
    return L.score_pairs(pairs, "vat_l", "vat_r").withColumn("jw", F.round("jw", 6))


@query("er02_names")
def er02_names(spark, d):
    pairs = read_table(spark, d, "entity_resolution_matches").select("name_l", "name_r").distinct()
    return L.score_pairs(pairs, "name_l", "name_r")


@query("er01_dedupe")
def er01_dedupe(spark, d):
    """Contractor records that match, from candidates by tax id or by the first four words of the name."""
    norm = S.normalize_name(F.col("canonical_name"))
    records = read_table(spark, d, "contractor_aliases").select(F.col("alias_id").alias("id"), "vat", norm.alias("norm"), S.name_prefix(norm).alias("prefix"))
    return L.dedupe_probabilities(records, "id", "norm", "vat", "prefix", threshold=0.0)


@query("er01_probabilities")
def er01(spark, d):
    """Match probabilities; u comes from the same pairs with one side shifted to another pair's."""
    m = read_table(spark, d, "entity_resolution_matches").select("id_l", "id_r", "name_l", "name_r").distinct()
    scored = L.score_pairs(m, "name_l", "name_r")
    order = Window.partitionBy(F.pmod(F.xxhash64("id_l"), F.lit(64))).orderBy("id_l", "id_r")
    unrelated = L.score_pairs(m.withColumn("other", F.lead("name_r", 7).over(order)).select("name_l", F.col("other").alias("name_r")).filter("name_r is not null").distinct(), "name_l", "name_r")
    return L.link_probability(scored, "jw", unrelated).select("id_l", "id_r", "jw", "level", "probability")


@query("er04_05_fn29_labels", f"WITH {_LABELS} SELECT id_l, id_r, label, reason FROM labels")
def er04(spark, d):
    label, reason = audit_label()
    return read_table(spark, d, "entity_resolution_matches").select("id_l", "id_r", label.alias("label"), reason.alias("reason"))


# ---------------------------------------------------------------- graph


def _award_graph(spark, d) -> DataFrame:
    e = R.edges(acts.auctions(spark, d).filter("not cancelled")).filter("amount > 0")
    return G.undirected(e.select(F.concat(F.lit("o"), "vat").alias("src"), F.concat(F.lit("c"), "contractor").alias("dst"), F.col("amount").alias("w")))


_GRAPH_SQL = X.acts("auctions") + ", " + _EDGES.replace("WHERE vat", "WHERE NOT cancelled AND vat") + """, g AS (SELECT 'o' || vat AS src, 'c' || contractor AS dst, amount AS w FROM edges WHERE amount > 0 UNION ALL SELECT 'c' || contractor, 'o' || vat, amount FROM edges WHERE amount > 0)"""


def _rank_sql(n: int) -> str:
    steps = ["sh AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS share FROM g), r0 AS (SELECT DISTINCT src AS v, 1.0::DOUBLE AS rank FROM g)"]
    for i in range(n):
        steps.append(f"r{i + 1} AS MATERIALIZED (SELECT dst AS v, 0.15 + 0.85 * sum(rank * share) AS rank FROM sh JOIN r{i} ON src = v GROUP BY 1)")
    return f"{_GRAPH_SQL}, {', '.join(steps)} SELECT v, round(rank, 6) AS rank FROM r{n}"


@query("gr06_08_page_rank", _rank_sql(20))
def gr08(spark, d):
    return G.page_rank(_award_graph(spark, d)).select("v", F.round("rank", 6).alias("rank"))


@query(
    "gr10_jn27_overlap",
    _rank_sql(20).rsplit(" SELECT v, round(rank, 6)", 1)[0] + """, t AS (SELECT v FROM r20 WHERE starts_with(v, 'o') ORDER BY rank DESC, v LIMIT 10), u AS (SELECT src AS v FROM g WHERE starts_with(src, 'o') GROUP BY 1 ORDER BY sum(w) DESC, 1 LIMIT 10)
    SELECT count(*) AS n_common FROM t JOIN u USING (v)""",
)
def gr10(spark, d):
    """How many of the ten highest ranked organisations are among the ten with most value."""
    ranks = G.page_rank(_award_graph(spark, d)).filter(F.col("v").startswith("o")).orderBy(F.desc("rank"), "v").limit(10).select("v")
    volume = _award_graph(spark, d).filter(F.col("src").startswith("o")).groupBy(F.col("src").alias("v")).agg(F.sum("w").alias("w")).orderBy(F.desc("w"), "v").limit(10)
    return ranks.join(volume, "v", "left_semi").agg(F.count(F.lit(1)).alias("n_common"))


@query("gr07_communities")
def gr07(spark, d):
    return G.communities(_award_graph(spark, d))


@query("gr09_betweenness")
def gr09(spark, d):
    """Exact betweenness of every vertex of the award graph."""
    return G.all_betweenness(_award_graph(spark, d))


@query(
    "gr12_load_checks",
    X.acts("auctions") + """, v AS (SELECT count(DISTINCT vat) AS n_org, count(ref) AS n_award, count(DISTINCT CASE WHEN ref IS NOT NULL AND year(try_cast(signed AS TIMESTAMP)) BETWEEN 1900 AND 9999 THEN year(try_cast(signed AS TIMESTAMP)) END) AS n_years FROM auctions)
    SELECT 1 AS check_no, 'counts' AS name, cast(3 AS BIGINT) AS n_checked, cast(0 AS BIGINT) AS n_off UNION ALL SELECT 2, 'amounts by year', n_years, 0 FROM v UNION ALL SELECT 3, 'organisations', least(n_org, 20), 0 FROM v
    UNION ALL SELECT 4, 'awards', least(n_award, 20), 0 FROM v UNION ALL SELECT 5, 'valid tax ids', 1, 0 UNION ALL SELECT 6, 'one organisation', 1, 0""",
)
def gr12(spark, d):
    """The graph written to bulk-import files, read back, and compared with what was staged."""
    auctions = acts.auctions(spark, d)
    path = f"{checkpoint_dir(spark)}/graph-{uuid.uuid4().hex}"
    graphfiles.write_graph(auctions, path)
    staged = graphfiles.vertices(auctions) | {"issued": graphfiles.edges(auctions)["issued"]}
    loaded = {k: graphfiles.read_vertices(spark, path, k) for k in ("organization", "contractor", "award")}
    loaded["issued"] = spark.read.schema("a string, b string").option("header", True).option("enforceSchema", True).csv(f"{path}/rel_issued")
    hub = staged["issued"].groupBy("a").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "a").first()  # the organisation with most awards
    return graphfiles.load_checks(spark, staged, loaded, hub.a if hub else "", 2020)


@query(
    "gr06_projection_by_year",
    X.acts("auctions") + """, e AS (SELECT year, 'o' || vat AS o, 'c' || member_vat AS c, round(coalesce(sum(value), 0), 2) AS w FROM auctions WHERE vat IS NOT NULL AND member_vat IS NOT NULL AND NOT cancelled GROUP BY 1, 2, 3)
    SELECT year, o AS src, c AS dst, w FROM e UNION ALL SELECT year, c, o, w FROM e""",
)
def gr06(spark, d):
    """Each year's undirected graph of awards that were not cancelled, by amount."""
    rows = acts.auctions(spark, d).filter("vat is not null and member.vat is not null and not cancelled")
    e = rows.groupBy("year", F.concat(F.lit("o"), "vat").alias("src"), F.concat(F.lit("c"), "member.vat").alias("dst")).agg(F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("w"))
    return e.unionByName(e.select("year", F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


# ---------------------------------------------------------------- sinks


@query(
    "snk03_05_keyed_json",
    "SELECT cast(org_id AS VARCHAR) AS key, cast(to_json(struct_pack(org_id := org_id, vat := vat, n_records := n_records)) AS VARCHAR) AS json FROM entities",
)
def snk05(spark, d):
    return keyed_json(read_table(spark, d, "entities").select("org_id", "vat", "n_records"), "org_id").withColumn("key", F.col("key").cast("string"))


# ---------------------------------------------------------------- stream


@query(
    "stream_windowed_counts",
    "SELECT cast(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
)
def stream_counts(spark, d):
    """The event table as a stream, run until nothing is left; the sink is a table in the shared folder.

    In update mode a window may be written again when more of its events come, so the last version of
    each counts; what the watermark has passed leaves the state.
    """
    schema = read_table(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    target = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = (
        windowed_counts(events).writeStream.outputMode("update")
        .foreachBatch(lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{target}/out/batch_{n}"))
        .option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    last = spark.read.parquet(f"{target}/out/*").groupBy("window_start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("x"))
    return last.select(F.to_date("window_start").alias("day"), "event_type", "x.n", F.round("x.total", 4).alias("total"))
