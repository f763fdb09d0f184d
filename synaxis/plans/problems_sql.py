"""DuckDB texts of the general operators' queries that SQL can express on whole tables."""

from __future__ import annotations

from synaxis.plans import sqltext as X

_VAT = X.vat('"organizationVatNumber"')

P5 = f"""WITH t AS (SELECT {_VAT} AS vat FROM auction)
    SELECT vat FROM t WHERE vat IS NOT NULL GROUP BY 1 HAVING count(*) * 100 >= 2 * (SELECT count(*) FROM auction)"""

P5_PROFILE = f"""WITH t AS (SELECT {_VAT} AS vat, row_id, "totalCostWithVAT" AS v FROM auction),
    l AS (SELECT *, v > lag(v IGNORE NULLS) OVER (PARTITION BY vat ORDER BY row_id) AS up FROM t WHERE vat IS NOT NULL)
    SELECT vat, count(*) AS n, count(v) AS n_values, max(v) AS high, min(v) AS low, arg_min(v, row_id) FILTER (v IS NOT NULL) AS first_v, arg_max(v, row_id) FILTER (v IS NOT NULL) AS last_v,
    coalesce(count(*) FILTER (up), 0) AS n_up, (SELECT count(*) FROM auction) AS n_all FROM l GROUP BY 1"""


def _json(t: str) -> str:
    return f"(CASE WHEN json_valid({t}) AND NOT regexp_full_match(lower(trim({t})), '-?(nan|inf|infinity)') THEN {t} END)"


def _unwrapped(j: str) -> str:
    """A JSON value, or the one inside a JSON string."""
    inner = f"json_extract_string({j}, '$')"
    return f"(CASE WHEN json_type({j}) = 'VARCHAR' THEN {_json(inner)} ELSE cast({j} AS VARCHAR) END)"


def _listed(j: str) -> str:
    return f"(CASE json_type({j}) WHEN 'ARRAY' THEN json_extract({j}, '$[*]') WHEN 'OBJECT' THEN [cast({j} AS JSON)] ELSE [] END)"


P6 = f"""WITH o AS (SELECT row_id, {_json('"objectDetailsList"')} AS j FROM auction), o1 AS (SELECT row_id, {_unwrapped("j")} AS j FROM o WHERE j IS NOT NULL),
    o2 AS (SELECT row_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT row_id, {_listed("j")} AS l FROM o1 WHERE j IS NOT NULL)),
    o3 AS (SELECT row_id, pos, {_unwrapped("e")} AS e FROM o2), obj AS (SELECT * FROM o3 WHERE json_type(e) = 'OBJECT'),
    c1 AS (SELECT row_id, pos, {_unwrapped("c")} AS j FROM (SELECT row_id, pos, json_extract(e, '$.cpvs') AS c FROM obj) WHERE c IS NOT NULL),
    c2 AS (SELECT row_id, pos, unnest(l) AS e, unnest(range(len(l))) AS sub_pos FROM (SELECT row_id, pos, {_listed("j")} AS l FROM c1 WHERE j IS NOT NULL)),
    c3 AS (SELECT row_id, pos, sub_pos, {_unwrapped("e")} AS e FROM c2),
    m AS (SELECT row_id, {_json('"contractingDataDetails.contractingMembersDataList"')} AS j FROM auction), m1 AS (SELECT row_id, {_unwrapped("j")} AS j FROM m WHERE j IS NOT NULL),
    m2 AS (SELECT row_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT row_id, {_listed("j")} AS l FROM m1 WHERE j IS NOT NULL)),
    m3 AS (SELECT row_id, pos, {_unwrapped("e")} AS e FROM m2)
    SELECT row_id, 'object' AS child, cast(pos AS INT) AS pos, -1 AS sub_pos FROM obj
    UNION ALL SELECT row_id, 'cpv', cast(pos AS INT), cast(sub_pos AS INT) FROM c3 WHERE json_type(e) = 'OBJECT'
    UNION ALL SELECT row_id, 'member', cast(pos AS INT), -1 FROM m3 WHERE json_type(e) = 'OBJECT'"""


def _p4(act: str, column: str, bad: str, run: int) -> str:
    return f"""SELECT '{act}' AS act, row_id, string_agg(reason, ',' ORDER BY reason) AS reasons FROM (
    WITH t AS (SELECT row_id, {_VAT} AS vat, "{column}" AS v FROM {act} WHERE "{column}" IS NOT NULL),
    r AS (SELECT * FROM t WHERE vat IN (SELECT vat FROM entities)),
    ok AS (SELECT * FROM r WHERE NOT ({bad})),
    d AS (SELECT vat, v, lag(v) OVER (PARTITION BY vat ORDER BY v) AS below, sum(n) OVER (PARTITION BY vat) AS n_all, sum(n) OVER (PARTITION BY vat ORDER BY v DESC) AS n_above
    FROM (SELECT vat, v, count(*) AS n FROM ok GROUP BY 1, 2)),
    gaps AS (SELECT vat, v, ln(v) - ln(below) AS gap FROM d WHERE n_all >= 20 AND v >= 2 * below AND n_above <= greatest(1, n_all * 0.1)),
    grid AS (SELECT ln(3) + (ln(8) - ln(3)) * i / 40 AS a FROM range(41) s(i)),
    th AS (SELECT coalesce(arg_min(a, density), ln(3)) AS t FROM (SELECT a, sum(exp(-((gap - a) / 0.15) * ((gap - a) / 0.15) / 2)) AS density FROM gaps, grid GROUP BY 1)),
    f AS (SELECT vat, min(v) AS floor_v FROM gaps, th WHERE gap >= t GROUP BY 1),
    g AS (SELECT *, row_number() OVER (PARTITION BY vat ORDER BY row_id) - row_number() OVER (PARTITION BY vat, v ORDER BY row_id) AS island FROM r)
    SELECT row_id, 'impossible' AS reason FROM r WHERE {bad} UNION SELECT ok.row_id, 'spike' FROM ok JOIN f ON ok.vat = f.vat AND ok.v >= f.floor_v
    UNION SELECT row_id, 'stuck' FROM (SELECT row_id, count(*) OVER (PARTITION BY vat, v, island) AS n FROM g) WHERE n >= {run}) GROUP BY row_id"""


P4_REASONS = _p4("auction", "totalCostWithVAT", "v <= 0 OR v > 1e10", 8) + " UNION ALL " + _p4("contract", "bidsSubmitted", "v < 1 OR v <> floor(v) OR v >= 300000", 12)

# ---- changes of fields between files

P1 = """WITH ok AS (SELECT file_name AS file, line_no, payload FROM contract_raw WHERE file_name IS NOT NULL AND json_valid(payload) AND json_type(payload) = 'OBJECT'),
    tree AS (SELECT file, line_no, replace(substr(t.fullkey, 3), '"', '') AS path, t.type AS kind, t.value AS v, length(t.fullkey) AS depth FROM ok, json_tree(ok.payload) t WHERE t.fullkey NOT LIKE '%[%' AND t.type NOT IN ('OBJECT', 'NULL')),
    leaf AS (SELECT file, line_no, path, arg_min(CASE WHEN kind = 'VARCHAR' THEN 'string' WHEN kind = 'ARRAY' THEN 'list' WHEN kind = 'BOOLEAN' THEN 'boolean' ELSE 'number' END, depth) AS type, arg_min(v, depth) AS v FROM tree GROUP BY 1, 2, 3),
    same AS (SELECT file, line_no, path, type, CASE WHEN type = 'string' THEN trim(v->>'$') ELSE cast(v AS VARCHAR) END AS s FROM leaf),
    val AS (SELECT file, line_no, path, type, CASE WHEN type <> 'list' AND length(s) <= 15 AND regexp_full_match(s, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN cast(cast(s AS DOUBLE) AS VARCHAR)
    WHEN lower(s) IN ('true', 'false') THEN lower(s) WHEN type = 'string' AND s[1:1] IN ('[', '{') AND json_valid(s) THEN cast(json(s) AS VARCHAR) ELSE s END AS same FROM same),
    act AS (SELECT file, line_no, any_value(same) AS act FROM (SELECT file, line_no, CASE WHEN type = 'string' THEN v->>'$' ELSE cast(v AS VARCHAR) END AS same FROM leaf WHERE path = 'referenceNumber') GROUP BY 1, 2),
    files AS (SELECT file, regexp_extract(file, '^(.*)/[^/]*$', 1) AS feed, row_number() OVER (PARTITION BY regexp_extract(file, '^(.*)/[^/]*$', 1) ORDER BY file) AS idx FROM (SELECT DISTINCT file_name AS file FROM contract_raw WHERE file_name IS NOT NULL)),
    main AS (SELECT file, path, arg_max(type, (n, type)) AS type FROM (SELECT file, path, type, count(*) AS n FROM val GROUP BY 1, 2, 3) GROUP BY 1, 2),
    st AS (SELECT feed, idx, path, type FROM main JOIN files USING (file)),
    d AS (SELECT f.feed, f.idx, f.file, x.path, CASE WHEN x.old IS NULL THEN 'added' WHEN x.new IS NULL THEN 'removed' WHEN x.old <> x.new THEN 'type_changed' END AS kind FROM (
    SELECT feed, idx, path, max(new) AS new, max(old) AS old FROM (SELECT feed, idx, path, type AS new, NULL AS old FROM st UNION ALL SELECT feed, idx + 1, path, NULL, type FROM st) GROUP BY 1, 2, 3) x JOIN files f USING (feed, idx) WHERE f.idx > 1),
    a AS (SELECT f.feed, f.idx, act, path, same FROM val JOIN act USING (file, line_no) JOIN files f USING (file)),
    nv AS (SELECT DISTINCT a.feed, a.idx, act, a.path, same FROM a JOIN d ON d.feed = a.feed AND d.idx = a.idx AND d.path = a.path AND d.kind = 'added'),
    ov AS (SELECT DISTINCT a.feed, a.idx + 1 AS idx, act, a.path, same FROM a JOIN d ON d.feed = a.feed AND d.idx = a.idx + 1 AND d.path = a.path AND d.kind = 'removed'),
    by_act AS (SELECT nv.feed, nv.idx, nv.path AS new_path, ov.path AS old_path, nv.act, bool_or(nv.same = ov.same) AS same FROM nv JOIN ov ON nv.feed = ov.feed AND nv.idx = ov.idx AND nv.act = ov.act GROUP BY 1, 2, 3, 4, 5),
    proved AS (SELECT feed, idx, new_path, old_path, count(*) AS n FROM by_act GROUP BY 1, 2, 3, 4 HAVING bool_and(same)),
    one AS (SELECT * FROM proved QUALIFY row_number() OVER (PARTITION BY feed, idx, new_path ORDER BY n DESC, old_path) = 1),
    ren AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY feed, idx, old_path ORDER BY n DESC, new_path) = 1)
    SELECT d.file AS file_name, d.path AS field_path, CASE WHEN r.new_path IS NOT NULL THEN 'renamed' ELSE d.kind END AS change_kind, coalesce(r.old_path, '') AS old_path FROM d
    LEFT JOIN ren r ON r.feed = d.feed AND r.idx = d.idx AND r.new_path = d.path AND d.kind = 'added' LEFT JOIN ren g ON g.feed = d.feed AND g.idx = d.idx AND g.old_path = d.path AND d.kind = 'removed'
    WHERE d.kind IS NOT NULL AND g.old_path IS NULL"""

# ---- the profile of three columns of the awards

_AMOUNT = '"totalCostWithoutVAT"'
_VATS = '"organizationVatNumber"'
_LIST = '"objectDetailsList"'


def _form(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, '[0-9]+', '9', 'g'), '\\p{{L}}+', 'a', 'g')"


_GOOD_AMOUNT = f"coalesce(regexp_full_match({_AMOUNT}, '[0-9]+(\\.[0-9]{{1,2}})?') AND try_cast({_AMOUNT} AS DECIMAL(38,2)) > 0 AND try_cast({_AMOUNT} AS DECIMAL(38,2)) <= 10000000000, false)"
_GOOD_VAT = f"(regexp_full_match({_VATS}, '[0-9]{{9}}') AND {_VATS} NOT IN ('000000000','999999999','111111111','001111111') AND {X.checksum(_VATS)})"
_BAD_KEY = "NOT coalesce(json_type(c) = 'OBJECT' AND json_type(json_extract(c, '$.key')) = 'VARCHAR' AND regexp_full_match(json_extract_string(c, '$.key'), '[0-9]{8}-[0-9]'), false)"
_ITEM_KIND = f"""CASE WHEN json_type(e) <> 'OBJECT' THEN 'element no object' WHEN coalesce(json_type(json_extract(e, '$.cpvs')), 'NULL') <> 'ARRAY' OR json_array_length(e, '$.cpvs') = 0 THEN 'cpvs no filled array'
    WHEN len(list_filter(json_extract(e, '$.cpvs[*]'), lambda c: {_BAD_KEY})) > 0 THEN 'bad key' END"""
_KIND = f"""CASE WHEN {_LIST} IS NULL THEN NULL WHEN {_json(_LIST)} IS NULL THEN 'not JSON' WHEN json_type({_json(_LIST)}) <> 'ARRAY' THEN 'no array' WHEN json_array_length({_json(_LIST)}) = 0 THEN 'empty'
    ELSE coalesce(list_filter(list_transform(json_extract({_json(_LIST)}, '$[*]'), lambda e: {_ITEM_KIND}), lambda k: k IS NOT NULL)[1], 'well formed') END"""
_CELLS = f"""k AS (SELECT *, {_KIND} AS kind FROM auction), cells AS (
    SELECT row_id, 'totalCostWithoutVAT' AS column_name, {_AMOUNT} AS t, {_form(_AMOUNT)} AS form, {_AMOUNT} IS NOT NULL AND NOT {_GOOD_AMOUNT} AS violates, {X.num(_AMOUNT)} AS v FROM k
    UNION ALL SELECT row_id, 'organizationVatNumber', {_VATS}, {_form(_VATS)}, {_VATS} IS NOT NULL AND NOT {_GOOD_VAT}, NULL FROM k
    UNION ALL SELECT row_id, 'objectDetailsList', {_LIST}, kind, {_LIST} IS NOT NULL AND kind <> 'well formed', NULL FROM k)"""

P2_VIOLATIONS = f"WITH {_CELLS} SELECT column_name, row_id, CASE WHEN column_name = 'objectDetailsList' THEN form END AS kind FROM cells WHERE violates"

P2_PROFILE = f"""WITH {_CELLS}, m AS (SELECT *, CASE WHEN v > 0 THEN cast(round(log10(v) * 10000) AS HUGEINT) END AS m FROM cells),
    a AS (SELECT column_name, count(*) AS n, count(*) FILTER (t IS NULL) AS n_null, count(*) FILTER (violates) AS n_violations, count(DISTINCT t) AS n_distinct, count(DISTINCT form) AS n_forms, min(v) AS value_min, max(v) AS value_max,
    cast(min(length(t)) AS INT) AS length_min, cast(max(length(t)) AS INT) AS length_max, count(m) AS k, sum(m) / 1e4 AS s1, sum(m * m) / 1e8 AS s2, sum(m * m * m) / 1e12 AS s3, sum(m * m * m * m) / 1e16 AS s4 FROM m GROUP BY 1),
    b AS (SELECT *, s1 / k AS u, s2 / k AS r2, s3 / k AS r3, s4 / k AS r4 FROM a), c AS (SELECT *, greatest(r2 - u * u, 0) AS var FROM b)
    SELECT column_name, n, n_null, n_violations, n_distinct, n_forms, value_min, value_max, length_min, length_max, CASE WHEN k > 0 THEN round(u, 4) END AS log_mean, CASE WHEN k > 0 THEN round(sqrt(var), 4) END AS log_sd,
    CASE WHEN var > 1e-9 THEN round((r3 - 3 * u * r2 + 2 * u * u * u) / pow(var, 1.5), 3) END AS log_skewness, CASE WHEN var > 1e-9 THEN round((r4 - 4 * u * r3 + 6 * u * u * r2 - 3 * u * u * u * u) / (var * var), 3) END AS log_kurtosis FROM c"""


def _arc(x: str) -> str:
    return f"(2 * asin(sqrt(least(greatest({x}, 0.0), 1.0))))"


def _share_shift(n: str, of: str, n_all: str, of_all: str) -> str:
    return f"({_arc(f'{n}::DOUBLE / nullif({of}, 0)')} - {_arc(f'({n_all} - {n})::DOUBLE / nullif({of_all} - {of}, 0)')})"


def _mean_shift(k: str, a: str, b: str) -> str:
    others = [f"(sum({x}) OVER w - {x})::DOUBLE" for x in (k, a, b)]
    mean = f"({others[1]} / nullif({others[0]}, 0))"
    return f"({a}::DOUBLE / nullif({k}, 0) - {mean}) / sqrt(greatest({others[2]} / nullif({others[0]}, 0) - {mean} * {mean}, 1e-4))"


def _shares(what: str, aspect: str) -> str:
    t = aspect.replace(" ", "_")
    return f"""{t}_c AS (SELECT column_name, load_id, {what} AS x, count(*) AS n FROM lc WHERE {what} IS NOT NULL AND load_id IS NOT NULL GROUP BY 1, 2, 3),
    {t}_t AS (SELECT column_name, x, sum(n) AS n_what FROM {t}_c GROUP BY 1, 2),
    {t}_f AS (SELECT t.column_name, t.x FROM {t}_t t JOIN least_n USING (column_name) WHERE n_what >= 0.02 * n_least),
    {t}_z AS (SELECT f.column_name, s.load_id, f.x, 0 AS n FROM {t}_f f JOIN sz s ON s.column_name = f.column_name WHERE NOT EXISTS (SELECT 1 FROM {t}_c c WHERE c.column_name = f.column_name AND c.load_id = s.load_id AND c.x = f.x)),
    {t}_s AS (SELECT a.column_name, a.load_id, n_load, {_share_shift("a.n", "n_load", "n_what", "n_all")} AS shift FROM (SELECT * FROM {t}_c UNION ALL SELECT * FROM {t}_z) a JOIN {t}_t USING (column_name, x) JOIN sz USING (column_name, load_id)),
    {t} AS (SELECT column_name, load_id, max(n_load) AS n, '{aspect}' AS aspect, max(shift) AS shift FROM {t}_s GROUP BY 1, 2 UNION ALL SELECT column_name, load_id, max(n_load), '{aspect} fallen', min(shift) FROM {t}_s GROUP BY 1, 2)"""


P2 = f"""WITH {_CELLS}, lc AS (SELECT c.*, a.load_id, CASE WHEN v > 0 THEN cast(round(log10(v) * 10000) AS HUGEINT) END AS m, cast(round(ln(1 + length(t)) * 10000) AS HUGEINT) AS s FROM cells c JOIN auction a USING (row_id)),
    sums AS (SELECT column_name, load_id, count(*) AS n, count(*) FILTER (t IS NULL) AS n_null, count(*) FILTER (violates) AS n_viol, count(m) AS k, coalesce(sum(m), 0) AS m1, coalesce(sum(m * m), 0) AS m2,
    count(s) AS lk, coalesce(sum(s), 0) AS l1, coalesce(sum(s * s), 0) AS l2 FROM lc WHERE load_id IS NOT NULL GROUP BY 1, 2),
    sz AS (SELECT column_name, load_id, n AS n_load, sum(n) OVER (PARTITION BY column_name) AS n_all FROM sums), least_n AS (SELECT column_name, sum(n) - max(n) AS n_least FROM sums GROUP BY 1),
    wide AS (SELECT column_name, load_id, n, {_share_shift("n_null", "n", "sum(n_null) OVER w", "sum(n) OVER w")} AS a1, {_share_shift("n_viol", "n", "sum(n_viol) OVER w", "sum(n) OVER w")} AS a2,
    {_mean_shift("k", "m1", "m2")} AS a3, {_mean_shift("lk", "l1", "l2")} AS a4 FROM sums WINDOW w AS (PARTITION BY column_name)),
    {_shares("t", "single value")}, {_shares("form", "single form")},
    shifts AS (SELECT column_name, load_id, n, 'null share' AS aspect, a1 AS shift FROM wide UNION ALL SELECT column_name, load_id, n, 'violation share', a2 FROM wide UNION ALL SELECT column_name, load_id, n, 'typical value', a3 FROM wide
    UNION ALL SELECT column_name, load_id, n, 'typical length', a4 FROM wide UNION ALL SELECT * FROM single_value UNION ALL SELECT * FROM single_form),
    mid AS (SELECT *, abs(shift - median(shift) OVER (PARTITION BY column_name, aspect)) AS off FROM shifts), usual AS (SELECT *, median(off) OVER (PARTITION BY column_name, aspect) AS usual FROM mid)
    SELECT 'value' AS finding, column_name, row_id AS key_id FROM cells WHERE violates UNION ALL SELECT DISTINCT 'load', column_name, cast(load_id AS BIGINT) FROM usual WHERE n >= 20 AND off >= 0.6 AND off >= 6 * usual"""


def _leaf(e: str, path: str) -> str:
    """A leaf as text: scalars bare, lists and objects as compact JSON."""
    j = f"json_extract({e}, '$.{path}')"
    return f"CASE WHEN json_type({j}) IS NULL OR json_type({j}) = 'NULL' THEN NULL ELSE json_extract_string({e}, '$.{path}') END"


P6_OBJECTS = P6.split("    SELECT row_id, 'object' AS child")[0] + " SELECT row_id, cast(pos AS INT) AS pos, " + ", ".join(
    f"{_leaf('e', p)} AS {p.replace('.', '_')}" for p in ("quantity", "costWithoutVAT", "shortDescription", "units.key", "units.value")
) + " FROM obj"
P6_CPVS = P6.split("    SELECT row_id, 'object' AS child")[0] + f" SELECT row_id, cast(pos AS INT) AS pos, cast(sub_pos AS INT) AS sub_pos, {_leaf('e', 'key')} AS key, {_leaf('e', 'value')} AS value FROM c3 WHERE json_type(e) = 'OBJECT'"
P6_MEMBERS = P6.split("    SELECT row_id, 'object' AS child")[0] + " SELECT row_id, cast(pos AS INT) AS pos, " + ", ".join(
    f"{_leaf('e', p)} AS {p.replace('.', '_')}" for p in ("vatNumber", "name", "country.key", "greekVatNumber")
) + " FROM m3 WHERE json_type(e) = 'OBJECT'"

P4 = f"SELECT act, row_id FROM ({P4_REASONS})"

ORACLE = {"p4_reasons": P4_REASONS, "p1_found": P1, "p2_found": P2, "p2_profile": P2_PROFILE, "p2_violations": P2_VIOLATIONS, "p6_objects": P6_OBJECTS, "p6_cpvs": P6_CPVS, "p6_members": P6_MEMBERS, "p4_found": P4, "p5_found": P5, "p5_profile": P5_PROFILE, "p6_found": P6}
