"""DuckDB SQL building blocks that state the clean act tables once for all query texts."""

from __future__ import annotations

from synaxis.functions.scalars import ACCENTED, UNACCENTED

_NUM = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"


def vat(col: str) -> str:
    d = f"regexp_replace({col}, '[^0-9]', '', 'g')"
    t = f"(CASE WHEN length({d}) > 9 THEN ltrim({d}, '0') ELSE {d} END)"
    n = f"(CASE WHEN length({t}) BETWEEN 7 AND 8 THEN lpad({t}, 9, '0') ELSE {t} END)"
    return f"(CASE WHEN length({n}) = 9 AND {n} NOT IN ('000000000','999999999','111111111','001111111') THEN {n} END)"


def checksum(v: str) -> str:
    total = " + ".join(f"try_cast(substr({v}, {i + 1}, 1) AS INT) * {1 << (8 - i)}" for i in range(8))
    return f"coalesce(regexp_full_match({v}, '[0-9]{{9}}') AND (({total}) % 11) % 10 = try_cast(substr({v}, 9, 1) AS INT), false)"


def num(col: str) -> str:
    t = f"cast({col} AS VARCHAR)"
    return f"(CASE WHEN regexp_full_match({t}, '{_NUM}') THEN try_cast(trim({t}) AS DOUBLE) END)"


def capped(v: str) -> str:
    return f"(CASE WHEN {v} <= 1e10 THEN {v} END)"


def plain(col: str) -> str:
    return f"translate({col}, '{ACCENTED}', '{UNACCENTED}')"


def norm_name(col: str) -> str:
    return f"array_to_string(regexp_extract_all(upper({col}), '[Α-Ωα-ωA-Za-z0-9]+'), ' ')"


def dedupe(table: str) -> str:
    return (
        f'(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "referenceNumber" ORDER BY row_id DESC) AS rn FROM {table})'
        ' WHERE rn = 1 OR "referenceNumber" IS NULL)'
    )


def json_array(col: str) -> str:
    return f"(CASE WHEN json_valid({col}) AND json_type({col}) = 'ARRAY' THEN {col} END)"


_MEMBERS = '"contractingDataDetails.contractingMembersDataList"'
_OWN = vat('"organizationVatNumber"')
_BASE = f'row_id, "referenceNumber" AS ref, "organization.value" AS org_name, {_OWN} AS own_vat, _source_year AS year, _source_month AS month, "submissionDate" AS submitted'

COUNTS = (
    "counts AS (SELECT name, vat, count(*) AS n FROM ("
    + " UNION ALL ".join(f'SELECT "organization.value" AS name, {_OWN} AS vat FROM {t}' for t in ("auction", "contract", "notice"))
    + ") WHERE name IS NOT NULL AND vat IS NOT NULL GROUP BY 1, 2)"
)
RESOLVER = f"{COUNTS}, resolver AS (SELECT name, vat FROM (SELECT *, sum(n) OVER (PARTITION BY name) AS total FROM counts) WHERE n * 1.0 / total >= 0.9)"


def _resolved(name: str, body: str) -> str:
    return f"{name} AS (SELECT b.*, coalesce(b.own_vat, r.vat) AS vat FROM ({body}) b LEFT JOIN resolver r ON b.org_name = r.name)"


AUCTIONS = _resolved(
    "auctions",
    f"""SELECT {_BASE}, title, "procedureType.key" AS proc_key, "procedureType.value" AS proc_value, "contractType.value" AS contract_type,
    {capped(f'coalesce({num(chr(34) + "totalCostWithoutVAT" + chr(34))}, {num(chr(34) + "totalCostWithVAT" + chr(34))})')} AS value,
    "signedDate" AS signed, "noticeRefNo" AS notice_ref, coalesce(lower(trim(cancelled)) = 'true', false) AS cancelled,
    "typeOfContractingAuthority" AS authority, "classificationOfPublicLawOrganization.value" AS classification,
    "nutsCode.key" AS nuts_code, "nutsCode.value" AS nuts_name, "nutsCity" AS nuts_city, "objectDetailsList" AS objects, {_MEMBERS} AS members,
    json_extract_string({json_array('"objectDetailsList"')}, '$[0].cpvs[0].key') AS cpv_key,
    json_extract_string({json_array('"objectDetailsList"')}, '$[0].cpvs[0].value') AS cpv_value,
    json_extract_string({json_array(_MEMBERS)}, '$[0].vatNumber') AS member_vat,
    json_extract_string({json_array(_MEMBERS)}, '$[0].name') AS member_name
    FROM {dedupe("auction")}""",
)
CONTRACTS = _resolved(
    "contracts",
    f"""SELECT {_BASE}, "procedureType.key" AS proc_key, "procedureType.value" AS proc_value, coalesce("bidsSubmitted", "contract.bidsSubmitted") AS bids,
    {capped('coalesce("totalCostWithoutVAT", "totalCostWithVAT")')} AS value,
    json_extract_string({json_array(_MEMBERS)}, '$[0].vatNumber') AS member_vat, json_array_length({json_array(_MEMBERS)}) AS n_members
    FROM {dedupe("contract")}""",
)
NOTICES = _resolved(
    "notices",
    f"""SELECT {_BASE}, "typeOfProcedure.key" AS proc_key, {capped('coalesce("totalCostWithoutVAT", "totalCostWithVAT", budget)')} AS estimate,
    try_cast(try_cast("submissionDate" AS TIMESTAMP) AS DATE) AS submitted_day, try_cast(try_cast("finalSubmissionDate" AS TIMESTAMP) AS DATE) AS final_day
    FROM {dedupe("notice")}""",
)
PAYMENTS = _resolved("payments", f'SELECT {_BASE}, {capped(chr(34) + "totalCostWithoutVAT" + chr(34))} AS value FROM {dedupe("payment")}')


def acts(*names: str) -> str:
    """WITH clause prefix that defines the named clean tables."""
    table = {"auctions": AUCTIONS, "contracts": CONTRACTS, "notices": NOTICES, "payments": PAYMENTS}
    return "WITH " + ", ".join([RESOLVER, *[table[n] for n in names]])
