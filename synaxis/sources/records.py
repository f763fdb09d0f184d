"""Records of the register as rows: flattened maps, companies, and the web form's entries."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synaxis.functions.jsontext import parse, plain

LONGEST = 1 << 63


def flat_record(text: str | None) -> dict[str, str | None] | None:
    """Dotted path to text of a record: nested objects opened, lists as JSON, whole numbers beyond 64 bits null."""
    value = parse(text)
    if not isinstance(value, dict):
        return None
    out: dict[str, str | None] = {}
    stack: list[tuple[str, object]] = [("", value)]
    while stack:
        at, node = stack.pop()
        if isinstance(node, dict) and (node or not at):
            stack += [(f"{at}.{k}" if at else k, v) for k, v in reversed(node.items())]
        elif isinstance(node, (list, dict)):
            out[plain(at)] = plain(json.dumps(node, ensure_ascii=False))
        elif isinstance(node, int) and not isinstance(node, bool) and not -LONGEST <= node < LONGEST:
            out[plain(at)] = None
        else:
            out[plain(at)] = plain(node)
    return out


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def flatten_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts of records to maps; null where a text is no JSON object."""
    for texts in batches:
        yield texts.map(flat_record)


# The fields of a company and where the answer holds them.
COMPANY = (
    ("registry_no", "$.arGemi", "string"), ("afm", "$.afm", "string"), ("name_el", "$.coNameEl", "string"), ("legal_type", "$.legalType.descr", "string"), ("status", "$.status.descr", "string"),
    ("incorporation_date", "$.incorporationDate", "string"), ("is_active", "$.autoRegistered", "boolean"), ("is_branch", "$.isBranch", "boolean"),
)


def company(answer: Column) -> Column:
    """A company's fields from its JSON; missing ones are null."""
    return F.when(answer.isNotNull(), F.struct(*[F.get_json_object(answer, path).try_cast(kind).alias(name) for name, path, kind in COMPANY], answer.alias("raw")))


def company_of_search(answer: Column) -> Column:
    """The first result of a search that is no branch, else the first; null where there is none."""
    results = F.from_json(answer, "struct<searchResults:array<string>>")["searchResults"]
    parent = F.filter(results, lambda r: F.get_json_object(r, "$.isBranch") == "false")
    return company(F.coalesce(F.try_element_at(parent, F.lit(1)), F.try_element_at(results, F.lit(1))))


def form_error(name: Column, email: Column, message: Column, vat: Column, entity: Column, trap: Column) -> Column:
    """Why an entry of the correction form is refused, ``dropped`` for a filled trap field, null where it is good."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return (
        F.when(F.trim(blank(trap)) != "", "dropped")
        .when((F.trim(blank(message)) == "") | (F.length(message) > 5000), "invalid_message")
        .when(~F.coalesce((F.length(email) <= 200) & email.rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$"), F.lit(False)), "invalid_email")
        .when(F.length(blank(name)) > 200, "invalid_name")
        .when((F.length(blank(vat)) > 20) | (F.length(blank(entity)) > 200), "invalid_context")
    )
