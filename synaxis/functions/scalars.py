"""Pure Column expressions: tax ids, amounts, dates, names, JSON helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tax ids that stand for "none".
DUMMY_VATS = ("000000000", "999999999", "111111111", "001111111")
VALUE_CAP = 1e10
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def vat_digits(raw: Column) -> Column:
    """ASCII digits of a raw tax id, brought towards nine places (too short or long ones stay as they are)."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    trimmed = F.when(F.length(digits) > 9, F.regexp_replace(digits, "^0+", "")).otherwise(digits)
    return F.when(F.length(trimmed).between(7, 8), F.lpad(trimmed, 9, "0")).otherwise(trimmed)


def normalize_vat(raw: Column) -> Column:
    """Nine-digit form of a raw tax id, or null where there is none (dummies included)."""
    v = vat_digits(raw)
    return F.when((F.length(v) == 9) & ~v.isin(*DUMMY_VATS), v)


def vat_checksum(vat: Column) -> Column:
    """Whether a nine-digit text carries the right mod-11 check digit; null-safe (false)."""
    total = reduce(
        lambda a, b: a + b,
        [F.substring(vat, i + 1, 1).try_cast("int") * (1 << (8 - i)) for i in range(8)],
    )
    ok = (total % 11) % 10 == F.substring(vat, 9, 1).try_cast("int")
    return F.coalesce(vat.rlike("^[0-9]{9}$") & ok, F.lit(False))


def to_number(col: Column) -> Column:
    """Guarded text-to-double: only plain decimal or exponent notation, else null; NaN is null."""
    text = col.cast("string")
    value = F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(value), value)


def sanitize_value(v: Column, cap: float = VALUE_CAP) -> Column:
    """Null above the cap (never clipped); infinities and NaN too."""
    return F.when((v <= cap) & ~F.isnan(v), v)


def to_timestamp(col: Column) -> Column:
    return col.try_cast("timestamp")


def to_day(col: Column) -> Column:
    return F.to_date(to_timestamp(col))


def plausible_day(day: Column, first_year: int = 1900, last_year: int = 9999) -> Column:
    return F.when(F.year(day).between(first_year, last_year), day)


def is_cancelled(col: Column) -> Column:
    """True only for a boolean or textual true in any case; null and anything else are false."""
    return F.coalesce(F.lower(F.trim(col.cast("string"))) == "true", F.lit(False))


def pct(a: Column, b: Column, digits: int = 2) -> Column:
    """Guarded percentage; null where the denominator is 0 or null."""
    return F.round(F.try_divide(F.lit(100.0) * a, b), digits)


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return r if digits is None else F.round(r, digits)


def first_digit(v: Column) -> Column:
    """First significant digit of a positive amount, from its decimal text (0.005 gives 5)."""
    return F.regexp_extract(v.cast("string"), "[1-9]", 0).try_cast("int")


def first_two_second_digit(v: Column) -> Column:
    """Second digit of the integer part, only for amounts of 10 or more."""
    whole = F.floor(v).cast("decimal(20,0)").cast("string")
    return F.when(v >= 10, F.substring(whole, 2, 1).try_cast("int"))


def normalize_name(name: Column) -> Column:
    """Upper case, runs of unaccented Greek or Latin letters and digits, single spaces."""
    return F.array_join(F.regexp_extract_all(F.upper(name), F.lit("([Α-Ωα-ωA-Za-z0-9]+)"), F.lit(1)), " ")


# Greek vowels with tonos or dialytika and their bare forms.
ACCENTED = "άέήίόύώϊϋΐΰΆΈΉΊΌΎΏΪΫ"
UNACCENTED = "αεηιουωιυιυΑΕΗΙΟΥΩΙΥ"


def strip_accents(name: Column) -> Column:
    return F.translate(name, ACCENTED, UNACCENTED)


def normalize_greek(name: Column) -> Column:
    return normalize_name(strip_accents(name))


def name_prefix(norm: Column, tokens: int = 4) -> Column:
    return F.substring_index(norm, " ", tokens)
