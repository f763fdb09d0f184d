"""Schema drift between files of semi-structured records.

Records become path-value maps with raw types, written once; path-type statistics are aggregated per
file where the records are read, each file is compared with the previous one of its feed, and only the
values of paths that came or went are brought together, to prove renames on the acts that both
files hold. One consistent typed table is projected with a report of failed casts and of values that
stand against each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synaxis.functions.jsontext import BAD, parse, plain
from synaxis.session import cut, q

ENTRY = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("path", "type", "value", "same", "clash")]))
MAX_FIELDS = 2000


def _leaves(obj: dict, prefix: str) -> Iterator[tuple[str, object]]:
    stack = [(prefix, obj)]
    while stack:
        at, node = stack.pop()
        for key, value in node.items():
            path = f"{at}.{key}" if at else key
            if isinstance(value, dict):
                stack.append((path, value))
            elif value is not None:
                yield path, value


def _kind(value: object) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return "string" if isinstance(value, str) else "list"


def _same(value: object) -> str:
    """A value's text with its type forgotten: 5, 5.0 and "5" are the same."""
    if isinstance(value, str):
        text = value.strip()
        if text[:1] in ("[", "{") and (inner := parse(text)) is not BAD:
            return plain(inner)
        if len(text) <= 15:
            try:
                return repr(float(text))
            except ValueError:
                pass
        return text.lower() if text.lower() in ("true", "false") else plain(text)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        try:
            return repr(float(value))
        except OverflowError:
            return plain(value)
    return plain(value)


def record_entries(text: str | None) -> list[tuple[str, str, str, str, str | None]] | None:
    """The non-null paths of a record; of a flat and a nested spelling the first, with ``clash`` set if the other differs."""
    value = parse(text)
    if not isinstance(value, dict):
        return None
    found: dict[str, tuple[str, str, str, str, str | None]] = {}
    for path, leaf in _leaves(value, ""):
        path = plain(path)
        if path not in found:
            found[path] = (path, _kind(leaf), plain(leaf), _same(leaf), None)
        elif found[path][3] != _same(leaf):
            found[path] = (*found[path][:4], "true")
    return list(found.values())


@F.pandas_udf(ENTRY)
def entries_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(record_entries)


def path_values(raw: DataFrame, file: str = "file_name", payload: str = "payload", act_path: str = "referenceNumber") -> DataFrame:
    """(feed, file, act, path, type, same): one row per non-null value of a record; ``same`` is its hash with the type forgotten.

    The feed is the file's folder. Records that are no JSON object have no paths. Nothing is shuffled.
    """
    records = raw.filter(q(file).isNotNull()).select(
        q(file).alias("file"), entries_udf(q(payload)).alias("entries")
    )
    act = F.element_at(F.filter("entries", lambda e: e["path"] == act_path), 1)["value"]
    short = F.transform("entries", lambda e: F.struct(e["path"].alias("path"), e["type"].alias("type"), F.xxhash64(e["same"]).alias("same")))
    return records.select(
        F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("feed"), "file", F.when(F.size("entries") > 0, act).alias("act"), F.inline(short)
    )


def file_order(raw: DataFrame, file: str = "file_name") -> DataFrame:
    """(feed, file, idx): files numbered in name order within their feed."""
    files = raw.filter(q(file).isNotNull()).select(q(file).alias("file")).distinct()
    files = files.withColumn("feed", F.regexp_extract("file", "^(.*)/[^/]*$", 1))
    return files.withColumn("idx", F.row_number().over(Window.partitionBy("feed").orderBy("file")))


def path_stats(values: DataFrame) -> DataFrame:
    """(feed, file, path, main_type, n): the type of most non-null values; ties by type name."""
    by_type = values.groupBy("feed", "file", "path", "type").agg(F.count(F.lit(1)).alias("n"))
    return by_type.groupBy("feed", "file", "path").agg(
        F.max_by("type", F.struct("n", "type")).alias("main_type"), F.sum("n").alias("n")
    )


def changes(values: DataFrame, files: DataFrame) -> DataFrame:
    """(feed, idx, file_name, field_path, change_kind, old_path): each change to the previous file.

    A vanished and a new path of the same file are one rename if at least one act of both files
    has both values and no such act disagrees; each path takes part in one rename, the one proved
    by most acts (then by name). A rename is listed only as such. First files have no changes; a
    file without any readable record counts as a file without fields.
    """
    stats = path_stats(values).join(files, ["feed", "file"])
    now = stats.select("feed", "idx", "path", F.col("main_type").alias("new_type"), F.lit(None).cast("string").alias("old_type"))
    before = stats.select(
        "feed", (F.col("idx") + 1).alias("idx"), "path", F.lit(None).cast("string").alias("new_type"), F.col("main_type").alias("old_type")
    )
    both = now.unionByName(before).groupBy("feed", "idx", "path").agg(F.max("new_type").alias("new_type"), F.max("old_type").alias("old_type"))
    diff = cut(
        both.join(files.filter("idx > 1"), ["feed", "idx"]).withColumn(
            "change_kind",
            F.when(F.col("old_type").isNull(), "added")
            .when(F.col("new_type").isNull(), "removed")
            .when(F.col("old_type") != F.col("new_type"), "type_changed"),
        ).filter("change_kind is not null")
    )
    # of the values, only those of paths that came or went in the file or the next one
    added = diff.filter("change_kind = 'added'").select("feed", "idx", "path").join(files, ["feed", "idx"])
    removed = diff.filter("change_kind = 'removed'").select("feed", "idx", "path").join(files.withColumn("idx", F.col("idx") + 1), ["feed", "idx"])
    acts = values.filter("act is not null").select("feed", "file", "act", "path", "same")
    new_values = acts.join(added, ["feed", "file", "path"]).select("feed", "idx", "act", F.col("path").alias("new_path"), F.col("same").alias("new_same")).distinct()
    old_values = acts.join(removed, ["feed", "file", "path"]).select("feed", "idx", "act", F.col("path").alias("old_path"), F.col("same").alias("old_same")).distinct()
    by_act = (
        new_values.join(old_values, ["feed", "idx", "act"])
        .groupBy("feed", "idx", "new_path", "old_path", "act")
        .agg(F.max(F.col("new_same") == F.col("old_same")).alias("same"))
    )
    proved = (
        by_act.groupBy("feed", "idx", "new_path", "old_path")
        .agg(F.count(F.lit(1)).alias("n"), F.min("same").alias("same")).filter("same")
    )
    best_new = Window.partitionBy("feed", "idx", "new_path").orderBy(F.desc("n"), "old_path")
    best_old = Window.partitionBy("feed", "idx", "old_path").orderBy(F.desc("n"), "new_path")
    renamed = (
        proved.withColumn("rn", F.row_number().over(best_new)).filter("rn = 1")
        .withColumn("ro", F.row_number().over(best_old)).filter("ro = 1")
        .select("feed", "idx", "new_path", "old_path")
    )
    as_new = renamed.select("feed", "idx", F.col("new_path").alias("path"), F.lit("added").alias("change_kind"), "old_path")
    as_old = renamed.select("feed", "idx", F.col("old_path").alias("path"), F.lit("removed").alias("change_kind"), F.lit(None).cast("string").alias("old_path"))
    marked = as_new.unionByName(as_old).withColumn("in_rename", F.lit(True))
    return (
        diff.join(marked, ["feed", "idx", "path", "change_kind"], "left")
        .filter("in_rename is null or old_path is not null")
        .select(
            "feed",
            "idx",
            F.col("file").alias("file_name"),
            F.col("path").alias("field_path"),
            F.when(F.col("in_rename"), "renamed").otherwise(F.col("change_kind")).alias("change_kind"),
            F.coalesce("old_path", F.lit("")).alias("old_path"),
        )
    )


def canonical_paths(renames: list[tuple[str, str]], together: list[set[str]] = ()) -> dict[str, str]:
    """Map each renamed path to the first name, in sort order, of all that were renamed into each other.

    ``together`` are sets of paths that stand in one file. Names of which any two do so are different
    fields, as when two fields swap names over time, and stay apart.
    """
    classes: dict[str, set[str]] = {}
    for a, b in sorted(renames):
        ca, cb = classes.setdefault(a, {a}), classes.setdefault(b, {b})
        if ca is not cb and not any(ca & t and cb & t for t in together):
            merged = ca | cb
            for x in merged:
                classes[x] = merged
    return {x: min(c) for x, c in classes.items()}


# A raw type and the column type it is projected to.
SPARK_TYPES = {"string": "string", "number": "double", "boolean": "boolean", "list": "string"}


def consistent_types(values: DataFrame, change_list: DataFrame, max_fields: int = MAX_FIELDS) -> list[tuple[str, str, list[str]]]:
    """(column, type, its paths) for every field: names over all renames, the type of most values.

    Only schema-sized facts come to the driver: the ``max_fields`` commonest paths, their renames, and in which
    combinations renamed paths stand in a file. Where paths are data (objects keyed by an id), the rest
    have no columns of their own but stay in the table's map of other values.
    """
    stats = cut(values.groupBy("file", "path", "type").agg(F.count(F.lit(1)).alias("n")))
    top = cut(stats.groupBy("path").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "path").limit(max_fields).select("path"))
    renames = (
        change_list.filter("change_kind = 'renamed'").select("old_path", "field_path").distinct()
        .join(top.withColumnRenamed("path", "field_path"), "field_path").join(top.withColumnRenamed("path", "old_path"), "old_path").select("old_path", "field_path").collect()
    )
    renamed = sorted({x for r in renames for x in r})
    sets = stats.filter(F.col("path").isin(renamed)).groupBy("file").agg(F.array_sort(F.collect_set("path")).alias("paths")).select("paths").distinct().collect() if renamed else []
    to = canonical_paths([tuple(r) for r in renames], [set(r.paths) for r in sets])
    counts: dict[str, dict[str, int]] = {}
    paths: dict[str, list[str]] = {}
    for r in stats.join(top, "path").groupBy("path", "type").agg(F.sum("n").alias("n")).orderBy("path", "type").collect():
        name = to.get(r.path, r.path)
        own = counts.setdefault(name, {})
        own[r.type] = own.get(r.type, 0) + r.n
        if r.path not in paths.setdefault(name, []):
            paths[name].append(r.path)
    return [(n, SPARK_TYPES[max(c, key=lambda t: (c[t], t))], paths[n]) for n, c in sorted(counts.items())]


def _typed(text, kind: str):
    if kind == "boolean":
        return F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true")
    return text.try_cast(kind) if kind != "string" else text


def consistent_table(
    raw: DataFrame, fields: list[tuple[str, str, list[str]]], file: str = "file_name", line: str = "line_no", payload: str = "payload"
) -> DataFrame:
    """One row per record with every field typed; a value that cannot be cast is null.

    Columns ``file_name``, ``line_no``, then the fields (dots as underscores, a clash gets a number),
    ``others``: values of paths that are no field, ``failed_casts``: the fields whose value was lost to a
    cast, and ``conflicts``: the fields of which a record holds a second, different value.
    """
    records = raw.select(q(file).alias("file_name"), q(line).alias("line_no"), entries_udf(q(payload)).alias("e"))
    part = lambda f: F.map_from_entries(F.transform("e", lambda x: F.struct(x["path"], x[f])))
    records = records.select("file_name", "line_no", part("value").alias("m"), part("same").alias("s"), F.map_filter(part("clash"), lambda _, v: v.isNotNull()).alias("c"))
    taken, columns, failed, conflicts = {"file_name", "line_no", "others", "failed_casts", "conflicts"}, [], [], []
    for name, kind, paths in fields:
        label = name.replace(".", "_")
        while label in taken:
            label += "_2"
        taken.add(label)
        text = F.coalesce(*[F.try_element_at("m", F.lit(p)) for p in paths])
        columns.append(_typed(text, kind).alias(label))
        if kind != "string":
            failed.append(F.when(text.isNotNull() & _typed(text, kind).isNull(), F.lit(name)))
        twice = F.lit(False)
        for p in paths:
            twice = twice | F.map_contains_key("c", F.lit(p))
        if len(paths) > 1:
            twice = twice | (F.size(F.array_distinct(F.array_compact(F.array(*[F.try_element_at("s", F.lit(p)) for p in paths])))) > 1)
        conflicts.append(F.when(twice, F.lit(name)))
    known = [p for _, _, paths in fields for p in paths]
    others = F.map_filter("m", lambda k, _: ~k.isin(known)) if known else F.col("m")

    def listed(found: list):
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")

    return records.select(
        "file_name", "line_no", *columns, others.alias("others"), F.coalesce(listed(failed), F.array().cast("array<string>")).alias("failed_casts"), F.coalesce(listed(conflicts), F.array().cast("array<string>")).alias("conflicts")
    )


def failed_casts(table: DataFrame) -> DataFrame:
    """(file_name, field_path, kind, n): values lost to a cast or to a second value, by file and field."""
    kinds = F.array(F.struct(F.lit("cast").alias("kind"), F.col("failed_casts").alias("paths")), F.struct(F.lit("conflict").alias("kind"), F.col("conflicts").alias("paths")))
    rows = table.select("file_name", F.inline(kinds)).select("file_name", "kind", F.explode("paths").alias("field_path"))
    return rows.groupBy("file_name", "field_path", "kind").agg(F.count(F.lit(1)).alias("n"))
