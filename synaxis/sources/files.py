"""File listings, sinks and synchronisation plans."""

from __future__ import annotations

import datetime as dt
import json
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from synaxis.session import exists


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(key, size, modified): files below a folder, without reading them."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(F.regexp_replace("path", "^.*/", "").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )


def latest_complete_month(files: DataFrame, entities: list[str]) -> DataFrame:
    """One row: the least over entities of their latest ``<entity>_<YYYY>_<MM>`` file; other names do not count."""
    pattern = r"^([a-z]+)_(\d{4})_(\d{2})\.parquet$"
    parts = files.select(*[F.regexp_extract("key", pattern, i).alias(c) for i, c in ((1, "entity"), (2, "y"), (3, "m"))]).filter(F.col("entity").isin(*entities))
    per = parts.groupBy("entity").agg(F.max(F.struct(F.col("y").cast("int").alias("year"), F.col("m").cast("int").alias("month"))).alias("ym"))
    return per.agg(F.min("ym").alias("ym"), F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") == len(entities), F.col("ym.year")).alias("year"), F.when(F.col("n") == len(entities), F.col("ym.month")).alias("month")
    )


def sync_plan(local: DataFrame, remote: DataFrame, direction: str = "push") -> DataFrame:
    """(key, reason): files to copy. Push if missing, of other size or newer here; pull if missing or of other size. Never deletes."""
    here, there = (local, remote) if direction == "push" else (remote, local)
    a = here.select("key", F.col("size").alias("size_a"), F.col("modified").alias("mod_a"))
    b = there.select("key", F.col("size").alias("size_b"), F.col("modified").alias("mod_b"))
    reason = F.when(F.col("size_b").isNull(), "missing").when(F.col("size_a") != F.col("size_b"), "size")
    if direction == "push":
        reason = reason.when(F.col("mod_a") > F.col("mod_b"), "newer")
    return a.join(b, "key", "left").withColumn("reason", reason).filter("reason is not null").select("key", "reason")


def write_months(df: DataFrame, path: str) -> None:
    """Overwrite only the months that the data holds, whole or not at all."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_source_year", "_source_month").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; a byte-order mark starts the first header cell, where spreadsheet programs look for it."""
    first = df.columns[0]
    df.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a fixed schema (ids stay text); a path that does not exist gives an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def columnar_json(df: DataFrame, block: Column | None = None) -> DataFrame:
    """(block, columns, rows): rows as arrays under one list of column names, in blocks of bounded size."""
    row = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    key = block if block is not None else F.spark_partition_id()
    return df.select(key.alias("block"), row.alias("r")).groupBy("block").agg(
        F.to_json(F.struct(F.array(*[F.lit(c) for c in df.columns]).alias("columns"), F.collect_list("r").alias("rows"))).alias("json")
    )


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """(key, json): each row as JSON with nulls written and NaN turned to null."""
    clean = [
        (F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")) if t in ("double", "float") else F.col(f"`{n}`")).alias(n) for n, t in df.dtypes
    ]
    return df.select(F.col(f"`{key}`").alias("key"), F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("json"))


def payload_json(df: DataFrame, header: dict[str, str | int | None], count_as: str, max_rows: int = 1_000_000) -> str:
    """One document: the header's entries, the number of records under ``count_as``, and the records, without NaN.

    A document is read whole by its users, so more than ``max_rows`` records raise; :func:`keyed_json` has no bound.
    """
    rows = keyed_json(df, df.columns[0]).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} records for one document")
    head = json.dumps(header | {count_as: len(rows)}, ensure_ascii=False)
    return head[:-1] + (", " if len(head) > 2 else "") + '"records": [' + ", ".join(r.json for r in rows) + "]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def append_whole(df: DataFrame, path: str) -> None:
    """Append rows to a Parquet table so that readers see all of them or none.

    Old and new rows are written beside the table, which is then replaced by renaming; a write that fails leaves the
    table as it was, and a table left renamed by a stopped run is put back first.
    """
    spark = df.sparkSession
    fs, target = _fs(spark, path)
    _, fresh = _fs(spark, path + ".tmp")
    _, old = _fs(spark, path + ".old")
    if fs.exists(old) and not fs.exists(target):
        fs.rename(old, target)
    every = spark.read.parquet(path).unionByName(df, allowMissingColumns=True) if fs.exists(target) else df
    every.write.mode("overwrite").parquet(path + ".tmp")
    fs.delete(old, True)
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(fresh, target):
        raise OSError(f"{path} could not be put in place")
    fs.delete(old, True)


def publish(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> list[str]:
    """Copy those of the named files that exist, and no others; the names copied."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = []
    for name in names:
        src_fs, src = _fs(spark, f"{source}/{name}")
        dst_fs, dst = _fs(spark, f"{target}/{name}")
        if src_fs.exists(src):
            jvm.org.apache.hadoop.fs.FileUtil.copy(src_fs, src, dst_fs, dst, False, True, conf)
            done.append(name)
    return done


def release(folder: str, archive: str, info: dict) -> dict:
    """Write ``build-info.json`` with the number of files into a local folder and pack the folder, in name order."""
    files = [p for p in sorted(Path(folder).rglob("*")) if p.is_file() and p.name != "build-info.json"]
    manifest = info | {"dist_file_count": len(files), "build_timestamp": dt.datetime.now(dt.timezone.utc).isoformat()}
    Path(folder, "build-info.json").write_text(json.dumps(manifest, ensure_ascii=False, indent=2), encoding="utf-8")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(Path(folder).rglob("*")):
            if p.is_file():
                out.write(p, p.relative_to(folder).as_posix())
    return manifest


def typed_header(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Rename columns to bulk-import headers such as ``vat:ID(Organization)``; data are unchanged."""
    return df.withColumnsRenamed(kinds)
