"""Nested JSON texts to flat child tables by columnar shredding.

Every leaf path of a nested schema becomes a column of (repetition level, definition level,
value) entries. For a leaf below the repeated nodes 1..m an entry's repetition level says at
which of them a new element begins (0: a new record), and its definition level how much of the
path exists: 2k for "node k+1 is missing or empty", 2k+1 for "an element of it stands there but is
no object", 2k+2 for "it is an object", 2m+1 for "the leaf has a value". A child table is read
back from the levels of any leaf below it; a deeper leaf also carries its ancestors, so one
column per chain is enough where no values are wanted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synaxis.functions.jsontext import BAD, parse, plain
from synaxis.session import q


@dataclass(frozen=True)
class Chain:
    """A column of JSON texts, the names of its nested repeated nodes, and a leaf below the last.

    ``nodes`` names the child tables from the outermost in; ``keys`` the fields that hold the
    inner lists (the outermost list is the text itself).
    """

    column: str
    nodes: tuple[str, ...]
    keys: tuple[str, ...] = ()
    leaf: str = "key"


@dataclass
class Levels:
    """One shredded column of a batch of records."""

    rep: list[int] = field(default_factory=list)
    define: list[int] = field(default_factory=list)
    values: list[str | None] = field(default_factory=list)


def _as_list(value):
    if isinstance(value, str):
        value = parse(value)
        if isinstance(value, str):
            value = parse(value)
    if isinstance(value, dict):
        return [value]
    return value if isinstance(value, list) else None


def _as_object(value):
    if isinstance(value, str):
        value = parse(value)
    return value if isinstance(value, dict) else None


def _field(obj: dict, path: str):
    for part in path.split("."):
        obj = obj.get(part) if isinstance(obj, dict) else None
    return obj


def shred_record(value, chain: Chain, out: Levels) -> None:
    """Append one parsed record to a shredded column."""
    rep, define, values = out.rep, out.define, out.values
    last = len(chain.nodes) - 1

    def walk(node, depth: int, r: int) -> None:
        items = _as_list(node)
        if not items:
            rep.append(r), define.append(2 * depth), values.append(None)
            return
        for i, item in enumerate(items):
            here = r if i == 0 else depth + 1
            obj = item if type(item) is dict else _as_object(item)
            if obj is None:
                rep.append(here), define.append(2 * depth + 1), values.append(None)
            elif depth < last:
                key = chain.keys[depth]
                walk(obj.get(key) if "." not in key else _field(obj, key), depth + 1, here)
            else:
                leaf = obj.get(chain.leaf) if "." not in chain.leaf else _field(obj, chain.leaf)
                rep.append(here), define.append(2 * depth + 2 + (leaf is not None)), values.append(plain(leaf))

    walk(None if value is BAD else value, 0, 0)


def shred(texts: Sequence[str | None], chains: Sequence[Chain]) -> list[Levels]:
    """Shred a batch of texts into one levelled column per chain (all of one JSON column)."""
    columns = [Levels() for _ in chains]
    for text in texts:
        value = parse(text)
        for chain, out in zip(chains, columns, strict=True):
            shred_record(value, chain, out)
    return columns


def assemble(levels: Levels, depth: int):
    """Elements of the repeated node at ``depth`` (1: outermost) that are objects.

    Returns record number, positions in each node down to ``depth`` (nulls and non-objects
    counted), and the index of each element's first entry, all from the level sequences.
    """
    rep = np.asarray(levels.rep, dtype=np.int32)
    define = np.asarray(levels.define, dtype=np.int32)
    index = np.arange(len(rep))
    record = np.cumsum(rep == 0) - 1
    positions = []
    for k in range(1, depth + 1):
        begun = np.cumsum(rep <= k)
        opens = np.maximum.accumulate(np.where(rep < k, index, 0)) if len(rep) else index
        positions.append(begun - begun[opens])
    keep = (rep <= depth) & (define >= 2 * depth)
    return record[keep], [p[keep] for p in positions], index[keep]


def _walk_leaves(value, node: str, found: Counter) -> None:
    """Count (repeated node, leaf path, type) of a parsed value; an object where a list is expected is a list of one."""
    stack = [(node, "", item) for item in _as_list(value) or []]
    while stack:
        node, at, item = stack.pop()
        obj = item if type(item) is dict else _as_object(item)
        if obj is None:
            continue
        for key, v in obj.items():
            path = f"{at}.{key}" if at else key
            if isinstance(v, dict):
                stack.append((node, path, v))
            elif isinstance(v, list) and any(isinstance(x, dict) for x in v):
                stack += [(f"{node}/{path}" if node else path, "", x) for x in v]
            elif v is not None:
                kind = "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "list" if isinstance(v, list) else "string"
                found[(node, plain(path), kind)] += 1


def leaf_paths(df: DataFrame, column: str) -> DataFrame:
    """(node, leaf, type, n): every leaf of the objects in a column of JSON lists, by its repeated node.

    ``node`` names the inner lists on the way ('' for the outermost), ``n`` counts the values that are not null. With
    it the chains and leaves of :func:`child_table` need not be known beforehand. Counts are summed in the tasks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["c"]:
                value = parse(text)
                if value is not BAD:
                    _walk_leaves(value, "", found)
        if found:
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["node", "leaf", "type", "n"])

    parts = df.select(q(column).alias("c")).filter("c is not null").mapInPandas(run, "node string, leaf string, type string, n long")
    return parts.groupBy("node", "leaf", "type").agg(F.sum("n").alias("n"))


def discovered(leaves: DataFrame, column: str, root: str, max_leaves: int = 2000) -> list[tuple[Chain, list[str]]]:
    """The chain and leaves of every repeated node, from :func:`leaf_paths`; at most ``max_leaves`` of the commonest leaves."""
    rows = leaves.groupBy("node", "leaf").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "node", "leaf").limit(max_leaves).collect()
    by_node: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.node, r.leaf)):
        by_node.setdefault(r.node, []).append(r.leaf)
    out = []
    for node, names in by_node.items():
        keys = tuple(node.split("/")) if node else ()
        out.append((Chain(column, (root, *keys), keys, names[0]), names))
    return out


def child_rows(df: DataFrame, id_column: str, chains: Sequence[Chain]) -> DataFrame:
    """(id, child, pos, sub_pos): one row per object in the place of an element of any chain.

    pos is the position in the outermost list, sub_pos that in the inner one or -1. An object
    where a list is expected is a list of one, a JSON string that holds JSON counts as that JSON,
    and a text that is not JSON (null, blank, cut off) has no children. Repeated rows give their
    children once for each; an empty table gives none; other columns are not read. A chain of more
    than two nodes has more positions than columns here and raises (:func:`child_table` takes any
    depth). The work is done in Arrow batches inside the scan's own tasks: no shuffle.
    """
    if any(len(c.nodes) > 2 for c in chains):
        raise ValueError("child_rows has two positions; use child_table for deeper chains")
    columns = list(dict.fromkeys(c.column for c in chains))
    id_type = df.schema[id_column].dataType.simpleString()
    src = df.select(q(id_column).alias("id"), *[q(c).alias(f"c{i}") for i, c in enumerate(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            parts = []
            for i, column in enumerate(columns):
                own = [c for c in chains if c.column == column]
                for chain, levels in zip(own, shred(batch.column(i + 1).to_pylist(), own), strict=True):
                    for depth, name in enumerate(chain.nodes, 1):
                        record, pos, _ = assemble(levels, depth)
                        sub = pos[1] if depth > 1 else np.full(len(record), -1)
                        parts.append((record, name, pos[0], sub))
            for record, name, pos, sub in parts:
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(record, pa.int64())),
                        pa.array(np.full(len(record), name, dtype=object), pa.string()),
                        pa.array(pos, pa.int32()),
                        pa.array(sub, pa.int32()),
                    ],
                    names=["id", "child", "pos", "sub_pos"],
                )

    out = src.mapInArrow(run, f"id {id_type}, child string, pos int, sub_pos int")
    return out.select(F.col("id").alias(id_column), "child", "pos", "sub_pos")


def child_table(df: DataFrame, id_column: str, chain: Chain, leaves: Sequence[str]) -> DataFrame:
    """The flat table of a chain's innermost node: id, positions p0.., and one text column per leaf.

    Every leaf is shredded into its own column; as all leaves of a node share its structure, the
    entries of the columns line up and are put side by side. Same rules as :func:`child_rows`.
    """
    depth = len(chain.nodes)
    id_type = df.schema[id_column].dataType.simpleString()
    src = df.select(q(id_column).alias("id"), q(chain.column).alias("c"))
    chains = [Chain(chain.column, chain.nodes, chain.keys, leaf) for leaf in leaves]
    names = ["id", *[f"p{k}" for k in range(depth)], *[leaf.replace(".", "_") for leaf in leaves]]
    types = [id_type, *["int"] * depth, *["string"] * len(leaves)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = shred(batch.column(1).to_pylist(), chains)
            record, pos, index = assemble(columns[0], depth)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(record, pa.int64())),
                    *[pa.array(p, pa.int32()) for p in pos],
                    *[pa.array([c.values[i] for i in index], pa.string()) for c in columns],
                ],
                names=names,
            )

    return src.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True))).withColumnRenamed("id", id_column)
