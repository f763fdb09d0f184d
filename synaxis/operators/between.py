"""Exact betweenness of a graph whose arcs fit into every task: Brandes' method from single vertices.

Tasks read the arcs from the shared folder, once per Python worker, and share the sources. A level is
added up along the arcs of its own vertices, along those of the vertices looked for, or along all, whichever
are fewest; in a two-sided graph only along those that begin on one side. Work is vertices x arcs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synaxis.session import Cut

TASK_SOURCES = 1000
TASKS_PER_CORE = 8


class Arcs:
    """Arcs in rows per vertex, both directions of every edge; the sides of a two-sided graph are numbered one after the other."""

    def __init__(self, src: np.ndarray, dst: np.ndarray, n: int):
        side = _sides(src, dst, n)
        self.order = np.argsort(side, kind="stable")  # the former number of each vertex
        self.place = np.empty(n, dtype=np.intp)
        self.place[self.order] = np.arange(n)
        begins, ends = self.place[src], self.place[dst]
        by = np.lexsort((ends, begins))
        self.n, self.ends, self.degree = n, ends[by], np.bincount(begins, minlength=n)
        self.start = np.concatenate([[0], np.cumsum(self.degree)])
        middle = int((side == 0).sum())
        two = 0 < middle < n and not (side[src] == side[dst]).any()
        self.blocks = [(0, middle), (middle, n)] if two else [(0, n)]
        self._room = np.empty(len(self.ends))

    def _targets(self, near: np.ndarray) -> tuple[int, int]:
        """Bounds of the vertices that can be next to ``near``, which are all on one side."""
        return self.blocks[1 if near[0] < self.blocks[0][1] else 0] if len(self.blocks) == 2 else self.blocks[0]

    def _places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the arcs of some vertices, row after row, and where each row begins."""
        n = self.degree[rows]
        begins = np.cumsum(n) - n
        return np.repeat(self.start[rows] - begins, n) + np.arange(n.sum()), begins

    def _sums(self, rows: np.ndarray, value: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Sum of ``value`` over the neighbours of each of ``rows``; only ``held`` have one other than 0."""
        if len(rows) == 0:
            return np.zeros(0)
        lo, hi = self._targets(held)
        first, last = self.start[lo], self.start[hi]
        own, theirs = 3 * self.degree[rows].sum(), 3 * self.degree[held].sum()  # single places cost about three times
        if theirs < min(own, last - first):
            at, _ = self._places(held)
            return np.bincount(self.ends.take(at), np.repeat(value[held], self.degree[held]), self.n)[rows]
        if own < last - first:
            at, begins = self._places(rows)
            return np.add.reduceat(value.take(self.ends.take(at)), begins)
        along = value.take(self.ends[first:last], out=self._room[: last - first], mode="clip")
        return np.add.reduceat(along, self.start[lo:hi] - first)[rows - lo]

    def add(self, s: int, total: np.ndarray) -> None:
        """Add to ``total`` what depends on each vertex for the shortest paths that begin at ``s``."""
        sigma, value, unseen = np.zeros(self.n), np.zeros(self.n), np.ones(self.n, dtype=bool)
        sigma[s], unseen[s] = 1.0, False
        levels = [np.array([s])]
        while True:
            near = levels[-1]
            lo, hi = self._targets(near)
            rows = lo + np.flatnonzero(unseen[lo:hi])
            value[near] = sigma[near]
            paths = self._sums(rows, value, near)
            value[near] = 0.0
            rows, paths = rows[paths > 0], paths[paths > 0]
            if len(rows) == 0:
                break
            sigma[rows], unseen[rows] = paths, False
            levels.append(rows)
        delta = np.zeros(len(levels[-1]))
        for below, rows in zip(levels[:0:-1], levels[-2::-1]):
            total[below] += delta
            value[below] = (1.0 + delta) / sigma[below]
            delta = sigma[rows] * self._sums(rows, value, below)
            value[below] = 0.0


def _sides(src: np.ndarray, dst: np.ndarray, n: int) -> np.ndarray:
    """1 where the distance from the first vertex of the component is odd, else 0."""
    start = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=n))])
    ends = dst[np.argsort(src, kind="stable")]
    side = np.full(n, -1, dtype=np.int8)
    for v in range(n):
        if side[v] < 0:
            side[v], near, odd = 0, np.array([v]), 0
            while len(near):
                near = np.unique(np.concatenate([ends[start[u] : start[u + 1]] for u in near]))
                near, odd = near[side[near] < 0], 1 - odd
                side[near] = odd
    return side


@lru_cache(maxsize=1)
def _read(path: str) -> tuple[pd.Index, Arcs]:
    """Vertices and arcs of a table (src, dst) in the shared folder; kept for the worker's next task."""
    fs, at = pafs.LocalFileSystem(), path
    if re.match(r"^\w+:/", path):
        fs, at = pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", path)))
    table = pads.dataset(at, filesystem=fs, format="parquet").to_table(columns=["src", "dst"])
    both = pa.chunked_array(table["src"].chunks + table["dst"].chunks).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy(zero_copy_only=False)
    return pd.Index(both.dictionary.to_pandas()), Arcs(codes[: len(table)], codes[len(table) :], len(both.dictionary))


def _from_sources(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                names, arcs = _read(path)
                total = np.zeros(arcs.n) if total is None else total
                for s in arcs.place[names.get_indexer(frame["v"])]:
                    arcs.add(s, total)
        if total is not None:
            yield pd.DataFrame({"v": names[arcs.order], "score": total / 2})

    return run


def scores(arcs: Cut, vertices: DataFrame, n_vertices: int) -> DataFrame:
    """(v, score) of every vertex (v) of the written arcs (src, dst), which hold both directions of every edge."""
    most = TASKS_PER_CORE * vertices.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(1, -(-n_vertices // TASK_SOURCES)), most)
    parts = vertices.repartition(tasks, "v").mapInPandas(_from_sources(arcs.path), f"v {vertices.schema['v'].dataType.simpleString()}, score double")
    return parts.groupBy("v").agg(F.sum("score").alias("score"))
