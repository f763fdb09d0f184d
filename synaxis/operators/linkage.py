"""Probabilistic record linkage: string similarity on distinct pairs, comparison levels, EM."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from synaxis.session import cut


def jaro_winkler(a: str | None, b: str | None, scale: float = 0.1, prefix: int = 4) -> float | None:
    """Jaro-Winkler similarity; null if either side is, 1 for two empty texts."""
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used_b = [False] * len(b)
    hits_a = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used_b[j] and b[j] == c:
                used_b[j] = True
                hits_a.append(c)
                break
    m = len(hits_a)
    if not m:
        return 0.0
    hits_b = [c for c, u in zip(b, used_b, strict=True) if u]
    swaps = sum(x != y for x, y in zip(hits_a, hits_b, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    same = 0
    for x, y in zip(a[:prefix], b[:prefix], strict=False):
        if x != y:
            break
        same += 1
    return jaro + same * scale * (1 - jaro) if jaro > 0.7 else jaro


def score_pairs(pairs: DataFrame, left: str, right: str, name: str = "jw") -> DataFrame:
    """Add the similarity of two text columns, computed once per distinct pair of texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [jaro_winkler(a, b) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch.assign(score=pd.Series(scores, index=batch.index, dtype="float64"))

    texts = pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null").distinct()
    scored = texts.mapInPandas(run, "a string, b string, score double").withColumnsRenamed({"a": left, "b": right, "score": name})
    return pairs.join(scored, [left, right], "left")


def close_match(name: str, names: list[str], cutoff: float = 0.75) -> str | None:
    """The closest of a short list of names by matching-block ratio, or None below the cutoff."""
    found = difflib.get_close_matches(name, names, n=1, cutoff=cutoff)
    return found[0] if found else None


def relabel(existing: DataFrame, labels: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """``existing`` with the labels of a policy; raises where a label given before differs, unless ``force``."""
    both = existing.join(labels.withColumnRenamed("label", "__label"), keys, "left")
    given = F.trim(F.coalesce("label", F.lit("")))
    if not force and not both.filter((given != "") & (given != F.coalesce("__label", F.lit("")))).isEmpty():
        raise ValueError("labels given before differ from the policy")
    return both.withColumn("label", F.col("__label")).drop("__label")


OFFICIAL_NAMES = 50_000
RANDOM_PAIRS = 2_000_000


def _letter_counts(names: list[str]) -> tuple[np.ndarray, dict[str, int]]:
    letters = {c: i for i, c in enumerate(sorted({c for n in names for c in n}))}
    counts = np.zeros((len(names), len(letters) + 1), dtype=np.int16)
    for row, name in enumerate(names):
        for c in name:
            counts[row, letters[c]] += 1
    return counts, letters


def match_official(names: DataFrame, official: DataFrame, cutoff: float = 0.75) -> DataFrame:
    """(name, kind, reason, match_type, official_name, similarity): names against a catalogue, equal or closest.

    ``names`` has name, kind and reason (why it is no candidate); ``official`` has distinct names. A name is
    ``exact``, else ``fuzzy`` with the closest official name by matching blocks from ``cutoff`` on (of equal ones the
    last in sort order, as the closest are listed), else ``missing``; one without a kind is ``excluded``. Names equal in letters bound
    the ratio, so few are compared in full. The catalogue is sent to the tasks and may hold OFFICIAL_NAMES
    names; a larger one raises, as it is no catalogue any more.
    """
    spark = names.sparkSession
    rows = official.filter("name is not null").select("name").distinct().limit(OFFICIAL_NAMES + 1).collect()
    if len(rows) > OFFICIAL_NAMES:
        raise ValueError(f"more than {OFFICIAL_NAMES} official names")
    sent = spark.sparkContext.broadcast(sorted(r.name for r in rows))

    def closest(name: str, known: list[str], counts: np.ndarray, letters: dict[str, int], lengths: np.ndarray) -> tuple[str | None, float | None]:
        mine = np.zeros(counts.shape[1], dtype=np.int16)
        for c in name:
            mine[letters.get(c, counts.shape[1] - 1)] += 1
        mine[-1] = 0
        bound = 2.0 * np.minimum(counts, mine).sum(axis=1) / np.maximum(lengths + len(name), 1)
        matcher = difflib.SequenceMatcher()
        matcher.set_seq2(name)
        best: tuple[float, str] | None = None
        for i in np.flatnonzero(bound >= cutoff - 1e-9):
            matcher.set_seq1(known[i])
            r = matcher.ratio()
            if r >= cutoff and (best is None or (r, known[i]) > best):
                best = (r, known[i])
        return (None, None) if best is None else (best[1], round(difflib.SequenceMatcher(None, name, best[1]).ratio(), 3))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        whole = set(known)
        counts, letters = _letter_counts(known)
        lengths = np.array([len(n) for n in known], dtype=np.int64)
        for batch in batches:
            found = []
            for name, kind in zip(batch["name"], batch["kind"], strict=True):
                if kind is None:
                    found.append(("excluded", None, None))
                elif name in whole:
                    found.append(("exact", name, None))
                else:
                    near, ratio = closest(name, known, counts, letters, lengths) if known else (None, None)
                    found.append(("fuzzy" if near else "missing", near, ratio))
            out = pd.DataFrame(found, columns=["match_type", "official_name", "similarity"], index=batch.index)
            yield pd.concat([batch[["name", "kind", "reason"]], out.astype({"similarity": "float64"})], axis=1)

    return names.select("name", "kind", "reason").mapInPandas(run, "name string, kind string, reason string, match_type string, official_name string, similarity double")


def comparison_level(score):
    """2: nearly equal, 1: similar, 0: different; null scores are different."""
    return F.when(score >= 0.9, 2).when(score >= 0.7, 1).otherwise(0)


def expectation_maximisation(counts: dict[int, int], u: list[float], prior: float = 0.1, rounds: int = 50) -> tuple[list[float], float]:
    """(m, prior): match-level probabilities from pair counts per level; three numbers on the driver."""
    n = np.array([counts.get(k, 0) for k in range(3)], dtype=float)
    m, u_ = np.array([0.1, 0.2, 0.7]), np.asarray(u)
    for _ in range(rounds):
        w = prior * m / (prior * m + (1 - prior) * u_)
        hits = n * w
        if hits.sum() == 0:
            break
        m, prior = np.maximum(hits / hits.sum(), 1e-6), float(np.clip(hits.sum() / n.sum(), 1e-6, 1 - 1e-6))
    return m.tolist(), prior


def link_probability(pairs: DataFrame, score: str, u_pairs: DataFrame) -> DataFrame:
    """Add ``level`` and ``probability``; u comes from ``u_pairs`` (mostly unrelated), m from EM on ``pairs``."""
    levelled = pairs.withColumn("level", comparison_level(F.col(score)))
    counts = {r.level: r.n for r in levelled.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}  # three rows
    seen = {r.level: r.n for r in u_pairs.groupBy(comparison_level(F.col(score)).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(seen.values())
    u = [(seen.get(k, 0) + 1) / (total + 3) for k in range(3)]
    m, prior = expectation_maximisation(counts, u)
    odds = [prior * m[k] / (prior * m[k] + (1 - prior) * u[k]) for k in range(3)]
    p = F.when(F.col("level") == 2, odds[2]).when(F.col("level") == 1, odds[1]).otherwise(odds[0])
    return levelled.withColumn("probability", p)


def prior_by_rule(records: DataFrame, key: str, recall: float) -> float:
    """Probability that two records at random match: pairs that agree in ``key``, of which a rule finds ``recall``.

    Pairs are counted from group sizes, not enumerated; two numbers come to the driver.
    """
    n = records.count()
    sizes = records.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("c"))
    found = sizes.agg(F.coalesce(F.sum(F.col("c") * (F.col("c") - 1) / 2), F.lit(0.0)).alias("p")).first().p
    return float(np.clip(found / recall / max(1.0, n * (n - 1) / 2), 1e-9, 0.5))


def blocked_pairs(records: DataFrame, id_column: str, keys: list[str]) -> DataFrame:
    """(id_l, id_r, key): pairs of records, the smaller id first, that agree in a key; once under the first key they share."""
    out = None
    for i, key in enumerate(keys):
        a = records.select(F.col(id_column).alias("id_l"), F.col(key).alias("__k"), *[F.col(k).alias(f"{k}_l") for k in keys[:i]])
        b = records.select(F.col(id_column).alias("id_r"), F.col(key).alias("__k"), *[F.col(k).alias(f"{k}_r") for k in keys[:i]])
        joined = a.join(b, "__k").filter("id_l < id_r")
        for k in keys[:i]:
            joined = joined.filter(~F.coalesce(F.col(f"{k}_l") == F.col(f"{k}_r"), F.lit(False)))
        part = joined.select("id_l", "id_r", F.lit(key).alias("key"))
        out = part if out is None else out.unionByName(part)
    return out


def dedupe_probabilities(records: DataFrame, id_column: str, name: str, rule: str, block: str, recall: float = 0.7, threshold: float = 0.5) -> DataFrame:
    """(id_l, id_r, jw, level, probability): candidate pairs of two blocking keys whose match is at least ``threshold``.

    Fellegi and Sunter with one comparison, the Jaro-Winkler similarity of names in three levels. The prior comes from
    the group sizes of ``rule``; how often unrelated names agree (u) from about RANDOM_PAIRS pairs of records that
    an order by hash puts side by side; how often matching ones do (m) from expectation-maximisation over the pairs of ``block``.
    """
    names = records.select(F.col(id_column).alias("id"), F.col(name).alias("n")).filter("n is not null")
    pairs = cut(
        blocked_pairs(records, id_column, [rule, block])
        .join(names.withColumnsRenamed({"id": "id_l", "n": "name_l"}), "id_l").join(names.withColumnsRenamed({"id": "id_r", "n": "name_r"}), "id_r")
    )
    scored = cut(score_pairs(pairs, "name_l", "name_r").withColumn("level", comparison_level(F.col("jw"))))
    n = names.count()
    places = range(1, 1 + int(np.clip(RANDOM_PAIRS // max(1, n), 1, 50)))
    order = Window.partitionBy(F.pmod(F.xxhash64("id"), F.lit(max(1, n // 10_000)))).orderBy(F.xxhash64("id", F.lit(1)), "id")
    beside = names.withColumns({f"n{k}": F.lead("n", k).over(order) for k in places})
    apart = beside.select(F.col("n").alias("name_l"), F.explode(F.array(*[f"n{k}" for k in places])).alias("name_r")).filter("name_r is not null")
    levels = lambda df: {r.level: r.n for r in df.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}  # noqa: E731  three rows
    seen = levels(score_pairs(apart, "name_l", "name_r").withColumn("level", comparison_level(F.col("jw"))))
    total = sum(seen.values())
    u = [(seen.get(k, 0) + 1) / (total + 3) for k in range(3)]
    m, _ = expectation_maximisation(levels(scored.filter(F.col("key") == block)), u)
    prior = prior_by_rule(records, rule, recall)
    odds = [prior * m[k] / (prior * m[k] + (1 - prior) * u[k]) for k in range(3)]
    p = F.when(F.col("level") == 2, odds[2]).when(F.col("level") == 1, odds[1]).otherwise(odds[0])
    return scored.withColumn("probability", p).filter(F.col("probability") >= threshold).select("id_l", "id_r", "jw", "level", "probability")
