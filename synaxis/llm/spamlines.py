"""Keyword-stuffed and link-list pages by a hidden Markov model over lines.

A text is cut into lines (and long lines into pieces); every piece becomes one symbol per feature:
links, tags, function words, sentence end, separators, repetition. A hidden Markov model with the
states prose, link list, tag list and menu (keyword and product lines) labels the sequence, so a short
piece takes its label from its neighbours. Function words are learned from the corpus, by how many texts
they stand in and how little of each they make up; for languages it does not know, very short words
stand in for them. The model starts from a prior, whose weight is a share of the corpus, and is trained
on all of it by expectation-maximisation until it stands still; expected counts are summed per
partition, so only tables of a few hundred numbers leave the tasks. A page is flagged by the share of
its words outside prose.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synaxis.session import cut

STATES = ("prose", "links", "tags", "menu")
PIECE_WORDS = 16
MAX_ROUNDS = 12
STILL = 0.005
PRIOR_SHARE = 0.05
THRESHOLD = 0.6

SHORT_WORD = 3
FUNCTION_WORD = 5
SPREAD_SHARE = 0.03
SPREAD_LEAST = 30
EVEN_SHARE = 0.05
MOST_SHARE = 0.06
LONG_TEXT = 30

_BREAK = re.compile(r"\n|<br\s*/?>|</?p\b[^>]*>|</?div\b[^>]*>|</?li\b[^>]*>|</?blockquote\b[^>]*>|\[/?quote[^\]]*\]", re.I)
_SENTENCE = re.compile(r"(?<=[.!?;…])\s+")
_LINK = re.compile(r"(?:https?://|www\.)\S+|<a\b[^>]*>|\[url[^\]]*\]", re.I)
_TAG = re.compile(r"(?<![\w/&])#\w+")
_WORD = re.compile(r"[^\W_]+")
_MARKUP = re.compile(r"<(?!a\b)[^>]{0,200}>|\[(?!url)/?\w+(?:=[^\]]{0,100})?\]", re.I)

#: Number of symbols of each feature, in the order of :func:`symbols`.
WIDTHS = (3, 3, 4, 2, 2, 3)


@dataclass
class Piece:
    symbols: tuple[int, ...]
    words: int


def _bucket(share: float, *bounds: float) -> int:
    return 0 if share <= 0 else 1 + sum(share >= b for b in bounds)


def spans_of(text: str | None) -> list[tuple[str, list[str]]]:
    """The pieces of a text with their words in lower case; none for null, empty or wordless texts."""
    if not text:
        return []
    clean = html.unescape(text).replace("\u00a0", " ").replace("\u00ad", "").replace("\u200b", "")
    spans: list[tuple[str, list[str]]] = []
    for line in _BREAK.split(clean):
        for sentence in _SENTENCE.split(line):
            sentence = _MARKUP.sub(" ", sentence).strip()
            if not sentence:
                continue
            part: list[str] = []
            words: list[str] = []
            for token in sentence.split():
                part.append(token)
                words += [w.lower() for w in _WORD.findall(token)]
                if len(words) >= PIECE_WORDS:
                    spans.append((" ".join(part), words))
                    part, words = [], []
            if words:
                spans.append((" ".join(part), words))
    return spans


def pieces(text: str | None, learned: frozenset[str] = frozenset()) -> list[Piece]:
    """The pieces of a text with their feature symbols.

    Function words are the ``learned`` ones and others of up to SHORT_WORD letters, unless in a text of LONG_TEXT
    words or more a learned one makes up more than MOST_SHARE of it or another more than EVEN_SHARE.
    """
    spans = spans_of(text)
    often = Counter(w for _, words in spans for w in words)
    total = sum(often.values())
    most, even = (MOST_SHARE * total, EVEN_SHARE * total) if total >= LONG_TEXT else (total, total)
    function = {w for w, k in often.items() if (k <= most if w in learned else len(w) <= SHORT_WORD and w.isalpha() and k <= even)}
    out = []
    for span, words in spans:
        n = len(words)
        link_words = sum(len(_WORD.findall(m)) for m in _LINK.findall(span))
        tag_words = sum(len(_WORD.findall(m)) for m in _TAG.findall(span))
        n_function = sum(w in function for w in words)
        repeated = sum(often[w] >= 4 and w not in function for w in words)
        out.append(
            Piece(
                (
                    _bucket(link_words / n, 0.3),
                    _bucket(tag_words / n, 0.3),
                    3 if n < 4 and not n_function else _bucket(n_function / n, 0.12),
                    int(span[-1:] in ".!?;:…"),
                    int("|" in span.lstrip("|> ")),  # at the start it marks a quote
                    0 if repeated / n < 0.25 else 1 if repeated / n < 0.6 else 2,
                ),
                n,
            )
        )
    return out


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, n, share): texts of a partition that hold a short enough word, and the sum of its shares of them."""
    n: Counter[str] = Counter()
    share: Counter[str] = Counter()
    for batch in batches:
        for text in batch["text"]:
            found = _WORD.findall(_MARKUP.sub(" ", text).lower())
            total = len(found)
            if total < LONG_TEXT:
                continue
            words = Counter(found)
            for w, k in words.items():
                if len(w) <= FUNCTION_WORD and w.isalpha():
                    n[w] += 1
                    share[w] += k / total
        if len(n) > 500_000:
            yield pd.DataFrame({"word": list(n), "n": list(n.values()), "share": [share[w] for w in n]})
            n, share = Counter(), Counter()
    if n:
        yield pd.DataFrame({"word": list(n), "n": list(n.values()), "share": [share[w] for w in n]})


def function_words(texts: DataFrame) -> frozenset[str]:
    """Words of up to FUNCTION_WORD letters in many of the texts (column text) that on average make up little of them.

    Many are SPREAD_SHARE of the texts of LONG_TEXT words or more, and at least SPREAD_LEAST; so there are at
    most (short words in a text) / SPREAD_SHARE of them, some thousands, in a corpus of any size.
    """
    found = texts.mapInPandas(_spread, "word string, n long, share double").groupBy("word").agg(F.sum("n").alias("n"), F.sum("share").alias("share"))
    frequent = found.filter((F.col("n") >= SPREAD_LEAST) & (F.col("share") <= EVEN_SHARE * F.col("n"))).filter(F.col("n") >= SPREAD_SHARE * texts.count())
    return frozenset(r.word for r in frequent.select("word").collect())


def _table(rows: list[list[float]]) -> np.ndarray:
    a = np.array(rows, dtype=float)
    return a / a.sum(axis=1, keepdims=True)


def prior() -> dict[str, list]:
    """The starting model: what each kind of line typically looks like, and that kinds persist."""
    emit = [
        _table([[90, 8, 2], [2, 8, 90], [95, 3, 2], [94, 5, 1]]),
        _table([[95, 4, 1], [95, 4, 1], [2, 8, 90], [96, 3, 1]]),
        _table([[5, 12, 78, 5], [70, 8, 2, 20], [75, 4, 1, 20], [74, 5, 1, 20]]),
        _table([[25, 75], [85, 15], [95, 5], [80, 20]]),
        _table([[99, 1], [95, 5], [98, 2], [60, 40]]),
        _table([[60, 35, 5], [50, 25, 25], [40, 30, 30], [10, 25, 65]]),
    ]
    move = _table([[94, 2, 2, 2], [6, 90, 2, 2], [8, 2, 88, 2], [5, 2, 2, 91]])
    start = _table([[85, 5, 4, 6]])[0]
    return {"emit": [e.tolist() for e in emit], "move": move.tolist(), "start": start.tolist()}


def _likelihoods(symbols: np.ndarray, model: dict) -> np.ndarray:
    """Likelihood of every piece (last axis: features) under every state."""
    out = np.ones((*symbols.shape[:-1], len(STATES)))
    for f, table in enumerate(model["emit"]):
        out *= np.asarray(table).T[symbols[..., f]]
    return out


def posterior(symbols: np.ndarray, lengths: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """State probabilities of every piece, and expected transitions per sequence.

    ``symbols`` is (sequence, piece, feature), padded to the longest; forward-backward with scaling,
    one step of all sequences at a time. Padded places have probability 0 in every state.
    """
    like, move, start = _likelihoods(symbols, model), np.asarray(model["move"]), np.asarray(model["start"])
    n_seq, n, k = like.shape
    inside = np.arange(n)[None, :] < lengths[:, None]
    like[~inside] = 1.0
    alpha, beta = np.empty((n_seq, n, k)), np.ones((n_seq, n, k))
    alpha[:, 0] = start * like[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, n):
        a = (alpha[:, i - 1] @ move) * like[:, i]
        alpha[:, i] = a / a.sum(axis=1, keepdims=True)
    for i in range(n - 2, -1, -1):
        b = (like[:, i + 1] * beta[:, i + 1]) @ move.T
        b /= b.sum(axis=1, keepdims=True)
        beta[:, i] = np.where(inside[:, i + 1, None], b, 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    gamma[~inside] = 0.0
    moves = np.zeros((n_seq, k, k))
    for i in range(n - 1):
        x = alpha[:, i, :, None] * move[None] * (like[:, i + 1] * beta[:, i + 1])[:, None, :]
        x /= x.sum(axis=(1, 2), keepdims=True)
        moves += np.where(inside[:, i + 1, None, None], x, 0.0)
    return gamma, moves


def _padded(flat: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, symbols, lengths) of a batch in groups of similar length and bounded size."""
    sizes = flat.map(len).to_numpy() // len(WIDTHS)
    order, at = np.argsort(sizes, kind="stable"), 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at) * sizes[order[end]] < 20_000:
            end += 1
        rows = order[at:end]
        lengths = sizes[rows]
        symbols = np.zeros((len(rows), lengths.max(), len(WIDTHS)), dtype=np.int64)
        for i, row in enumerate(rows):
            symbols[i, : lengths[i]] = np.reshape(flat.iloc[row], (-1, len(WIDTHS)))
        yield rows, symbols, lengths
        at = end


def _expect(model: dict):
    """Expected counts of a partition as (part, i, j, value) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        emit = [np.zeros((len(STATES), w)) for w in WIDTHS]
        move, start = np.zeros((len(STATES),) * 2), np.zeros(len(STATES))
        for batch in batches:
            times = batch["times"].to_numpy(dtype=float)
            for rows, symbols, lengths in _padded(batch["symbols"]):
                gamma, moves = posterior(symbols, lengths, model)
                weight = times[rows]
                start += weight @ gamma[:, 0]
                move += np.tensordot(weight, moves, 1)
                weighted = (gamma * weight[:, None, None]).reshape(-1, len(STATES))
                for f, table in enumerate(emit):
                    for state in range(len(STATES)):
                        table[state] += np.bincount(symbols[..., f].ravel(), weighted[:, state], WIDTHS[f])
        parts = enumerate([*emit, move, start[None, :]])
        yield pd.DataFrame(
            [(f, i, j, float(t[i, j])) for f, t in parts for i in range(t.shape[0]) for j in range(t.shape[1])],
            columns=["part", "i", "j", "value"],
        )

    return run


def train(sequences: DataFrame, max_rounds: int = MAX_ROUNDS) -> dict:
    """Expectation-maximisation over all sequences, held near the prior by PRIOR_SHARE of as many counts as they have.

    ``sequences`` has one row per distinct symbol sequence with the number of texts that have it. Rounds go on
    until no probability moves by more than STILL.
    """
    base = prior()
    model = base
    size = sequences.agg(F.coalesce(F.sum(F.size("symbols") * F.col("times")), F.lit(0)).alias("n"), F.coalesce(F.sum("times"), F.lit(0)).alias("k")).first()
    weight, weight_start = max(1.0, PRIOR_SHARE * size.n / len(WIDTHS)), max(1.0, PRIOR_SHARE * size.k)
    for _ in range(max_rounds):
        sums = sequences.mapInPandas(_expect(model), "part int, i int, j int, value double")
        counts = sums.groupBy("part", "i", "j").agg(F.sum("value").alias("value")).collect()  # under 200 numbers
        tables = [weight * np.asarray(t) for t in (*base["emit"], base["move"])] + [weight_start * np.asarray([base["start"]])]
        for r in counts:
            tables[r.part][r.i, r.j] += r.value
        tables = [t / t.sum(axis=1, keepdims=True) for t in tables]
        before = [np.asarray(t) for t in (*model["emit"], model["move"], [model["start"]])]
        model = {"emit": [t.tolist() for t in tables[:-2]], "move": tables[-2].tolist(), "start": tables[-1][0].tolist()}
        if max(float(np.abs(a - b).max()) for a, b in zip(before, tables, strict=True)) < STILL:
            break
    return model


def _features(learned: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [pieces(t, learned) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "symbols": [[s for p in ps for s in p.symbols] for ps in found], "words": [[p.words for p in ps] for ps in found]})

    return run


def _label(model: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shares = np.zeros((len(batch), len(STATES)))
            for rows, symbols, lengths in _padded(batch["symbols"]):
                best = posterior(symbols, lengths, model)[0].argmax(axis=2)
                for i, row in enumerate(rows):
                    words = np.asarray(batch["words"].iloc[row], dtype=float)
                    shares[row] = np.bincount(best[i, : lengths[i]], words, len(STATES)) / words.sum()
            yield pd.DataFrame({"id": batch["id"], **{name: shares[:, k] for k, name in enumerate(STATES)}})

    return run


def line_shares(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, prose, links, tags, menu): share of each text's words by kind of line.

    Texts that are null, empty or without words have no row. Equal texts and repeated rows get equal
    shares. An empty table gives no rows. Only the two named columns are read.
    """
    src = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    id_type = src.schema["id"].dataType.simpleString()
    pieced = cut(src.mapInPandas(_features(function_words(src.select("text"))), f"id {id_type}, symbols array<int>, words array<int>").filter(F.size("words") > 0))
    sequences = pieced.groupBy("symbols").agg(F.count(F.lit(1)).alias("times"))
    model = train(cut(sequences))
    out = pieced.mapInPandas(_label(model), f"id {id_type}, " + ", ".join(f"{s} double" for s in STATES))
    return out.withColumnRenamed("id", id_column)


def stuffed(shares: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Texts of which more than ``threshold`` of the words stand outside prose."""
    return shares.filter(1 - F.col("prose") > threshold)
