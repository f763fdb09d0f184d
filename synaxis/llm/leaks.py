"""Evaluation passages in a corpus, by suffix arrays over corpus shards.

Texts are reduced to words without looks (markup, case, accents, invisible characters). Equal test
texts are one. A shard of the corpus is a run of whole documents; its suffix array holds, in order,
every suffix that could match a test text at all, that is whose first SEED words occur in one. Every
suffix of every test text is placed in that order by binary search, and the stretch of the array around
its place that shares enough words with it gives all its verbatim matches with their lengths; how many
words are enough depends on how many test texts share them. The matches of a document with a test
text are chained in order, over interruptions and changed words, to the passage they are parts of, and
only then is judged how much of it is the text's own and how much boilerplate.

The test texts are written in blocks of bounded size to the shared folder; a task reads the blocks
one after the other against the shard it holds. So the corpus is read once however large the test
set is, never shuffled, and nothing of either comes to the driver.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synaxis.session import Cut

SEED = 3
MAX_ITEMS = 3
MANY_ITEMS = 10
MANY_SHARE = 0.1
MIN_PASSAGE = 13
MIN_MATCHED = 8
MIN_OWN = 6
OWN_SHARE = 0.5
MIN_NAMES = 2
MIN_SHARE = 0.4
MAX_GAP = 60
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 200_000
BLOCKS_HELD = 8
PAIRS_AT_ONCE = 2_000_000

#: Lengths of runs whose number of test texts is counted: single words, short runs, long ones.
SHORT_RUNS = (3, 4, 5, 6, 7, 8)
LONG_RUNS = (8, MIN_PASSAGE, 20, 32, 64)
RUNS = (1, *SHORT_RUNS, *LONG_RUNS[1:])
NEVER = 1 << 20

_MARKUP = re.compile(r"<[^<>]{0,300}>|\[/?[A-Za-z]+(?:=[^\[\]]{0,100})?\]")
_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}


def plain_words(text: str | None) -> list[str]:
    """The words of a text, free of markup, case, accents and invisible characters."""
    if not text:
        return []
    text = _MARKUP.sub(" ", html.unescape(text).translate(_INVISIBLE))
    text = unicodedata.normalize("NFKD", text.casefold())
    if not text.isascii():
        text = "".join(c for c in text if not unicodedata.combining(c)).replace("ς", "σ")
    return _WORD.findall(text)


# Letters and digits of the corpus' languages, as one class of a regular expression.
LETTERS = "0-9A-Za-zÀ-ÿΆ-ώ"
_EXACT = re.compile(f"[{LETTERS}]+")


def exact_words(text: str | None) -> list[str]:
    """The runs of letters and digits of a text just as they stand."""
    return _EXACT.findall(text) if text else []


Tokeniser = Callable[[str | None], list[str]]


def _worded(items: DataFrame, id_column: str, text_column: str, words_of: Tokeniser) -> DataFrame:
    """(item_id, words) of the items that have an id and at least SEED words."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def words_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(words_of)

    named = items.select(F.col(id_column).alias("item_id"), words_udf(F.col(text_column)).alias("words"))
    return named.filter((F.size("words") >= SEED) & F.col("item_id").isNotNull())


def run_counts(texts: DataFrame) -> DataFrame:
    """(text_id, counts): for each place of a text and each of RUNS in how many texts the run from there stands.

    ``counts`` is one list, place by place; 0 where the text ends before the run does.
    """

    def runs(length: int):
        starts = F.sequence(F.lit(1), F.size("words") - (length - 1))
        found = F.transform(starts, lambda i: F.struct(i.alias("pos"), F.lit(length).alias("len"), F.xxhash64(F.slice("words", i, length)).alias("run")))
        return F.when(F.size("words") >= length, found).otherwise(F.array().cast("array<struct<pos:int,len:int,run:bigint>>"))

    single = texts.select("text_id", F.inline(F.concat(*[runs(n) for n in RUNS])))
    counted = single.select("len", "run", "text_id").distinct().groupBy("len", "run").agg(F.count(F.lit(1)).alias("n"))
    by_place = single.join(counted, ["len", "run"]).groupBy("text_id", "pos").agg(
        F.array(*[F.coalesce(F.max(F.when(F.col("len") == n, F.col("n"))), F.lit(0)).cast("int") for n in RUNS]).alias("n")
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "n")))  # as long as the text
    return by_place.groupBy("text_id").agg(F.flatten(F.transform(ordered, lambda x: x["n"])).alias("counts"))


def own_length(counted: DataFrame, max_items: int) -> int:
    """The least length of runs, from SEED on, of which at least OWN_SHARE stand in no more than ``max_items`` texts.

    The more test texts there are, the longer a run must be to be anyone's own. Eleven numbers come to the driver.
    """
    cells = counted.select(F.posexplode("counts").alias("at", "n")).filter("n > 0").groupBy(F.pmod("at", F.lit(len(RUNS))).alias("k"))
    rows = cells.agg(F.avg((F.col("n") <= max_items).cast("double")).alias("rare")).collect()
    rare = {RUNS[r.k]: r.rare for r in rows}
    return next((length for length in SHORT_RUNS if rare.get(length, 0.0) >= OWN_SHARE), SHORT_RUNS[-1])


def suffix_needs(counts: np.ndarray, max_items: int, many: int, length: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(need, own, named) of the places of a text from the counts of its runs, one row per place.

    ``own``: ``length`` where the run of that length is in at most ``max_items`` texts, else 0; inside
    MIN_PASSAGE words that more, but not ``many``, texts share behind the opening that many have, any
    SEED words are own, as several questions may use one passage. ``need``: so many words a match from
    there must have to be reported, as many as at most ``max_items`` texts share or else a long run that
    not ``many`` do; where even long runs stand in ``many`` texts it must go on beyond them. Every match
    that holds a reported one is reported whole. ``named``: words that few hold.
    """
    n = dict(zip(RUNS, counts.T, strict=True))
    places = len(counts)
    own = np.where((n[length] > 0) & (n[length] <= max_items), length, 0)
    need = np.full(places, NEVER)
    for runs, most in ((LONG_RUNS, many - 1), (SHORT_RUNS, max_items)):
        for k in runs:
            ok = (n[k] > 0) & (n[k] <= most)
            need[ok] = np.minimum(need[ok], k)
    begun = np.flatnonzero((n[SEED] > 0) & (n[SEED] < many))
    shared = (n[MIN_PASSAGE] > max_items) & (n[MIN_PASSAGE] < many) & (np.arange(places) >= (begun[0] if len(begun) else places))
    reused = np.convolve(shared, np.ones(MIN_PASSAGE, dtype=np.int64))[:places] > 0
    inside = np.convolve(shared, np.ones(MIN_PASSAGE - SEED + 1, dtype=np.int64))[:places] > 0
    own[inside], need[inside] = SEED, SEED
    for i in range(places - 2, -1, -1):
        need[i] = min(need[i], need[i + 1] + 1)
    return need, own, (n[1] <= max_items) | reused & (n[1] < many)


def word_code(word: str) -> int:
    return xxhash.xxh64_intdigest(word) or 1


class Codes:
    """Word codes of a worker, remembered for the words seen lately."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 2_000_000:
            known.clear()
        return np.fromiter((known.get(w) or known.setdefault(w, word_code(w)) for w in words), dtype=np.uint64, count=len(words))


class TestBlock:
    """A block of test texts as numbers: (text id, words, need, own, named) for each text."""

    __test__ = False

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        lengths = np.array([len(r[1]) for r in rows], dtype=np.int64)
        codes = Codes()
        self.words = np.concatenate([codes.of(r[1]) for r in rows]) if rows else np.zeros(0, dtype=np.uint64)
        self.text = np.repeat(np.arange(len(rows)), lengths)
        self.first = np.cumsum(lengths) - lengths
        self.where = np.arange(len(self.words)) - np.repeat(self.first, lengths)
        self.need, self.own, self.named = (np.concatenate([np.asarray(r[k]) for r in rows]) if rows else np.zeros(0, dtype=np.int64) for k in (2, 3, 4))
        self.seeds, self.valid = seed_codes(self.words, self.text)
        self.known = np.unique(self.seeds[self.valid])

    def text_slice(self, i: int) -> slice:
        end = self.first[i + 1] if i + 1 < len(self.first) else len(self.words)
        return slice(int(self.first[i]), int(end))


_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def seed_codes(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number for the SEED words from each place on, and whether they are words of one text."""
    n = len(words)
    codes, valid = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    if n >= SEED:
        m = n - SEED + 1
        valid[:m] = owner[:m] == owner[SEED - 1 :]
        with np.errstate(over="ignore"):
            for k, mix in enumerate(_MIX):
                codes[:m] = (codes[:m] ^ words[k : m + k]) * mix
                codes[:m] ^= codes[:m] >> np.uint64(29)
    return codes, valid


def _steps(places: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(following, preceding): index of the next and the last place where it is the neighbour in the same text, else -1."""
    following, preceding = np.full(len(places), -1, dtype=np.int64), np.full(len(places), -1, dtype=np.int64)
    if len(places) > 1:
        at = np.flatnonzero((places[1:] == places[:-1] + 1) & (owner[1:] == owner[:-1]))
        following[at], preceding[at + 1] = at + 1, at
    return following, preceding


class Suffixes:
    """Suffixes of sequences of codes, ranked by prefix doubling; every level is kept to compare with.

    ``rank`` is the lexicographic rank of every suffix, equal for equal ones. On level k suffixes
    have equal ranks if their first 2^k codes are equal.
    """

    def __init__(self, codes: np.ndarray, following: np.ndarray):
        n = len(codes)
        rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        jump, left = following.copy(), np.ones(n, dtype=np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(rank, jump)]
        while (jump >= 0).any():
            left = left + np.where(jump >= 0, left[jump], 0)
            then = np.where(jump >= 0, rank[jump] + 1, 0)
            rank = np.unique(rank * (n + 2) + then, return_inverse=True)[1].astype(np.int64)
            jump = np.where(jump >= 0, jump[jump], -1)
            self.levels.append((rank, jump))
        self.rank, self.left = rank, left

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix, in codes, of pairs of suffixes."""
        most = np.minimum(self.left[i], self.left[j])
        total = np.zeros(len(i), dtype=np.int64)
        i, j = i.copy(), j.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            rank, jump = self.levels[k]
            same = (i >= 0) & (j >= 0)
            same[same] = rank[i[same]] == rank[j[same]]
            total[same] += 1 << k
            i[same], j[same] = jump[i[same]], jump[j[same]]
        return np.minimum(total, most)


def _edge(suffixes: Suffixes, order: np.ndarray, t: np.ndarray, least: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """The farthest place from ``inner`` towards ``outer`` up to which suffixes share ``least`` codes with t (exclusive).

    Common prefixes only get shorter away from a suffix's own place, so this is a binary search.
    """
    way = np.sign(outer - inner)
    near, far = np.zeros(len(t), dtype=np.int64), np.abs(outer - inner)
    while (open_ := near < far).any():
        middle = (near + far) // 2
        at = inner + way * middle - (way < 0)
        ok = np.zeros(len(t), dtype=bool)
        ok[open_] = suffixes.common(t[open_], order[at[open_]]) >= least[open_]
        near = np.where(open_ & ok, middle + 1, near)
        far = np.where(open_ & ~ok, middle, far)
    return inner + way * near


def find_matches(words: np.ndarray, doc: np.ndarray, test: TestBlock) -> pd.DataFrame:
    """Maximal verbatim matches (doc, item, d, t, n) of a shard: n words from d on and from t on of the item.

    A maximal match is reported if at some place of it the words that follow there are as many as that place of
    the item needs.
    """
    empty = pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in ("doc", "item", "d", "t", "n")})
    seeds, valid = seed_codes(words, doc)
    if not len(test.known) or not len(seeds):
        return empty
    at = np.minimum(np.searchsorted(test.known, seeds), len(test.known) - 1)
    place = np.flatnonzero(valid & (test.known[at] == seeds))
    if not len(place):
        return empty
    code, owner = seeds[place], doc[place]
    here = np.unique(code)
    at = np.minimum(np.searchsorted(here, test.seeds), len(here) - 1)
    asked = np.flatnonzero(test.valid & (here[at] == test.seeds))  # suffixes that begin with words of the shard
    n = len(place)
    d_next, d_last = _steps(place, owner)
    t_next, t_last = _steps(asked, test.text[asked])
    suffixes = Suffixes(np.concatenate([code, test.seeds[asked]]), np.concatenate([d_next, np.where(t_next >= 0, t_next + n, -1)]))
    order = np.argsort(suffixes.rank[:n], kind="stable")  # the suffix array of the shard
    mine = np.arange(n, n + len(asked))
    put = np.searchsorted(suffixes.rank[order], suffixes.rank[mine])
    least = test.need[asked] - (SEED - 1)
    first = _edge(suffixes, order, mine, least, put, np.zeros(len(asked), dtype=np.int64))
    end = _edge(suffixes, order, mine, least, put, np.full(len(asked), n))
    count = end - first
    found = []
    cuts = np.searchsorted(np.cumsum(count), np.arange(0, count.sum(), PAIRS_AT_ONCE)[1:])
    for part in np.split(np.arange(len(asked)), np.unique(cuts + 1)):
        k = count[part]
        if not k.sum():
            continue
        t = np.repeat(part, k)
        d = order[np.repeat(first[part], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
        before_d, before_t = d_last[d], t_last[t]
        inner = (before_d >= 0) & (before_t >= 0)
        inner[inner] = code[before_d[inner]] == test.seeds[asked[before_t[inner]]]
        t, d = t[~inner], d[~inner]
        length = suffixes.common(t + n, d) + SEED - 1
        found.append(pd.DataFrame({"doc": owner[d], "item": test.text[asked[t]], "d": place[d], "t": test.where[asked[t]], "n": length}))
    return pd.concat(found, ignore_index=True) if found else empty


def own_parts(test: TestBlock, item: int, t: np.ndarray, n: np.ndarray, begin: int, end: int) -> tuple[int, int, int, int]:
    """(own runs, words in them, names matched, names in all) of matches of an item between two of its words."""
    first = test.first[item]
    runs, words, mine = np.zeros(end - begin, dtype=bool), np.zeros(end - begin, dtype=bool), np.zeros(end - begin + 1, dtype=np.int64)
    own = test.own[first + begin : first + end]
    for a, m in zip((t - begin).tolist(), n.tolist(), strict=True):
        words[a : a + m] = True
        starts = a + np.flatnonzero((own[a : a + m] > 0) & (np.arange(m) + own[a : a + m] <= m))
        runs[starts] = True
        np.add.at(mine, starts, 1)
        np.add.at(mine, starts + own[starts], -1)
    names = test.named[first + begin : first + end]
    return int(runs.sum()), int((np.cumsum(mine)[:-1] > 0).sum()), int((names & words).sum()), int(names.sum())


def near_matches(words: np.ndarray, doc: np.ndarray, test: TestBlock, i: int, item: int, at: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, t, n): all maximal matches of an item with a document, boilerplate too, near its own ones from ``at`` until ``until``."""
    begin, end = np.searchsorted(doc, [i, i + 1])
    a, b = max(begin, int(at.min()) - MAX_GAP), min(end, int(until.max()) + MAX_GAP)
    seeds, valid = seed_codes(words[a:b], doc[a:b])
    mine = test.text_slice(item)
    places, codes = np.flatnonzero(test.valid[mine]), test.seeds[mine]
    places = places[np.argsort(codes[places], kind="stable")]
    asked = np.flatnonzero(valid)
    low, high = (np.searchsorted(codes[places], seeds[asked], side=side) for side in ("left", "right"))
    k = high - low
    place = np.repeat(asked, k)
    where = places[np.repeat(low, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
    # seeds on one diagonal that follow each other are one match
    order = np.lexsort((place, where - place))
    place, where = place[order], where[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(where) != 1)])
    return place[starts] + a, where[starts], np.diff(np.r_[starts, len(place)]) + SEED - 1


def chain(d: np.ndarray, t: np.ndarray, n: np.ndarray, max_gap: int = MAX_GAP) -> tuple[int, int, int, int, np.ndarray]:
    """The best chain of matches in order in both texts: (matched, item span, first, last place, its matches).

    Neighbours in a chain are at most ``max_gap`` words apart in either text, from the end of one to
    the start of the next; overlaps count once.
    """
    order = np.lexsort((t, d))
    d, t, n = (x[order].tolist() for x in (d, t, n))
    longest = max(n, default=0)
    best: list[tuple[int, int, int, int]] = []
    top, at = 0, -1
    for j in range(len(d)):
        here = (n[j], t[j], d[j], -1)
        i = j - 1
        while i >= 0 and d[j] - d[i] <= max_gap + longest:
            d_gap, t_gap = d[j] - (d[i] + n[i]), t[j] - (t[i] + n[i])
            if d_gap <= max_gap and t_gap <= max_gap and d[i] < d[j] and t[i] < t[j]:
                gain = n[j] - max(0, -d_gap, -t_gap)
                if gain > 0 and best[i][0] + gain > here[0]:
                    here = (best[i][0] + gain, best[i][1], best[i][2], i)
            i -= 1
        best.append(here)
        if here[0] > top:
            top, at = here[0], j
    if at < 0:
        return 0, 0, 0, 0, order[:0]
    path = [at]
    while best[path[-1]][3] >= 0:
        path.append(best[path[-1]][3])
    return top, t[at] + n[at] - best[at][1], best[at][2], d[at] + n[at], order[path]


def passages(words: np.ndarray, doc: np.ndarray, test: TestBlock, min_passage: int, min_matched: int, min_own: int, min_share: float):
    """(doc, item, matched, own words, span, first, last) of the chains of a shard that are long enough.

    An instruction, or a turn of phrase that many items share, is no passage however long the match. A chain
    is the item's own by ``min_own`` own runs. As each changed word takes several runs from a passage, as
    many words in own runs do where the chain also holds two names (words and numbers that few texts
    hold) and at least half of those in its span. Boilerplate around own matches that
    make no passage alone is matched too, since turns of phrase are part of one.
    """
    found = find_matches(words, doc, test)
    for (i, item), g in found.groupby(["doc", "item"], sort=False):
        d, t, n = (g[c].to_numpy() for c in ("d", "t", "n"))
        if own_parts(test, item, t, n, t.min(), (t + n).max())[1] < min_own:
            continue
        for again in (False, True):
            if again:
                d, t, n = near_matches(words, doc, test, i, item, d, d + n)
            matched, span, first, last, path = chain(d, t, n)
            begin = t[path].min()
            runs, mine, names, all_names = own_parts(test, item, t[path], n[path], begin, begin + span)
            own = runs >= min_own or mine >= min_own and names >= MIN_NAMES and 2 * names >= all_names
            if span >= min_passage and matched >= min_matched and own and matched >= min_share * span:
                yield i, item, matched, mine, span, first, last
                break


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there, for reading in a task."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", path)))
    return pafs.LocalFileSystem(), path


_HELD: OrderedDict[tuple[str, int], TestBlock] = OrderedDict()


def held_block(path: str, block: int, build: Callable[[list[dict]], TestBlock]) -> TestBlock:
    """A block of test texts from the shared folder; a worker holds the last few."""
    key = (path, block)
    if key not in _HELD:
        fs, at = open_folder(f"{path}/block={block}")
        rows = pads.dataset(at, filesystem=fs, format="parquet").to_table().to_pylist() if fs.get_file_info(at).type != pafs.FileType.NotFound else []
        _HELD[key] = build(rows)
        while len(_HELD) > BLOCKS_HELD:
            _HELD.popitem(last=False)
    _HELD.move_to_end(key)
    return _HELD[key]


def _search(
    corpus: DataFrame, doc_column: str, text_column: str, texts: Cut, n_blocks: int, words_of: Tokeniser,
    build: Callable[[list[dict]], TestBlock], judge: Callable, columns: list[str], text_type: str,
) -> DataFrame:
    """(doc_id, text_id, columns): what ``judge`` yields as (doc, text, *columns) for every shard and block."""
    docs = corpus.select(F.col(doc_column).alias("doc_id"), F.col(text_column).alias("text")).filter("text is not null")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    names, path = ["doc_id", "text_id", *columns], texts.path

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()

        def flush(ids: list, parts: list[np.ndarray]) -> pd.DataFrame:
            lengths = np.array([len(p) for p in parts])
            words, doc = np.concatenate(parts), np.repeat(np.arange(len(parts)), lengths)
            rows = []
            for b in range(n_blocks):
                test = held_block(path, b, build)
                rows += [(ids[i], test.ids[item], *rest) for i, item, *rest in judge(words, doc, np.cumsum(lengths) - lengths, test)]
            return pd.DataFrame(rows, columns=names)

        ids, parts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch["doc_id"], batch["text"], strict=True):
                own = codes.of(words_of(text))
                if len(own) >= SEED:
                    ids.append(i), parts.append(own)
                    size += len(own)
                if size >= SHARD_WORDS:
                    yield flush(ids, parts)
                    ids, parts, size = [], [], 0
        if size:
            yield flush(ids, parts)

    return docs.mapInPandas(run, f"doc_id {doc_type}, text_id {text_type}, " + ", ".join(f"{c} int" for c in columns))


def _written(worded: DataFrame, counted: bool) -> tuple[Cut, int, int]:
    """The distinct texts, with the counts of their runs if asked for, in blocks of about BLOCK_WORDS words in the shared folder; and how many blocks and texts."""
    texts = Cut(worded.groupBy("words").agg(F.min("item_id").alias("text_id")))
    total = texts.df.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k")).first()
    n_blocks = max(1, -(-int(total.n) // BLOCK_WORDS))
    out = texts.df.join(run_counts(texts.df), "text_id") if counted else texts.df
    blocks = Cut(out.withColumn("block", F.pmod(F.xxhash64("text_id"), F.lit(n_blocks)).cast("int")).repartition(n_blocks, "block"), "block")
    return blocks, n_blocks, int(total.k)


def leaks(
    corpus: DataFrame, doc_column: str, text_column: str, items: DataFrame, item_column: str, item_text: str,
    min_passage: int = MIN_PASSAGE, min_matched: int = MIN_MATCHED, min_own: int = MIN_OWN,
    min_share: float = MIN_SHARE, max_items: int = MAX_ITEMS,
) -> DataFrame:
    """(doc_id, item_id, matched_words, own_words, passage_words, first_word, last_word): leaked passages.

    One row per document and item; ``passage_words`` is what the chain spans in the item, and
    the places are word numbers in the document. Null and empty texts match nothing; items without id
    have no row; repeated documents and items are found once for each row; an empty corpus or no items
    give no rows. ``own_words`` are matched words in runs that at most ``max_items`` texts hold. Many
    texts, whose common words are boilerplate, are MANY_SHARE of them and at least MANY_ITEMS, or most
    of a few. ``min_passage`` lies below the wanted length by what changed words at the ends may hide.
    """
    worded = Cut(_worded(items, item_column, item_text, plain_words)).df
    blocks, n_blocks, n_texts = _written(worded, True)
    many = max(max_items + 1, min(n_texts // 2 + 1, max(MANY_ITEMS, int(MANY_SHARE * n_texts))))
    length = own_length(blocks.df, max_items)

    def build(rows: list[dict]) -> TestBlock:
        return TestBlock([(r["text_id"], r["words"], *suffix_needs(np.reshape(r["counts"], (-1, len(RUNS))), max_items, many, length)) for r in rows])

    def judge(words, doc, begins, test):
        for i, item, matched, mine, span, first, last in passages(words, doc, test, min_passage, min_matched, min_own, min_share):
            yield i, item, matched, mine, span, int(first - begins[i]), int(last - begins[i])

    columns = ["matched_words", "own_words", "passage_words", "first_word", "last_word"]
    found = _search(corpus, doc_column, text_column, blocks, n_blocks, plain_words, build, judge, columns, items.schema[item_column].dataType.simpleString())
    return _each_item(found, worded, blocks, columns)


def _each_item(found: DataFrame, worded: DataFrame, blocks: Cut, columns: list[str]) -> DataFrame:
    """Findings of a text for every item that has it."""
    of_text = worded.join(blocks.df.select("words", "text_id"), "words").select("item_id", "text_id")
    return found.join(of_text, "text_id").select("doc_id", "item_id", *columns)


def verbatim(
    corpus: DataFrame, doc_column: str, text_column: str, items: DataFrame, item_column: str, item_text: str, min_words: int = MIN_PASSAGE,
) -> DataFrame:
    """(doc_id, item_id, first_word, item_word, n_words): every maximal run of equal words, from ``min_words`` on.

    Words are compared just as they stand (:func:`exact_words`), boilerplate is no exception, and all matches
    of a document with an item are given. Otherwise as :func:`leaks`.
    """
    worded = Cut(_worded(items, item_column, item_text, exact_words)).df
    blocks, n_blocks, _ = _written(worded, False)

    def build(rows: list[dict]) -> TestBlock:
        every = [(r["text_id"], r["words"], np.full(len(r["words"]), min_words), np.zeros(len(r["words"]), dtype=np.int64), np.zeros(len(r["words"]), dtype=bool)) for r in rows]
        return TestBlock(every)

    def judge(words, doc, begins, test):
        for r in find_matches(words, doc, test).itertuples(index=False):
            yield r.doc, r.item, int(r.d - begins[r.doc]), int(r.t), int(r.n)

    columns = ["first_word", "item_word", "n_words"]
    found = _search(corpus, doc_column, text_column, blocks, n_blocks, exact_words, build, judge, columns, items.schema[item_column].dataType.simpleString())
    return _each_item(found, worded, blocks, columns)
