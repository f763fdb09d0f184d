"""Variant spellings of names, linked by suffix blocking and the longest-common-subsequence ratio.

Names are taken apart into phonetic tokens; words that stand beside many others (trades, kinds of
organisation), legal forms and first names are set aside and kept as further fields, and the telling
token is indexed under each of its suffixes above a minimum length, whole, as it is, read backwards, and
with its last letters cut, so that a slip anywhere leaves one. Overly common suffixes are refined with
other fields (the letters before the suffix, with slips allowed for, and the tax id) and discarded only where
a refined one is still overly common. Tokens that meet under a key are compared by the ratio of their
longest common subsequence, once per distinct spelling; only the classes of equal records of similar
spellings are then compared by the other fields.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synaxis.llm import nameforms as N
from synaxis.session import cut

MIN_SUFFIX = 4
SHORT_TOKEN = 8
CUT_LETTERS = (2, 3, 4)
CUT_STARTS = 6
COMMON_KEY = 200
MIN_RATIO = 5 / 6
MIN_RATIO_SHORT = 0.9
HOT_TOKEN = 1000
TRADE_LEAST = 4
TRADE_OF_WORDS = 0.004
TRADE_SHARE = 0.5
DEGREE_CAP = 64
DEGREE_PIECES = 64
FORMS = {"sound": 1, "spelling": -1}
OF_FORMS = [f"{form}_{x}" for form in FORMS for x in ("letters", "bag")]


def common_tokens(names: DataFrame, share: float, least: int) -> list[str]:
    """Token sounds that stand in at least ``share`` of the rows of ``name`` (at most words-per-name / share of them)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(s, n) for name, n in zip(batch["name"], batch["n"], strict=True) for s in {N.sound(t) for t in N.tokens(name)}]
            yield pd.DataFrame(found, columns=["sound", "n"])

    counted = names.filter("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    total = names.count()
    sounds = counted.mapInPandas(run, "sound string, n long").groupBy("sound").agg(F.sum("n").alias("n"))
    rows = sounds.filter((F.col("n") >= max(least, share * total)) & (F.length("sound") >= 4)).orderBy("sound").collect()
    return [r.sound for r in rows]


@lru_cache(maxsize=200_000)
def _tells(part: str) -> bool:
    """Whether a word can be a surname or a trade: no first name, legal form, initials or abbreviation."""
    sound = N.sound(part)
    if len(sound) < 3 or len(sound) == 3 and any(f.startswith(sound) for f in N.FIRST):
        return False
    if "/" in part or N.legal_form(part) or sound in N._LEGAL_WORDS or sound == N._COMPANY or sound in N.FIRST:
        return False
    if len(sound) <= 11 and any(len(f) >= 4 and abs(len(f) - len(sound)) <= 2 and N.errors(sound, f) <= 1 for f in N.FIRST):
        return False
    return not (any(N.errors(sound, w) <= 1.5 for w in N._LEGAL_WORDS if len(w) >= 7) or N.errors(sound, N._COMPANY) <= 1)


def unlike(sounds: list[str], cap: int = DEGREE_CAP) -> list[str]:
    """Up to ``cap`` of the sounds, none of them a mistyped or cut form of another, in the order given."""
    kept: list[str] = []
    for s in sounds:
        if len(kept) >= cap:
            break
        if not any(s.startswith(k) or k.startswith(s) for k in kept) and all(abs(len(s) - len(k)) > 3 or N.errors(s, k) > (1.5 if len(k) >= 7 else 1.0) for k in kept):
            kept.append(s)
    return kept


def _degrees(pairs: DataFrame) -> DataFrame:
    """(word, degree): how many unlike words a word stands beside, up to DEGREE_CAP; found by pieces of bounded result."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"word": batch["word"], "others": [unlike(list(x)) for x in batch["others"]]})

    def grouped(df: DataFrame, *by: str) -> DataFrame:
        lists = df.groupBy(*by).agg(F.array_sort(F.collect_set("other")).alias("others")).select("word", "others")
        return lists.mapInPandas(keep, "word string, others array<string>")

    pieces = grouped(pairs.withColumn("piece", F.pmod(F.xxhash64("other"), F.lit(DEGREE_PIECES))), "word", "piece")
    return grouped(pieces.select("word", F.explode("others").alias("other")), "word").select("word", F.size("others").alias("degree"))


def trade_words(names: DataFrame, least: int = TRADE_LEAST, share: float = TRADE_SHARE) -> list[str]:
    """Sounds of trades: words beside ``least`` or more unlike words that themselves stand beside fewer.

    With many distinct words ``least`` rises to TRADE_OF_WORDS of them, at most DEGREE_CAP. A surname stands beside its holder's trade and first name however many rows the holder has, and a
    trade stands beside the surnames of many. Mistyped forms of a word count once, and the words of lower
    degree must be there in ``share`` of the distinct names that hold another telling word at all.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name in batch["name"]:
                sounds = sorted({N.sound(t) for t in N.tokens(name) if _tells(t)})
                found += [(name, a, b) for a in sounds for b in sounds if a != b and N.errors(a, b) > 1.5]
            yield pd.DataFrame(found, columns=["name", "word", "other"])

    beside = cut(names.filter("name is not null").select("name").distinct().mapInPandas(run, "name string, word string, other string"))
    degrees = cut(_degrees(beside.select("word", "other").distinct()))
    least = max(least, min(DEGREE_CAP, int(TRADE_OF_WORDS * degrees.count())))
    of_other = degrees.select(F.col("word").alias("other"), F.col("degree").alias("other_degree"))
    ranked = cut(beside.join(degrees.filter(F.col("degree") >= least), "word").join(of_other, "other"))
    lower = ranked.filter(F.col("other_degree") < F.col("degree"))
    enough = _degrees(lower.select("word", "other").distinct()).filter(F.col("degree") >= least).select("word")
    shares = (
        ranked.groupBy("word", "name").agg(F.max((F.col("other_degree") < F.col("degree")).cast("int")).alias("low"))
        .groupBy("word").agg(F.avg("low").alias("low")).filter(F.col("low") >= share)
    )
    return [r.word for r in shares.join(enough, "word").select("word").orderBy("word").collect()]


def _near_common(sound: str, common: list[str]) -> bool:
    """Whether a token is a common word, mistyped or cut short."""
    for word in common:
        if len(word) <= 3:
            if sound == word:
                return True
            continue
        if abs(len(word) - len(sound)) <= 3 and N.errors(sound, word) <= (1.5 if len(word) >= 7 else 0.5):
            return True
        if 3 <= len(sound) < len(word) and word.startswith(sound):
            return True
    return False


def contractor_fields(name: str, common: list[str]) -> tuple[str, str, str] | None:
    """(telling token, first name or initials, kind) of a contractor's name; None where nothing tells it.

    Kind is ``company`` where a trade or legal form stands in the name, else ``person``. Where all words
    are trades or near one, those near one tell the name, else all together.
    """
    telling, first, kind = "", "", "person"
    trades: list[str] = []
    skip = False
    parts = N.tokens(name)
    for part in parts:
        sound = N.sound(part)
        if skip:
            skip = False
            continue
        if sound == "tu":  # "of": a father's name follows
            skip = True
        elif N.legal_form(part) or sound in N._LEGAL_WORDS or sound == N._COMPANY:
            kind = "company"
        elif sound in N.FIRST:
            first = N.FIRST[sound]
        elif "/" in part or _near_common(sound, [c for c in common if c not in N.FIRST]):
            kind = "company"
            if "/" not in part and len(sound) >= 4:
                trades.append(part)
        elif len(sound) <= 3:
            first = first or sound
        else:
            close = [N.FIRST[f] for f in N.FIRST if len(f) >= 4 and abs(len(f) - len(sound)) <= 2 and N.errors(sound, f) <= 1]
            if close and len(sound) <= 11:
                first = close[0]
            elif any(N.errors(sound, w) <= 1.5 for w in N._LEGAL_WORDS if len(w) >= 7) or N.errors(sound, N._COMPANY) <= 1:
                kind = "company"
            elif len(sound) > len(N.sound(telling)):
                telling = part
    if len(N.sound(telling)) < 4:
        telling = max((t for t in trades if N.sound(t) not in common), key=len, default="") or "".join(sorted(set(trades)))
    return (N.token(telling), first, kind) if len(N.sound(telling)) >= 4 else None


def token_ratio(a: str, b: str) -> float:
    """Longest-common-subsequence ratio of two tokens, by sound or by spelling, whichever is larger."""
    (sound_a, spell_a), (sound_b, spell_b) = a.split("|"), b.split("|")
    return max(N.ratio(sound_a, sound_b), N.ratio(spell_a, spell_b))


def tokens_similar(a: str, b: str) -> bool:
    """Ratio test of two telling tokens; short ones may only have lost a letter."""
    short = min(a.index("|"), b.index("|")) < 6
    return token_ratio(a, b) >= (MIN_RATIO_SHORT if short else MIN_RATIO) - 1e-9


def places_similar(a: str, b: str) -> bool:
    """Stricter test for place names, which share long endings: the ratio of one wrong or swapped letter."""
    (sound_a, spell_a), (sound_b, spell_b) = a.split("|"), b.split("|")
    return any(N.ratio(x, y) >= 1 - 2 / max(2, len(x) + len(y)) - 1e-9 for x, y in ((sound_a, sound_b), (spell_a, spell_b)))


def suffix_keys(tokens: DataFrame) -> DataFrame:
    """The columns of ``tokens`` with (key, before): whole suffixes of a token and the letters before them.

    Suffixes have at least MIN_SUFFIX letters, one less for tokens of less than SHORT_TOKEN; a token shorter than
    that is its only suffix. They are taken of both forms of the token, of these read backwards (marked ``<``),
    and, the CUT_STARTS longest, of its sound without the last CUT_LETTERS. One slip leaves the end before or
    behind it, and so do two unless they are near both ends; then the cut leaves what lies between.
    """
    least = F.when(F.length("sound") < SHORT_TOKEN, MIN_SUFFIX - 1).otherwise(MIN_SUFFIX)

    def suffixes(form, mark: str, most: int | None = None):
        until = F.greatest(F.length(form) - least + 1, F.lit(1))
        starts = F.sequence(F.lit(1), until if most is None else F.least(until, F.lit(most)))
        one = lambda i: F.struct(
            F.concat(F.lit(mark), F.substring(form, i, F.length(form))).alias("key"), F.reverse(F.substring(F.reverse(F.substring(form, F.lit(1), i - 1)), 1, 3)).alias("before")
        )
        return F.transform(starts, one)

    forms = tokens.withColumns({"sound": F.substring_index("token", "|", 1), "spelling": F.substring_index("token", "|", -1)})
    shorter = [F.when(F.length("sound") - k >= least, suffixes(F.substring(F.col("sound"), F.lit(1), F.length("sound") - k), "", CUT_STARTS)) for k in CUT_LETTERS]
    every = F.array(
        suffixes(F.col("sound"), ""), suffixes(F.reverse("sound"), "<"), *shorter,
        *[F.when(F.col("spelling") != F.col("sound"), suffixes(f, m)) for f, m in ((F.col("spelling"), ""), (F.reverse("spelling"), "<"))],
    )
    return forms.select(*tokens.columns, F.inline(F.array_distinct(F.flatten(F.array_compact(every)))))


def with_bags(tokens: DataFrame) -> DataFrame:
    """``tokens`` with the length of each form and its bag: a bit for a letter that stands in it, a second for one that does twice.

    Letters of equal code modulo 32 share their bits. Bits that differ between two bags are letters that one form has and the
    other has not, so there are never more of them than letters outside the longest common subsequence.
    """
    code = "ascii(c) % 32"
    bag = f"aggregate(filter(split({{}}, ''), c -> c != ''), 0L, (m, c) -> m | shiftleft(1L, {code} + 32 * cast(shiftrightunsigned(m, {code}) & 1 AS int)))"
    every = [(form, f"substring_index(token, '|', {i})") for form, i in FORMS.items()]
    return tokens.withColumns({f"{form}_letters": F.expr(f"length({x})") for form, x in every} | {f"{form}_bag": F.expr(bag.format(x)) for form, x in every})


def _near(most_errors: Callable):
    """Whether tokens ``l`` and ``r`` can be similar; lengths and bags are compared first, and edits are counted up to the bound only."""
    near = F.lit(False)
    for form, i in FORMS.items():
        m, n, x, y = (F.col(f"{side}.{form}_{what}") for what in ("letters", "bag") for side in ("l", "r"))
        most = most_errors(m + n).cast("int")
        # -1 where there are more edits
        edits = F.call_function("levenshtein", F.substring_index("l.token", "|", i), F.substring_index("r.token", "|", i), most)
        near = near | ((F.abs(m - n) <= most) & (F.bit_count(x.bitwiseXOR(y)) <= most) & (edits >= 0))
    return near


def _refined(keyed: DataFrame, common_key: int) -> DataFrame:
    """(token, side, OF_FORMS, key, last): keys with too many tokens refined, those that still have too many discarded.

    A common suffix goes with what is left of the three letters before it when one or two of them are lost,
    as in two tokens that differ there only, and with the tax id. Tokens that agree further share a longer
    suffix as well. ``last`` is the letter before the suffix. The common keys alone are a short table.
    """

    def common(df: DataFrame) -> DataFrame:
        return cut(df.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > common_key).select("key"))

    own = ["token", "side", *OF_FORMS]
    last = F.substring("before", -1, 1).alias("last")
    often = common(keyed)
    fine = keyed.join(often, "key", "left_anti").select(*own, "key", last)
    letter = [F.substring("before", i, 1) for i in (1, 2, 3)]
    left = [F.concat(letter[0], letter[1]), F.concat(letter[0], letter[2]), F.concat(letter[1], letter[2]), *letter]
    refined = cut(keyed.join(often, "key", "left_semi").select(
        *own, last,
        F.explode(
            F.array_distinct(F.array_compact(F.array(*[F.concat_ws("~", "key", x) for x in left], F.when(F.col("field").isNotNull(), F.concat_ws("#", "key", "field")))))
        ).alias("key"),
    ))
    return fine.unionByName(refined.join(common(refined), "key", "left_anti").select(*own, "key", "last"))


def similar_tokens(tokens: DataFrame, similar: Callable[[str, str], bool], most_errors: Callable, common_key: int = COMMON_KEY) -> DataFrame:
    """(a, b) of similar distinct tokens of sides 0 and 1, or of one table with itself (side null: a <= b).

    ``tokens`` has token, side and field (a start of the tax id for refining, or null). A key holds at most
    ``common_key`` tokens, so no task ever compares more than that many with each other. Two tokens meet
    under their longest common suffix only, where the letters before it differ. ``most_errors`` is a bound, in
    letters, on what similar tokens leave outside their longest common subsequence, by the sum of their lengths:
    what lies beyond it by length, bag or edit distance is dropped where the pairs are joined, so only near pairs
    are shuffled and compared by ratio.
    """
    keyed = cut(_refined(suffix_keys(with_bags(tokens)), common_key))
    two_sided = F.col("l.side").isNotNull()
    joined = keyed.alias("l").join(keyed.alias("r"), "key").filter(
        F.when(two_sided, (F.col("l.side") == 0) & (F.col("r.side") == 1)).otherwise(F.col("l.token") < F.col("r.token"))
    )
    joined = joined.filter((F.col("l.last") != F.col("r.last")) | (F.col("l.last") == "") | F.col("key").contains("~") | F.col("key").contains("#"))
    pairs = joined.filter(_near(most_errors)).select(F.col("l.token").alias("a"), F.col("r.token").alias("b")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [a == b or similar(a, b) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch[keep]

    found = pairs.mapInPandas(run, "a string, b string")
    same = tokens.filter("side is null").select(F.col("token").alias("a"), F.col("token").alias("b")).distinct()
    return found.unionByName(same)


def most_errors_of_tokens(letters):
    """Letters outside the common subsequence, of which MIN_RATIO leaves so many; the edit distance never exceeds them."""
    return F.floor(letters * (1 - MIN_RATIO) + 1e-6)


def most_errors_of_places(letters):
    return F.lit(2)


def _first_agrees(a: str, b: str) -> bool:
    """First names agree if either is missing, both are one name, or one is the other's initials."""
    if not a or not b or a == b:
        return True
    short, long = sorted((a, b), key=len)
    if len(short) <= 3:
        return long.startswith(short)
    return N.errors(a, b) <= 1


def _vat_far(a: str | None, b: str | None) -> bool:
    """Whether two tax ids are both given and more than mistyped forms of one."""
    return bool(a) and bool(b) and N.errors(a, b) > 2


def same_contractor(x: tuple, y: tuple) -> bool:
    """Whether two records (first, kind, vat) with similar telling tokens name one contractor."""
    (first_x, kind_x, vat_x), (first_y, kind_y, vat_y) = x, y
    if _vat_far(vat_x, vat_y):
        return False
    near = bool(vat_x) and bool(vat_y)
    if kind_x != kind_y:
        # a trade may be missing on one side, a first name may not
        return near and not (first_x and first_y and not _first_agrees(first_x, first_y))
    return kind_x == "company" or (_first_agrees(first_x, first_y) and (near or bool(first_x) and bool(first_y)))


def contractor_classes(aliases: DataFrame, id_column: str, vat_column: str, name_column: str, common_key: int = COMMON_KEY) -> tuple[DataFrame, DataFrame]:
    """(id, class_id) of the rows whose name tells something, and (class_a, class_b) of classes that name one contractor.

    Rows with equal fields (telling token, first name, kind, tax id) are one class, named by its least id;
    only classes are compared.
    """
    rows = aliases.select(F.col(id_column).cast("long").alias("id"), F.col(vat_column).cast("string").alias("vat"), F.col(name_column).alias("name"))
    common = trade_words(rows)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fields = [contractor_fields(n, common) for n in batch["name"]]
            keep = [f is not None for f in fields]
            out = batch.loc[keep, ["id", "vat"]].reset_index(drop=True)
            found = pd.DataFrame([f for f in fields if f is not None], columns=["token", "first", "kind"])
            yield pd.concat([out, found], axis=1)

    parsed = cut(rows.filter("name is not null and id is not null").mapInPandas(parse, "id long, vat string, token string, first string, kind string"))
    fields = ["vat", "token", "first", "kind"]
    classes = cut(parsed.groupBy(*fields).agg(F.min("id").alias("class_id")))
    tokens = classes.select("token", F.lit(None).cast("int").alias("side"), F.substring("vat", 1, 5).alias("field")).distinct()
    pairs = similar_tokens(tokens, tokens_similar, most_errors_of_tokens, common_key)
    # a token of many classes is compared in pieces of HOT_TOKEN
    hot = classes.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / HOT_TOKEN).cast("int").alias("pieces")).filter("pieces > 1")
    split = classes.join(hot, "token", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("class_id", "vat", "first", "kind")] + [F.col("token").alias(x)]
    left = split.select(*side("a"), F.pmod(F.xxhash64("class_id"), F.col("pieces")).cast("int").alias("piece"))
    every = split.select("token", "pieces").distinct().select(F.col("token").alias("a"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    meet = (
        pairs.join(every, "a").join(left, ["a", "piece"]).join(split.select(*side("b")), "b")
        .filter((F.col("class_id_a") != F.col("class_id_b")) & ((F.col("a") != F.col("b")) | (F.col("class_id_a") < F.col("class_id_b"))))
    )

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                same_contractor((fa, ka, va), (fb, kb, vb))
                for fa, ka, va, fb, kb, vb in zip(
                    batch["first_a"], batch["kind_a"], batch["vat_a"], batch["first_b"], batch["kind_b"], batch["vat_b"], strict=True
                )
            ]
            yield batch.loc[keep, ["class_id_a", "class_id_b"]]

    judged = meet.mapInPandas(judge, "class_id_a long, class_id_b long")
    links = judged.select(F.least("class_id_a", "class_id_b").alias("class_a"), F.greatest("class_id_a", "class_id_b").alias("class_b")).distinct()
    # within a class only the rows' own fields speak, as between two classes with equal ones
    whole = classes.filter((F.col("kind") == "company") | (F.col("vat") != "") | (F.col("first") != "")).select("class_id")
    member = parsed.alias("p").join(classes.alias("c"), [F.col(f"p.{f}").eqNullSafe(F.col(f"c.{f}")) for f in fields]).select(F.col("p.id").alias("id"), "class_id")
    return member.join(whole.withColumn("whole", F.lit(True)), "class_id", "left").select("id", "class_id", F.coalesce("whole", F.lit(False)).alias("whole")), links


def contractor_pairs(aliases: DataFrame, id_column: str, vat_column: str, name_column: str, common_key: int = COMMON_KEY) -> DataFrame:
    """(key_a, key_b), key_a < key_b: each pair of rows that name the same contractor.

    Rows with a null or empty name, or one without any telling word, have no pair. Equal rows are
    paired like variants; two rows of equal id are not a pair. An empty table gives none.
    """
    member, links = contractor_classes(aliases, id_column, vat_column, name_column, common_key)
    member = cut(member)
    inside = member.filter("whole").select(F.col("id").alias("key_a"), "class_id").join(member.select(F.col("id").alias("key_b"), "class_id"), "class_id")
    a, b = member.select(F.col("id").alias("key_a"), F.col("class_id").alias("class_a")), member.select(F.col("id").alias("key_b"), F.col("class_id").alias("class_b"))
    across = links.join(a, "class_a").join(b, "class_b").filter("key_a != key_b")
    both = inside.filter("key_a < key_b").select("key_a", "key_b").unionByName(across.select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b")))
    return both.distinct()


def contractor_members(aliases: DataFrame, id_column: str, vat_column: str, name_column: str) -> DataFrame:
    """(id, class_id, n_links): each row's class of equal records and how many other classes name its contractor.

    Rows with a null or empty name, or one without any telling word, are in no class. The size of the result
    is that of the table, however many rows a contractor has.
    """
    member, links = contractor_classes(aliases, id_column, vat_column, name_column)
    ends = links.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    return member.select("id", "class_id").join(ends, "class_id", "left").select("id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


_NOTE = re.compile(r"\([^()]*\)")


def kind_match(parts: list[str], kind_words: list[str]) -> float:
    """Share of an organisation's kind words that a name's other words stand for, less what stands for none.

    A word stands for one that it nearly equals or begins, a word with a slash for one that its
    parts begin and end, and initials for the words they begin.
    """
    sounds = [N.sound(w) for w in kind_words]
    covered, idle = set(), 0
    for part in parts:
        s = N.sound(part)
        hit = None
        for i, w in enumerate(sounds):
            if i in covered:
                continue
            if "/" in part:
                begin, end = (N.sound(x) for x in part.split("/", 1))
                if w.startswith(begin[:4]) and w.endswith(end[-2:]):
                    hit = {i}
                    break
            elif len(s) >= 4 and N.errors(s, w) <= (1.5 if len(w) >= 7 else 1.0) or s and w.startswith(s):
                hit = {i}
                break
            elif len(s) >= 5 and any(N.errors(s, w[: len(s) + d]) <= 0.5 for d in (0, 1)):
                hit = {i}
                break
        if hit is None and 2 <= len(part) <= 6:
            for i in range(len(kind_words)):
                for j in range(i + 2, len(kind_words) + 1):
                    run = "".join(w[0] for w in kind_words[i:j])
                    if s == N.sound(run) and not covered & set(range(i, j)):
                        hit = set(range(i, j))
        if hit is None:
            idle += 1
        else:
            covered |= hit
    return len(covered) / max(1, len(kind_words)) - 0.15 * idle


def organisation_links(
    registry: DataFrame, org_id: str, registered_name: str, acts: DataFrame, row_id: str, typed_name: str,
    least_kind: float = 0.7,
) -> DataFrame:
    """(key_a, key_b): registry id and row id for each row whose name denotes a registered organisation.

    Only names that differ from the registered one are linked; of several organisations the one
    with the best agreement counts, and none where two are equally good. Null and empty names have
    no link. Names are compared once per spelling, however many rows hold it.
    """
    entities = registry.select(F.col(org_id).cast("long").alias("org_id"), F.col(registered_name).alias("name")).filter("name is not null")
    rows = acts.select(F.col(row_id).cast("long").alias("row_id"), F.col("`" + typed_name + "`").alias("name")).filter("name is not null")
    common = set(common_tokens(entities.select("name"), 0.02, 5))

    def split_registered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for i, name in zip(batch["org_id"], batch["name"], strict=True):
                parts = N.tokens(name)
                telling = max((p for p in parts if N.sound(p) not in common), key=len, default=None)
                if telling:
                    found.append((i, name, N.token(telling), [p for p in parts if p != telling]))
            yield pd.DataFrame(found, columns=["org_id", "registered", "token", "kind_words"])

    def split_typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name in batch["name"]:
                text = name
                while (shorter := _NOTE.sub(" ", text)) != text:
                    text = shorter
                parts = N.tokens(text)
                for k, part in enumerate(parts):
                    sound = N.sound(part)
                    if len(sound) >= 5 and sound not in common and "/" not in part:
                        found.append((name, N.token(part), parts[:k] + parts[k + 1 :]))
            yield pd.DataFrame(found, columns=["name", "token", "others"])

    known = cut(entities.mapInPandas(split_registered, "org_id long, registered string, token string, kind_words array<string>"))
    typed = cut(rows.select("name").distinct().mapInPandas(split_typed, "name string, token string, others array<string>"))
    no_field = F.lit(None).cast("string").alias("field")
    tokens = known.select("token", F.lit(0).alias("side"), no_field).unionByName(typed.select("token", F.lit(1).alias("side"), no_field)).distinct()
    pairs = similar_tokens(tokens, places_similar, most_errors_of_places)
    meet = pairs.join(known.withColumnRenamed("token", "a"), "a").join(typed.withColumnRenamed("token", "b"), "b")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [
                kind_match(list(others), list(words)) - 0.1 * N.token_errors(a, b)
                for others, words, a, b in zip(batch["others"], batch["kind_words"], batch["a"], batch["b"], strict=True)
            ]
            out = batch[["name", "org_id", "registered"]].assign(score=scores)
            yield out[out["score"] >= least_kind - 0.2]

    judged = meet.mapInPandas(judge, "name string, org_id long, registered string, score double")
    scored = judged.groupBy("name", "org_id", "registered").agg(F.max("score").alias("score"))
    best = scored.groupBy("name").agg(F.max_by(F.struct("org_id", "registered"), "score").alias("best"), F.max("score").alias("top"))
    equal = scored.join(best, "name").filter(F.col("score") == F.col("top")).groupBy("name").agg(F.count(F.lit(1)).alias("n_equal"))
    clear = best.join(equal, "name").filter((F.col("top") >= least_kind) & (F.col("n_equal") == 1)).select("name", F.col("best.org_id").alias("org_id"), F.col("best.registered").alias("registered"))
    return rows.join(clear, "name").filter(F.col("name") != F.col("registered")).select(F.col("org_id").alias("key_a"), F.col("row_id").alias("key_b"))
