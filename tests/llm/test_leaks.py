import random

import numpy as np

from synaxis.llm import leaks as L

DOCS, ITEMS = "doc_id long, text string, item_id string, words string", "item_id long, text string, task string"
RND = random.Random(9)
WORDS = [[f"w{i}x{j}" if j % 3 else ["the", "of", "and", "to"][j // 3 % 4] for j in range(40)] for i in range(6)]
INSTRUCTION = "read the passage below and choose the answer that follows from it".split()


def search(spark, docs, items=None, **kw):
    rows = items if items is not None else [(i, " ".join(INSTRUCTION + w), "x") for i, w in enumerate(WORDS)]
    d = spark.createDataFrame([(i, t, "clash", "clash") for i, t in docs], DOCS)
    out = L.leaks(d, "doc_id", "text", spark.createDataFrame(rows, ITEMS), "item_id", "text", **kw)
    return {(r.doc_id, r.item_id) for r in out.collect()}


def test_passages_and_what_is_none(spark):
    w = WORDS[2]
    changed = [x if j % 7 else "other" for j, x in enumerate(w[:30])]
    docs = [
        (1, "hello there " + " ".join(w[5:25]) + " bye"), (2, " ".join(x.upper() for x in w[:18]).replace(" ", " <b>&nbsp;") + "</b>"), (3, " ".join(changed)),
        (4, " ".join(w[:9]) + " a wholly different sentence stands here in between now " + " ".join(w[9:20])), (5, " ".join(w[3:13])), (6, " ".join(INSTRUCTION) + " and more of it"),
        (7, None), (8, ""), (9, " ".join(WORDS[0][:20] + WORDS[5][10:30])), (10, "nothing " * 50000), (1, " ".join(w[5:25])), (11, "w2\u00adx1 ".join(["", " ".join(w[2:22])])),
    ]
    assert search(spark, docs) == {(1, 2), (2, 2), (3, 2), (4, 2), (9, 0), (9, 5), (11, 2)}


def test_empty_sides(spark):
    assert search(spark, []) == set()
    assert search(spark, [(1, " ".join(WORDS[1]))], items=[]) == set()
    assert search(spark, [(1, " ".join(WORDS[1]))], items=[(1, None, "x"), (2, "a b", "x")]) == set()


def test_copies_and_passages_of_several_items(spark):
    own = [(i, " ".join(INSTRUCTION + w), "x") for i, w in enumerate(WORDS)]
    copies = [(10 + i, own[3][1], "x") for i in range(5)]
    passage = [f"p{j}" for j in range(24)]
    reused = [(20 + i, " ".join(INSTRUCTION + passage + [f"q{i}x{j}" for j in range(8)]), "x") for i in range(4)]
    docs = [(1, " ".join(WORDS[3][4:24])), (2, " ".join(passage[2:20])), (3, " ".join(INSTRUCTION) + " and more of it"), (4, " ".join(passage[2:12]))]
    assert search(spark, docs, own + copies + reused) == {(1, i) for i in (3, *range(10, 15))} | {(2, 20 + i) for i in range(4)}


def test_short_passages_with_changed_words(spark):
    w = [f"n{j}" if j % 3 != 1 else ["the", "of", "and", "to"][j % 4] for j in range(40)]
    others = [" ".join(["of", "the", "and", "to"] * 3 + [f"v{i}x{j}" for j in range(20)]) for i in range(6)]
    rows = [(2, " ".join(w), "x")] + [(10 + i, t, "x") for i, t in enumerate(others)]

    def changed(a, n, at, gap=None):
        out = ["other" if j in at else x for j, x in enumerate(w[a : a + n])]
        return " ".join(out if gap is None else out[:gap] + "a sentence of one hand stands here".split() + out[gap:])

    docs = [(1, changed(3, 15, (3, 7, 11))), (2, changed(4, 15, (4, 11), 7)), (3, changed(2, 18, (3, 7, 14), 10)), (4, changed(5, 10, (4,)))]
    assert search(spark, docs, rows) == {(1, 2), (2, 2), (3, 2)}


def test_many_copies_of_an_item(spark):
    for n in (1, 4, 1000):
        rows = [(i, " ".join(INSTRUCTION + w), "x") for i, w in enumerate(WORDS)] + [(100 + i, " ".join(INSTRUCTION + WORDS[3]), "x") for i in range(n - 1)]
        assert search(spark, [(1, " ".join(WORDS[3])), (2, " ".join(INSTRUCTION))], rows) == {(1, 3)} | {(1, 100 + i) for i in range(n - 1)}


def test_long_matches_chain_whole(spark):
    w = [f"n{j}" for j in range(700)]
    text = " ".join(w[:300] + [f"x{j}" for j in range(10)] + w[310:610])
    d = spark.createDataFrame([(1, text, "c", "c")], DOCS)
    row = L.leaks(d, "doc_id", "text", spark.createDataFrame([(5, " ".join(w), "x")], ITEMS), "item_id", "text").first()
    assert (row.matched_words, row.passage_words, row.first_word, row.last_word) == (600, 610, 0, 610)


def test_blocks_change_nothing(spark, monkeypatch):
    docs = [(i, " ".join(WORDS[i % 6][i : i + 20])) for i in range(12)] + [(50, " ".join(WORDS[0][:20] + WORDS[5][10:30]))]
    whole = search(spark, docs)
    monkeypatch.setattr(L, "BLOCK_WORDS", 60)
    assert search(spark, docs) == whole and len(whole) == 14


def test_verbatim_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    items = [(i, " ".join(f"A{x}" for x in rng.integers(0, 3, 30)), "x") for i in range(4)] + [(9, None, "x"), (10, "A1", "x")]
    docs = [(i, "; ".join(f"A{x}" for x in rng.integers(0, 3, 80)), "c", "c") for i in range(6)] + [(7, None, "c", "c"), (8, "", "c", "c")]
    out = L.verbatim(spark.createDataFrame(docs, DOCS), "doc_id", "text", spark.createDataFrame(items, ITEMS), "item_id", "text", 5)
    want = set()
    for d, text, *_ in docs[:6]:
        for i, own, _ in items[:4]:
            want |= {(d, i, a, b, n) for a, b, n in maximal(text.split("; "), own.split(), 5)}
    assert {tuple(r) for r in out.collect()} == want and len(want) > 50


def maximal(t, own, least):
    for a in range(len(t)):
        for b in range(len(own)):
            if a and b and t[a - 1] == own[b - 1]:
                continue
            n = 0
            while a + n < len(t) and b + n < len(own) and t[a + n] == own[b + n]:
                n += 1
            if n >= least:
                yield a, b, n


def test_suffixes_are_ranked_and_compared():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        codes, owner = rng.integers(0, 3, 30), np.sort(rng.integers(0, 4, 30))
        following, _ = L._steps(np.arange(30), owner)

        def suffix(i):
            out = []
            while i >= 0:
                out.append(int(codes[i]))
                i = following[i]
            return out

        made = L.Suffixes(codes, following)
        pairs = [(i, j) for i in range(30) for j in range(30)]
        common = made.common(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
        for (i, j), n in zip(pairs, common):
            a, b = suffix(i), suffix(j)
            assert (made.rank[i] < made.rank[j]) == (a < b)
            assert n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_matches_equal_brute_force():
    rng = np.random.default_rng(3)
    for need in (3, 4, 6):
        own = [[f"a{x}" for x in rng.integers(0, 4, 25)] for _ in range(3)]
        test = L.TestBlock([(i, w, np.full(25, need), np.zeros(25, dtype=int), np.zeros(25, dtype=bool)) for i, w in enumerate(own)])
        texts = [[f"a{x}" for x in rng.integers(0, 5, 60)] for _ in range(5)]
        words = L.Codes().of([w for t in texts for w in t])
        found = L.find_matches(words, np.repeat(np.arange(5), 60), test)
        got = [(int(r.doc), int(r.item), int(r.d) - int(r.doc) * 60, int(r.t), int(r.n)) for r in found.itertuples()]
        want = {(d, i, a, b, n) for d, t in enumerate(texts) for i, w in enumerate(own) for a, b, n in maximal(t, w, need)}
        assert set(got) == want and len(got) == len(want)


def test_needs_follow_the_number_of_texts():
    boilerplate = [1, *[20] * 7, 0, 0, 0]  # even 13 words from here stand in 20 texts
    rare, shared = [9, 9, 9, 2, 1, 1, 1, 1, 0, 0, 0], [9, 9, 9, 9, 9, 9, 9, 0, 0, 0, 0]
    need, own, named = L.suffix_needs(np.array([boilerplate] * 3 + [rare] + [shared] * 2), 3, 10)
    assert own.tolist() == [0] * 6 and L.suffix_needs(np.array([rare]), 3, 10, 5)[1].tolist() == [5]
    assert need.tolist() == [8, 7, 6, 5, 8, 8] and named.tolist() == [True] * 3 + [False] * 3
    # what a few texts share behind the opening is theirs, by any three words
    need, own, _ = L.suffix_needs(np.array([boilerplate] * 3 + [[9] * 8 + [0] * 3] + [[9] * 7 + [0] * 4] * 12), 3, 10)
    assert own.tolist() == [0] * 3 + [3] * 11 + [0] * 2 and need.tolist()[:4] == [6, 5, 4, 3]
