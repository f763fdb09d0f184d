from synaxis.llm import nameforms as N
from synaxis.llm import variants as V

ALIAS = "alias_id long, vat string, canonical_name string, token string, key string"
TRADES = ["ΜΕΤΑΦΟΡΕΣ", "ΓΡΑΦΙΚΕΣ ΤΕΧΝΕΣ", "ΤΡΟΦΙΜΑ"]


def test_sounds_over_scripts():
    assert N.sound("ΧΑΡΑΛΑΜΠΟΣ") == N.sound("CHARALABOS") == N.sound("XAPAΛAMΠOΣ")
    assert N.tokens('"Ο. Ε. ΔΟΚΙΜΗ"') == ["ΟΕ", "ΔΟΚΙΜΗ"] and N.tokens(None) == [] and N.tokens("") == []
    assert N.legal_form("EΠE") == "ΕΠΕ" and N.legal_form("Ε") is None


def test_common_subsequence_against_brute_force():
    import random

    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rnd = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        assert N.common_length(a, b) == lcs(a, b)
    assert N.ratio("", "") == 0.0 and N.errors("abcd", "abdc") == 1 and N.errors("abcd", "abd") == 0.5


def aliases(spark, rows):
    filler = [(1000 + i, None, f"ΖΖΖΞΞΨ{chr(913 + i)}ΨΩΡΤΛ{chr(913 + i)}ΘΦ {TRADES[i % 3]}") for i in range(15)]
    df = spark.createDataFrame([(*r, "c", "k") for r in rows + filler], ALIAS)
    return {(r.key_a, r.key_b) for r in V.contractor_pairs(df, "alias_id", "vat", "canonical_name").collect()} - {(a, b) for a in range(1000, 1020) for b in range(1000, 1020)}


def test_contractors(spark):
    got = aliases(
        spark,
        [
            (1, "400000001", "ΚΑΓΚΑΒΑΝΤΕΚΙΝΟΣ ΘΕΟΔΩΡΟΣ"), (2, None, "ΘΟΔΩΡΗΣ ΚΑΓΚΑΒΑΝΤΕΚΝΟΣ"), (3, "400000010", "kagavadekinos theodoros"), (4, "677000555", "ΚΑΓΚΑΒΑΝΤΕΚΙΝΟΣ ΗΛΙΑΣ"),
            (5, None, "ΡΟΜΠΟΛΟΜΗΧΑΡΑΣ ΜΕΤΑΦΟΡΕΣ Α.Ε."), (6, None, "ΜΕΤΑΦΟΡΕΣ ΡΟΜΠΟΛΟΜΗΧΑΡΑΣ"), (7, None, None), (8, None, ""), (9, None, "ΡΟΜΠΟΛΟΜΗΧΑΡΑΣ ΜΕΤΑΦΟΡΕΣ Α.Ε."),
        ],
    )
    assert got == {(1, 2), (1, 3), (2, 3), (5, 6), (5, 9), (6, 9)}


def test_contractor_with_a_third_of_the_rows(spark):
    big = [(i, None, ["ΚΡΟΤΑΛΟΠΕΤΡΙΔΗΣ ΜΕΤΑΦΟΡΕΣ Α.Ε.", "ΜΕΤΑΦΟΡΕΣ ΚΡΟΤΑΛΟΠΕΤΡΙΔΗΣ", "ΚΡΟΤΑΛΟΠΕΤΡΗΔΗΣ ΜΕΤΑΦΟΡΕΣ"][i % 3]) for i in range(1, 11)]
    assert aliases(spark, big) == {(a, b) for a in range(1, 11) for b in range(a + 1, 11)}


def test_last_telling_token_stays():
    assert V.contractor_fields("ΜΕΤΑΦΟΡΑΣ Α.Ε.", ["metafores"])[0] == N.token("ΜΕΤΑΦΟΡΑΣ")
    assert V.contractor_fields("ΜΕΤΑΦΟΡΕΣ Α.Ε.", ["metafores"])[0] == N.token("ΜΕΤΑΦΟΡΕΣ")


def test_no_aliases(spark):
    df = spark.createDataFrame([], ALIAS)
    assert V.contractor_pairs(df, "alias_id", "vat", "canonical_name").count() == 0


def test_organisations(spark):
    kinds = ["ΔΗΜΟΣ", "ΓΕΝΙΚΟ ΝΟΣΟΚΟΜΕΙΟ", "ΔΗΜΟΤΙΚΗ ΕΠΙΧΕΙΡΗΣΗ ΥΔΡΕΥΣΗΣ ΑΠΟΧΕΤΕΥΣΗΣ"]
    places = ["ΓΚΑΨΑΠΥΛΙΩΝ", "ΠΥΧΑΛΟΒΡΥΣΗΣ", "ΤΡΙΜΟΘΕΚΑΣΤΡΟΥ", "ΖΕΣΙΜΟΝΙΑΣ", "ΡΟΒΕΡΙΝΙΑΣ", "ΛΥΓΙΑΓΙΑΛΙΩΝ"]
    names = [f"{k} {p}" for k in kinds for p in places]
    registry = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(names)], "org_id long, name string, row_id string")
    typed = {
        100: ("ΔΗΜΟΣ ΓΚΑΨΑΠΥΛΙΩΝ", None), 101: ("Δήμος Γκαψαπυλίων", 0), 102: ("ΓΚΑΨΑΠΥΛΙΩΝ, ΔΗΜΟΣ", 0), 103: ("ΔΕΥΑ ΠΥΧΑΛΟΒΡΥΣΗΣ", 13), 104: ("ΓΕΝ. ΝΟΣ/ΜΕΙΟ ΠΥΧΑΛΟΒΡΙΣΗΣ", 7),
        105: ("DIMOS TRIMOTHEKASTROU", 2), 106: ("ΔΗΜΟΣ ΑΛΛΟΥΞΕΝΟΥΤΟΠΟΥ", None), 107: ("ΠΑΝΕΠΙΣΤΗΜΙΟ ΖΕΣΙΜΟΝΙΑΣ", None), 108: (None, None), 109: ("", None), 110: ("ΔΗΜΟΣ ΖΕΣΙΜΟΝΙΑΣ (ΕΔΡΑ)", 3),
    }
    acts = spark.createDataFrame([(k, v[0], "x") for k, v in typed.items()], "row_id long, `org.value` string, org_id string")
    got = {r.key_b: r.key_a for r in V.organisation_links(registry, "org_id", "name", acts, "row_id", "org.value").collect()}
    assert got == {k: v[1] for k, v in typed.items() if v[1] is not None}


def test_slips_anywhere_meet_under_a_whole_suffix(spark):
    import random

    rnd, base = random.Random(4), ["georgakis", "karagianis", "papadopulos", "vasilakopulos", "maniatis", "konstadinidis"]
    pairs = []
    for w in base:
        for i in range(len(w)):
            pairs.append((w, w[:i] + ("x" if w[i] != "x" else "q") + w[i + 1 :]))
            if len(w) >= 11:
                j = rnd.randrange(len(w) // 2)
                v = pairs[-1][1]
                pairs.append((w, v[:j] + "y" + v[j + 1 :]))
    named = [(f"{a}|{a}", f"{b}|{b}") for a, b in pairs]
    rows = sorted({x for p in named for x in p})
    tokens = spark.createDataFrame([(x, None, None) for x in rows], "token string, side int, field string")
    met = {frozenset((r.a, r.b)) for r in V.similar_tokens(tokens, V.tokens_similar, V.most_errors_of_tokens).collect()}
    wanted = [p for p in named if V.tokens_similar(*p)]
    assert len(wanted) > 60 and all(frozenset(p) in met for p in wanted)


def test_common_suffixes_are_refined_before_they_go(spark):
    rows = [f"{a}{b}{c}stopulos" for a in "bdgklmnprt" for b in "aeiou" for c in "klmn"]
    tokens = spark.createDataFrame([(f"{x}|{x}", None, None) for x in rows], "token string, side int, field string")
    same = lambda a, b: V.token_ratio(a, b) >= 1 - 1 / 11 - 1e-9
    want = {frozenset((f"{x}|{x}", f"{y}|{y}")) for x in rows for y in rows if same(f"{x}|{x}", f"{y}|{y}")}
    got = {frozenset((r.a, r.b)) for r in V.similar_tokens(tokens, same, V.most_errors_of_places, 60).collect()}
    assert got == want


def test_only_pairs_that_share_their_letters_are_compared(spark):
    import random

    rnd, words = random.Random(7), {"abcdefghijkl", "wxyzefghijkl", "efghijkl", "aabbefghijkl", "abefghijkl"}
    for w in ("karagianis", "papadopulos", "vasilakopulos", "manatos", "adamadadakis"):
        for _ in range(40):
            v = list(w)
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(v))
                v[i : i + rnd.randint(0, 2)] = rnd.choice(["", "s", "a", "da", "7"])
            words.add("".join(v))
    tokens = spark.createDataFrame([(f"{w}|{w}", None, None) for w in sorted(words) if w], "token string, side int, field string")
    met = {(r.a.split("|")[0], r.b.split("|")[0]) for r in V.similar_tokens(tokens, lambda a, b: True, V.most_errors_of_tokens).collect()}
    assert ("abcdefghijkl", "wxyzefghijkl") not in met and ("abefghijkl", "efghijkl") in met
    differ = lambda a, b: sum(abs(min(2, a.count(c)) - min(2, b.count(c))) for c in set(a + b))
    assert all(differ(a, b) <= (len(a) + len(b)) // 6 for a, b in met)
    bags = {r.token.split("|")[0]: (r.sound_letters, r.sound_bag, r.spelling_letters, r.spelling_bag) for r in V.with_bags(tokens).collect()}
    for a in bags:
        assert bags[a][:2] == bags[a][2:] and bags[a][0] == len(a)
        assert all((bags[a][1] ^ bags[b][1]).bit_count() <= 2 * N.errors(a, b) for b in bags)


def test_members_have_one_row_each(spark):
    rows = [(1, None, "ΡΟΜΠΟΛΟΜΗΧΑΡΑΣ ΜΕΤΑΦΟΡΕΣ Α.Ε."), (2, None, "ΜΕΤΑΦΟΡΕΣ ΡΟΜΠΟΛΟΜΗΧΑΡΑΣ"), (3, None, "ΡΟΜΠΟΛΟΜΗΧΑΡΑΣ ΜΕΤΑΦΟΡΕΣ Α.Ε."), (4, None, None)]
    filler = [(1000 + i, None, f"ΖΖΖΞΞΨ{chr(913 + i)}ΨΩΡΤΛ{chr(913 + i)}ΘΦ {TRADES[i % 3]}") for i in range(15)]
    df = spark.createDataFrame([(*r, "c", "k") for r in rows + filler], ALIAS)
    got = {r.id: (r.class_id, r.n_links) for r in V.contractor_members(df, "alias_id", "vat", "canonical_name").collect()}
    assert got[1] == got[3] == (1, 0) or got[1][0] == got[3][0]
    assert 4 not in got and len(got) == 18
