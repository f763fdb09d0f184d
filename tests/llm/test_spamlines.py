import numpy as np

from synaxis.llm import spamlines as P

PROSE = "The old owner told me this morning that the kettle on the roof was narrow. I would not trust a cheap pump, but it works well behind the house."
LINKS = "\n".join(f"http://shop{i}.example/item/{i}" for i in range(12))
TAGS = " ".join(f"#cheap_tyres_{i} #tyresbuy{i}" for i in range(15))
KEYWORDS = " ".join(["cheap tyres best offer online", "fast loans top price discount", "cheap tyres sale 2024"] * 8)
PRODUCTS = "\n".join(f"best roof repair | SKU {i}0{i} | {i}9,99 EUR | discount" for i in range(10))


def shares(spark, texts):
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, t in enumerate(texts)], "doc_id long, text string, prose double, id string")
    return {r.doc_id: r for r in P.line_shares(df, "doc_id", "text").collect()}


def test_kinds(spark):
    ordinary = [PROSE, PROSE + "\n\n#fence #saw", PROSE + "\n-- \nGreetings\nhttp://me.example", PROSE + "\n1. rusty boiler under the stairs\n2. wet paint on the roof"]
    stuffed = [LINKS, TAGS, KEYWORDS, PRODUCTS, "We like it here.\n" + PRODUCTS, f"<div>{LINKS}</div>", KEYWORDS]
    texts = ordinary * 6 + stuffed + [None, "", "!!! ..."]
    got = shares(spark, texts)
    n = len(ordinary) * 6
    assert all(1 - got[i].prose <= P.THRESHOLD for i in range(n))
    assert all(1 - got[i].prose > P.THRESHOLD for i in range(n, n + len(stuffed)))
    assert not {n + len(stuffed) + k for k in range(3)} & set(got)
    assert abs(sum(got[n][s] for s in P.STATES) - 1) < 1e-9


ORDINARY = [
    "El viejo vecino me dijo esta mañana que la tetera del tejado era demasiado estrecha. No me fiaría de una bomba barata, pero detrás de la casa funciona bien. Ayer por la tarde fuimos al mercado con mi hermana y compramos pan y queso para la cena.",
    "Il vecchio proprietario mi ha detto questa mattina che il bollitore sul tetto era stretto. Non mi fiderei di una pompa a buon mercato, ma dietro la casa funziona bene. Ieri sera siamo andati al mercato con mia sorella e abbiamo comprato pane e formaggio per la cena.",
    "Vanha omistaja kertoi minulle tänä aamuna, että katolla oleva kattila oli kapea. En luottaisi halpaan pumppuun, mutta talon takana se toimii hyvin. Eilen illalla menimme torille siskoni kanssa ja ostimme leipää ja juustoa.",
]


def test_languages_the_corpus_does_not_know(spark, data):
    corpus = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    texts = ORDINARY + [t.replace(". ", "\n") for t in ORDINARY[:2]] + ["neumáticos baratos oferta envío gratis comprar zapatos descuento " * 12]
    got = shares(spark, texts + corpus)
    assert all(got[i].prose > 0.9 for i in range(5)) and got[5].prose < 0.1


def test_function_words_are_spread_and_even(spark):
    nouns = ["kettle", "ladder", "router", "window", "garden", "basket", "bottle", "candle"]
    texts = [f"the {nouns[i % 8]} and the {nouns[(i + 3) % 8]} of my aunt {i} " * 4 for i in range(60)] + ["buy loan " * 30] * 40
    df = spark.createDataFrame([(t,) for t in texts] + [("the the",)], "text string")
    found = P.function_words(df)
    assert "buy" not in found and "loan" not in found and "kettle" not in found
    assert P.function_words(df.filter("false")) == frozenset()


def test_quoted_lines_are_prose(spark):
    quoted = "We read this before.\n" + "\n".join("| " + x for x in PROSE.split(". "))
    got = shares(spark, [PROSE] * 10 + [quoted, PRODUCTS, KEYWORDS])
    assert got[10].prose > 0.9 and got[11].prose < 0.1


def test_no_texts(spark):
    assert shares(spark, []) == {}


def test_long_text(spark):
    got = shares(spark, [PROSE * 2000, KEYWORDS * 500])
    assert got[0].prose > 0.9 and got[1].prose < 0.2


def test_posterior_equals_enumeration():
    import itertools

    model = P.prior()
    symbols = np.array([[0, 0, 2, 1, 0, 0], [2, 0, 0, 0, 0, 1], [0, 2, 0, 0, 0, 1]])
    like = P._likelihoods(symbols, model)
    move, start = np.array(model["move"]), np.array(model["start"])
    want = np.zeros((3, 4))
    for path in itertools.product(range(4), repeat=3):
        p = start[path[0]] * like[0, path[0]]
        for i in (1, 2):
            p *= move[path[i - 1], path[i]] * like[i, path[i]]
        for i in range(3):
            want[i, path[i]] += p
    padded = np.zeros((2, 5, 6), dtype=int)
    padded[0, :3] = symbols
    padded[1, :1] = symbols[:1]
    gamma, moves = P.posterior(padded, np.array([3, 1]), model)
    assert np.allclose(gamma[0, :3], want / want.sum(axis=1, keepdims=True)) and np.allclose(gamma[0, 3:], 0)
    assert np.isclose(moves[0].sum(), 2) and np.isclose(moves[1].sum(), 0)
