"""What a name typed by people consists of: phonetic tokens, first name, trade, legal form.

Pure Python on single names; used inside Arrow batch functions.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Capital letters that look alike, Latin and Greek.
LATIN_LOOKS = "ABEZHIKMNOPTYX"
GREEK_LOOKS = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
_TO_GREEK = str.maketrans(LATIN_LOOKS, GREEK_LOOKS)
_TO_LATIN = str.maketrans(GREEK_LOOKS, LATIN_LOOKS)
_ONLY_GREEK = set("ΓΔΘΛΞΠΣΦΨΩ")
_ONLY_LATIN = set("CDFGJLQRSUVW")

# How Greek letters and pairs sound, longest first; and the same for Latin spellings.
GREEK_SOUNDS = (
    ("ΟΥ", "u"), ("ΕΙ", "i"), ("ΟΙ", "i"), ("ΥΙ", "i"), ("ΑΙ", "e"), ("ΑΥ", "av"), ("ΕΥ", "ev"), ("ΜΠ", "b"), ("ΝΤ", "d"),
    ("ΓΚ", "g"), ("ΓΓ", "g"), ("ΓΧ", "nx"), ("Α", "a"), ("Β", "v"), ("Γ", "g"), ("Δ", "d"), ("Ε", "e"), ("Ζ", "z"),
    ("Η", "i"), ("Θ", "q"), ("Ι", "i"), ("Κ", "k"), ("Λ", "l"), ("Μ", "m"), ("Ν", "n"), ("Ξ", "x"), ("Ο", "o"), ("Π", "p"),
    ("Ρ", "r"), ("Σ", "s"), ("Τ", "t"), ("Υ", "i"), ("Φ", "f"), ("Χ", "h"), ("Ψ", "y"), ("Ω", "o"),
)
LATIN_SOUNDS = (
    ("OU", "u"), ("EI", "i"), ("OI", "i"), ("AI", "e"), ("AY", "av"), ("EY", "ev"), ("AU", "av"), ("EU", "ev"), ("TH", "q"),
    ("CH", "h"), ("PS", "y"), ("KS", "x"), ("MP", "b"), ("NT", "d"), ("GK", "g"), ("GG", "g"), ("A", "a"), ("B", "b"),
    ("C", "k"), ("D", "d"), ("E", "e"), ("F", "f"), ("G", "g"), ("H", "h"), ("I", "i"), ("J", "z"), ("K", "k"), ("L", "l"),
    ("M", "m"), ("N", "n"), ("O", "o"), ("P", "p"), ("Q", "k"), ("R", "r"), ("S", "s"), ("T", "t"), ("U", "u"), ("V", "v"),
    ("W", "o"), ("X", "x"), ("Y", "i"), ("Z", "z"),
)
_GREEK = dict(GREEK_SOUNDS)
_LATIN = dict(LATIN_SOUNDS)
_GREEK_RE = re.compile("|".join(k for k, _ in GREEK_SOUNDS))
_LATIN_RE = re.compile("|".join(k for k, _ in LATIN_SOUNDS))

# Legal forms, as initials and in full.
LEGAL_FORMS = {
    "ΑΕ": "ΑΝΩΝΥΜΗ ΕΤΑΙΡΕΙΑ",
    "ΕΠΕ": "ΕΤΑΙΡΕΙΑ ΠΕΡΙΟΡΙΣΜΕΝΗΣ ΕΥΘΥΝΗΣ",
    "ΟΕ": "ΟΜΟΡΡΥΘΜΗ ΕΤΑΙΡΕΙΑ",
    "ΕΕ": "ΕΤΕΡΟΡΡΥΘΜΗ ΕΤΑΙΡΕΙΑ",
    "ΙΚΕ": "ΙΔΙΩΤΙΚΗ ΚΕΦΑΛΑΙΟΥΧΙΚΗ ΕΤΑΙΡΕΙΑ",
}

# Greek first names with their usual short and familiar forms.
FIRST_NAMES = """
ΕΜΜΑΝΟΥΗΛ ΜΑΝΩΛΗΣ ΜΑΝΟΣ|ΣΤΥΛΙΑΝΟΣ ΣΤΕΛΙΟΣ|ΔΗΜΗΤΡΙΟΣ ΔΗΜΗΤΡΗΣ ΜΗΤΣΟΣ ΜΙΜΗΣ ΤΖΙΜΗΣ|ΦΩΤΙΟΣ ΦΩΤΗΣ
ΚΩΝΣΤΑΝΤΙΝΟΣ ΚΩΣΤΑΣ ΝΤΙΝΟΣ ΚΩΣΤΗΣ|ΑΝΑΣΤΑΣΙΟΣ ΤΑΣΟΣ ΑΝΑΣΤΑΣΗΣ|ΙΩΑΝΝΗΣ ΓΙΑΝΝΗΣ ΓΙΑΝΝΟΣ|ΗΛΙΑΣ ΛΙΑΚΟΣ|ΧΑΡΑΛΑΜΠΟΣ ΜΠΑΜΠΗΣ ΧΑΡΗΣ ΛΑΜΠΗΣ
ΛΑΖΑΡΟΣ|ΜΙΧΑΗΛ ΜΙΧΑΛΗΣ|ΕΛΕΝΗ ΛΕΝΑ ΛΕΝΙΩ ΕΛΕΝΑ|ΓΕΩΡΓΙΟΣ ΓΙΩΡΓΟΣ ΓΙΩΡΓΗΣ|ΣΠΥΡΙΔΩΝ ΣΠΥΡΟΣ|ΘΕΟΔΩΡΟΣ ΘΟΔΩΡΗΣ ΘΟΔΩΡΟΣ|ΠΑΝΑΓΙΩΤΗΣ ΠΑΝΟΣ ΤΑΚΗΣ ΠΑΝΑΓΟΣ
ΖΑΧΑΡΙΑΣ ΖΑΧΟΣ|ΒΑΣΙΛΕΙΟΣ ΒΑΣΙΛΗΣ ΒΑΣΟΣ|ΑΙΚΑΤΕΡΙΝΗ ΚΑΤΕΡΙΝΑ ΚΑΙΤΗ ΚΑΤΙΝΑ|ΟΡΕΣΤΗΣ|ΝΙΚΟΛΑΟΣ ΝΙΚΟΣ ΝΙΚΟΛΑΣ|ΑΘΑΝΑΣΙΟΣ ΘΑΝΑΣΗΣ ΘΑΝΟΣ ΝΑΣΟΣ|ΕΥΑΓΓΕΛΟΣ ΒΑΓΓΕΛΗΣ ΑΓΓΕΛΟΣ
ΕΥΣΤΑΘΙΟΣ ΣΤΑΘΗΣ|ΧΡΗΣΤΟΣ ΧΡΙΣΤΟΣ|ΑΝΤΩΝΙΟΣ ΑΝΤΩΝΗΣ|ΣΤΑΥΡΟΣ|ΑΛΕΞΑΝΔΡΟΣ ΑΛΕΚΟΣ ΑΛΕΞΗΣ|ΜΑΡΙΑ ΜΑΡΙΚΑ ΜΑΙΡΗ|ΣΟΦΙΑ|ΑΝΝΑ|ΣΩΤΗΡΙΟΣ ΣΩΤΗΡΗΣ|ΑΠΟΣΤΟΛΟΣ ΤΟΛΗΣ
ΠΕΤΡΟΣ|ΠΑΥΛΟΣ|ΑΝΔΡΕΑΣ|ΓΡΗΓΟΡΙΟΣ ΓΡΗΓΟΡΗΣ|ΒΑΣΙΛΙΚΗ ΒΑΣΩ|ΓΕΩΡΓΙΑ ΓΩΓΩ|ΔΗΜΗΤΡΑ|ΕΙΡΗΝΗ ΡΕΝΑ|ΠΑΡΑΣΚΕΥΗ ΕΥΗ ΒΙΒΗ|ΕΥΑΓΓΕΛΙΑ ΛΙΤΣΑ ΕΥΑ|ΚΥΡΙΑΚΟΣ|ΣΤΕΦΑΝΟΣ|ΑΡΙΣΤΕΙΔΗΣ ΑΡΗΣ
"""

_PART = re.compile(r"[^\W_]+(?:/[^\W_]+)*")
_INITIALS = re.compile(r"(?<![^\W_])(?:[^\W\d_]\.\s?){1,}[^\W\d_]?(?:\.|(?![^\W_]))")


def upper_plain(name: str) -> str:
    """Upper case without accents or invisible characters."""
    text = unicodedata.normalize("NFKD", name.replace("\u00ad", "").replace("\u200b", "").upper())
    return "".join(c for c in text if not unicodedata.combining(c))


@lru_cache(maxsize=200_000)
def sound(word: str) -> str:
    """A word by how it sounds, equal over scripts, spellings and doubled letters."""
    letters = set(word)
    if letters & _ONLY_LATIN and not letters & _ONLY_GREEK:
        word = word.translate(_TO_LATIN)
        out = _LATIN_RE.sub(lambda m: _LATIN[m[0]], word)
    elif letters & _ONLY_GREEK or any("Α" <= c <= "Ω" for c in letters):
        out = _GREEK_RE.sub(lambda m: _GREEK[m[0]], word.translate(_TO_GREEK))
    else:
        # only letters of either script: short ones are initials that look Greek
        out = _GREEK_RE.sub(lambda m: _GREEK[m[0]], word.translate(_TO_GREEK)) if len(word) <= 3 else _LATIN_RE.sub(lambda m: _LATIN[m[0]], word)
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^a-z0-9]", "", out))


@lru_cache(maxsize=200_000)
def spelling(word: str) -> str:
    """A word letter by letter in one script, where a slip inside a pair of letters changes one sound only."""
    letters = set(word)
    if letters & _ONLY_LATIN and not letters & _ONLY_GREEK:
        return "".join(_LATIN.get(c, "") for c in word.translate(_TO_LATIN))
    return "".join(_GREEK.get(c, c if c.isdigit() else "") for c in word.translate(_TO_GREEK))


def token(word: str) -> str:
    """Both forms of a word: sound and spelling."""
    return f"{sound(word)}|{spelling(word)}"


def token_errors(a: str, b: str) -> float:
    """Wrong letters between two tokens, by sound or by spelling, whichever is less."""
    (sound_a, spell_a), (sound_b, spell_b) = a.split("|"), b.split("|")
    return min(errors(sound_a, sound_b), errors(spell_a, spell_b))


def legal_form(word: str) -> str | None:
    """The legal form that a short word abbreviates, in either script."""
    greek = word.translate(_TO_GREEK)
    return greek if greek in LEGAL_FORMS else None


def tokens(name: str | None) -> list[str]:
    """The words of a name; initials with dots are joined, a slash inside a word is kept."""
    if not name:
        return []
    text = upper_plain(name)
    text = _INITIALS.sub(lambda m: " " + re.sub(r"[.\s]", "", m[0]) + " ", text)
    return _PART.findall(text)


_LEGAL_WORDS = {sound(w): k for k, v in LEGAL_FORMS.items() for w in v.split() if w != "ΕΤΑΙΡΕΙΑ"}
_COMPANY = sound("ΕΤΑΙΡΕΙΑ")
FIRST = {sound(form): sound(group.split()[0]) for group in re.split(r"[|\n]", FIRST_NAMES.strip()) for form in group.split()}


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        m = masks.get(c, 0)
        x = row & m
        row = ((row + x) | (row - x)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Longest-common-subsequence ratio: twice the common length over both lengths."""
    return 2 * common_length(a, b) / (len(a) + len(b)) if a or b else 0.0


def errors(a: str, b: str) -> float:
    """Letters outside the common subsequence, per side: a changed or swapped letter is 1, a lost one 0.5."""
    return (len(a) + len(b) - 2 * common_length(a, b)) / 2
