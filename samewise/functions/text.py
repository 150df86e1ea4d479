"""Normalization of names and addresses as column expressions.

All functions take and give columns, so that whole cleaning runs inside the JVM;
only characters beyond Latin need :func:`transliterate`'s Arrow tail.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Word rules in the order in which they apply, and word lists.
NAME_RULES = (
    (r"\bpvt\b", "private"), (r"\bp\.v\.t\b", "private"), (r"\bltd\b", "limited"), (r"\bl\.t\.d\b", "limited"),
    (r"\bllp\b", "llp"), (r"\bllc\b", "llc"), (r"\binc\b", "inc"), (r"\bincorporated\b", "inc"), (r"\bcorp\b", "corp"),
    (r"\bcorporation\b", "corp"), (r"\bco\b", "co"), (r"\bcompany\b", "co"), (r"\b&\b", "and"), (r"\bpriv\b", "private"),
)
ADDRESS_RULES = (
    (r"\brd\b", "road"), (r"\bst\b", "street"), (r"\bstr\b", "street"), (r"\bave\b", "avenue"), (r"\bblvd\b", "boulevard"), (r"\bdr\b", "drive"),
    (r"\bln\b", "lane"), (r"\bapt\b", "apartment"), (r"\bunit\b", "unit"), (r"\bno\b", "number"), (r"\bnr\b", "near"), (r"\bopp\b", "opposite"),
)
LEGAL_WORDS = ("private", "limited", "llp", "llc", "inc", "corp", "co", "pvt", "ltd", "plc", "sarl", "sas", "gmbh")
GENERIC_NAME_WORDS = (
    "services", "associates", "enterprises", "solutions", "holdings", "group", "international", "consulting", "management", "industries", "trading",
    "products", "systems", "global", "company", "business", "corporation", "india", "pvt", "ltd", "limited", "private",
)
ADDRESS_STOPWORDS = (
    "road", "street", "avenue", "boulevard", "lane", "drive", "suite", "floor", "unit", "apartment", "building", "near", "opposite", "behind", "north",
    "south", "east", "west", "po", "box", "fl", "no", "shop", "dr", "rd", "st", "ave", "blvd", "ln", "apt", "first", "second", "third", "block",
    "sector", "plot", "district", "state", "city", "nagar", "colony", "marg", "bazaar", "bazar", "complex", "plaza", "chowk", "arcade", "mansion",
    "tower", "towers", "heights", "residency", "park", "garden", "market", "center", "centre", "mall", "enclave", "vihar", "puram", "gali", "delhi",
    "mumbai", "bangalore", "bengaluru", "kolkata", "hyderabad", "chennai", "pune", "ahmedabad", "jaipur", "surat", "lucknow", "kanpur", "nagpur",
    "indore", "thane", "bhopal", "patna", "vadodara", "ghaziabad", "ludhiana", "agra", "nashik", "faridabad", "meerut", "rajkot", "varanasi",
    "srinagar", "aurangabad", "dhanbad", "amritsar", "navi", "allahabad", "prayagraj", "ranchi", "howrah", "coimbatore", "jabalpur", "gwalior",
    "vijayawada", "jodhpur", "madurai", "raipur", "kota", "guwahati", "chandigarh", "noida", "gurgaon", "gurugram",
)
PIN = r"\b(\d{6}|\d{5}(?:-\d{4})?)\b"
HOUSE = r"\b(\d+[-/]?\d*)\b"
HOUSE_BLOCK = r"\b0*(\d+[-/]?\d*)\b"
NAME_KEY_LENGTH, MAX_NAME_TOKENS, MAX_ADDRESS_TOKENS = 4, 3, 2

#: Letters that become several, and letters without a decomposition.
MULTIPLE = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ĳ": "ij", "Ĳ": "IJ"}
SINGLE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H", "ı": "i", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
_CONSONANTS = "k kh g gh ng c ch j jh ny tt tth dd ddh nn t th d dh n n p ph b bh m y r r l l l v sh ss s h".split()
_VOWELS = "a aa i ii u uu r l e e e ai o o o au".split()
#: First code points of the Indic blocks, which share one layout.
_INDIC = (0x900, 0x980, 0xA00, 0xA80, 0xB00, 0xB80, 0xC00, 0xC80, 0xD00)


def _latin() -> tuple[str, str]:
    """Accented Latin letters and the letters under their accents, from the decomposition of U+00C0 to U+017F."""
    pairs = dict(SINGLE)
    for code in range(0xC0, 0x180):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha() and chr(code) not in MULTIPLE:
            pairs.setdefault(chr(code), base)
    return "".join(pairs), "".join(pairs.values())


@lru_cache(1)
def _indic() -> tuple[dict[str, str], dict[str, str]]:
    """Letters of the Indic blocks by their place in them, and the vowel signs, which take the place of a letter's inherent a."""
    letters, signs = {}, {}
    for block in _INDIC:
        letters |= {chr(block + 5 + i): v for i, v in enumerate(_VOWELS)} | {chr(block + 0x15 + i): c + "a" for i, c in enumerate(_CONSONANTS)}
        letters |= {chr(block + 0x66 + i): str(i) for i in range(10)} | {chr(block + 1): "n", chr(block + 2): "m", chr(block + 3): "h"}
        signs |= {chr(block + 0x3E + i): v for i, v in enumerate("aa i ii u uu r rr e e e ai o o o au".split())} | {chr(block + 0x4D): ""}
    return letters, signs


@lru_cache(1)
def script_table() -> dict[str, str]:
    """ASCII for the letters of other scripts, made on the driver by the transliterator among Spark's libraries.

    Letters are taken one by one, so that a table of them serves all executors;
    an ideograph's reading ends with a space. Empty without a running session.
    """
    session = SparkSession.getActiveSession()
    if session is None:
        return {}
    transliterator = session._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin; Latin-ASCII")
    letters = [chr(c) for c in range(0x180, 0x10000) if not 0xD800 <= c < 0xF900 and not any(b <= c < b + 0x80 for b in _INDIC) and unicodedata.category(chr(c))[0] in "LN"]
    table = {}
    for at in range(0, len(letters), 4000):
        part = letters[at : at + 4000]
        for letter, plain in zip(part, transliterator.transliterate("\n".join(part)).split("\n"), strict=True):
            plain = "".join(c for c in unicodedata.normalize("NFKD", plain) if c.isascii())
            table[letter] = plain + " " if unicodedata.name(letter, "").startswith("CJK UNIFIED") and plain else plain
    return table


def ascii_of(text: str | None, scripts: dict[str, str] | None = None) -> str | None:
    """Any text in ASCII: known letters by table, others by decomposition; what has neither goes."""
    if text is None or text.isascii():
        return text
    (letters, signs), out = _indic(), []
    for char in text:
        if char in MULTIPLE or char in SINGLE:
            out.append(MULTIPLE.get(char) or SINGLE[char])
        elif char in signs:
            if out and out[-1].endswith("a"):
                out[-1] = out[-1][:-1]
            out.append(signs[char])
        elif char in letters:
            out.append(letters[char])
        else:
            plain = "".join(c for c in unicodedata.normalize("NFKD", char) if c.isascii())
            out.append(plain or (scripts or {}).get(char) or "".join((scripts or {}).get(c, "") for c in unicodedata.normalize("NFKD", char)))
    return "".join(out)


def transliterate(text: Column, tail: bool = True) -> Column:
    """ASCII for accented Latin in the JVM; with ``tail``, for all other letters through an Arrow UDF, which sees only the rows that need it."""
    single, plain = _latin()
    out = F.translate(text, single, plain)
    for letter, letters in MULTIPLE.items():
        out = F.replace(out, F.lit(letter), F.lit(letters))
    if not tail:
        return out
    scripts = script_table()

    @F.pandas_udf("string")
    def rest(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: ascii_of(x, scripts), na_action="ignore")

    odd = out.rlike(r"[^\x00-\x7F]")
    return F.coalesce(rest(F.when(odd, out)), out)


def _rewritten(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    for pattern, word in rules:
        text = F.regexp_replace(text, pattern, word)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_name(name: Column, tail: bool = True) -> Column:
    text = F.regexp_replace(F.lower(transliterate(F.coalesce(name, F.lit("")), tail)), r"^[-*<>~.\s]+", "")
    return _rewritten(F.regexp_replace(text, r"[^a-z0-9&\s]", " "), NAME_RULES)


def clean_address(address: Column, tail: bool = True) -> Column:
    text = F.lower(transliterate(F.coalesce(address, F.lit("")), tail))
    return _rewritten(F.regexp_replace(text, r"[^a-z0-9\s,]", " "), ADDRESS_RULES)


def name_core(cleaned: Column) -> Column:
    return F.array_join(F.filter(F.split(cleaned, " "), lambda t: ~t.isin(*LEGAL_WORDS)), " ")


def name_key(core: Column, length: int = NAME_KEY_LENGTH) -> Column:
    return F.substring(F.regexp_replace(core, "[^a-z0-9]", ""), 1, length)


def pin(address: Column) -> Column:
    return F.regexp_extract(address, PIN, 1)


def house_no(address: Column, blocking: bool = False) -> Column:
    """The first number of an address; blocking drops its leading zeros, features keep them."""
    return F.regexp_extract(address, HOUSE_BLOCK if blocking else HOUSE, 1)


def city(address: Column) -> Column:
    """The last part between commas with three characters or more and no digit."""
    parts = F.transform(F.split(address, ","), lambda p: F.trim(p))
    return F.coalesce(F.try_element_at(F.filter(parts, lambda p: (F.length(p) >= 3) & ~p.rlike(r"\d")), F.lit(-1)), F.lit(""))


def country_norm(country: Column) -> Column:
    return F.lower(F.trim(F.coalesce(country, F.lit(""))))


def token_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda t: t != ""))


def combined(name: Column, address: Column) -> Column:
    return F.trim(F.concat_ws(" ", name, address))


def _longest(tokens: Column, most: int) -> Column:
    """The longest tokens, longest first, equal lengths in order of position."""
    placed = F.transform(tokens, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))
    return F.slice(F.transform(F.array_sort(placed), lambda s: s["t"]), 1, most)


def sig_tokens(core: Column) -> Column:
    return _longest(F.filter(F.split(core, " "), lambda t: (F.length(t) >= 3) & ~t.isin(*GENERIC_NAME_WORDS)), MAX_NAME_TOKENS)


def addr_tokens(address: Column) -> Column:
    words = F.split(F.regexp_replace(address, r"[^a-z0-9\s]", " "), " ")
    return _longest(F.filter(words, lambda t: (F.length(t) >= 4) & ~t.isin(*ADDRESS_STOPWORDS) & ~t.rlike(r"^\d+$")), MAX_ADDRESS_TOKENS)
