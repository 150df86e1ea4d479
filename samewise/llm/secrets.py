"""Secret scan: keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton over the ASCII-lower-cased text finds the keywords of
all kinds in one pass. An expression is tried only where a keyword of its kind
stands, and anchored there. A kind whose values carry a checksum is reported
only if the checksum holds. The bare hexadecimal kind has no keyword: its runs
are found by probing every 24th character, as any long enough run covers one.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import mapped


HEX_RUN = 24
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(token: str) -> bool:
    """The last six characters are the base-62 CRC-32 of the 30 before them."""
    value, out = zlib.crc32(token[-36:-6].encode()), ""
    while value:
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out.rjust(6, "0") == token[-6:]


def luhn(digits: str) -> bool:
    numbers = [int(c) for c in digits if c.isdigit()][::-1]
    return sum(numbers[::2]) % 10 == -sum(sum(divmod(2 * d, 10)) for d in numbers[1::2]) % 10 and len(set(numbers)) > 1


def mod97(account: str) -> bool:
    moved = re.sub(" ", "", account)
    return int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1


#: Characters of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def account_end(match: re.Match) -> int | None:
    """Where an account number of its country's length ends, if its checksum holds; what follows it is other text."""
    wanted, text, at = IBAN_LENGTHS.get(match[1][:2].upper()), match[1], 0
    if not wanted:
        return None
    for held, char in enumerate(c for c in text if c != " "):
        at = text.index(char, at) + 1
        if held + 1 == wanted:
            whole = not match.string[match.start(1) + at : match.start(1) + at + 1].isalnum()
            return match.start(1) + at if whole and mod97(text[:at].upper()) else None
    return None


def ends(ok: Callable[[re.Match], bool]) -> Callable[[re.Match], int | None]:
    """Where a match ends if it passes, else None."""
    return lambda match: match.end() if ok(match) else None


def json_header(token: str) -> bool:
    head = token.split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError, binascii.Error):
        return False


#: Name, keywords in lower case (an expression begins where its keyword does), expression, and where a match that passes its check ends.
#: The order is the order of ties. Checksums hold for forge, card and iban; a jwt's header must be JSON that names an
#: algorithm, and pem has its two marker lines (or its base64 lines, where the last is missing) in place of a checksum.
Kind = tuple[str, tuple[str, ...], re.Pattern, Callable[[re.Match], int | None]]
KINDS: tuple[Kind, ...] = (
    ("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
     re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
     ends(lambda m: len(m[2]) >= 6)),
    ("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), ends(lambda m: len(m[0]) >= 20)),
    ("hex", (), re.compile(r"[0-9a-f]+"), ends(lambda m: len(m[0]) >= HEX_RUN)),
    ("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), re.compile(r"(gh[pousr]|npm)_[0-9A-Za-z]{36}(?![0-9A-Za-z])"), ends(lambda m: crc_base62(m[0]))),
    ("jwt", ("eyj",), re.compile(r"eyJ[\w-]{8,}\.eyJ[\w-]{2,}\.[\w-]{8,}", re.ASCII), ends(lambda m: json_header(m[0]))),
    ("pem", ("-----begin ",), re.compile(r"-----BEGIN (?P<kind>(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----(?:(?:(?!-----)[\s\S])*-----END (?P=kind)-----|(?:\s*[A-Za-z0-9+/=]{16,})*)"), ends(lambda m: True)),
    ("card", ("card",), re.compile(r"card(?: number| no\.?)?[\"']?\x20*[:=#]?\x20*(\d(?:[ -]?\d){12,18})(?!\d)", re.ASCII | re.IGNORECASE), ends(lambda m: luhn(m[1]))),
    ("iban", ("iban",), re.compile(r"iban\x20*[:=]?\x20*([A-Z]{2}\d{2}(?: ?[0-9A-Z]){11,30})", re.ASCII | re.IGNORECASE), account_end),
)


@lru_cache(1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, (_, keywords, _, _) in enumerate(KINDS):
        for word in keywords:
            found.add_word(word, (number, len(word)))
    found.make_automaton()
    return found


@lru_cache(1)
def _hex_flags() -> np.ndarray:
    flags = np.zeros(0x110000, bool)
    flags[[ord(c) for c in "0123456789abcdef"]] = True
    return flags


def _hex_runs(text: str) -> list[tuple[int, int]]:
    """Spans of all maximal runs of at least HEX_RUN lower-case hexadecimal digits."""
    if len(text) < HEX_RUN:
        return []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    probes = np.flatnonzero(_hex_flags()[points[HEX_RUN - 1 :: HEX_RUN]]) * HEX_RUN + HEX_RUN - 1
    if len(probes):  # a run that covers a probe has HEX_RUN digits only if the eight on either side of it hold enough
        near = points[np.clip(probes[:, None] + np.arange(-8, 9), 0, len(points) - 1)]
        flags = _hex_flags()[near]
        probes = probes[flags[:, :9].all(1) | flags[:, 8:].all(1)]
    spans: list[tuple[int, int]] = []
    digits = "0123456789abcdef"
    for at in probes.tolist():
        if spans and at < spans[-1][1]:
            continue
        begin = at
        while begin and text[begin - 1] in digits:
            begin -= 1
        end = KINDS[2][2].match(text, begin).end()
        if end - begin >= HEX_RUN and (not spans or spans[-1][0] != begin):
            spans.append((begin, end))
    return spans


def scan(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, number of the kind, end) in code points, leftmost and non-overlapping for each kind, in order."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes.lower() is ASCII's
    past = [0] * len(KINDS)
    found = [(a, 2, b) for a, b in _hex_runs(text)]
    hits: list[tuple[int, int]] = sorted((end + 1 - size, number) for end, (number, size) in automaton().iter(lowered))
    for at, number in hits:
        if at < past[number]:
            continue
        match = KINDS[number][2].match(text, at)
        if match:
            end = KINDS[number][3](match)
            past[number] = match.end() if end is None else end
            if end is not None:
                found.append((at, number, end))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in spans)


def scanned(docs: DataFrame, carry: list[Column] | None = None) -> DataFrame:
    """Secrets in each whole text (null: empty).

    Returns the columns in ``carry`` (doc_id if none are named) and n_assign,
    n_access, n_hex, base_sha256 (of the spans of these three kinds), spans (of
    all kinds, ``kind:start:end`` joined by commas) and redacted (the text with
    each span's characters replaced by ``[REDACTED]``, overlapping spans as
    one). No spans: empty strings. Rows stay as they are.
    """
    carry = carry or [F.col("doc_id")]
    out = docs.select(*carry, F.col("text").alias("__text"))
    schema = out.drop("__text").schema
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"), ("spans", "string"), ("redacted", "string")):
        schema = schema.add(name, kind)

    def work(batches):
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                spans = scan(text or "")
                base = [s for s in spans if s[1] < 3]
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), redact(text, spans)))
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()] * 3, strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(batch.columns[:-1] + columns, names=schema.names)

    return mapped(out, work, schema)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for begin, _, end in spans:
        if begin >= at:
            parts += [text[at:begin], "[REDACTED]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with their columns as they are, but for secrets blotted out of text."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row")
    found = scanned(docs, [rest])
    return found.select(*[F.col("redacted").alias(c) if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
