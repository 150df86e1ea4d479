"""Byte-level BPE over many texts at once: numpy finds the words, each distinct word is encoded once.

A text is cut into words as the byte-level pattern of the public 50k vocabulary
does (contractions, then letters, digits or other characters with one space
before them, then white space). The cut is done for a run of texts in one array
of code points; an open-addressing numpy table finds the words already seen by
this worker by a 64-bit hash and compares their code points, so two words with
one hash never share ids. Only new words go to the encoder of words, which is
the tokenizers library or :mod:`samewise.llm.bpe`. A tokenizer file with another
normalizer, another cut or another model gets whole texts through the library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import regex

from samewise.llm.common import runs_of

LETTER, NUMBER, SPACE, OTHER, END = 1, 2, 3, 0, 4
_PRIME = 0x9E3779B97F4A7C15
_PAD = 4
#: Characters that are worked on at once: their arrays stay near the cache.
RUN_CHARS = 1 << 18

#: Code points that Unicode 16 leaves unassigned and later versions make letters or numbers; the pattern follows Unicode 16.
LATER_THAN_UNICODE_16 = (
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f), (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2,
    0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2), (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5,
    0x10ec7), (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1), (0x1246f, 0x1246f), (0x12475, 0x1247f),
    (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3), (0x16ff2, 0x16ff3), (0x16ff4, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09,
    0x18d20), (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168), (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24),
    (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff), (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0,
    0x1e6f4), (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479), (0x3d000, 0x3fc3f),
)

#: A list of ids for each word, or the ids of all words and how many each word has.
IdEncoder = Callable[[list[str]], list[list[int]] | tuple[np.ndarray, np.ndarray]]


@lru_cache(1)
def class_table() -> np.ndarray:
    """The pattern's class of each code point."""
    every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    classes = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            begin, end = found.span()
            classes[begin:end] = kind
    for first, last in LATER_THAN_UNICODE_16:
        classes[first : last + 1] = OTHER
    return classes


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return series(_PRIME), series(pow(_PRIME, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``size`` of them."""
    return _powers(1 << max(19, (size - 1).bit_length()))


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit number's image under a fixed bijection that looks random; works in place."""
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def range_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points from each start up to the next.

    It is the mixed sum of a mixed number for each (place, code point), so that,
    unlike a polynomial's, it has no short structured texts that collide.
    """
    points, starts = points[starts[0] :], starts - starts[0]
    lengths = np.diff(np.append(starts, len(points)))
    values = np.arange(len(points), dtype=np.uint64)
    values -= np.repeat(starts.astype(np.uint64), lengths)
    values <<= np.uint64(21)
    values |= points
    return mixed(np.add.reduceat(mixed(values), starts) + lengths.astype(np.uint64))


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined with one separator after each (and padding), as code points, and the separators' places."""
    joined = "\n".join(texts) + "\n" * _PAD
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return joined, points, np.cumsum(lengths + 1) - 1


def words_of(points: np.ndarray, seps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words and the separators begin, and the class of each code point."""
    classes = class_table()[points]
    classes[seps] = END
    classes[seps[-1] :] = END
    begins = np.empty(len(points), bool)
    begins[0] = True
    np.not_equal(classes[1:], classes[:-1], out=begins[1:])
    begins[seps] = True
    begins[seps + 1] = True
    space = classes == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])
    last = last[classes[last + 1] != END]
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero(points[: seps[-1]] == 39)
    quote = quote[begins[quote] & (classes[quote + 1] == LETTER)]
    if len(quote):
        one, two = points[quote + 1], points[quote + 2]
        short = quote[np.isin(one, [ord(c) for c in "stmd"])]
        pair = one.astype(np.int64) * 0x200000 + two
        wide = quote[np.isin(pair, [ord(a) * 0x200000 + ord(b) for a, b in ("re", "ve", "ll")])]
        wide = wide[classes[wide + 2] == LETTER]
        for found, length in ((short, 2), (wide, 3)):
            begins[found + 1] = False
            begins[found + length] = True
    starts = np.flatnonzero(begins)
    return starts[starts <= seps[-1]], classes


class WordTable:
    """Ids of words, for one worker; it starts anew when ``most`` words, or ``most_chars`` characters of words, are held."""

    def __init__(self, encode: IdEncoder, special: dict[str, int] | None = None, most: int = 1 << 20, most_chars: int = 1 << 23):
        self.encode_words, self.special, self.most, self.most_chars = encode, special or {}, most, most_chars
        self._clear()

    def _clear(self) -> None:
        self.slots = 1 << 16
        self.keys = np.zeros(self.slots, np.uint64)
        self.at = np.zeros(self.slots, np.int32)
        self.words = 0
        self.begin, self.count = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0
        self.char_begin, self.char_count = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        self.chars, self.chars_used = np.zeros(1 << 18, np.uint32), 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        mask = self.slots - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        key = self.keys[slot]
        found = np.where(key == hashes, self.at[slot], -1)
        left = np.flatnonzero((key != hashes) & (key != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & mask
            key = self.keys[slot[left]]
            same = key == hashes[left]
            found[left[same]] = self.at[slot[left[same]]]
            left = left[~same & (key != 0)]
        return found

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = self.slots - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = hashes[free]
            won = free[self.keys[slot[free]] == hashes[free]]
            self.at[slot[won]] = numbers[won]
            done = np.zeros(len(hashes), bool)
            done[won] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & mask

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        (ids, counts_of), first = _flat(self.encode_words(words)), self.words
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.flat, self.used = _appended(self.flat, self.used, [ids])
        self.chars, self.chars_used = _appended(self.chars, self.chars_used, [points])
        self.words = first + len(words)
        for sizes, begins, counts, used in ((counts_of, "begin", "count", self.used), (map(len, words), "char_begin", "char_count", self.chars_used)):
            while self.words > len(getattr(self, begins)):
                for name in (begins, counts):
                    setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
            each = np.fromiter(sizes, np.int32, len(words))
            getattr(self, begins)[first : self.words] = used - int(each.sum()) + np.cumsum(each) - each
            getattr(self, counts)[first : self.words] = each
        numbers = np.arange(first, self.words, dtype=np.int32)
        if self.words * 2 > self.slots:
            old = self.keys != 0
            held, at = self.keys[old], self.at[old]
            while self.words * 2 > self.slots:
                self.slots *= 2
            self.keys, self.at = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
            self._put(held, at)
        self._put(hashes, numbers)

    def _differ(self, points: np.ndarray, begins: np.ndarray, lengths: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Places of the words whose code points are not those of the held word with their number."""
        wrong = lengths != self.char_count[number]
        ends = np.cumsum(lengths)
        place = np.arange(int(ends[-1]) if len(ends) else 0)
        own = place + np.repeat(begins - (ends - lengths), lengths)
        held = place + np.repeat(self.char_begin[number] - (ends - lengths), lengths)
        other = np.flatnonzero(points[own] != self.chars[np.minimum(held, self.chars_used - 1)])
        wrong[np.searchsorted(ends, other, side="right")] = True
        return np.flatnonzero(wrong)

    def _run(self, texts: list[str]) -> list[np.ndarray]:
        joined, points, seps = code_points(texts)
        starts, classes = words_of(points, seps)
        hashes = range_hashes(points[: seps[-1] + 1], starts)
        real = classes[starts] != END
        lengths = np.diff(np.append(starts, seps[-1] + 1))
        hashes = hashes[real]
        hashes[hashes == 0] = 1
        begins, lengths = starts[real], lengths[real]
        if self.words > self.most or self.chars_used > self.most_chars:
            self._clear()
        number = self._find(hashes)
        missing = np.flatnonzero(number < 0)

        def text(rows: np.ndarray) -> list[str]:
            return [joined[a : a + n] for a, n in zip(begins[rows].tolist(), lengths[rows].tolist(), strict=True)]

        if len(missing):
            new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            before = self.words
            self._add(new, text(missing[first]))
            number[missing] = before + back
        flat, begin, counts = self.flat, self.begin[number], self.count[number].astype(np.int64)
        odd = self._differ(points, begins, lengths, number) if len(number) else number
        if len(odd):  # another word holds the hash: these are encoded on their own each time
            own, sizes = _flat(self.encode_words(text(odd)))
            begin[odd], counts[odd] = len(flat) + np.cumsum(sizes) - sizes, sizes
            flat = np.concatenate([flat, own])
        ends_at = np.cumsum(counts)
        total = int(ends_at[-1]) if len(ends_at) else 0
        ids = flat[np.arange(total) + np.repeat(begin - (ends_at - counts), counts)]
        edges = np.append(0, ends_at)[np.searchsorted(begins, seps)]
        return np.split(ids, edges[:-1])

    def encode(self, texts: list[str], most_chars: int = RUN_CHARS) -> Iterator[np.ndarray]:
        """The ids (uint32) of each text, in order."""
        odd = [t for t in self.special if any(t in x for x in texts)]
        if odd:
            cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(odd, key=len, reverse=True)) + ")")
            for text in texts:
                parts = cut.split(text)
                ids = iter(list(self.encode([p for p in parts[::2] if p], most_chars)))
                yield np.concatenate([np.zeros(0, np.uint32), *(np.array([self.special[p]], np.uint32) if i % 2 else next(ids) for i, p in enumerate(parts) if p)])
            return
        for a, b in runs_of(texts, most_chars):
            yield from self._run(texts[a:b])


def _flat(encoded: list | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words (uint32), and how many each word has."""
    if isinstance(encoded, tuple):
        return encoded
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    return np.concatenate([np.zeros(0, np.uint32), *(np.asarray(x, np.uint32) for x in encoded)]), sizes


def _appended(held: np.ndarray, used: int, parts: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The array, grown by doubling, with the parts behind its ``used`` numbers, and how many are used now."""
    total = sum(map(len, parts))
    while used + total > len(held):
        held = np.concatenate([held, np.zeros_like(held)])
    if total:
        held[used : used + total] = np.concatenate(parts)
    return held, used + total


class WholeTexts:
    """Ids of whole texts from the tokenizers library, for files that :func:`cuts_words` does not know."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, texts: list[str], most_chars: int = RUN_CHARS) -> Iterator[np.ndarray]:
        for a, b in runs_of(texts, most_chars):
            yield from (np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts[a:b], add_special_tokens=False))


def cuts_words(spec: dict) -> bool:
    """Whether a tokenizer file cuts and encodes words as this module does: byte-level BPE by its usual pattern, nothing normalized."""
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = not any(t.get(flag) for t in spec.get("added_tokens", []) for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    plain &= not any(model.get(flag) for flag in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    usual = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    return bool(plain and usual and spec.get("normalizer") is None and model.get("type", "BPE") == "BPE")


class LibraryWords:
    """Ids of words from the tokenizers library, all words in one call.

    That call tells which ids come out, not where each word's end: byte-level tokens stand for
    as many bytes as they have characters, so each word's ids are those that fill its bytes.
    Where the ids do not fill the words in this way, words are encoded one by one.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        held = tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(held.values(), default=0) + 1, np.int64)
        self.bytes_of[list(held.values())] = [len(token) for token in held]

    def __call__(self, words: list[str]) -> list[list[int]] | tuple[np.ndarray, np.ndarray]:
        if words:
            ids = np.array(self.tokenizer.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
            filled = np.cumsum(self.bytes_of[np.minimum(ids, len(self.bytes_of) - 1)])
            last = np.searchsorted(filled, ends)
            if len(ids) and filled[-1] == ends[-1] and int(ids.max()) < len(self.bytes_of) and np.array_equal(filled[last], ends):
                return ids, np.diff(last, prepend=-1)
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


@lru_cache(2)
def library_table(path: str) -> WordTable | WholeTexts:
    """Texts encoded by the tokenizers library, word by word where the file allows; kept by each worker between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        if not cuts_words(json.load(file)):
            return WholeTexts(tokenizer)
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    return WordTable(LibraryWords(tokenizer), special)
