"""String similarities: built-in expressions where Spark has them, numpy over whole Arrow batches where it has none.

The functions of one pair (``ratio``, ``token_sort`` and so on) state what is
computed; those of batches, named in the plural, give the same values.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """One minus the edit distance over the longer length; 1 for two empty texts."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def _jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def ngram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    """Jaccard of the sets of character n-grams; 0 if a text is empty or too short, 1 if they are equal."""

    def grams(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))

    short = (F.length(a) < n) | (F.length(b) < n)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(short, 0.0).otherwise(_jaccard(grams(a), grams(b)))


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of the sets of words between white space; 0 if a text is empty, 1 if they are equal."""

    def tokens(text: Column) -> Column:
        return F.filter(F.split(text, r"\s+"), lambda t: t != "")

    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.coalesce(F.try_divide(F.size(F.array_intersect(tokens(a), tokens(b))), F.size(F.array_union(tokens(a), tokens(b)))), F.lit(0.0)))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, all columns of a row at once in the bits of one integer."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """0 to 100: twice the common subsequence over both lengths; 100 for two empty texts."""
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best of three comparisons of the shared words and of the rest of either side; 0 if a side has no word."""
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    both = one & two
    if both and (one == both or two == both):
        return 100.0
    left, right = " ".join(sorted(one - two)), " ".join(sorted(two - one))
    shared = len(" ".join(sorted(both)))
    gap = 1 if both else 0
    total = 2 * (shared + gap) + len(left) + len(right)
    apart = len(left) + len(right) - 2 * lcs_length(left, right)
    best = 100.0 - 100.0 * apart / total
    if both:
        best = max(best, *(100.0 - 100.0 * (gap + len(x)) / (2 * shared + gap + len(x)) for x in (left, right)))
    return best


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter text against windows of the longer, clipped ones at both ends too."""
    if not a or not b:
        return 100.0 if a == b else 0.0

    def best(short: str, long: str) -> float:
        m, n, chars, most = len(short), len(long), set(short), 0.0
        spans = [(0, i) for i in range(1, m)] + [(i, i + m) for i in range(n - m + 1)] + [(i, n) for i in range(n - m + 1, n)]
        for begin, end in spans:
            # a window that ends (or, clipped at the end, begins) outside the short text's characters is never better than its neighbour
            if (long[begin] if end == n and end - begin < m else long[end - 1]) in chars:
                most = max(most, ratio(short, long[begin:end]))
                if most == 100.0:
                    break
        return most

    if len(a) == len(b):
        return max(best(a, b), best(b, a))
    return best(a, b) if len(a) < len(b) else best(b, a)


def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro similarity, raised for up to four equal first characters if it is above 0.7; 1 for two empty texts."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    m = len(left)
    swaps = sum(x != y for x, y in zip(left, (b[j] for j in range(len(b)) if taken[j]), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


# --- whole batches in numpy

WORD = 64
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _symbols(*sides: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Each side's texts as a matrix of small numbers, one for each character of the batch, with the texts' lengths; and how many there are."""
    points = [np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) for texts in sides]
    known, number = np.unique(np.concatenate(points), return_inverse=True)
    out, at = [], 0
    for texts, flat in zip(sides, points, strict=True):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        matrix = np.zeros((len(texts), int(lengths.max(initial=0)) or 1), np.int32)
        row = np.repeat(np.arange(len(texts)), lengths)
        matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = number[at : at + len(flat)]
        at += len(flat)
        out.append((matrix, lengths))
    return out, max(1, len(known))


def _places(matrix: np.ndarray, lengths: np.ndarray, kinds: int, words: int) -> np.ndarray:
    """For each text and character a bit set of where it stands, in ``words`` numbers of 64 bits."""
    bits = np.zeros((len(matrix), kinds, words), np.uint64)
    for i in range(min(matrix.shape[1], words * WORD)):
        row = np.flatnonzero(lengths > i)
        bits[row, matrix[row, i], i // WORD] |= np.uint64(1 << i % WORD)
    return bits


def _step(row: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """One character of the other text, for all rows: a zero bit stands for each step of the common subsequence."""
    hit = row & hit
    total, carry = np.empty_like(row), np.zeros(len(row), np.uint64)
    for w in range(row.shape[1]):
        part = row[:, w] + hit[:, w]
        total[:, w] = part + carry
        carry = ((part < row[:, w]) | (total[:, w] < part)).astype(np.uint64)
    return total | (row & ~hit)


def _zeros(row: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Zero bits among the first ``lengths`` bits; bits beyond them are never cleared."""
    return row.shape[1] * WORD - np.bitwise_count(row).sum(1, dtype=np.int64)


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Longest common subsequences of pairs of texts, a batch at a time."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(pairs), np.int64)
    size = np.fromiter((-(-len(x) // WORD) for x, _ in pairs), np.int64, len(pairs))
    for words in np.unique(size[size > 0]).tolist():
        chosen = np.flatnonzero(size == words)
        for rows in np.array_split(chosen, -(-len(chosen) // 1024)):
            rows = rows[np.argsort([-len(pairs[r][1]) for r in rows.tolist()], kind="stable")]  # the longest first: those at work are always the first ones
            ((short, m), (long, n)), kinds = _symbols([pairs[r][0] for r in rows.tolist()], [pairs[r][1] for r in rows.tolist()])
            places, state = _places(short, m, kinds, words), np.full((len(rows), words), _ALL)
            for j in range(long.shape[1]):
                live = int(np.searchsorted(-n, -j, side="left"))
                state[:live] = _step(state[:live], places[np.arange(live), long[:live, j]])
            out[rows] = _zeros(state, m)
    return out


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    return np.where(total > 0, 200.0 * lcs_lengths(a, b) / np.maximum(total, 1), 100.0)


def token_sorts(a: list[str], b: list[str]) -> np.ndarray:
    known = {x: " ".join(sorted(x.split())) for x in {*a, *b}}
    return ratios([known[x] for x in a], [known[x] for x in b])


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    known = {x: set(x.split()) for x in {*a, *b}}
    out, left, right, rows, shared = np.zeros(len(a)), [], [], [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        one, two = known[x], known[y]
        both = one & two
        if both and (len(both) == len(one) or len(both) == len(two)):
            out[i] = 100.0
        elif one and two:
            rows.append(i)
            left.append(" ".join(sorted(one - both)))
            right.append(" ".join(sorted(two - both)))
            shared.append(sum(map(len, both)) + len(both) - 1 if both else -1)
    if rows:
        l, r = (np.fromiter(map(len, side), np.float64, len(rows)) for side in (left, right))
        s = np.array(shared, np.float64)
        any_shared, s = s >= 0, np.maximum(s, 0)
        gap = any_shared.astype(np.float64)
        best = 100.0 - 100.0 * (l + r - 2 * lcs_lengths(left, right)) / (2 * (s + gap) + l + r)
        for rest in (l, r):
            best = np.maximum(best, np.where(any_shared, 100.0 - 100.0 * (gap + rest) / np.maximum(2 * s + gap + rest, 1), 0.0))
        out[rows] = best
    return out


def _best_windows(short: list[str], long: list[str]) -> np.ndarray:
    """The best ratio of each text against its windows in a text at least as long: a run of steps from each place of it."""
    out = np.zeros(len(short))
    size = np.fromiter((-(-len(x) // WORD) for x in short), np.int64, len(short))
    for words in np.unique(size).tolist():
        chosen = np.flatnonzero(size == words)
        for rows in np.array_split(chosen, -(-len(chosen) // 256)):
            ((a, m), (b, n)), kinds = _symbols([short[r] for r in rows.tolist()], [long[r] for r in rows.tolist()])
            places = _places(a, m, kinds, words)
            pair = np.repeat(np.arange(len(rows)), n)
            begin = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            steps = np.minimum(m[pair], n[pair] - begin)
            order = np.argsort(-steps, kind="stable")
            pair, begin, steps = pair[order], begin[order], steps[order]
            first, best, state = begin == 0, np.zeros(len(rows)), np.full((len(pair), words), _ALL)
            for t in range(1, int(steps[0]) + 1):
                live = int(np.searchsorted(-steps, -t, side="right"))
                state[:live] = _step(state[:live], places[pair[:live], b[pair[:live], begin[:live] + t - 1]])
                told = np.flatnonzero(first[:live] | (steps[:live] == t))  # whole windows, and each beginning of the text
                at = pair[told]
                np.maximum.at(best, at, 200.0 * _zeros(state[told], m[at]) / (m[at] + t))
            out[rows] = best
    return out


def partials(a: list[str], b: list[str]) -> np.ndarray:
    out = np.fromiter((100.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)), np.float64, len(a))
    rows = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y]
    if rows:
        sides = [(a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in rows]
        best = _best_windows([x for x, _ in sides], [y for _, y in sides])
        same = [k for k, (x, y) in enumerate(sides) if len(x) == len(y)]
        if same:
            best[same] = np.maximum(best[same], _best_windows([sides[k][1] for k in same], [sides[k][0] for k in same]))
        out[rows] = best
    return out


def _low_bits(count: np.ndarray) -> np.ndarray:
    return np.where(count >= WORD, _ALL, (np.uint64(1) << np.minimum(count, WORD - 1).astype(np.uint64)) - np.uint64(1))


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    """Characters are matched place by place, all pairs at once, in the bits of one number; longer texts than it has bits go one by one."""
    out = np.fromiter((1.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)), np.float64, len(a))
    rest = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y]
    for i in rest:
        if max(len(a[i]), len(b[i])) > WORD:
            out[i] = jaro_winkler_of(a[i], b[i])
    short = np.array([i for i in rest if max(len(a[i]), len(b[i])) <= WORD], np.int64)
    for rows in np.array_split(short, -(-len(short) // 1024)) if len(short) else []:
        ((one, m), (two, n)), kinds = _symbols([a[i] for i in rows.tolist()], [b[i] for i in rows.tolist()])
        places, taken = _places(two, n, kinds, 1)[:, :, 0], np.zeros(len(rows), np.uint64)
        reach = np.maximum(0, np.maximum(m, n) // 2 - 1)
        matched = np.zeros(one.shape, bool)
        for i in range(one.shape[1]):
            near = _low_bits(np.minimum(n, i + reach + 1)) & ~_low_bits(np.maximum(0, i - reach))
            free = np.where(m > i, places[np.arange(len(rows)), one[:, i]] & near & ~taken, np.uint64(0))
            taken |= free & (~free + np.uint64(1))
            matched[:, i] = free != 0
        met = (taken[:, None] >> np.arange(two.shape[1], dtype=np.uint64) & np.uint64(1)).astype(bool)
        count = matched.sum(1)
        swapped = np.bincount(np.nonzero(matched)[0], one[matched] != two[met], len(rows)).astype(np.int64) // 2
        some = np.maximum(count, 1)
        jaro = np.where(count > 0, (count / m + count / n + (count - swapped) / some) / 3, 0.0)
        prefix = np.zeros(len(rows), np.int64)
        for i in range(min(4, one.shape[1], two.shape[1])):
            prefix += (prefix == i) & (m > i) & (n > i) & (one[:, i] == two[:, i])
        out[rows] = np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)
    return out


def _each_once(function: Callable[[list[str], list[str]], np.ndarray], x: pd.Series, y: pd.Series) -> np.ndarray:
    """The function's values, with pairs that repeat within a batch compared once; null if a side is."""
    pairs = list(zip(x, y, strict=True))
    known = list({p for p in pairs if p[0] is not None and p[1] is not None})
    values = dict(zip(known, function([p[0] for p in known], [p[1] for p in known]).tolist(), strict=True)) if known else {}
    return np.array([values.get(p, np.nan) for p in pairs], np.float64)


def _pairwise(function):
    def make(a: Column, b: Column) -> Column:
        @F.pandas_udf("double")
        def compare(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series(_each_once(function, x, y)).astype("Float64").replace({np.nan: None}) if x.isna().any() or y.isna().any() else pd.Series(_each_once(function, x, y))

        return compare(a, b)

    return make


token_sort_ratio = _pairwise(token_sorts)
token_set_ratio = _pairwise(token_sets)
partial_ratio = _pairwise(partials)
jaro_winkler = _pairwise(jaro_winklers)

#: The ten comparisons of a pair of records, each from 0 to 1: what is compared, and how.
FUZZY = (
    ("name_jaro_winkler", 0, jaro_winklers, 1), ("name_token_sort_ratio", 0, token_sorts, 100), ("name_token_set_ratio", 0, token_sets, 100), ("name_partial_ratio", 0, partials, 100),
    ("addr_jaro_winkler", 1, jaro_winklers, 1), ("addr_token_sort_ratio", 1, token_sorts, 100), ("addr_token_set_ratio", 1, token_sets, 100), ("addr_partial_ratio", 1, partials, 100),
    ("combined_token_sort_ratio", 2, token_sorts, 100), ("combined_token_set_ratio", 2, token_sets, 100),
)


def fuzzy_comparisons(*sides: Column) -> Column:
    """A struct of all of FUZZY, of names, addresses and both combined (a, b, a, b, a, b): one Arrow function, so texts pass to Python once."""

    @F.pandas_udf(", ".join(f"{name} double" for name, *_ in FUZZY))
    def compare(n1: pd.Series, n2: pd.Series, a1: pd.Series, a2: pd.Series, c1: pd.Series, c2: pd.Series) -> pd.DataFrame:
        given = ((n1, n2), (a1, a2), (c1, c2))
        return pd.DataFrame({name: _each_once(function, *given[at]) / scale for name, at, function, scale in FUZZY})

    return compare(*sides)


def lcs_expression(a: Column, b: Column) -> Column:
    """The common subsequence's length in SQL functions alone: exact, interpreted, for cross-checks."""
    left = F.split(a, "")
    zero = F.transform(F.sequence(F.lit(0), F.length(a)), lambda _: F.lit(0))

    def step(row: Column, c: Column) -> Column:
        def cell(new: Column, j: Column) -> Column:
            same = F.element_at(left, j) == c
            value = F.when(same, F.element_at(row, j) + 1).otherwise(F.greatest(F.element_at(row, j + 1), F.element_at(new, -1)))
            return F.concat(new, F.array(value))

        return F.aggregate(F.sequence(F.lit(1), F.length(a)), F.array(F.lit(0)), cell)

    rows = F.aggregate(F.filter(F.split(b, ""), lambda c: c != ""), zero, step)
    return F.when((a == "") | (b == ""), 0).otherwise(F.element_at(rows, -1))
