"""Golden vectors and properties of normalization and similarity."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samewise.functions import similarity as sim
from samewise.functions import text as t


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        ("--Acme Foods Pvt. Ltd.", "acme foods private limited"), ("Johnson&Johnson a & b", "johnsonandjohnson a & b"), ("  P.V.T Traders Incorporated ", "p v t traders inc"),
        ("Zyx Corporation", "zyx corp"), ("Éclair Straße", "eclair strasse"), (None, ""), ("", ""),
    ],
)
def test_clean_name(spark, raw, cleaned):
    assert one(spark, t.clean_name(F.col("a")), a=raw) == cleaned


def test_name_core(spark):
    assert one(spark, t.name_core(F.col("a")), a="zyx corp") == "zyx"
    assert one(spark, t.name_key(F.col("a")), a="a bc de") == "abcd"


@pytest.mark.parametrize(
    ("raw", "cleaned", "pin", "feature", "blocking", "city"),
    [
        ("No. 007, M.G. Rd, Pune, 411001", "number 007, m g road, pune, 411001", "411001", "007", "7", "pune"),
        ("12a St., Springfield, IL 90210-1234", "12a street , springfield, il 90210 1234", "90210", "90210", "90210", "springfield"),
        ("45678 Opp Mall, Lyon 69001", "45678 opposite mall, lyon 69001", "45678", "45678", "45678", ""),
        (None, "", "", "", "", ""),
    ],
)
def test_address(spark, raw, cleaned, pin, feature, blocking, city):
    row = spark.createDataFrame([(raw,)], "a string").select(t.clean_address(F.col("a")).alias("a"))
    row = row.select("a", t.pin(F.col("a")).alias("p"), t.house_no(F.col("a")).alias("f"), t.house_no(F.col("a"), True).alias("b"), t.city(F.col("a")).alias("c")).first()
    assert tuple(row) == (cleaned, pin, feature, blocking, city)


def test_tokens(spark):
    assert one(spark, F.array_join(t.sig_tokens(F.col("a")), "|"), a="abc services abcdef xy abd abcdef") == "abcdef|abcdef|abc"
    assert one(spark, F.array_join(t.addr_tokens(F.col("a")), "|"), a="123456, rose, road, lilies") == "lilies|rose"
    assert one(spark, t.token_count(F.col("a")), a=" ") == 0


@pytest.mark.parametrize(
    ("raw", "plain"),
    [
        ("राम café №5", "raama cafe No5"), ("Москва", "Moskva"), ("Αθήνα", "Athena"), ("東京", "dong jing "), ("ગુજરાત", "gujaraata"), ("서울", "seoul"), ("トヨタ", "toyota"),
        ("Łódź Straße", "Lodz Strasse"), (None, None), ("", ""),
    ],
)
def test_transliteration(spark, raw, plain):
    assert one(spark, t.transliterate(F.col("a")), a=raw) == plain


def test_names_of_other_scripts_have_keys(spark):
    for raw in ("شركة النور", "Газпром", "北京银行", "עברית", "ไทย"):
        assert len(one(spark, t.name_key(t.name_core(t.clean_name(F.col("a")))), a=raw)) >= 3


def test_similarity_vectors():
    assert sim.token_sort("new york", "new yrok") == 87.5
    assert sim.token_sort("acme foods", "foods acme") == 100
    assert sim.token_sort("acme foods", "acme food") == pytest.approx(94.736842)
    assert sim.token_sort("abc traders", "abc trading co") == 64
    assert sim.token_sort("", "acme") == 0
    assert sim.token_sort("", "") == 100
    assert sim.token_set("acme foods", "acme foods india") == 100
    assert sim.token_set("", "") == 0
    assert sim.partial("acme", "acme foods") == 100
    assert (sim.partial("", ""), sim.partial("", "x")) == (100, 0)
    assert sim.jaro_winkler_of("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert sim.jaro_winkler_of("dixon", "dicksonx") == pytest.approx(0.813333, abs=1e-6)
    assert sim.jaro_winkler_of("abcdef", "abxyzw") == pytest.approx(0.555556, abs=1e-6)
    assert sim.jaro_winkler_of("", "") == 1


def test_similarity_expressions(spark):
    pairs = [("kitten", "sitting"), ("", ""), ("acmefood", "acmefoods"), ("ab", "abc"), ("", "x"), ("a b", "b c"), ("street,", "street"), ("new york", "new yrok")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = rows.select(
        sim.levenshtein_similarity(a, b), sim.ngram_jaccard(a, b), sim.token_jaccard(a, b), sim.lcs_expression(a, b), sim.token_sort_ratio(a, b)
    ).collect()
    assert got[0][0] == pytest.approx(0.571429, abs=1e-6)
    assert got[1][0] == 1
    assert [got[2][1], got[3][1], got[4][1]] == [pytest.approx(6 / 7), 0, 0]
    assert [got[5][2], got[6][2]] == [pytest.approx(1 / 3), 0]
    assert [r[3] for r in got] == [sim.lcs_length(x, y) for x, y in pairs]
    assert [r[4] for r in got] == [sim.token_sort(x, y) for x, y in pairs]


def lcs_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    new = [0]
    for j, y in enumerate(b):
        new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
    return new


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
@settings(max_examples=200, deadline=None)
def test_similarity_properties(a, b):
    assert sim.lcs_length(a, b) == lcs_by_table(a, b)
    for function, most in ((sim.token_sort, 100), (sim.token_set, 100), (sim.partial, 100), (sim.jaro_winkler_of, 1)):
        assert 0 <= function(a, b) <= most + 1e-9
        assert function(a, b) == pytest.approx(function(b, a))
    windows = [b[i:j] for i in range(len(b)) for j in range(i + 1, len(b) + 1) if j - i == len(a) or (j - i < len(a) and (i == 0 or j == len(b)))]
    if a and len(a) < len(b):
        assert sim.partial(a, b) == pytest.approx(max(sim.ratio(a, w) for w in windows))


TEXTS = st.lists(st.tuples(st.text("abcé ", max_size=14), st.text("abcé ", max_size=14)), max_size=12)
LONGER = st.lists(st.tuples(st.text("ab cd", max_size=200), st.text("ab cd", max_size=200)), max_size=4)


@given(st.one_of(TEXTS, LONGER))
@settings(max_examples=150, deadline=None)
def test_batches_give_what_pairs_give(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    for batch, single in (
        (sim.lcs_lengths, sim.lcs_length), (sim.ratios, sim.ratio), (sim.token_sorts, sim.token_sort), (sim.token_sets, sim.token_set), (sim.partials, sim.partial),
        (sim.jaro_winklers, sim.jaro_winkler_of),
    ):
        assert batch(a, b).tolist() == pytest.approx([single(x, y) for x, y in pairs])


def test_null_sides_give_null(spark):
    rows = spark.createDataFrame([("a", None), (None, None), ("a b", "b a")], "a string, b string")
    assert [r[0] for r in rows.select(sim.token_sort_ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 100]
