import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epistar.functions import text as tx

AGE_CASES = {
    "Age10_14": (10, 14),
    "Age<18": (0, 18),
    "Age80+": (80, 200),
    "1_Age60+": (60, 200),
    "1_Age<60": (0, 60),
    "AgeUNK": (0, 200),
    "ALL": (0, 200),
    "HCW": (0, 200),
    "Age1_2_3": (None, None),
}


def test_age_bands(spark):
    df = spark.createDataFrame([(k,) for k in AGE_CASES], "g string")
    lo, hi = tx.age_band("g")
    got = {r.g: (r.lo, r.hi) for r in df.select("g", lo.alias("lo"), hi.alias("hi")).collect()}
    assert got == AGE_CASES


def test_row_hash_and_key(spark):
    import hashlib

    df = spark.createDataFrame([("2021-W10", "DE", None, "ALL")], "a string, b string, c string, d string")
    r = df.select(tx.composite_key("a", "b", "c", "d").alias("k"), tx.row_hash("a", "b", "c", "d").alias("h")).first()
    assert r.k == "2021-W10|DE|ALL"
    # a null keeps its place in the hash, or ("a", null, "b") and ("a", "b", null) would hash alike
    assert r.h == hashlib.sha256(b"2021-W10|DE|\0|ALL").hexdigest()


def test_row_hash_tells_parts_apart(spark):
    # every split of texts over the special characters is another row
    parts = [None, "", "|", "\\", "\0", "a|b", "a", "b", "a\\", "|b", "\\|", "\\\\"]
    rows = [(x, y) for x in parts for y in parts]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(tx.row_hash("x", "y").alias("h")).distinct().count() == len(rows)
    pairs = df.select(tx.row_hash("x", "y", sep=";").alias("h"))
    assert pairs.distinct().count() == len(rows)
    with pytest.raises(ValueError):
        tx.row_hash("x", sep="\\")


@pytest.mark.parametrize(
    "endpoint,slug",
    [
        ("movementindicators/json/", "movementindicators.json"),
        ("/nationalcasedeath_eueea_daily_ei/json/", "nationalcasedeath-eueea-daily-ei.json"),
        ("json/data.json", "colour-key.json"),
        ("Vaccine_Tracker/csv/data.csv", "vaccine-tracker.json"),
        ("file.csv", "file.csv"),
    ],
)
def test_slug(spark, endpoint, slug):
    df = spark.createDataFrame([(endpoint,)], "e string")
    assert df.select(tx.dataset_slug("e").alias("s")).first().s == slug


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _py_ratio(a, b):
    n = max(len(a), len(b))
    return 100 if n == 0 else (200 * (n - _lev(a, b)) + n) // (2 * n)


def _py_similarity(a, b):
    ts = lambda s: " ".join(sorted(s.split(" ")))
    return max(_py_ratio(a, b), (_py_ratio(ts(a), ts(b)) * 95 + 50) // 100)


words = st.text(alphabet="abcde ", min_size=1, max_size=14).map(lambda s: " ".join(s.split()) or "a")


@settings(max_examples=30, deadline=None)
@given(pairs=st.lists(st.tuples(words, words), min_size=1, max_size=25))
def test_similarity_and_window_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    lo, hi = tx.length_window(F.length("a"), 75)
    rows = df.select("a", "b", tx.similarity("a", "b").alias("s"), lo.alias("lo"), hi.alias("hi")).collect()
    for r in rows:
        assert r.s == _py_similarity(r.a, r.b)
        if r.s >= 75:
            # the length window never drops a pair that can reach the threshold
            assert r.lo <= len(r.b) <= r.hi


def test_similarity_word_order(spark):
    df = spark.createDataFrame([("republic czech", "czech republic")], "a string, b string")
    assert df.select(tx.similarity("a", "b").alias("s")).first().s == 95


def test_prefix(spark):
    df = spark.createDataFrame([("DEU",), (None,)], "t string")
    assert [r.p for r in df.select(tx.prefix("t").alias("p")).collect()] == ["DE", None]
