"""Token-set and partial forms of the fuzzy score, and that the blocking loses no pair."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from epistar.functions.text import ALL_FORMS, similarity
from epistar.operators import lookup as lk


def prepared(spark, names):
    rows = [(n, f"C{i}", i) for i, n in enumerate(names)]
    return lk.prepare_lookup(spark.createDataFrame(rows, "Name string, Code string, _pos long"), pos_col="_pos")


def words(rng, n, letters="aeioklmnrst"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_longer_official_names_match_their_short_ones(spark):
    entries = prepared(spark, ["Moldova", "United Kingdom", "Iran", "Viet Nam", "Korea, Republic of", "Germany", "Oman"])
    asked = ["Republic of Moldova", "United Kingdom of Great Britain", "Iran (Islamic Republic)", "Germny", "the Kingdm of Moldva islands", "Atlantis", "Om"]
    got = {r["_match_name"]: r["match_name"] for r in lk.best_fuzzy_matches(spark.createDataFrame([(a,) for a in asked], "_match_name string"), entries).collect()}
    assert got["Republic of Moldova"] == "moldova" and got["United Kingdom of Great Britain"] == "united kingdom"
    assert got["Iran (Islamic Republic)"] == "iran" and got["Germny"] == "germany"
    assert "Atlantis" not in got and "Om" not in got


def test_blocking_finds_the_best_of_all_pairs(spark):
    rng = random.Random(7)
    names = sorted({words(rng, rng.randint(1, 4)) for _ in range(150)} | {"a", "ab", "abc", "abcd", "of of of", "x y z"})
    asked = set(names[:20])
    for n in names:
        chars = list(n)
        for _ in range(rng.randint(0, 5)):
            chars[rng.randrange(len(chars))] = rng.choice("xyz ")
        asked.add("".join(chars))
        asked.add(" ".join(rng.sample(n.split(), len(n.split())) + [words(rng, 1)] * rng.randint(0, 3)))
        asked.add(n[rng.randrange(len(n)) :] + " " + words(rng, 2))
    entries = prepared(spark, names)
    frame = spark.createDataFrame([(a,) for a in sorted(asked)], "_match_name string")
    for least in (75, 60, 90):
        found = {(r["_match_name"], r["match_name"], r["match_score"]) for r in lk.best_fuzzy_matches(frame, entries, least).collect()}
        every = frame.withColumn("_norm", lk.normalize_name(F.col("_match_name"))).crossJoin(F.broadcast(entries))
        every = every.withColumn("s", similarity("_norm", "_lk_name", ALL_FORMS)).groupBy("_match_name").agg(
            F.max_by(F.struct("_lk_name", "s"), F.struct("s", -F.col("_lk_pos"))).alias("b"))
        want = {(r["_match_name"], r["b"]["_lk_name"], r["b"]["s"]) for r in every.where(F.col("b.s") >= least).collect()}
        assert found == want


def test_few_pairs_of_a_large_lookup_are_scored(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = sorted({words(rng, rng.randint(1, 4), letters) for _ in range(4000)})
    asked = [n + " " + words(rng, 1, letters) for n in rng.sample(names, 400)]
    cand = spark.createDataFrame([(a,) for a in asked], "_match_name string").withColumn("_norm", lk.normalize_name(F.col("_match_name")))
    pairs = lk.candidate_pairs(cand, prepared(spark, names), 75, ALL_FORMS).count()
    assert 400 <= pairs < 0.05 * len(names) * len(asked)
