"""Merkle manifest, fingerprints and clustering against brute force, and for odd input."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from epistar.llm import fingerprint, merkle, ns_bounds

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text=None):
    doc_id, own, lang, source, n = row
    fields = [doc_id, source, lang, n, own if text is None else text]
    return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(levels, pos, digest):
    """(siblings' text, root folded from digest) of one tree given as lists of digests."""
    proof = ""
    for level in levels[:-1]:
        run = level[pos // 8 * 8 : pos // 8 * 8 + 8]
        before, after = "".join(run[: pos % 8]), "".join(run[pos % 8 + 1 :])
        proof, digest, pos = proof + before + after, h(before + digest + after), pos // 8
    return proof, digest


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def brute_merkle(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, members = {}, {}
    for lang in langs:
        own = [(r, leaf_of(r)) for r in rows if r[2] == lang]
        members[lang] = sorted(own, key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
        trees[lang] = tree([m[1] for m in members[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for pos, (row, leaf) in enumerate(members[lang]):
            tampered = row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            low, folded = climb(trees[lang], pos, leaf_of(row, small(row[1])) if tampered else leaf)
            high, folded = climb(top, k, folded)
            out.append((row[0], leaf, trees[lang][-1][0], top[-1][0], h(low + high), folded, folded == top[-1][0]))
    return out


def check(spark, rows, monkeypatch=None):
    import os
    import tempfile

    folder = tempfile.mkdtemp(prefix="epistar-test-")
    spark.createDataFrame(rows, DOC).write.parquet(os.path.join(folder, "documents.parquet"))
    return merkle.op11_merkle_manifest(spark, folder).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def test_merkle_equals_brute_force_over_several_levels(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace("DIV 4096", "DIV 16").replace("DIV 64 * 64", "DIV 4 * 4"))
    monkeypatch.setattr(merkle, "BLOCK", 16)
    monkeypatch.setattr(merkle, "SHARE", 4)
    langs = ["en"] * 6 + ["de", "fr", None, ""] + [f"l{k}" for k in range(9)]
    rows = [(i, f"Text Nr {i} É" * rng.randint(0, 3), rng.choice(langs), rng.choice(["a", None]), rng.choice([None, i])) for i in rng.sample(range(10**6), 700)]
    rows += [(None, "x", "en", "a", 1), (None, None, "en", "a", 1), (5, None, None, None, None), (-7, "Minus", "solo", "a", 1)]
    assert by_text(check(spark, rows).collect()) == by_text(brute_merkle(rows))


def test_merkle_small_and_repeated(spark):
    one = [(3, "Alone A", "en", "s", 7)]
    assert by_text(check(spark, one).collect()) == by_text(brute_merkle(one))
    assert check(spark, one).first()["proof_sha256"] == h("")
    twice = [(1, "Same", "en", "s", 4)] * 9 + [(1, "Other", "en", "s", 5), (2, "Same", "de", "s", 4), (9, "A" * 300_000, "de", "s", 4)]
    assert by_text(check(spark, twice).collect()) == by_text(brute_merkle(twice))
    none = check(spark, [])
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_merkle_ignores_other_columns_and_finds_tampering(spark):
    rows = [(i, f"Row {i}", "en" if i % 3 else "de", "s", i) for i in range(40)]
    frame = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS leaf", "1 AS slot", "2 AS tree", "3 AS _pid", "4 AS row_id")
    shown = {"text": F.when(F.col("doc_id") == 17, F.lit("forged")).otherwise(F.col("text"))}
    got = merkle.check_proofs(spark, merkle.build_manifest(frame, shown=shown)).collect()
    assert {r["row_id"] for r in got if not r["verified"]} == {17} and len(got) == 40


def test_runs_are_linked_and_no_key_serves_more_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 16)
    made = merkle.build_manifest(spark.createDataFrame([(i, str(i), "en", "s", i) for i in range(600)], DOC))
    runs = made.runs.collect()
    ids = {r["id"] for r in runs}
    assert all(r["parent"] in ids for r in runs if r["parent"] is not None) and {r["parent"] for r in runs} > {None}
    assert sorted(r["block"] for r in runs if r["parent"] is None) == list(range(600 // 16 + 1))


# ---------------------------------------------------------------- fingerprints


def jaccard(a, b):
    a, b = set(fingerprint.digests(a).tolist()), set(fingerprint.digests(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def text_of(rng, n):
    return " ".join(rng.choice(["lorem", "ipsum", "dolor.", "sit", "amet!\n", "elit"]) + str(rng.randint(0, 40)) for _ in range(n))


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, text_of(rng, rng.choice([0, 1, 5, 80, 600])), "en", "s", 0) for i in rng.sample(range(1000), 120)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s", 0), (2002, "é" * 5001, "en", "s", 0), (2003, " \n ", "en", "s", 0), (None, "No id. At all.", "en", "s", 0)]
    rows.append((2004, text_of(rng, 30_000), "en", "s", 0))
    frame = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS part", "2 AS packed", "3 AS id", "4 AS fingerprint")
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(frame.repartition(7)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    for k, row in enumerate(order):
        text, following = row[1] or "", order[(k + 1) % len(order)][1] or ""
        version = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        r = got[row[0]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), h(version))
        assert (r["fingerprint"], r["edited_fingerprint"]) == tuple(fingerprint.written(fingerprint.digests(t)) for t in (text, version))
        assert r["near_edited"] == pytest.approx(jaccard(text, version)) and r["near_next"] == pytest.approx(jaccard(text, following))


def test_fingerprints_of_few_and_repeated_rows(spark):
    none = fingerprint.fingerprints(spark.createDataFrame([], DOC))
    assert none.count() == 0
    alone = fingerprint.fingerprints(spark.createDataFrame([(4, "One line.\nAnother line.\nThird.", "en", "s", 1)], DOC)).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    same = fingerprint.fingerprints(spark.createDataFrame([(4, "Equal. Text.", "en", "s", 1)] * 30 + [(5, "Equal. Text.", "de", "t", 2)], DOC)).collect()
    assert len(same) == 31 and len({r["fingerprint"] for r in same}) == 1 and {r["near_next"] for r in same} == {1.0}


def test_peeling_recovers_the_differing_digests_and_retries_larger():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 500).astype(np.uint64)
    few = rng.integers(0, 2**63, (2, 6)).astype(np.uint64)
    a, b = np.concatenate([common, few[0]]), np.concatenate([common, few[1, :4]])
    only_a, only_b = fingerprint.peel([(a, b)], 16)[0]
    assert set(only_a) == set(few[0]) and set(only_b) == set(few[1, :4])
    many = rng.integers(0, 2**63, (2, 300)).astype(np.uint64)
    assert fingerprint.peel([(many[0], many[1])], 16) == [None]
    tried = []
    assert fingerprint.likenesses([(a, b), (many[0], many[1]), (a, a)], 16, tried) == [500 / 510, 0.0, 1.0]
    assert tried[0] == (16, 3) and all(n == 1 for _, n in tried[1:]) and tried[-1][0] > 16


def test_an_edit_keeps_the_paragraphs_elsewhere():
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 999)}" for _ in range(3000)]  # no sentence marks, no lines
    changed = words[:]
    changed[1500] = "changed"
    assert jaccard(" ".join(words), " ".join(changed)) > 0.98
    assert len(fingerprint.paragraphs(" ".join(words))) > 100


# ---------------------------------------------------------------- clustering


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, tuple(int(np.floor(1024.0 * float(x))) for x in v)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((h(f"3:{'' if i is None else i}"), v) for i, v in kept)[:k]
    centroids = [v for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else c for j, c in enumerate(centroids)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), centroids


def vectors(seed, n, centres=4, spread=0.1):
    rng = np.random.default_rng(seed)
    c = rng.normal(0, 1, (centres, 64))
    return [(i, [float(x) for x in c[i % centres] + rng.normal(0, spread, 64)]) for i in range(n)]


VEC = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_clusters_equal_brute_force(spark, spread):
    rows = vectors(3, 150, spread=spread)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 63 + [None]), (904, [float("nan")] * 64), (905, [float("inf")] + [0.0] * 63)]
    rows += [(7, rows[7][1])] * 3 + [(None, [0.25] * 64), (906, [0.0] * 64), (907, [0.0] * 64)]
    want, centroids = brute_clusters(rows)
    for refresh in (0.0, 0.3, 2.0):  # the state is written every round, sometimes, never
        report = []
        frame = spark.createDataFrame(rows, VEC).selectExpr("*", "1 AS cluster", "2 AS v", "3 AS seen").repartition(3)
        found, got = ns_bounds.cluster(frame, refresh=refresh, report=report)
        assert sorted(map(tuple, found.collect()), key=str) == want
        assert [tuple(map(int, c)) for c in got] == centroids
        assert report[0][1] == report[0][2]
        if spread < 1:
            assert report[-1][1] < report[-1][2] / 4 or refresh > 1


def test_cluster_query_on_few_rows_and_none(spark, scratch):
    path = f"{scratch}/embeddings.parquet"
    spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64), (4, [1e30] * 64)], VEC).write.parquet(path)
    rows = ns_bounds.op13_centroid_clustering(spark, scratch).collect()
    assert len(rows) == 4 and {r["distance"] for r in rows} == {0} and {r["inertia"] for r in rows} == {0}
    spark.createDataFrame([], VEC).write.mode("overwrite").parquet(path)
    assert ns_bounds.op13_centroid_clustering(spark, scratch).count() == 0


def test_superseded_state_is_removed(spark):
    first = ns_bounds.cut_lineage(ns_bounds.integer_vectors(spark.createDataFrame(vectors(1, 20), VEC), "vec_id", "embedding"))
    files = first.inputFiles()
    ns_bounds.drop_table(spark, first)
    import os

    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
