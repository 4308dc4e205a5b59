"""Centroid clustering, hard negatives and toxicity against brute force and held-out rows, with edge cases."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.llm import centroids, hard_negatives, toxicity

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, turn string, block string, _set string"


@pytest.fixture(scope="module")
def rows(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    real = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    odd = [(9000, None, 1), (9001, [math.nan] * 64, 1), (9002, [None] * 64, 1), (9003, [math.inf] * 64, 1), (9004, [0.5] * 63, 2), (9005, [], 3),
           (9006, [0.0] * 64, 0), (9006, [0.0] * 64, 0), (9007, [0.25] * 64, None), (None, [0.1] * 64, 4), (9100, real[0][1], 2), (9100, real[0][1], 2)]
    # One vector and one id hold a third of all rows.
    odd += [(9008, real[3][1], 5)] * 120
    return spark.createDataFrame([(*r, "t", "b", "s") for r in real + odd], SCHEMA)


def whole(row, scale, width=None):
    v = row.embedding
    if v is None or any(x is None or not math.isfinite(x) for x in v) or width is not None and len(v) != width:
        return None
    return [math.floor(scale * float(x)) for x in v]


def test_hard_negatives(rows):
    kept = [(r.vec_id, r.label, whole(r, 256)) for r in rows.collect() if r.vec_id is not None and r.label is not None]
    kept = [x for x in kept if x[2] is not None]
    expected = set()
    for anchor in sorted({x[0] for x in kept if x[0] % 50 == 0}):
        label, vector = min((x[1], len(x[2]), x[2]) for x in kept if x[0] == anchor)[::2]
        score = lambda v: sum(a * b for a, b in zip(vector, v, strict=False))  # noqa: B023, E731
        others = sorted(((-score(v), i, lab) for i, lab, v in kept if i != anchor))
        for p, positive in {(-s, i) for s, i, lab in [o for o in others if o[2] == label][:5]}:
            band = [(i, -s) for s, i, lab in others if lab != label and 30 * p <= 100 * -s <= 90 * p][:10]
            expected |= {(anchor, positive, n + 1, i, p, s) for n, (i, s) in enumerate(band)}
    for side in (32_768, 20):  # one meeting of all rows, and many small ones
        found = hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, side_rows=side)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == expected and expected
    assert hard_negatives.mine(rows.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.mine(rows, F.lit(False)).count() == 0


@pytest.mark.parametrize("most", [1, 300, 1 << 20, 1 << 33, 1 << 45])
def test_packed_products_are_exact(most):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-most, most + 1, (5, 7)), rng.integers(-most // 3, most + 1, (23, 7))
    packing = hard_negatives.Packing(7, int(a.min()), int(a.max()), int(b.min()), int(b.max()))
    exact = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    if max(abs(x) for r in exact for x in r) < 1 << 63:
        assert packing.scores(a, packing.pack(b), b.sum(axis=1)).tolist() == exact
    else:
        with pytest.raises(ValueError):
            packing.scores(a, packing.pack(b), b.sum(axis=1))


def brute_clusters(kept, k, rounds):
    """Plain rounds in Python's integers."""
    digest = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda x: (digest(x[0]), np.array(x[1], "<i2").tobytes()))
    middle = [v for _, v in order[:k]]
    away = lambda v: [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
    for _ in range(rounds):
        near = [min(range(len(middle)), key=away(v).__getitem__) for _, v in kept]
        for j in range(len(middle)):
            own = [v for (_, v), c in zip(kept, near, strict=True) if c == j]
            if own:
                middle[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = []
    for i, v in kept:
        d = away(v)
        out.append((i, min(range(len(d)), key=d.__getitem__), min(d)))
    return out, middle


@pytest.mark.parametrize("rounds", [0, 3])
def test_clusters(rows, rounds):
    kept = [(r.vec_id, whole(r, 1024, 64)) for r in rows.collect()]
    kept = [x for x in kept if x[1] is not None]
    expected, middle = brute_clusters(kept, 8, rounds)
    found = centroids.cluster_vectors(rows, rounds=rounds).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=key) == sorted(expected, key=key)
    total = sum(x[2] for x in expected)
    for r in found:
        assert r.inertia == total and r.cluster_inertia == sum(x[2] for x in expected if x[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest()


def test_clusters_of_few_rows(rows):
    assert centroids.cluster_vectors(rows.limit(0)).count() == 0
    few = centroids.cluster_vectors(rows.where("vec_id in (1, 2, 9006)"), rounds=2).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 9006, 9006] and all(r.distance == 0 for r in few)
    large = rows.sparkSession.createDataFrame([(1, [1e9] * 64), (2, [-1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        centroids.cluster_vectors(large)


def test_geometry_never_loses_too_little():
    """No vector of the sphere comes nearer to a moved centroid than the bound says; the bound is below the drift."""
    rng = np.random.default_rng(5)
    less = 0
    for _ in range(200):
        dims = int(rng.integers(2, 6))
        before = rng.integers(-1000, 1000, (4, dims))
        after = before + rng.integers(-60, 60, (4, dims))
        after[0] = before[0]
        radius = rng.uniform(0, 900, 4)
        drift, loss = centroids.drifts(before, after, radius)
        for i in range(4):
            x = rng.normal(size=(300, dims))
            x *= radius[i] / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
            x += before[i]
            for j in range(4):
                lost = np.linalg.norm(x - before[j], axis=1) - np.linalg.norm(x - after[j], axis=1)
                assert lost.max() <= loss[i, j] + 1e-6 and loss[i, j] <= drift[j] * (1 + 1e-6)
                less += loss[i, j] < 0.9 * drift[j]
    assert less > 500


def test_bounds_spare_scans():
    rng = np.random.default_rng(2)
    middle = rng.integers(-4000, 4000, (6, 8))
    vectors = np.concatenate([c + rng.integers(-200, 200, (50, 8)) for c in middle])
    exact = centroids.squares(vectors, middle)
    near, roots = exact.argmin(axis=1), np.sqrt(exact.astype(float))
    upper = roots[np.arange(len(near)), near]
    moved = middle + rng.integers(-20, 20, middle.shape)
    radius = np.array([upper[near == j].max() for j in range(6)])
    now, _, _, scanned = centroids.reassign(vectors, centroids.Moves(moved, *centroids.drifts(middle, moved, radius)), near, upper, roots)
    assert (now == centroids.squares(vectors, moved).argmin(axis=1)).all() and scanned < len(vectors) // 10


def test_toxicity(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    folder = "/root/testdata/sf0.01"
    real = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", F.lit("x").alias("key"), F.lit(2).alias("y"), F.lit(3).alias("predicted"))
    odd = [(7001, None), (7001, None), (7002, ""), (7003, "!!! ??? ###"), (7004, "1d10t " * 40_000), (7005, "日本語 😀 ΣΑΣ İ"), (None, "no id"), (7006, "\n\t ")]
    docs = real.unionByName(spark.createDataFrame([(*r, "x", 2, 3) for r in odd], "doc_id long, text string, key string, y int, predicted int"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labels = labels.unionByName(spark.createDataFrame([(7003, 1, None), (None, 0, 1), (1, None, 9)], "doc_id long, quality int, toxic int"))
    held = toxicity.held_out(docs)
    model = toxicity.train(docs, labels, ~held, trees=60)
    found = toxicity.score_texts(docs, model)
    assert found.columns == ["doc_id", "text", "key", "y", "score", "predicted"]
    got = found.withColumn("held", held).join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(got) == 1000 + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    judged = [r for r in got if r.held and r.toxic is not None]
    bad, fine = [r.score for r in judged if r.toxic], [r.score for r in judged if not r.toxic]
    pairs = [(a > b) + 0.5 * (a == b) for a in bad for b in fine]
    assert sum(pairs) / len(pairs) > 0.9
    empty = {r.score for r in got if not (r.text or "")}
    assert len(empty) == 1 and empty.pop() < 0.5
    # Only texts count: other ids and the order of rows change nothing.
    again = {r.text: r.score for r in toxicity.score_texts(docs.select("text").orderBy(F.desc("text")), model).collect()}
    assert all(again[r.text] == r.score for r in got)
    assert toxicity.train(docs.limit(0), labels, ~held) is None and toxicity.train(docs, labels.where("toxic = 0"), ~held) is None
    assert {r.score for r in toxicity.score_texts(docs, None).collect()} == {0.0}
    assert toxicity.score_texts(docs.limit(0), model).count() == 0


def test_units_match_plain_reading():
    """Words, hidden words and counts against regular expressions."""
    import re

    texts = ["You are an 1d10t, st.up.id!!", "", "SHOUT loud?! aaargh", "plain words only", "über Größe 42", None]
    import pyarrow as pa

    for _, _, found in toxicity.parts_of(pa.array(texts, pa.string())):
        words = [w for t in texts for w in re.findall(r"[a-z\x80-\U0010ffff]+", (t or "").lower())]
        real = found.hashes["word"] != 0
        assert found.hashes["word"][real].tolist() == toxicity.hash_words(words).tolist()
        plain = set(found.hashes["plain"][found.hashes["plain"] != 0].tolist())
        assert {int(h) for h in toxicity.hash_words(["idiot", "stupid"])} <= plain
        assert found.counts[0, 2] == 2 and found.counts[2, 1] == 1 and found.counts[2, 9] == 1 and found.counts[1].sum() == 0


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(0)
    margin, y, weight = rng.normal(size=60), rng.integers(0, 2, 60).astype(float), rng.uniform(0.5, 2, 60)
    knots, values = toxicity.isotonic(margin, y, weight)
    assert (np.diff(values) >= 0).all() and (np.diff(knots) > 0).all() and values.min() > 0 and values.max() < 1


def test_trees_fit_an_exclusive_or():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    forest = toxicity.boost(x, y, 40, 3, 0.3)
    assert ((forest.margin(x) > 0) == y).mean() > 0.97
