"""The inverted index against a scan; the sample against a full sort; credential shapes."""

import random

import pytest
from pyspark.sql import functions as F

from cartloom.operators import audit
from cartloom.operators.search_index import search_index, write_index


@pytest.mark.parametrize("block_rows", [3, 100_000])
def test_search_equals_the_scan(spark, tmp_path, block_rows):
    rnd = random.Random(4)
    words = ["Red", "ball", "football", "ÉCLAIR", "a+b", "x%y", "Beach", "men", "women", "\t", "", "ball\nred"]
    texts = {i: " ".join(rnd.choice(words) for _ in range(rnd.randrange(7))) for i in range(200)}
    texts[200] = "ball " * 5000
    rows = [*texts.items(), (201, None), (None, "red ball")]
    write_index(spark.createDataFrame(rows, "id long, text string"), "id", F.col("text"), str(tmp_path), block_rows)
    for query in ["red", "Ball RED", "men", "éclair ball", "all", "a+b x%y", "nothing red", "", "  ", "ball ball", "women foot eac"]:
        terms = query.lower().split()
        want = sorted(i for i, t in texts.items() if terms and all(t_ in t.lower() for t_ in terms))
        assert sorted(r.id for r in search_index(spark, str(tmp_path), query).collect()) == want, query


def test_index_of_an_empty_table(spark, tmp_path):
    write_index(spark.createDataFrame([], "id long, text string"), "id", F.col("text"), str(tmp_path))
    assert search_index(spark, str(tmp_path), "red").count() == 0


@pytest.mark.parametrize("max_rows", [50, 1_000_000])
def test_sample_is_the_bottom_of_the_draws(spark, max_rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("row"))  # a third of the keys null
    for n in (0, 1, 700, 3000, 9000):
        got = audit.deterministic_sample(df.repartition(3), "k", n, 7, max_rows).collect()
        draws = [r.d for r in df.select(F.xxhash64("k", F.lit(7)).alias("d")).collect()]
        want = sorted(draws)[:n]
        kept = spark.createDataFrame(got, df.schema).select(F.xxhash64("k", F.lit(7)).alias("d")) if got else None
        assert len({r.row for r in got}) == len(want) and (kept is None or sorted(r.d for r in kept.collect()) == want)
    assert audit.deterministic_sample(df.limit(0), "k", 5, 7, max_rows).count() == 0


def test_credential_shapes(spark):
    texts = [
        "SHPAT_" + "0aF" * 8, "x shpss_" + "1" * 16 + " shpss_" + "2" * 20, "re_" + "a" * 20, "RE_" + "a" * 20, "-----BEGIN RSA PRIVATE KEY-----",
        "'" + "ab12" * 8 + "'", "", None, "nothing", "private key shpat_",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = [tuple(r) for r in audit.secret_scan(docs, "id", "text").collect()]
    assert {r[0] for r in found} == {0, 1, 2, 4, 5} and (1, "shared secret", 2) in found
