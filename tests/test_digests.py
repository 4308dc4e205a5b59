"""Two copies of a table compared by digests."""

from pyspark.sql import functions as F

from cartloom.operators import digests as d

ROWS = "k long, a string, bucket double"


def compare(spark, source, target, **given):
    left, right = (spark.createDataFrame(rows, ROWS) for rows in (source, target))
    found = d.differing_keys(left, right, ["k"], ["a", "bucket"], leaves=16, **given).collect()
    assert len({r.k for r in found}) == len(found)
    return {r.k: (r.status, r.source_rows, r.target_rows, r.columns) for r in found}


def test_findings(spark):
    same = [(i, f"v{i}", float(i)) for i in range(50)]
    assert compare(spark, same, same[::-1]) == {}
    source = same + [(60, None, 1.0), (61, "x", None), (None, "n", 1.0), (62, "r", 2.0)]
    target = same[1:] + [(60, "", 1.0), (61, None, None), (None, "m", 1.0), (62, "r", 2.0), (62, "r", 2.0), (70, "new", 0.0)]
    assert compare(spark, source, target) == {
        0: ("missing", 1, 0, []), 70: ("extra", 0, 1, []), 60: ("changed", 1, 1, ["a"]), 61: ("changed", 1, 1, ["a"]),
        None: ("changed", 1, 1, ["a"]), 62: ("changed", 1, 2, ["a", "bucket"]),
    }


def test_null_places_and_pairings(spark):
    # the same values in other cells, and the same values of a key paired otherwise
    assert compare(spark, [(1, None, 3.0)], [(1, "3.0", None)]) == {1: ("changed", 1, 1, ["a", "bucket"])}
    crossed = compare(spark, [(1, "a", 1.0), (1, "b", 2.0)], [(1, "a", 2.0), (1, "b", 1.0)])
    assert crossed == {1: ("changed", 2, 2, [])}


def test_empty_sides(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (None, None, None)]
    assert compare(spark, [], []) == {}
    assert compare(spark, rows, []) == {1: ("missing", 2, 0, []), None: ("missing", 1, 0, [])}
    assert compare(spark, [], rows) == {1: ("extra", 0, 2, []), None: ("extra", 0, 1, [])}


def test_only_unequal_buckets_are_read_and_levels_agree(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("a"), F.lit(1.0).alias("bucket"))
    hot = df.unionByName(df.sparkSession.range(10_000).select(F.lit(7).cast("long").alias("k"), F.lit("hot").alias("a"), F.lit(2.0).alias("bucket")))
    target = hot.where("k <> 123").repartition(5)
    leaves = [d.leaf_digests(x, ["k"], ["a", "bucket"], 256) for x in (hot, target)]
    bad = d.unequal_buckets(*leaves).collect()
    assert len(bad) == 1 and bad[0].source_rows == bad[0].target_rows + 1
    tops = [d.parent_digests(x, 16) for x in leaves]
    assert tops[0].count() == 16 and [r.bucket for r in d.unequal_buckets(*tops).collect()] == [bad[0].bucket // 16]
    kept = {"source": leaves[0], "target": leaves[1]}
    found = d.differing_keys(hot, target, ["k"], ["a", "bucket"], 256, kept)
    assert [(r.k, r.status) for r in found.collect()] == [(123, "missing")]
    whole = d.difference_rows(hot, found, ["k"]).collect()
    assert [tuple(r) for r in whole] == [(123, "v123", 1.0)]
