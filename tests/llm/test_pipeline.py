"""The pipeline keeps clean documents, drops copies and returns pieces of what is left."""

import corpus_pipeline


def test_pipeline(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == before.columns, name
        if name in ("language_id", "line_dedup"):
            assert docs.count() >= 0.95 * before.count()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.where("piece_ids IS NULL OR NOT round_trip").count() == 0 and rows.count() > 100
