"""The quality score keeps the labels' class prior when the sample is bounded."""

from pyspark.sql import functions as F

from slicedigest.llm.quality import fit_quality, score_quality


def test_small_samples_keep_the_score_level(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = docs.select("doc_id", F.when(F.xxhash64("doc_id") % 7 == 0, 0).otherwise(1).alias("quality"))  # texts tell nothing about them
    good = labels.agg(F.avg("quality")).first()[0]
    levels = {}
    for rows in (40, 4000):
        levels[rows] = score_quality(docs, fit_quality(docs, labels, sample_rows=rows)).agg(F.avg("score")).first()[0]
    print(good, levels)
    assert all(abs(v - good) < 0.08 for v in levels.values()), levels
