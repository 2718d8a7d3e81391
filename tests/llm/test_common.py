from pyspark.sql import functions as F

from flowstat.llm.common import hash_sample


def test_sample_is_bounded_whatever_the_keys(spark):
    """A key on a third of the rows is passed over or fits; the same rows come from any partitions."""
    for hot in range(12):
        df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-hot - 1)).otherwise(F.col("id")).alias("k"), "id")
        n = hash_sample(df, 1000, "k").count()
        assert 700 <= n <= 1000
    even = spark.range(50_000).select(F.col("id").alias("k"))
    a, b = (sorted(r.k for r in hash_sample(df, 2000, "k").collect()) for df in (even, even.repartition(13)))
    assert a == b and 1800 <= len(a) <= 2000
    assert hash_sample(even.limit(10), 10, "k").count() == 10
    assert hash_sample(spark.range(5000).select(F.lit(1).alias("k")), 10, "k").count() <= 10
