import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowstat.llm.sharding import domain, permute, shard

from .helpers import empty, nasty


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 1000, 4093])
def test_permutation(spark, n):
    got = [r.p for r in spark.range(n).select(permute(F.col("id"), n, 42).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    if n > 90:
        assert got != list(range(n))


def test_domain_holds_all_numbers():
    for n in [*range(1, 300), 10**6 + 3, 10**9 + 7]:
        a, b = domain(n)
        assert 0 <= a * b - n <= a


def test_sharding(spark):
    docs = nasty(spark)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    for shards in (4, 16):
        got = shard(docs, shards).collect()
        assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
            ((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows), key=str)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
            assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots[k]) for k in range(shards)]
        assert max(counts) - min(counts) <= 1


def test_same_whatever_the_partitions(spark):
    docs = nasty(spark)
    once = sorted(map(tuple, shard(docs).collect()), key=str)
    again = sorted(map(tuple, shard(docs.repartition(7, "text")).collect()), key=str)
    other = sorted(map(tuple, shard(docs, seed=1).collect()), key=str)
    assert once == again and once != other


def test_empty(spark):
    assert shard(empty(spark)).count() == 0
