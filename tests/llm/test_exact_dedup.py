import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from flowstat.llm.common import shared
from flowstat.llm.exact_dedup import exact_dedup, run_stream, sha256

from .helpers import empty, nasty


def expected(rows):
    """By plain grouping: (doc_id, keep_id, group_size, sha) of each row, sorted."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, max(known) if known else None, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def check(got, rows):
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    assert sum(r.kept for r in got) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("digest", [sha256, lambda t: F.substring(F.sha2(t, 256), 1, 1)], ids=["sha256", "colliding"])
def test_many_batches_nulls_ties_and_collisions(spark, tmp_path, digest):
    docs = nasty(spark).unionByName(nasty(spark)).repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(exact_dedup(spark, str(tmp_path / "documents.parquet"), digest, maxFilesPerTrigger=1).collect(), rows)


def test_named_state_goes_on(spark, tmp_path):
    """A second call of the same name reads the new files only; one without a name starts anew."""
    path, name = str(tmp_path / "documents.parquet"), f"test-{uuid.uuid4().hex}"
    first = [(1, "a"), (2, "b"), (5, None)]
    spark.createDataFrame(first, "doc_id long, text string").coalesce(1).write.parquet(path)
    check(exact_dedup(spark, path, name=name).collect(), first)
    more = [(3, "a"), (4, "")]
    spark.createDataFrame(more, "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    epochs = shared(spark, f"dedup-{name}/state")
    before = {(r.epoch, r.keep_id) for r in spark.read.parquet(epochs).collect()}
    check(exact_dedup(spark, path, name=name).collect(), first + more)
    after = {(r.epoch, r.keep_id) for r in spark.read.parquet(epochs).collect()}
    # the text "b" got no new row, so its state was not written again
    assert {keep for _, keep in after - before} == {3, 5}
    assert {r.keep_id: r.n for r in run_stream(spark, path, name=name).collect()} == {3: 2, 2: 1, 5: 2}
    check(exact_dedup(spark, path).collect(), first + more)


@pytest.mark.parametrize("end", ["", "/", "/*", "/*.[p]arquet"])
def test_paths(spark, tmp_path, end):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string").write.parquet(path)
    assert {r.keep_id: r.n for r in run_stream(spark, path + end).collect()} == {2: 2}


def test_empty(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    df = exact_dedup(spark, str(tmp_path / "documents.parquet"))
    assert df.count() == 0 and df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
