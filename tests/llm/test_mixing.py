from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowstat.llm import mixing

from .helpers import empty, nasty


def water_fill(sizes, epochs=3):
    """Targets of sources in order, by the rule as stated: cap, reshare, until none is above."""
    total, open_, target = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    left = float(total)
    while open_:
        share = {i: left * (i % 3 + 1) / sum(j % 3 + 1 for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > epochs * sizes[i]}
        if not over:
            for i in open_:
                target[i] = share[i]
            break
        for i in over:
            target[i] = float(epochs * sizes[i])
            left -= target[i]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1, 1000, 3, 0], [0, 0], [7], [1, 10, 100, 1000, 10000, 100000]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(water_fill(sizes))


def sample(spark, n=300):
    words = [(i, " ".join(["w"] * ((i * 37) % 90)), ["a", "b", None, "Z", "ä"][min(i % 9, 4)]) for i in range(n)]
    return spark.createDataFrame(words, "doc_id long, text string, source string")


def test_mix_meets_the_targets(spark):
    got = mixing.mix(sample(spark))[0].collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.size == (r.doc_id * 37) % 90 and r.taken <= 3 * r.size
    order = ["Z", "a", "b", "ä", None]
    expected = water_fill([sum(r.size for r in by[s]) for s in order])
    for s, t in zip(order, expected):
        assert {r.source_size for r in by[s]} == {sum(r.size for r in by[s])}
        assert by[s][0].target == pytest.approx(t)
        assert sum(r.taken for r in by[s]) == pytest.approx(t, rel=0.02)


def test_blocks_are_equal_and_cover_every_word(spark):
    rows = spark.createDataFrame([(f"r{i}", 1, (i * 13) % 40, 17, sum((k * 13) % 40 for k in range(50))) for i in range(50)],
                                 "row string, source_no int, size long, n_blocks long, source_size long")
    pieces = mixing.block_pieces(rows).collect()
    words, blocks = defaultdict(int), defaultdict(int)
    for p in pieces:
        words[p.row] += p.words
        blocks[p.block] += p.words
    assert dict(words) == {f"r{i}": (i * 13) % 40 for i in range(50) if (i * 13) % 40}
    assert set(blocks) == set(range(17)) and max(blocks.values()) - min(blocks.values()) <= 1


def test_schedule_is_even_in_every_prefix(spark):
    sources = spark.createDataFrame([(1, 64, 64, 64.0), (2, 64, 64, 128.0), (3, 64, 64, 192.0)],
                                    "source_no int, n_blocks long, source_size long, target double")
    slots = mixing.schedule(sources).orderBy("slot").collect()
    seen = defaultdict(int)
    for i, r in enumerate(slots, 1):
        assert r.rank == seen[r.source_no] and r.block == r.rank % 64
        seen[r.source_no] += 1
        assert all(abs(seen[k] - i * k / 6) <= 6 for k in (1, 2, 3))
    assert len(slots) >= 380


def test_reruns_agree(spark):
    once = sorted(map(tuple, mixing.mix(sample(spark))[0].collect()), key=str)
    again = sorted(map(tuple, mixing.mix(sample(spark).repartition(9, F.col("text")))[0].collect()), key=str)
    assert once == again


def test_mixed_documents(spark):
    docs = sample(spark).withColumns({"n_chars": F.char_length("text").cast("long"), "mix_key": F.lit("extra")})
    taken = {(r.doc_id): r.taken for r in mixing.mix(docs)[0].collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and r.mix_key == "extra"
    assert got == {i: t for i, t in taken.items() if t}


def test_nasty_and_empty(spark):
    got = mixing.mix(nasty(spark))[0].collect()
    assert len(got) == nasty(spark).count() and all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mixed_documents(nasty(spark)).columns == nasty(spark).columns
    assert mixing.mix(empty(spark))[0].count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0


def test_partial_texts_are_the_words_that_the_schedule_took(spark):
    """Documents over several blocks: every word as often as its block, in the text's own line breaks."""
    rows = [(i, " \n\n".join(f"d{i}w{k}\tx{k}" for k in range(40 + i)) + "\n", "ab"[i % 2]) for i in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    options = {"block_words": 16, "least_blocks": 3}
    taken, slots = mixing.mix(docs, **options)
    named = taken.withColumn("source_no", F.when(F.col("source") == "a", 1).otherwise(2))
    blocks = F.greatest(F.ceil(F.col("source_size") / 16), F.lit(3)).cast("long")
    pieces = mixing.block_pieces(named.select(F.concat_ws(":", "key", "copy").alias("row"), "source_no", "size", blocks.alias("n_blocks"), "source_size"))
    times = defaultdict(int)
    for r in slots.collect():
        times[r.source_no, r.block] += 1
    ids, words, got = {f"{r.key}:{r.copy}": r.doc_id for r in taken.collect()}, defaultdict(int), defaultdict(int)
    for p in pieces.collect():
        for w in rows[ids[p.row]][1].split()[p["from"]:p["from"] + p.words]:
            words[ids[p.row], w] += times[p.source_no, p.block]
    partial = 0
    for r in mixing.mixed_documents(docs, **options).collect():
        for w in r.text.split():
            got[r.doc_id, w] += 1
        assert rows[r.doc_id][1].startswith(r.text)
        partial += r.text != rows[r.doc_id][1]
    assert got == {k: n for k, n in words.items() if n} and partial
