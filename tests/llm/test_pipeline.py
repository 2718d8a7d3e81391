import zlib

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from flowstat.llm import decontam
from flowstat.llm.common import materialize, table

from ..conftest import SF0001, SF001
from .helpers import empty, nasty
from .test_ngram_join import expected as components
from .test_token_files import PATH


def test_every_stage_by_brute_force(spark):
    """Each stage's decisions on its own input, recomputed plainly."""
    con = duckdb.connect()
    original = table(spark, SF001, "documents")
    labels = dict(con.execute(f"SELECT doc_id, quality FROM '{SF001}/labels.parquet'").fetchall())
    items = con.execute(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    tables = [original]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF001), name))
    assert all(t.columns == original.columns for t in tables[:-1])
    rows = [[tuple(r) for r in t.collect()] for t in tables]
    before, good, single, clean, mixed, tokens = rows
    ids = {r[0] for r in good}
    wrong = [i for i, q in labels.items() if (i in ids) != (q == 1)]
    assert len(wrong) <= 0.02 * len(labels) and set(good) <= set(before)
    assert {r[0] for r in single} == {c for _, _, c in components([r[:2] for r in good])} and len(single) == len({r[0] for r in single})
    found_by = decontam.searchers(items)
    assert sorted(clean) == sorted(r for r in single if not decontam.search(r[1], found_by)[1])
    whole = {r[0]: r for r in clean}
    words = {i: len(r[1].split()) for i, r in whole.items()}
    for r in mixed:
        assert r == whole[r[0]] or r[1].split() == whole[r[0]][1].split()[:len(r[1].split())]
    # a weight-3 source gets about three times the words of a weight-1 source
    sums = {}
    for r in mixed:
        sums[r[3]] = sums.get(r[3], 0) + len(r[1].split())
    sources = sorted({r[3] for r in clean})
    total = sum(words.values())
    assert abs(sum(sums.values()) - total) < 0.02 * total
    for k, s in enumerate(sources):
        own = sum(n for i, n in words.items() if whole[i][3] == s)
        assert sums[s] <= 3 * own
    library, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    found = sorted(tokens, key=lambda r: r[1])
    assert [r[0] for r in found] == sorted(r[0] for r in mixed)
    for r in found:
        assert r[1] == start
        start += r[2]
    crc = sorted(zlib.crc32(np.array(library.encode(r[1], add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in mixed)
    assert crc == sorted(r[3] for r in found)


def test_run_and_reruns_agree(spark):
    once = sorted(map(tuple, corpus_pipeline.run(spark, SF0001).collect()))
    assert once and once == sorted(map(tuple, corpus_pipeline.run(spark, SF0001).collect()))


def test_stages_take_nasty_and_empty_tables(spark):
    for docs in (nasty(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF0001)
            assert out.columns == docs.columns and out.count() <= 3 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).count() == docs.count()
