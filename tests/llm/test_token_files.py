import tracemalloc
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from flowstat.llm import token_files as T
from flowstat.llm.common import scratch

from .helpers import empty, nasty

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "it's I'LL ''s 'S x<|endoftext|>y 12 3½", "é́ ÀB İstanbul Σς ß\x1c\x85z", "a'b''t \t\r\n it'S've", "ÀÉÎ õü naïve Ÿ",
         "x" * 5000, "日本語 text \U0001F600", "<|startoftext|>", "don't**stop!!||1,234.5", " nbsp em", "ªº µ ²"]


@pytest.mark.parametrize("text", TEXTS)
def test_encoder_equals_the_library(text):
    library = Tokenizer.from_file(PATH)
    assert np.frombuffer(T.Encoder(PATH).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_many_texts_and_another_tokenizer():
    """The texts together, and a file with other settings, which must not take the way by pieces."""
    for path, by_piece in ((PATH, True), (public_tokenizers.path("byte_bpe_50k.json"), False)):
        library, own = Tokenizer.from_file(path), T.Encoder(path)
        assert own.by_piece == by_piece
        want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS * 3]
        assert [x.tolist() for x in own.encode_all(TEXTS * 3)] == want


def test_words_end_where_the_library_ends_them():
    """Each plain character beside letters, in texts of one batch."""
    plain = [chr(c) for c in range(256) if T.PLAIN.fullmatch(chr(c))]
    texts = [f"{a}b{a}{a} Wörd{a}" for a in plain] + plain + ["".join(plain)]
    library = Tokenizer.from_file(PATH)
    assert [x.tolist() for x in T.Encoder(PATH).encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_taken_as_they_are_encoded():
    """A batch's texts are not all held: the first ids come before the later texts are read."""
    read, text = [], "some words " * 10_000
    found = T.Encoder(PATH).encode_all(read.append(i) or text for i in range(100))
    first = next(found)
    assert len(read) <= -(-T.TOGETHER // len(text)) < 30
    assert all((x == first).all() for x in found) and len(read) == 100


def test_memory_of_a_file():
    """Blocks are packed and unpacked some at a time: little more than the ids and the file's bytes."""
    ids = np.random.default_rng(5).integers(0, 50_000, 1 << 22).astype("<u4")
    tracemalloc.start()
    data = T.encode_file(ids, [len(ids)], [1])
    packed = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    got, _, _ = T.decode_file(data)
    unpacked = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert (got == ids).all()
    assert packed <= 3 * ids.nbytes and unpacked <= 2 * ids.nbytes


def test_kept_pieces_are_bounded():
    made = []
    kept = T.Kept(lambda p: made.append(p) or p.encode(), 10)
    for i in range(1000):
        assert kept[str(i % 25)] == str(i % 25).encode() and len(kept.new) + len(kept.old) <= 20
    for _ in range(50):
        assert kept["a"] == b"a"
    assert made.count("a") == 1


@pytest.mark.parametrize("high", [1, 2, 300, 2**16, 2**32 - 1])
def test_format_round_trip(high):
    rnd = np.random.default_rng(high % 1000)
    for n in (0, 1, 63, 64, 65, 4095, 4096, 4097, 20_000):
        ids = rnd.integers(0, high, n, dtype=np.uint64).astype("<u4")
        if n:
            ids[rnd.integers(0, n, n // 50)] = high - 1     # outliers
        lengths = [n // 3, n - n // 3]
        for percentile in (0.0, 0.5, 0.9, 1.0):
            got, l, d = T.decode_file(T.encode_file(ids, lengths, [None, -7], percentile))
            assert (got == ids).all() and l.tolist() == lengths and d == [None, -7]


def test_outliers_are_exceptions():
    ids = np.full(4096, 5, "<u4")
    ids[7] = 2**31
    assert len(T.encode_file(ids, [4096], [1])) < 100


def expected(rows, end=1):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_in_order(spark):
    rows = [(k * 7 % 120 - 20, t) for k, t in enumerate(TEXTS * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for file_ids in (50, 1 << 22):
        got = T.token_files(docs, PATH, file_ids=file_ids).orderBy("doc_id").collect()
        assert [tuple(r) for r in got] == expected(sorted(rows))


def test_nasty_and_empty(spark):
    got = T.token_files(nasty(spark), PATH).collect()
    assert len(got) == nasty(spark).count()
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)][:3] == [None] * 3
    assert {(r.n_tokens, r.ids_crc32) for r in got if r.doc_id in (1, 2, 3)} == {(1, zlib.crc32(np.array([1], "<u4").tobytes()))}
    assert T.token_files(empty(spark), PATH).count() == 0


def test_a_file_written_twice_is_whole(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    folder = scratch(spark, "test-files")
    for _ in range(2):     # the second attempt finds the first one's files
        manifest = T.write_files(docs, folder, PATH)
    assert [r.n_tokens for r in T.read_files(manifest, folder).orderBy("doc_id").collect()] == [3, 2]
