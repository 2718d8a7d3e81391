"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the benchmark's windows of ten consecutive words (an item of fewer
words is one pattern).  Patterns of one length form a searcher.  Its shift table
maps a block of two words to the distance that the window may be moved on
without passing over an occurrence; blocks that are in no pattern move it by the
whole width.  Where the shift is zero, the bucket of the window's last block
names the patterns to compare, which are then compared word by word.

The benchmark is a stated query set: it is searched in blocks of at most
``block_windows`` patterns, one pass over the documents for each block, so what
a task holds is bounded whatever the benchmark's size.

Cases.  Null or wordless documents have no words and no hits.  Items that are
null or wordless are no window; items with a null id hit without being named.
Repeated items and repeated documents are separate rows.  Very long texts are
searched whole.  An empty benchmark hits nothing, empty documents give an empty
result.  Other columns are not read (``keep_clean`` passes them on).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

# fixed values: the contract's word characters
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(ASCII_LOWER) if not text.isascii() else text.lower()) if text else []


class Searcher:
    """All patterns of one length, as a shift table and suffix buckets."""

    def __init__(self, patterns: dict[tuple[str, ...], set[int]]):
        self.width = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.shift: dict[tuple[str, ...], int] = {}
        self.buckets: dict[tuple[str, ...], list[tuple[str, ...]]] = defaultdict(list)
        self.items = patterns
        for p in patterns:
            for end in range(b, m + 1):
                block = p[end - b:end]
                self.shift[block] = min(self.shift.get(block, m), m - end)
            self.buckets[p[m - b:]].append(p)

    def find(self, text: list[str]) -> Iterator[tuple[int, tuple[str, ...]]]:
        """(start, pattern) of each occurrence, in order."""
        m, b, shift, buckets = self.width, self.block, self.shift, self.buckets
        unseen, end, n = m - b + 1, m, len(text)
        while end <= n:
            block = tuple(text[end - b:end])
            step = shift.get(block, unseen)
            if step:
                end += step
                continue
            for p in buckets[block]:
                if text[end - m] == p[0] and tuple(text[end - m:end]) == p:
                    yield end - m, p
            end += 1


def searchers(items: Iterable[tuple[int | None, str | None]], width: int = 10) -> list[Searcher]:
    """One searcher for each pattern length of (item id, text) pairs."""
    by_length: dict[int, dict[tuple[str, ...], set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            p = tuple(w[i:i + width])
            by_length[len(p)][p].add(item)
    return [Searcher(dict(p)) for p in by_length.values()]


def search(text: str | None, found_by: list[Searcher]) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged hit spans (in words), items found."""
    w = words(text)
    spans, items = [], set()
    for s in found_by:
        for start, p in s.find(w):
            spans.append((start, start + s.width))
            items |= s.items[p]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return len(w), merged, items


RESULT = "n_words long, spans array<struct<s:int,e:int>>, items array<long>"


def _search_block(docs: DataFrame, block: list[tuple[int, str]], width: int) -> DataFrame:
    """docs (row, doc_id, text) -> row, doc_id and RESULT for one block of items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_by = searchers(block, width)
        for batch in batches:
            out = [search(x.as_py(), found_by) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keys),
                 pa.array([n for n, _, _ in out], pa.int64()),
                 pa.array([[{"s": a, "e": b} for a, b in s] for _, s, _ in out],
                          pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                 pa.array([sorted(x for x in i if x is not None) for _, _, i in out], pa.list_(pa.int64()))],
                names=[*keys, "n_words", "spans", "items"])

    keys = [c for c in docs.columns if c != "text"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{fields}, {RESULT}")


def item_blocks(benchmark: DataFrame, width: int, block_windows: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in blocks whose texts hold at most ``block_windows``
    patterns (an upper bound: one for each character run), or a single item."""
    size = F.greatest(F.size(F.split(F.coalesce("text", F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")), F.lit(1))
    block, held = [], 0
    for r in benchmark.select("item_id", "text", size.alias("n")).toLocalIterator():
        if block and held + r.n > block_windows:
            yield block
            block, held = [], 0
        block.append((r.item_id, r.text))
        held += r.n
    yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_windows: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit
    spans (word positions) and items themselves."""
    rows = docs.select("doc_id", "text")
    n, found = 0, None
    for block in item_blocks(benchmark, width, block_windows):
        n += 1
        if n == 1:
            found, first = _search_block(rows, block, width), block
            continue
        if n == 2:  # several passes meet by row: number the rows once, in a written table
            rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
            found = materialize(_search_block(rows, first, width), "decontam-pass")
        found = found.unionByName(materialize(_search_block(rows, block, width), "decontam-pass"))
    if n > 1:
        found = found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).drop("row")
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["to"]))).alias("n"),
                              F.greatest(a["to"], x["e"]).alias("to")), lambda a: a["n"].cast("long"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
                        "spans", "items")


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_windows: int = 200_000) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    def without(block: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found_by = searchers(block, width)
            for batch in batches:
                yield batch.filter(pa.array([not search(x.as_py(), found_by)[1] for x in batch.column("text")], pa.bool_()))
        return run

    for n, block in enumerate(item_blocks(benchmark, width, block_windows)):
        if n:  # written, or all blocks' searchers would stand in one task
            docs = materialize(docs, "decontam-clean")
        docs = docs.mapInArrow(without(block), docs.schema)
    return docs
