"""Token ids in files of patched frame-of-reference blocks.

Texts are encoded with a public tokenizer, an end id is appended to each, and
the ids go in ascending ``doc_id`` order to files of at most about ``file_ids``
ids.  Rows are dealt over tasks by ranges of ``doc_id`` and sorted there, so
files follow each other in the order of their names; a manifest row for each
file (written as a table, the commit of the write) gives the number of ids, and
its running sum is where a file's first id stands in the whole.

File format, little-endian:

    magic "PFOR1\\0\\0\\0", u64 number of ids, u64 number of documents
    blocks of 4096 ids (the last one shorter), each:
        u32 minimum, u8 width, u8 0, u16 number of exceptions,
        ids minus minimum, their low `width` bits packed in groups of 64 values
        (a block is filled up to whole groups with its minimum),
        exceptions: u16 positions, then u32 values minus minimum
    document table: u32 ids per document, i64 doc_id, u8 1 where doc_id is null
    block index: u64 start of each block, u64 start of the document table

The width is that of the ``percentile`` quantile of the block's values; larger
ones are exceptions.  Files are written under a temporary name and renamed, so
an attempt that is lost or run twice leaves whole files only.

Cases.  Null text counts as empty: its ids are the end id alone.  Null ids come
first; rows with equal ids are ordered by a hash of the text.  Empty tables
give no file and an empty result.  Very long texts are encoded whole; a file ends
behind the document that fills it, however long that is.  Other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, scratch, whole

MAGIC = b"PFOR1\0\0\0"
BLOCK = 4096
HEAD = struct.Struct("<IBBH")

# ------------------------------------------------------------------ encoding
# Characters for which lower-casing, normalisation and the split into pieces can be
# told from the character alone; a text with any other goes to the library whole.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
# fixed values: the settings of the tokenizer file for which that holds, and its split pattern over lower-case plain characters
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None}
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
TOGETHER = 1 << 21  # characters whose words are looked up together
KEPT = 200_000      # pieces whose ids are kept, to twice as many
AT_ONCE = 64        # blocks packed or unpacked together


class Kept:
    """Ids (u32 bytes) by string, made when first met; the short strings met last are kept, ``most`` to
    twice as many."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.new, self.old = make, most, {}, {}

    def __getitem__(self, piece: str) -> bytes:
        ids = self.new.get(piece)
        if ids is None:
            ids = self.old.get(piece)
            if ids is None:
                ids = self.make(piece)
            if len(piece) <= 64:
                if len(self.new) >= self.most:
                    self.old, self.new = self.new, {}
                self.new[piece] = ids
        return ids


class Encoder:
    """The library's ids of whole texts.

    Where the file's own settings are the known ones (``KNOWN``), words between white space, and
    pieces inside them, are independent of each other.  Then the distinct words of many texts
    are split into pieces, a piece goes through the library's model once and its ids are kept, and the
    texts' ids are gathered from those of their words.  With any other file, whole texts go through the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        model = settings["model"]
        self.by_piece = (all(settings.get(k) == v for k, v in KNOWN.items()) and model["type"] == "BPE" and not model.get("dropout")
                         and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in settings["added_tokens"]))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + i for i, b in enumerate(hidden)}
        self.pieces = Kept(self._piece, KEPT)

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self.pieces[word]
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(word)))

    def _plain(self, text: str) -> bool:
        return self.by_piece and PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _gathered(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts."""
        # words in Arrow's memory; only the distinct ones become Python strings (an empty one has no ids)
        words = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
        coded = words.flatten().dictionary_encode()
        bounds, codes = words.offsets.to_numpy(), coded.indices.to_numpy()
        made = [self._word(w) for w in coded.dictionary.to_pylist()]
        ids, size = np.frombuffer(b"".join(made), "<u4"), np.array([len(m) // 4 for m in made], np.int64)
        first, sizes = (np.cumsum(size) - size)[codes], size[codes]
        del words, coded, codes, made
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(first - ends[:-1], sizes)
        at += np.arange(len(at))
        return np.split(ids[at], ends[bounds[1:-1]])

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of every text, in order; as many texts are held as have ``TOGETHER`` characters."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [self._plain(t) for t in texts]
        found = iter(self._gathered([t for t, p in zip(texts, plain) if p]) if any(plain) else ())
        for text, p in zip(texts, plain):
            yield next(found) if p else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text])).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# -------------------------------------------------------------------- format
def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, groups, 64) values below 2^width -> (blocks, groups, width) u64."""
    out = np.zeros((*values.shape[:2], width), "<u8")
    for j in range(64 if width else 0):
        word, off = divmod(j * width, 64)
        v = values[:, :, j].astype("<u8")
        out[:, :, word] |= v << np.uint64(off)
        if off + width > 64:
            out[:, :, word + 1] |= v >> np.uint64(64 - off)
    return out


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((*packed.shape[:2], 64), "<u4")
    mask = np.uint64((1 << width) - 1)
    for j in range(64 if width else 0):
        word, off = divmod(j * width, 64)
        v = packed[:, :, word] >> np.uint64(off)
        if off + width > 64:
            v = v | (packed[:, :, word + 1] << np.uint64(64 - off))
        out[:, :, j] = v & mask
    return out


def encode_file(ids: np.ndarray, lengths: list[int], doc_ids: list[int | None], percentile: float = 0.9) -> bytes:
    """A file's bytes from all ids of its documents."""
    parts = [MAGIC, struct.pack("<QQ", len(ids), len(lengths))]
    at, starts = 24, []
    whole_blocks = len(ids) // BLOCK * BLOCK
    some = [ids[a:min(a + AT_ONCE * BLOCK, whole_blocks)].reshape(-1, BLOCK) for a in range(0, whole_blocks, AT_ONCE * BLOCK)]
    for rows in (*some, ids[whole_blocks:].reshape(1, -1)):
        if not rows.size:
            continue
        least = rows.min(axis=1)
        rest = rows - least[:, None]
        rank = min(rest.shape[1] - 1, int(percentile * rest.shape[1]))
        typical = np.partition(rest, rank, axis=1)[:, rank]
        widths = np.array([int(x).bit_length() for x in typical])
        groups = -(-rest.shape[1] // 64)
        filled = np.zeros((len(rest), groups * 64), "<u4")
        filled[:, :rest.shape[1]] = rest
        packed: dict[int, bytes] = {}
        for w in np.unique(widths):
            which = np.flatnonzero(widths == w)
            low = filled[which] & np.uint32((1 << int(w)) - 1)
            for i, p in zip(which, _pack(low.reshape(len(which), groups, 64), int(w))):
                packed[i] = p.tobytes()
        for i, w in enumerate(widths):
            odd = np.flatnonzero(rest[i] >> np.uint32(w)) if w < 32 else np.empty(0, int)
            block = [HEAD.pack(least[i], w, 0, len(odd)), packed[i], odd.astype("<u2").tobytes(), rest[i][odd].astype("<u4").tobytes()]
            starts.append(at)
            at += sum(map(len, block))
            parts += block
    table = at
    parts += [np.array(lengths, "<u4").tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
              np.array([x is None for x in doc_ids], "u1").tobytes(), np.array([*starts, table], "<u8").tobytes()]
    return b"".join(parts)


def decode_file(data: bytes | memoryview) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
    """ids, ids per document, doc_ids of a file's bytes."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n, docs = struct.unpack_from("<QQ", data, 8)
    blocks = -(-n // BLOCK)
    starts = np.frombuffer(data, "<u8", blocks + 1, len(data) - 8 * (blocks + 1)).astype(int)
    ids = np.empty(n, "<u4")
    heads = [HEAD.unpack_from(data, s) for s in starts[:-1]]
    by_width: dict[tuple[int, int], list[int]] = {}
    for i, (_, w, _, _) in enumerate(heads):
        by_width.setdefault((w, min(BLOCK, n - i * BLOCK)), []).append(i)
    for w, size, which in [(*k, v[a:a + AT_ONCE]) for k, v in by_width.items() for a in range(0, len(v), AT_ONCE)]:
        groups = -(-size // 64)
        words = groups * w
        packed = np.stack([np.frombuffer(data, "<u8", words, starts[i] + HEAD.size) for i in which])
        values = _unpack(packed.reshape(len(which), groups, w), w).reshape(len(which), -1)
        for i, v in zip(which, values):
            least, _, _, odd = heads[i]
            if odd:
                at = starts[i] + HEAD.size + 8 * words
                v[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
            ids[i * BLOCK:i * BLOCK + size] = v[:size] + np.uint32(least)
    at = starts[-1]
    lengths = np.frombuffer(data, "<u4", docs, at)
    doc_ids = np.frombuffer(data, "<i8", docs, at + 4 * docs)
    null = np.frombuffer(data, "u1", docs, at + 12 * docs)
    return ids, lengths, [None if x else int(i) for i, x in zip(doc_ids, null)]


# --------------------------------------------------------------- write, read
def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1,
                file_ids: int = 1 << 22, percentile: float = 0.9) -> DataFrame:
    """Write the token files of ``docs`` (doc_id, text) and return the manifest:
    name, n_docs, n_tokens, base (ids of all files before)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        task, made = TaskContext.get().partitionId(), 0
        held, lengths, doc_ids = bytearray(), [], []

        def flush() -> pa.RecordBatch:
            name = f"part-{task:06d}-{made:06d}.pfor"
            data = encode_file(np.frombuffer(held, "<u4"), lengths, doc_ids, percentile)
            own = f"{path}/_{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as f:
                f.write(data)
            store.move(own, f"{path}/{name}")
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(lengths)], pa.int64()), pa.array([len(held) // 4], pa.int64())],
                names=["name", "n_docs", "n_tokens"])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id"), enc.encode_all(t.as_py() for t in batch.column("text"))):
                held += ids.tobytes() + end
                lengths.append(len(ids) + 1)
                doc_ids.append(doc_id.as_py())
                if len(held) // 4 >= file_ids:
                    yield flush()
                    made, held, lengths, doc_ids = made + 1, bytearray(), [], []
        if lengths:
            yield flush()

    ordered = (docs.select("doc_id", whole("text").alias("text"), F.xxhash64(whole("text")).alias("th"))
               .repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "text"))
    files = materialize(ordered.mapInArrow(write, "name string, n_docs long, n_tokens long"), "token-manifest")
    before = W.orderBy("name").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files that the manifest names."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("name"), batch.column("content")):
                ids, lengths, doc_ids = decode_file(memoryview(data.as_buffer()))
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(lengths), pa.string()), pa.array(doc_ids, pa.int64()), pa.array(starts),
                     pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["name", "doc_id", "at", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.pfor").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    docs = files.mapInArrow(read, "name string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (docs.join(manifest.select("name", "base"), "name")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, file_ids: int = 1 << 22,
                percentile: float = 0.9) -> DataFrame:
    """Write, read back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = scratch(spark, "token-files")
    manifest = write_files(docs, folder, tokenizer, end_id, file_ids, percentile)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_files(manifest, folder)
