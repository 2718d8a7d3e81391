"""Jaccard self-join on word shingles by adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles (64-bit hashes); two
documents link when 100 * intersection >= 80 * union.  Shingles have one global
order, rare ones first.  If two sets link, then for every l the first
n - ceil(0.8 n) + l shingles of both share at least l.  Each document takes its
own l: a longer prefix costs more postings but asks for more shared shingles
before a pair is verified, so l is the one with the least estimated cost of
postings read plus candidates verified; a pair must share the smaller l of the
two.

Steps, each distributed:

1. One pass gives each document its number of shingles and the digest of its
   set, and adds every shingle to a table of counters of fixed size (the only
   thing sent to the driver and back: ``2 ** sketch_bits`` cells).  The counters
   give the order and the cost estimates; they never decide what is compared
   beyond that, so their collisions cost time only.
2. Documents with equal sets are one class.  Each class posts its prefix with the
   places of the shingles in it; a task posts a class once however many copies
   it reads.  A place bounds the sizes of sets that can link through it (the
   first l common shingles leave at least the needed overlap behind them), so
   postings whose shingle has a single class, or no class of a fitting size, are
   dropped.
3. Near copies in the thousands would make all pairs of their group, so classes
   are first compared with one other class only, the centre of the shingles that
   they share most: the class with the shingle at the earliest place, which has
   the fewest shingles of its own.  Linked ones merge into components.  This is
   repeated with other centres on postings that still hold several components.
4. What is left is compared in full: all pairs of classes in different
   components under one shingle, except that the largest component's members
   need no comparison with each other.  Pairs with fitting sizes and at least
   min(l) shared shingles at fitting places are verified on the whole texts.

So every pair of linked documents is either verified or already joined through
others, and groups of copies cost about as many comparisons as members.

Cases.  Null or wordless texts have no shingles and component_id = doc_id.
Texts of one to four words are a single shingle.  Null ids: a component's id is
its smallest non-null id.  Repeated rows are copies of each other.  Empty tables
give an empty result.  Extra columns are not read.

Shingles and set digests are hashes (64 and 128 bit): a false match inside one
pair of 20,000-word documents has a chance of about 1e-11.  A class is named by
64 bits of its digest.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, materialize, scratch, whole

WORDS = 5
SKETCH_ROWS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text; lower-cases A-Z only and
    splits at space and \\x09-\\x0D, as bytes do."""
    w = text.lower().split()
    n = len(w)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, n)
    k = min(WORDS, n)
    s = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        s = s * MIX + h[i:n - k + 1 + i]
    s ^= s >> np.uint64(32)
    s *= np.uint64(0xD6E8FEB86659FD93)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def set_digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def class_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def at_least(n: int) -> int:
    """Smallest number of shared shingles of a set of n in any link."""
    return (4 * n + 4) // 5


# ------------------------------------------------------------------- pass one
def _classes(docs: DataFrame, sketch_bits: int) -> DataFrame:
    """Rows of documents (doc_id, th, n, class) and, with ``part`` set, of counters."""
    cells, per_row = 1 << sketch_bits, (1 << sketch_bits) // SKETCH_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros(cells, np.int64), [], 0
        for batch in batches:
            n, ids = [], []
            for text in batch.column("text").cast(pa.binary()):
                s = shingles(text.as_py())
                n.append(len(s))
                ids.append(class_id(set_digest(s)) if len(s) else None)
                held.append(s >> np.uint64(64 - sketch_bits))
                size += len(s)
                if size > cells // 2:
                    counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int32()), pa.array(ids, pa.int64()),
                 pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())],
                names=["doc_id", "th", "n", "class", "part", "counts"])
        if held:
            counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells)
        if counts.any():
            blobs = [zlib.compress(c.astype("<u4").tobytes(), 1) for c in counts.reshape(SKETCH_ROWS, per_row)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SKETCH_ROWS, pa.int64()), pa.nulls(SKETCH_ROWS, pa.int64()), pa.nulls(SKETCH_ROWS, pa.int32()), pa.nulls(SKETCH_ROWS, pa.int64()),
                 pa.array(range(SKETCH_ROWS), pa.int32()), pa.array(blobs, pa.binary())],
                names=["doc_id", "th", "n", "class", "part", "counts"])

    return docs.mapInArrow(run, "doc_id long, th long, n int, class long, part int, counts binary")


def _sketch(found: DataFrame, sketch_bits: int) -> tuple[np.ndarray, float]:
    """The summed counters as quarter steps of their logarithm, one byte each (a fixed
    number of cells, whatever the input), and their mean."""
    per_row = (1 << sketch_bits) // SKETCH_ROWS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts")):
                c = np.frombuffer(zlib.decompress(blob.as_py()), "<u4").astype(np.int64)
                sums[part] = sums[part] + c if part in sums else c
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([quarters(c).tobytes() for c in sums.values()], pa.binary()),
             pa.array([int(c.sum()) for c in sums.values()], pa.int64())], names=["part", "steps", "total"])

    rows = (found.where("part is not null").select("part", "counts").repartition(SKETCH_ROWS, "part")
            .mapInArrow(add, "part int, steps binary, total long"))
    out, total = np.zeros((SKETCH_ROWS, per_row), np.uint8), 0
    for r in rows.collect():  # SKETCH_ROWS rows, a byte for each cell
        out[r.part] = np.frombuffer(r.steps, np.uint8)
        total += r.total
    return out.reshape(-1), total / out.size


def quarters(counts: np.ndarray) -> np.ndarray:
    return np.round(4 * np.log2(counts + 1.0)).astype(np.uint8)


# ------------------------------------------------------------------- postings
def prefix(s: np.ndarray, steps: np.ndarray, shift: int, floor: float, most: int) -> tuple[np.ndarray, int]:
    """The shingles a set posts, and the number l that a pair must share."""
    n, c = len(s), steps[(s >> np.uint64(shift)).astype(np.int64)]
    # rare first; the counters' logarithm in quarter steps, then the hash (s is sorted, the sort is stable)
    order = np.argsort(c, kind="stable")
    shortest = n - at_least(n)
    longest = min(most, at_least(n))
    others = np.cumsum(np.maximum(0.0, np.exp2(c[order[:shortest + longest]] / 4.0) - 1 - 2 * floor))[shortest:]
    share = np.arange(1, longest + 1)
    # postings read, plus candidates (those that share l are at most postings / l) times the cost of a verification
    best = int(np.argmin(share + others * (1 + n / 8 / share)))
    return s[order[:shortest + best + 1]], best + 1


def _postings(docs: DataFrame, held: Broadcast, floor: float, sketch_bits: int, most: int) -> DataFrame:
    """shingle, class, nip (size, place in the prefix, room for ``_earlier``, and l, packed); each task posts a class once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            tokens, ids, sizes = [np.empty(0, np.uint64)], [], []
            for text in batch.column("text").cast(pa.binary()):
                s = shingles(text.as_py())
                digest = set_digest(s)
                if not len(s) or digest in seen:
                    continue
                seen.add(digest)
                p, share = prefix(s, held.value, 64 - sketch_bits, floor, most)
                tokens.append(p)
                ids.append(np.full(len(p), class_id(digest), np.int64))
                sizes.append((len(s) << 32) + (np.arange(len(p), dtype=np.int64) << 8) + share)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(sizes))],
                    names=["shingle", "class", "nip"])

    return _crowded(docs.select("text").mapInArrow(run, "shingle long, class long, nip long"), "class")


PLACE = (1 << 24) - 1


def _size(nip: str) -> Column:
    return F.shiftright(nip, 32)


def _place(nip: str) -> Column:
    return F.shiftright(nip, 8).bitwiseAND(F.lit(PLACE))


def _earlier(nip: str) -> Column:
    return F.shiftright(nip, 4).bitwiseAND(F.lit(15))


def _with_earlier(postings: DataFrame) -> DataFrame:
    """Postings with the number of their class's earlier ones (15 at most) packed into ``nip``.  The ones left
    out stand under shingles that no class able to link has, so no earlier common shingle is among them."""
    before = F.row_number().over(W.partitionBy("class").orderBy(_place("nip"))) - 1
    return postings.withColumn("nip", F.col("nip") + F.shiftleft(F.least(before, F.lit(15)).cast("long"), 4))


def _share(nip: str) -> Column:
    return F.pmod(nip, F.lit(16))


def _crowded(postings: DataFrame, group: str) -> DataFrame:
    """Postings under shingles that hold several values of ``group``, and at least
    one class of a size that can link through the posting."""
    same = W.partitionBy("shingle")
    n = _size("nip")
    # a pair's l-th common shingle leaves an overlap of at most n - place + l - 1, and it
    # needs 4/9 (n + m) or more; 0.8 n <= m <= 1.25 n in any case
    tail = n - _place("nip") + _share("nip") - 1
    most = F.least(F.floor(n * 5 / 4), F.floor(tail * 9 / 4) - n)
    return (postings.withColumns({"low": F.min(group).over(same), "high": F.max(group).over(same),
                                  "n_low": F.min(n).over(same), "n_high": F.max(n).over(same)})
            .where((F.col("low") != F.col("high")) & (most >= F.col("n_low")) & (F.ceil(n * 4 / 5) <= F.col("n_high")))
            .drop("low", "high", "n_low", "n_high"))


def _can_link(a: str, b: str) -> Column:
    """Sizes fit, and neither place is too late for the overlap that they need."""
    n, m = _size(a), _size(b)
    # one of the first l common shingles, and of those before it no more than either class has posted
    tail = F.least(n - _place(a), m - _place(b)) + F.least(_share(a) - 1, _share(b) - 1, _earlier(a), _earlier(b))
    return (100 * F.least(n, m) >= 80 * F.greatest(n, m)) & (9 * tail >= 4 * (n + m))


# --------------------------------------------------------------- verification
def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) of classes -> those that link, compared on whole texts (class, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, None
        for batch in batches:
            keep = []
            b_ids = batch.column("b").to_pylist()
            for i, (b, x, y) in enumerate(zip(b_ids, batch.column("x").cast(pa.binary()), batch.column("y").cast(pa.binary()))):
                if b != last:
                    last, other = b, shingles(y.as_py())
                s = shingles(x.as_py())
                both = len(np.intersect1d(s, other, assume_unique=True))
                if 100 * both >= 80 * (len(s) + len(other) - both):
                    keep.append(i)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    left = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("x")), "a")
    both = left.join(texts.select(F.col("class").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """class, comp (its component's smallest class) for the ends of edges (a, b),
    by rounds of large and small stars, one job each."""
    def written(rows: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        out = materialize(rows.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")), "edges")
        return out, tuple(seen.get.values())

    e, state = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"))
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        before, (e, state) = state, written(small.unionByName(least.select("u", F.col("m").alias("v"))))
        if before == state:
            break
    return e.select(F.col("u").alias("class"), F.col("v").alias("comp"))


def _with_links(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links (a, b): a class's link to its component's name stands for all earlier ones."""
    if labels is None:
        return components(links)
    return components(labels.select(F.col("class").alias("a"), F.col("comp").alias("b")).unionByName(links))


# ----------------------------------------------------------------- the join
def _with_components(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with their class's component, under shingles that still hold several."""
    if labels is None:
        return _crowded(postings.withColumn("comp", F.col("class")), "comp")
    named = postings.join(labels, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    return _crowded(named.select("shingle", "class", "nip", "comp"), "comp")


def _stars(left: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b): each class and the centre with which it shares most shingles."""
    first = _place("nip") if number == 0 else F.xxhash64(F.lit(number), "class")
    centre = F.min(F.struct(first.alias("first"), "class", "nip", "comp")).over(W.partitionBy("shingle"))
    met = left.withColumn("c", centre).withColumns({"c_nip": F.col("c.nip"), "b": F.col("c.class")})
    return (met.where((F.col("comp") != F.col("c.comp")) & _can_link("nip", "c_nip"))
            .groupBy(F.col("class").alias("a"), "b").count()
            .groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b")))


def _all_pairs(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes in different components that share enough; no two of
    the largest component under a shingle."""
    sizes = left.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("shingle").agg(F.max_by("comp", F.struct("k", "comp")).alias("big"))
    named = left.join(largest, "shingle")
    a = named.where("comp <> big").select("shingle", *[F.col(c).alias(f"a_{c}") for c in ("class", "nip", "comp")])
    b = named.select("shingle", "big", *[F.col(c).alias(f"b_{c}") for c in ("class", "nip", "comp")])
    # each pair once: a minor meets the whole largest component, and other minors of smaller components
    once = (F.col("b_comp") == F.col("big")) | (F.col("a_comp") > F.col("b_comp"))
    return (a.join(b, "shingle").where((F.col("a_comp") != F.col("b_comp")) & once & _can_link("a_nip", "b_nip"))
            # which class is 'a' differs from shingle to shingle; the shared ones are counted under one order
            .groupBy(F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b"))
            .agg(F.count(F.lit(1)).alias("k"), F.first(F.least(_share("a_nip"), _share("b_nip"))).alias("l"))
            .where("k >= l").select("a", "b"))


def jaccard_join(docs: DataFrame, sketch_bits: int = 22, most_shared: int = 4, star_rounds: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text), and th, the text's hash."""
    text, spark = whole("text"), docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
    found = materialize(_classes(rows, sketch_bits), "join-classes")
    members = found.where("part is null").select("doc_id", "th", "n", "class")
    steps, floor = _sketch(found, sketch_bits)
    held = spark.sparkContext.broadcast(steps)
    shared = materialize(_with_earlier(_postings(rows, held, floor, sketch_bits, most_shared).dropDuplicates(["shingle", "class"])), "join-postings")
    held.destroy()

    labels = None
    if not shared.isEmpty():
        name = by_class(_texts(rows, members, shared.select("class").distinct()))
        texts = spark.table(name)
        for number in range(star_rounds):
            labels = _with_links(labels, materialize(verify(_stars(_with_components(shared, labels), number), texts), "join-links"))
        left = materialize(_with_components(shared, labels), "join-left")
        labels = _with_links(labels, materialize(verify(_all_pairs(left), texts), "join-links"))
        spark.sql(f"DROP TABLE {name}")  # the name only; its files are in the shared folder
    return _assign(members, labels)


def _texts(rows: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """class, text of one document of each of the classes."""
    one = (members.join(classes, "class").groupBy("class").agg(F.min(F.struct("doc_id", "th")).alias("r"))
           .select("class", F.col("r.doc_id").alias("r_id"), F.col("r.th").alias("r_th")))
    return (rows.join(one, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")))
            .dropDuplicates(["class"]).select("class", "text"))


def by_class(texts: DataFrame) -> str:
    """Write ``texts`` as a table bucketed by class in the shared folder, so that joins on
    the class move the other side only; the table's name."""
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"join_texts_{uuid.uuid4().hex}"
    (texts.repartition(n, "class").write.bucketBy(n, "class").sortBy("class")
     .option("path", scratch(spark, "join-texts")).saveAsTable(name))
    return name


def _assign(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    classes = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("low"))
    if labels is not None:
        classes = classes.join(labels, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    else:
        classes = classes.withColumn("comp", F.col("class"))
    ids = classes.groupBy("comp").agg(F.min("low").alias("component"))
    by_class = classes.join(ids, "comp").select("class", "comp", "component")
    return (members.join(by_class, "class", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                    "th", F.coalesce("comp", "class").alias("component_class")))


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """One row of each component: that of the smallest id (null last), then of the
    smallest text hash.  Rows of equal id and text are one document; wordless
    documents all stay."""
    def key(th: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), th)

    found, name = jaccard_join(docs, **parameters), fresh(docs, "join_key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th"))
    one = (found.where("component_class is not null").groupBy("component_class").agg(first.alias("r")).select("r.doc_id", "r.th")
           .unionByName(found.where("component_class is null").select("doc_id", "th").distinct())
           .select(key(F.col("th")).alias(name)))
    keyed = docs.withColumn(name, key(F.xxhash64(whole("text"))))
    return keyed.join(one, name, "left_semi").dropDuplicates([name]).drop(name)
