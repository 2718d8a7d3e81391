"""Mixing sources to target weights by a low-discrepancy schedule.

Sources in code-point order (null last) weigh 1, 2, 3, repeating.  Targets share
all words by weight; a source's target stops at ``epochs`` times its size and the
excess goes to the others by weight until none is above.  That is a water level
L with target = min(weight * L, epochs * size), found on the sorted ratios
epochs * size / weight by running sums over the table of sources.

A source's documents are shuffled by a hash and joined to one stream of words,
which is cut in equal blocks (their borders differ by one word at most).  A
schedule of slots is dealt over the sources: slot i stands at the i-th van der
Corput point (its binary digits mirrored at the point), which falls in one
source's part of the cumulative slot weights.  The r-th slot of a source takes its block r modulo the
number of blocks, so each block is taken about equally often and every prefix
of the schedule is mixed as the whole.  Slots beyond ``epochs`` rounds of a
source stay empty.

Running sums and ranks go in two steps (sums per chunk, then inside a chunk),
so a source with a third of all rows is not one task.  Only the tables of sources
and of chunk sums are in one window; they do not grow with the documents.

Cases.  Null and wordless texts have size 0, are in no block and taken is 0.
Null sources are one source.  Repeated rows are separate documents.  An empty
table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, materialize, whole, words_count

CHUNKS = 1024


def _before(*keys: str):
    return W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)


def targets(sizes: DataFrame, epochs: int = 3) -> DataFrame:
    """source, source_size -> and weight, target (one row for each source)."""
    last = F.col("source").isNull()
    ranked = sizes.withColumn("weight", F.pmod(F.row_number().over(W.orderBy(last, "source")) - 1, F.lit(3)) + 1)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    by_ratio = W.orderBy((F.col("source_size") / F.col("weight")), last, "source")
    filled = F.coalesce(F.sum(epochs * F.col("source_size")).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weights_left = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    level = (F.lit(total) - filled) / weights_left
    # the first source, by ratio, that its share does not fill sets the level; later candidates are lower
    found = ranked.withColumn("level", level).withColumn(
        "open", F.when(F.col("level") * F.col("weight") <= epochs * F.col("source_size"), F.col("level")))
    first_open = F.max("open").over(W.partitionBy())
    cap = (epochs * F.col("source_size")).cast("double")
    return (found.withColumn("target", F.least(F.coalesce(F.col("weight") * first_open, cap), cap))
            .select("source", "source_size", "weight", "target"))


def _blocks(size: Column, block_words: int, least_blocks: int) -> Column:
    """Number of equal blocks of a source of ``size`` words."""
    return F.greatest(F.ceil(size / block_words), F.least(size, F.lit(least_blocks))).cast("long")


def schedule(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """slot, source_no, rank, block from sources (source_no, n_blocks, source_size, target)."""
    spark = sources.sparkSession
    wanted = sources.withColumn("wanted", F.col("target") * F.col("n_blocks") / F.col("source_size"))
    n = int(round(wanted.agg(F.sum("wanted")).first()[0] or 0))
    edges = (wanted.withColumn("to", F.sum("wanted").over(W.orderBy("source_no").rowsBetween(W.unboundedPreceding, 0)))
             .withColumn("from", F.coalesce(F.lag("to").over(W.orderBy("source_no")), F.lit(0.0))))
    total = F.max("to").over(W.partitionBy())
    # parts of 1/grid that a source's interval touches: a slot meets the one or two sources of its part
    grid = 4096
    cell = F.explode(F.sequence(F.floor(F.col("lo") * grid).cast("int"), F.least(F.floor(F.col("hi") * grid), F.lit(grid - 1)).cast("int")))
    parts = (edges.withColumn("lo", F.col("from") / total).withColumn("hi", F.col("to") / total)
             .select("source_no", "n_blocks", "lo", "hi", cell.alias("cell")))
    digits = max(1, (n - 1).bit_length())
    mirrored = F.conv(F.reverse(F.lpad(F.bin("id"), digits, "0")), 2, 10).cast("double") / float(1 << digits)
    slots = spark.range(n).select(F.col("id").alias("slot"), mirrored.alias("at"))
    slots = slots.withColumn("cell", F.least(F.floor(F.col("at") * grid), F.lit(grid - 1)).cast("int"))
    # the last source's interval ends at 1 whatever the rounding
    placed = slots.join(parts, "cell").where((F.col("at") >= F.col("lo")) & ((F.col("at") < F.col("hi")) | (F.col("hi") >= 1.0)))
    placed = placed.withColumn("chunk", F.floor(F.col("slot") / 65536))
    counts = placed.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(_before("source_no", "chunk")), F.lit(0)).alias("off"))
    inside = F.row_number().over(W.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = placed.withColumn("inside", inside).join(offsets, ["source_no", "chunk"]).withColumn("rank", F.col("off") + F.col("inside"))
    return (ranked.where(F.col("rank") < epochs * F.col("n_blocks"))
            .select("slot", "source_no", "rank", F.pmod("rank", "n_blocks").alias("block")))


def block_pieces(rows: DataFrame, seed: int = 42) -> DataFrame:
    """row, block, words, from: each document's part in each block of its source's
    shuffled stream, from rows (row, source_no, size, n_blocks, source_size)."""
    keyed = rows.where("size > 0").withColumn("h", F.xxhash64(F.lit(seed), "row")).withColumn("chunk", F.pmod("h", F.lit(CHUNKS)))
    sums = keyed.groupBy("source_no", "chunk").agg(F.sum("size").alias("n"))
    offsets = sums.select("source_no", "chunk", F.coalesce(F.sum("n").over(_before("source_no", "chunk")), F.lit(0)).alias("off"))
    inside = F.coalesce(F.sum("size").over(W.partitionBy("source_no", "chunk").orderBy("h", "row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = (keyed.withColumn("inside", inside).join(offsets, ["source_no", "chunk"])
              .withColumn("start", F.col("off") + F.col("inside")).withColumn("end", F.col("start") + F.col("size")))

    # block b holds the words from floor(b * size / blocks) on
    def product(x: Column, y: str) -> Column:
        return x.cast("decimal(20,0)") * F.col(y).cast("decimal(18,0)")

    def block_of(word: Column) -> Column:
        return F.call_function("div", product(word + 1, "n_blocks") - 1, F.col("source_size"))

    def border(block: Column) -> Column:
        return F.call_function("div", product(block, "source_size"), F.col("n_blocks"))

    cut = placed.withColumn("block", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("end") - 1))))
    low = F.greatest(F.col("start"), border(F.col("block")))
    high = F.least(F.col("end"), border(F.col("block") + 1))
    return cut.select("row", "source_no", "block", (high - low).alias("words"), (low - F.col("start")).alias("from"))


def row_key() -> Column:
    """A document's name: its id, source and text, hashed."""
    return F.md5(F.to_json(F.struct("doc_id", "source", F.sha2(whole("text"), 256).alias("text"))))


def mix(docs: DataFrame, block_words: int = 512, least_blocks: int = 512, epochs: int = 3) -> tuple[DataFrame, DataFrame]:
    """The documents with their numbers of words taken (key, copy, doc_id, source,
    size, source_size, target, taken), and the schedule (slot, source_no, rank, block)."""
    rows = docs.select("doc_id", "source", words_count(whole("text")).cast("long").alias("size"), row_key().alias("key"))
    # equal rows are told apart by a number among themselves, so a row's name does not depend on partitions
    rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("key").orderBy("size")))
    rows = materialize(rows.withColumn("row", F.concat_ws(":", "key", "copy")), "mix-rows")
    sizes = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), epochs)
    sources = materialize(sizes.withColumn("source_no", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")))
                          .withColumn("n_blocks", _blocks(F.col("source_size"), block_words, least_blocks)), "mix-sources")
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    slots = materialize(schedule(sources.where("source_size > 0"), epochs), "mix-schedule")
    pieces = block_pieces(named.select("row", "source_no", "size", "n_blocks", "source_size"))
    times = slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (pieces.join(times, ["source_no", "block"])
             .groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    out = named.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.select("key", "copy", "doc_id", "source", "size", "source_size", "target", "taken"), slots


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: a document once for
    each whole time it is taken, and once more with its text up to the last word
    taken where the mix ends inside it.  A source's ranks take its blocks in order,
    so what is taken once more than the rest is always the opening."""
    key, copy, found, text = (fresh(docs, f"mix_{c}") for c in ("key", "copy", "found", "text"))
    taken, _ = mix(docs, **parameters)
    per_key = taken.where("taken > 0").groupBy(F.col("key").alias(key)).agg(
        F.map_from_entries(F.collect_list(F.struct("copy", F.struct("taken", "size")))).alias(found))
    number = F.row_number().over(W.partitionBy(key).orderBy(F.hash(*docs.columns)))
    rows = (docs.withColumn(key, row_key()).withColumn(copy, number).join(per_key, key)
            .withColumn(found, F.try_element_at(found, F.col(copy))).where(F.col(found).isNotNull()))
    rest = F.pmod(F.col(found)["taken"], F.col(found)["size"])
    word, first = "[^ \\x09-\\x0D]+", rest.cast("int")
    # each word behind the white space before it, as they stand in the text
    part = F.array_join(F.zip_with(F.slice(F.split("text", word, -1), 1, first),
                                   F.slice(F.regexp_extract_all("text", F.lit(word), F.lit(0)), 1, first), lambda a, b: F.concat(a, b)), "")
    times = F.call_function("div", F.col(found)["taken"], F.col(found)["size"]).cast("int")
    texts = F.concat(F.array_repeat(F.col("text"), times), F.when(rest > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    out = rows.withColumn(text, F.explode(texts))
    size = F.when(F.col(text) == F.col("text"), F.col("n_chars")).otherwise(F.char_length(text)) if "n_chars" in docs.columns else None
    return out.select(*[F.col(text).alias(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
