"""Secret scan: fixed formats, and random strings by two character Markov models.

Fixed formats (base spans) are assignments to names like ``password``, access
keys and long hexadecimal strings; see ``BASE``.

The method's own spans, of kind ``random``, are runs of key characters that look
drawn at random.  Two first-order Markov models over the characters of keys,
one of random strings and one of ordinary identifiers, give each run the mean
log-likelihood ratio per transition; a run is a secret if it is above the
threshold.  The models are transition counts with one added to each, learned
over all documents: values of base spans are the random class; the ordinary
class is runs of key characters of any length from ``least`` on that overlap no
base span and are shaped as identifiers (``ORDINARY``: words, capitals and
numbers, joined by separators or by case).  The threshold is the ratio that
``quantile`` of the ordinary runs stay under, and not below zero; those as long
as the runs that are scored, which are few among the words, must stay under it
at that share by themselves.  The models are a table of fixed size
(``len(ALPHABET) ** 2`` pairs).

A random span is only added where no base span overlaps it.

Everything runs in DataFrame functions.  Cases.  Null text counts as empty.
Places are in code points.  With no sample of a class its model is uniform.
Repeated rows are scanned row by row; empty tables give an empty result; extra
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, whole
from .spans import joined, names, overlapping, spans

# fixed values: the contract's formats
KEYWORDS = "password|passwd|secret|token|api_?key"
VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = f"(?i:{KEYWORDS})[\"']?\\x20*+[:=]\\x20*+[\"']?{VALUE}++"
ASSIGN_HEAD = f"^(?i:{KEYWORDS})[\"']?\\x20*+[:=]\\x20*+[\"']?"
ACCESS = "AKIA[A-Z0-9]{12,}+"          # 16 characters or more; a shorter run holds no longer one
HEX = "(?<![0-9a-f])[0-9a-f]{32,}+"     # a maximal run
# --------------------------------------------------------------------------
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# runs of key characters with a letter among them (long numbers are no keys)
LONG = 16
RUN = f"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{{{LONG},}}+"
# identifiers: parts between separators are words or capitals of three letters or more, with a number behind and a
# longer word behind that, or one or two letters with a number, or a number
WORD = "(?:[A-Z]?[a-z]{3,}+|[A-Z]{3,}+)++"
ORDINARY = f"^[+/_=-]*+(?:(?:[A-Za-z]{{1,2}}[0-9]{{0,4}}|{WORD}(?:[0-9]++(?:(?=[A-Za-z]{{5}}){WORD}[0-9]*+)?+)?+|[0-9]++)(?:[+/_=-]++|$))++$"


def base_spans(text: Column) -> dict[str, Column]:
    def value(x: Column) -> Column:
        return F.char_length(F.regexp_replace(x["v"], ASSIGN_HEAD, ""))

    return {"assign": F.filter(spans(text, ASSIGN), lambda x: value(x) >= 8),
            "access": spans(text, ACCESS), "hex": spans(text, HEX)}


def _pairs(samples: DataFrame) -> DataFrame:
    """label, times, a, b: the transitions of samples (label, string, and times), as places in ALPHABET."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("string") - 1))
    times = F.col("times") if "times" in samples.columns else F.lit(1)
    rows = samples.where(F.char_length("string") >= 2).select("label", "string", times.alias("times"), at.alias("i"))
    place = [F.instr(F.lit(ALPHABET), F.substring("string", F.col("i") + k, F.lit(1))) - 1 for k in (0, 1)]
    return rows.select("label", "times", place[0].alias("a"), place[1].alias("b")).where("a >= 0 and b >= 0")


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random against ordinary) of each transition, row by
    row over ALPHABET, from samples (label 'random' / 'ordinary', string)."""
    n = len(ALPHABET)
    counts = {k: [[1.0] * n for _ in range(n)] for k in ("random", "ordinary")}
    for r in _pairs(samples).groupBy("label", "a", "b").agg(F.sum("times").alias("n")).collect():  # at most 2 * n * n rows
        counts[r.label][r.a][r.b] += r.n
    return [math.log(x / sum(p)) - math.log(y / sum(q))
            for p, q in zip(counts["random"], counts["ordinary"]) for x, y in zip(p, q)]


def ratio(string: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per transition; characters outside ALPHABET are skipped."""
    n = len(ALPHABET)
    table = F.array(*[F.lit(x) for x in model])
    chars = F.filter(F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda i: i > 0)
    steps = F.zip_with(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))),
                       F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(0))), lambda a, b: (a - 1) * n + b)
    total = F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.element_at(table, i))
    return total / F.greatest(F.size(steps), F.lit(1))


def labelled_samples(found: DataFrame, docs: DataFrame, least: int) -> DataFrame:
    """label, string, times: values of base spans, and identifier-shaped runs of all documents."""
    values = F.flatten(F.array(F.transform("assign", lambda x: F.regexp_replace(x["v"], ASSIGN_HEAD, "")),
                               F.transform("access", lambda x: x["v"]), F.transform("hex", lambda x: x["v"])))
    random = found.where("size(assign) + size(access) + size(hex) > 0").select(F.lit("random").alias("label"), F.explode(values).alias("string"))
    # base spans leave the text before its runs are taken
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(whole("text"), f"{ASSIGN}(?<={VALUE}{{8}})", " "), ACCESS, " "), HEX, " ")
    run = f"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{{{least},}}+"
    ordinary = (docs.select(F.explode(F.regexp_extract_all(text, F.lit(run), F.lit(0))).alias("string"))
                .where(F.col("string").rlike(ORDINARY)).select(F.lit("ordinary").alias("label"), "string"))
    return random.unionByName(ordinary).groupBy("label", "string").agg(F.count(F.lit(1)).alias("times"))


def quantile_of(ratios: DataFrame, quantile: float) -> float:
    """The ratio that ``quantile`` of the rows (at, times) stay under, rounded up to thousandths."""
    # as many rows as thousandths that ratios differ by
    steps = ratios.groupBy(F.ceil(F.col("at") * 1000).alias("k")).agg(F.sum("times").alias("n")).orderBy("k").collect()
    left = quantile * sum(r.n for r in steps)
    for r in steps:
        left -= r.n
        if left <= 0:
            return r.k / 1000
    return steps[-1].k / 1000 if steps else 0.0


def scan(docs: DataFrame, least: int = 6, quantile: float = 0.9999) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, and the found spans of
    each kind as arrays (assign, access, hex, random)."""
    text = whole("text")
    runs = spans(text, RUN)
    base = base_spans(text)
    # the text is scanned once; what is left is short
    found = materialize(docs.select("doc_id", *[c.alias(k) for k, c in base.items()], runs.alias("runs")), "secret-spans")
    samples = materialize(labelled_samples(found, docs, least), "secret-samples")
    model = train(samples)
    ratios = samples.where("label = 'ordinary'").select(ratio(F.col("string"), model).alias("at"), "times", "string")
    threshold = max(0.0, quantile_of(ratios, quantile), quantile_of(ratios.where(F.char_length("string") >= LONG), quantile))
    known = F.concat("assign", "access", "hex")
    both = F.arrays_zip(F.col("runs").alias("r"), overlapping(F.col("runs"), known).alias("hit"))
    random = F.transform(F.filter(both, lambda x: ~x["hit"] & (ratio(x["r"]["v"], model) > threshold)), lambda x: x["r"])
    out = found.withColumn("random", F.when(F.size("runs") > 0, random).otherwise(F.col("runs")))
    named = [names(k, F.col(k), i) for i, k in enumerate(("assign", "access", "hex", "random"))]
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.array_sort(F.concat(*named[:3]))), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat(*named))).alias("spans"), "assign", "access", "hex", "random")
