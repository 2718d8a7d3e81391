"""Personal data: strict formats, and candidates chosen by gradient-boosted trees.

Strict formats (base spans) are e-mail addresses, IPv4 addresses, card numbers
and phone numbers as in ``base_spans``.  The method's own spans, of kind
``likely``, come from generators of high recall (``GENERATORS``) which propose
overlapping spans: anything with an at sign or a spelled-out one, and runs of
seven or more digits with separators.  Boosted trees, one set for each generator, score a
candidate by its format (lengths, groups of digits, separators, labels of a domain) and
by the words and characters around it.

What a strict format tests (a leading plus, the at sign itself, the check digit, octets) is no
feature, or the trees would learn nothing else.  Positives are confirmed candidates, each also in
other dress: without its first group of digits, in parentheses, with other separators; an address with the at sign
spelled out, without its digits, without the first of several labels of its domain.
Negatives are runs of digits that no format confirms in a neutral context, without any word of ``KEYWORDS``, and
confirmed addresses cut behind the first label of their domain.  Unconfirmed candidates in a telling context
are unlabelled.  All labelled candidates of a generator take part: a fifth of them, by a hash, is held out, the others
train its trees.  Candidates with the same features are one row with their number as weight, so the trees read
distinct feature values only, and a leaf's least share of the weight is that of five candidates.  A score's calibrated precision is that of the held-out rows at or above it, both classes weighing the same;
the generator's threshold is the lowest score whose precision reaches ``precision``.  A candidate is added if it scores
at least that and overlaps no base span; of overlapping ones the earlier, longer stays.

Everything runs in DataFrame functions and Spark's own trees.  Cases.  Null text
counts as empty.  Places are in code points.  Without both classes among a generator's candidates
it adds nothing.  Very long texts are scanned whole; places of many matches are summed up block by block.  Rows with equal id and text are one document.  Empty tables
give an empty result; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, whole
from .spans import SPAN, joined, names, overlapping, spans

# fixed values: the contract's formats
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = f"(?:\\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
# --------------------------------------------------------------------------
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
GENERATORS = {
    "at": f"(?:\\G|(?<!{LOCAL})){LOCAL}++\\x20?(?:@|[(\\[]at[)\\]])\\x20?[A-Za-z0-9.-]++",
    "digits": "(?<![0-9])\\+?+\\(?+[0-9](?:[\\x20().-]{0,2}[0-9]){6,}+",
}
CONTEXT = 24
KEYWORDS = {"phone": "phone|tel|call|mobile|fax|cell", "card": "card|visa|credit|account|iban", "mail": "mail|contact|write", "net": "\\bip\\b|host|server|address"}


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    n = F.char_length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(number, n - i, F.lit(1))) - 48
        d = F.when(i % 2 == 1, d * 2).otherwise(d)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def is_card(v: Column) -> Column:
    number = digits(v)
    return F.when(F.char_length(number).between(13, 19), luhn(number)).otherwise(F.lit(False))


def is_ip(v: Column) -> Column:
    return v.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")


def base_spans(text: Column) -> dict[str, Column]:
    return {"email": spans(text, EMAIL),
            "ip": F.filter(spans(text, IP), lambda x: is_ip(x["v"])),
            "card": F.filter(spans(text, CARD), lambda x: is_card(x["v"])),
            "phone": F.filter(spans(text, PHONE), lambda x: F.char_length(digits(x["v"])).between(9, 15))}


def candidates(text: Column, pattern: str) -> Column:
    """Proposed spans (s, e, v) with the text before and after each."""
    return spans(text, pattern, CONTEXT)


def feature_columns(c: Column) -> list[Column]:
    v, before, after = c["v"], c["before"], c["after"]
    bare = F.regexp_replace(v, "^\\+", "")                     # a leading plus tells nothing
    number = digits(v)
    groups = F.filter(F.split(bare, "[^0-9]+"), lambda x: x != "")
    domain = F.regexp_extract(v, "(?:@|[(\\[]at[)\\]])\\x20?(.*)$", 1)
    flags = [F.contains(v, F.lit("(")), bare.rlike("[0-9][ ][0-9]"), bare.rlike("[0-9]-[0-9]"), bare.rlike("[0-9]\\.[0-9]"),
             domain.rlike("\\.[A-Za-z]{2,}$"), before.rlike("[A-Za-z0-9]$"), after.rlike("^[A-Za-z0-9]"), before.rlike("[:=]\\s*$"),
             after.rlike("^[,.;\\s]|^$"), *[before.rlike(f"(?i){w}") for w in KEYWORDS.values()]]
    sizes = F.transform(groups, lambda x: F.char_length(x))
    return [F.char_length(number).cast("double"), F.size(groups).cast("double"), F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
            F.coalesce(F.get(sizes, F.size(sizes) - 1), F.lit(0)).cast("double"), F.size(F.split(domain, "\\.")).cast("double"),
            F.char_length(domain).cast("double"), *[f.cast("double") for f in flags]]


def neutral(c: Column) -> Column:
    """No word before the candidate tells of personal data."""
    return ~F.greatest(*[c["before"].rlike(f"(?i){w}") for w in KEYWORDS.values()])


def examples(each: DataFrame) -> DataFrame:
    """Labelled candidates (kind, label, c) from all (kind, c, known, th)."""
    def dressed(c: Column, v: Column) -> Column:
        return c.withField("v", v)

    c, v = F.col("c"), F.col("c.v")
    # a phone's, card's or address's digits in other dress; the same address spelled out
    shorter = F.regexp_replace(v, "^\\+?[0-9]{1,3}[ .-]?(?=.*[0-9].*[0-9].*[0-9].*[0-9].*[0-9].*[0-9].*[0-9])", "")
    others = F.when(F.col("kind") == "at", F.array(v, F.regexp_replace(v, "@", " (at) "), F.regexp_replace(v, "@", " [at] "), F.regexp_replace(v, "[0-9]", ""),
                                                  F.regexp_replace(v, "@[A-Za-z0-9-]+\\.(?=.*\\.)", "@"))).otherwise(
        F.array(v, shorter, F.translate(F.regexp_replace(shorter, "[()]", ""), ".-", "  "), F.regexp_replace(shorter, "[() .]+", "-"),
                F.regexp_replace(shorter, "^\\(?([0-9]{3})\\)?", "($1) ")))
    right = each.where("known").select("kind", "th", "s", "e", F.explode(F.transform(others, lambda x: dressed(c, x))).alias("c"), F.lit(1.0).alias("label"))
    cut = each.where("known and kind = 'at'").select("kind", "th", "s", "e", dressed(c, F.regexp_replace(v, "(@[A-Za-z0-9-]+)\\..*$", "$1")).alias("c"), F.lit(0.0).alias("label"))
    wrong = each.where(~F.col("known") & (F.col("kind") == "digits") & neutral(c)).select("kind", "th", "s", "e", "c", F.lit(0.0).alias("label"))
    return right.unionByName(cut).unionByName(wrong)


def _boost(rows: DataFrame, rounds: int, precision: float):
    """Trees and threshold from rows (held, label, features, n), n alike ones in each, or None without both classes."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    counts = {(r.held, r.label): r.n for r in rows.groupBy("held", "label").agg(F.sum("n").alias("n")).collect()}  # four rows at most
    if any(not counts.get((h, y)) for h in (False, True) for y in (0.0, 1.0)):
        return None
    leaf = min(0.49, 5 / (counts[False, 0.0] + counts[False, 1.0]))
    model = GBTClassifier(maxIter=rounds, maxDepth=4, seed=7, weightCol="n", minWeightFractionPerNode=leaf).fit(rows.where("not held"))
    scored = model.transform(rows.where("held")).select("label", "n", vector_to_array("probability")[1].alias("p"))
    steps = scored.groupBy(F.floor(F.col("p") * 1000).cast("int").alias("k")).agg(
        F.sum(F.col("label") * F.col("n")).alias("right"), F.sum((1 - F.col("label")) * F.col("n")).alias("wrong")).orderBy(F.desc("k")).collect()  # 1001 rows at most
    right = wrong = 0.0
    found = None
    for r in steps:
        right += r.right / counts[True, 1.0]
        wrong += r.wrong / counts[True, 0.0]
        if right / (right + wrong) >= precision:
            found = r.k / 1000
    return None if found is None else (model, found)


def select_spans(scored: DataFrame) -> DataFrame:
    """k_id, k_th, likely: of the scored candidates (doc_id, th, s, e, v) by start, longest first, those that
    begin behind the last one taken."""
    none = F.array().cast(SPAN)
    good = scored.groupBy(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th")).agg(
        F.array_sort(F.collect_set(F.struct("s", F.negative("e").alias("z"), "e", "v"))).alias("good"))
    # spans of one chain of overlaps only are held in the growing list: a span behind all before it begins a new one
    chosen = F.aggregate("good", F.struct(F.lit(0).alias("to"), none.alias("out")), lambda a, x: F.when(
        x["s"] >= a["to"], F.struct(x["e"].alias("to"), F.concat(a["out"], F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v")))).alias("out")))
        .otherwise(a), lambda a: a["out"])
    return good.select("k_id", "k_th", chosen.alias("likely"))


def scan(docs: DataFrame, rounds: int = 10, precision: float = 0.99) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and the spans of
    each kind as arrays (email, ip, card, phone, likely)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    text = whole("text")
    found = materialize(docs.select("doc_id", F.xxhash64(text).alias("th"), *[c.alias(k) for k, c in base_spans(text).items()],
                                    *[candidates(text, p).alias(f"c_{k}") for k, p in GENERATORS.items()]), "pii-spans")
    known = F.concat(*KINDS)

    def tested(kind: str) -> Column:
        both = F.arrays_zip(F.col(f"c_{kind}").alias("c"), overlapping(F.col(f"c_{kind}"), known).alias("known"))
        return F.transform(both, lambda x: F.struct(F.lit(kind).alias("kind"), x["known"].alias("known"), x["c"].alias("c")))

    proposed = [tested(k) for k in GENERATORS]
    each = (found.where(" or ".join(f"size(c_{k}) > 0" for k in GENERATORS)).select("doc_id", "th", F.explode(F.concat(*proposed)).alias("x"))
            .select("doc_id", "th", "x.kind", "x.known", "x.c", F.col("x.c.s").alias("s"), F.col("x.c.e").alias("e")))
    each = materialize(each, "pii-candidates")
    labelled = examples(each)
    held = F.pmod(F.xxhash64(F.lit(1), "th", "s", "e"), F.lit(5)) == 0
    alike = materialize(labelled.groupBy("kind", held.alias("held"), "label", F.array(*feature_columns(F.col("c"))).alias("features"))
                        .agg(F.count(F.lit(1)).cast("double").alias("n")), "pii-examples")
    good = []
    for kind in GENERATORS:
        trained = _boost(alike.where(F.col("kind") == kind).withColumn("features", array_to_vector("features")), rounds, precision)
        if trained:
            model, threshold = trained
            rest = each.where(~F.col("known") & (F.col("kind") == kind)).select(
                "doc_id", "th", "s", "e", F.col("c.v").alias("v"), array_to_vector(F.array(*feature_columns(F.col("c")))).alias("features"))
            good.append(model.transform(rest).where(F.floor(vector_to_array("probability")[1] * 1000) >= int(round(threshold * 1000))).select("doc_id", "th", "s", "e", "v"))
    none = F.array().cast(SPAN)
    if good:
        likely = select_spans(reduce(DataFrame.unionByName, good))
        out = (found.join(likely, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left")
               .withColumn("likely", F.coalesce("likely", none)))
    else:
        out = found.withColumn("likely", none)
    named = [names(k, F.col(k), i) for i, k in enumerate((*KINDS, "likely"))]
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(joined(F.concat(*named[:4])), 256).alias("base_sha256"),
                      joined(F.concat(*named)).alias("spans"), *KINDS, "likely")
