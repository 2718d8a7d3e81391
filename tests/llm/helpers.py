"""Inputs shared by the operators' tests."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "x string, th string, row string, size string, score string, lines string, pos string, item_id string, comp string")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def nasty(spark):
    """Nulls, empty and very long texts, ties, repeated rows, other columns with names the operators use."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four five six"), (6, "one two three four five six"),
            (6, "one two three four five six"), (None, "no id here at all, only text"), (None, "no id here at all, only text"),
            (None, None), (7, LONG), (8, LONG), (9, "ÄÖÜ ß éè   \U0001F600 naïve words"), (10, "a\nb\nc\nd\na\nb\nc"), (-5, "a\nb\nc")]
    return spark.createDataFrame(
        [(i, t, None, [None, "s1", "s2"][k % 3], None, *["e"] * 9) for k, (i, t) in enumerate(rows)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def near_copies(seed=3, groups=6, words=60):
    """(doc_id, text): groups of copies with a few words changed, and single texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for g in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(rnd.randint(1, 12)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(words)] = rnd.choice(vocabulary)
            rows.append((i, " ".join(copy)))
            i += 1
        rows.append((i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 40)))))
        i += 1
    return rows
