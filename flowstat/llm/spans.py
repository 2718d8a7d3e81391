"""Matches of a pattern with their places, in DataFrame functions only.

A span is a struct (s, e, v): start, end (exclusive) in code points, and the
matched string.  Spark's functions return matches without places; places follow
from the pieces between the matches, whose lengths are added up.

Patterns use possessive groups and a look-behind at the start of a run, so that
long runs of one character class take time in proportion to their length and no
stack; where a match may begin right behind the one before, ``\\G`` allows it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,e:int,v:string>>"
CONTEXT_SPAN = "array<struct<s:int,e:int,v:string,before:string,after:string>>"


BLOCK = 64
MOST = 30  # powers of two in the length of an array


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(numbers: Column, join: Callable[[Column, Column], Column], first: int = 0) -> Column:
    """Running sums (or greatest, by ``join``) of an array of ints.

    A list that grows by one number at a time is copied for each, so that is done inside
    blocks of ``BLOCK`` numbers, and once over what the blocks come to."""
    def grown(array: Column, start: Column) -> Column:
        def step(s: Column, x: Column) -> Column:
            at = join(s["at"], x)
            return F.struct(at.alias("at"), F.concat(s["out"], F.array(at)).alias("out"))

        return F.aggregate(array, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), step, lambda s: s["out"])

    def by_block(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda j: F.slice(a, j * BLOCK + 1, F.lit(BLOCK)))
        return let(blocks, lambda b: F.flatten(F.zip_with(
            b, F.concat(F.array(F.lit(first)), grown(F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: F.aggregate(x, F.lit(first), join)), F.lit(first))),
            grown)))

    return let(numbers, lambda a: F.when(F.size(a) <= BLOCK, grown(a, F.lit(first))).otherwise(by_block(a)))


def spans(text: Column, pattern: str, context: int = 0) -> Column:
    """Leftmost non-overlapping matches of ``pattern``, in order; with ``context``, also so many
    characters before and after each, as far as the matches beside it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def placed(x: Column) -> Column:
        lengths = F.zip_with(F.slice(x["b"], 1, F.size(x["m"])), x["m"], lambda b, m: F.char_length(b) + F.char_length(m))
        with_ends = F.zip_with(running(lengths, lambda a, n: a + n), x["m"], lambda end, m: F.struct(
            (end - F.char_length(m)).alias("s"), end.alias("e"), m.alias("v")))
        if not context:
            return with_ends

        def beside(y: Column, i: Column) -> Column:
            last = F.when(i > 0, F.element_at(x["m"], F.greatest(i, F.lit(1)))).otherwise(F.lit(""))
            following = F.coalesce(F.get(x["m"], i + 1), F.lit(""))
            return F.struct(y["s"].alias("s"), y["e"].alias("e"), y["v"].alias("v"),
                            F.right(F.concat(last, F.element_at(x["b"], i + 1)), F.lit(context)).alias("before"),
                            F.left(F.concat(F.element_at(x["b"], i + 2), following), F.lit(context)).alias("after"))

        return F.transform(with_ends, beside)

    none = F.array().cast(CONTEXT_SPAN if context else SPAN)
    return F.when(text.rlike(pattern), let(F.struct(found.alias("m"), between.alias("b")), placed)).otherwise(none)


def overlapping(candidates: Column, known: Column) -> Column:
    """For each of the candidates whether it overlaps one of the known spans, in any order."""
    ends = let(F.array_sort(F.transform(known, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))),
               lambda k: F.struct(F.transform(k, lambda x: x["s"]).alias("s"), running(F.transform(k, lambda x: x["e"]), lambda a, b: F.greatest(a, b)).alias("e")))

    def test(k: Column, x: Column) -> Column:
        # how many known spans begin before the candidate's end, by halving; do any of them reach beyond its start?
        before = F.aggregate(F.array(*[F.lit(1 << i) for i in range(MOST, -1, -1)]), F.lit(0), lambda n, step: F.when(
            F.when(step <= F.size(k["s"]) - n, F.element_at(k["s"], n + step) < x["e"]).otherwise(F.lit(False)), n + step).otherwise(n))
        return let(before, lambda n: F.when(n > 0, F.element_at(k["e"], n) > x["s"]).otherwise(F.lit(False)))

    none = F.transform(candidates, lambda _: F.lit(False))
    return F.when((F.size(known) == 0) | (F.size(candidates) == 0), none).otherwise(let(ends, lambda k: F.transform(candidates, lambda x: test(k, x))))


def names(kind: str, found: Column, rank: int) -> Column:
    """Spans as sortable structs (s, k, name) with name = kind:start:end."""
    return F.transform(found, lambda x: F.struct(
        x["s"].alias("s"), F.lit(rank).alias("k"), x["e"].alias("e"), F.concat_ws(":", F.lit(kind), x["s"], x["e"]).alias("name")))


def joined(all_names: Column) -> Column:
    return F.array_join(F.transform(all_names, lambda x: x["name"]), ",")
