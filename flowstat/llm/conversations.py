"""Conversation structure repair: turns aligned to the alternating grammar by Wagner-Fischer.

``damage`` breaks a table of conversations by a hash of conversation and turn;
``repair`` finds for each conversation the cheapest edits (Keep, Rerole, Delete,
Insert) after which the role initials read ``(s?(ua)+)?``.

Alignment.  The target is a string of the grammar.  For every feasible length the
turns are aligned to the target of that length (edit distance in the manner of
Wagner and Fischer); cells further from the diagonal than the cost of the best
alignment so far allows are never filled (Ukkonen's bands), and lengths that
must cost more are not tried.  Each best alignment is traced back to its audit,
the initials of the edits, and the ASCII-least audit of the cheapest ones wins.

Long conversations.  Turns are dealt over tasks by ranges of (conversation, turn,
role, text), so a conversation of any length is split between tasks.  A task aligns blocks of
``BLOCK`` turns, between every pair of grammar states in which a block may begin
and end, and joins the blocks' alignments: costs are added, audits joined, the
least (cost, audit) of each pair of states stays.  That is exact, since an audit
of a block is never the beginning of another one of equal cost.  The parts of a
conversation that several tasks hold are joined in rounds of ``FAN`` parts.  The
digest of the repaired text alone needs a conversation's turns one after the
other; there they run through a task as a sorted stream that holds one turn at
a time (and the audit, one character for each edit, which is a result's value anyway).

Cases.  Null roles and texts count as one space, as do null ids and turns in the
hash.  Turns of equal number (null ones first) are ordered by role, then text.  A null
``conv_id`` is a conversation of its own.  Empty roles and roles with other
initials can't be kept.  Very long texts are read whole; they stay in the JVM but for the
digest.  Repeated rows count as often as they are there (equal ones are folded before they
are dealt).  Empty tables give an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

BLOCK, FLUSH, FAN = 16, 1024, 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
START, S, U, A = range(4)
AFTER = {"s": S, "u": U, "a": A}
Paths = dict[tuple[int, int], tuple[int, str]]  # (state before, state after) -> (cost, audit)


# ------------------------------------------------------------------ alignment
def targets(p: int, q: int, most: int) -> list[str]:
    """Strings of at most ``most`` letters that lead from state p to state q."""
    if p == START:
        found = targets(A, q, most) if q in (U, A) else []
        found = [x for x in found if x]
        found += ["s" + x for x in targets(S, q, most - 1)] if most else []
        return found + ([""] if q == START else [])
    if q in (START, S):
        return [""] if p == q else []
    first = "a" if p == U else "u"
    cycle = first + ("u" if first == "a" else "a")
    prefixes = [(cycle * n)[:n] for n in range(most + 1)]
    return [x for x in prefixes if (AFTER[x[-1]] if x else p) == q]


def align(turns: list[tuple[str, int]], forced: list[int], target: str, most: int) -> tuple[int, str] | None:
    """Least (cost, audit) of turns (initial, 1 if truncated) against ``target``,
    or None if it costs more than ``most``; ``forced[i]`` deletions come before turn i."""
    n, m = len(turns), len(target)
    base = DELETE * sum(forced)
    left = most - base
    if left < 0:
        return None
    # a cell (i, j) lies j - i from the diagonal: that many insertions or deletions before it, and the rest behind it
    lo, hi = max(-(left // DELETE), m - n - left // INSERT), min(left // INSERT, m - n + left // DELETE)
    if lo > hi:
        return None
    none = 1 << 60
    cost = [[none] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, below = cost[i], cost[i + 1]
        for j in range(min(m, i + hi), max(0, i + lo) - 1, -1):
            if i == n and j == m:
                row[j] = 0
                continue
            best = none
            if i < n:
                best = DELETE + below[j]
                if j < m:
                    role, broken = turns[i]
                    if role == target[j]:
                        best = min(best, KEEP + TRUNCATED * broken + below[j + 1])
                    if target[j] != "s":
                        best = min(best, REROLE + TRUNCATED * broken + below[j + 1])
            if j < m and target[j] != "s":
                best = min(best, INSERT + row[j + 1])
            row[j] = best
    if cost[0][0] > left:
        return None
    audit, i, j = ["D" * forced[0]], 0, 0
    while i < n or j < m:  # the ASCII-least way among the cheapest: D, I, K, R
        now = cost[i][j]
        if i < n and now == DELETE + cost[i + 1][j]:
            audit.append("D" + "D" * forced[i + 1])
            i += 1
        elif j < m and target[j] != "s" and now == INSERT + cost[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            keep = turns[i][0] == target[j] and now == KEEP + TRUNCATED * turns[i][1] + cost[i + 1][j + 1]
            audit.append(("K" if keep else "R") + "D" * forced[i + 1])
            i, j = i + 1, j + 1
    return base + cost[0][0], "".join(audit)


def _least(n: int, forced: list[int], target: str) -> int:
    """No alignment of n turns to the target costs less."""
    over = len(target) - n
    return DELETE * sum(forced) + (INSERT * over if over > 0 else -DELETE * over)


@lru_cache(maxsize=1 << 16)
def block_paths(signature: str, starts: tuple[int, ...]) -> Paths:
    """The best alignment of a block of turns between each pair of states.

    A block is written as its turns' initials, ``x`` for others, in capitals if the
    turn is truncated, and ``-`` for a deletion that is required."""
    parts = signature.replace("-", " - ").split()
    turns, forced = [], [0]
    for part in parts:
        if part == "-":
            forced[-1] += 1
            continue
        for c in part:
            turns.append((c.lower(), int(c.isupper())))
            forced.append(0)
    n, found = len(turns), {}
    for p in starts:
        for q in (START, S, U, A):
            best = None
            # deleting every turn and inserting at most two letters leads everywhere that can be reached
            for target in sorted(targets(p, q, n + (DELETE * n + 2 * INSERT) // INSERT), key=lambda x: _least(n, forced, x)):
                limit = best[0] if best else DELETE * (n + sum(forced)) + 2 * INSERT
                if _least(n, forced, target) > limit:
                    break
                got = align(turns, forced, target, limit)
                if got and (best is None or got < best):
                    best = got
            if best:
                found[p, q] = best
    return found


def join_paths(left: Paths, right: Paths) -> Paths:
    """One after the other: for each pair of states the least (cost, audit)."""
    out: Paths = {}
    for (p, x), (c1, a1) in left.items():
        for (y, q), (c2, a2) in right.items():
            if x == y and ((p, q) not in out or c1 + c2 <= out[p, q][0]):
                both = (c1 + c2, a1 + a2)
                if (p, q) not in out or both < out[p, q]:
                    out[p, q] = both
    return out


# ------------------------------------------------------------------- the turns
def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after damage by crc32(conv_id:turn) % 20:
    0 drops a row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets the role user."""
    kind = F.pmod(F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])), F.lit(20))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return (rows.withColumns({
        "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))})
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text"))


def _faults(turns: DataFrame) -> DataFrame:
    """Folded turns with ``blank``, ``broken`` (the end of the text) and ``seen`` (role and text were there in an earlier turn)."""
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    digest = F.sha2(F.concat(F.col("role"), F.lit(":"), F.col("text")), 256)
    rows = turns.withColumns({"blank": end == "", "broken": ~F.right(end, F.lit(1)).isin(".", "!", "?"), "digest": digest,
                              "size": F.char_length("role")})
    # only what several turns say needs to be looked up
    first = (rows.groupBy(F.col("conv_id").alias("k_conv"), F.col("digest").alias("k_digest"), F.col("size").alias("k_size"))
             .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    same = F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("digest") == F.col("k_digest")) & (F.col("size") == F.col("k_size"))
    return (rows.join(first, same, "left")
            .withColumn("seen", F.coalesce(place != F.col("first"), F.lit(False)))
            .select("conv_id", "turn", "role", "text", "times", "blank", "broken", "seen"))


class _Run:
    """What a task knows of the conversation that it reads: alignment so far, counts, ends."""

    def __init__(self, conv, seq: int, starts: tuple[int, ...]):
        self.conv, self.seq, self.starts = conv, seq, starts
        self.paths: Paths | None = None
        self.signature, self.open_turns, self.turns = [], 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, initial: str, times: int, blank: bool, broken: bool, seen: bool) -> None:
        self.illegal += (self.last is not None and not legal(self.last, initial)) + times - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        free = not (blank or seen)
        self.blank += times if blank else 0
        self.duplicate += 0 if blank else times - free
        self.truncated += free and broken
        if free:
            letter = initial if initial in AFTER else "x"
            self.signature.append(letter.upper() if broken else letter)
            self.open_turns += 1
        self.turns += 1
        rest = times - free
        if rest > BLOCK:  # many deletions in a row: no need to write them one by one
            self._close()
            starts = tuple(sorted({q for _, q in self.paths})) if self.paths else self.starts
            # as one deletion, and edits behind it
            every = {k: (c + DELETE * (rest - 1), "D" * (rest - 1) + a) for k, (c, a) in block_paths("-", starts).items()}
            self.paths = join_paths(self.paths, every) if self.paths else every
        else:
            self.signature.append("-" * rest)
        if self.open_turns >= BLOCK or len(self.signature) >= 4 * BLOCK:
            self._close()

    def _close(self) -> None:
        text = "".join(self.signature)
        if text:
            starts = tuple(sorted({q for _, q in self.paths})) if self.paths else self.starts
            found = block_paths(text, starts)
            self.paths = join_paths(self.paths, found) if self.paths else found
        self.signature, self.open_turns = [], 0

    def row(self, part: int, closed: bool) -> tuple:
        self._close()
        paths = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in sorted(self.paths.items())]
        return (self.conv, part, self.seq, closed, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, paths)


def legal(a: str, b: str) -> bool:
    return (a, b) in (("s", "u"), ("u", "a"), ("a", "u"))


PATHS = "array<struct<p:int,q:int,cost:bigint,audit:string>>"
COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string"


def _parts_schema(kind: T.DataType) -> T.StructType:
    rest = T._parse_datatype_string(f"part bigint, seq bigint, closed boolean, {COUNTS}, paths {PATHS}")
    return T.StructType([T.StructField("conv_id", kind), *rest.fields])


def _arrow(kind: T.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(_parts_schema(kind))


def _parts(rows: DataFrame) -> DataFrame:
    """One row for each conversation, or for each ``FLUSH`` turns of it that a task holds."""
    kind = rows.schema["conv_id"].dataType
    shape = _arrow(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, done = TaskContext.get().partitionId(), None, []
        fresh = False  # whether the task has seen the end of another conversation, so that this one begins here
        for batch in batches:
            for conv, initial, times, blank, broken, seen in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row(part, fresh and now.seq == 0))
                        fresh = True
                    now = _Run(conv, 0, (START,) if fresh else (START, S, U, A))
                elif now.turns >= FLUSH:
                    done.append(now.row(part, False))
                    now = _Run(conv, now.seq + 1, (START, S, U, A))
                now.add(initial, times, blank, broken, seen)
            if done:
                yield _batch(done, shape)
                done = []
        if now is not None:  # the next task may go on with it
            yield _batch([now.row(part, False)], shape)

    order = ["conv_id", "turn", "role", "text"]
    dealt = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .select("conv_id", F.left("role", F.lit(1)).alias("initial"), "times", "blank", "broken", "seen"))
    return dealt.mapInArrow(run, _parts_schema(kind))


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(shape)], schema=shape)


def _joined(parts: DataFrame) -> DataFrame:
    """The parts of conversations that several rows hold, joined in order, ``FAN`` at a time."""
    kind = parts.schema["conv_id"].dataType
    shape = _arrow(kind)

    def merge(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        out = rows[0]
        paths = {(x["p"], x["q"]): (x["cost"], x["audit"]) for x in out["paths"]}
        for r in rows[1:]:
            paths = join_paths(paths, {(x["p"], x["q"]): (x["cost"], x["audit"]) for x in r["paths"]})
            out |= {k: out[k] + r[k] for k in ("blank", "duplicate", "truncated", "illegal")}
            out |= {"illegal": out["illegal"] + (not legal(out["last"], r["first"])), "last": r["last"]}
        out |= {"paths": [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in sorted(paths.items())]}
        return pa.Table.from_pylist([out], schema=shape)

    now = parts
    while True:
        most = now.agg(F.max("seq").alias("seq"), F.max("part").alias("part")).first()
        if not most.seq and not most.part:
            return now
        # first the rows of one task, then those of neighbouring tasks
        fan = lambda c: F.floor(F.col(c) / FAN)
        keys = {"part": F.col("part"), "seq": fan("seq")} if most.seq else {"part": fan("part"), "seq": F.col("seq")}
        grouped = now.groupBy("conv_id", *[c.alias(f"g_{k}") for k, c in keys.items()])
        now = materialize(grouped.applyInArrow(merge, _parts_schema(kind)).withColumns(keys), "conversation-parts")


def _digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: the turns run through a task in order, after their audit."""
    kind = turns.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # conv, audit, place in it, state, hash, whether anything was written
        done: list[tuple] = []

        def write(role: str, text: str) -> None:
            if now["any"]:
                now["hash"].update(b"\n")
            now["any"] = True
            now["hash"].update(role.encode())
            now["hash"].update(b":")
            now["hash"].update(text.encode())
            now["state"] = AFTER[role[0]]

        def other() -> str:
            return "assistant" if now["state"] == U else "user"

        def insert() -> None:
            while now["audit"][now["at"]:now["at"] + 1] == "I":
                now["at"] += 1
                write(other(), "")

        def finish() -> None:
            insert()
            done.append((now["conv"], now["hash"].hexdigest()))

        for batch in batches:
            for conv, audit, role, text, times in zip(*[c.to_pylist() for c in batch.columns]):
                if audit is not None:
                    if now is not None:
                        finish()
                    now = {"conv": conv, "audit": audit, "at": 0, "state": START, "hash": hashlib.sha256(), "any": False}
                    continue
                while times:
                    insert()
                    edit = now["audit"][now["at"]]
                    if edit == "D":  # repeated rows beyond the first are all deleted
                        gone = len(now["audit"][now["at"]:now["at"] + times]) - len(now["audit"][now["at"]:now["at"] + times].lstrip("D"))
                        now["at"], times = now["at"] + gone, times - gone
                        continue
                    now["at"], times = now["at"] + 1, times - 1
                    write(role if edit == "K" else other(), text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((batch.schema.field(0).type, pa.string()))],
                                                 names=["conv_id", "repaired_sha256"])
                done = []
            key = batch.schema.field(0).type
        if now is not None:
            finish()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((key, pa.string()))],
                                             names=["conv_id", "repaired_sha256"])

    none = F.lit(None).cast("string")
    heads = audits.select("conv_id", "audit", none.alias("role"), none.alias("text"), F.lit(0).cast("long").alias("times"), F.lit(0).alias("z"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"))
    rows = turns.select("conv_id", none.alias("audit"), "role", "text", "times", F.lit(1).alias("z"), "turn")
    stream = (heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "z", "turn", "role", "text")
              .select("conv_id", "audit", "role", "text", "times"))
    return stream.mapInArrow(run, T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())]))


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each
    conversation of ``turns`` (conv_id, turn, role, text), and of those of ``ids`` without any turn."""
    folded = materialize(turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times")), "conversation-turns")
    parts = materialize(_parts(_faults(folded)), "conversation-parts")
    split = parts.where("not closed")
    whole = parts.where("closed").unionByName(_joined(split) if not split.isEmpty() else split)
    best = F.array_min(F.transform(F.filter("paths", lambda x: (x["p"] == START) & x["q"].isin(START, A)),
                                   lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"))))
    found = materialize(whole.withColumn("best", best).select(
        "conv_id", "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit")), "conversation-audits")
    spread = folded.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = ids if ids is not None else folded
    out = out.select("conv_id").distinct()
    for more in (found, spread, _digests(folded, found.select("conv_id", "audit"))):
        named = more.withColumnRenamed("conv_id", "k_conv")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("k_conv")), "left").drop("k_conv")
    counts: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations, one row for each original conversation."""
    return repair(damage(conversations), conversations)
