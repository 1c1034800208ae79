"""Conversation repair by Knuth's lightest-derivation agenda.

A conversation's rows, in order, are repaired so that the role initials read
``(s?(ua)+)?``.  An item ``(i, state)`` stands for the rows from ``i`` on, with
the output before them in ``state`` (nothing, after the system turn, after a
user, after an assistant).  Deduction rules derive an item from the item behind
one edit:

    Keep      (i, s) <- (i + 1, s')   0, one more for a truncated row
    Rerole    (i, s) <- (i + 1, s')   2, one more for a truncated row
    Delete    (i, s) <- (i + 1, s)    3 a copy
    Insert    (i, s) <- (i, s')       2

An item's value is (cost, audit), the audit being the edits' initials.  Every
rule prefixes one initial, so the rules are monotone; they are superior on the
agenda's order (cost, rows consumed, initial), as an edit costs something or
consumes a row.  From one item, equal initials lead to the same item, so equal
costs are decided by the first initial, and no audit is ever compared or copied
in the agenda.  The first item popped for ``(0, start)`` is final.

Long conversations are cut: rows are range-partitioned in order, and a task
derives for its piece of a conversation the value of every pair of states
(``piece``).  A second agenda joins pieces by a rule of two antecedents, the
piece's value and the item behind it; audits of equal cost over the same rows
differ at some letter (a proper extension would hold inserts, which cost), so
the rule is monotone in both.  Only what a task's first and last conversation
send crosses tasks.

Texts take no part in this: a row is a digest, its role's initial and its
fault.  They move once, to be hashed: each conversation's surviving rows and its
plan are streamed in order through one hasher.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import written

SPACE = "[\\x20\\x09-\\x0D]"
ENDS = "[.!?]"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Output so far: nothing, the system turn, ends with a user, with an assistant.
NEW, SYSTEM, USER, ASSISTANT = range(4)
GOOD_ENDS = (NEW, ASSISTANT)
#: The state after an inserted or reroled turn (a user, unless one was last).
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}


def after(state: int, initial: str) -> int | None:
    """The state after a kept row, None if it may not stand there."""
    if initial == "s":
        return SYSTEM if state == NEW else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


# ------------------------------------------------------------------ agenda --
def derive(rows: list[tuple], ends: tuple, starts: tuple = (NEW,)) -> dict:
    """Lightest derivations of ``rows`` down to one of the states ``ends``.

    A row is (initial, truncated, m): an optional row (m = 0) or a run of m rows
    that must go.  Returns ``{start: (cost, audit, end)}`` for every state of
    ``starts`` that can be derived; the audit is a list of (initial, count)."""
    n = len(rows)
    best: dict = {}                     # item -> (cost, initial, count, item behind)
    agenda = [(0, 0, "", n, s, 0, None) for s in ends]
    heapq.heapify(agenda)
    left = {(0, s) for s in starts}
    while agenda and left:
        cost, used, letter, i, s, count, behind = heapq.heappop(agenda)
        if (i, s) in best:
            continue
        best[i, s] = (cost, letter, count, behind)
        left.discard((i, s))
        for t in range(4):              # an insert before this item
            if NEXT[t] == s and (i, t) not in best:
                heapq.heappush(agenda, (cost + 2, used, INSERT, i, t, 1, (i, s)))
        if not i:
            continue
        initial, truncated, m = rows[i - 1]
        if (i - 1, s) not in best:
            heapq.heappush(agenda, (cost + 3 * max(1, m), used + 1, DELETE, i - 1, s, max(1, m), (i, s)))
        if not m:
            for t in range(4):
                if after(t, initial) == s and (i - 1, t) not in best:
                    heapq.heappush(agenda, (cost + truncated, used + 1, KEEP, i - 1, t, 1, (i, s)))
                if NEXT[t] == s and (i - 1, t) not in best:
                    heapq.heappush(agenda, (cost + 2 + truncated, used + 1, REROLE, i - 1, t, 1, (i, s)))
    out = {}
    for s in starts:
        if (0, s) in best:
            at, audit = (0, s), []
            while best[at][3] is not None:
                _, letter, count, behind = best[at]
                audit.append((letter, count))
                at = behind
            out[s] = (best[0, s][0], audit, at[1])
    return out


def spell(audit: list[tuple]) -> str:
    return "".join(letter * count for letter, count in audit)


def plan_of(audit: list[tuple], rows: list[tuple]) -> str:
    """The audit's letters without the runs that must go."""
    out, i = [], 0
    for letter, count in audit:
        if letter == INSERT:
            out.append(letter)
            continue
        if not rows[i][2]:
            out.append(letter)
        i += 1
    return "".join(out)


def piece(rows: list[tuple]) -> list[tuple]:
    """(start, end, cost, audit, plan) for every pair of states."""
    every = []
    for end in range(4):
        for start, (cost, audit, _) in derive(rows, (end,), tuple(range(4))).items():
            every.append((start, end, cost, spell(audit), plan_of(audit, rows)))
    return every


def combine(pieces: list[list[tuple]]) -> tuple[int, str, str]:
    """Cost, audit and plan of consecutive pieces: a hyperedge derives the item
    (p, start) from the piece's value for (start, end) and the item (p + 1, end)."""
    n, best = len(pieces), {}
    agenda = [(0, 0, "", n, s, "") for s in GOOD_ENDS]
    heapq.heapify(agenda)
    while (0, NEW) not in best:
        cost, used, audit, p, s, plan = heapq.heappop(agenda)
        if (p, s) in best:
            continue
        best[p, s] = (cost, audit, plan)
        if p:
            for start, end, more, front, own in pieces[p - 1]:
                if end == s and (p - 1, start) not in best:
                    heapq.heappush(agenda, (cost + more, used + 1, front + audit, p - 1, start, own + plan))
    return best[0, NEW]


# ------------------------------------------------------------------ damage --
def damage(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``conv, turn, role, text, copies``: the damaged rows, nulls of the key,
    role and text read as one space.  A dropped row stays with no copies, so
    that its conversation stays known; a repeated one has two."""
    blank = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    fate = F.crc32(F.concat(part(id_col), F.lit(":"), part(turn_col)).cast("binary")) % 20
    some = turns.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), part(role_col).alias("role"),
                        part(text_col).alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return some.select("conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("copies"))


def intact(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """The same columns without damage."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), part(role_col).alias("role"),
                        part(text_col).alias("text"), F.lit(1).alias("copies"))


def _digest() -> Column:
    return F.unhex(F.md5(F.concat("role", F.lit("\0"), "text").cast("binary")))


def _is_blank() -> Column:
    return ~F.col("text").rlike(f"[^{SPACE[1:]}")


def _signs(rows: DataFrame) -> DataFrame:
    """``conv, turn, initial, key, blank, truncated, n, first``: equal rows of a
    turn once with their number (before the shuffle); ``first`` marks the turn in
    which its role and text are first seen."""
    last = F.regexp_extract("text", f"([^{SPACE[1:]}){SPACE}*\\z", 1)
    signs = rows.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), _digest().alias("key"), _is_blank().alias("blank"),
                        (~last.rlike(ENDS)).alias("truncated"), F.col("copies").cast("long").alias("n"), F.col("role").alias("who"))
    signs = written(signs.groupBy("conv", "turn", "who", "initial", "key", "blank", "truncated").agg(F.sum("n").alias("n")), "signs")
    seen = signs.filter("n > 0").groupBy(F.col("conv").alias("c"), F.col("key").alias("k")).agg(
        F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("low"))
    first = F.when(F.col("none"), F.col("turn").isNull()).otherwise(F.col("turn").eqNullSafe(F.col("low")))
    return signs.join(seen, signs.conv.eqNullSafe(F.col("c")) & (signs.key == F.col("k")), "left").select(
        "conv", "turn", "who", "initial", "key", "blank", "truncated", "n", F.coalesce(first, F.lit(False)).alias("first"))


# ------------------------------------------------------------------ pieces --
PIECE = ("whole boolean, at long, n long, gap_low {turn}, gap_high {turn}, turns long, blank long, duplicate long, truncated long, illegal long, "
         "head string, tail string, parts array<struct<start:int,end:int,cost:long,audit:string,plan:string>>")


class _Piece:
    """What one task knows of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.turns, self.low, self.high = conv, [], 0, None, None
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.head = self.tail = None

    def add(self, turn, initial, blank, truncated, n, first):
        if not n:
            return
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.n and self.tail + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1            # copies stand side by side, and no initial may follow itself
        self.head, self.tail = initial if self.head is None else self.head, initial
        self.n += n
        once = 1 if first and not blank else 0
        if once:
            self.truncated += truncated
            self.rows.append((initial, int(truncated), 0))
        if blank:
            self.blank += n
        else:
            self.duplicate += n - once
        if n > once:
            self.rows.append((initial, 0, n - once))

    def told(self, at: int, whole: bool) -> dict:
        if whole:
            cost, audit, _ = derive(self.rows, GOOD_ENDS)[NEW]
            parts = [(NEW, NEW, cost, spell(audit), plan_of(audit, self.rows))]
        else:
            parts = piece(self.rows)
        return {"conv": self.conv, "whole": whole, "at": at, "n": self.n, "gap_low": self.low, "gap_high": self.high, "turns": self.turns,
                "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "head": self.head, "tail": self.tail, "parts": [dict(zip(("start", "end", "cost", "audit", "plan"), p)) for p in parts]}


def _pieces(signs: DataFrame) -> DataFrame:
    """A row for each conversation that lies inside a task, and a row for each
    piece of a task's first and last one."""
    conv, turn = (signs.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    order = ["conv", "turn", "who", "key"]
    placed = signs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.spark_partition_id().cast("long"))
    schema = f"conv {conv}, " + PIECE.format(turn=turn)
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        made, now, inner, at = [], None, False, 0
        for b in batches:
            for r in zip(*(b.column(k).to_pylist() for k in range(b.num_columns))):
                if now is None or r[0] != now.conv:
                    if now is not None:
                        made.append(now.told(at, inner))
                        inner = True                 # all but the first and the last are whole
                    now, at = _Piece(r[0]), r[7]
                now.add(*r[1:7])
            if len(made) > 2000:
                yield pa.RecordBatch.from_pylist(made, kinds)
                made = []
        if now is not None:
            made.append(now.told(at, False))
        if made:
            yield pa.RecordBatch.from_pylist(made, kinds)

    return written(placed.select("conv", "turn", "initial", "blank", "truncated", "n", "first", "at").mapInArrow(run, schema), "pieces")


FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, plan string"


def _joined(pieces: DataFrame) -> DataFrame:
    """One row per conversation: ``conv`` and ``FIELDS``."""
    span = F.coalesce(F.col("gap_high") - F.col("gap_low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    one = F.get("parts", F.lit(0))
    whole = pieces.filter("whole").select("conv", span.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                                          one["cost"].alias("cost"), one["audit"].alias("audit"), one["plan"].alias("plan"))
    schema = f"conv {pieces.schema['conv'].dataType.simpleString()}, {FIELDS}"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def join(key, table):
        some = sorted((r for r in table.to_pylist() if r["n"]), key=lambda r: r["at"])
        cost, audit, plan = combine([[tuple(p.values()) for p in r["parts"]] for r in some])
        dated = [r for r in some if r["gap_low"] is not None]
        turns = sum(r["turns"] for r in dated) - sum(a["gap_high"] == b["gap_low"] for a, b in zip(dated, dated[1:]))
        out = {"conv": key[0].as_py(), "gaps": dated[-1]["gap_high"] - dated[0]["gap_low"] + 1 - turns if dated else 0,
               **{c: sum(r[c] for r in some) for c in ("blank", "duplicate", "truncated")},
               "illegal": sum(r["illegal"] for r in some) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(some, some[1:])),
               "cost": cost, "audit": audit, "plan": plan}
        return pa.Table.from_pylist([out], kinds)

    cut = pieces.filter("not whole").groupBy("conv").applyInArrow(join, schema)
    return whole.union(cut)


# ------------------------------------------------------------------ result --
def repaired_lines(plan: str, rows):
    """(role, text) of the repaired conversation: ``rows`` are the rows that may
    stay, in order, as (role, text)."""
    state, rows = NEW, iter(rows)
    for letter in plan:
        if letter == INSERT:
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        role, text = next(rows)
        if letter == DELETE:
            continue
        state = after(state, role[:1]) if letter == KEEP else NEXT[state]
        yield (role if letter == KEEP else ROLE[state]), text


def repair(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text", damaged: bool = True) -> DataFrame:
    """One row per conversation of ``turns``: ``conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256``; ``damaged=False`` repairs
    the rows as they are.

    Rows go by turn, nulls first, then by role and by the digest of role and
    text.  A null role or text is one space (a role without a legal initial, a
    blank text); a null id is a conversation of its own.  Repeated rows are
    duplicates.  A conversation without rows has zeros, an empty audit and the
    hash of the empty string; an empty table gives no rows.  Only the four
    columns are read, so others may have any name."""
    rows = (damage if damaged else intact)(turns, id_col, turn_col, role_col, text_col)
    found = _joined(_pieces(_signs(rows)))
    # the texts that may stay: not blank, once per role and text, at their first turn
    kept = (rows.filter(F.col("copies") > 0).filter(~_is_blank()).groupBy("conv", "role", "text")
            .agg(F.max(F.col("turn").isNull().cast("int")).alias("none"), F.min("turn").alias("low"))
            .select("conv", F.lit(1).alias("kind"), F.when(F.col("none") == 0, F.col("low")).alias("turn"), "role",
                    _digest().alias("key"), "text"))
    facts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "plan"]
    both = kept.unionByName(found.withColumn("kind", F.lit(0)), allowMissingColumns=True).select("conv", "kind", "turn", "role", "key", "text", *facts)
    placed = both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "key").drop("kind", "turn", "key")
    conv = turns.schema[id_col].dataType.simpleString()
    schema = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):

        def stream():
            for b in batches:
                yield from zip(*(b.column(k).to_pylist() for k in range(b.num_columns)))

        made, held, rest = [], None, stream()

        def texts():
            """The rows up to the next conversation's facts, which are held back."""
            nonlocal held
            for r in rest:
                if r[3] is not None:
                    held = r
                    return
                yield r[1], r[2]

        held = next(rest, None)
        while held is not None:
            now, held = held, None
            own, digest, empty = texts(), hashlib.sha256(), True
            for role, text in repaired_lines(now[10], own):
                digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
            for _ in own:
                pass
            made.append(dict(zip(kinds.names, [now[0], *now[3:10], digest.hexdigest()])))
            if len(made) >= 2000:
                yield pa.RecordBatch.from_pylist(made, kinds)
                made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, kinds)

    return placed.mapInArrow(run, schema)
