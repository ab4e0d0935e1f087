"""Conversation structure repair by depth-first branch and bound.

Rows of a conversation, in order of their turn, are kept, given another role, deleted, or have empty turns inserted between
them, so that the initials of the roles read ``(s?(ua)+)?``, at the least cost; of equally cheap repairs the one with the
ASCII-least audit (the edits' initials in order). Blank rows and repeats of an earlier row must be deleted; a kept truncated row costs extra.

The search walks an explicit stack of (rows done, place in the grammar, cost, audit so far), cheapest edit first. A node is cut off

* if its cost and the lower bound of the rows left (their cheapest repair when it may end anywhere, kept for each suffix) exceed the
  best complete repair found, or equal it with a greater audit, and
* if the table of its (rows done, place in the grammar) holds a prefix that is cheaper, or as cheap with a smaller audit. Two
  equally cheap prefixes over the same rows are never one the beginning of the other (what is longer has more insertions), so the
  smaller one stays smaller however both go on.

When the stack is empty the best repair is proved.

Conversations of up to ``LONG_ROWS`` rows are brought together by one shuffle and solved one at a time while tasks stream over the sorted
rows. Longer ones (one may hold a third of all rows) are counted beforehand and go another way: identical rows collapse to one
with a count, earlier rows of the same role and text are found by an aggregate and a join, the rows are dealt by ranges of their order
and cut into pieces of ``PIECE_ROWS``, and each piece is solved by the same search for every pair of places in the grammar it may begin and end
in. One task per conversation then only chains the pieces' answers (four cheapest repairs so far) and streams the repaired rows
through SHA-256, which can't be split.

Edge cases: a null role or text is one space; a null ``conv_id`` is one conversation; ties in ``turn`` are ordered by role, then text, a
null turn comes first; repeated rows are duplicates; an empty role has no initial, so it can't stay; a conversation without rows has
zeros, an empty audit and the hash of an empty string; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_few, cut, read_table

LONG_ROWS = 2_000
PIECE_ROWS = 500

RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs; keeping is free
# Places in the grammar: nothing yet, behind s, behind u, behind a. Role initial -> next place.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
GOOD_ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
PAIRS = {"su", "ua", "au"}

OK, BLANK, DUPLICATE, CUT_SHORT = range(4)  # a row's first fault


def fault(text: str, seen: bool) -> int:
    said = text.rstrip(" \t\n\x0b\f\r")
    return BLANK if not said else DUPLICATE if seen else OK if said[-1] in ".!?" else CUT_SHORT


def bounds(rows: list[tuple[str, int]]) -> list[tuple[int, ...]]:
    """For each row and place in the grammar, the least that this row and those behind it can cost if the conversation may
    end anywhere."""
    least = [(0,) * 4]
    for initial, wrong in reversed(rows):
        extra, behind, own = TRUNCATED * (wrong == CUT_SHORT), least[-1], []
        for place in range(4):
            costs = [DELETE + behind[place]]
            if wrong not in (BLANK, DUPLICATE):
                costs += [RETAG + extra + behind[NEXT[place][r]] for r in ROLES if r in NEXT[place]]
                costs += [extra + behind[to] for r, to in NEXT[place].items() if r == initial]
            own.append(min(costs))
        # an insertion before the row moves on to the place behind u or behind a
        least.append(tuple(min(own[p], *(INSERT + own[to] for r, to in NEXT[p].items() if r in ROLES)) for p in range(4)))
    return least[::-1]


def search(rows: list[tuple[str, int]], begin: int = START, ends: Iterable[int] = GOOD_ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the best repair of ``rows`` (role initial, fault) from ``begin`` to one of ``ends``; None if there is none."""
    least, ends = bounds(rows), set(ends)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, begin, 0, "")]
    while stack:
        at, place, cost, audit = stack.pop()
        if best is not None and (cost + least[at][place], audit) > (best[0], best[1][:len(audit)]):
            continue
        known = table.get((at, place))
        if known is not None and known <= (cost, audit):
            continue
        table[at, place] = cost, audit
        if at == len(rows) and place in ends and (best is None or (cost, audit) < best):
            best = cost, audit
        forth = NEXT[place]
        made = "u" if "u" in forth else "a"  # the only role that an edit can give here
        steps = [(INSERT, "I", at, forth[made])]
        if at < len(rows):
            initial, wrong = rows[at]
            steps.append((DELETE, "D", at + 1, place))
            if wrong not in (BLANK, DUPLICATE):
                extra = TRUNCATED * (wrong == CUT_SHORT)
                steps.append((RETAG + extra, "R", at + 1, forth[made]))
                if initial in forth:
                    steps.append((extra, "K", at + 1, forth[initial]))
        for price, letter, to, state in sorted(steps, key=lambda s: (s[0] + least[s[2]][s[3]], s[1]), reverse=True):
            stack.append((to, state, cost + price, audit + letter))
    return best


def repaired(rows: Iterable[tuple[str, str]], audit: str, begin: int = START) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that ``audit`` makes of ``rows``."""
    place, left = begin, iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter != "K":
            role = ROLES["u" if "u" in NEXT[place] else "a"]
        place = NEXT[place][role[:1]]
        yield role, text


class _Facts:
    """Counts of a stretch of rows, and what is needed to join it with the next stretch."""

    def __init__(self) -> None:
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]
        self.first = None

    def add(self, turn: int | None, initial: str, wrong: int, copies: int = 1) -> None:
        """``copies`` equal rows; all but the first repeat it."""
        if turn is not None:
            self.turns += turn != self.high  # rows come in order
            self.low, self.high = turn if self.low is None else self.low, turn
        self.illegal += self.last is not None and self.last + initial not in PAIRS
        self.illegal += copies - 1  # no role may follow itself
        self.first = initial if self.first is None else self.first
        self.last = initial
        self.faults[wrong] += 1
        self.faults[BLANK if wrong == BLANK else DUPLICATE] += copies - 1

    def extend(self, low: int | None, high: int | None, turns: int, illegal: int, faults: list[int], first: str, last: str) -> None:
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        self.illegal += illegal + (self.last is not None and self.last + first not in PAIRS)
        self.faults = [a + b for a, b in zip(self.faults, faults)]
        self.last = last

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults[1:], self.illegal)


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
RESULT = f"conv_id long, {_COUNTS}, cost long, audit string, repaired_sha256 string"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"audit": pa.string(), "repaired_sha256": pa.string(), "role": pa.string(), "text": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names=names)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _digest(turns: Iterable[tuple[str, str]]) -> str:
    sha = hashlib.sha256()
    for n, (role, text) in enumerate(turns):
        sha.update(f"{chr(10) if n else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
    return sha.hexdigest()


def _conversations(batches: Iterator[pa.RecordBatch], key: int = 1) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(first ``key`` columns, rows) of consecutive rows; a conversation's rows are read as they are asked for."""
    rows = itertools.chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)
    return itertools.groupby(rows, lambda r: r[:key])


def _rows(conversations: DataFrame) -> DataFrame:
    present = F.col("present") if "present" in conversations.columns else F.lit(True)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), present.alias("present"))


def repair(conversations: DataFrame, long_rows: int = LONG_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per ``conv_id`` its faults, and cost, audit and digest of its best repair.

    A boolean column ``present`` marks rows that only name their conversation (false).
    """
    rows = _rows(conversations)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > long_rows)
    long = cut(sizes.select(F.col("conv_id").alias("long_id")))
    few = broadcast_if_few(long)
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = rows.join(few, is_long, "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (conv,), group in _conversations(batches):
            facts, seen, todo, said = _Facts(), set(), [], []
            for _, turn, role, text, present in group:
                if present:
                    wrong = fault(text, (role, text) in seen)
                    seen.add((role, text))
                    facts.add(turn, role[:1], wrong)
                    todo.append((role[:1], wrong))
                    said.append((role, text))
            cost, audit = search(todo)
            out.append((conv, *facts.row(), cost, audit, _digest(repaired(said, audit))))
            if len(out) == 1000:
                yield _batch(out, _names(RESULT))
                out = []
        if out:
            yield _batch(out, _names(RESULT))

    done = (short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, RESULT))
    if long.isEmpty():
        return done
    return done.unionByName(_repair_long(rows.join(few, is_long, "left_semi"), piece_rows))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[f"{k}_"])
    return out


PIECE = ["conv_id", "part", "piece"]


def _repair_long(rows: DataFrame, piece_rows: int) -> DataFrame:
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    kinds = rows.groupBy("conv_id", "turn", "role", "text", "present", "digest").agg(F.count("*").alias("copies"))
    # the first turn (null first) of each role and text
    first = (kinds.where("present").groupBy("conv_id", "role", "digest")
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn"))).alias("first")))
    first = first.select(F.col("conv_id").alias("conv_id_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"),
                         F.col("first.turn").alias("turn_"))
    rows = (kinds.join(first, _same(kinds, first, ["conv_id", "role", "digest"]), "left")
            .withColumn("seen", ~F.col("turn").eqNullSafe(F.col("turn_")))
            .select("conv_id", "turn", "role", "text", "present", "copies", "seen"))
    at = F.monotonically_increasing_id()
    rows = (rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
            .withColumn("part", F.shiftright(at, 33)).withColumn("row", at.bitwiseAND((1 << 33) - 1)))
    rows = cut(rows.withColumn("piece", F.floor(F.col("row") / piece_rows)))
    names = ["conv_id", "part", "piece", "low", "high", "turns", "illegal", "faults", "first", "last", "answers"]
    answer = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
    schema = pa.schema(list(zip(names, [pa.int64()] * 7 + [pa.list_(pa.int64()), pa.string(), pa.string(), pa.list_(answer)])))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _conversations(batches, 3):
            facts, todo = _Facts(), []
            for _, _, _, turn, role, text, present, copies, seen in group:
                if present:
                    wrong = fault(text, seen)
                    facts.add(turn, role[:1], wrong, copies)
                    todo += [(role[:1], wrong)] + [(role[:1], BLANK if wrong == BLANK else DUPLICATE)] * (copies - 1)
            found = [{"begin": b, "end": e, "cost": x[0], "audit": x[1]}
                     for b in range(4) for e in range(4) if (x := search(todo, b, [e])) is not None]
            values = (*key, facts.low, facts.high, facts.turns, facts.illegal, facts.faults, facts.first, facts.last, found)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    pieces = (rows.select(*PIECE, "turn", "role", "text", "present", "copies", "seen")
              .mapInArrow(solve, "conv_id long, part long, piece long, low long, high long, turns long, illegal long, faults array<long>, "
                                 "first string, last string, answers array<struct<begin:long,end:long,cost:long,audit:string>>"))

    chosen_schema = f"conv_id long, part long, piece long, begin long, {_COUNTS}, cost long, audit string"

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv,), group in _conversations(batches):
            facts, where, steps = _Facts(), [], []
            best: dict[int, tuple[int, str]] = {START: (0, "")}
            for _, part, piece, low, high, turns, illegal, faults, first_, last_, answers in group:
                if first_ is not None:
                    facts.extend(low, high, turns, illegal, faults, first_, last_)
                reached: dict[int, tuple[int, str, int, str]] = {}
                for x in answers:
                    if x["begin"] in best:
                        cost, audit = best[x["begin"]]
                        way = (cost + x["cost"], audit + x["audit"], x["begin"], x["audit"])
                        if x["end"] not in reached or way[:2] < reached[x["end"]][:2]:
                            reached[x["end"]] = way
                best = {e: w[:2] for e, w in reached.items()}
                where.append((part, piece))
                steps.append({e: w[2:] for e, w in reached.items()})
            place = min((e for e in GOOD_ENDS if e in best), key=lambda e: best[e])
            cost, out = best[place][0], []
            for (part, piece), step in zip(reversed(where), reversed(steps)):
                place, audit = step[place]
                out.append((conv, part, piece, place, *facts.row(), cost, audit))
            yield _batch(out, _names(chosen_schema))

    chosen = cut(pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(chain, chosen_schema))
    side = broadcast_if_few(chosen.select(*[F.col(c).alias(f"{c}_") for c in PIECE], *chosen.columns[3:]))
    told = (rows.join(side, _same(rows, side, PIECE))
            .select("conv_id", "part", "row", "piece", "begin", *chosen.columns[4:], "role", "text", "present", "copies"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv,), group in _conversations(batches):
            head: list = []
            audits: list[str] = []

            def turns() -> Iterator[tuple[str, str]]:
                for _, lines in itertools.groupby(group, lambda r: (r[1], r[3])):
                    line = next(lines)
                    head[:] = line[5:11]
                    audits.append(line[11])
                    again = itertools.chain([line], lines)
                    yield from repaired(((r[12], r[13]) for r in again if r[14] for _ in range(r[15])), line[11], line[4])

            sha = _digest(turns())
            yield _batch([(conv, *head, "".join(audits), sha)], _names(RESULT))

    return (told.repartition("conv_id").sortWithinPartitions("conv_id", "part", "row").mapInArrow(finish, RESULT))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by the checksum of conversation and turn (20 kinds: dropped, emptied, without stops, repeated, as user; the
    rest stay). A dropped row stays as ``present`` false, so that its conversation is known."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    df = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return df.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "time")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(read_table(spark, sf_dir, "conversations")))
