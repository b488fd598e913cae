"""Conversation structure repair by weighted CYK interval parsing.

A conversation is a sequence of turns that should read system (optional), then
user and assistant in turn. Its cheapest repair is a parse under a grammar in
Chomsky normal form whose nonterminals are pairs of places in that reading:
X[p, q] derives the turns that lead from place p to place q. A turn alone gives
X[p, q] by an edit (keep, change the role, delete), an empty span by insertions
(their closure stands in front of every turn and at the end), and
X[p, q] -> X[p, r] X[r, q] joins two neighbouring spans. A cell holds, for each
nonterminal, the minimum of (cost, audit), the audit being the edits' letters.
Cells of spans are filled bottom-up by span length. Audits of equal cost are
never prefixes of each other (a longer one has more insertions), so the least
audit of a span is made of the least audits of its parts.

Turns are sorted and dealt by range of (conversation, turn, role, text hash),
so a conversation with a third of all turns lies in many tasks. A conversation
of few turns inside one task is repaired there. The others leave the cells of
stretches of `SPAN` turns, which are again joined by the same parse, `SPAN`
neighbours at a time, until one cell spans the conversation; only cells are
shuffled for that. At last the stretches pass by in order, each taking its part
of the audit. Equal turns (conversation, turn, role and text) are counted
before they are shuffled: all but the first are deleted, whatever their number.

Defined cases: NULL conversations are one conversation, NULL turns come first
and count for no gap, NULL roles and texts are one space. Turns of one number
are ordered by role, then by the SHA-256 of the text. A conversation without
turns has zero counts and cost, an empty audit and no rows. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, table, written
from tillflow.operators.ordering import default_partitions

#: Turns of one stretch, and cells joined by one parse.
SPAN = 16
#: Spans of symbols whose cells a task remembers.
CACHE_SPANS = 200_000
# White space, marks that end a sentence, costs and role names.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"s": "system", "u": "user", "a": "assistant"}
# Fixed value: places in the reading: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
GOOD_END = (0, 3)
LEGAL = ("su", "ua", "au")
GONE = "X"  # symbol of a turn that must be deleted

Cell = dict  # (p, q) -> (cost, audit)


def join(left: Cell, right: Cell) -> Cell:
    """X[p, q] -> X[p, r] X[r, q]."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for (r2, q), (c2, a2) in right.items():
            if r == r2:
                new = (c1 + c2, a1 + a2)
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def better(a: Cell, b: Cell) -> Cell:
    return {k: min(x for x in (a.get(k), b.get(k)) if x is not None) for k in {**a, **b}}


def insertions() -> Cell:
    """The empty span: the cheapest insertions between any two places."""
    out = {(p, p): (0, "") for p in STEP}
    one = {(p, q): (INSERT, "I") for p, to in STEP.items() for role, q in to.items() if role in "ua"}
    while True:
        new = better(out, join(out, one))
        if new == out:
            return out
        out = new


def edits(symbol: str) -> Cell:
    """One turn: GONE, or its role's initial and t (truncated) or f (fine)."""
    out = {(p, p): (DELETE, "D") for p in STEP}
    if symbol != GONE:
        role, extra = symbol[:-1], TRUNCATED * (symbol[-1] == "t")
        for p, to in STEP.items():
            for c, q in to.items():
                new = (extra, "K") if c == role else (REROLE + extra, "R") if c in "ua" else None
                if new and ((p, q) not in out or new < out[p, q]):
                    out[p, q] = new
    return out


class Parser:
    """Cells of spans, by span length; spans of equal symbols are parsed once a task."""

    def __init__(self):
        self.empty = insertions()
        self.known: dict[tuple, Cell] = {}

    def turn(self, symbol: str, times: int) -> Cell:
        """`times` equal turns, each with the insertion closure in front."""
        power, out = join(self.empty, edits(symbol)), None
        while times:
            if times & 1:
                out = power if out is None else join(out, power)
            power, times = join(power, power), times >> 1
        return out

    @staticmethod
    def parse(cells: list[Cell], known=None, name=None) -> Cell:
        """Bottom-up over all spans of neighbouring cells."""
        n = len(cells)
        span = {(i, i + 1): c for i, c in enumerate(cells)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                j = i + length
                key = name[i:j] if known is not None else None
                cell = known.get(key) if key is not None else None
                if cell is None:
                    cell = {}
                    for k in range(i + 1, j):
                        cell = better(cell, join(span[i, k], span[k, j]))
                    if key is not None:
                        known[key] = cell
                span[i, j] = cell
        return span[0, n]

    def symbols(self, turns: list[tuple[str, int]]) -> Cell:
        name = tuple(turns)
        if not name:
            return {(p, p): (0, "") for p in STEP}
        if name not in self.known:
            if len(self.known) > CACHE_SPANS:
                self.known.clear()
            for one in name:
                if (one,) not in self.known:
                    self.known[one,] = self.turn(*one)
            if len(name) > 1:
                self.parse([self.known[one,] for one in name], self.known, name)
        return self.known[name]

    def best(self, cell: Cell) -> tuple[int, str]:
        done = join(cell, self.empty)
        return min(done[0, q] for q in GOOD_END if (0, q) in done)


@dataclass
class Stretch:
    """What neighbouring turns tell about themselves; `+` of neighbours is that of both."""
    cell: Cell
    turns: int = 0
    first: str = ""    # initials of the first and last role
    last: str = ""
    illegal: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    low: int | None = None
    high: int | None = None
    numbers: int = 0

    def plus(self, other: "Stretch", cell: Cell) -> "Stretch":
        meet = bool(self.turns and other.turns) and self.last + other.first not in LEGAL
        return Stretch(
            cell, self.turns + other.turns, self.first if self.turns else other.first,
            other.last if other.turns else self.last, self.illegal + other.illegal + meet,
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.low if self.low is not None else other.low, other.high if other.high is not None else self.high,
            self.numbers + other.numbers - (self.high is not None and self.high == other.low))

    def verdict(self, parser: Parser) -> dict:
        cost, audit = parser.best(self.cell)
        return {"gaps": 0 if self.low is None else self.high - self.low + 1 - self.numbers, "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost,
                "audit": audit}

    def dump(self) -> str:
        return json.dumps([[[*k, *v] for k, v in self.cell.items()], *list(self.__dict__.values())[1:]])

    @staticmethod
    def load(text: str) -> "Stretch":
        cell, *rest = json.loads(text)
        return Stretch({(p, q): (c, a) for p, q, c, a in cell}, *rest)


def joined(parser: Parser, parts: list[Stretch]) -> Stretch:
    """Neighbouring stretches as one, their cells joined by the parse."""
    out = parts[0]
    for p in parts[1:]:
        out = out.plus(p, {})
    out.cell = parser.parse([p.cell for p in parts])
    return out


def measure(parser: Parser, turns: list[dict]) -> Stretch:
    """Sorted turns (turn, role, text, times, first, blank, cut) as one stretch."""
    out, symbols = Stretch({}), []
    for t in turns:
        n, role = t["times"], t["role"][:1]
        gone = t["blank"] or not t["first"]
        if gone:
            symbols.append((GONE, n))
        else:
            symbols.append((role + ("t" if t["cut"] else "f"), 1))
            if n > 1:
                symbols.append((GONE, n - 1))
        blank = n * t["blank"]
        number = t["turn"]
        out = out.plus(Stretch(
            {}, n, role, role, n - 1 if role + role not in LEGAL else 0, blank, 0 if blank else n - t["first"],
            int(not gone and t["cut"]), number, number, int(number is not None)), {})
    out.cell = parser.symbols(symbols)
    return out


class Repair:
    """Applies an audit to turns that pass by in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.made = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def _next_role(self) -> str:
        return ROLES["u" if (self.made - self.odd) % 2 == 0 else "a"]

    def _insert(self, out: list) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            out.append({"role": self._next_role(), "text": ""})
            self.at, self.made = self.at + 1, self.made + 1

    def turns(self, rows: list[dict]) -> list[dict]:
        out: list[dict] = []
        for r in rows:
            for _ in range(r["times"]):
                self._insert(out)
                letter = self.audit[self.at]
                if letter != "D":
                    out.append({"role": r["role"] if letter == "K" else self._next_role(), "text": r["text"]})
                    self.made += 1
                self.at += 1
        return out

    def end(self) -> list[dict]:
        out: list[dict] = []
        self._insert(out)
        return out


VERDICT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
ROWS = "rows array<struct<role:string,text:string>>"


def sorted_turns(rows: DataFrame) -> DataFrame:
    """(c, turn, role, hash, text, times, first, blank, cut) of rows(c, turn, role, text, copies), sorted in tasks.

    first: no earlier turn of the conversation has this role and text.
    """
    hashed = rows.withColumn("hash", F.unhex(F.sha2(F.col("text"), 256)))
    here = hashed.where("copies > 0")
    nothing = F.lit(None)
    none = hashed.where("copies = 0").select(
        "c", nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
        nothing.cast("binary").alias("hash"), nothing.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
        F.lit(False).alias("mark"))
    seen = here.groupBy("c", "role", "hash").agg(
        F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("least"))
    marks = seen.select("c", F.when(~F.col("unnumbered"), F.col("least")).alias("turn"), "role", "hash",
                        nothing.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), F.lit(True).alias("mark"))
    turns = here.select("c", "turn", "role", "hash", "text", F.col("copies").cast("long").alias("copies"),
                        F.lit(False).alias("mark")).union(marks).union(none)
    counted = turns.groupBy("c", "turn", "role", "hash").agg(
        F.max("text").alias("text"), F.sum("copies").alias("times"), F.bool_or("mark").alias("first"))
    bare = F.rtrim("text", F.lit(SPACE))
    marked = counted.select("*", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("cut"))
    order = [F.col("c").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("hash")]
    return marked.repartitionByRange(default_partitions(rows), *order).sortWithinPartitions(*order)


def _batches(rows: list[dict], schema: pa.Schema, most: int = 500) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), most):
        yield pa.RecordBatch.from_pylist(rows[i:i + most], schema=schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def stretches_of(turns: DataFrame, kind: str) -> DataFrame:
    """Sorted turns as repaired conversations (`whole`) and, where a task does not hold all of a
    conversation or it is long, as stretches with their cells. Written once."""
    schema = (f"c {kind}, task int, nth long, whole boolean, {VERDICT}, cell string, "
              "rows array<struct<role:string,text:string,times:long>>")
    target = _arrow_schema(schema)

    def run(batches):
        parser, task = Parser(), TaskContext.get().partitionId()
        now, turns, nth, first_of_task, out = None, [], 0, True, []

        def close(complete: bool) -> None:
            nonlocal turns, nth
            if now is not None and (turns or not nth):
                got = measure(parser, turns)
                row = {"c": now[0], "task": task, "nth": nth, "whole": complete and not nth}
                if row["whole"]:
                    row |= got.verdict(parser)
                    fix = Repair(row["audit"])
                    row["rows"] = fix.turns(turns) + fix.end()
                else:
                    row |= {"cell": got.dump(), "rows": [{k: t[k] for k in ("role", "text", "times")} for t in turns]}
                out.append(row)
                turns, nth = [], nth + 1

        for b in batches:
            for t in b.to_pylist():
                if now is None or t["c"] != now[0]:
                    close(not first_of_task)
                    first_of_task = now is None
                    now, turns, nth = (t["c"],), [], 0
                if t["times"]:
                    if len(turns) == SPAN:
                        close(False)
                    turns.append(t)
            yield from _batches(out, target)
            out.clear()
        close(False)
        yield from _batches(out, target)

    return written(turns.mapInArrow(run, schema), "repair-stretches")


def _join_up(cells: DataFrame, key: Column, kind: str, order: str) -> DataFrame:
    """Neighbouring stretches (c, part, nth, cell) of equal key as one stretch."""
    schema = f"c {kind}, task int, nth long, cell string"
    target = _arrow_schema(schema)

    def up(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("task", "ascending"), ("nth", "ascending")])
        got = joined(Parser(), [Stretch.load(x) for x in rows.column("cell").to_pylist()])
        step = rows.column("step")[0].as_py()
        place = {"task": rows.column("task")[0].as_py(), "nth": 0, order: step}
        return pa.Table.from_pylist([{"c": rows.column("c")[0].as_py(), **place, "cell": got.dump()}],
                                    schema=target)

    keys = ["c", "step"] if order == "task" else ["c", "task", "step"]
    return cells.withColumn("step", key).groupBy(*keys).applyInArrow(up, schema)


def whole_cells(stretches: DataFrame, kind: str) -> DataFrame:
    """(c, cell) of the whole of each conversation that lies in stretches."""
    cells = stretches.select("c", "task", "nth", "cell")
    nth, tasks = cells.agg(F.max("nth"), F.max("task")).first()
    nth, tasks = nth or 0, tasks or 0
    while nth > 0:  # within a task, then across tasks
        cells, nth = _join_up(cells, F.floor(F.col("nth") / SPAN).cast("long"), kind, "nth"), nth // SPAN
    while tasks > 0:
        cells, tasks = _join_up(cells, F.floor(F.col("task") / SPAN).cast("int"), kind, "task"), tasks // SPAN
    return cells.select("c", "cell")


def repair_conversations(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", copies: str | None = None) -> DataFrame:
    """(conversation, stretch, last, gaps, blank, duplicate, truncated, illegal, cost, audit, rows).

    rows holds the repaired turns. A long conversation comes in several rows, numbered by stretch and
    in that order in one task; its verdict stands in the first of them.
    """
    kind = dict(rows.dtypes)[conversation]
    base = rows.select(F.col(conversation).alias("c"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                       (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"))
    found = stretches_of(sorted_turns(base), kind)
    verdict = [c.split()[0] for c in VERDICT.split(", ")]
    plain = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    short = found.where("whole").select("c", F.lit(0).cast("long").alias("stretch"), F.lit(True).alias("last"),
                                        *verdict, plain.alias("rows"))
    parts = found.where("not whole")
    heads = whole_cells(parts, kind).select("c", F.lit(-1).alias("task"), F.lit(-1).cast("long").alias("nth"), "cell",
                                            F.lit(None).cast(parts.schema["rows"].dataType).alias("rows"))
    passing = parts.select("c", "task", "nth", F.lit(None).cast("string").alias("cell"), "rows").union(heads) \
        .repartition(default_partitions(rows), "c").sortWithinPartitions("c", "task", "nth")
    schema = f"c {kind}, stretch long, last boolean, {VERDICT}, {ROWS}"
    target = _arrow_schema(schema)

    def run(batches):
        parser, held, fix = Parser(), None, None

        def end():
            if held is not None:
                held["rows"] += fix.end()
                held["last"] = True
                yield held

        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["nth"] < 0:
                    out += end()
                    got = Stretch.load(r["cell"]).verdict(parser)
                    fix, held = Repair(got["audit"]), {"c": r["c"], "stretch": 0, **got, "rows": []}
                elif r["rows"]:
                    if held["rows"] or held["stretch"]:
                        out.append({**held, "last": False})
                        held = {"c": r["c"], "stretch": held["stretch"] + 1, "rows": []}
                    held["rows"] = fix.turns(r["rows"])
            yield from _batches(out, target)
        yield from _batches(list(end()), target)

    return short.union(passing.mapInArrow(run, schema)).withColumnRenamed("c", conversation)


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: its verdict and the SHA-256 of its turns (role:text, one a line).

    Conversations of one row are hashed where they are; the others pass by in order.
    """
    key = repaired.columns[0]
    kind = dict(repaired.dtypes)[key]
    verdict = [c.split()[0] for c in VERDICT.split(", ")]
    once = F.col("last") & (F.col("stretch") == 0)
    lines = F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    short = repaired.where(once).select(key, *verdict, F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    schema = f"`{key}` {kind}, {VERDICT}, repaired_sha256 string"
    target = _arrow_schema(schema)

    def run(batches):
        head, sha, started = None, None, False
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["stretch"] == 0:
                    head, sha, started = {c: r[c] for c in (key, *verdict)}, hashlib.sha256(), False
                for x in r["rows"]:
                    sha.update((("\n" if started else "") + x["role"] + ":" + x["text"]).encode())
                    started = True
                if r["last"]:
                    out.append({**head, "repaired_sha256": sha.hexdigest()})
            yield from _batches(out, target)

    return short.union(repaired.where(~once).mapInArrow(run, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows with `copies` 0, 1 or 2, chosen by the CRC of conversation and turn."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("d"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("d") == 4, ROLES["u"]).otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).alias("copies"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest of repair_conversations over all conversations after the contract's damage."""
    rows = damaged(table(prepare(spark), sf_dir, "conversations"))
    return digests(repair_conversations(rows, copies="copies"))
