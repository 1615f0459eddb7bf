"""Repairs conversations to the role grammar at the least cost, by generalised LR parsing with edits.

The grammar is `Chat -> (nothing) | Turns | s Turns`, `Turns -> u a | Turns u a` over the initials of roles; its LR automaton is
built below. A parse holds a frontier of stacks: a top state has links to the stacks below it, which are shared nodes, and
equal stacks are merged by the least (cost, audit). On each row a stack may keep it (shift its initial), rerole it (shift the
user or assistant instead) or delete it (stay), and before a row or at the end insert an empty turn. Equal costs go to the
audit that is least in ASCII; audits of one cost that read the same rows are never prefixes of each other, so merging
early is exact.

A conversation may be any size. Rows are sorted into ranges over all conversations and written once, with their place; each
run of 4096 places is a segment that is parsed on its own, from every stack that can lie before it, so a huge conversation is
parsed by many tasks. Segments' tables are then folded in order, which takes as much as the audit does. The repaired texts
are hashed as a stream of sorted rows in bounded memory; this last pass over one conversation is one task's, as a hash
has no parts that can be joined.

Defined cases. A null role or text is one space. A null turn comes first and is left out of gaps. Rows of one turn come in the
order of role, then text. Rows alike in id, turn, role and text are counted once before they move; all but the first are
duplicates. A null id is a conversation of its own. A role with another initial than s, u or a, or without any, fits nowhere
and is reroled or deleted. Conversations without rows: no faults, no edits, the hash of nothing.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.work import stored

#: What an edit costs, and a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Initials that may follow each other.
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"
SEGMENT_BITS = 12

GRAMMAR = (("Chat", ""), ("Chat", "T"), ("Chat", "sT"), ("T", "ua"), ("T", "Tua"))

State = frozenset
Stack = tuple  # (state, stack below or None)
Best = tuple[int, str]  # cost, audit


def _closure(items: set[tuple[str, str, int]]) -> State:
    while new := {(left, right, 0) for _, rhs, dot in items for left, right in GRAMMAR if rhs[dot : dot + 1] == left} - items:
        items = items | new
    return frozenset(items)


def _automaton() -> tuple[dict[tuple[int, str], int], dict[int, tuple[str, int]], set[int]]:
    """By number of state: where a symbol leads, the rule that is reduced, and whether a chat may end there."""
    states = [_closure({(left, right, 0) for left, right in GRAMMAR if left == "Chat"})]
    leads: dict[tuple[int, str], int] = {}
    for n, state in enumerate(states):  # grows on the way
        for symbol in sorted({rhs[dot] for _, rhs, dot in state if dot < len(rhs)}):
            target = _closure({(left, rhs, dot + 1) for left, rhs, dot in state if rhs[dot : dot + 1] == symbol})
            if target not in states:
                states.append(target)
            leads[n, symbol] = states.index(target)
    done = [{(left, len(rhs)) for left, rhs, dot in s if dot == len(rhs)} for s in states]
    reduces = {n: next(iter(rules)) for n, rules in enumerate(done) if any(left == "T" for left, _ in rules)}
    assert all(len(done[n]) == len(states[n]) == 1 for n in reduces), "no state both reduces turns and goes on"
    return leads, reduces, {n for n, rules in enumerate(done) if any(left == "Chat" for left, _ in rules)}


LEADS, REDUCES, ENDS = _automaton()
EMPTY: Stack = (0, None)


def _push(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and the reductions it completes, or None where the grammar has no place for it."""
    to = LEADS.get((stack[0], symbol))
    if to is None:
        return None
    if to not in REDUCES:
        return (to, stack)
    left, length = REDUCES[to]
    for _ in range(length - 1):  # the last symbol was never put on
        stack = stack[1]
    return _push(stack, left)


def _reachable() -> list[Stack]:
    """All stacks that can occur: the grammar recurs on the left, so they are few."""
    found = [EMPTY]
    for stack in found:  # grows on the way
        found += [s for x in "sua" if (s := _push(stack, x)) is not None and s not in found]
    return found


STACKS = _reachable()
NUMBER = {stack: n for n, stack in enumerate(STACKS)}
SHIFTS = [{x: NUMBER[s] for x in "sua" if (s := _push(stack, x)) is not None} for stack in STACKS]
ACCEPTED = [n for n, stack in enumerate(STACKS) if stack[0] in ENDS]

Frontier = dict[int, Best]  # by number of the stack


def _merge(frontier: Frontier, stack: int, best: Best) -> bool:
    if stack in frontier and frontier[stack] <= best:
        return False
    frontier[stack] = best
    return True


def _inserted(frontier: Frontier) -> Frontier:
    """The frontier with all that inserts reach from it."""
    todo, out = list(frontier), dict(frontier)
    while todo:
        stack = todo.pop()
        cost, audit = out[stack]
        for symbol in ROLES:
            to = SHIFTS[stack].get(symbol)
            if to is not None and _merge(out, to, (cost + INSERT, audit + "I")):
                todo.append(to)
    return out


def _step(frontier: Frontier, symbol: str) -> Frontier:
    """After one row: `D` must go; otherwise the initial, a capital if the row is truncated, `x` for any other role."""
    out: Frontier = {}
    initial, more = symbol.lower(), TRUNCATED * symbol.isupper()
    for stack, (cost, audit) in _inserted(frontier).items():
        _merge(out, stack, (cost + DELETE, audit + "D"))
        if symbol == "D":
            continue
        for shifted, to in SHIFTS[stack].items():
            if shifted == initial:
                _merge(out, to, (cost + more, audit + "K"))
            elif shifted in ROLES:
                _merge(out, to, (cost + more + REROLE, audit + "R"))
    return out


def _parsed(symbols: str) -> tuple[tuple[int, int, int, str], ...]:
    """From each stack before a segment to each stack after it: the least cost and its audit."""
    table = []
    for entry in range(len(STACKS)):
        frontier: Frontier = {entry: (0, "")}
        for symbol in symbols:
            frontier = _step(frontier, symbol)
        table += [(entry, to, cost, audit) for to, (cost, audit) in frontier.items()]
    return tuple(table)


_parsed_before = lru_cache(20_000)(_parsed)  # of short segments, which are alike by the thousand
SHORT = 12


def transfer(symbols: str) -> tuple[tuple[int, int, int, str], ...]:
    return _parsed_before(symbols) if len(symbols) <= SHORT else _parsed(symbols)


def fold(tables: list[list[tuple[int, int, int, str]]]) -> Best:
    """The least (cost, audit) of a conversation whose segments have these tables, in order.

    What all audits begin with is set aside on the way, so that long ones are not copied again and again.
    """
    frontier: Frontier = {NUMBER[EMPTY]: (0, "")}
    common: list[str] = []
    for table in tables:
        out: Frontier = {}
        for entry, to, cost, audit in table:
            if entry in frontier:
                before = frontier[entry]
                if to not in out or before[0] + cost <= out[to][0]:
                    _merge(out, to, (before[0] + cost, before[1] + audit))
        shared = os.path.commonprefix([audit for _, audit in out.values()])
        common.append(shared)
        frontier = {to: (cost, audit[len(shared) :]) for to, (cost, audit) in out.items()}
    closed = _inserted(frontier)
    cost, audit = min(closed[n] for n in ACCEPTED if n in closed)
    return cost, "".join(common) + audit


def damaged(chats: DataFrame) -> DataFrame:
    """The rows damaged by crc32 of `id:turn`: one in twenty each is dropped, emptied, without end signs, repeated, set to user."""
    key = F.concat(F.coalesce(F.col("id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    rows = chats.withColumns({"kind": kind, "role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    return rows.where("kind <> 0").select(
        "id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _symbol(duplicate: Column) -> dict[str, Column]:
    """Faults of a row and its symbols for the parse; copies after the first must all go."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    blank = trimmed == ""
    truncated = ~blank & ~duplicate & ~F.substring(trimmed, -1, 1).isin(".", "!", "?")
    first = F.when(blank | duplicate, "D").when(truncated, F.upper(initial)).otherwise(initial)
    copies = F.col("n").cast("int")
    return {
        "blank": F.when(blank, F.col("n")).otherwise(0),
        "duplicate": F.when(blank, 0).otherwise(F.col("n") - F.when(duplicate, 0).otherwise(1)),
        "truncated": truncated.cast("long"),
        "symbols": F.concat(first, F.repeat(F.lit("D"), copies - 1)),
        "initials": F.repeat(initial, copies),
    }


def _placed(rows: DataFrame) -> DataFrame:
    """Each different row once, with its faults, symbols and place `at` in the order of all rows; written and read again."""
    rows = rows.groupBy("id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    said = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    rows = rows.withColumn("said", said)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = rows.groupBy("id", "said").agg(F.count("*").alias("turns"), F.min(turn).alias("first")).where("turns > 1")
    firsts = firsts.select(F.col("id").alias("of"), F.col("said").alias("what"), "first")
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("what"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    found = rows.join(firsts, same, "left").withColumns(_symbol(later)).drop("said", "of", "what", "first")
    order = [F.asc_nulls_first("id"), F.asc_nulls_first("turn")]
    ranged = found.repartitionByRange(*order, F.substring("role", 1, 64), F.substring("text", 1, 64))
    return stored(ranged.sortWithinPartitions(*order, "role", "text").withColumn("at", F.monotonically_increasing_id()))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        symbols, initials, turns = (batch.column(name).to_pylist() for name in ("symbols", "initials", "turns"))
        illegal = [sum(x[i : i + 2] not in LEGAL for i in range(len(x) - 1)) for x in initials]
        made = {
            "illegal": pa.array(illegal, pa.int64()),
            "ends": pa.array([x[0] + x[-1] for x in initials]),
            "turns": pa.array([len(set(x)) for x in turns], pa.int64()),
            "table": pa.array([[dict(zip(_TABLE, entry, strict=True)) for entry in transfer(x)] for x in symbols], _TABLE_TYPE),
        }
        own = {name: batch.column(name) for name in _PASSED}
        yield pa.RecordBatch.from_pydict(own | made)


_PASSED = ("id", "segment", "low", "high", "blank", "duplicate", "truncated")
_TABLE = ("entry", "to", "cost", "audit")
_TABLE_TYPE = pa.list_(pa.struct([("entry", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENT = (
    "segment long, low {turn}, high {turn}, blank long, duplicate long, truncated long, illegal long, ends string, turns long,"
    " table array<struct<entry int, to int, cost long, audit string>>"
)
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation (id, its segments in order) the counts and the audit."""
    for batch in batches:
        found = []
        for segments in batch.column("segments").to_pylist():
            out = {name: sum(s[name] for s in segments) for name in ("blank", "duplicate", "truncated", "illegal")}
            out["illegal"] += sum(a["ends"][-1] + b["ends"][0] not in LEGAL for a, b in zip(segments[:-1], segments[1:], strict=True))
            known = [s for s in segments if s["low"] is not None]
            shared = sum(a["high"] == b["low"] for a, b in zip(known[:-1], known[1:], strict=True))
            out["gaps"] = known[-1]["high"] - known[0]["low"] + 1 - sum(s["turns"] for s in known) + shared if known else 0
            out["cost"], out["audit"] = fold([[tuple(e[k] for k in _TABLE) for e in s["table"]] for s in segments])
            found.append(out)
        columns = {name: pa.array([x[name] for x in found], pa.int64()) for name in COUNTS}
        yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | columns | {"audit": pa.array([x["audit"] for x in found], pa.string())})


class _Repaired:
    """Follows a conversation's audit row by row; `digest` hashes `role:text` of the rows that stay, joined by newlines."""

    def __init__(self, header: dict):
        self.header, self.audit, self.at = header, header["audit"], 0
        self.last, self.digest, self.lines = "", hashlib.sha256(), 0

    def _say(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.last, self.lines = role[:1], self.lines + 1

    def _expected(self) -> str:
        return ROLES["a" if self.last == "u" else "u"]

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._say(self._expected(), "")
            self.at += 1

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self._inserts()
            edit, self.at = self.audit[self.at], self.at + 1
            if edit != "D":
                self._say(role if edit == "K" else self._expected(), text)

    def end(self) -> dict:
        self._inserts()
        return self.header | {"repaired_sha256": self.digest.hexdigest()}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, each led by its header; a conversation's result comes when the next one begins."""
    chat = None
    names = ["id", *COUNTS, "audit", "repaired_sha256"]
    kind = None
    for batch in batches:
        kind, done = batch.schema.field("id").type, []
        for low in range(0, batch.num_rows, 1000):
            for row in batch.slice(low, 1000).to_pylist():
                if row["at"] is not None:
                    chat.row(row["role"], row["text"], row["n"])
                    continue
                if chat is not None:
                    done.append(chat.end())
                chat = _Repaired({name: row[name] for name in names[:-1]})
        if done:
            yield _ended(done, names, kind)
    if chat is not None:
        yield _ended([chat.end()], names, kind)


def _ended(done: list[dict], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([x[n] for x in done], k) for n, k in zip(names, kinds, strict=True)], names)


def repair(rows: DataFrame, ids: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """For each of `ids`: the faults of its rows, the least cost of edits, the audit of edits and the hash of what is left.

    rows: id, turn (whole number), role, text without nulls, and how often the row comes, `n`. ids: id, each once.
    """
    kind, turn = rows.schema["id"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    placed = _placed(rows)
    cell = F.struct("at", "symbols", "initials", "turn")
    cells = F.array_sort(F.collect_list(cell))
    grouped = placed.groupBy("id", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        cells.alias("cells"),
    )
    texts = {name: F.array_join(F.col("cells")[name], "") for name in ("symbols", "initials")}
    turns = F.filter(F.col("cells")["turn"], lambda t: t.isNotNull())
    segments = grouped.withColumns(texts | {"turns": turns}).drop("cells")
    parsed = segments.mapInArrow(_segments, f"id {kind}, {_SEGMENT.format(turn=turn)}")
    whole = [c for c in parsed.columns if c != "id"]
    of_chat = parsed.select("id", F.struct(*whole).alias("s")).unionByName(ids.select("id"), allowMissingColumns=True)
    of_chat = of_chat.groupBy("id").agg(F.array_sort(F.collect_list("s")).alias("segments"))
    header = f"id {kind}, {', '.join(f'{name} long' for name in COUNTS)}, audit string"
    headers = of_chat.mapInArrow(_folded, header)
    lines = headers.unionByName(placed.select("id", "at", "role", "text", "n"), allowMissingColumns=True)
    lines = lines.repartition("id").sortWithinPartitions(F.asc_nulls_first("id"), F.asc_nulls_first("at"))
    return lines.mapInArrow(_digests, f"{header}, repaired_sha256 string").withColumnRenamed("id", id_column)


def repair_damaged(chats: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """The conversations (id, turn, role, text) damaged, and repaired."""
    rows = chats.select(F.col(id_column).alias("id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return repair(damaged(rows), rows.select("id").distinct(), id_column)
