"""Conversation structure repair against a plain search over edits, and its SQL."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

import oracle_check
from conftest import SF_DIR
from waitlens.llm import queries, role_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def searched(symbols: str) -> tuple[int, str]:
    """The least (cost, audit) by a search over (row, state of the plain automaton), cheapest and then ASCII-least first."""
    queue, done = [(0, "", 0, "start")], set()
    while queue:
        cost, audit, row, state = heapq.heappop(queue)
        if row == len(symbols) and state in ("start", "a"):
            return cost, audit
        if (row, state) in done:
            continue
        done.add((row, state))
        wanted = "a" if state == "u" else "u"
        heapq.heappush(queue, (cost + 5, audit + "I", row, wanted))
        if row == len(symbols):
            continue
        heapq.heappush(queue, (cost + 2, audit + "D", row + 1, state))
        if symbols[row] != "D":
            late, initial = 5 * symbols[row].isupper(), symbols[row].lower()
            if initial == wanted or (initial == "s" and state == "start"):
                heapq.heappush(queue, (cost + late, audit + "K", row + 1, initial))
            if initial != wanted:
                heapq.heappush(queue, (cost + late + 1, audit + "R", row + 1, wanted))
    raise AssertionError("deletes always end")


def spoken(rows: list[tuple]) -> dict:
    """A conversation's result, row by row. rows: (turn, role, text) after damage, in order."""
    seen, symbols, counts = set(), "", dict.fromkeys(role_repair.COUNTS, 0)
    for _, role, text in rows:
        core, initial = text.strip(" \t\n\x0b\x0c\r"), role[:1] if role[:1] in ("s", "u", "a") else "x"
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols += "D" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    counts["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts["cost"], audit = searched(symbols)
    lines, left, last = [], list(rows), ""
    for edit in audit:
        said = "assistant" if last == "u" else "user"
        role, text = (said, "") if edit == "I" else left.pop(0)[1:]
        if edit != "D":
            lines.append((role if edit == "K" else said, text))
            last = lines[-1][0][:1]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return counts | {"audit": audit, "repaired_sha256": digest}


def expected(chats: list[tuple]) -> dict:
    """By conversation, after damage."""
    out: dict = {c[0]: [] for c in chats}
    for conv, turn, role, text in chats:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: spoken(sorted(rows, key=order)) for conv, rows in out.items()}


def found(spark, chats: list[tuple]) -> dict:
    rows = role_repair.repair_damaged(spark.createDataFrame(chats, SCHEMA)).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: {k: r[k] for k in (*role_repair.COUNTS, "audit", "repaired_sha256")} for r in rows}


def test_parse_equals_search():
    pick = random.Random(5)
    for _ in range(400):
        symbols = "".join(pick.choices("DsuaxSUAX", [2, 1, 4, 4, 1, 1, 1, 1, 1], k=pick.randrange(0, 12)))
        assert role_repair.fold([list(role_repair.transfer(symbols))] if symbols else []) == searched(symbols), symbols


def test_parts_fold_to_the_whole():
    pick = random.Random(6)
    for _ in range(100):
        symbols = "".join(pick.choices("DsuaxUA", k=pick.randrange(2, 60)))
        cuts = sorted(pick.sample(range(1, len(symbols)), min(3, len(symbols) - 1)))
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        assert role_repair.fold([list(role_repair.transfer(p)) for p in parts]) == searched(symbols)


def test_stacks_are_few_and_the_grammar_holds():
    assert len(role_repair.STACKS) == 8
    for chat, good in {"": 1, "ua": 1, "sua": 1, "uaua": 1, "s": 0, "u": 0, "au": 0, "usa": 0, "suau": 0}.items():
        stack = role_repair.EMPTY
        for symbol in chat:
            stack = stack and role_repair._push(stack, symbol)
        assert (stack is not None and stack[0] in role_repair.ENDS) == bool(good), chat


def test_cases(spark):
    chats = [(1, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(12)]
    chats += [(2, t, r, x) for t, (r, x) in enumerate([("system", "Be."), ("user", "a"), ("user", " \t"), ("tool", "b!"), ("assistant", "b!")])]
    chats += [(3, None, "user", "a."), (3, None, None, None), (3, 7, "", "x?"), (3, 7, "user", "a."), (3, 9, "User", "é."), (3, 9, "user", "é　")]
    chats += [(None, None, "user", "a."), (None, 2, "assistant", "b."), (4, 2, None, None), (5, -3, "assistant", "x" * 100_000 + ". \n")]
    chats += [(6, 4, "user", "same.")] * 7 + [(6, 5, "user", "same.")] * 3 + [(6, 6, "assistant", "same.")]
    dropped = next(c for c in range(100, 200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    chats.append((dropped, 0, "user", "gone."))
    assert found(spark, chats) == expected(chats)
    assert found(spark, chats)[dropped]["audit"] == ""


def test_random_chats(spark):
    pick = random.Random(9)
    texts = ["Yes.", "No", "", " ", "What?\n", "Go on!", None, " "]
    roles = ["user", "assistant", "system", "tool", "umpire", None, ""]
    chats = [
        (c, pick.choice([None, *range(6)]), pick.choices(roles, [5, 5, 2, 1, 1, 1, 1])[0], pick.choice(texts)) for c in range(150) for _ in range(pick.randrange(1, 9))
    ]
    assert found(spark, chats) == expected(chats)


def test_one_conversation_with_a_third_of_all_rows(spark, monkeypatch):
    """It is cut into many segments, here of 64 places, and all null turns of it lie in one order."""
    monkeypatch.setattr(role_repair, "SEGMENT_BITS", 6)
    pick = random.Random(3)
    chats = [(1, t if t % 3 else None, pick.choice(["user", "assistant"]), f"{pick.randrange(900)}.") for t in range(3000)]
    chats += [(c, t, "user", "hi.") for c in range(2, 2000) for t in range(3)]
    rows = role_repair.damaged(spark.createDataFrame(chats, SCHEMA).withColumnRenamed("conv_id", "id"))
    segments = role_repair._placed(rows).groupBy(F.shiftright("at", 6).alias("s")).count()
    assert segments.agg(F.max("count")).first()[0] <= 64
    assert found(spark, chats) == expected(chats)


def test_no_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert role_repair.repair_damaged(empty).collect() == []
    chats = [(1, 1, "user", "a."), (1, 2, "assistant", "b.")]
    clash = spark.createDataFrame([(*c, "x", "y", 1, 2) for c in chats], SCHEMA + ", id string, audit string, n long, at long")
    plain = role_repair.repair_damaged(spark.createDataFrame(chats, SCHEMA))
    assert role_repair.repair_damaged(clash).collect() == plain.collect()


def test_equals_sql(spark):
    con = oracle_check.connect(SF_DIR)
    con.execute(f"create view conversations as select * from '{SF_DIR}/conversations.parquet'")
    name = "op11_structure_repair"
    assert oracle_check.difference(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None


@pytest.mark.parametrize("text", ["\x0b", "\x1f", "　", "."])
def test_blank_is_of_ascii_spaces_alone(spark, text):
    chats = [(1, 1, "user", text)]
    assert found(spark, chats) == expected(chats)
