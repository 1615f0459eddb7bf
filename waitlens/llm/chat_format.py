"""Chat formatting: any known layout of conversations becomes canonical turns, and turns become text with a loss mask.

A layout is told by the fingerprint of its schema: the hash of its nested field paths, of those that any layout uses (other
columns do not matter). The fingerprint selects a declarative mapping, SQL expressions over the fields. Rows of JSON are told
one by one, by the fingerprint of their own keys, those of all elements of a list; rows of no known layout, with an empty
list, or that are no JSON go to a table of their own with the paths found.

The template writes each turn as `<turn:ROLE>`, the text and `</turn>`, each on lines of its own. Inside roles and texts the
characters that the template uses are written as two, each starting with a backslash, so nothing in a text can end a turn,
and unescaping gives back exactly what was there. The loss mask holds the assistant's texts as spans of their turns.

All on DataFrame functions. A conversation is one output row, so its turns come together in one task; nothing else does.

Defined cases. Null role or text: empty. Turns in order of turn, then role and text; null turns first. Repeated rows are turns
of their own. Null id: one conversation. A table of an unknown layout is an error that names its paths; a row of JSON of one is
given back as unreadable. A list element without a role or text reads as empty there.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASSISTANT = "assistant"
OPEN, HEAD_END, CLOSE = "<turn:", ">\n", "\n</turn>\n"
#: Character, what stands for it. The backslash comes first when escaping and last when unescaping.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("\n", "\\n"))

_ROLE = "coalesce(element_at(map('human', 'user', 'gpt', 'assistant', 'bot', 'assistant', 'model', 'assistant'), {0}), {0})"


def _pair(*turns: tuple[str, str]) -> str:
    return "array(" + ", ".join(f"struct('{role}' as role, {text} as text)" for role, text in turns) + ")"


#: Field paths of a layout, and its turns as an array of (role, text); None: rows are turns already.
LAYOUTS = {
    "turn rows": (("conv_id", "turn", "role", "text"), None),
    "messages": (("messages[].role", "messages[].content"), f"transform(messages, m -> struct({_ROLE.format('m.role')} as role, m.content as text))"),
    "shared": (("conversations[].from", "conversations[].value"), f"transform(conversations, m -> struct({_ROLE.format('m.from')} as role, m.value as text))"),
    "prompt": (("prompt", "completion"), _pair(("user", "prompt"), (ASSISTANT, "completion"))),
    "prompt and response": (("prompt", "response"), _pair(("user", "prompt"), (ASSISTANT, "response"))),
    "system prompt": (("system", "prompt", "response"), _pair(("system", "system"), ("user", "prompt"), (ASSISTANT, "response"))),
    "instruction": (("instruction", "output"), _pair(("user", "instruction"), (ASSISTANT, "output"))),
    "instruction and input": (
        ("instruction", "input", "output"),
        _pair(("user", "concat_ws('\\n\\n', instruction, nullif(input, ''))"), (ASSISTANT, "output")),
    ),
    "question": (("question", "answer"), _pair(("user", "question"), (ASSISTANT, "answer"))),
}
_PATHS = sorted({path for paths, _ in LAYOUTS.values() for path in paths})


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths) & set(_PATHS))).encode()).hexdigest()


_KNOWN = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    if isinstance(kind, T.StructType):
        dot = f"{prefix}." if prefix else ""
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{dot}{f.name}")]
    return [prefix]


def layout_of(schema: T.StructType) -> str:
    found = field_paths(schema)
    if (print_ := fingerprint(found)) not in _KNOWN:
        raise ValueError(f"no mapping for the layout {sorted(found)}")
    return _KNOWN[print_]


def _numbered(rows: DataFrame) -> DataFrame:
    """conv_id, turns -> conv_id, turn, role, text."""
    return rows.select("conv_id", F.posexplode("turns").alias("turn", "t")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text"
    )


def canonical_turns(rows: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """conv_id, turn, role, text from rows of any known layout."""
    _, turns = LAYOUTS[layout_of(rows.schema)]
    if turns is None:
        return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return _numbered(rows.select(F.col(id_column).alias("conv_id"), F.expr(turns).alias("turns")))


def _json_schema(paths: tuple[str, ...]) -> str:
    top: dict[str, list[str]] = {}
    for path in paths:
        head, _, leaf = path.partition("[].")
        top.setdefault(head, []).extend([leaf] if leaf else [])
    fields = (f"{h}: array<struct<{', '.join(f'{x}: string' for x in leaves)}>>" if leaves else f"{h}: string" for h, leaves in top.items())
    return f"struct<{', '.join(fields)}>"


def _json_paths(document: Column) -> Column:
    """The field paths of a JSON object that any layout uses, sorted."""

    def inner(key: Column) -> Column:
        value = F.call_function("get_json_object", document, F.concat(F.lit("$."), key))
        elements = F.filter(F.from_json(value, "array<map<string, string>>"), lambda m: m.isNotNull())
        leaves = F.array_distinct(F.flatten(F.transform(elements, F.map_keys)))
        listed = F.transform(leaves, lambda k: F.concat(key, F.lit("[]."), k))
        return F.when(value.startswith("["), F.coalesce(listed, F.array(F.concat(key, F.lit("[]"))))).otherwise(F.array(key))

    paths = F.flatten(F.transform(F.json_object_keys(document), inner))
    return F.sort_array(F.array_intersect(paths, F.array(*map(F.lit, _PATHS))))


def canonical_json(rows: DataFrame, json: str, id_column: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Rows of JSON, each with a layout of its own: conv_id, turn, role, text of those that are known, and conv_id, json, paths of
    the others. Every row is in one of both."""
    document = F.col(json)
    told = rows.select(F.col(id_column).alias("conv_id"), document.alias("json"), _json_paths(document).alias("paths"))
    told = told.withColumn("print", F.sha2(F.array_join("paths", "\n"), 256))
    turns = F.lit(None).cast("array<struct<role: string, text: string>>")
    for paths_of, mapping in LAYOUTS.values():
        if mapping is not None:
            turns = F.when(F.col("print") == fingerprint(paths_of), told_fields(mapping, paths_of)).otherwise(turns)
    told = told.withColumn("turns", turns)
    missing = F.col("turns").isNull() | (F.size("turns") == 0)
    read = _numbered(told.where(~missing).select("conv_id", "turns"))
    texts = {c: F.coalesce(c, F.lit("")) for c in ("role", "text")}
    return read.withColumns(texts), told.where(missing).select("conv_id", "json", "paths")


def canonical_json_turns(rows: DataFrame, json: str, id_column: str = "conv_id") -> DataFrame:
    """The turns alone; `canonical_json` also gives the rows that it cannot read."""
    return canonical_json(rows, json, id_column)[0]


def told_fields(mapping: str, paths: tuple[str, ...]) -> Column:
    """A mapping over the fields of the parsed JSON."""
    for name in sorted({p.partition("[]")[0] for p in paths}, key=len, reverse=True):
        mapping = _qualified(mapping, name)
    return F.expr(f"element_at(transform(array(from_json(json, '{_json_schema(paths)}')), j -> {mapping}), 1)")


def _qualified(mapping: str, name: str) -> str:
    import re

    return re.sub(rf"(?<![\w.'])({name})(?=[,) ])", r"j.\1", mapping)


def _escaped(text: Column) -> Column:
    for plain, coded in ESCAPES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def _unescaped(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask: the text of each conversation, and the spans (turn, start, length) under the loss.

    A span counts code points from the start of its turn's own text in `formatted`, header included.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), F.replace(_escaped(role), F.lit("\n"), F.lit("\\n")), F.lit(HEAD_END))
    pieces = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), _escaped(text).alias("body"))
    listed = pieces.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("turn", "role", "text", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.length("head").alias("start"), F.length("body").alias("length")))
        ).alias("turns")
    )
    spans = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["start"].alias("start"), t["length"].alias("length"), t["role"].alias("role")))
    return listed.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["role"] == ASSISTANT), lambda s: s.dropFields("role")).alias("loss_mask"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), loss_texts: read back from `formatted` and `loss_mask` alone."""
    pieces = F.split("formatted", CLOSE)  # without what follows the last one, which is empty
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    split = formatted.select("conv_id", "formatted", "loss_mask", pieces.alias("pieces"))
    head = lambda p: F.substring_index(p, HEAD_END, 1)
    turn = lambda p: F.struct(
        _unescaped(F.substr(head(p), F.lit(len(OPEN) + 1))).alias("role"),
        _unescaped(F.substr(p, F.length(head(p)) + len(HEAD_END) + 1)).alias("text"),
    )
    under = lambda s: _unescaped(F.substr(F.get("pieces", s["turn"]), s["start"] + 1, s["length"]))
    return split.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"), F.transform("loss_mask", under).alias("loss_texts"))
