"""Packs documents into sequences of tokens: concatenate and cut.

First pass: each task tokenizes its documents, ends each with an end token, and writes the tokens with their place in the
task's own stream. The tasks' totals, one row each, are summed up in order and give every task its global offset. Second
pass: fixed windows of the global stream are the sequences; a document that crosses a window's end is cut there, and each
piece is a boundary record of its own. Nothing is sorted or shuffled, and no row depends on another task's rows.

The stream's remainder, shorter than a window, is cut at powers of two, which need no padding.

Defined cases. Null or empty text: the end token alone. Any id may be null or repeat; pieces are told apart by their place.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.text import SPACES, utf8
from waitlens.llm.work import stored

SEQUENCE = 4096
END = 2
MEMORY = 144 << 20  # bytes of words and their ids that a worker remembers, in two halves
JOINED = 64
_WORD_COST = 110  # bytes of a remembered word besides its own characters and ids
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class _Encoder:
    """Token ids of words as bytes, from the tokenizer or from a worker's memory of the words of late.

    The tokenizer drops white space, never joins over it, and ignores case, so a text's tokens are those of its words in lower
    case. It never joins letters and signs either, so signs at a word's end are a word of their own. Words of letters alone go to
    it several at once and are told apart by the tokens that close a word; where these are not one a word, each goes alone.
    A word that spells an added token goes to it whole. Tokenizers of another kind are refused.
    """

    def __init__(self, tokenizer: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(tokenizer)
        spec = json.loads(self.model.to_str())
        folds = "Lowercase" in json.dumps(spec["normalizer"])
        if not folds or spec["model"].get("end_of_word_suffix") != "</w>" or any(a["normalized"] for a in spec["added_tokens"]):
            raise ValueError(f"{tokenizer} does not fold case and close words with </w>")
        added = [re.escape(a["content"].encode()) for a in spec["added_tokens"]]
        self.added = re.compile(b"|".join(added) if added else b"(?!)")
        vocabulary = self.model.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.memory, self.held = memory, 0

    def _learn(self, fresh: set[bytes]) -> None:
        """Words without signs at the end, the words before such signs, and the signs, each from the tokenizer."""
        known, whole, tails = self.young, [], []
        for word in fresh:
            core = word.rstrip(_SIGNS)
            if len(core) < len(word) and core and core[-1] in _PLAIN and not self.added.search(word):
                tails.append((word, core, word[len(core) :]))
            else:
                whole.append(word)
        whole += {x for _, core, signs in tails for x in (core, signs)}.difference(known, fresh)
        texts, alone, letters = b" ".join(whole).decode().split(" ") if whole else [], [], []
        for i, text in enumerate(texts):
            (letters if text.isalpha() else alone).append(i)
        groups = [letters[i : i + JOINED] for i in range(0, len(letters), JOINED)]
        coded = self.model.encode_batch_fast([" ".join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        for group, c in zip(groups, coded, strict=True):
            ids = np.array(c.ids, np.uint32)
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            raw = ids.tobytes()
            if len(ends) != len(group) or ends[-1] != len(raw):
                alone += group
                continue
            known.update(zip([whole[i] for i in group], map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        coded = self.model.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
        known.update([(whole[i], np.array(c.ids, np.uint32).tobytes()) for i, c in zip(alone, coded, strict=True)])
        known.update([(word, known[core] + known[signs]) for word, core, signs in tails])
        self.held += 4 * sum(map(len, fresh)) + _WORD_COST * (len(whole) + len(tails))

    def __call__(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as its words."""
        wanted = set().union(*texts)
        missing = wanted.difference(self.young)
        if missing and self.held > self.memory // 2:
            self.old, self.young, self.held, missing = self.young, {}, 0, wanted
        if missing:
            old = self.old
            again = {word: old[word] for word in missing if word in old}
            self.young.update(again)
            self.held += sum(map(len, again)) * 4 + _WORD_COST * len(again)
            self._learn(missing.difference(again))
        known = self.young
        return [b"".join(map(known.__getitem__, words)) for words in texts]


_encoders: dict[tuple[str, int], _Encoder] = {}  # of a worker, for its next tasks


def _encoder(tokenizer: str, memory: int) -> _Encoder:
    if (tokenizer, memory) not in _encoders:
        _encoders[tokenizer, memory] = _Encoder(tokenizer, memory)
    return _encoders[tokenizer, memory]


def _tokens(tokenizer: str, end: int, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, at = _encoder(tokenizer, memory), TaskContext.get().partitionId(), 0
        last = np.array([end], np.uint32).tobytes()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            data, offsets = data.tobytes(), offsets.tolist()
            for low in range(0, batch.num_rows, 256):
                texts = [data[a:b].split() for a, b in zip(offsets[low : min(low + 256, batch.num_rows)], offsets[low + 1 : low + 257], strict=True)]
                ids = [x + last for x in encode(texts)]
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                places = at + np.cumsum(counts) - counts
                at += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), task)), pa.array(places), batch.column(0).slice(low, len(ids)), pa.array(counts), pa.array(ids, pa.binary())],
                    ["task", "place", "id", "doc_tokens", "ids"],
                )

    return run


def _cuts(begin: int, end: int, total: int, sequence: int) -> list[int]:
    """Where the stream is cut between `begin` and `end`."""
    whole = total // sequence * sequence
    cuts = list(range((begin // sequence + 1) * sequence, min(end - 1, whole) + 1, sequence))
    at = whole
    for bit in range((total - whole).bit_length() - 1, -1, -1):
        if (total - whole) >> bit & 1:
            at += 1 << bit
            if begin < at < end:
                cuts.append(at)
    return cuts


def _sequence(place: int, total: int, sequence: int) -> tuple[int, int]:
    """The sequence of a place in the stream, and the offset in it."""
    whole = total // sequence * sequence
    if place < whole:
        return place // sequence, place % sequence
    number, at = whole // sequence, whole
    for bit in range((total - whole).bit_length() - 1, -1, -1):
        if (total - whole) >> bit & 1:
            if place < at + (1 << bit):
                break
            at += 1 << bit
            number += 1
    return number, place - at


def _cut(sequence: int):
    """Of each document (id, tokens, ids, global place, total) its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pieces = [], []
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            for row, (tokens, ids, begin, total) in enumerate(zip(*columns, strict=True)):
                edges = [begin, *_cuts(begin, begin + tokens, total, sequence), begin + tokens]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    rows.append(row)
                    own = ids[4 * (a - begin) : 4 * (b - begin)]
                    pieces.append((a - begin, b - a, own, tokens, *_sequence(a, total, sequence)))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            made = [pa.array(list(c), k) for c, k in zip(zip(*pieces, strict=True), kinds, strict=True)] if pieces else [pa.array([], k) for k in kinds]
            names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end: int = END, memory: int = MEMORY
) -> DataFrame:
    """Pieces of documents: the id, start, length, ids (unsigned 32-bit little-endian), doc_tokens, sequence_id and offset.

    tokenizer: a file that every executor can read. Every token lies in one piece; a sequence's pieces follow without gaps.
    memory: bytes of words that each worker keeps between its tasks.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    tokens = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(
        _tokens(tokenizer, end, memory), f"task long, place long, id {kind}, doc_tokens long, ids binary"
    )
    tokens = stored(tokens)
    totals = tokens.groupBy("task").agg(F.sum("doc_tokens").alias("tokens"))  # a row for each task of the first pass
    before = F.sum("tokens").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("task", F.coalesce(before, F.lit(0)).alias("before"), F.sum("tokens").over(Window.partitionBy()).alias("total"))
    placed = tokens.join(F.broadcast(offsets), "task").select("id", "doc_tokens", "ids", F.expr("place + before"), "total")
    return placed.mapInArrow(_cut(sequence), f"id {kind}, {_PIECES}").withColumnRenamed("id", id_column)


assert set(SPACES) == set(b" \t\n\r\x0b\x0c"), "bytes.split() cuts at these"
