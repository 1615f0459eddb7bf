"""Token files against the tokenizers library on whole texts, and random access to them."""

from __future__ import annotations

import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from waitlens.llm import token_files
from waitlens.llm.work import work_folder

BYTES, WORDS = (str(public_tokenizers.path(f"{n}.json")) for n in ("byte_bpe_50k", "word_bpe_49k"))
PARTS = [" ", "  ", "\n", " \n", "\t", "\xa0", "　", "\x1c", "\x85", "'s", "'", ".", "...", "!?", "a", "word", "Été", "é", "1", "23", "²", "<|endoftext|>", "漢字"]
PARTS += ["😀", "́", "ͣ", "x" * 30, "\r\n", "#", "_", "<|", "|>", "ª", "ʰ", "ͅ", "ǅ", "‍", "﻿", "The", "(it)", "can't", "WE'LL"]


load = lru_cache(Tokenizer.from_file)


def library(path: str, text: str | None) -> list[int]:
    return load(path).encode(text or "", add_special_tokens=False).ids + [token_files.END]


@pytest.mark.parametrize("slice_chars", [1 << 20, 29])
def test_ids_of_parts_are_ids_of_the_text(monkeypatch, slice_chars):
    monkeypatch.setattr(token_files, "SLICE", slice_chars)
    pick, model = random.Random(3), Tokenizer.from_file(BYTES)
    texts = ["".join(pick.choices(PARTS, k=pick.randrange(40))) for _ in range(3000)]
    encode = token_files.Encoder(BYTES, memory=20_000)  # forgets all the time
    found = [np.frombuffer(ids, encode.kind).tolist() for low in range(0, len(texts), 50) for ids in encode(texts[low : low + 50])]
    assert found == [c.ids for c in model.encode_batch(texts, add_special_tokens=False)]


def test_words_with_marks_and_line_breaks_are_no_calls_of_their_own(monkeypatch):
    """Their words go to the library together: with a call for each such part the check counted 482 CPU seconds a GB."""
    encode, sent = token_files.Encoder(BYTES), []
    ids_of = encode._ids
    monkeypatch.setattr(encode, "_ids", lambda texts: sent.extend(texts) or ids_of(texts))
    texts = [f"wörd{c}ed, once{c}.\nThen{c}, it's so{c}&&& {c}ed.\n\nNo  {c}\n {c}\x0b{c} '{c}' x{c}_\n_{c}'s " * 3 for c in "abcdefghij" * 10]
    wanted = [library(BYTES, x)[:-1] for x in texts]
    assert [np.frombuffer(x, encode.kind).tolist() for x in encode(texts)] == wanted
    assert not any("&&&" in x and len(x) > 3 or "once" in x and "." in x for x in sent)


def test_other_tokenizers_get_whole_texts():
    encode = token_files.Encoder(WORDS)
    assert not encode.cut
    texts = ["A  Word, x<|endoftext|>y", "", "É é"]
    assert [np.frombuffer(x, encode.kind).tolist() for x in encode(texts)] == [library(WORDS, t)[:-1] for t in texts]


def made(spark) -> list[tuple]:
    pick = random.Random(8)
    long = " ".join(pick.choice(["alpha", "Bêta", "x1,", "\n", ""]) for _ in range(40_000))
    texts = [None, "", "a", long, "b <|endoftext|> c", " ", "#", "# #", *["".join(pick.choices(PARTS, k=30)) for _ in range(60)]]
    rows = [(i * 3, t, "clash", i) for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[4], (9, "another text of an id", "", 0), (None, "no id", "", 0), (None, None, "", 0), (-5, "first of ids", "", 0)]


def expected(rows: list[tuple], path: str) -> dict:
    """The multiset of (id, n_tokens, checksum), and that starts are gapless in the order of ids."""
    out = []
    for doc, text, *_ in rows:
        ids = library(path, text)
        out.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("length, sequences", [(16, 2), (2048, 256)])
def test_round_trip(spark, length, sequences):
    rows = made(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, id long").repartition(5)
    found = token_files.round_trip(docs, BYTES, length=length, sequences=sequences).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], key=key) == expected(rows, BYTES)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_random_access(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 50)) for i in range(300)], "doc_id long, text string")
    folder = f"{work_folder(spark)}/tokens"
    parts = token_files.write(docs, BYTES, folder, length=32, sequences=4).orderBy("part").collect()
    stream = np.concatenate([library(BYTES, f"text {i} " * (i % 50)) for i in range(300)])
    assert sum(p.n_ids for p in parts) == len(stream) and sum(p.n_docs for p in parts) == 300
    for part in parts:
        own, file = stream[part.start : part.start + part.n_ids], token_files.TokenFile(part.ids)
        assert file.file.schema.field("ids").type == pa.list_(pa.uint16(), 32)
        pick = random.Random(1)
        for _ in range(50):
            first = pick.randrange(part.n_ids)
            n = pick.randrange(1, part.n_ids - first + 1)
            assert file.ids(first, n).tolist() == own[first : first + n].tolist()
        view = file.ids(0, 32)
        assert not view.flags.owndata and not view.flags.writeable  # of the mapped file
        ids, mask, ends = file.sequence((part.n_ids - 1) // 32)
        tail = (part.n_ids - 1) % 32 + 1
        assert mask.to_pylist() == [True] * tail + [False] * (32 - tail) and ids[tail:].tolist() == [0] * (32 - tail)
        assert ends[tail - 1].as_py()
        assert len(file.ends()) == part.n_docs


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert token_files.round_trip(docs, BYTES).collect() == []


def test_hot_id_is_spread(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, id, 7L) as doc_id", "concat('text ', id) as text")
    folder = f"{work_folder(spark)}/tokens"
    parts = token_files.write(docs.repartition(6), BYTES, folder).collect()
    assert max(p.n_docs for p in parts) < 2000 or len(parts) == 1
    assert sum(p.n_docs for p in parts) == 3000
