"""Source divergence against plain counting, and its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import oracle_check
from conftest import SF_DIR
from waitlens.llm import queries, source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def plain(docs: list[tuple], least: int, top: int = 50) -> list[tuple]:
    counts, holds, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(words)
        holds[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in holds[lang].items() if n >= least]

        def shares(count: Counter) -> dict[str, int]:
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}  # noqa: B023

        own = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            parts = {
                "pair": [(o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in sources if o != s],
                "term": [(t, own[s][t] - whole[t]) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(items) if part == "pair" or n < top]
    return sorted(out)


def found(spark, docs: list[tuple], least: int, **options) -> list[tuple]:
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    rows = source_divergence.audit(frame, least_documents=least, **options)
    return sorted(tuple(r) for r in rows.select("lang", "source", "part", "item", "value", "rank").collect())


def made(seed: int, n: int = 300) -> list[tuple]:
    pick = random.Random(seed)
    texts = [" ".join(pick.choice(["Été", "the", "DAY-x", "漢字", "a1b", "no\x85w", "_"]) + "q" * pick.randrange(6) for _ in range(pick.randrange(30))) for _ in range(n)]
    docs = [(i, t, pick.choice(["en", "de", None, ""]), pick.choice(["s0", "s0", "s1", "S2", None, "é", "z"])) for i, t in enumerate(texts)]
    return [*docs, docs[0], docs[0], (7, None, "en", "silent"), (8, "", "xx", "a"), (9, "alone here", "xx", "b"), (10, "alone", "one", "only")]


@pytest.mark.parametrize("least", [1, 30, 10_000])
def test_equals_plain_counting(spark, least):
    docs = made(least)
    assert found(spark, docs, least) == plain(docs, least)


def test_blocks_chunks_and_flushes(spark, monkeypatch):
    """Many blocks, several chunks of sources, texts read in pieces and counts given out early change nothing."""
    for name, value in (("BLOCK_BITS", 3), ("CHUNK", 2), ("ENTRIES", 20), ("PIECE", 16)):
        monkeypatch.setattr(source_divergence, name, value)
    docs = made(4, 120)
    frame = spark.createDataFrame(docs, SCHEMA)
    counts = source_divergence.term_counts(frame.repartition(3), 5)
    plainly = source_divergence.audit(frame, 5)
    assert sorted(map(tuple, plainly.collect())) == plain(docs, 5)
    assert counts.where("term is null").count() == len({(d[2] or "", d[3] or "") for d in docs})


def test_pairs_by_chunks(spark, monkeypatch):
    docs = made(6, 200)
    frame = spark.createDataFrame(docs, SCHEMA)
    counts = source_divergence.term_counts(frame, 5)
    terms = source_divergence._ordered(counts)
    totals = counts.groupBy("lang", "source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "total")
    of_lang = terms.groupBy("lang").count().withColumnRenamed("count", "terms")
    totals = totals.join(of_lang, "lang")
    columns = source_divergence.run_columns(counts, terms, totals)
    sums = [sorted(map(tuple, source_divergence.pair_sums(columns, totals, chunk).collect())) for chunk in (1, 3, 64)]
    assert sums[0] == sums[1] == sums[2] and sums[0]


def test_runs_are_merged():
    pick = random.Random(2)
    for _ in range(50):
        a, b = ([pick.choice([1, 1, 1, 5, 9]) for _ in range(40)] for _ in range(2))
        runs = []
        for column in (a, b):
            ends = [i + 1 for i in range(40) if i == 39 or column[i] != column[i + 1]]
            runs.append((np.array(ends), np.array([column[e - 1] for e in ends])))
        assert source_divergence._difference(*runs) == sum(abs(x - y) for x, y in zip(a, b))


def test_shares_are_exact(spark):
    pick = random.Random(1)
    rows = [(n, n + pick.randrange(10**15), pick.randrange(1, 10**6)) for n in [0, 1, 10**14, 3 * 10**9, *[pick.randrange(10**13) for _ in range(50)]]]
    frame = spark.createDataFrame(rows, "n long, total long, terms long")
    share = source_divergence._share(frame.n, frame.total, frame.terms)
    got = [r[0] for r in frame.select(share).collect()]
    assert got == [1 + 10**9 * (n + 5) // (total + 5 * terms) for n, total, terms in rows]


def test_no_rows_and_clashing_columns(spark):
    assert found(spark, [], 1) == []
    docs = made(3, 40)
    frame = spark.createDataFrame([(*d, "x", 5, "y") for d in docs], SCHEMA + ", term string, n long, at string")
    assert sorted(map(tuple, source_divergence.audit(frame, 2).collect())) == plain(docs, 2)


def test_very_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "PIECE", 1000)
    docs = [(i, "Long wörd " * 20_000 + "x" * 50_000, "en", f"s{i % 2}") for i in range(4)] + [(9, "wörd", "en", "s2")]
    assert found(spark, docs, 2) == plain(docs, 2)


def test_equals_sql(spark):
    con = oracle_check.connect(SF_DIR)
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    name = "op12_source_divergence"
    assert oracle_check.difference(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None
