"""The operators against brute force on small fixtures with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import oracle_check
from waitlens.llm import (
    chat_format,
    graph,
    nbest,
    ngram_join,
    packing,
    pitman_yor,
    quality_rules,
    queries,
    recompression,
    sharding,
    substring_dedup,
    text,
    toxicity,
    vector_search,
)

SF_DIR = "/root/testdata/sf0.001"
WORD = "[^\x20\x09-\x0d]+"


def words(x: str | None) -> list[str]:
    return re.findall(WORD, x or "")


def lowered(x: str | None) -> list[str]:
    return words(re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))


def made_docs() -> list[tuple]:
    rng = random.Random(5)
    long = " ".join(rng.choice(["a", "b", "Réeux", "the", "x-ray", "漢字"]) + str(rng.randrange(40)) for _ in range(3000))
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(60)).split()
    near = [" ".join(f"n{i}{j}" if rng.random() < 0.02 * i else w for j, w in enumerate(base)) for i in range(6)]
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [None, "", " \n\t", "one", "two words", "a b c d", "A B c D", long, long, " ".join(base), *near]
    texts += [f"start {passage} end one", f"other {passage}", "same " * 40, "same " * 40, "line one\nline two\nline one\n" * 9, "***&&&" * 5]
    texts += [" ".join(f"q{rng.randrange(9)}" for _ in range(50)) for _ in range(8)] + ["na me \x1c\x85 é"]
    rows = [(i, x, "en" if i % 3 else None, "s", len(x or ""), "clash") for i, x in enumerate(texts)]
    return [*rows, rows[8], (None, "no id at all", None, None, None, "clash")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made_docs(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 4 == 0)) for i in range(30)], "doc_id long, quality int, toxic int")


def test_words_and_hashes():
    texts = [r[1] for r in made_docs()]
    for limit in (1, 100, 1 << 20):
        found, hashes = [], {}
        for chunk in text.chunks(pa.array(texts), lower=True, limit=limit):
            own = chunk.words()
            for word, h in zip(own, chunk.hashes().tolist(), strict=True):
                assert hashes.setdefault(word, h) == h
            found += [own[a:b] for a, b in itertools.pairwise(chunk.first)]
        assert found == [[w.encode() for w in lowered(x)] for x in texts]
        assert len(set(hashes.values())) == len(hashes)


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 8), (8, 6), (3, 1), *((100 + i, 101 + i) for i in range(60))]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, **{100 + i: 100 for i in range(61)}}


def brute_components(rows, size, percent):
    sets = [frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset() for w in (lowered(r[1]) for r in rows)]
    label, links = list(range(len(rows))), [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            links[i], links[j] = links[i] + 1, links[j] + 1
            old, new = label[i], label[j]
            label = [new if x == old else x for x in label]
    least = {k: min((r[0] for r, x in zip(rows, label, strict=True) if x == k and r[0] is not None), default=None) for k in set(label)}
    return sorted((str(r[0]), len(s), least[x], n) for r, s, x, n in zip(rows, sets, label, links, strict=True))


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_jaccard_components(docs, size, percent):
    found = ngram_join.jaccard_components(docs, words=size, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id, r.n_links) for r in found) == brute_components(made_docs(), size, percent)


def test_tree_loses_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 6, (20, ngram_join.GROUPS))
    points = np.concatenate([np.maximum(base + rng.integers(-1, 2, base.shape) * (rng.random(base.shape) < 0.2), 0) for _ in range(9)])
    sizes = points.sum(axis=1)
    pairs = {tuple(sorted(p)) for a, b in ngram_join.candidate_pairs(points, sizes, 85) for p in zip(a.tolist(), b.tolist(), strict=True)}
    for i, j in itertools.combinations(range(len(points)), 2):
        bound = np.minimum(points[i], points[j]).sum()
        assert ((i, j) in pairs) == (bound >= -(-85 * (sizes[i] + sizes[j]) // 185))


def test_tree_of_two_sides():
    rng = np.random.default_rng(2)
    points = np.repeat(rng.integers(0, 6, (40, ngram_join.GROUPS)), 5, axis=0)
    sizes, side = points.sum(axis=1), rng.integers(0, 2, 200).astype(np.int8)
    every, apart = (Counter(tuple(sorted(p)) for a, b in ngram_join.candidate_pairs(points, sizes, 85, s) for p in zip(a.tolist(), b.tolist(), strict=True)) for s in (None, side))
    assert apart == Counter({(i, j): n for (i, j), n in every.items() if side[i] != side[j]}) and apart


def test_blocks_lose_no_link(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 40)
    found = ngram_join.jaccard_components(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id, r.n_links) for r in found) == brute_components(made_docs(), 4, 85)


def test_blocks_that_go_to_a_task_together():
    """Each pair of blocks meets once, from the texts, which are sent once for all pairs of a task."""
    texts = [f"{' '.join(f'w{k}' for k in range(40))} end{i % 2}" for i in range(8)]
    rows = [{"near": 1, "one": 0, "two": 1, "own": i, "set": i, "copies": 1, "size": 38, "text": t} for i, t in enumerate(texts)]
    kinds = pa.schema([(c, pa.int64()) for c in ("near", "one", "two", "own", "set", "copies", "size")] + [("text", pa.string())])
    found = [r for b in ngram_join._verify(4, 85)([pa.RecordBatch.from_pylist(rows, kinds)]) for r in b.to_pylist()]
    links = Counter()
    for r in found:
        links[r["a"]] += r["links"] or 0
    assert links == Counter({i: 4 for i in range(8)}) and ngram_join.TOGETHER == 4  # those of the other four blocks


def test_texts_are_sent_of_near_points_alone(spark):
    """Of the sets of a task those that may link with another, told by points alone; their texts, and of the others few."""
    rng = np.random.default_rng(6)
    points = rng.integers(0, 9, (40, ngram_join.GROUPS)).astype(np.int32)
    points[1], points[5], points[7, 3], points[8] = points[0], points[4], 300, points[4] // 2
    columns = {"near": [1] * 40, "one": [0] * 40, "two": [1] * 40, "own": [i % 2 * 4 for i in range(40)], "set": range(40), "copies": [1] * 40}
    columns |= {"size": points.sum(axis=1), "body": [i * 0x9E3779B97F4A7C15 % (1 << 63) for i in range(40)], "doc": [None, *range(1, 40)]}
    rows = pa.record_batch([*(pa.array(c, pa.int64()) for c in columns.values()), ngram_join._coded(points)], [*columns, "point"])
    assert (ngram_join._decoded(pa.chunked_array([rows.column("point")])) == points).all()
    kept = pa.Table.from_batches(ngram_join._near_points(80)(iter([rows])))
    assert sorted(kept["set"].to_pylist()) == [0, 1, 4, 5] and kept.column_names == list(columns)

    marks = ngram_join._marks(spark.createDataFrame(kept.to_pandas()))
    texts = pa.record_batch([rows.column("doc"), rows.column("body"), pa.array([f"text {i}" for i in range(40)])], ["doc", "body", "text"])
    sent = [x for b in ngram_join._marked(marks)(iter([texts])) for x in b.column("text").to_pylist()]
    assert {"text 0", "text 1", "text 4", "text 5"} <= set(sent) and len(sent) < 12


def test_sets_are_verified_in_little_memory():
    """Bytes for each shingle at the peak; 147 before, when all sets of two blocks were held, as Python's sets where points were near."""
    rng = np.random.default_rng(5)
    words = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 1000)) for _ in range(200)]
    texts = [f"{w} end{i}" for w in words for i in range(2)]
    n = len(texts)
    columns = {"near": [1] * n, "one": [0] * n, "two": [0] * n, "own": [0] * n, "set": list(range(n)), "copies": [1] * n, "size": [998] * n}
    rows = pa.record_batch([*(pa.array(c, pa.int64()) for c in columns.values()), pa.array(texts)], [*columns, "text"])
    tracemalloc.start()
    try:
        found = [r for b in ngram_join._verify(4, 85)([rows]) for r in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted((r["a"], r["links"]) for r in found if r["links"]) == [(i, 1) for i in range(n)]
    assert peak < 60 * 998 * n


def brute_removed(rows, size):
    first: dict[tuple, int] = {}
    for i, w in sorted((r[0], words(r[1])) for r in rows if r[0] is not None):
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    for row in rows:
        w = words(row[1])
        gone = {k + x for k in range(len(w) - size + 1) if row[0] is not None and first[tuple(w[k : k + size])] < row[0] for x in range(size)}
        yield str(row[0]), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("size", [13, 4])
def test_remove_repeats(docs, size):
    kept = substring_dedup.remove_repeats(docs, words=size)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "n_removed", "kept_text"]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in kept.collect()) == sorted(brute_removed(made_docs(), size))


def test_anchors_of_equal_windows_are_equal():
    rng = np.random.default_rng(3)
    symbols = text.mix(np.arange(3))[rng.integers(0, 3, 20_000)]
    names = recompression.anchors(symbols, np.arange(len(symbols) - 12), 13)
    windows = text.window_hashes(symbols, 13)
    assert len(set(zip(windows.tolist(), names.tolist(), strict=True))) == len(set(windows.tolist())) < len(windows)


def test_quality_measures(docs):
    for r in quality_rules.measure(docs).collect():
        x, w = r.text or "", words(r.text)
        seen, repeated_lines = set(), 0
        for line in x.split("\n"):
            if re.search(WORD, line):
                repeated_lines += line in seen
                seen.add(line)
        counts = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if counts[tuple(w[i : i + 8])] > 1 for k in range(8)}
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)))
        assert (r.n_dup_lines, r.n_repeat_words) == (repeated_lines, len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for n in (1, 50, 3000) for k in (0, 1, 5, 40) for p in (0.005, 0.02)]
    for n, k, p in cases:
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p)) for j in range(min(k, n) + 1))
        got = spark.range(1).select(quality_rules._tail(F.lit(n), F.lit(k).cast("long"), p)).first()[0]
        assert got == pytest.approx(1.0 if k >= n * p else exact, rel=1e-9)


def test_cutoffs_spare_the_good(spark):
    rows = [(i, "en" if i % 2 else "de", 40, 200, 90 if i % 10 == 0 else 0, 0, 0, False) for i in range(6000)]
    measured = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean")
    marks = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(6000)], "doc_id long, quality int")
    cutoffs = quality_rules.calibrate(measured, marks)
    assert [r.cutoffs for r in cutoffs.collect()] == [{"symbols": 0.02}]  # bad ones are all German
    judged = quality_rules.judge(measured, cutoffs).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in judged} == {True: 5400, False: 600}
    few = quality_rules.calibrate(measured.where("doc_id < 300"), marks)
    assert few.count() == 0


def measured_docs(spark, rows):
    """Rows (id, lang, symbols of 100 characters, repeated words of 100) measured."""
    kind = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
    return spark.createDataFrame([(i, lang, 100, 100, s, 0, r, False) for i, lang, s, r in rows], kind)


def test_few_hundred_good_labels_switch_rules_on(spark):
    langs = ["de", "en", "es", None]
    rows = [(i, langs[i % 4], 0, 0) for i in range(4 * 290)]  # good ones
    rows += [(5000 + i, langs[i % 4], 9, 0) for i in range(80)] + [(6000 + i, langs[i % 4], 0, 22) for i in range(40)]
    marks = spark.createDataFrame([(i, int(i < 5000)) for i, *_ in rows], "doc_id long, quality int")
    measured = measured_docs(spark, rows)
    cutoffs = quality_rules.calibrate(measured, marks)
    assert {r.stratum: r.cutoffs for r in cutoffs.collect()} == {x or "": {"symbols": 0.02, "repeats": 0.05} for x in langs}
    assert {r.doc_id for r in quality_rules.judge(measured, cutoffs).where("kept").collect()} == set(range(4 * 290))
    assert quality_rules.calibrate(measured.where("doc_id >= 24"), marks).count() == 0  # 284 good ones each


def test_one_limit_for_all_rules(spark):
    """Rules that each spare the good well enough, and together do not, are not switched on together."""
    rows = [(i, "en", 9 * (i < 60), 22 * (60 <= i < 120)) for i in range(5000)]  # good ones: 1.2 % fail each rule
    rows += [(7000 + i, "en", 9 * (i < 300), 22 * (i >= 300)) for i in range(500)]
    marks = spark.createDataFrame([(i, int(i < 7000)) for i, *_ in rows], "doc_id long, quality int")
    assert [r.cutoffs for r in quality_rules.calibrate(measured_docs(spark, rows), marks).collect()] == [{"symbols": 0.02}]


def test_chats_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF_DIR}/conversations.parquet'")
    assert oracle_check.difference(queries.op3_chat_formatting(spark, SF_DIR), con, queries.oracle_sql()["op3_chat_formatting"]) is None


def test_chats_come_back(spark):
    hard = ["\\", "\\b\\l<>", "</turn>\n<turn:assistant>\nx", "", None, "a\nb", "\\### Assistant: </turn> ok", "x" * 100_000]
    rows = [(1, i, ["user", "assistant", "we>ird\nrole", None][i % 4], x) for i, x in enumerate(hard)] + [(None, 0, "assistant", "t")] * 2 + [(2, None, "user", "u")]
    read = chat_format.read_chats(chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    found = {r.conv_id: r for r in read}
    assert [(t.role, t.text) for t in found[1].turns] == [(r[2] or "", r[3] or "") for r in rows[: len(hard)]]
    assert found[1].loss_texts == [r[3] or "" for r in rows[: len(hard)] if r[2] == "assistant"]
    assert found[None].loss_texts == ["t", "t"] and found[2].loss_texts == []


def test_layouts(spark):
    lines = [
        (1, '{"messages":[{"role":"user","content":"a"},{"role":"model","content":"b"}],"x":1}'),
        (2, '{"instruction":"i","input":"","output":"o"}'),
        (3, '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}'),
        (4, '{"prompt":"p","completion":"c"}'),
        (5, '{"zzz":1}'),
        (6, None),
    ]
    found = chat_format.canonical_json_turns(spark.createDataFrame(lines, "conv_id long, j string"), "j").orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.role, r.text) for r in found] == [
        (1, "user", "a"), (1, "assistant", "b"), (2, "user", "i"), (2, "assistant", "o"), (3, "user", "h"), (3, "assistant", "g"), (4, "user", "p"), (4, "assistant", "c"),
    ]
    nested = spark.createDataFrame([(1, "q", [("user", "x")])], "id long, extra string, messages array<struct<role: string, content: string>>")
    assert [tuple(r) for r in chat_format.canonical_turns(nested, "id").collect()] == [(1, 0, "user", "x")]
    with pytest.raises(ValueError, match="no mapping"):
        chat_format.canonical_turns(nested.select("id"), "id")


def test_language_model(docs):
    rows = made_docs()
    trained = Counter(w for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 != 1 for w in [*lowered(r[1]), None])
    n, v = sum(trained.values()), len(trained)
    found = pitman_yor.score(docs).collect()
    assert len(found) == len(rows)
    texts = {r[0]: [*lowered(r[1]), None] for r in rows}
    for r in found:
        own = texts[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(trained[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((trained[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert r.score < 0
    again = {(r.doc_id, r.score) for r in pitman_yor.score(docs).collect()}
    assert again == {(r.doc_id, r.score) for r in found}


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    count = rng.integers(0, 30, (40, 6)) * (rng.random((40, 6)) < 0.6)
    word, context = np.divmod(np.arange(240), 6)
    part = pitman_yor._Slice(0, np.arange(40, dtype=np.uint64), word, 40, context, count.ravel(), count.ravel(), np.zeros(0), np.zeros(0))
    customers, tables = np.zeros((2, pitman_yor.RESTAURANTS), np.int64)
    customers[:6], nothing = count.sum(axis=0), np.zeros(0, np.int64)
    known = np.count_nonzero(count.sum(axis=1))
    totals = pitman_yor.Totals(int(count.sum()), known, customers, tables, float(known), 0.5, 0.5, np.zeros(0, np.uint64), nothing, nothing, nothing)
    seats, own, roots = pitman_yor._seated(part, totals, 0)
    totals = totals._replace(tables=np.bincount(context, seats, pitman_yor.RESTAURANTS).astype(np.int64), root_tables=float(roots.sum()))
    root = pitman_yor._root(own, roots, totals)
    unknown = (1 + 0.5 * roots.sum()) / (known + 1) / (1 + seats.sum())
    assert root[own > 0].sum() + unknown == pytest.approx(1)
    assert (seats[count.ravel() > 0] >= 1).all() and (seats <= count.ravel()).all()


def test_every_context_of_a_draw_adds_up_to_one(spark):
    """All words of all slices, the frequent ones that lie in several included, and one more for all unknown words."""
    rows = [(i, f"the cat number{i % 7} sat on the mat{i % 3} and the dog ran " * (1 + i % 4)) for i in range(120)]
    docs = spark.createDataFrame(rows, "number long, text string").withColumn("held_out", F.lit(False))
    dealt, draws = pitman_yor._trained(docs)
    parts = list(pitman_yor._slices(dealt.toArrow().to_batches()))
    assert len(draws) == pitman_yor.SAMPLES and draws[1][1] is draws[0][2]
    for number, before, after in draws:
        known, mass = {}, np.zeros(pitman_yor.RESTAURANTS)
        for part in parts:
            tables, customers, roots = pitman_yor._seated(part, before, number)
            at, frequent = pitman_yor._spread(part, after.frequent)
            customers[at], roots[at] = after.frequent_customers[frequent], after.frequent_tables[frequent]
            known |= dict(zip(part.names.tolist(), pitman_yor._root(customers, roots, after).tolist()))
            parent = pitman_yor._root(customers, roots, after)[part.word]
            own = pitman_yor._predicted(part, (number, before, after))
            share = (pitman_yor.STRENGTH + after.discount * after.tables) / (pitman_yor.STRENGTH + after.customers)
            mass += np.bincount(part.context, own - share[part.context] * parent, pitman_yor.RESTAURANTS)
        unknown = pitman_yor._root(np.zeros(1), np.zeros(1), after)[0]
        assert sum(known.values()) + unknown == pytest.approx(1, abs=1e-9)
        assert np.allclose(mass + share, 1, atol=1e-9)
        assert len(known) == after.words


def test_every_word_before_is_a_context(spark):
    """Of one class, so in one restaurant above; each has its own totals, from all slices, and adds up to 1 in every draw."""
    rows = [(i, f"aaaring foo{i % 9} x aaaring foo{i % 9} bbbring bar{i % 9} y{i % 5} bbbring bar{i % 9} the foo1 the bar2 ") for i in range(90)]
    docs = spark.createDataFrame(rows, "number long, text string").withColumn("held_out", F.lit(False))
    dealt, draws = pitman_yor._trained(docs)
    parts = list(pitman_yor._slices(dealt.toArrow().to_batches()))
    contexts = [None, *(w for r in rows for w in r[1].split())]
    followed = Counter(w for r in rows for w in [None, *r[1].split()])
    for draw in draws:
        after, mass, seated, totals = draw[2], Counter(), Counter(), {}
        for part in parts:
            below, seats = part.below, pitman_yor._seats(part, draw[1], draw[0])
            above = pitman_yor._predicted(part, draw)[below.pair]
            own = pitman_yor._after_word(part, draw)
            for i, at in enumerate(below.place):
                key = int(below.contexts[at])
                totals.setdefault(key, set()).add((int(below.customers[at]), int(below.tables[draw[0] + 1][at])))
                customers, tables = below.customers[at], below.tables[draw[0] + 1][at]
                mass[key] += own[i] - (1 + after.word_discount * tables) / (1 + customers) * above[i]
                seated[key] += int(seats.own[i])
        assert all(len(x) == 1 for x in totals.values()) and len(totals) == len(set(contexts))
        found = {key: next(iter(x)) for key, x in totals.items()}
        assert sorted(c for c, _ in found.values()) == sorted(followed.values())
        assert {key: t for key, (_, t) in found.items()} == seated
        assert all(mass[k] + (1 + after.word_discount * t) / (1 + c) == pytest.approx(1, abs=1e-9) for k, (c, t) in found.items())


def test_words_of_one_ending_are_told_apart(spark):
    held = [i for i in range(900, 1000) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(i, f"aaaring foo{i % 3} bbbring bar{i % 3}") for i in range(300)] + [(held[0], "aaaring foo1"), (held[1], "bbbring foo1")]
    found = {r.doc_id: r.score for r in pitman_yor.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[held[0]] > found[held[1]] + 1


def test_slices_are_gathered_in_little_memory():
    """Bytes for each token at the peak; 54 before, when chunks' tokens were kept spelled out and all orders at once."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 4000) % 50_000) for _ in range(100)]
    rows = pa.record_batch([pa.array(range(100), pa.int64()), pa.array([i % 5 != 1 for i in range(100)]), pa.array(texts)], ["number", "trains", "text"])
    dealt = pa.Table.from_batches(pitman_yor._deal(1, np.zeros(0, np.uint64))(iter([rows]))).combine_chunks().to_batches()
    del texts, rows
    tracemalloc.start()
    try:
        found = list(pitman_yor._gather(iter(dealt)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found[0].column("tokens").to_pylist() == [400_100]
    assert peak < 43 * 400_100


def test_a_slice_is_alone_in_its_task(spark, monkeypatch):
    """Two slices in a task would be in one Arrow batch, in the JVM and the worker at once."""
    monkeypatch.setattr(pitman_yor, "LEAST_SLICES", 16)
    rows = [(i, i % 5 == 1, " ".join(f"w{k}" for k in range(i, i + 60))) for i in range(40)]
    dealt, _ = pitman_yor._trained(spark.createDataFrame(rows, "number long, held_out boolean, text string"))
    held = dealt.where("model is not null").groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("slices")).collect()
    assert [r.slices for r in held] == [1] * 16


def test_model_beats_unigrams(spark):
    held = pitman_yor.score(spark.read.parquet(f"{SF_DIR}/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def all_segments(scores):
    """Maximal segments by their definition: the best one, least in length, then the same left and right of it."""
    best = None
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        total = sum(scores[a:b])
        if total > 1e-12 and (best is None or total > best[2] + 1e-9 or abs(total - best[2]) < 1e-9 and b - a < best[1] - best[0]):
            best = (a, b, total)
    if not best:
        return []
    return [*all_segments(scores[: best[0]]), best[:2], *((best[1] + a, best[1] + b) for a, b in all_segments(scores[best[1] :]))]


def test_segments_are_maximal():
    rng = random.Random(2)
    for _ in range(200):
        drift = -rng.random()
        scores = [rng.uniform(0.5, 3) if rng.random() < 0.4 else drift for _ in range(rng.randrange(1, 13))]
        at = np.array([i for i, s in enumerate(scores) if s > 0], int)
        found = toxicity.segments(at, np.array([scores[i] for i in at]), drift)
        assert sorted((a, b) for a, b, _ in found) == all_segments(scores)


def test_toxicity(spark, docs, labels, none):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("red green blue sky tree rain bird".split()) for _ in range(60)) for _ in range(400)]
    texts = [x.replace("rain bird", "vile scum") if i % 4 == 0 else x for i, x in enumerate(texts)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int("vile" in x)) for i, x in enumerate(texts)], "doc_id long, toxic int")
    model = toxicity.fit(table, marks)
    for r in toxicity.score(table, model).where("held_out").collect():
        assert r.predicted == int("vile" in texts[r.doc_id]) and 0 <= r.score <= 1
        assert bool(r.passages) == bool(r.predicted)
    assert toxicity.score(docs, model).count() == len(made_docs())
    assert toxicity.score(docs, toxicity.fit(docs, labels)).where("score is null").count() == 0
    assert toxicity.fit(none, labels) is None


def test_packing(docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(queries.word_tokenizer())
    pieces = packing.pack(docs, queries.word_tokenizer(), sequence=64).collect()
    wanted = Counter((r[0], tuple([*model.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in made_docs())
    by_sequence: dict[int, list] = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    stream = [r for s in sorted(by_sequence) for r in sorted(by_sequence[s], key=lambda r: r.offset)]
    found, ids = Counter(), []
    for r in stream:
        assert r.start == len(ids)
        ids += np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(r.ids) // 4 > 0
        if len(ids) == r.doc_tokens:
            found[r.doc_id, tuple(ids)] += 1
            ids = []
    assert found == wanted and sorted(by_sequence) == list(range(len(by_sequence)))
    for rows in by_sequence.values():
        lengths = [r.length for r in sorted(rows, key=lambda r: r.offset)]
        assert [r.offset for r in sorted(rows, key=lambda r: r.offset)] == [sum(lengths[:i]) for i in range(len(lengths))]
        assert sum(lengths) == 64 or sum(lengths).bit_count() == 1


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(900, 8)).astype("float32")
    vectors[100:400] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(2000, None), (2050, [0.0] * 8), (2100, [1.0] * 7 + [None]), (2150, [float("nan")] * 8), (2200, [1.0, 2.0]), (None, [1.0] * 8)]
    found = vector_search.nearest(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>"), F.col("id") % 50 == 0).collect()
    exact, hits = vectors.astype(float), 0
    for i in range(0, 900, 50):
        scores = vector_search.cosines(exact[i], exact)
        order = [j for j in np.lexsort((np.arange(900), -scores)).tolist() if j != i][:5]
        own = sorted((r for r in found if r.query_id == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert all(r.score == pytest.approx(scores[r.vec_id]) for r in own)
        hits += len({r.vec_id for r in own} & set(order))
    assert len(found) == 90 and hits >= 81
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"]) for r in vector_search.nearest(few, F.col("id") == 0).collect()] == [(0, 1), (0, 2)]
    assert vector_search.nearest(few.limit(0), F.col("id") == 0).count() == 0


def test_nearest_with_tiny_leaves(spark):
    rng = np.random.default_rng(11)
    alone = rng.normal(size=(24, 16)) * 5
    hot = rng.normal(size=(4, 16))[rng.integers(0, 4, 1976)] + 0.01 * rng.normal(size=(1976, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([alone, hot]))]
    rows += [(0, (alone[0] + 0.1 * x).tolist()) for x in rng.normal(size=(6, 16))]  # an id with several vectors
    found = vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), (F.col("id") < 24) | (F.col("id") % 5 == 0), recall=0.3).collect()
    counts = Counter(r.query_id for r in found)
    assert set(counts) == {*range(24), *range(25, 2000, 5)} and set(counts.values()) == {5}
    assert all(r.query_id != r.vec_id for r in found)


def test_visits_go_on_until_leaves_hold_enough():
    tree = vector_search.build_tree(np.random.default_rng(5).normal(size=(2000, 8)))
    query, held = np.eye(8)[0], np.zeros(tree.leaves, int)
    order = vector_search.visits(tree, query, tree.leaves)
    held[order[9]], held[order[20]] = 4, 2
    assert vector_search.visits(tree, query, 2, held, 4) == order[:10]
    assert vector_search.visits(tree, query, 2, held, 6) == order[:21]
    assert vector_search.visits(tree, query, 2, held, 7) == order
    assert vector_search.visits(tree, query, 12, held, 4) == order[:12]


def segmentations(vocabulary, word):
    if not word:
        yield 0.0
    for end in range(1, len(word) + 1):
        if word[:end] in vocabulary.pieces:
            yield from (vocabulary.pieces[word[:end]][1] + s for s in segmentations(vocabulary, word[end:]))
    if word and word[0] not in vocabulary.pieces:
        yield from (vocabulary.unknown + s for s in segmentations(vocabulary, word[1:]))


def test_nbest(spark, docs):
    import public_tokenizers

    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    vocabulary, rng = nbest.read_vocabulary(model), random.Random(3)
    for _ in range(60):
        x = "".join(rng.choice("then aiors é一\U0001f600") for _ in range(rng.randrange(1, 9)))
        wanted = sorted(segmentations(vocabulary, nbest.MARK + x.replace(" ", nbest.MARK)), reverse=True)[:3]
        found = nbest.text_nbest([nbest.word_nbest(vocabulary, w, 3) for w in nbest.words_of(x)], 3)
        assert [s for s, _ in found] == pytest.approx(wanted)
    read = nbest.decoded(nbest.encode(docs, model), model).collect()
    for r in read:
        assert set(r.decoded) == {r.text or ""}
    assert Counter(map(repr, nbest.round_trip(docs, model).collect())) == Counter(map(repr, read))
    assert {len(r.ids) for r in nbest.encode(docs, model, 1).collect()} == {1}


def test_nbest_words_outlive_a_change_of_memory():
    import public_tokenizers

    vocabulary = nbest.read_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model")))
    words, texts = nbest._Words(vocabulary, 3), ["some words twice words", "", "a", "words of  another kind \U0001f600"]
    first = [nbest._ways(words, x, 3) for x in texts]
    again = words.renewed()
    assert [nbest._ways(again, x, 3) for x in texts] == first
    for x, (scores, ids) in zip(texts, first, strict=True):
        found = nbest.text_nbest([nbest.word_nbest(vocabulary, w, 3) for w in nbest.words_of(x)], 3) if x else [(0.0, {})]
        assert scores == pytest.approx([s for s, _ in found]) and len(set(ids)) == len(ids)


def test_nbest_of_many_words_together():
    """The same as word by word: ways, their order and scores, with ties, unknown characters and words of any length."""
    import public_tokenizers

    vocabulary, rng = nbest.read_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model"))), random.Random(4)
    trie = nbest._trie(vocabulary)
    words = ["".join(rng.choice("then aiors é一\x00\U0001f600" + nbest.MARK) for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    for n in (1, 2, 3, 5):
        scores, ids, sizes = nbest.words_nbest(vocabulary, trie, words, n)
        parts = np.split(ids, np.cumsum(sizes.ravel())[:-1])
        for i, word in enumerate(words):
            found = [(scores[i, k], tuple(parts[i * n + k].tolist())) for k in range(n) if scores[i, k] > -np.inf]
            assert found == nbest.word_nbest(vocabulary, word, n)


def test_no_word_is_searched_alone(monkeypatch):
    """But for long ones: a search for each new word by itself took 2.5 times the budget of CPU seconds."""
    import public_tokenizers

    model, alone = str(public_tokenizers.path("piece_bpe_32k.model")), []
    search = nbest.word_nbest
    monkeypatch.setattr(nbest, "_words", {})
    monkeypatch.setattr(nbest, "CACHED_WORDS", 50)
    monkeypatch.setattr(nbest, "READ", 200)
    monkeypatch.setattr(nbest, "word_nbest", lambda vocabulary, word, n: alone.append(word) or search(vocabulary, word, n))
    texts = [f"word{i % 40} some other{i} words " + "long" * (20 * (i == 7)) for i in range(100)] + [None, ""]
    rows = pa.record_batch({"id": range(len(texts)), "text": pa.array(texts, pa.string())})
    found = [r for b in nbest._decode(model)(nbest._encode(model, 3)(iter([rows]))) for r in b.to_pylist()]
    assert [set(r["decoded"]) for r in found] == [{x or ""} for x in texts]
    assert [len(r["ids"]) for r in found[:100]] == [3] * 100 and alone == [nbest.MARK + "long" * 20]


def test_one_odd_way_leaves_the_others_to_the_fast_path(monkeypatch):
    import public_tokenizers

    vocabulary, table = nbest._table(str(public_tokenizers.path("piece_bpe_32k.model")))
    odd, plain = [vocabulary.pieces["▁a"][0], vocabulary.bytes_[0xE4]], [vocabulary.pieces["▁the"][0], vocabulary.pieces["▁a"][0]]
    seen, decode = [], nbest.decode
    monkeypatch.setattr(nbest, "decode", lambda v, ids: seen.append(ids) or decode(v, ids))
    ways = pa.array([plain, odd, [], plain], pa.list_(pa.int32()))
    assert nbest._texts(vocabulary, table, ways).to_pylist() == ["the a", "a\ufffd", "", "the a"] and seen == [odd]
    assert nbest._texts(vocabulary, table, ways[2:]).to_pylist() == ["", "the a"] and seen == [odd]


def test_decoded_bytes_that_are_no_text(spark):
    import public_tokenizers

    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    vocabulary = nbest.read_vocabulary(model)
    odd = [vocabulary.pieces["▁a"][0], vocabulary.bytes_[0xE4]]
    rows = spark.createDataFrame([(1, "x", [0.0], [odd, odd[:1]]), (2, None, [0.0], [[]])], "id long, text string, scores array<double>, ids array<array<int>>")
    assert [r.decoded for r in nbest.decoded(rows, model).orderBy("id").collect()] == [["a\ufffd", "a"], [""]]


def test_shards(docs):
    rows = sharding.byte_shards(docs, shards=3).collect()
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(sizes.values()) == sum(len((r[1] or "").encode()) + 1 for r in made_docs())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)


def test_empty_tables(spark, none, labels):
    assert ngram_join.jaccard_components(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert quality_rules.verdicts(none, labels).count() == 0
    assert pitman_yor.score(none).count() == 0
    assert packing.pack(none, queries.word_tokenizer()).count() == 0
    assert sharding.byte_shards(none).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_chats(chat_format.format_chats(turns)).count() == 0


def test_sha_of_kept_text(spark):
    found = queries.op4_substring_dedup(spark, SF_DIR).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    wanted = {(i, n, k, hashlib.sha256(x.encode()).hexdigest()) for i, n, k, x in brute_removed(rows, 13)}
    assert {(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in found} == wanted


def test_pipeline(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, documents, SF_DIR))
        rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
        seen.append(name)
        if name == "n-gram Jaccard join":
            wanted = {str(i) for i, _, least, _ in brute_components(rows, 5, 80) if i == str(least)}
            assert {str(r.doc_id) for r in out.collect()} == wanted
        if name == "substring dedup":
            texts = {str(r.doc_id): words(r.text) for r in out.collect()}
            assert texts == {i: words(x) for i, _, _, x in brute_removed(rows, 13)}
        if name != "packing":
            assert out.columns == documents.columns and 0 < out.count() <= len(rows)
        documents = out
    assert len(seen) == 5


def test_pipeline_decides_by_row(spark, tmp_path):
    """Repeated rows, repeated ids with other texts, and null ids in every stage."""
    import corpus_pipeline

    stages, rng = dict(corpus_pipeline.STAGES), random.Random(9)

    def prose(n):
        return " ".join(rng.choice("red green blue sky tree rain bird".split()) + str(rng.randrange(99)) for _ in range(n))

    def out(stage, rows):
        table = spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
        found = stages[stage](spark, table.repartition(3), str(tmp_path))
        assert stage == "packing" or found.columns == table.columns
        return found

    def kept(stage, rows):
        return Counter((r.doc_id, r.text) for r in out(stage, rows).collect())

    texts = [prose(60) + (" vile scum" if i % 4 == 0 else "") for i in range(400)]
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    known = list(enumerate(texts))
    clean, other, toxic = prose(60), prose(60), prose(60) + " vile scum"
    odd = [(None, clean), (None, clean), (None, toxic), (900, other), (900, toxic), (901, clean), (901, clean)]
    assert kept("toxicity", known + odd) == Counter([r for r in known + odd if "vile" not in r[1]])

    short = [(None, "too short"), (None, clean), (900, "short"), (900, other), (900, other)]
    assert kept("quality rules", known + short) == Counter([r for r in known + short if len(r[1]) > 20])

    near = clean + " end"
    rows = [(5, clean), (5, clean), (7, near), (None, clean), (8, other), (8, toxic), (8, other), (None, texts[1]), (None, texts[1]), (None, texts[2]), (None, ""), (9, None)]
    wanted = [(5, clean), (8, other), (8, toxic), (None, texts[1]), (None, texts[2]), (None, ""), (9, None)]
    assert kept("n-gram Jaccard join", rows) == Counter(wanted)

    passage = prose(20)
    same, none = [(5, f"a {passage} one"), (5, f"b {passage} two"), (6, f"c {passage}"), (5, f"a {passage} one")], [(None, f"d {passage}"), (None, f"e {passage}")]
    found = kept("substring dedup", same + none)
    assert sum(n for (_, x), n in found.items() if passage in x) == 1 and found.total() == 6
    assert found[6, "c"] == found[None, "d"] == found[None, "e"] == 1
    assert sum(n for (i, x), n in found.items() if i == 5 and passage in x) == 1
    assert sum(passage in x for _, x in kept("substring dedup", none)) == 1

    pieces = out("packing", [(5, clean), (5, clean), (None, other)]).where("start = 0")
    assert Counter(r.doc_id for r in pieces.collect()) == {5: 2, None: 1}


def test_packing_takes_added_tokens_as_the_tokenizer_does():
    """At the edges of words and inside, and not in another case."""
    path, rng = queries.word_tokenizer(), random.Random(2)
    from tokenizers import Tokenizer

    model, encode = Tokenizer.from_file(path), packing._Encoder(path)
    parts = ["a", "Word", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "É", "é", " ", "  ", "\n", "!", "...", "'s", "1", "23", "漢", "<|", "|>", "don't"]
    texts = ["a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|>", "<|endoftext|>.", *["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(3000)]]
    for x in texts:
        assert np.frombuffer(encode([x.encode().split()])[0], np.uint32).tolist() == model.encode(x, add_special_tokens=False).ids, x


def test_packing_refuses_other_tokenizers_and_forgets_words():
    import public_tokenizers

    with pytest.raises(ValueError):
        packing._Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    encode = packing._Encoder(queries.word_tokenizer(), memory=100_000)
    whole = [encode([[b"word%d" % i, b"again."]])[0] for i in range(2000)]
    assert len(encode.young) + len(encode.old) < 1000
    assert whole == [encode([[b"word%d" % i, b"again."]])[0] for i in range(2000)]


def test_segments_of_a_very_long_text_take_one_pass():
    """Hits far apart fall step by step; each is a segment of its own, and none is compared with all before it."""
    import time

    n = 100_000
    at, scores = np.arange(n) * 50, np.full(n, 1.6)
    began = time.process_time()
    found = toxicity.segments(at, scores, -0.05)
    assert len(found) == n and time.process_time() - began < 3
    assert toxicity.segments(at, scores, -0.03)[0][2] > 1.6


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op4_substring_dedup", "op10_sharding", "chat_mixed_layouts"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    assert oracle_check.difference(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None


def test_json_rows_that_cannot_be_read_are_given_back(spark):
    """Every row is read or given back; all elements of a list tell its layout, and unknown keys do not matter."""
    lines = {
        1: '{"messages": [{"role": "user"}, {"role": "assistant", "content": "b", "weight": 1}], "source": "x"}',
        2: '{"messages": []}',
        3: '{"prompt": "p", "completion": "c", "response": "r"}',
        4: '{"dialogue": [{"who": "a"}]}',
        5: "no json",
        6: None,
        7: '{"prompt": "p", "completion": null, "unknown": {"prompt": 1}}',
        8: '{"messages": "text"}',
        9: '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "gpt"}]}',
        10: '{"messages": [null, {"content": "c", "role": "system"}]}',
    }
    read, rest = chat_format.canonical_json(spark.createDataFrame(list(lines.items()), "conv_id long, j string"), "j")
    got = {}
    for r in read.orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got[1] == [("user", ""), ("assistant", "b")]
    assert got[7] == [("user", "p"), ("assistant", "")]
    assert got[9] == [("user", "h"), ("assistant", "g"), ("assistant", "")]
    assert got[10][-1] == ("system", "c")
    left = {r.conv_id for r in rest.collect()}
    assert left == {2, 3, 4, 5, 6, 8} and left | set(got) == set(lines)
