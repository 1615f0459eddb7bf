"""Language-model scores by a hierarchical Pitman-Yor model.

A word's context is the whole word before it; each has a restaurant of its own. Its parent is the restaurant of the class of
that word, its ending hashed into a fixed number of classes, and theirs is the root, which holds the words; the root's own
parent is uniform over the known words and one more for all unknown.

1. Tokens go to slices by their hash (a very frequent word by the class of its context as well, so that none fills a slice),
   packed by chunk of texts, and each slice is written once: its words, their counts by context, and the documents of each.
2. Blocked Gibbs sweeps: all customers of a (context, word) leave and are seated anew, at an old table or a new one, given the
   tables of all other restaurants as of the last sweep. A new table is a customer of the parent. Seats are drawn slice by
   slice, from a generator seeded by slice and sweep; the sweep's table counts by restaurant are the next one's totals.
   Totals of classes are a small table. Those of contexts are as many as there are words, so no task holds them all: each
   slice sends its counts to buckets of contexts, which add them up and send the totals back to the slices that asked.
3. The predictive probabilities of several further draws of the chain are averaged. Those of a draw use its own seats, drawn
   again from the same seeds, and its own totals, so that each context's probabilities add up to 1. Each slice sums the
   logarithms up by document, and the sums of the slices meet in one aggregate.

Defined cases. Null or empty text: the end token alone. Null id: a training document. Documents that repeat id and text score
alike. Without training documents nothing is known and all tokens share the unknown word's probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.memory import tidy
from waitlens.llm.text import Chunk, chunks, mix, signed
from waitlens.llm.work import stored as _stored

RESTAURANTS = 4096
SLICE_TOKENS = 2_000_000
LEAST_SLICES = 32
FREQUENT = 512  # words with more than a share of one in so many are spread over slices
SWEEPS = 2
SAMPLES = 3
STRENGTH = 1.0
SEED = 1
_CHUNK = 4 << 20
_HASH_BITS = 52  # of a context; the others are its class
_START, _END = 0, mix(np.array([0xE5D]))[0]
_U = np.uint64


def stored(frame: DataFrame) -> DataFrame:
    return _stored(frame, codec="zstd")  # for planes of small numbers


class Totals(NamedTuple):
    """Of the whole model, but for the restaurants of whole words. customers, tables: by class."""

    tokens: int
    words: int
    customers: np.ndarray  # of the classes: tables of their contexts
    tables: np.ndarray
    root_tables: float
    discount: float
    root_discount: float
    frequent: np.ndarray  # words that are in several slices, ascending; then their training tokens and, at the root,
    frequent_count: np.ndarray
    frequent_customers: np.ndarray
    frequent_tables: np.ndarray
    word_discount: float = 0.5  # of the restaurants of whole words


def held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 1, F.lit(False))


def _tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context and row of each token, the end tokens included. A context is the class of the word before, in the upper bits,
    and its hash."""
    rows = chunk.stop - chunk.start
    at = np.arange(len(chunk.starts)) + chunk.row
    ends = chunk.first[1:] + np.arange(rows)
    tokens = np.full(len(at) + rows, _END, _U)
    tokens[at] = chunk.hashes()
    length = chunk.ends - chunk.starts
    ending = np.minimum(length, 5).astype(_U) << _U(40)
    for back in range(1, 5):
        own = chunk.data[np.maximum(chunk.ends - back, chunk.starts)].astype(_U) << _U(8 * back)
        ending |= np.where((back <= length) & ((back < 4) | (length == 4)), own, _U(0))
    contexts = np.full(len(tokens) + 1, _START, _U)
    contexts[at + 1] = (mix(ending, 21) % _U(RESTAURANTS - 1) + _U(1)) << _U(_HASH_BITS) | tokens[at] >> _U(64 - _HASH_BITS)
    contexts[ends + 1] = _START
    return tokens, contexts[:-1], np.repeat(np.arange(rows), chunk.counts + 1)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words that are frequent in a chunk, and of all its tokens (token 0)."""
    for batch in batches:
        for chunk in chunks(batch.column(0), lower=True, limit=_CHUNK):
            tokens, _, _ = _tokens(chunk)
            coarse = np.bincount((tokens >> _U(52)).astype(np.int64), minlength=4096) * 2 * FREQUENT > len(tokens)
            found, counts = np.unique(tokens[coarse[(tokens >> _U(52)).astype(np.int64)]], return_counts=True)
            some = counts * 2 * FREQUENT > len(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(0, signed(found[some]))), pa.array(np.append(len(tokens), counts[some]))], ["token", "n"])


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Places at which one of the columns changes."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return np.flatnonzero(new)


def _planes(x: np.ndarray, width: int) -> bytes:
    """The lower bytes of each number, plane by plane: high planes are mostly zero and compress."""
    own = x.astype("<u4" if width <= 4 else "<u8", copy=False)
    return np.ascontiguousarray(own.view(np.uint8).reshape(-1, own.itemsize)[:, :width].T).tobytes()


def _unplaned(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def _deal(slices: int, frequent: np.ndarray):
    """Packs each chunk's tokens by slice: the words, of each how many tokens, and of each token the context and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, training = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(2), lower=True, limit=_CHUNK):
                tokens, contexts, rows = _tokens(chunk)
                key = np.where(np.isin(tokens, frequent), mix(tokens ^ mix(contexts >> _U(_HASH_BITS), 22), 23), mix(tokens, 23))
                to = ((key >> _U(32)) * _U(slices) >> _U(32)).astype(np.int64)
                order = np.lexsort((rows, contexts, tokens, to))
                edges = np.searchsorted(to[order], np.arange(slices + 1))
                own, trains = numbers[chunk.start : chunk.stop], training[chunk.start : chunk.stop]
                for i in range(slices):
                    part = order[edges[i] : edges[i + 1]]
                    if len(part):
                        pairs = _firsts(tokens[part], contexts[part])
                        words, counts = np.unique(tokens[part[pairs]], return_counts=True)
                        docs, where = np.unique(rows[part], return_inverse=True)
                        blob = [words.tobytes(), _planes(counts, 4), contexts[part[pairs]].tobytes()]
                        blob += [_planes(np.diff(np.append(pairs, len(part))), 4), _planes(where, 4)]
                        blob += [own[docs].tobytes(), trains[docs].astype(np.uint8).tobytes()]
                        sizes = [len(words), len(pairs), len(part), len(docs)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([i]), *(pa.array([x]) for x in sizes), pa.array([b"".join(blob)], pa.binary())],
                            ["slice", "words", "pairs", "tokens", "docs", "blob"],
                        )

    return run


class _Dealt(NamedTuple):
    """What a chunk of texts has for a slice: words, of each how many pairs, of those the context and how many tokens, of each
    token the place of its document; the documents, and whether they are trained on."""

    words: np.ndarray
    per_word: np.ndarray
    contexts: np.ndarray
    per_pair: np.ndarray
    where: np.ndarray
    docs: np.ndarray
    trains: np.ndarray


def _undealt(words: int, pairs: int, tokens: int, docs: int, blob: pa.BinaryScalar) -> _Dealt:
    part = _cut(memoryview(blob.as_buffer()), 8 * words, 4 * words, 8 * pairs, 4 * pairs, 4 * tokens, 8 * docs, docs)
    per_word, per_pair, where = (_narrow(_unplaned(part[k], n, 4)) for k, n in ((1, words), (3, pairs), (4, tokens)))
    # copies, so that the bytes of a batch go with it
    return _Dealt(np.frombuffer(part[0], _U).copy(), per_word, np.frombuffer(part[2], _U).copy(), per_pair, where,
                  np.frombuffer(part[5], np.int64).copy(), np.frombuffer(part[6], bool).copy())


_SLICE = {"slice": pa.int64(), "words": pa.int64(), "pairs": pa.int64(), "model": pa.binary(), "tokens": pa.int64(), "docs": pa.int64(), "places": pa.binary()}
_MODEL = list(_SLICE)[:4]  # what counts and sweeps read; the places of tokens, most of a slice, are read by the scores alone


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each slice, whose rows follow one another, one row: words, pairs of word and context, tokens by pair, documents."""
    held: list[_Dealt] = []
    last = None

    def joined(column: str) -> np.ndarray:
        return np.concatenate([getattr(x, column) for x in held])

    def row() -> pa.RecordBatch:
        docs, place = np.unique(joined("docs"), return_inverse=True)
        of_doc = np.zeros(len(docs), bool)
        of_doc[place] = joined("trains")
        place, firsts = place.astype(np.int32), np.cumsum([0, *(len(x.docs) for x in held)])
        where = np.concatenate([place[x.where + np.int32(first)] for x, first in zip(held, firsts, strict=False)])
        per_pair = joined("per_pair")
        names = np.repeat(np.repeat(joined("words"), joined("per_word")), per_pair)
        contexts = np.repeat(joined("contexts"), per_pair)
        held.clear()
        del place, per_pair
        order = np.lexsort((where, contexts, names)).astype(np.int32)
        where = where[order]  # one after the other, so that no two of them are there twice
        contexts = contexts[order]
        names = names[order]
        del order
        pairs = _firsts(names, contexts)
        contexts = contexts[pairs]
        words, per_word = np.unique(names[pairs], return_counts=True)
        tokens = np.diff(np.append(pairs, len(names)))
        del names
        trained = np.add.reduceat(of_doc[where], pairs, dtype=np.int64)
        model = [words.tobytes(), _planes(per_word, 4), contexts.tobytes(), _planes(tokens, 5), _planes(trained, 5)]
        sizes = len(words), len(pairs)
        del contexts, tokens, trained, pairs
        places = [_planes(where, 4), docs.tobytes()]
        values = [last, *sizes, b"".join(model), len(where), len(docs), b"".join(places)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _SLICE.values(), strict=True)], list(_SLICE))

    for batch in batches:
        for i, slice_ in enumerate(batch.column(0).to_pylist()):
            if held and slice_ != last:
                yield row()
            last = slice_
            held.append(_undealt(*(batch.column(c)[i].as_py() for c in range(1, 5)), batch.column(5)[i]))
    if held:
        yield row()


class _Below(NamedTuple):
    """The pairs of word and whole word before, each below one of word and class."""

    pair: np.ndarray  # of each, the pair above it
    place: np.ndarray  # of its context among `contexts`
    tokens: np.ndarray
    count: np.ndarray
    contexts: np.ndarray  # of the slice, by bucket
    edges: np.ndarray  # of the buckets in them
    customers: np.ndarray  # of the contexts, in all slices
    tables: dict[int, np.ndarray]  # by sweep, those that it saw


class _Slice(NamedTuple):
    number: int
    names: np.ndarray  # of the words
    word: np.ndarray  # of each pair of word and class, the number of its word
    n_words: int
    context: np.ndarray  # the class
    tokens: np.ndarray  # of each pair, in all documents
    count: np.ndarray  # of each pair, in training documents
    where: np.ndarray | None  # of each token, ordered by pair, the place in `docs`; both only where they are read
    docs: np.ndarray | None
    below: _Below | None = None


def _cut(data: memoryview, *sizes: int) -> list[memoryview]:
    ends = np.cumsum([0, *sizes])
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the least room."""
    return x.astype(np.int32 if not len(x) or x.max() < 1 << 31 else np.int64)


def _totals_of(replies: list[dict], n: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Of the slice's contexts, by bucket, the customers, and by sweep the tables, which come for more than one customer alone."""
    blobs: dict[int, list[np.ndarray]] = {}
    for reply in replies:  # ordered by sweep and bucket
        blobs.setdefault(reply["sweep"], []).append(_unplaned(reply["totals"], len(reply["totals"]) // 5, 5).astype(np.int64))
    counts = [x.reshape(2, -1) for x in blobs.pop(0, [])]
    customers, distinct = np.concatenate(counts, axis=1) if counts else np.zeros((2, n), np.int64)
    tables = {0: distinct}
    for sweep, values in blobs.items():
        tables[sweep] = np.minimum(customers, 1)
        tables[sweep][customers > 1] = np.concatenate(values)
    return customers, tables


def _slices(batches: Iterator[pa.RecordBatch], slices: int = 1) -> Iterator[_Slice]:
    """One slice at a time, without a copy of the others' bytes. Rows of totals come before the slice that they are for."""
    replies: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            if "totals" in batch.schema.names and batch.column("totals")[i].is_valid:
                replies.append({name: batch.column(name)[i].as_py() for name in ("sweep", "totals")})
                continue
            word = keys = counts = part = per_word = where = docs = below = None  # the last slice goes before the next is unpacked
            own = {name: batch.column(name)[i] for name in batch.schema.names}
            number, words, pairs = (own[c].as_py() for c in ("slice", "words", "pairs"))
            slices = own["slices"].as_py() if "slices" in own else slices
            part = _cut(memoryview(own["model"].as_buffer()), 8 * words, 4 * words, 8 * pairs, 5 * pairs, 5 * pairs)
            per_word, tokens, count = (_unplaned(part[k], n, w) for k, n, w in ((1, words, 4), (3, pairs, 5), (4, pairs, 5)))
            tokens, count, keys = _narrow(tokens), _narrow(count), np.frombuffer(part[2], _U)
            word = np.repeat(np.arange(words, dtype=np.int32), per_word.astype(np.int64))
            context = (keys >> _U(_HASH_BITS)).astype(np.int16)
            first = _firsts(word, context)
            contexts, place = np.unique(keys, return_inverse=True)
            bucket = _bucket(contexts, slices)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            totals = _totals_of(replies, len(contexts)) if "totals" in own else (np.zeros(len(contexts), np.int64), {})
            replies.clear()
            pair = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, pairs)))
            below = _Below(pair, rank[place], tokens, count, contexts[order], np.searchsorted(bucket[order], np.arange(slices + 1)), *totals)
            if "places" in own:
                n_tokens, n_docs = own["tokens"].as_py(), own["docs"].as_py()
                places = _cut(memoryview(own["places"].as_buffer()), 4 * n_tokens, 8 * n_docs)
                where, docs = _unplaned(places[0], n_tokens, 4).astype(np.int32), np.frombuffer(places[1], np.int64)
            sums = [np.add.reduceat(x, first, dtype=np.int64) for x in (tokens, count)]
            del place, bucket, order, rank, pair, totals
            yield _Slice(number, np.frombuffer(part[0], _U), word[first], words, context[first], *sums, where, docs, below)


def _bucket(contexts: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(contexts, 24) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _asked(part: _Slice, some: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """Rows for the buckets of contexts: the slice's contexts that are `some` and its own values of them."""
    rows = []
    for bucket, (low, high) in enumerate(zip(part.below.edges[:-1], part.below.edges[1:], strict=True)):
        own = np.flatnonzero(some[low:high]) + low
        if len(own):
            rows.append((part.number, bucket, part.below.contexts[own].tobytes(), _planes(np.concatenate([x[own] for x in values]), 5)))
    slices, buckets, keys, sent = zip(*rows, strict=True) if rows else ((), (), (), ())
    none = pa.nulls(len(rows), pa.int64())
    columns = [pa.array(slices, pa.int64()), pa.array(buckets, pa.int64()), none, none, none, pa.array(keys, pa.binary()), pa.array(sent, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, _SENT_COLUMNS)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket, whose rows follow one another, the sums by context, for each slice in the order that it sent."""
    held: list[tuple] = []

    def rows() -> pa.RecordBatch:
        keys = [np.frombuffer(k, _U) for _, _, k, _ in held]
        sent = [_unplaned(v, len(v) // 5, 5).astype(np.int64).reshape(-1, len(k)) for k, (_, _, _, v) in zip(keys, held, strict=True)]
        contexts, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = [np.bincount(place, x, len(contexts)).astype(np.int64) for x in np.concatenate(sent, axis=1)]
        edges = np.cumsum([0, *map(len, keys)])
        totals = [_planes(np.concatenate([x[place[a:b]] for x in sums]), 5) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        out = [pa.array([r[0] for r in held]), pa.array([r[1] for r in held]), pa.array(totals, pa.binary())]
        held.clear()
        return pa.RecordBatch.from_arrays(out, ["slice", "bucket", "totals"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if held and row[1] != held[-1][1]:
                yield rows()
            held.append(row)
    if held:
        yield rows()


def seat(customers: np.ndarray, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each restaurant after its customers have come in: the first opens one, each further one a new one in
    proportion to `new_weight`, or sits down in proportion to those seated less `discount` a table. Up to 16 come one by one,
    then in groups of an eighth of those seated."""
    tables = np.minimum(customers, 1)
    at = np.flatnonzero(customers > 1)
    seated = np.ones(len(at), np.int64)
    while len(at):
        come = np.minimum(np.where(seated < 16, 1, seated // 8), customers[at] - seated)
        weight = new_weight[at]
        tables[at] += rng.binomial(come, weight / (weight + np.maximum(seated - discount * tables[at], 1e-9)))
        seated = seated + come
        at, seated = at[seated < customers[at]], seated[seated < customers[at]]
    return tables


def _spread(part: _Slice, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words of the slice are in other slices as well, and their numbers among the frequent words."""
    at = np.flatnonzero(np.isin(part.names, frequent))
    return at, np.searchsorted(frequent, part.names[at])


def _with(own: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    own[at] = values
    return own


class _Seats(NamedTuple):
    own: np.ndarray | None  # tables of each pair of word and whole word before
    in_class: np.ndarray  # of each pair of word and class its customers, and its tables
    tables: np.ndarray
    customers: np.ndarray  # of each word at the root
    roots: np.ndarray


def _seats(part: _Slice, totals: Totals, sweep: int) -> _Seats:
    """The slice's words seated in all restaurants."""
    rng = np.random.Generator(np.random.Philox(key=[SEED + sweep, part.number]))
    at, frequent = _spread(part, totals.frequent)
    own, below, in_class = None, part.below, part.count
    if below is not None:
        in_class = np.bincount(below.pair, np.minimum(below.count, 1), len(part.word)).astype(np.int64)
    tables = np.minimum(in_class, 1)
    customers = _with(np.bincount(part.word, tables, part.n_words).astype(np.int64), at, totals.frequent_customers[frequent])
    roots = _with(np.minimum(customers, 1), at, totals.frequent_tables[frequent])
    for _ in range(2):
        parent = _root(customers, roots, totals)
        if below is not None:
            weight = (STRENGTH + totals.word_discount * below.tables[sweep][below.place]) * _of_class(part, in_class, tables, parent, totals)[below.pair]
            own = seat(below.count, weight, totals.word_discount, rng)
            in_class = np.bincount(below.pair, own, len(part.word)).astype(np.int64)
        tables = seat(in_class, (STRENGTH + totals.discount * totals.tables[part.context]) * parent[part.word], totals.discount, rng)
        customers = _with(np.bincount(part.word, tables, part.n_words).astype(np.int64), at, totals.frequent_customers[frequent])
        roots = _with(_root_seats(customers, totals, rng), at, totals.frequent_tables[frequent])
    return _Seats(own, in_class, tables, customers, roots)


def _seated(part: _Slice, totals: Totals, sweep: int):
    """Of the restaurants of classes and of the root: tables of each pair, and of each word its customers and tables at the root."""
    return tuple(_seats(part, totals, sweep)[2:])


def _of_class(part: _Slice, in_class: np.ndarray, tables: np.ndarray, parent: np.ndarray, totals: Totals) -> np.ndarray:
    """Of each pair of word and class the probability of the word in the class."""
    sits = np.maximum(in_class - totals.discount * tables, 0)
    return (sits + (STRENGTH + totals.discount * totals.tables[part.context]) * parent[part.word]) / (STRENGTH + totals.customers[part.context])


def _root_seats(customers: np.ndarray, totals: Totals, rng: np.random.Generator) -> np.ndarray:
    weight = (STRENGTH + totals.root_discount * totals.root_tables) / (totals.words + 1)
    return seat(customers, np.full(len(customers), weight), totals.root_discount, rng)


def _root(customers: np.ndarray, roots: np.ndarray, totals: Totals) -> np.ndarray:
    rest = STRENGTH + totals.root_discount * totals.root_tables
    return (np.maximum(customers - totals.root_discount * roots, 0) + rest / (totals.words + 1)) / (STRENGTH + totals.tables.sum())


def _by_frequent(part: _Slice, values: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Sums of the pairs' values for each frequent word."""
    at, of = _spread(part, frequent)
    out = np.zeros(len(frequent), np.int64)
    out[of] = np.bincount(part.word, values, part.n_words)[at]
    return out


_SENT = "slice long, bucket long, context long, a long, b long, keys binary, sent binary"
_SENT_COLUMNS = [c.split()[0] for c in _SENT.split(", ")]


def _sums(by_context: np.ndarray, more: np.ndarray, others: list[tuple[int, int]], b: np.ndarray) -> pa.RecordBatch:
    """Rows (context, a, b): by class, after them by frequent word, and under negative numbers the others."""
    a = np.concatenate([by_context, more, [x for x, _ in others]]).astype(np.int64)
    second = np.zeros(len(by_context) + len(more), np.int64)
    second[: len(b)] = b
    second = np.append(second, [y for _, y in others]).astype(np.int64)
    keys = np.append(np.arange(len(by_context) + len(more)), -1 - np.arange(len(others)))
    none, no_bytes = pa.nulls(len(keys), pa.int64()), pa.nulls(len(keys), pa.binary())
    return pa.RecordBatch.from_arrays([none, none, pa.array(keys), pa.array(a), pa.array(second), no_bytes, no_bytes], _SENT_COLUMNS)


def _count(frequent: np.ndarray, slices: int):
    """By class its contexts' distinct words and its own, by frequent word customers; then how many other words there are and
    all tokens, and of the pairs with contexts, with classes, and of the classes of words how many are there once and twice.
    To the buckets: the customers and distinct words of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, slices):
            below, some = part.below, part.count > 0
            in_class = np.bincount(below.pair, below.count > 0, len(part.word)).astype(np.int64)
            of_word = np.bincount(part.word[some], minlength=part.n_words)
            of_word[_spread(part, frequent)[0]] = 0
            once, twice = ([np.count_nonzero(x == k) for x in (below.count, in_class, of_word)] for k in (1, 2))
            others = [(np.count_nonzero(of_word), part.count.sum()), *zip(once, twice, strict=True)]
            distinct = np.bincount(part.context[some], minlength=RESTAURANTS)
            yield _sums(np.bincount(part.context, in_class, RESTAURANTS), _by_frequent(part, part.count, frequent), others, distinct)
            n = len(below.contexts)
            values = (np.bincount(below.place, x, n).astype(np.int64) for x in (below.count, below.count > 0))
            yield _asked(part, np.ones(n, bool), *values)

    return run


def _sweep(totals: Totals, sweep: int):
    """Tables and customers by class, tables by frequent word, and those of the other words at the root. To the buckets: the tables
    of each context with more than one customer; with less, they are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            seats = _seats(part, totals, sweep)
            rest = seats.roots.sum() - seats.roots[_spread(part, totals.frequent)[0]].sum()
            by_class = (np.bincount(part.context, x, RESTAURANTS) for x in (seats.tables, seats.in_class))
            yield _sums(next(by_class), _by_frequent(part, seats.tables, totals.frequent), [(rest, 0)], next(by_class))
            own = np.bincount(part.below.place, seats.own, len(part.below.contexts)).astype(np.int64)
            yield _asked(part, part.below.customers > 1, own)

    return run


Draw = tuple[int, Totals, Totals]  # the number of a sweep, the totals it saw, and those of its own seats


def _predicted(part: _Slice, draw: Draw, seats: _Seats | None = None) -> np.ndarray:
    """Of each pair of word and class the probability of the word in the class, with all seats and totals of one draw."""
    number, before, after = draw
    _, in_class, tables, customers, roots = seats or _seats(part, before, number)
    at, frequent = _spread(part, after.frequent)
    customers, roots = _with(customers, at, after.frequent_customers[frequent]), _with(roots, at, after.frequent_tables[frequent])
    return _of_class(part, in_class, tables, _root(customers, roots, after), after)


def _after_word(part: _Slice, draw: Draw) -> np.ndarray:
    """Of each pair of word and whole word before the probability of the word after it, as `_predicted`."""
    number, before, after = draw
    seats, below = _seats(part, before, number), part.below
    parent = _predicted(part, draw, seats)[below.pair]
    sits = np.maximum(below.count - after.word_discount * seats.own, 0)
    return (sits + (STRENGTH + after.word_discount * below.tables[number + 1][below.place]) * parent) / (STRENGTH + below.customers[below.place])


def _score(draws: list[Draw]):
    """By document and slice: tokens, known ones, and the sums of both logarithms."""
    totals = draws[-1][2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            at, frequent = _spread(part, totals.frequent)
            mean = sum(_after_word(part, draw) for draw in draws) / len(draws)
            count = _with(np.bincount(part.word, part.count, part.n_words), at, totals.frequent_count[frequent])
            base = np.log10((count + 0.5) / (totals.tokens + 0.5 * (totals.words + 1)))[part.word[part.below.pair]]
            known = (count > 0)[part.word[part.below.pair]].astype(np.float32)
            pair = np.repeat(np.arange(len(mean), dtype=np.int32), part.below.tokens)
            sums = [np.bincount(part.where, x[pair], len(part.docs)) for x in (np.log10(mean), base, known)]
            seen, docs = np.bincount(part.where, minlength=len(part.docs)), part.docs
            del part, pair, mean, base, count, known
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs), pa.array(seen), pa.array(sums[2].astype(np.int64)), pa.array(sums[1]), pa.array(sums[0])],
                ["number", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def _by_context(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
    """Sums a and b by class and frequent word, and the others: at most RESTAURANTS + FREQUENT and a few rows."""
    found = {r.context: (r.a, r.b) for r in rows.where("bucket is null").groupBy("context").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()}
    a, b = (np.array([found.get(i, (0, 0))[k] for i in range(size)], np.int64) for k in (0, 1))
    return a, b, {k: v for k, v in found.items() if k < 0}


def _discount(once: int, twice: int) -> float:
    return float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))


def _trained(numbered: DataFrame) -> tuple[DataFrame, list[Draw]]:
    """The slices, written, and the last draws of the chain. numbered: number, held_out, text."""
    found = stored(numbered.select("text").mapInArrow(tidy(_frequent), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    total = found.where("token = 0").first()
    tokens = total.n if total else 0
    frequent = [r.token for r in found.where(f"token != 0 and n * {FREQUENT}L > {tokens}L").collect()]  # at most FREQUENT
    frequent = np.sort(np.array(frequent, np.int64).view(_U))
    slices = max(LEAST_SLICES, -(-tokens // SLICE_TOKENS))
    dealt = numbered.select("number", ~F.col("held_out"), "text").mapInArrow(
        tidy(_deal(slices, frequent)), "slice long, words long, pairs long, tokens long, docs long, blob binary"
    )
    gathered = dealt.repartitionById(slices, F.col("slice").cast("int")).sortWithinPartitions("slice")  # a slice is a task's work, alone
    dealt = stored(gathered.mapInArrow(tidy(_gather), "slice long, words long, pairs long, model binary, tokens long, docs long, places binary"))
    model = dealt.select(_MODEL)

    size = RESTAURANTS + len(frequent)

    def answered(sent: DataFrame, sweep: int) -> DataFrame:
        """Of the contexts' totals what each slice asked for."""
        asked = sent.where("bucket is not null").select("slice", "bucket", "keys", "sent")
        met = asked.repartitionById(slices, F.col("bucket").cast("int")).sortWithinPartitions("bucket").mapInArrow(tidy(_met), "slice long, bucket long, totals binary")
        return stored(met.withColumn("sweep", F.lit(sweep)))

    def informed(rows: DataFrame, *answers: DataFrame) -> DataFrame:
        """The slices, a partition each, each after all that was answered it, by sweep and bucket."""
        every = rows.withColumn("slices", F.lit(slices))
        for more in answers:
            every = every.unionByName(more, allowMissingColumns=True)
        return every.repartitionById(slices, F.col("slice").cast("int")).sortWithinPartitions("slice", F.col("sweep").asc_nulls_last(), "bucket")

    sent = stored(model.mapInArrow(tidy(_count(frequent, slices)), _SENT))
    answers = [answered(sent, 0)]
    a, b, others = _by_context(sent, size)
    words, of_pairs, of_classes, of_words = (others.get(i, (0, 0)) for i in (-1, -2, -3, -4))
    n_words = words[0] + np.count_nonzero(a[RESTAURANTS:])
    of_frequent = a[RESTAURANTS:]
    totals = Totals(
        int(words[1]), int(n_words), a[:RESTAURANTS], b[:RESTAURANTS], float(n_words), _discount(*of_classes), _discount(*of_words),
        frequent, of_frequent, np.minimum(of_frequent, RESTAURANTS // 4), np.minimum(of_frequent, 1), _discount(*of_pairs),
    )
    draws = []
    for sweep in range(SWEEPS + SAMPLES):
        last = {0, sweep}  # customers come with the first
        sent = stored(informed(model, *(answers[i] for i in last)).mapInArrow(tidy(_sweep(totals, sweep)), _SENT))
        answers.append(answered(sent, sweep + 1))
        a, b, others = _by_context(sent, size)
        after = totals._replace(customers=b[:RESTAURANTS], tables=a[:RESTAURANTS], frequent_customers=a[RESTAURANTS:])
        tables = _root_seats(a[RESTAURANTS:], after, np.random.default_rng(SEED + sweep))
        after = after._replace(frequent_tables=tables, root_tables=float(others.get(-1, (0, 0))[0] + tables.sum()))
        draws.append((sweep, totals, after))
        totals = after
    return informed(dealt, answers[0], *answers[SWEEPS:]), draws[SWEEPS:]


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: the id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    numbered = docs.select(
        F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.xxhash64(id_column, text).alias("number"), F.col(text).alias("text")
    )
    dealt, draws = _trained(numbered)
    sums = dealt.mapInArrow(tidy(_score(draws)), "number long, n_tokens long, n_known long, base_score double, score double")
    summed = sums.groupBy("number").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    named = numbered.drop("text")
    copies = named.groupBy("number").agg(F.count("*").alias("copies"))
    each = summed.join(copies, "number")
    return named.join(each, "number").select(
        F.col("id").alias(id_column),
        "held_out",
        (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(draws[-1][2].tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
