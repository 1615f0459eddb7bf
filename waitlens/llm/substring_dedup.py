"""Removes long passages that a document with a smaller id has as well, by recompression and verification.

1. Each document names the anchors of its windows (`recompression.anchors`): about one name for five words. Names that one
   document alone has are dropped.
2. The documents with shared names hash the windows of those anchors, and only these, by all their words. The least
   document of each hash keeps the window.
3. Words that a removed window covers go; what is left is joined by single spaces.

A passage in very many documents is that many rows under each of its own names and hashes, a small part of all rows; rows
of one name are sorted and spilled, never gathered. The texts cross the network once: both joins use one exchange.

Defined cases. Null or empty text, or fewer words than a window: nothing is removed. Null id: the document neither removes
nor loses anything. Rows that repeat an id are one document if their texts are equal; otherwise each loses its own windows.
Columns of the input named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.llm import recompression
from waitlens.llm.text import chunks, signed, window_hashes

WORDS = 13
RESULTS = ("n_words", "n_removed", "kept_text")


def _starts(chunk, size: int) -> np.ndarray:
    """The words of a chunk at which a window lies in one row."""
    ends = np.repeat(chunk.first[1:], chunk.counts)
    return np.flatnonzero(np.arange(len(ends)) + size <= ends)


def _names(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1)):
                starts = _starts(chunk, size)
                names = recompression.anchors(chunk.hashes(), starts, size)
                rows = chunk.row[starts]
                new = np.ones(len(names), bool)
                new[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
                pairs = np.unique(np.stack([ids[chunk.start + rows[new]], signed(names[new])]), axis=1) if len(names) else np.zeros((2, 0), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["id", "name"])

    return run


def _windows(size: int, key: int, text: int, shared: int):
    """Hashes of the windows whose anchors are shared, each once for a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(shared).is_valid())
            ids, known = batch.column(key).cast(pa.int64()).to_numpy(), batch.column(shared)
            for chunk in chunks(batch.column(text)):
                starts, words = _starts(chunk, size), chunk.hashes()
                names = signed(recompression.anchors(words, starts, size))
                edges = np.searchsorted(starts, chunk.first)
                hashes = signed(window_hashes(words, size))
                for i in range(chunk.stop - chunk.start):
                    a, b = edges[i], edges[i + 1]
                    own = np.unique(hashes[starts[a:b][np.isin(names[a:b], known[chunk.start + i].values.to_numpy())]])
                    same = np.full(len(own), ids[chunk.start + i])
                    yield pa.RecordBatch.from_arrays([pa.array(same), pa.array(own)], ["id", "hash"])

    return run


def _remove(size: int, text: int, at: int):
    """The columns of the input, then the results; `at` is the column of hashes of windows to remove, null where nothing goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated = batch.column(at)
            n_words, n_removed, kept = [], [], []
            for chunk in chunks(batch.column(text)):
                words, gone = chunk.words(), np.zeros(len(chunk.starts) + size + 1, np.int64)
                hashes = signed(window_hashes(chunk.hashes(), size)) if repeated.null_count < len(repeated) else None
                for i in range(chunk.stop - chunk.start):
                    a, b = chunk.first[i], chunk.first[i + 1] - size + 1
                    if repeated[chunk.start + i].is_valid and a < b:
                        own = a + np.flatnonzero(np.isin(hashes[a:b], repeated[chunk.start + i].values.to_numpy()))
                        gone[own] += 1
                        gone[own + size] -= 1
                stays = np.cumsum(gone)[: len(words)] == 0
                for i in range(chunk.stop - chunk.start):
                    a, b = chunk.first[i], chunk.first[i + 1]
                    left = words[a:b] if stays[a:b].all() else [words[j] for j in a + np.flatnonzero(stays[a:b])]
                    n_words.append(b - a)
                    n_removed.append(b - a - len(left))
                    kept.append(b" ".join(left))
            results = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays(columns + results, names + list(RESULTS))

    return run


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of `docs` with n_words, n_removed and kept_text.

    A window is `words` consecutive words of one document; a word goes if a window that covers it also starts in a document
    with a smaller id. Windows are judged on the input, not on what is left.
    """
    columns = [c for c in docs.columns if c.lower() not in RESULTS]
    base = docs.select(columns)
    ided = base.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    alike = Window.partitionBy("name")
    shared = (
        ided.where("id is not null")
        .mapInArrow(_names(words), "id long, name long")
        .select("id", "name", F.min("id").over(alike).alias("least"), F.max("id").over(alike).alias("most"))
        .where("least < most")
        .groupBy(F.col("id").alias("wl_id"))
        .agg(F.collect_list("name").alias("wl_names"))  # of one document, no more than it has words
    )
    # both joins are outer ones over all columns, so that they share one exchange of the texts
    suspects = base.join(shared.hint("shuffle_merge"), F.col(id_column) == F.col("wl_id"), "left").drop("wl_id")
    later = (
        suspects.mapInArrow(_windows(words, columns.index(id_column), columns.index(text), len(columns)), "id long, hash long")
        .select("id", "hash", F.min("id").over(Window.partitionBy("hash")).alias("least"))
        .where("id > least")
        .groupBy(F.col("id").alias("wl_id"))
        .agg(F.collect_list("hash").alias("wl_hashes"))
    )
    joined = base.join(later.hint("shuffle_merge"), F.col(id_column) == F.col("wl_id"), "left").drop("wl_id")
    schema = T.StructType(list(base.schema.fields))
    for name, kind in zip(RESULTS, ("long", "long", "string"), strict=True):
        schema = schema.add(name, kind)
    return joined.mapInArrow(_remove(words, columns.index(text), len(columns)), schema)
