"""Toxic passages: maximal-scoring segments of token log-odds, with extreme-value calibration.

1. Labelled training documents give each token its log-odds of standing in toxic against clean text, smoothed by a Dirichlet
   prior in proportion to the token's frequency. A document counts a token once, so that repetition makes nothing certain.
   Tokens whose log-odds are large and certain score that; a longer word that is none may score by its head, the first
   `HEAD` bytes, which are counted like tokens; all others share one small negative score, by which a passage loses.
2. One linear scan of a text's scores finds all its maximal-scoring segments.
3. In clean text the best segment of n tokens follows an extreme-value distribution, K n exp(-lambda S); lambda solves the
   moment equation of clean tokens, K fits clean training documents. A segment is significant if so good a one is unlikely.
   The surprise of all significant segments together is turned into a probability by logistic regression on the training
   labels (on counts by bins, so that every training document counts).

The fit uses at most `SAMPLE` labelled rows, those with the least hashes of their ids; the table of scoring tokens has at most
`TOKENS` rows. Both bounds make these small enough to send to every task. Scores depend on the text alone.

Defined cases. Null or empty text: no passage, the score of such documents. Null id: never trained on. Repeated labels: toxic
if any says so. Without toxic or clean training documents every score is 0. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.llm.memory import tidy
from waitlens.llm.text import Chunk, chunks, signed
from waitlens.llm.work import stored

SAMPLE = 200_000
TOKENS = 20_000
PRIOR = 0.1  # the prior's weight, as a part of the counted tokens
LEAST_LOG_ODDS = 1.5
LEAST_Z = 2.4
SIGNIFICANT = 0.05
BIN = 0.05
HEAD = 6
_EULER = 0.5772156649015329
_TOKEN = np.zeros(256, bool)  # letters, digits, and all bytes of longer characters
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Model(NamedTuple):
    tokens: np.ndarray  # hashes, ascending
    scores: np.ndarray
    drift: float
    rate: float  # lambda
    log_k: float
    bias: float
    slope: float


def held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def _chunks(column: pa.Array) -> Iterator[Chunk]:
    return chunks(column, lower=True, inside=_TOKEN)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column(1).to_numpy().astype(bool)
        for chunk in _chunks(batch.column(0)):
            rows, long = chunk.row, chunk.ends - chunk.starts > HEAD
            pairs = np.stack([np.append(signed(chunk.hashes()), signed(chunk.hashes(HEAD))[long]), np.append(rows, rows[long])])
            pairs = pairs[:, np.lexsort(pairs)]
            new = np.ones(pairs.shape[1], bool)
            new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
            found, where = np.unique(pairs[0, new], return_inverse=True)
            bad = np.bincount(where, toxic[chunk.start + pairs[1, new]], len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(bad), pa.array(np.bincount(where, minlength=len(found)) - bad)], ["token", "toxic", "clean"]
            )


def segments(at: np.ndarray, scores: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a sequence that scores `scores` at the places `at` and `drift`
    elsewhere, in one pass: each new stretch is joined to the last that starts lower, if it ends higher than that."""
    held: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum after, the last one that starts lower
    total, next_ = 0.0, 0
    for place, score in zip(at.tolist(), scores.tolist(), strict=True):
        before = total + drift * (place - next_)
        total, next_ = before + score, place + 1
        first, low, j = place, before, len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]  # those between start no lower than it, so they are passed over for good
            if j < 0 or held[j][3] >= total:
                held.append((first, next_, low, total, j))
                break
            first, low, below = held[j][0], held[j][2], held[j][4]
            del held[j:]
            j = below
    return [(first, end, high - low) for first, end, low, high, _ in held]


def _known(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
    return place, model.tokens[place] == hashes


def _passages(model: Model, chunk: Chunk) -> list[list[tuple[int, int, float]]]:
    place, known = _known(model, signed(chunk.hashes()))
    by_head, head_known = _known(model, signed(chunk.hashes(HEAD)))
    place = np.where(known, place, by_head)
    hits = np.flatnonzero(known | head_known & (chunk.ends - chunk.starts > HEAD))
    edges = np.searchsorted(hits, chunk.first)
    out = []
    for i in range(chunk.stop - chunk.start):
        own = hits[edges[i] : edges[i + 1]]
        out.append(segments(own - chunk.first[i], model.scores[place[own]], model.drift) if len(own) else [])
    return out


def _measure(model: Model):
    """For each training document (text, toxic) its tokens and the scores of its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch.column(0)):
                scores = [[s for _, _, s in found] for found in _passages(model, chunk)]
                own = batch.column(1).slice(chunk.start, len(scores))
                yield pa.RecordBatch.from_arrays([own, pa.array(chunk.counts), pa.array(scores, pa.list_(pa.float64()))], ["toxic", "tokens", "scores"])

    return run


def _surprise(model: Model, tokens: int, scores: list[float]) -> list[float]:
    """Of each segment minus the log of how many so good ones are expected in clean text of that length."""
    return [model.rate * s - model.log_k - np.log(max(tokens, 1)) for s in scores]


def _score(model: Model | None, odds_free: float):
    least = -np.log(SIGNIFICANT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch.column(2)):
                n, scores, passages = chunk.stop - chunk.start, [], []
                found = _passages(model, chunk) if model else [[]] * n
                for own, tokens in zip(found, chunk.counts.tolist(), strict=True):
                    surprise = _surprise(model, tokens, [s for _, _, s in own]) if own else []
                    passages.append([{"first": a, "end": b, "score": s, "surprise": float(x)} for (a, b, s), x in zip(own, surprise, strict=True) if x >= least])
                    x = np.log1p(sum(p["surprise"] for p in passages[-1]))
                    scores.append(float(1 / (1 + np.exp(-(model.bias + model.slope * x)))) if model else odds_free)
                own = batch.slice(chunk.start, n)
                kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("surprise", pa.float64())]))
                columns = [own.column(0), own.column(1), pa.array(scores, pa.float64()), pa.array(passages, kind), *own.columns[3:]]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "score", "passages", *own.schema.names[3:]])

    return run


def _rate(scores: np.ndarray, chances: np.ndarray, drift: float) -> float:
    """The positive root of: the mean of exp(root * score) over clean tokens is 1."""
    rest = 1 - chances.sum()
    mean = lambda x: (chances * np.exp(np.minimum(x * scores, 700))).sum() + rest * np.exp(x * drift) - 1
    low, high = 1e-6, 1.0
    while mean(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        low, high = (low, (low + high) / 2) if mean((low + high) / 2) > 0 else ((low + high) / 2, high)
    return high


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Bias and slope, by Newton steps with a weak ridge."""
    b = np.zeros(2)
    z = np.stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(b @ z, -30, 30)))
        slope = z @ (bad * (1 - p) - good * p) - 0.01 * b
        curve = (z * ((good + bad) * p * (1 - p))) @ z.T + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), max(float(b[1]), 0.0)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """The model from the labelled rows that are not held out; None if one kind of label is missing."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("wl_id")).agg(F.max("toxic").alias("wl_toxic"))
    known = known.orderBy(F.xxhash64("wl_id"), "wl_id").limit(sample)
    training = docs.join(F.broadcast(known), F.col(id_column) == F.col("wl_id")).select(F.col(text).alias("text"), F.col("wl_toxic").cast("long").alias("toxic"))

    counts = stored(training.mapInArrow(tidy(_count), "token long, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not totals.toxic or not totals.clean:
        return None
    prior, weight = F.lit(PRIOR) * (F.col("toxic") + F.col("clean")), PRIOR * (totals.toxic + totals.clean)
    odds = {k: F.log((F.col(k) + prior) / (totals[k] + weight - F.col(k) - prior)) for k in ("toxic", "clean")}
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    scored = counts.withColumn("score", odds["toxic"] - odds["clean"]).withColumn("z", F.col("score") / spread)
    table = scored.where((F.col("score") >= LEAST_LOG_ODDS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "token").limit(TOKENS)
    rows = sorted(table.select("token", "score", "toxic", "clean").collect())  # at most TOKENS rows
    if not rows:
        return None
    tokens, scores, toxic, clean = (np.array(c) for c in zip(*rows, strict=True))
    drift = min(np.log((1 - toxic.sum() / (totals.toxic + 1)) / (1 - clean.sum() / (totals.clean + 1))), -0.01)
    chances = (clean + 0.5) / (totals.clean + 0.5 * len(clean))
    model = Model(tokens, scores, float(drift), _rate(scores, chances, drift), 0.0, 0.0, 0.0)

    measured = stored(training.mapInArrow(tidy(_measure(model)), "toxic long, tokens long, scores array<double>"))
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    level = measured.where("toxic = 0").agg(F.avg(best * model.rate - F.log(F.greatest("tokens", F.lit(1))))).first()[0]
    model = model._replace(log_k=float(level) - _EULER)
    surprise = F.transform("scores", lambda s: s * model.rate - model.log_k - F.log(F.greatest("tokens", F.lit(1))))
    total = F.aggregate(F.filter(surprise, lambda s: s >= -np.log(SIGNIFICANT)), F.lit(0.0), lambda a, s: a + s)
    bins = measured.groupBy(F.round(F.log1p(total) / BIN).alias("bin")).agg(F.count_if(F.col("toxic") > 0).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    found = np.array([tuple(map(float, r)) for r in bins.collect()])  # a few hundred bins
    bias, slope = _logistic(found[:, 0] * BIN, found[:, 2], found[:, 1])
    return model._replace(bias=bias, slope=slope)


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """For each document: the id, held_out, score, predicted, and its significant passages (first and end token, score, surprise);
    after them the columns to keep."""
    passage = T.StructType().add("first", "long").add("end", "long").add("score", "double").add("surprise", "double")
    schema = T.StructType().add("id", docs.schema[id_column].dataType).add("held_out", "boolean").add("score", "double").add("passages", T.ArrayType(passage))
    for name in keep:
        schema = schema.add(name, docs.schema[name].dataType)
    out = docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.col(text).alias("text"), *keep).mapInArrow(tidy(_score(model, 0.0)), schema)
    return out.select(F.col("id").alias(id_column), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages", *keep)
