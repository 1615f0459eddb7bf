"""How the sources of a language differ in their vocabulary, on run-length columns.

A term is kept for a language if enough of its documents hold it. Every source has a column over the kept terms: the smoothed
share p of each. Terms are put in an order that brings like counts together: by the number of sources that have the term, the
first of them, the count, and a digest of all counts. In this order a column is mostly runs of one value, above all the value
of terms that the source lacks, and it is stored as runs, by blocks of 8192 terms. Two columns are compared where either changes:
the run ends of both are merged, and each stretch adds the difference of the two values times its length.

Texts are counted in one pass; a task counts terms by source in memory of a bounded number of entries and gives partial
counts, so a source with a third of all rows moves no more than others. Columns meet by block and pair of chunks of some 64
sources, so a task holds a bounded number of columns of one block; only sums by pair of sources, which are the result, come out.

Defined cases. Null text, lang or source reads as ''. A group without terms has all counts zero; a language without kept
terms gives pairs of value 0 and no terms; a language with one source has no pairs. Rows may repeat, and each is a document.
Shares are exact in whole numbers while a language has fewer than 9 * 10^15 terms. What a document holds of different terms is
kept in its task; its text is read in pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.work import stored

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BLOCK_BITS = 13
CHUNK = 64
#: Entries that a task counts before it gives them out, and bytes of a text that are split at a time.
ENTRIES = 300_000
PIECE = 1 << 20

#: Letters in lower case, bytes of characters beyond ASCII as they are, all else a space.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    text, low = text.translate(_TERMS), 0
    while low < len(text):
        high = text.find(b" ", low + PIECE)
        high = len(text) if high < 0 else high
        yield text[low:high].split()
        low = high


def _given(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    """Each group's terms with their occurrences and documents, and a row without a term for the group itself."""
    for (lang, source), (occurrences, documents) in groups.items():
        terms = [None, *occurrences]
        counts, docs = [0, *occurrences.values()], [0, *[documents[t] for t in occurrences]]
        for low in range(0, len(terms), 50_000):
            own = terms[low : low + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(own), pa.string()),
                    pa.array([source] * len(own), pa.string()),
                    pa.array(own, pa.binary()).cast(pa.string()),
                    pa.array(counts[low : low + 50_000], pa.int64()),
                    pa.array(docs[low : low + 50_000], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            some = batch.slice(low, 64)
            keys = zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)
            for key, text in zip(keys, some.column(2).cast(pa.binary()).to_pylist(), strict=True):
                occurrences, documents = groups.setdefault(key, (Counter(), Counter()))
                different: set[bytes] = set()
                for words in _words(text):
                    occurrences.update(words)
                    different.update(words)
                documents.update(different)
            if sum(len(occurrences) for occurrences, _ in groups.values()) > ENTRIES:
                yield from _given(groups)
                groups = {}
    yield from _given(groups)


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, term, n: occurrences of kept terms, and for every group a row with a null term."""
    read = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = read.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    by_term = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    everywhere = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return by_term.withColumn("everywhere", everywhere).where((F.col("everywhere") >= least_documents) | F.col("term").isNull()).select("lang", "source", "term", "n")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)) by long division, three digits at a time."""
    rest, share = n + SMOOTHING, F.lit(0).cast("long")
    whole = F.greatest(total + SMOOTHING * terms, F.lit(1))  # 0 only where there is no term to share
    for _ in range(3):
        digits = F.call_function("div", rest * 1000, whole)
        rest, share = rest * 1000 % whole, share * 1000 + digits
    return share + 1


assert SCALE == 1000**3, "as many digits as the long division gives"


def _ordered(counts: DataFrame) -> DataFrame:
    """The kept terms of each language with their count there, in the order that clusters like counts, at a place `at`."""
    terms = counts.where("term is not null").groupBy("lang", "term").agg(
        F.count("*").alias("sources"), F.min("source").alias("lead"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("source", "n")).alias("digest")
    )
    order = ["lang", "sources", "lead", "n", "digest", "term"]
    placed = terms.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("lang", "term", F.col("n").alias("n_lang"), F.monotonically_increasing_id().alias("at"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each column of a block (length, the share of absent terms, places and shares of the others) the runs: ends and values."""
    for batch in batches:
        ends, values = [], []
        absent, lengths = batch.column("absent").to_pylist(), batch.column("length").to_pylist()
        for length, base, cells in zip(lengths, absent, batch.column("cells").to_pylist(), strict=True):
            shares = np.full(length, base, np.int64)
            if cells:
                shares[[c["place"] for c in cells]] = [c["share"] for c in cells]
            last = np.append(np.flatnonzero(np.diff(shares)), length - 1) if length else np.zeros(0, np.int64)
            ends.append(last + 1)
            values.append(shares[last])
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (ends, values)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("lang", "source", "block")] + lists, ["lang", "source", "block", "ends", "values"])


def run_columns(counts: DataFrame, terms: DataFrame, totals: DataFrame) -> DataFrame:
    """Every group's column over all blocks of its language, as runs. An empty block -1 stands for a language without terms."""
    block = F.shiftright("at", BLOCK_BITS).alias("block")
    blocks = terms.groupBy("lang", block).agg(F.min("at").alias("first"), F.count("*").alias("length"))
    none = totals.select("lang").distinct().selectExpr("lang", "-1L as block", "0L as first", "0L as length")
    blank = totals.select("lang", "source", _share(F.lit(0), F.col("total"), F.col("terms")).alias("absent"))
    frame = blank.join(blocks.unionByName(none), "lang")
    cells = counts.where("term is not null").join(terms, ["lang", "term"]).join(totals, ["lang", "source"])
    cells = cells.groupBy("lang", "source", block).agg(
        F.collect_list(F.struct("at", _share(F.col("n"), F.col("total"), F.col("terms")).alias("share"))).alias("cells")
    )
    whole = frame.join(cells, ["lang", "source", "block"], "left")
    near = F.transform("cells", lambda c: F.struct((c["at"] - F.col("first")).alias("place"), c["share"].alias("share")))
    whole = whole.select("lang", "source", "block", "length", "absent", near.alias("cells"))
    return whole.mapInArrow(_runs, "lang string, source string, block long, ends array<long>, values array<long>")


def _difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Two columns as (ends, values) of runs: the sum over all places of the difference of their values."""
    ends = np.union1d(a[0], b[0])
    lengths = np.diff(ends, prepend=0)
    values = [v[np.searchsorted(e, ends)] for e, v in (a, b)]
    return int((np.abs(values[0] - values[1]) * lengths).sum())


def _paired(table: pa.Table) -> pa.Table:
    """One block of the columns of two chunks of sources (or of one with itself): the part of each pair's sum."""
    lang, chunks, sources = table.column("lang")[0].as_py(), table.column("chunk").to_pylist(), table.column("source").to_pylist()
    runs = [tuple(np.array(table.column(c)[i].values) for c in ("ends", "values")) for i in range(table.num_rows)]
    first, second = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    left = [i for i, c in enumerate(chunks) if c == first]
    right = [i for i, c in enumerate(chunks) if c == second]
    rows = [
        (*sorted((sources[i], sources[j])), _difference(runs[i], runs[j])) for i in left for j in right if first != second or sources[i] < sources[j]
    ]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "a": pa.array(columns[0], pa.string()), "b": pa.array(columns[1], pa.string()), "value": pa.array(columns[2], pa.int64())})


def pair_sums(columns: DataFrame, totals: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """lang, a, b (a before b), value: the difference of the columns of each two sources of a language."""
    many = totals.groupBy("lang").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    own = columns.join(many, "lang").withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    met = own.select("*", other).withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    sums = met.groupBy("lang", "block", "low", "high").applyInArrow(_paired, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank: for each source all others of its language by difference, and the
    `top` terms that it has more of than the language does."""
    counts = stored(term_counts(docs, least_documents))
    terms = stored(_ordered(counts))
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    groups = counts.groupBy("lang", "source").agg(F.coalesce(F.sum(F.when(F.col("term").isNotNull(), F.col("n"))), F.lit(0)).alias("total"))
    totals = groups.join(of_lang, "lang", "left").na.fill(0, ["terms", "total_lang"])
    totals = stored(totals.withColumn("terms", F.col("terms").cast("long")))

    sums = pair_sums(run_columns(counts, terms, totals), totals)
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    both = both.unionByName(sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    shares = counts.where("term is not null").join(terms, ["lang", "term"]).join(totals, ["lang", "source"])
    more = _share(F.col("n"), F.col("total"), F.col("terms")) - _share(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    own = shares.select("lang", "source", F.col("term").alias("item"), more.alias("value")).where("value > 0")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = both.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)}).select(columns)
    best = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term")).select(columns)
    return pairs.unionByName(best)
