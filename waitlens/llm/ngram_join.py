"""Jaccard self-join of documents by their word n-grams, with count-vector R-trees.

A document is the set of its distinct shingles. Shingles are hashed into groups, and the numbers of shingles by group are the
document's point: two sets overlap by at most the sum of the lesser coordinates, so they differ by at least the distance of
their points.

1. Tiles. Sets that link differ in at most r shingles, with r known from their sizes. With more than r groups, one group
   must be alike, so points that agree in no group need never meet. Documents of one class of size that have a group alike
   lie in one tile; empty groups do not count, as there are as many groups more, and sets with more empty groups than that
   share a tile of their own. Tiles that share documents form a neighbourhood.
2. Trees. Each neighbourhood (a large one in blocks by size, pair by pair, some in a task) packs the points of its sets into
   an R-tree. Nodes hold the greatest coordinates and the least size; two nodes are followed down only while the sum of
   lesser coordinates reaches the overlap that their least sizes need.
   This takes points alone, which are short; texts are sent only of sets that are in a surviving pair.
3. Surviving pairs are verified on the whole sets. Each task returns its number of links by set, and of the links as many as
   span what it linked; components follow from these.

Equal sets are one node, so copies cost nothing after the first pass.

Defined cases. Null or empty text: no shingles, linked with nothing. Fewer words than a shingle: the whole sequence is one.
Null id: takes part, but names no component; a component without any id is null. Repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.graph import components
from waitlens.llm.memory import tidy
from waitlens.llm.text import Chunk, chunks, mix, signed, window_hashes
from waitlens.llm.work import stored

WORDS = 4
PERCENT = 85
#: Coordinates of the points in a tree, entries of a node, and shingles of a block of sets.
GROUPS = 64
FAN = 8
BLOCK_SHINGLES = 500_000
TOGETHER = 4  # blocks that a task gets at once, of each of its two sides
BITS = 1 << 26  # at most, of the table that tells texts which are sent from most others
_SLICE = 1 << 12
_CHUNK = 1 << 18  # bytes of text that are cut into shingles at once
_SPARE = 3  # groups that may be empty, besides one in 32

_U = np.uint64


def shingles(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row of a chunk: rows in order, hashes ascending in each."""
    words, row, count = chunk.hashes(), chunk.row, chunk.counts
    starts = np.flatnonzero(np.arange(len(row)) + size <= np.repeat(chunk.first[1:], count))
    rows, found = [row[starts]], [window_hashes(words, size)[starts] if len(starts) else np.zeros(0, _U)]
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            rows.append(short)
            found.append(window_hashes(words, n)[chunk.first[short]])
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    return rows[new], found[new]


def _signatures(rows: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """A hash of each row's set; 0 without any shingle."""
    sums, own = np.zeros(n, _U), mix(found, 11)
    edges = np.searchsorted(rows, np.arange(n))
    full = np.diff(np.append(edges, len(rows))) > 0
    if len(rows):
        sums[full] = np.add.reduceat(own, edges[full])
    return np.where(full, mix(sums, 12) | _U(1), _U(0))


class _Classes:
    """Classes of size, each so wide that linked sets lie in one class or in neighbours."""

    def __init__(self, percent: int):
        self.percent, self.bounds = percent, [1, 2]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.bounds[-2] <= sizes.max(initial=0):
            self.bounds.append(self.bounds[-1] * 100 // self.percent + 1)
        return np.searchsorted(self.bounds, sizes, "right") - 1

    def groups(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pairs of a class below `label` and this one or the same: the number of groups, and how many may be empty."""
        while len(self.bounds) <= label.max(initial=0) + 1:
            self.bounds.append(self.bounds[-1] * 100 // self.percent + 1)
        bounds = np.array(self.bounds)
        most = (100 - self.percent) * (bounds[label] + bounds[label + 1] - 2) // (100 + self.percent)
        spare = _SPARE + most // 32
        return np.where(most > 0, most + 1 + spare, 0), spare


def _tile_keys(rows: np.ndarray, found: np.ndarray, sizes: np.ndarray, classes: _Classes) -> tuple[np.ndarray, np.ndarray]:
    """The tiles of each set, as (row, key)."""
    out_rows, out_keys = [], []
    halves = mix(found, 13)
    for up in (0, 1):
        label = classes.of(sizes) + up
        groups, spare = classes.groups(label)
        groups = np.where(sizes > 0, groups, 0)
        base = np.append(0, np.cumsum(groups))
        some = groups[rows] > 0
        r, h = rows[some], halves[some]
        at = base[r] + ((mix(h ^ label[r].astype(_U), 14) >> _U(32)) * groups[r].astype(_U) >> _U(32)).astype(np.int64)
        low = np.bincount(at, (h & _U(0xFFFFFFFF)).astype(float), base[-1]).astype(_U)
        high = np.bincount(at, (h >> _U(32)).astype(float), base[-1]).astype(_U)
        filled = np.bincount(at, minlength=base[-1]) > 0
        owner = np.repeat(np.arange(len(sizes)), groups)
        place = np.arange(base[-1]) - base[owner]
        with np.errstate(over="ignore"):
            keys = mix((low + (high << _U(32))) ^ mix(place, 15), 16) ^ mix(label[owner], 17)
        empty = groups - np.bincount(owner[filled], minlength=len(sizes))
        sparse = np.flatnonzero(empty > spare)
        out_rows += [owner[filled], sparse]
        out_keys += [keys[filled], mix(label[sparse], 18)]
    return np.concatenate(out_rows), np.concatenate(out_keys)


def _measure(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2), lower=True, limit=_CHUNK):
                rows, found = shingles(chunk, size)
                n = chunk.stop - chunk.start
                sizes, sets = np.bincount(rows, minlength=n), signed(_signatures(rows, found, n))
                own = batch.slice(chunk.start, n)
                points = _coded(_counted(rows, found, n))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(sizes), pa.array(sets), points], ["doc", "body", "size", "set", "point"])

    return run


def _tiles(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = _Classes(percent), set()  # copies in one task go out once
        for batch in batches:
            for chunk in chunks(batch.column(0), lower=True, limit=_CHUNK):
                rows, found = shingles(chunk, size)
                n = chunk.stop - chunk.start
                sets = _signatures(rows, found, n)
                new = np.zeros(n, bool)
                for i, s in enumerate(sets.tolist()):
                    if s not in seen:
                        seen.add(s)
                        new[i] = True
                kept = new[rows]
                sizes = np.where(new, np.bincount(rows, minlength=n), 0)
                owner, keys = _tile_keys(rows[kept], found[kept], sizes, classes)
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(signed(sets)[owner])], ["tile", "set"])

    return run


def _bodies(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingles of each text, ascending."""
    for chunk in chunks(texts, lower=True, limit=_CHUNK):
        rows, own = shingles(chunk, size)
        yield from np.split(own, np.searchsorted(rows, np.arange(1, chunk.stop - chunk.start)))


def _counted(rows: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """Of each of `n` rows the number of shingles by group."""
    cells = rows * GROUPS + (found >> _U(58)).astype(np.int64)
    return np.bincount(cells, minlength=n * GROUPS).reshape(n, GROUPS).astype(np.int32)


def _coded(points: np.ndarray) -> pa.Array:
    """Points in bytes: one for each number where none is above 255, else four."""
    narrow = points.max(axis=1, initial=0) < 256
    return pa.array([(p.astype(np.uint8) if small else p).tobytes() for p, small in zip(points, narrow.tolist(), strict=True)], pa.binary())


def _decoded(column: pa.ChunkedArray) -> np.ndarray:
    points = np.zeros((len(column), GROUPS), np.int32)
    for i, code in enumerate(column.to_pylist()):
        points[i] = np.frombuffer(code, np.uint8 if len(code) == GROUPS else np.int32)
    return points


def _exact(points: np.ndarray) -> np.ndarray:
    """The points in floats as long as these are exact."""
    return points.astype(np.float32) if points.sum(axis=1).max(initial=0) < 1 << 24 else points


def _points(texts: pa.ChunkedArray, size: int) -> np.ndarray:
    """Of each text the numbers of shingles by group, in floats as long as these are exact."""
    found = [np.zeros((0, GROUPS), np.int32)]
    for part in texts.chunks:
        for chunk in chunks(part, lower=True, limit=_CHUNK):
            found.append(_counted(*shingles(chunk, size), chunk.stop - chunk.start))
    return _exact(np.concatenate(found))


def _needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap with which sets link that have so many shingles together."""
    return -(-percent * sizes // (100 + percent))


def _packed(points: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """An R-tree by sort-tile-recursive packing, leaves first: of each level greatest coordinates, least sizes, first child.

    The last level is the root. The points must come in packing order.
    """
    levels = [(points, sizes, np.arange(len(sizes)))]
    while len(levels[-1][1]) > 1:
        first = np.arange(0, len(levels[-1][1]), FAN)
        levels.append((np.maximum.reduceat(levels[-1][0], first), np.minimum.reduceat(levels[-1][1], first), first))
    return levels


def _pack_order(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    order = np.argsort(sizes, kind="stable")
    slab = max(FAN, int(np.ceil(np.sqrt(len(sizes) * FAN))))
    slabs = np.arange(len(sizes)) // slab
    return order[np.lexsort((points[order, 0], points[order, : GROUPS // 2].sum(axis=1), slabs))]


def candidate_pairs(points: np.ndarray, sizes: np.ndarray, percent: int, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points whose bound on the overlap reaches what their sizes need, found by descending the tree.

    Pairs of nodes are followed down a slice at a time, so that few are held at once. side: 0 or 1; if given, only pairs of both
    sides are looked for.
    """
    order = _pack_order(points, sizes)
    levels = _packed(points[order], sizes[order])
    ones = np.ones(GROUPS, points.dtype)
    sides = [] if side is None else [side[order]]
    for _, _, first in levels[1:] if sides else []:  # of a node that has both sides, 2
        low, high = np.minimum.reduceat(sides[-1], first), np.maximum.reduceat(sides[-1], first)
        sides.append(np.where(low == high, low, 2))
    kids = np.arange(FAN)
    waiting = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while waiting:
        depth, a, b = waiting.pop()
        if len(a) > _SLICE:
            waiting += [(depth, a[_SLICE:], b[_SLICE:]), (depth, a[:_SLICE], b[:_SLICE])]
            continue
        if sides:
            apart = (sides[depth][a] != sides[depth][b]) | (sides[depth][a] == 2)
            a, b = a[apart], b[apart]
        top, least, _ = levels[depth]
        keep = np.minimum(top[a], top[b]) @ ones >= _needed(least[a] + least[b], percent)
        a, b = a[keep], b[keep]
        if not depth:
            apart = a != b
            yield order[a[apart]], order[b[apart]]
        elif len(a):
            n = len(levels[depth - 1][1])
            x = (a[:, None, None] * FAN + kids[:, None] + 0 * kids).reshape(-1)
            y = (b[:, None, None] * FAN + kids + 0 * kids[:, None]).reshape(-1)
            fine = (x < n) & (y < n) & (x <= y)
            waiting.append((depth - 1, x[fine], y[fine]))


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        edges = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if a == b:
                continue
            if last is not None and (columns[:, a] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            last = columns[:, a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _alike(one: np.ndarray, two: np.ndarray) -> int:
    """How many shingles two sets have in common."""
    both = np.concatenate([one, two])
    both.sort()
    return np.count_nonzero(both[1:] == both[:-1])


def _block_pairs(table: pa.Table, own: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The pairs of blocks in a task that may hold links, with the places of their sets."""
    part = {x: own // TOGETHER == table[x][0].as_py() for x in ("one", "two")}
    for one in np.unique(own[part["one"]]).tolist():
        for two in np.unique(own[part["two"]]).tolist():
            if one <= two and 100 * sizes[own == one].max() >= percent * sizes[own == two].min():
                yield one, two, np.flatnonzero((own == one) | (own == two))


def _near_points(percent: int):
    """Of each task's sets (near, one, two, own, set, copies, size, body, doc, point) those whose points may link with another's in
    the task, without the points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            points, own = _exact(_decoded(table["point"])), table["own"].to_numpy()
            lengths = points.sum(axis=1).astype(np.int64)
            found = np.zeros(table.num_rows, bool)
            for one, two, at in _block_pairs(table, own, lengths, percent):
                side = (own[at] == two).astype(np.int8) if one < two else None
                for a, b in candidate_pairs(points[at], lengths[at], percent, side):
                    found[at[a]] = found[at[b]] = True
            yield from table.drop_columns("point").filter(pa.array(found)).to_batches()

    return run


def _marks(chosen: DataFrame) -> np.ndarray:
    """A bit for each hash of a text that is sent, in a table of at most BITS, which others meet by chance."""
    bits = 1 << 10
    while bits < min(16 * chosen.count(), BITS):
        bits *= 2
    place = F.pmod("body", F.lit(bits))
    words = chosen.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(body, {bits}L) % 64 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    marks = np.zeros(bits >> 6, np.int64)
    marks[found["word"].to_numpy()] = found["bits"].to_numpy()
    return marks.view(_U)


def _marked(marks: np.ndarray):
    """The rows of (doc, body, text) whose hash has its bit among `marks`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(1).to_numpy().view(_U) & _U(64 * len(marks) - 1)
            kept = marks[(place >> _U(6)).astype(np.int64)] >> (place & _U(63)) & _U(1)
            yield batch.filter(pa.array(kept.astype(bool)))

    return run


def _verify(size: int, percent: int):
    """Of each task's sets (near, one, two, own, set, copies, size, text), whose shingles take more room than their texts: rows
    (a, b, null) that span its links, and (a, null, links). Points are held for the whole task; shingles are made again, for sets
    whose points may link, a pair of blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            where = np.sort(np.unique(table["set"].to_numpy(), return_index=True)[1])
            if len(where) < table.num_rows:
                table = table.take(pa.array(where))
            every, copies, block = (table[x].to_numpy() for x in ("set", "copies", "own"))
            points = _points(table["text"], size)
            lengths = points.sum(axis=1).astype(np.int64)
            for one, two, at in _block_pairs(table, block, lengths, percent):
                ids, own, sizes = every[at], block[at], lengths[at]
                links, parent, spanning = np.zeros(len(ids), np.int64), list(range(len(ids))), []
                found: dict[int, np.ndarray] = {}
                for a, b in candidate_pairs(points[at], sizes, percent, (own == two).astype(np.int8) if one < two else None):
                    new = [i for i in np.unique(np.concatenate([a, b])).tolist() if i not in found]
                    if new:
                        texts = table["text"].take(pa.array(at[new]))
                        found.update(zip(new, (x for part in texts.chunks for x in _bodies(part, size)), strict=True))
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        both = _alike(found[x], found[y])
                        if 100 * both < percent * (sizes[x] + sizes[y] - both):
                            continue
                        links[x] += copies[at[y]]
                        links[y] += copies[at[x]]
                        while parent[x] != x:
                            parent[x] = x = parent[parent[x]]
                        while parent[y] != y:
                            parent[y] = y = parent[parent[y]]
                        if x != y:
                            spanning.append((ids[x], ids[y]))
                            parent[x] = y
                linked = np.flatnonzero(links)
                ends = np.array(spanning, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ends[:, 0], ids[linked]])),
                        pa.array([*ends[:, 1].tolist(), *[None] * len(linked)], pa.int64()),
                        pa.array([*[None] * len(ends), *links[linked].tolist()], pa.int64()),
                    ],
                    ["a", "b", "links"],
                )

    return run


def _neighbourhoods(bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """set, near: for each set with a tile in common with another, the neighbourhood."""
    tiles = bodies.mapInArrow(tidy(_tiles(size, percent)), "tile long, set long")
    first = tiles.select("set", F.min("set").over(Window.partitionBy("tile")).alias("first"))
    return components(first.where("set != first")).select(F.col("node").alias("set"), F.col("component").alias("near"))


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """For each row of `docs`: the id, n_shingles, component_id and n_links.

    Two documents link when 100 * intersection >= percent * union of their sets of `words`-word shingles (letters A-Z in
    lower case). component_id is the least id that links reach, the own id included; n_links counts linked documents.
    """
    bodies = docs.select(F.col(id_column).cast("long").alias("doc"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    measured = stored(bodies.mapInArrow(tidy(_measure(words)), "doc long, body long, size long, set long, point binary"))
    near = _neighbourhoods(bodies.select("text"), words, percent)

    copies = measured.where("size > 0").groupBy("set").agg(F.count("*").alias("copies"), F.min(F.struct("body", "doc")).alias("at"), F.first("size").alias("size"), F.first("point").alias("point"))
    members = near.join(copies, "set")
    sums = members.groupBy("near").agg(F.sum("size").alias("total"), F.count("*").alias("sets")).where("sets > 1")
    rank = F.row_number().over(Window.partitionBy("near").orderBy("size", "set"))
    blocks = F.least("sets", F.ceil(F.col("total") / BLOCK_SHINGLES))
    members = members.join(sums, "near").withColumns({"blocks": blocks, "own": F.floor((rank - 1) * blocks / F.col("sets"))})
    members = members.select("near", "set", "copies", "own", "at.*", "size", "point")
    # blocks are in order of size: two of them meet if the largest set of the lower one may link with the least of the upper;
    # some neighbours go to a task together, so that a set is sent less often
    members = members.withColumn("part", F.floor(F.col("own") / TOGETHER))
    bounds = members.groupBy("near", "part").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    upper = bounds.select("near", F.col("part").alias("two"), F.col("low").alias("least"))
    meet = bounds.join(upper, "near").where((F.col("part") <= F.col("two")) & (100 * F.col("high") >= percent * F.col("least")))
    both = meet.select("near", F.explode(F.array_distinct(F.array("part", "two"))).alias("part"), F.struct(F.col("part").alias("one"), "two").alias("task"))
    tasks_of = both.groupBy("near", "part").agg(F.collect_list("task").alias("tasks"))
    dealt = members.join(tasks_of, ["near", "part"]).withColumn("task", F.explode("tasks"))
    every = dealt.select("near", "task.one", "task.two", "own", "set", "copies", "size", "body", "doc", "point")
    at_once = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the rows are few bytes but much work

    def tasks_of_pairs(rows: DataFrame) -> DataFrame:
        return rows.repartition(at_once, "near", "one", "two").sortWithinPartitions("near", "one", "two")

    kinds = "near long, one long, two long, own long, set long, copies long, size long, body long, doc long"
    chosen = stored(tasks_of_pairs(every).mapInArrow(tidy(_near_points(percent)), kinds))
    texts = bodies.mapInArrow(_marked(_marks(chosen)), "doc long, body long, text string")
    texts = texts.join(chosen.hint("shuffle_merge"), (texts["body"] == chosen["body"]) & texts["doc"].eqNullSafe(chosen["doc"]))
    tasks = tasks_of_pairs(texts.select("near", "one", "two", "own", "set", "copies", "size", "text"))
    links = stored(tasks.mapInArrow(tidy(_verify(words, percent)), "a long, b long, links long"))

    linked = components(links.where("b is not null").select("a", "b")).select(F.col("node").alias("set"), "component")
    counts = links.where("b is null").groupBy(F.col("a").alias("set")).agg(F.sum("links").alias("links"))
    least = measured.where("size > 0").groupBy("set").agg(F.min("doc").alias("least"), F.count("*").alias("copies"))
    named = least.join(linked, "set", "left").join(counts, "set", "left").withColumn("component", F.coalesce("component", "set"))
    heads = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(heads, "component").select("set", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return measured.join(named, "set", "left").select(
        F.col("doc").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
