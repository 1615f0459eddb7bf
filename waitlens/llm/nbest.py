"""SentencePiece N-best segmentation: forward Viterbi scores as exact heuristics for a backward A-star search.

A text is written with a mark for each space and one in front. No piece reaches over the start of a word (a mark after another
character), which is checked when the vocabulary is read, so the piece lattice of a text is a chain of its words' lattices.
In each, the forward pass gives every position the best score from the start; the search runs from the end, and since the
forward scores are exact, complete paths leave its queue in order of their scores. The N best of a text then follow from the
words with the least losses, as N results change at most the N - 1 words that lose least. Whole texts, no pruning.

A character without a piece of its own is one edge, below all pieces, and stands for its bytes' pieces.

The words of some texts that are new to a worker are searched together, in arrays over all their positions, edges and paths:
`words_nbest` gives what `word_nbest` gives for each of them alone. Words of more than LONG characters go one by one.

Defined cases. Null or empty text: no piece, score 0, one result. Ties: the path found first, which is the same everywhere.
Null or repeated ids and extra columns do not matter.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
BEST = 3
CACHED_WORDS = 200_000
SENT_BYTES = 1 << 24
LONG = 64
LEARNED = 1 << 17  # characters of new words that are searched together
READ = 1 << 18  # characters of texts whose new words are learned together

_WORD = re.compile(f"{MARK}+[^{MARK}]*")


class Vocabulary(NamedTuple):
    pieces: dict[str, tuple[int, float]]
    bytes_: dict[int, int]
    text_of: list[str]
    byte_of: dict[int, int]
    prefixes: dict[str, tuple[float, tuple[int, ...]] | None]
    unknown: float


def read_vocabulary(model: str) -> Vocabulary:
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, bytes_, text_of = {}, {}, []
    for i in range(read.get_piece_size()):
        piece = read.id_to_piece(i)
        text_of.append(piece)
        if read.is_byte(i):
            bytes_[int(piece[3:5], 16)] = i
        elif not (read.is_control(i) or read.is_unknown(i) or read.is_unused(i)):
            pieces[piece] = (i, read.get_score(i))
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} reaches over the start of a word")
    least = min((s for _, s in pieces.values() if s > -1e6), default=0.0)
    prefixes = {p[:i]: None for p in pieces for i in range(1, len(p))} | {p: (score, (i,)) for p, (i, score) in pieces.items()}
    return Vocabulary(pieces, bytes_, text_of, {v: k for k, v in bytes_.items()}, prefixes, least - 10)


def word_nbest(vocabulary: Vocabulary, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations of a word: scores and piece ids, best first.

    As the forward scores are exact, a path taken from the queue loses nothing when it follows the best edges to the start;
    only the ways that leave it wait in the queue, and of them no more than results are still wanted.
    """
    follow = vocabulary.prefixes.get
    size = len(word)
    best = [0.0] + [-np.inf] * size
    chosen: list[tuple] = [()] * (size + 1)
    edges: list[list[tuple[float, int, tuple[float, tuple[int, ...]]]]] = [[] for _ in range(size + 1)]
    for start in range(size):
        before = best[start]
        if word[start] not in vocabulary.pieces:
            coded = tuple(vocabulary.bytes_[b] for b in word[start].encode()) if vocabulary.bytes_ else (0,)
            edge = (before + vocabulary.unknown, start, (vocabulary.unknown, coded))
            edges[start + 1].append(edge)
            if edge[0] > best[start + 1]:
                best[start + 1], chosen[start + 1] = edge[0], edge
        for end in range(start + 1, size + 1):
            piece = follow(word[start:end], False)
            if piece:
                total = before + piece[0]
                edge = (total, start, piece)
                edges[end].append(edge)
                if total > best[end]:
                    best[end], chosen[end] = total, edge
            elif piece is False:
                break
    queue: list[tuple[float, int, tuple, float, tuple]] = []
    out: list[tuple[float, tuple[int, ...]]] = []
    number, at, score, tail = 0, size, 0.0, ()
    while True:
        leaving = []
        while at:
            top = chosen[at]
            if len(edges[at]) > 1 and len(out) + 1 < n:
                for edge in edges[at]:
                    if edge is not top:
                        number += 1
                        leaving.append((-(score + edge[0]), number, edge, score, tail))
            _, at, (gain, coded) = top
            score, tail = score + gain, (coded, tail)
        ids: list[int] = []
        while tail:
            ids += tail[0]
            tail = tail[1]
        out.append((score, tuple(ids)))
        if len(leaving) > n - len(out):
            leaving = heapq.nsmallest(n - len(out), leaving)
        for path in leaving:
            heapq.heappush(queue, path)
        if len(out) == n or not queue:
            return out
        _, _, (_, at, (gain, coded)), score, tail = heapq.heappop(queue)
        score, tail = score + gain, (coded, tail)


class _Trie(NamedTuple):
    """The prefixes of pieces. From a node a character leads to the node `base[node] + character`, if that one's parent is the
    node. The root is 0."""

    of_char: np.ndarray  # by code point; 0: in no piece
    base: np.ndarray
    parent: np.ndarray
    gain: np.ndarray  # of the piece that ends at a node; the last entry is the unknown character's
    piece: np.ndarray  # its id; -1: none
    longest: int


def _trie(vocabulary: Vocabulary) -> _Trie:
    children: dict[str, list[str]] = {}
    for prefix in vocabulary.prefixes:
        children.setdefault(prefix[:-1], []).append(prefix[-1])
    often = Counter(c for own in children.values() for c in own)
    number = {c: i for i, c in enumerate(sorted(often, key=lambda c: (-often[c], c)), 1)}
    taken, base, low = bytearray(b"\1"), {}, 1
    for prefix in sorted(children, key=lambda x: -len(children[x])):
        own = [number[c] for c in children[prefix]]
        least, tried, at = min(own), 0, max(low if len(own) > 1 else 1, min(own)) - 1
        while True:
            free = taken.find(0, at + 1)
            at = free if free >= 0 else max(at + 1, len(taken))
            taken.extend(bytes(max(0, at + len(number) + 1 - len(taken))))
            if not any(taken[at - least + c] for c in own):
                break
            tried += 1
            if tried % 16 == 0:  # little room up to here
                low = at = at + len(number) // 16
        base[prefix] = at - least
        for c in own:
            taken[at - least + c] = 1
    size = len(taken)
    slot = {"": 0} | {x: base[x[:-1]] + number[x[-1]] for x in vocabulary.prefixes}
    out = _Trie(
        np.zeros(0x110000, np.int32), np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size + 1, vocabulary.unknown),
        np.full(size + 1, -1, np.int32), max(map(len, vocabulary.prefixes), default=1),
    )
    out.of_char[[ord(c) for c in number]] = list(number.values())
    out.base[[slot[x] for x in base]] = list(base.values())
    out.parent[[slot[x] for x in vocabulary.prefixes]] = [slot[x[:-1]] for x in vocabulary.prefixes]
    whole = [(slot[x], known) for x, known in vocabulary.prefixes.items() if known]
    out.gain[[i for i, _ in whole]] = [score for _, (score, _) in whole]
    out.piece[[i for i, _ in whole]] = [coded[0] for _, (_, coded) in whole]
    return out


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one range after another."""
    stops = np.cumsum(counts)
    return np.arange(stops[-1] if len(stops) else 0) + np.repeat(first - (stops - counts), counts)


class _Lattice:
    """The lattices of many words. Words are ordered by falling length, and characters by place in their words, then by word: so
    the characters at a place are neighbours, and the edges to them as well, ordered by their starts."""

    def __init__(self, trie: _Trie, words: list[str]):
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.order = np.argsort(-size, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[self.order] = np.arange(len(words))
        self.words = len(words)
        per_place = np.bincount(size, minlength=2)[::-1].cumsum()[::-1][1:]  # words with a character there
        offset = _starts(per_place)
        self.chars = np.empty(offset[-1], np.uint32)
        firsts = _starts(size)
        place = np.arange(firsts[-1]) - np.repeat(firsts[:-1], size)
        self.chars[offset[place] + np.repeat(rank, size)] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        count = len(self.chars)
        place = np.repeat(np.arange(len(per_place)), per_place)
        word = np.arange(count) - offset[place]
        following = np.where(word < np.append(per_place, 0)[place + 1], offset[np.minimum(place + 1, len(per_place) - 1)] + word, count)
        following = np.append(following, count).astype(np.int32)
        codes = np.append(trie.of_char[self.chars], 0)
        last, node = np.arange(count, dtype=np.int32), np.zeros(count, np.int32)
        found = np.full((count, trie.longest), -1, np.int32)  # by last character and, longest first, length: the node
        for length in range(1, trie.longest + 1):
            to = trie.base[node] + codes[last]
            on = np.flatnonzero(trie.parent[to] == node)
            last, node = last[on], to[on]
            whole = np.flatnonzero(trie.piece[node] >= 0)
            found[last[whole], -length] = node[whole]
            last = following[last]
        found[:, -1][found[:, -1] < 0] = len(trie.piece) - 1  # unknown
        found = found.ravel()
        at = np.flatnonzero(found >= 0)
        self.node = found[at]
        self.gain = trie.gain[self.node]
        self.end = at // trie.longest  # the last character
        back = trie.longest - at % trie.longest
        before = np.concatenate([np.zeros(1, np.int64), len(words) + offset])  # of the points before the characters at a place
        place = place[self.end]
        self.start = before[place - back + 1] + self.end - offset[place]  # a point: words' beginnings, then those after each character
        self.first = np.searchsorted(self.end, np.arange(count + 1))
        self.stops = before[size[self.order]] + np.arange(len(words))  # the points at the words' ends
        self._forward(offset)

    def _forward(self, offset: np.ndarray) -> None:
        best = np.zeros(self.words + len(self.chars))
        self.through = np.empty(len(self.end))  # the best score from the start over an edge
        for low, high in zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True):
            a, b = self.first[low], self.first[high]
            self.through[a:b] = best[self.start[a:b]] + self.gain[a:b]
            best[self.words + low : self.words + high] = np.maximum.reduceat(self.through[a:b], self.first[low:high] - a)
        top = np.flatnonzero(self.through == best[self.words + self.end])
        new = np.ones(len(top), bool)
        new[1:] = self.end[top[1:]] != self.end[top[:-1]]
        self.chosen = top[new]  # the best edge to each character, the first of equal ones

    def walk(self, at: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
        """Along the best edges to the start: of each step the path, its number, the edge and the score behind it. Adds to `score`."""
        at, live, steps = at.copy(), np.flatnonzero(at >= self.words), []
        while len(live):
            edge = self.chosen[at[live] - self.words]
            steps.append((live, np.full(len(live), len(steps)), edge, score[live]))
            score[live] += self.gain[edge]
            at[live] = self.start[edge]
            live = live[at[live] >= self.words]
        return tuple(map(np.concatenate, zip(*steps, strict=True))) if steps else (*np.zeros((3, 0), np.int64), np.zeros(0))


def _least(word: np.ndarray, cost: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` least costs of each word, by word and cost; of equal ones the first."""
    order = np.lexsort((cost, word))
    own = word[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    first = np.flatnonzero(new)
    return order[np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own)))) < most]


def words_nbest(vocabulary: Vocabulary, trie: _Trie, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`word_nbest` of many words that are not empty: scores by word and way, missing ways at -inf; all ids; how many of each way."""
    lattice = _Lattice(trie, words)
    scores, sizes = np.full((len(words), n), -np.inf), np.zeros((len(words), n), np.int64)
    word, at, score = np.arange(len(words)), lattice.stops, np.zeros(len(words))
    parent, kept, edge = np.zeros((3, len(words)), np.int64)  # the path that it left, how many of its edges it kept, and its own first
    queue = None
    paths: list[tuple[np.ndarray, np.ndarray]] = []  # by way: where the edges of each word begin, and the edges from the end
    for way in range(n):
        lead = kept + (way > 0)  # edges before those of the walk
        path, step, top, behind = lattice.walk(at, score)
        counts = lead + np.bincount(path, minlength=len(word))
        first = _starts(counts)
        edges = np.empty(first[-1], np.int64)
        edges[first[path] + lead[path] + step] = top
        if way:
            edges[first[:-1] + kept] = edge
            for other in range(way):
                own = np.flatnonzero(parent == other)
                begins, others = paths[other]
                edges[_ranges(first[own], kept[own])] = others[_ranges(begins[word[own]], kept[own])]
        begins = np.zeros(len(words), np.int64)
        begins[word] = first[:-1]
        paths.append((begins, edges))
        scores[word, way], sizes[word, way] = score, counts
        if way + 1 == n:
            break
        point = lattice.end[top]
        ways = lattice.first[point + 1] - lattice.first[point]
        some = np.flatnonzero(ways > 1)
        ways, point = ways[some], point[some]
        taken = _ranges(lattice.first[point], ways)
        of = np.repeat(some, ways)
        other = taken != top[of]
        taken, of = taken[other], of[other]
        cost = -(behind[of] + lattice.through[taken])
        least = _least(word[path[of]], cost, n - way - 1)
        taken, of, cost = taken[least], of[least], cost[least]
        leaving = [word[path[of]], cost, np.full(len(of), way), (lead[path] + step)[of], taken, behind[of]]
        queue = leaving if queue is None else [np.concatenate(x) for x in zip(queue, leaving, strict=True)]
        order = _least(queue[0], queue[1], n)
        queue = [x[order] for x in queue]
        next_ = np.ones(len(order), bool)
        next_[1:] = queue[0][1:] != queue[0][:-1]
        word, _, parent, kept, edge, score = (x[next_] for x in queue)
        queue = [x[~next_] for x in queue]
        score, at = score + lattice.gain[edge], lattice.start[edge]
    to = np.empty_like(sizes)
    to[lattice.order] = np.arange(len(words) * n).reshape(len(words), n)  # ways in the order of the words as given
    back = np.argsort(lattice.order)
    scores, sizes = scores[back], sizes[back]
    ends = _starts(sizes.ravel())
    all_ = np.empty(ends[-1], np.int64)
    for way, (begins, edges) in enumerate(paths):
        own, last = sizes[:, way], ends[1:].reshape(-1, n)[:, way]
        behind = np.arange(own.sum()) - np.repeat(_starts(own)[:-1], own)
        all_[np.repeat(last - 1, own) - behind] = edges[_ranges(begins[back], own)]
    return scores, *_ids_of(vocabulary, trie, lattice, all_, sizes)


def _ids_of(vocabulary: Vocabulary, trie: _Trie, lattice: _Lattice, edges: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the edges, and how many there are in each way. An unknown character has those of its bytes."""
    ids = trie.piece[lattice.node[edges]]
    unknown = np.flatnonzero(ids < 0)
    if not len(unknown):
        return ids, sizes
    chars, which = np.unique(lattice.chars[lattice.end[edges[unknown]]], return_inverse=True)
    coded = [[vocabulary.bytes_[b] for b in chr(c).encode()] if vocabulary.bytes_ else [0] for c in chars.tolist()]
    long = np.ones(len(edges), np.int64)
    long[unknown] = np.array([len(x) for x in coded])[which]
    first = _starts(long)
    out = np.empty(first[-1], np.int32)
    out[first[:-1]] = ids
    table, begins = np.array([x for own in coded for x in own], np.int32), _starts(np.array([len(x) for x in coded]))
    out[_ranges(first[:-1][unknown], long[unknown])] = table[_ranges(begins[which], long[unknown])]
    return out, np.diff(first[_starts(sizes.ravel())]).reshape(sizes.shape)


def words_of(text: str) -> list[str]:
    """The text's words as the lattice sees them: marks, then all up to the next mark."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def loss(ways: list[tuple]) -> float:
    """What a word's second best segmentation loses; infinite where there is none."""
    return ways[0][0] - ways[1][0] if len(ways) > 1 else np.inf


def _changes(total: float, lost: np.ndarray, ways: Callable[[int], list[tuple]], n: int) -> list[tuple[float, dict[int, int]]]:
    """Of a text's n best the score, and the words that take another way than their best.

    total: the best score; lost: what each word's second way loses; ways: those of a word, by its place.
    """
    other = np.flatnonzero(lost < np.inf) if n > 1 else np.zeros(0, np.int64)
    if len(other) > n - 1:
        other = other[lost[other] <= np.partition(lost[other], n - 2)[n - 2]]
    at = sorted(other[np.argsort(lost[other], kind="stable")[: n - 1]].tolist())
    losses = [[ways(i)[0][0] - score for score, _ in ways(i)] for i in at]
    ranked = sorted((sum(x[k] for x, k in zip(losses, way, strict=True)), way) for way in product(*(range(len(x)) for x in losses)))
    return [(total - less, {i: k for i, k in zip(at, way, strict=True) if k}) for less, way in ranked[:n]]


def text_nbest(found: list[list[tuple]], n: int) -> list[tuple[float, dict[int, int]]]:
    """`_changes` of words given with their n best each."""
    return _changes(sum(w[0][0] for w in found), np.array([loss(w) for w in found]), found.__getitem__, n)


def decode(vocabulary: Vocabulary, ids) -> str:
    out, raw = [], bytearray()
    for i in ids:
        if i in vocabulary.byte_of:
            raw.append(vocabulary.byte_of[i])
            continue
        if raw:
            out.append(raw.decode(errors="replace"))
            raw = bytearray()
        out.append(vocabulary.text_of[i])
    out.append(raw.decode(errors="replace"))
    return "".join(out).replace(MARK, " ")[1:]


class _Words(dict):
    """Numbers of the words of late; by number, in flat arrays, the scores and ids of n ways each, missing ways at -inf."""

    def __init__(self, vocabulary: Vocabulary, n: int, old: _Words | None = None):
        super().__init__()
        self.vocabulary, self.n, self.old = vocabulary, n, old
        self.trie = old.trie if old else _trie(vocabulary)
        self.score, self.ids, self.ends = array("d"), array("i"), array("q", [0])

    def ways(self, number: int) -> list[tuple[float, array]]:
        """The ways of a word, with their ids."""
        at = range(self.n * number, self.n * number + self.n)
        return [(self.score[i], self.ids[self.ends[i] : self.ends[i + 1]]) for i in at if self.score[i] > -np.inf]

    def __missing__(self, word: str) -> int:
        known = None if self.old is None else self.old.get(word)
        ways = word_nbest(self.vocabulary, word, self.n) if known is None else self.old.ways(known)
        for score, ids in ways:
            self.score.append(score)
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
        for _ in range(self.n - len(ways)):
            self.score.append(-np.inf)
            self.ends.append(len(self.ids))
        self[word] = number = len(self)
        return number

    def _add(self, words: list[str], scores: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        last = self.ends[-1]
        self.update(zip(words, range(len(self), len(self) + len(words)), strict=True))
        self.score.frombytes(scores.astype(np.float64).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.ends.frombytes((np.cumsum(sizes.ravel()) + last).astype(np.int64).tobytes())

    def learn(self, words: set[str]) -> None:
        """Those of the words that are not known are searched together, or taken from the older memory."""
        new = words.difference(self)
        if self.old is not None:
            again = [w for w in new if w in self.old]
            if again:
                at = self.n * np.array([self.old[w] for w in again], np.int64)
                ends = np.frombuffer(self.old.ends, np.int64)
                ways = at[:, None] + np.arange(self.n)
                sizes = ends[ways + 1] - ends[ways]
                ids = np.frombuffer(self.old.ids, np.int32)[_ranges(ends[at], sizes.sum(axis=1))]
                self._add(again, np.frombuffer(self.old.score)[ways], ids, sizes)
                new.difference_update(again)
        some, held = [], 0
        for word in new:
            if 0 < len(word) <= LONG:
                some.append(word)
                held += len(word)
                if held > LEARNED:
                    self._add(some, *words_nbest(self.vocabulary, self.trie, some, self.n))
                    some, held = [], 0
        if some:
            self._add(some, *words_nbest(self.vocabulary, self.trie, some, self.n))

    def renewed(self) -> _Words:
        """An empty one that remembers the words of this one, but no older ones."""
        self.old = None
        return _Words(self.vocabulary, self.n, self)


_words: dict[tuple[str, int], _Words] = {}  # of a worker, for its next tasks


def _ways(words: _Words, text: str, n: int, own: list[str] | None = None) -> tuple[list[float], list[bytes]]:
    """Scores and ids of a text's n best segmentations. own: its words, if known."""
    number = np.array(list(map(words.__getitem__, words_of(text) if own is None else own)), np.int64)
    if not len(number):
        return [0.0], [b""]
    scores_of, ends = np.frombuffer(words.score), np.frombuffer(words.ends, np.int64)
    score, first = scores_of[n * number], ends[n * number]
    lost = score - scores_of[n * number + 1] if n > 1 else score
    size = ends[n * number + 1] - first
    stops = np.cumsum(size)
    best = np.frombuffer(words.ids, np.int32)[np.arange(stops[-1]) + np.repeat(first - (stops - size), size)].tobytes()
    scores, ids = [], []
    for total, other in _changes(float(score.sum()), lost, lambda i: words.ways(number[i]), n):
        parts, done = [], 0
        for i, k in other.items():
            parts += [best[done : 4 * (stops[i] - size[i])], words.ways(number[i])[k][1].tobytes()]
            done = 4 * stops[i]
        scores.append(total)
        ids.append(b"".join([*parts, best[done:]]))
    return scores, ids


def _learned(words: _Words, column: pa.Array, row: int) -> list[list[str]]:
    """The words of the texts from a row on, some texts together, the last text's first; all are learned."""
    found, held = [], 0
    while row < len(column) and held < READ:
        text = column[row].as_py() or ""
        found.append(words_of(text))
        held += len(text)
        row += 1
    words.learn(set().union(*found))
    return found[::-1]


def _lists(parts: list[list], values: pa.Array | list) -> pa.Array:
    """One list of `values` for each part, as long as it."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), values)


def _encode(model: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (model, n) not in _words:
            _words[model, n] = _Words(_table(model)[0], n)
        words = _words[model, n]

        def batch_of(rows: pa.RecordBatch) -> pa.RecordBatch:
            flat = [x for way in ids for x in way]
            ends = pa.array(np.cumsum([0, *map(len, flat)]) // 4, pa.int32())
            segmentations = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(flat), np.int32)))
            totals = pa.array([x for way in scores for x in way], pa.float64())
            return pa.RecordBatch.from_arrays([*rows.columns, _lists(scores, totals), _lists(ids, segmentations)], ["id", "text", "scores", "ids"])

        for batch in batches:
            low, held, scores, ids, ready = 0, 0, [], [], []
            for row, text in enumerate(batch.column(1)):
                if not ready:
                    ready = _learned(words, batch.column(1), row)
                totals, coded = _ways(words, text.as_py() or "", n, ready.pop())
                scores.append(totals)
                ids.append(coded)
                held += sum(map(len, coded))
                if held > SENT_BYTES:
                    yield batch_of(batch.slice(low, row + 1 - low))
                    low, held, scores, ids = row + 1, 0, [], []
                if not ready and len(words) > CACHED_WORDS:
                    words = _words[model, n] = words.renewed()
            if ids:
                yield batch_of(batch.slice(low))

    return run


def _texts(vocabulary: Vocabulary, table: pa.Array, ways: pa.ListArray) -> pa.Array:
    """The texts of lists of ids; table: the bytes that each id stands for."""
    taken = table.take(ways.flatten())
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    edges = ends[ways.offsets.to_numpy() - ways.offsets[0].as_py()]
    texts = pa.Array.from_buffers(pa.large_binary(), len(ways), [None, pa.py_buffer(np.ascontiguousarray(edges)), taken.buffers()[2]])
    data = np.frombuffer(taken.buffers()[2] or b"", np.uint8)
    some = edges[:-1] < edges[1:]
    heads = edges[:-1][some]
    if (data[heads] == ord(" ")).all():
        rest = np.ones(len(data), bool)
        rest[heads] = False
        rest[edges[-1] :] = False
        rest[: edges[0]] = False
        ends = edges - edges[0] - np.append(0, np.cumsum(some))
        buffers = [None, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(data[rest])]
        try:
            return pa.Array.from_buffers(pa.large_binary(), len(ways), buffers).cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8: replaced, as the piece model's own decoder does
            pass
    return pa.array([_text(vocabulary, x.as_py(), way) for x, way in zip(texts, ways, strict=True)], pa.string())


def _text(vocabulary: Vocabulary, data: bytes, way: pa.ListScalar) -> str:
    try:
        return data.decode().replace(MARK, " ")[1:]
    except UnicodeDecodeError:
        return decode(vocabulary, way.as_py())


_tables: dict[str, tuple[Vocabulary, pa.Array]] = {}  # of a worker, for its next tasks


def _table(model: str) -> tuple[Vocabulary, pa.Array]:
    """The vocabulary, and the bytes that each id stands for."""
    if model not in _tables:
        vocabulary = read_vocabulary(model)
        of = [bytes([vocabulary.byte_of[i]]) if i in vocabulary.byte_of else x.replace(MARK, " ").encode() for i, x in enumerate(vocabulary.text_of)]
        _tables[model] = vocabulary, pa.array(of, pa.large_binary())
    return _tables[model]


def _decode(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table = _table(model)
        for batch in batches:
            held = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)) // SENT_BYTES
            edges = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if high > low:
                    part = batch.slice(low, high - low)
                    ways = part.column(3)
                    texts = pa.ListArray.from_arrays(pc.subtract(ways.offsets, ways.offsets[0]), _texts(vocabulary, table, ways.flatten()))
                    yield pa.RecordBatch.from_arrays([*part.columns, texts], [*batch.schema.names, "decoded"])

    return run


_COLUMNS = "text string, scores array<double>, ids array<array<int>>"


def _on_texts(docs: DataFrame, id_column: str, text: str, run: Callable, columns: str) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, {columns}")


def encode(docs: DataFrame, model: str, n: int = BEST, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text, scores and ids (of the n best segmentations, best first). model: a file that every executor can read."""
    return _on_texts(docs, id_column, text, _encode(model, n), _COLUMNS)


def decoded(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of `encode` with `decoded`, the texts of the segmentations."""
    return encoded.mapInArrow(_decode(model), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.ArrayType(T.StringType()))]))


def round_trip(docs: DataFrame, model: str, n: int = BEST, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`decoded` of `encode` in one pass over the texts."""
    encode_, decode_ = _encode(model, n), _decode(model)
    return _on_texts(docs, id_column, text, lambda batches: decode_(encode_(batches)), f"{_COLUMNS}, decoded array<string>")
