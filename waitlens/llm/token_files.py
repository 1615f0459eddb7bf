"""Token ids of a corpus as Arrow files of equal-length sequences, and random access to them.

Documents are sorted by id into ranges. A task writes its range as one stream of ids, each document closed by an end id, cut
into sequences of equal length, the last one padded. A file holds record batches of fixed-size lists: `ids`, `mask` (not
padding) and `ends` (the last id of a document). Beside it a second file lists the documents: id, first place in the stream
and number of ids. Ids are 16-bit where the vocabulary allows, else 32-bit. Every batch but the last has the same number of
sequences, so any sequence, and any stretch of ids, is found by division; from a memory map it is read without a copy.

Files are written by the tasks themselves through pyarrow's file systems (local, HDFS, S3, GCS, ...), under names of the
attempt, so a task that is repeated leaves the files of its first attempt alone; which files count says the table of parts,
a row for each, written by Spark when all have ended. Orphans stay for the cluster to clean.

The ids are those of the tokenizers library for the whole text, `add_special_tokens` off; special tokens spelled out in a text
become their id, as there. For a byte-level tokenizer without normalizer, a text falls apart before every space that stands
before a character other than white space, and the library's ids of the parts, in order, are its ids of the text. So a
worker asks the library for each different part of late just once, and no text needs to be encoded in one go. Texts of any
other tokenizer are encoded whole.

Defined cases. Null or empty text: the end id alone. Null ids come first; rows that share an id come by the hash of the text,
then the text. Repeated rows are documents of their own. An empty table gives no files and no rows. A part without any space
is encoded in one go, however long it is.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.work import stored, work_folder

END = 2
LENGTH = 2048
SEQUENCES = 256
#: Bytes of parts and their ids that a worker remembers, and characters of a text that are cut at a time.
MEMORY = 128 << 20
SLICE = 1 << 20
_JOINED = 64
_PART_COST = 200  # bytes of a remembered part besides its own characters
#: Letters in every version of Unicode that a tokenizer may know.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ʯ]+"
_MARKS = r"[!-/:-@\[-`{-~]*"
_WORD = re.compile(f"(?<![^ ]){_LETTERS}(?![^ ])")
#: A word with marks, and after a line break another one. The library cuts at each of these groups.
_MARKED = re.compile(f"({_LETTERS})({_MARKS})(?:(\n)({_LETTERS})({_MARKS}))?")


_models: dict[str, tuple] = {}  # of a worker, for its next tasks
_encoders: dict[str, Encoder] = {}


def _model(path: str) -> tuple:
    """The tokenizer, whether texts may be cut, a pattern of its added tokens, which ids begin with a space, and which is a line
    break."""
    if path not in _models:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = Tokenizer.from_file(path)
        spec = json.loads(model.to_str())
        split = spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        cut = not spec["normalizer"] and split.get("type") == "ByteLevel" and split.get("use_regex") and not split["add_prefix_space"]
        cut = cut and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or " " in a["content"] for a in added)
        spelled = sorted((a["content"] for a in added), key=len, reverse=True)
        vocabulary = model.get_vocab(with_added_tokens=True)
        spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        _models[path] = (model, bool(cut), re.compile(f"({'|'.join(map(re.escape, spelled))})") if spelled else None, spaced, vocabulary.get("Ċ", -1))
    return _models[path]


class Encoder:
    """Ids of texts as bytes. It remembers the parts of late, in two halves bounded by bytes; the older one is given up when
    the younger is full."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.model, self.cut, self.added, self.spaced, self.line = _model(path)
        self.kind = np.dtype("<u2" if len(self.spaced) <= 1 << 16 else "<u4")
        self.memory, self.held = memory, 0
        self.known: dict[str, bytes | None] = {}  # by part, without the space before it
        self.older: dict[str, bytes | None] = {}
        self.heads: dict[str, bytes] = {}  # parts without a space before them

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(c.ids, self.kind) for c in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _head(self, text: str) -> bytes:
        if not text:
            return b""
        if text not in self.heads:
            self.heads[text] = self._ids([text])[0].tobytes()
            self.held += 3 * len(text) + _PART_COST
        return self.heads[text]

    def _words(self, words: list[str], between: str, begins: np.ndarray) -> Iterator[tuple[str, bytes]]:
        """Ids of words of letters, each behind `between`. They go to the library together and are told apart by the ids that begin
        with it; where these are not as many as the words, one by one. A space is part of a word's ids, a line break is not."""
        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        size, spaced = self.kind.itemsize, between == " "
        for group, ids in zip(groups, self._ids([between + between.join(g) for g in groups]), strict=True):
            starts = np.flatnonzero(begins[ids]) * size
            if len(starts) != len(group) or starts[0]:
                yield from zip(group, [own.tobytes() for own in self._ids([between * spaced + w for w in group])], strict=True)
                continue
            raw, stops = ids.tobytes(), [*starts[1:].tolist(), len(ids) * size]
            yield from zip(group, map(raw.__getitem__, map(slice, (starts + size * (not spaced)).tolist(), stops)), strict=True)

    def _learn(self, parts: set[str]) -> None:
        """A part's words, marks and line break are ids of their own. Empty parts, and those that begin with white space, are no
        parts by themselves: None."""
        known, older, alone, marked = self.known, self.older, [], []
        text = " ".join(parts)
        words = set(_WORD.findall(text))
        for part in parts.difference(words):
            if not part or part[0].isspace():
                known[part] = None
            elif found := _MARKED.fullmatch(part):
                marked.append((part, *found.groups()))
            else:
                alone.append(part)
        cores = {x[1] for x in marked}.difference(known, words)
        again = {core: older[core] for core in cores if core in older}
        known.update(again)
        words.update(cores.difference(again))
        known.update(self._words(list(words), " ", self.spaced))
        behind = {x[4] for x in marked if x[4]}.difference(self.heads)
        line = np.zeros(len(self.spaced), bool)
        line[self.line] = self.line >= 0
        self.heads.update(self._words(list(behind), "\n", line))
        known.update(zip(alone, [ids.tobytes() for ids in self._ids([" " + p for p in alone])], strict=True))
        head, heads = self._head, self.heads
        known.update(
            [
                (part, known[core] + (head(marks + broken) + heads[word] + head(last) if broken else head(marks)))
                for part, core, marks, broken, word, last in marked
            ]
        )
        self.held += 3 * len(text) + _PART_COST * (len(parts) + len(cores) + len(behind)) + 3 * sum(map(len, behind))

    def _known(self, wanted: set[str]) -> dict[str, bytes]:
        missing = wanted.difference(self.known)
        if missing and self.held > self.memory // 2:
            self.older, self.known, self.heads, self.held, missing = self.known, {}, {}, 0, wanted
        if missing:
            older = self.older
            again = {part: older[part] for part in missing if part in older}
            self.known.update(again)
            self.held += 3 * sum(map(len, again)) + _PART_COST * len(again)
            self._learn(missing.difference(again))
        return self.known

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The text at its spaces, a slice at a time; the first part of a slice has no space before it, the others have one."""
        low = 0
        while low < len(text):
            high = low + SLICE
            while high < len(text):
                high = text.find(" ", high)
                if high < 0:
                    high = len(text)
                elif high + 1 < len(text) and not text[high + 1].isspace():
                    break
                else:
                    high += 1
            yield text[low:high].split(" ")
            low = high

    def _coded(self, slices: list[list[str]]) -> Iterator[bytes]:
        known = self._known(set().union(*slices))
        for parts in slices:
            rest = iter(parts)
            first = next(rest)
            try:
                ids = b"".join(map(known.__getitem__, rest))
            except TypeError:  # more than one space: all but the last belong to the part before
                merged = [first]
                for part in parts[1:]:
                    if known[part] is None:
                        merged[-1] += " " + part
                    else:
                        merged.append(part)
                first = merged[0]
                ids = b"".join(map(self._known(set(merged[1:])).__getitem__, merged[1:]))
            yield (self._head(first) if first else b"") + ids

    def _spelled(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def _one(self, text: str) -> Iterator[bytes]:
        """The ids of one text, a slice at a time, cut at the added tokens in it: every other run is such a token."""
        for n, run in enumerate(self.added.split(text) if self._spelled(text) else [text]):
            if n % 2:
                yield self._ids([run])[0].tobytes()
            else:
                for parts in self._cut(run):
                    yield from self._coded([parts])

    def _together(self, texts: list[str]) -> list[bytes]:
        """The ids of some texts that are not empty: each different part is looked up once, and their ids are laid side by side."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        firsts = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        whole = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        parts = pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")  # none of them has a space
        at = coded.indices.to_numpy()
        own = list(map(self._known(set(parts)).__getitem__, parts))
        gaps = np.zeros(len(own), bool)
        if None in own:
            gaps[:] = [ids is None for ids in own]
            own = [ids or b"" for ids in own]
        size = np.fromiter(map(len, own), np.int64, len(own)) // self.kind.itemsize
        begins = np.cumsum(size) - size
        sizes = size[at]
        sizes[firsts[:-1]] = 0  # it has no space before it
        stops = np.cumsum(sizes)
        ids = np.frombuffer(b"".join(own), self.kind)[np.arange(stops[-1]) + np.repeat(begins[at] - (stops - sizes), sizes)].tobytes()
        edges = (np.append(0, stops)[firsts] * self.kind.itemsize).tolist()
        gaps = gaps[at]
        gaps[firsts[:-1]] = False
        odd = np.append(0, np.cumsum(gaps))[firsts]
        odd = (odd[1:] > odd[:-1]).tolist()  # more than one space in a row, or a space at the end
        heads = [parts[i] for i in at[firsts[:-1]].tolist()]
        return [
            next(self._coded([text.split(" ")])) if odd[i] else self._head(heads[i]) + ids[edges[i] : edges[i + 1]]
            for i, text in enumerate(texts)
        ]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. Short texts are looked up together, long ones a slice at a time."""
        if not self.cut:
            yield from (self._ids([text])[0].tobytes() for text in texts)
            return
        short = [bool(t) and len(t) <= SLICE and not self._spelled(t) for t in texts]
        codes = iter(self._together([t for t, one in zip(texts, short, strict=True) if one]) if any(short) else [])
        for text, one in zip(texts, short, strict=True):
            yield next(codes) if one else b"".join(self._one(text))


def _some(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that are looked up together: as many as are in a megabyte, one at least."""
    held = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE
    edges = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(texts)]
    return zip(edges[:-1], edges[1:], strict=True)


class _Writer:
    """One part: a stream of ids as batches of sequences."""

    def __init__(self, folder: str, name: str, kind: np.dtype, id_type: pa.DataType, length: int, sequences: int):
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        self.paths = [f"{folder}/{what}-{name}.arrow" for what in ("ids", "docs")]
        self.outs = [files.open_output_stream(f"{root}/{what}-{name}.arrow") for what in ("ids", "docs")]
        self.kind, self.id, self.length, self.batch = kind, pa.from_numpy_dtype(kind), length, length * sequences
        flags = pa.list_(pa.bool_(), length)
        self.lists = pa.schema([("ids", pa.list_(self.id, length)), ("mask", flags), ("ends", flags)])
        self.listed = pa.schema([("doc_id", id_type), ("first", pa.int64()), ("n_tokens", pa.int64())])
        self.files = [pa.ipc.new_file(out, schema) for out, schema in zip(self.outs, (self.lists, self.listed), strict=True)]
        self.held, self.ends, self.written, self.docs = bytearray(), [], 0, 0

    @property
    def total(self) -> int:
        return self.written + len(self.held) // self.kind.itemsize

    def add(self, doc_ids: pa.Array, coded: list[bytes]) -> None:
        firsts, counts = [], []
        for ids in coded:
            firsts.append(self.total)
            counts.append(len(ids) // self.kind.itemsize)
            self.held += ids
            self.ends.append(self.total - 1)
            if len(self.held) >= self.batch * self.kind.itemsize:
                self._flush(whole=True)
        columns = [doc_ids, pa.array(firsts, pa.int64()), pa.array(counts, pa.int64())]
        self.files[1].write_batch(pa.record_batch(columns, schema=self.listed))
        self.docs += len(coded)

    def _flush(self, whole: bool) -> None:
        """Whole batches, or all that is left with padding."""
        ids = np.frombuffer(bytes(self.held), self.kind)
        done = 0
        ends = np.array(self.ends, np.int64) - self.written
        while len(ids) - done >= self.batch or (not whole and done < len(ids)):
            own = ids[done : done + self.batch]
            size = -(-len(own) // self.length) * self.length
            mask, closed = np.zeros(size, bool), np.zeros(size, bool)
            mask[: len(own)] = True
            closed[ends[(ends >= done) & (ends < done + len(own))] - done] = True
            padded = np.concatenate([own, np.zeros(size - len(own), self.kind)]) if size > len(own) else own
            values = [pa.array(padded), pa.array(mask), pa.array(closed)]
            lists = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in values]
            self.files[0].write_batch(pa.record_batch(lists, schema=self.lists))
            done += len(own)
        self.ends = [e for e in self.ends if e >= self.written + done]
        self.written += done
        self.held = bytearray(self.held[done * self.kind.itemsize :])

    def close(self) -> dict:
        self._flush(whole=False)
        for file, out in zip(self.files, self.outs, strict=True):
            file.close()
            out.close()
        return {"ids": self.paths[0], "docs": self.paths[1], "n_docs": self.docs, "n_ids": self.total}


_PART = "part int, ids string, docs string, n_docs long, n_ids long"
_PART_TYPE = pa.schema([("part", pa.int32()), ("ids", pa.string()), ("docs", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _write(folder: str, tokenizer: str, end: int, length: int, sequences: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer = None, None
        task = TaskContext.get()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
                last = np.array([end], encode.kind).tobytes()
                name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
                writer = _Writer(folder, name, encode.kind, batch.schema.field(0).type, length, sequences)
            for low, high in _some(batch.column(1)):
                some = batch.slice(low, high - low)
                writer.add(some.column(0), [ids + last for ids in encode([t or "" for t in some.column(1).to_pylist()])])
        if writer is not None:
            yield pa.RecordBatch.from_pylist([{"part": task.partitionId()} | writer.close()], _PART_TYPE)

    return run


def write(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    end: int = END,
    length: int = LENGTH,
    sequences: int = SEQUENCES,
) -> DataFrame:
    """Writes the files and gives the table of parts in the order of ids: part, ids, docs (paths), n_docs, n_ids, start (ids
    of all parts before it). tokenizer: a file that every executor can read. folder: one that all executors share."""
    folder = folder or f"{work_folder(docs.sparkSession)}/tokens"
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    key = F.xxhash64("text")
    ranged = rows.repartitionByRange(F.asc_nulls_first("id"), key).sortWithinPartitions(F.asc_nulls_first("id"), key, "text")
    parts = stored(ranged.mapInArrow(_write(folder, tokenizer, end, length, sequences), _PART))
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each part
    return parts.withColumn("start", F.coalesce(before, F.lit(0)))


class TokenFile:
    """Random access to the ids of one part; in a local folder by memory map, without copies."""

    def __init__(self, path: str):
        files, place = fs.FileSystem.from_uri(path)
        self.source = pa.memory_map(place) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(place)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.sequences = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self.number, self.now = -1, None

    def batch(self, number: int) -> pa.RecordBatch:
        if number != self.number:
            self.number, self.now = number, self.file.get_batch(number)
        return self.now

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Ids, mask and ends of one sequence."""
        batch, row = self.batch(number // self.sequences), number % self.sequences
        ids, mask, ends = (batch.column(c).slice(row, 1).flatten() for c in ("ids", "mask", "ends"))
        return ids.to_numpy(zero_copy_only=True), mask, ends

    def ids(self, first: int, n: int) -> np.ndarray:
        """A stretch of the stream; a view where it lies in one batch."""
        size, found = self.sequences * self.length, []
        while n > 0:
            own = self.batch(first // size).column("ids").flatten().to_numpy(zero_copy_only=True)[first % size :][:n]
            found.append(own)
            first, n = first + len(own), n - len(own)
        return found[0] if len(found) == 1 else np.concatenate(found)

    def ends(self) -> np.ndarray:
        """Places of all documents' last ids."""
        size, found = self.sequences * self.length, [np.zeros(0, np.int64)]
        for number in range(self.file.num_record_batches):
            flags = self.file.get_batch(number).column("ends").flatten().to_numpy(zero_copy_only=False)
            found.append(np.flatnonzero(flags) + number * size)
        return np.concatenate(found)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.to_pylist():
            tokens, at = TokenFile(part["ids"]), 0
            ends = tokens.ends()
            files, place = fs.FileSystem.from_uri(part["docs"])
            with files.open_input_file(place) as source, pa.ipc.open_file(source) as docs:
                for number in range(docs.num_record_batches):
                    own = docs.get_batch(number)
                    firsts, counts = (own.column(c).to_numpy() for c in ("first", "n_tokens"))
                    if not np.array_equal(ends[at : at + len(firsts)], firsts + counts - 1):
                        raise ValueError(f"{part['ids']} and {part['docs']} do not agree")
                    at += len(firsts)
                    sums = [zlib.crc32(tokens.ids(a, n).astype("<u4").tobytes()) for a, n in zip(firsts.tolist(), counts.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [own.column("doc_id"), pa.array(firsts + part["start"]), own.column("n_tokens"), pa.array(sums, pa.int64())],
                        ["id", "start", "n_tokens", "ids_crc32"],
                    )


def read(parts: DataFrame, id_type: str = "bigint", id_column: str = "doc_id") -> DataFrame:
    """Of each document, from the files: the id, start in the whole stream, n_tokens with the end id, ids_crc32."""
    spread = parts.repartition(max(1, parts.count()))  # a task for each file
    found = spread.mapInArrow(_read, f"id {id_type}, start long, n_tokens long, ids_crc32 long")
    return found.withColumnRenamed("id", id_column)


def round_trip(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents written, and read back."""
    return read(stored(write(docs, tokenizer, id_column=id_column, **options)), docs.schema[id_column].dataType.simpleString(), id_column)
