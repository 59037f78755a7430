"""Token ids of a corpus in binary files, document after document in the order of their ids.

**Files.** Documents are range-partitioned by id and sorted, so partition after partition and
file after file hold one long array of token ids. A file holds the ids of some 4 million tokens,
always of whole documents, then two Elias-Fano lists, where its documents end and which ids they have, and a
footer of fixed size. Ids take 2 bytes where the vocabulary allows, else 4. Offsets come from
select on the ends; there is no table of 64-bit offsets. Files are written by Spark's own writer,
which commits the output of one attempt of each task on any file system.

**Encoding.** BPE with byte-level pre-tokens never joins anything across a space that stands before a
letter or digit, so texts are cut there and each distinct piece of some MB of text is encoded
once, many in one call, parted by line breaks. Tokenizers of other kinds encode whole texts. The result is that of the whole text
either way, and the memory that of pieces, however long a text is.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.elias_fano import EliasFano

MAGIC, VERSION = b"TOKENIDS", 1
# Magic, version, bytes per id, partition, file in it, tokens before the file in its partition, tokens,
# documents, documents without an id, smallest id.
_FOOTER = struct.Struct("<8sBBIIQQQQq")
_END = b"\n"
FILE_TOKENS = 4 << 20
# Pieces of one call, and characters that are encoded together.
_GROUP, _SLICE = 50, 8 << 20
# Words a worker remembers.
_KNOWN = 600_000
# Encoders of this process, for all its tasks.
_ENCODERS: dict[tuple[bytes, int], Encoder] = {}
# A word of letters that all versions of Unicode have as such, and the marks behind it. An apostrophe may begin
# a pre-token that goes on with letters.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_WORD = rf'^(?P<word>[{_LETTERS}]+)(?P<mark>(?:[!-&(-/:-@\[-`{{-~][!-/:-@\[-`{{-~]*)?)$'
# Pieces without white space but single line breaks inside, so that nothing runs into what stands next to them.
_PRINTED = rf"^[!-~{_LETTERS}]+(?:\n[!-~{_LETTERS}]+)*$"
_CUT = re.compile(r" (?=[^\W_])")
_UNSAFE = re.compile(r" (?![^\W_])")
_DOCUMENTS = "part int, start_in_part long, doc long, n_tokens long, ids_crc32 long"


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer's file content and the id that ends a document; sent with the tasks."""

    tokenizer: str
    end_id: int

    @property
    def in_pieces(self) -> bool:
        """True for byte-level BPE that may be cut before words."""
        spec = json.loads(self.tokenizer)
        split = spec.get("pre_tokenizer") or {}
        return (
            spec.get("normalizer") is None and spec["model"]["type"] == "BPE" and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space") and split.get("use_regex", True)
        )


def load_vocabulary(path: str, end_id: int) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read(), end_id)


class Encoder:
    """Encodes texts to little-endian ids; the strings of special tokens are ordinary text."""

    def __init__(self, vocabulary: Vocabulary):
        # One thread per task: Spark deals out the cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(vocabulary.tokenizer)
        self.tokenizer.encode_special_tokens = True
        largest = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, vocabulary.end_id)
        self.dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.end = np.array([vocabulary.end_id], self.dtype).tobytes()
        line = self._ids(self.tokenizer, ["\n"])[0]
        self.in_pieces = vocabulary.in_pieces and len(line) == 1
        none = np.empty(0, np.int64)
        self.known = pa.array([], pa.large_string()), (none, none, none)
        if self.in_pieces:
            self.line = line[0]
            # The same vocabulary and merges for words that are one pre-token each.
            self.words = Tokenizer.from_str(vocabulary.tokenizer)
            self.words.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.Split("\n", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )

    @staticmethod
    def of(vocabulary: Vocabulary) -> Encoder:
        """This process's encoder of the vocabulary."""
        key = hashlib.sha256(vocabulary.tokenizer.encode("utf-8")).digest(), vocabulary.end_id
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(vocabulary)
        return _ENCODERS[key]

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text in parts, the end not among them."""
        at = 0
        while self.in_pieces and len(text) - at > _SLICE:
            cut = _CUT.search(text, at + _SLICE)
            if cut is None:
                break
            yield self.encode_all([text[at : cut.start()]])[0]
            at = cut.start()
        yield self.encode_all([text[at:] if at else text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of some texts, or slices of texts, that are short together.

        The texts' pieces are numbered and each distinct one is encoded once; the ids are then put
        together for all texts at a time. Nothing is done piece by piece but by the tokenizer.
        """
        if not self.in_pieces:
            return [np.array(x, self.dtype).tobytes() for x in self._ids(self.tokenizer, texts)]
        if not texts:
            return []
        pieces, bounds = _pieces(texts)
        numbered = pieces.dictionary_encode()
        distinct, number = numbered.dictionary, numbered.indices.to_numpy()
        flat, starts, sizes = self._spaced(distinct)
        # The space goes to the piece behind it; the first piece of a text has none and is encoded by itself.
        first = self._ids(self.tokenizer, distinct.take(pa.array(number[bounds[:-1]])).to_pylist())
        own = np.fromiter(map(len, first), np.int64, len(first))
        starts, sizes = starts[number], sizes[number]
        starts[bounds[:-1], 0], sizes[bounds[:-1]] = len(flat) + np.cumsum(own) - own, np.column_stack([own, 0 * own])
        flat = np.concatenate([flat, _array(first, int(own.sum()))])
        counts = sizes.ravel()
        ends = np.cumsum(counts)
        at = np.repeat(starts.ravel() - (ends - counts), counts)
        at += np.arange(len(at))
        ids = flat[at].astype(self.dtype).tobytes()
        cuts = (np.append(0, ends)[2 * bounds] * self.dtype.itemsize).tolist()
        return [ids[i:j] for i, j in itertools.pairwise(cuts)]

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, distinct: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces with a space before each: all ids, and for each piece two runs of them, start and length.

        Plain words need no pattern to be cut into pre-tokens, and marks behind a word are
        a pre-token of their own; a word is encoded once, with whatever marks it comes.
        """
        parsed = pc.extract_regex(distinct, _WORD)
        plain = parsed.is_valid().to_numpy(zero_copy_only=False)
        rest = distinct.filter(pc.invert(parsed.is_valid()))
        near = pc.match_substring_regex(rest, _PRINTED).to_numpy(zero_copy_only=False)
        lines = rest.filter(pa.array(near))
        words = parsed.field("word").filter(parsed.is_valid()).dictionary_encode()
        marks = parsed.field("mark").filter(parsed.is_valid()).dictionary_encode()
        tables = [
            self._plain(words.dictionary),
            self._apart(marks.dictionary.to_pylist()),
            self._together(self.tokenizer, lines.to_pylist(), pc.count_substring(lines, "\n").to_numpy()),
            self._apart([" " + x for x in rest.filter(pa.array(~near)).to_pylist()]),
        ]
        offsets = np.cumsum([0] + [len(t[0]) for t in tables])
        starts, sizes = np.zeros((len(distinct), 2), np.int64), np.zeros((len(distinct), 2), np.int64)
        others = np.flatnonzero(~plain)
        for k, (rows, run, which) in enumerate((
            (np.flatnonzero(plain), 0, words.indices.to_numpy()), (np.flatnonzero(plain), 1, marks.indices.to_numpy()),
            (others[near], 0, slice(None)), (others[~near], 0, slice(None)),
        )):
            starts[rows, run] = tables[k][1][which] + offsets[k]
            sizes[rows, run] = tables[k][2][which]
        return np.concatenate([t[0] for t in tables]), starts, sizes

    def _plain(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts and lengths of distinct plain words; words met lately are not encoded again."""
        known, (flat, starts, sizes) = self.known
        at = pc.index_in(words, value_set=known)
        new = words.filter(at.is_null())
        more, new_starts, new_sizes = self._together(self.words, new.to_pylist())
        new_starts = new_starts + len(flat)
        table = (np.append(flat, more), np.append(starts, new_starts), np.append(sizes, new_sizes))
        place = at.to_numpy(zero_copy_only=False).copy()
        place[at.is_null().to_numpy(zero_copy_only=False)] = len(known) + np.arange(len(new))
        place = place.astype(np.int64)
        found = table[0], table[1][place], table[2][place]
        if len(known) + len(new) <= _KNOWN:
            self.known = pa.concat_arrays([known, new]), table
        else:
            # Only the words of these texts are kept, and their ids put together.
            ends = np.cumsum(found[2])
            first = ends - found[2]
            kept = found[0][np.repeat(found[1] - first, found[2]) + np.arange(int(ends[-1]))]
            self.known = words, (kept, first, found[2])
        return found

    def _together(
        self, tokenizer, pieces: list[str], breaks: np.ndarray | int = 0
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts and lengths of pieces, each with a space before it, many in one call, parted by
        line breaks; ``breaks`` counts those a piece has itself."""
        runs = []
        for first in range(0, len(pieces), 400 * _GROUP):
            part = pieces[first : first + 400 * _GROUP]
            found = self._ids(tokenizer, [" " + "\n ".join(part[i : i + _GROUP]) for i in range(0, len(part), _GROUP)])
            for ids in found:
                ids.append(self.line)
            runs.append(_array(found, sum(map(len, found))))
        flat = np.concatenate(runs) if runs else np.empty(0, np.int64)
        stops = np.flatnonzero(flat == self.line)
        wanted = np.cumsum(np.ones(len(pieces), np.int64) + breaks)
        if len(stops) != (wanted[-1] if len(wanted) else 0):
            raise ValueError("the tokenizer joins pieces across line breaks")
        stops = stops[wanted - 1]
        starts = np.append(0, stops[:-1] + 1)[: len(stops)]
        return flat, starts, stops - starts

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of any texts, one by one."""
        found = [ids for i in range(0, len(texts), 5000) for ids in self._ids(self.tokenizer, texts[i : i + 5000])]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return _array(found, int(sizes.sum())), np.cumsum(sizes) - sizes, sizes


def _array(found: list[list[int]], size: int) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(found), np.int64, size)


def _pieces(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The texts cut at their spaces, but at none that a token might reach over, and each text's bounds."""
    split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    pieces, bounds = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    unsafe = [i for i, text in enumerate(texts) if _UNSAFE.search(text) is not None]
    if not unsafe:
        return pieces, bounds
    parts, counts, at = [], np.diff(bounds), 0
    for i in unsafe:
        found = pieces.slice(bounds[i], counts[i]).to_pylist()
        joined = [found[0]]
        for piece in found[1:]:
            if piece[:1].isalnum():
                joined.append(piece)
            else:
                joined[-1] += " " + piece
        parts += [pieces.slice(bounds[at], bounds[i] - bounds[at]), pa.array(joined, pieces.type)]
        counts[i], at = len(joined), i + 1
    parts.append(pieces.slice(bounds[at]))
    return pa.concat_arrays(parts), np.append(0, np.cumsum(counts))


def write(
    docs: DataFrame, path: str, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> None:
    """Writes the ids of all texts to files in a new folder.

    Every document is whole texts' ids and one end id; NULL and empty texts are the end alone.
    Documents stand in rising order of their ids (whole numbers; NULL first), those of equal ids
    in a fixed order of their own, each of them a document. An empty table gives files without documents.
    Other columns are left behind, whatever their names.
    """
    located = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("binary").alias("text"),
        # Splits equal ids too, and is the same when a lost task is run again.
        F.spark_partition_id().alias("origin"),
    )
    placed = located.repartitionByRange("doc", "origin").sortWithinPartitions("doc", "origin", F.xxhash64("text"))
    files = placed.select("doc", "text").mapInArrow(_file_writer(vocabulary, file_tokens), "content binary")
    (
        files.select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", _END.decode()).option("maxRecordsPerFile", 1).text(path)
    )


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """A row per document of the files: ``doc``, ``part``, ``start_in_part``, ``n_tokens``, ``ids_crc32`` and, if wanted, ``ids``.

    ``start_in_part`` counts the tokens before it in its range partition; see :func:`offsets`.
    ``ids`` are an array of ints. A broken file raises.
    """
    schema = _DOCUMENTS + (", ids array<int>" if ids else "")
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        .select("content").mapInArrow(_file_reader(ids), schema)
    )


def offsets(documents: DataFrame) -> DataFrame:
    """Adds ``start``, the tokens of all documents before: one number per range partition reaches the driver."""
    sizes = documents.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("n"))
    counted = sorted((r["part"], r["n"]) for r in sizes.collect())
    starts = itertools.accumulate((n for _, n in counted), initial=0)
    first = documents.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(counted, starts)], "part int, first long"
    )
    return documents.join(F.broadcast(first), "part").withColumn("start", F.col("first") + F.col("start_in_part")).drop("first")


class TokenFile:
    """One file's content."""

    def __init__(self, content: bytes):
        if not content.endswith(_END) or len(content) < _FOOTER.size + 1:
            raise ValueError("not a whole file of token ids")
        at = len(content) - _FOOTER.size - len(_END)
        (magic, version, width, self.part, self.file, self.start, self.tokens, self.documents, self.without_id,
         self.smallest) = _FOOTER.unpack_from(content, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of token ids")
        view = memoryview(content)
        self.ids = np.frombuffer(view[: self.tokens * width], np.dtype(f"<u{width}"))
        self.ends, at = EliasFano.from_buffer(view, self.tokens * width)
        self.doc_ids, _ = EliasFano.from_buffer(view, at)

    def bounds(self, ranks) -> tuple[np.ndarray, np.ndarray]:
        """First and end place of the documents of the given ranks among the file's ids."""
        ranks = np.asarray(ranks, np.int64)
        starts = np.zeros(len(ranks), np.int64)
        later = ranks > 0
        starts[later] = self.ends.select(ranks[later] - 1)
        return starts, self.ends.select(ranks).astype(np.int64)

    def document(self, rank: int) -> np.ndarray:
        (start,), (end,) = self.bounds([rank])
        return self.ids[start:end]

    def document_ids(self) -> list[int | None]:
        shifted = self.doc_ids.select(np.arange(self.doc_ids.n)).tolist()
        return [None] * self.without_id + [self.smallest + v for v in shifted]


def file_of(
    ids: bytes, width: int, lengths: list[int], doc_ids: list[int | None], part: int, file: int, start: int
) -> bytes:
    """The content of one file, from documents in rising order of their ids."""
    known = [d for d in doc_ids if d is not None]
    smallest = known[0] if known else 0
    shifted = np.array([d - smallest for d in known], np.uint64)
    ends = np.cumsum(np.array(lengths, np.uint64), dtype=np.uint64)
    footer = _FOOTER.pack(
        MAGIC, VERSION, width, part, file, start, len(ids) // width, len(doc_ids), len(doc_ids) - len(known), smallest
    )
    return b"".join((ids, EliasFano.of(ends).to_bytes(), EliasFano.of(shifted).to_bytes(), footer))


def _file_writer(vocabulary: Vocabulary, file_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(vocabulary), TaskContext.get().partitionId()
        width = encoder.dtype.itemsize
        ids, lengths, doc_ids = bytearray(), [], []
        file = before = 0

        def finished() -> pa.RecordBatch:
            content = file_of(bytes(ids), width, lengths, doc_ids, part, file, before)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for doc, parts in _encoded(batches, encoder):
            size = len(ids)
            for some in parts:
                ids += some
            ids += encoder.end
            lengths.append((len(ids) - size) // width)
            doc_ids.append(doc)
            if len(ids) >= file_tokens * width:
                yield finished()
                before += len(ids) // width
                file += 1
                ids, lengths, doc_ids = bytearray(), [], []
        if doc_ids:
            yield finished()

    return run


def _encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[tuple[int | None, Iterable[bytes]]]:
    """Documents and their ids in parts; short texts are encoded together, long ones in slices."""
    for batch in batches:
        docs, texts, size = [], [], 0
        for doc, value in zip(batch.column("doc").to_pylist(), batch.column("text")):
            data = value.as_py()
            text = data.decode("utf-8", "replace") if data else ""
            if docs and size + len(text) > _SLICE:
                yield from zip(docs, ([x] for x in encoder.encode_all(texts)))
                docs, texts, size = [], [], 0
            if len(text) > _SLICE:
                yield doc, encoder.encode(text)
            else:
                docs.append(doc)
                texts.append(text)
                size += len(text)
        yield from zip(docs, ([x] for x in encoder.encode_all(texts)))


def _file_reader(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                if data:
                    yield _documents(TokenFile(data), with_ids)

    return run


def _documents(file: TokenFile, with_ids: bool) -> pa.RecordBatch:
    starts, ends = file.bounds(np.arange(file.documents))
    sums = [
        zlib.crc32(file.ids[a:b].astype("<u4")) for a, b in zip(starts.tolist(), ends.tolist())
    ]
    columns = [
        pa.array(np.full(file.documents, file.part, np.int32)), pa.array(starts + file.start),
        pa.array(file.document_ids(), pa.int64()), pa.array(ends - starts), pa.array(sums, pa.int64()),
    ]
    if with_ids:
        columns.append(pa.ListArray.from_arrays(
            pa.array(np.append(0, ends).astype(np.int32)), pa.array(file.ids.astype(np.int32))
        ))
    names = ["part", "start_in_part", "doc", "n_tokens", "ids_crc32", "ids"]
    return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])
