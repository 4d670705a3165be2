"""Token ids as Arrow files of equal-length sequences, and reading them back without copies.

Documents are dealt by ranges of their id, sorted, tokenised and appended (each with its end id) to one
stream of ids per range. A task writes its stream as it comes, in the Arrow file format (the stream
format with a footer, so any record batch is found at once): column ``ids``, fixed-size lists of ``length`` ids
in the smallest unsigned type that holds the vocabulary, and column ``mask``, fixed-size lists of booleans
that are false on the padding, which only the end of a file has. All batches but the last hold ``ROWS``
sequences, so sequence i of a file is row ``i % ROWS`` of batch ``i // ROWS`` and reading it is a view of the
mapped file. A second Arrow file per task tells where each document lies (``doc_id, start, length``).

Files in the order of their ranges hold all ids in ascending ``doc_id`` order; where a file's ids begin
in the whole is the sum of the ids before it, a number per file. Text moves once, ids never do. A file
is as large as its range; what a task holds is a batch of texts and one record batch of ids.

Each attempt of a task writes files of its own under the shared folder, and the manifest, which Spark
commits, names those of the attempt that succeeded: lost executors leave unnamed files, never
half-written ones that are read. The folder may be any that ``pyarrow.fs`` opens (local or shared mount,
``hdfs://``, ``s3://``, ``gs://``).

Defined results: a null text is empty and gives the end id alone; null ids come first; rows with one id
go by a 64-bit hash of their text, equal rows in any order; an empty table gives no file and no row;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path, materialize
from .common import table

if TYPE_CHECKING:
    from pyarrow import fs

LENGTH = 2048
#: Sequences per record batch.
ROWS = 64
#: Characters that are tokenised at a time.
CHARS = 4_000_000
#: Pieces whose ids a worker remembers (about 200 bytes each); a cache, it changes no result.
CACHED = 500_000
MANIFEST = "shard int, ids_path string, docs_path string, n_ids long, n_docs long, n_sequences long"


class ByteBpe:
    """Ids of whole texts from a byte-level BPE file, as little-endian bytes of ``dtype``.

    The file's own pattern parts a text into pieces (a word with the blank before it, marks, digits, white
    space) that are encoded for themselves; here they are cut by the same pattern, written out for
    Latin-1, and each distinct one is encoded once and remembered. A text with other characters is first parted before
    single blanks and newlines between two other characters, where the pattern always parts it; a part with
    such characters stays whole. A text that holds a special token's string goes whole.
    """

    LETTER, DIGIT, WHITE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
    PIECES = re.compile(f" ?[{LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{DIGIT}]+| ?[^{WHITE}{LETTER}{DIGIT}]+"
                        f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
    PARTS = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n][^\s\x1c-\x1f])")
    #: Between words that are encoded together; the pattern parts them there and it makes no token of its own.
    GLUE = ""
    KEPT = CACHED
    _shared: dict[str, "ByteBpe"] = {}

    def __init__(self, file: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(file)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    @classmethod
    def shared(cls, file: str) -> "ByteBpe":
        """One per worker process, so what one task has learned serves the next."""
        if file not in cls._shared:
            cls._shared[file] = cls(file)
        return cls._shared[file]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.KEPT:
            self.known.clear()
        pieces = [self._pieces(t) for t in texts]
        self._learn(set().union(*pieces).difference(self.known))
        return [b"".join(map(self.known.__getitem__, p)) for p in pieces]

    def _pieces(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            return [text]
        if is_latin1(text):
            return self.PIECES.findall(text)
        return [p for part in self.PARTS.split(text) for p in (self.PIECES.findall(part) if is_latin1(part) else [part])]

    def _is_word(self, piece: str) -> bool:
        return piece[0] == " " and piece[1:].isalpha()

    def _learn(self, pieces: set[str]) -> None:
        words = [p for p in pieces if self._is_word(p)]
        for i in range(0, len(words), 16_384):  # many words in one text; which word an id is from is told by the library
            groups = [words[j:j + 256] for j in range(i, min(i + 16_384, len(words)), 256)]
            for group, e in zip(groups, self.tokenizer.encode_batch([self.GLUE.join(g) for g in groups], add_special_tokens=False)):
                ids = np.array(e.ids, self.dtype).tobytes()
                ends = ((np.flatnonzero(np.diff(np.array(e.word_ids), append=-1)) + 1) * self.dtype.itemsize).tolist()
                self.known.update((w, ids[a:b]) for w, a, b in zip(group, [0, *ends], ends))
        rest = list(pieces.difference(words))
        for i in range(0, len(rest), 1000):
            some = rest[i:i + 1000]
            for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[p] = np.array(e.ids, self.dtype).tobytes()


def is_latin1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


# --- the files --------------------------------------------------------------------------------

def _opened(path: str) -> tuple["fs.FileSystem", str]:
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class SequenceWriter:
    """Appends ids to a file of fixed-size lists; ``close`` pads the last sequence."""

    def __init__(self, path: str, dtype: np.dtype, length: int):
        self.dtype, self.length, self.rows, self.ids = dtype, length, 0, 0
        item = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        system, place = _opened(path)
        self.sink = system.open_output_stream(place)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held = bytearray()

    def append(self, ids: bytes) -> None:
        self.held += ids
        self.ids += len(ids) // self.dtype.itemsize
        width = ROWS * self.length * self.dtype.itemsize
        full = len(self.held) // width * width
        for at in range(0, full, width):
            self._batch(bytes(self.held[at:at + width]), ROWS * self.length)
        del self.held[:full]

    def _batch(self, ids: bytes, real: int) -> None:
        values = np.zeros(-(-real // self.length) * self.length, self.dtype)
        values[:real] = np.frombuffer(ids, self.dtype)
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (values, np.arange(len(values)) < real)]
        self.file.write_batch(pa.record_batch(arrays, schema=self.schema))
        self.rows += len(values) // self.length

    def close(self) -> None:
        if self.held:
            self._batch(bytes(self.held), len(self.held) // self.dtype.itemsize)
            self.held = bytearray()
        self.file.close()
        self.sink.close()


class SequenceFile:
    """Random access to a written file; ids and masks are views of the mapped bytes."""

    def __init__(self, path: str):
        system, place = _opened(path)
        self.source = pa.memory_map(place) if system.type_name == "local" else system.open_input_file(place)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self._batch: tuple[int, pa.RecordBatch] | None = None

    def __enter__(self) -> "SequenceFile":
        return self

    def __exit__(self, *_) -> None:
        self._batch = None
        self.source.close()

    def batch(self, k: int) -> pa.RecordBatch:
        if self._batch is None or self._batch[0] != k:
            self._batch = k, self.file.get_batch(k)
        return self._batch[1]

    def sequence(self, i: int) -> np.ndarray:
        """The ids of sequence i with its padding."""
        values = self.batch(i // ROWS).column("ids").values
        return values.slice(i % ROWS * self.length, self.length).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> np.ndarray:
        """Which ids of sequence i are real."""
        values = self.batch(i // ROWS).column("mask").values
        return values.slice(i % ROWS * self.length, self.length).to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The file's ids from ``start`` on, as views of one record batch each."""
        wide = ROWS * self.length
        while n:
            k, at = divmod(start, wide)
            some = min(n, wide - at)
            yield self.batch(k).column("ids").values.slice(at, some).to_numpy(zero_copy_only=True)
            start, n = start + some, n - some


class DocumentIndex:
    """The record batches of a documents file, one at a time."""

    def __init__(self, path: str):
        system, place = _opened(path)
        self.source = pa.memory_map(place) if system.type_name == "local" else system.open_input_file(place)

    def __enter__(self) -> Iterator[pa.RecordBatch]:
        file = pa.ipc.open_file(self.source)
        return (file.get_batch(k) for k in range(file.num_record_batches))

    def __exit__(self, *_) -> None:
        self.source.close()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Slices of a batch of at most about CHARS characters (or one row)."""
    ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHARS:
            yield ids.slice(lo, i - lo), texts[lo:i]
            lo, size = i, 0
        size += len(t)
    if texts:
        yield ids.slice(lo), texts[lo:]


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer_file: str | None = None,
                      length: int = LENGTH, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Write the files under ``folder`` (default: the shared folder); returns their manifest.

    The manifest has a row per pair of files, ``shard`` in the order of the documents, and ``first``: how
    many ids the files before it hold. The tokenizer's file is opened in the tasks.
    """
    folder = folder or fresh_path(docs.sparkSession, "token_files")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("__hash").asc(), F.col("__at").asc()]
    dealt = (rows.withColumns({"__hash": F.xxhash64("text"), "__at": F.monotonically_increasing_id()})
             .repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from pyspark import TaskContext
        tok = ids = docs_file = sink = None
        starts = n_docs = 0
        for batch in batches:
            for doc_ids, texts in _texts(batch):
                if ids is None:
                    tok = ByteBpe.shared(tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"))
                    end = np.array([end_id], tok.dtype).tobytes()
                    shard = TaskContext.get().partitionId()
                    base = f"{folder}/part-{shard:06d}-{uuid.uuid4().hex[:12]}"
                    system, place = _opened(folder)
                    system.create_dir(place, recursive=True)
                    ids = SequenceWriter(f"{base}.ids.arrow", tok.dtype, length)
                    sink = system.open_output_stream(_opened(f"{base}.docs.arrow")[1])
                    schema = pa.schema([("doc_id", doc_ids.type), ("start", pa.int64()), ("length", pa.int64())])
                    docs_file = pa.ipc.new_file(sink, schema)
                lengths = []
                for one in tok.encode(texts):
                    ids.append(one)
                    ids.append(end)
                    lengths.append(len(one) // tok.dtype.itemsize + 1)
                ends = np.cumsum(lengths) + starts
                docs_file.write_batch(pa.record_batch(
                    [doc_ids, pa.array(ends - lengths), pa.array(lengths, pa.int64())], schema=schema))
                starts = int(ends[-1])
                n_docs += len(lengths)
        if ids is not None:
            ids.close()
            docs_file.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "ids_path": f"{base}.ids.arrow", "docs_path": f"{base}.docs.arrow",
                "n_ids": ids.ids, "n_docs": n_docs, "n_sequences": ids.rows}],
                pa.schema([("shard", pa.int32()), ("ids_path", pa.string()), ("docs_path", pa.string()),
                           ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("n_sequences", pa.int64())]))

    manifest = materialize(dealt.mapInArrow(write, MANIFEST), "token_manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it; the checksum is over little-endian unsigned
    32-bit ids. One task per pair of files.
    """
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with SequenceFile(row["ids_path"]) as ids, DocumentIndex(row["docs_path"]) as docs:
                    for part in docs:
                        crcs = []
                        for start, n in zip(part.column("start").to_pylist(), part.column("length").to_pylist()):
                            crc = 0
                            for view in ids.ids(start, n):
                                crc = zlib.crc32(view.astype("<u4"), crc)
                            crcs.append(crc)
                        starts = pa.compute.add(part.column("start"), row["first"])
                        yield pa.RecordBatch.from_arrays([part.column("doc_id"), starts, part.column("length"), pa.array(crcs, pa.int64())],
                                                         ["doc_id", "start", "n_tokens", "ids_crc32"])

    dealt = manifest.select("shard", "ids_path", "docs_path", "first").repartitionByRange(files, "shard")
    return dealt.mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def op12_token_files(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_documents(write_token_files(docs), docs.schema["doc_id"].dataType.simpleString())


QUERIES = {"op12_token_files": op12_token_files}
