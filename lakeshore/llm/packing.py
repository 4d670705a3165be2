"""Best-fit packing planned on a length histogram.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. How many pieces
have each length is at most ``capacity`` numbers, whatever the size of the table. Best fit
decreasing runs over these counts: runs of equally filled sequences take several pieces of one
length at a time, so the plan has a few rows per length. Pieces then take the planned places by
joining on their rank within their length.

The driver holds the histogram and the plan, both bounded by ``capacity``; everything that
grows with the table is written, ranked and joined by Spark. A length's rank is dealt over
hashed buckets, so a length that a third of all pieces share is not ranked by one task.

Defined results: a null text is empty and gives one piece with the end token alone; repeated
rows are packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import table
from .tokenfiles import ByteBpe, is_latin1

CAPACITY = 2048
PIECES = "piece int, start long, length long, ids_crc32 long"


class WordBpe(ByteBpe):
    """Ids of whole texts from a lower-casing BPE file that drops white space, as little-endian 32-bit bytes.

    The pieces are the pattern's: runs of letters, single digits, runs of marks, English endings. A text with
    other characters than Latin-1 is parted at white space first; a part with such characters, or that may hold a special
    token's string, stays whole.
    """

    LETTER, DIGIT, WHITE = ByteBpe.LETTER, ByteBpe.DIGIT, ByteBpe.WHITE
    PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTER}]+|[{DIGIT}]|[^{WHITE}{LETTER}{DIGIT}]+")
    GLUE = " "
    KEPT = 250_000
    _shared: dict[str, "WordBpe"] = {}

    def __init__(self, file: str):
        super().__init__(file)
        self.dtype = np.dtype("<u4")

    def _pieces(self, text: str) -> list[str]:
        if "<|" not in text and is_latin1(text):
            return self.PIECES.findall(text.lower())
        return [p for chunk in _chunks(text)
                for p in (self.PIECES.findall(chunk.lower()) if "<|" not in chunk and is_latin1(chunk) else [chunk])]

    def _is_word(self, piece: str) -> bool:
        return piece.isalpha() and is_latin1(piece)


def _chunks(text: str) -> list[str]:
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        # str.split takes these four for white space, the tokenizers' patterns do not
        return re.findall(r"[^ \t-\r]+", text)
    return text.split()


def token_pieces(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = CAPACITY,
                 end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` (and ``ids`` on request).

    The file is opened in the tasks: the default is the installed public vocabulary.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, {PIECES}" + (", ids array<int>" if keep_ids else "")
    end = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers
        tok = WordBpe.shared(tokenizer_file or public_tokenizers.path("word_bpe_49k.json"))
        for batch in batches:
            for lo, hi in _spans(batch["text"], 2_000_000):
                yield pieces_of(batch.iloc[lo:hi], tok, 4 * capacity)

    def pieces_of(part: pd.DataFrame, tok: WordBpe, width: int) -> pd.DataFrame:
        out = []
        for doc, ids in zip(part["doc_id"].array, tok.encode(part["text"].tolist())):
            ids += end
            for k, at in enumerate(range(0, len(ids), width)):
                piece = ids[at:at + width]
                row = (doc, k, at // 4, len(piece) // 4, zlib.crc32(piece))
                out.append((*row, np.frombuffer(piece, "<u4").astype("int32")) if keep_ids else row)
        return pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    # ids cross to Python as text: pandas would turn integers with a null among them into floats
    return (docs.select(F.col(id_col).cast("string").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .mapInPandas(cut, schema.replace(f"doc_id {id_type}", "doc_id string", 1))
            .withColumn("doc_id", F.col("doc_id").cast(id_type)))


def _spans(texts: pd.Series, chars: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``chars`` characters (or one row)."""
    lo = size = 0
    for i, n in enumerate(texts.str.len()):
        if size and size + n > chars:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(texts):
        yield lo, len(texts)


def plan_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over a length histogram.

    Returns rows (length, first rank, ranks, first sequence, pieces per sequence, offset): the
    pieces of that length whose ranks lie in the row's range go to consecutive sequences, so
    many in each, from that offset on. Runs of sequences with equal room are kept together;
    the fullest run that still has room for the length is served first.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> [(first sequence, sequences)]
    plan, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = next((r for r in range(length, capacity) if runs.get(r)), capacity)
            each = room // length
            if room < capacity:
                first, n = runs[room].pop()
            else:
                first, n = sequences, -(-left // each)
                sequences += n
            full = min(n, left // each)
            if full:
                plan.append((length, rank, full * each, first, each, capacity - room))
                runs[room - each * length].append((first, full))
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # the rest goes to one more sequence of the run
                plan.append((length, rank, left, first + full, left, capacity - room))
                runs[room - left * length].append((first + full, 1))
                full, left = full + 1, 0
            if full < n:
                runs[room].append((first + full, n - full))
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = 20_000,
         length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Lengths must lie in 1..capacity.

    The pieces are written once; a row is known by its file and its place in it, which no
    retry changes, so equal rows get different ranks.
    """
    columns = pieces.columns
    kept = materialize(pieces, "pack_pieces")
    counts = {r[0]: r[1] for r in kept.groupBy(length_col).count().collect()}  # at most capacity rows
    total = sum(counts.values())
    plan = plan_histogram(counts, capacity)
    spark = pieces.sparkSession
    planned = spark.createDataFrame(
        plan, "p_length long, p_rank long, p_ranks long, p_first long, p_each long, p_offset long")
    buckets = max(1, -(-total // bucket_rows))
    row = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    ranked = (kept.select(*columns, row[0].alias("__file"), row[1].alias("__row"))
              .withColumn("__bucket", F.pmod(F.xxhash64("__file", "__row"), F.lit(buckets))))
    sizes = ranked.groupBy(length_col, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(length_col).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(length_col, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(length_col, "__bucket").orderBy("__file", "__row")
    ranked = (ranked.withColumn("__place", F.row_number().over(inside))
              .join(bases, [length_col, "__bucket"])
              .withColumn("__rank", F.col("__base") + F.col("__place") - 1))
    # the plan has a few rows per length: bounded by the capacity, never by the table
    placed = ranked.join(F.broadcast(planned), (F.col(length_col) == F.col("p_length"))
                         & (F.col("__rank") >= F.col("p_rank"))
                         & (F.col("__rank") < F.col("p_rank") + F.col("p_ranks")))
    at = F.col("__rank") - F.col("p_rank")
    return placed.select(
        *columns, (F.col("p_first") + F.floor(at / F.col("p_each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + F.pmod(at, F.col("p_each")) * F.col(length_col)).cast("long").alias("offset"))


def op4_pack(spark, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents")))


QUERIES = {"op4_pack": op4_pack}
