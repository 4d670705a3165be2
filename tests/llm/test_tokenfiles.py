"""Token files against the tokenizer itself, and the files' own layout."""

import random
import zlib
from array import array

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeshore.llm import tokenfiles
from tests.conftest import SF_SMALL

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ref():
    return Tokenizer.from_file(FILE)


def _ids(ref, text):
    return ref.encode(text or "", add_special_tokens=False).ids + [0]


def _want(ref, rows):
    """(doc_id, start, n_tokens, crc) in order; rows of one id by their own order"""
    out, at = [], 0
    for doc, text in rows:
        ids = _ids(ref, text)
        out.append((doc, at, len(ids), zlib.crc32(array("I", ids).tobytes())))
        at += len(ids)
    return out


def test_pieces_equal_the_tokenizer(ref):
    rng = random.Random(4)
    alphabet = ["a", "b", "Z", "é", "ß", " ", " ", "  ", "\n", "\t", ".", ",", "'", "'s", "'ll", "-", "0", "12", " ", "　",
                "日", "本", "\x1c", "\x85", "\r\n", "😀", "_", "$", "<|endoftext|>", "<|", "½", "́", "×", "²", "ª", "µ",
                "\xa0", "\x00", "\xad", " x", " Ab", "“", "— "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(20_000)]
    texts += ["The quick  brown\nfox's \n jumps. Don't\n\nstop,now ", "x" * 5000, " " * 3000, "\n"]
    tok = tokenfiles.ByteBpe(FILE)
    texts += ["".join(map(chr, rng.sample(range(256), 40))) for _ in range(3000)]
    for lo in range(0, len(texts), 3000):
        some = texts[lo:lo + 3000]
        for text, got in zip(some, tok.encode(some)):
            assert np.frombuffer(got, tok.dtype).tolist() == ref.encode(text, add_special_tokens=False).ids, repr(text)


def test_given_table(spark, ref):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().sort_values("doc_id")
    got = tokenfiles.op12_token_files(spark, SF_SMALL)
    assert dict(got.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(_want(ref, zip(docs.doc_id, docs.text)))


def test_layout_and_random_access(spark, ref):
    rows = [(k, f"Some text, number {k}.\nMore of it " * (k % 7)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    manifest = tokenfiles.write_token_files(df.repartition(4), length=16).orderBy("shard").collect()
    stream = [i for _, t in rows for i in _ids(ref, t)]
    at = 0
    for m in manifest:
        assert m["first"] == at
        with tokenfiles.SequenceFile(m.ids_path) as f:
            assert f.file.schema.field("ids").type == pa.list_(pa.uint16(), 16)
            assert sum(f.file.get_batch(k).num_rows for k in range(f.file.num_record_batches)) == m.n_sequences == -(-m.n_ids // 16)
            order = list(range(m.n_sequences))
            random.Random(1).shuffle(order)
            for i in order:
                real = min(16, m.n_ids - 16 * i)
                ids, mask = f.sequence(i), f.mask(i)
                assert len(ids) == 16 and mask.tolist() == [True] * real + [False] * (16 - real)
                assert ids[:real].tolist() == stream[at + 16 * i:at + 16 * i + real] and not ids[real:].any()
                assert not ids.flags.owndata
        at += m.n_ids
    assert at == len(stream) and sum(m.n_docs for m in manifest) == 400


def test_odd_tables(spark, ref):
    rows = [(None, "solo"), (1, None), (2, ""), (3, "w " * 40_000), (4, "a b"), (9007199254740993, "big"), (5, "dup"), (5, "dup")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, shard int, `first` string, ids int")
    got = tokenfiles.read_documents(tokenfiles.write_token_files(df.repartition(3))).collect()
    first = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == _want(ref, first)
    # rows of one id: any order of theirs, the same at every run, gapless
    ties = [(7, f"text {k}") for k in range(50)] + [(7, "text 1")] * 500
    a, b = (sorted(map(tuple, tokenfiles.read_documents(tokenfiles.write_token_files(
        spark.createDataFrame(t, "doc_id long, text string").repartition(n))).collect()), key=lambda r: r[1])
        for t, n in ((ties, 3), (ties[::-1], 6)))
    assert a == b and all(x[1] + x[2] == y[1] for x, y in zip(a, a[1:]))
    assert sorted(x[2:] for x in a) == sorted(x[2:] for x in _want(ref, ties))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfiles.read_documents(tokenfiles.write_token_files(none)).count() == 0


def test_string_ids(spark, ref):
    df = spark.createDataFrame([("b", "x y"), ("a", "z")], "doc_id string, text string")
    got = tokenfiles.read_documents(tokenfiles.write_token_files(df), "string").orderBy("start").collect()
    assert [tuple(r) for r in got] == _want(ref, [("a", "z"), ("b", "x y")])
