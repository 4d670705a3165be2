"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie of word-initial and continuation pieces. Every node has a failure
link to the node that spells the rest of its string after the pieces that greedy longest match
would take from it, and the number of those pieces. A word is read once, character by
character; when no edge fits, the count of the popped pieces is added and the failure link
followed. No piece is ever built, and the steps are linear in the word's length.

A word without a full segmentation counts as one unknown piece, as the greedy word-piece rule
has it. Words are runs of letters, digits and marks, or single other visible characters.

Defined results: a null or empty text has no words and no pieces; repeated rows are counted
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .packing import _spans

WORD = re.compile(r"\w+|[^\w\s]")
#: Distinct words whose counts a task remembers.
CACHED_WORDS = 250_000
_CACHE: dict[str, "LongestMatch"] = {}


class LongestMatch:
    """``pieces`` start a word, ``continuations`` go on inside it."""

    def __init__(self, pieces, continuations):
        self.edges: list[dict[str, int]] = [{}, {}]
        self.start, self.inner = 0, 1  # an empty word; an empty rest inside a word
        self.ends = [False, False]
        for root, words in ((0, pieces), (1, continuations)):
            for w in words:
                node = root
                for c in w:
                    nxt = self.edges[node].get(c)
                    if nxt is None:
                        nxt = self.edges[node][c] = len(self.edges)
                        self.edges.append({})
                        self.ends.append(False)
                    node = nxt
                if w:
                    self.ends[node] = True
        # failure links, shortest strings first; -1: no segmentation can go on
        n = len(self.edges)
        self.fail, self.pops = [-1] * n, [0] * n
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.edges[parent].items():
                if self.ends[node]:
                    self.fail[node], self.pops[node] = self.inner, 1
                else:
                    z, popped = self.fail[parent], self.pops[parent]
                    while z >= 0 and c not in self.edges[z]:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[node], self.pops[node] = self.edges[z][c], popped
                queue.append(node)

    def count(self, word: str) -> int:
        """Pieces of the word; 0 if it has no full segmentation."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = total = 0
        for c in word:
            while True:
                nxt = edges[node].get(c)
                if nxt is not None:
                    node = nxt
                    break
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
        while node != self.inner:  # the end of the word fits no edge
            total += pops[node]
            node = fail[node]
            if node < 0:
                return 0
        return total


def sentencepiece_vocabulary(file: str) -> tuple[list[str], list[str]]:
    """Word-initial pieces (marked by U+2581) and continuations of a sentencepiece file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return ([p[1:] for p in names if p[0] == "▁" and len(p) > 1],
            [p for p in names if p[0] != "▁"])


def _matcher(file: str) -> LongestMatch:
    if file not in _CACHE:
        _CACHE[file] = LongestMatch(*sentencepiece_vocabulary(file))
    return _CACHE[file]


def wordpiece_counts(docs: DataFrame, vocabulary_file: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_pieces, n_unknown`` of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers
        matcher = _matcher(vocabulary_file or public_tokenizers.path("piece_bpe_32k.model"))
        known: dict[str, int] = {}
        for batch in batches:
            for lo, hi in _spans(batch["text"], 4_000_000):
                out = []
                for doc, text in zip(batch["doc_id"].array[lo:hi], batch["text"].iloc[lo:hi]):
                    words = WORD.findall(text)
                    for w in set(words):
                        if w not in known:
                            known[w] = matcher.count(w)
                    found = list(map(known.__getitem__, words))
                    unknown = found.count(0)
                    out.append((doc, len(words), sum(found) + unknown, unknown))
                    if len(known) > CACHED_WORDS:
                        known.clear()
                yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_pieces", "n_unknown"])

    return (docs.select(F.col(id_col).cast("string").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .mapInPandas(counts, "doc_id string, n_words long, n_pieces long, n_unknown long")
            .withColumn("doc_id", F.col("doc_id").cast(id_type)))


def op7_wordpiece(spark, sf_dir: str) -> DataFrame:
    return wordpiece_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op7_wordpiece": op7_wordpiece}
