"""Exact n-gram Jaccard self-join by prefix lists and set relations; linked documents as classes.

A document's set holds its distinct five-word shingles, as 64-bit hashes. Two sets of Jaccard
similarity 0.8 or more overlap so much that their prefixes meet in any common order of
shingles. The join goes through these steps; each is exact.

1. Equal word sequences are one class; the join is between classes.
2. In hash order, the first n - ceil(0.8 n) + l shingles of linked sets share at least l. With l
   a tenth of the set, a class goes on only if that many of these shingles also occur in
   another class. Shingles found frequent in a sample count as shared without being dealt out,
   which can only keep more classes.
3. The classes left are indexed by the prefixes of their shingles, rarest first: lists of
   (class, size, position). Within a list, neighbours by size and the list's smallest set are
   compared; their links make first components, which similar sets fall into at once.
4. Sets of one component need no further comparison. For the rest, sets are put into chunks of
   related sets, a list's entries are skipped by size and position against the bounds of a
   chunk's block of entries, and a set visits every chunk of other components it still meets
   in a list. A chunk's task keeps its members' index, and derives a visitor's overlaps from
   those of the visitor before it where they are similar: they differ at most by the shingles
   in which the two visitors differ, so only overlaps near the threshold are counted anew.
5. Links of both steps give the components.

Classes are told apart by 128 bits, shingles (and classes inside the join) by 64.

No pairs of a list are ever emitted: step 3 gives at most two per entry, step 4 one visit per
set and chunk and one link per visit and component.

Defined results: a null or empty text, or one without words, has an empty set, linked with
nothing; fewer than five words are one shingle; texts equal up to case and white space are
linked if their set is not empty; a null id is greater than all others; repeated rows are rows
of one class; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import table
from .components import connected_components
from .packing import _spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SHINGLE = 5
#: Similarity 80/100, and the part of a set (in tenths) that l of step 2 is.
NUM, DEN = 80, 100
EXTRA_TENTHS = 1
CACHED_WORDS = 150_000
#: Frequent shingles: in at least this many sampled classes (one in SAMPLE); at most FREQUENT of them.
SAMPLE, SAMPLE_LEAST, FREQUENT = 64, 4, 20_000
CHUNK = 256
VISITORS = 1024
#: Class ids that may be broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        return WORD.findall(text.translate(LOWER) if not text.islower() else text)

    def shingles(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                                          "little")
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - SHINGLE + 1)
        out = np.full(n, 0x9E3779B97F4A7C15 if len(h) >= SHINGLE else len(h), np.uint64)
        for k in range(min(SHINGLE, len(h))):
            out = _mix((out ^ h[k:k + n]) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k + 1))
        return np.unique(out.view(np.int64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def least_overlap(n):
    """ceil(0.8 n): shingles that a set of size n shares with any set it links to."""
    return -(-NUM * n // DEN)


def _linked(overlap, a, b):
    return DEN * overlap >= NUM * (a + b - overlap)


def _key(words: list[str]) -> tuple[int, int]:
    """128-bit key of a word sequence, as two longs."""
    key = hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, h, k1, k2, n, few, need`` per row: hash of the text, 128-bit key of the word sequence,
    set size, the lowest shingles in hash order that step 2 looks at, and how many of them must be shared."""
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = Shingler()
        for batch in batches:
            for lo, hi in _spans(batch["text"], 2_000_000):
                out = []
                part = batch.iloc[lo:hi]
                for doc, h, text in zip(part["doc_id"].array, part["h"], part["text"]):
                    words = cut.words(text)
                    s = cut.shingles(words)
                    extra = max(1, -(-EXTRA_TENTHS * len(s) // 10))
                    few = s[:len(s) - least_overlap(len(s)) + extra]
                    out.append((doc, h, *_key(words), len(s), few, min(extra, len(few))))
                yield pd.DataFrame(out, columns=["doc_id", "h", "k1", "k2", "n", "few", "need"])

    return (_texts(docs).select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
            .mapInPandas(run, "doc_id string, h long, k1 long, k2 long, n long, few array<long>, need long")
            .withColumn("doc_id", F.col("doc_id").cast(id_type)))


def _whole_sets(docs: DataFrame) -> DataFrame:
    """``id, n, s`` per row of (id, text) whose class is ``id``: the whole sorted set."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = Shingler()
        for batch in batches:
            for lo, hi in _spans(batch["text"], 1_000_000):
                out = []
                for class_id, text in zip(batch["id"].iloc[lo:hi], batch["text"].iloc[lo:hi]):
                    words = cut.words(text)
                    if _key(words)[0] == class_id:  # rows with one id may hold other texts
                        s = cut.shingles(words)
                        out.append((class_id, len(s), s))
                yield pd.DataFrame(out, columns=["id", "n", "s"])

    return docs.select("id", "text").mapInPandas(run, "id long, n long, s array<long>")


def _survivors(rows: DataFrame) -> DataFrame:
    """``k1, k2, doc_id, n`` of the classes that step 2 keeps; doc_id is the smallest of the class."""
    filled = rows.filter("n > 0")
    seen = filled.filter(F.pmod("k2", F.lit(SAMPLE)) == 0).select("k1", "k2", F.explode("few").alias("t"))
    frequent = materialize(
        seen.groupBy("t").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.count(F.lit(1)).alias("c"))
        .filter((F.col("lo") != F.col("hi")) & (F.col("c") >= SAMPLE_LEAST))
        .orderBy(F.col("c").desc(), "t").limit(FREQUENT).select("t"), "nj_frequent")
    entries = filled.select("k1", F.explode("few").alias("t"))
    frequent = F.broadcast(frequent)  # at most FREQUENT rows
    sure = entries.join(frequent, "t", "left_semi").groupBy("k1").agg(F.count(F.lit(1)).alias("c"))
    token = Window.partitionBy("t")
    shared = (entries.join(frequent, "t", "left_anti")
              .withColumn("lo", F.min("k1").over(token)).withColumn("hi", F.max("k1").over(token))
              .filter("lo <> hi").groupBy("k1").agg(F.count(F.lit(1)).alias("c")))
    # each row of a class adds its shingles, so the sums are over the class's rows
    sums = sure.unionByName(shared).groupBy("k1").agg(F.sum("c").alias("c"))
    # min over structs: the smallest id, nulls last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id"))).alias("d")
    per = filled.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"),
                                         F.first("need").alias("need"))
    return (per.join(sums, "k1").filter(F.col("c") >= F.col("need") * F.col("rows"))
            .select("k1", "k2", F.col("d.doc_id").alias("doc_id"), "n"))


def _index(sets: DataFrame) -> DataFrame:
    """Prefix lists: ``t, id, n, pos`` for the shingles that occur in several sets, rarest first."""
    token = Window.partitionBy("t")
    shared = (sets.select("id", "n", F.explode("s").alias("t"))
              .withColumn("df", F.count(F.lit(1)).over(token)).filter("df > 1"))
    least = F.ceil(F.col("n") * NUM / DEN)
    listed = (shared.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("l"))
              .withColumn("alone", F.col("n") - F.size("l"))  # shingles of its own come first
              .withColumn("left", (F.col("n") - least + 1 - F.col("alone")).cast("int"))
              .filter("left > 0"))
    return listed.select("id", "n", "alone", F.posexplode(F.slice("l", F.lit(1), F.col("left"))).alias("p", "e")).select(
        F.col("e.t").alias("t"), "id", "n", (F.col("alone") + F.col("p")).alias("pos"))


def _first_links(index: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` among neighbours by size, and with the smallest set, of each list."""
    order = Window.partitionBy("t").orderBy("n", "id")
    here = F.struct("id", "n")
    paired = index.select("t", here.alias("x"), F.lag(here).over(order).alias("y"), F.first(here).over(order).alias("z"))
    pairs = paired.select("x", F.explode(F.array("y", "z")).alias("y")).filter(
        F.col("y").isNotNull() & (F.col("x.id") != F.col("y.id")))
    near = F.least("x.n", "y.n") * DEN >= F.greatest("x.n", "y.n") * NUM
    pairs = (pairs.filter(near).select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct())
    pairs = materialize(pairs, "nj_pairs")
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    overlap = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b").withColumn("o", overlap)
            .filter(F.col("o") * DEN >= (F.col("na") + F.col("nb") - F.col("o")) * NUM).select("a", "b"))


def _chunks(index: DataFrame, found: DataFrame) -> DataFrame:
    """``id, component, chunk``: related sets together, at most about CHUNK of them in expectation.

    A large component is cut into chunks of its own; small ones are put together by the list
    of their rarest shared shingle's first set, cut by a hash.
    """
    nodes = index.groupBy("id").agg(F.min(F.struct("pos", "t")).alias("first"))
    heads = index.groupBy("t").agg(F.min("id").alias("head"))
    nodes = (nodes.select("id", F.col("first.t").alias("t")).join(heads, "t")
             .join(found, "id", "left").select("id", "head", F.coalesce("component", "id").alias("component")))
    nodes = materialize(nodes, "nj_nodes")
    big = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("c"))
    nodes = nodes.join(big, "component")
    family = nodes.filter(F.col("c") < CHUNK).groupBy("head").agg(F.count(F.lit(1)).alias("f"))
    nodes = nodes.join(family, "head", "left")
    # chunks of large components have ids from 0 on, pooled ones below: the few visit the many
    own = F.xxhash64("component", F.pmod(F.xxhash64("id"), F.ceil(F.col("c") / CHUNK))).bitwiseAND((1 << 63) - 1)
    pooled = F.xxhash64("head", F.pmod(F.xxhash64("component"), F.ceil(F.col("f") / CHUNK))).bitwiseOR(-(1 << 63))
    return nodes.select("id", "component", F.when(F.col("c") >= CHUNK, own).otherwise(pooled).alias("chunk"))


def _visits(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """``chunk, id``: sets that still meet a chunk in a list and may link to another component."""
    entries = materialize(index.join(chunks, "id"), "nj_entries")
    # a list's entries of one chunk are a block: its bounds decide whether it is skipped
    blocks = entries.groupBy("t", "chunk").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("n").alias("n0"),
        F.max("n").alias("n1"), F.min("pos").alias("p0"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    several = entries.groupBy("t").agg(F.min("component").alias("x0"), F.max("component").alias("x1")).filter("x0 <> x1")
    blocks = blocks.join(several.select("t"), "t").withColumnRenamed("chunk", "into")
    met = entries.join(blocks, "t")
    other = (F.col("c0") != F.col("component")) | (F.col("c1") != F.col("component"))
    near = (F.col("n1") * DEN >= F.col("n") * NUM) & (F.col("n") * DEN >= F.col("n0") * NUM)
    most = F.least(F.col("rest"), F.col("n") - F.col("pos"))
    reach = most * (DEN + NUM) >= (F.col("n") + F.greatest(F.col("n0"), F.ceil(F.col("n") * NUM / DEN))) * NUM
    # both sides see each other; the visit into the greater chunk id is the one that is made
    return (met.filter(other & near & reach & ((F.col("into") >= F.col("chunk"))))
            .select(F.col("into").alias("chunk"), "id").distinct())


def _visit_links(visits: DataFrame, chunks: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between visitors and members of other components (one per visitor and component).

    A task holds a chunk and a tile of about VISITORS visitors, dealt by their own hash, so the visitors of a component of
    any size are spread; inside a tile those of one component follow each other.
    """
    visits = materialize(visits, "nj_visits")
    loads = visits.groupBy("chunk").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("tiles"))
    members = (chunks.join(loads, "chunk").join(sets, "id")
               .select("chunk", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "id", "component", "s"))
    guests = (visits.join(loads, "chunk").join(chunks.select("id", "component"), "id").join(sets, "id")
              .select("chunk", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"),
                      "id", "component", "s"))
    both = members.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        inside, visitors = rows[~rows["guest"]], rows[rows["guest"]].copy()
        visitors["n"] = visitors["s"].map(len)
        visitors = visitors.sort_values(["component", "n", "id"])
        return pd.DataFrame(_compare(inside, visitors), columns=["a", "b"]).astype("int64")

    return both.groupBy("chunk", "tile").applyInPandas(compare, "a long, b long")


def _compare(inside: pd.DataFrame, visitors: pd.DataFrame) -> list[tuple[int, int]]:
    """Links of visitors with members; overlaps follow from the visitor before where they can."""
    members = inside["s"].tolist()
    sizes = np.array([len(s) for s in members], np.int64)
    ids, comps = inside["id"].to_numpy(), inside["component"].to_numpy()
    if not len(members):
        return []
    flat = np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    links, last, low, high = [], None, None, None
    for vid, comp, s in zip(visitors["id"], visitors["component"], visitors["s"]):
        s = np.asarray(s)
        n = len(s)
        open_ = (comps != comp) & (DEN * np.minimum(sizes, n) >= NUM * np.maximum(sizes, n))
        if not open_.any():
            continue
        # an overlap differs from the last visitor's by at most what the visitors do not share
        if last is not None:
            both = len(np.intersect1d(s, last, assume_unique=True))
            low, high = np.maximum(0, low - (len(last) - both)), np.minimum(high + (n - both), np.minimum(n, sizes))
            yes, no = _linked(low, n, sizes), ~_linked(high, n, sizes)
        if last is None or (open_ & ~yes & ~no).any():
            at, to = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
            hit = to > at
            reps = (to - at)[hit]
            places = np.repeat(at[hit] - np.r_[0, np.cumsum(reps)[:-1]], reps) + np.arange(reps.sum())
            low = high = np.bincount(owner[places], minlength=len(members))
            yes = _linked(low, n, sizes)
        last = s
        linked = np.nonzero(open_ & yes)[0]
        if len(linked):
            _, first = np.unique(comps[linked], return_index=True)
            links.extend((int(vid), int(ids[i])) for i in linked[first])
    return links


def link_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    ``h`` (hash of the text) tells rows with one id apart, ``component, other`` name the component.
    """
    rows = materialize(classes(docs), "nj_classes")
    kept = materialize(_survivors(rows).withColumn("id", F.col("k1")), "nj_survivors")
    key = _small(kept.select("id", F.col("doc_id").alias("__d")))
    texts = _texts(docs).join(key, F.col("doc_id").eqNullSafe(F.col("__d"))).select("id", "text")
    sets = materialize(_whole_sets(texts).dropDuplicates(["id"]), "nj_sets")
    index = materialize(_index(sets), "nj_index")
    links = materialize(_first_links(index, sets), "nj_links")
    found = materialize(connected_components(links, "nj_first"), "nj_found")
    chunks = materialize(_chunks(index, found), "nj_chunks")
    more = materialize(_visit_links(_visits(index, chunks), chunks, sets), "nj_more")
    whole = connected_components(links.unionByName(more), "nj_all")
    # the smallest document id of each component, nulls last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id")))
    per_class = rows.filter("n > 0").groupBy("k1", "k2").agg(first.alias("d"))
    per_class = per_class.join(whole, F.col("k1") == F.col("id"), "left").drop("id")
    least = (per_class.filter("component is not null").groupBy("component").agg(F.min("d").alias("least"))
             .withColumnRenamed("component", "__c"))
    named = (per_class.join(least, F.col("component") == F.col("__c"), "left")
             .select("k1", "k2", "component",
                     F.when(F.col("__c").isNull(), F.col("d")).otherwise(F.col("least"))["doc_id"]
                     .alias("component_id"))
             .withColumn("other", F.when(F.col("component").isNull(), F.col("k2")))
             .withColumn("component", F.coalesce("component", "k1")))
    full = rows.filter("n > 0").join(named, ["k1", "k2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "h", "component", "other")
    none = F.lit(None).cast("long")
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                        "h", none.alias("component"), none.alias("other"))
    return full.unionByName(empty)


def one_per_component(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, that of the smallest id, with all columns.

    Rows without words are linked with nothing and stay.
    """
    linked = materialize(link_components(docs), "nj_linked")
    filled = linked.filter("n_shingles > 0")
    rank = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "h")
    first = filled.groupBy("component", "other").agg(F.min(rank).alias("m"))
    first = first.select(F.col("component").alias("__c"), F.col("other").alias("__o"), "m")
    rows = filled.groupBy("component", "other", "doc_id", "h").agg(F.count(F.lit(1)).alias("rows"))
    judged = materialize(
        rows.join(first, (F.col("component") == F.col("__c")) & F.col("other").eqNullSafe(F.col("__o")))
        .select(F.xxhash64("doc_id", "h").alias("__k"), F.col("h").alias("__h"), "rows",
                (F.col("m.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("m.h") == F.col("h"))).alias("kept")),
        "nj_judged")
    repeated = _small(judged.filter("kept and rows > 1").select("__k", "__h"))
    gone = _small(judged.filter("not kept or rows > 1").select("__k", "__h"))
    h = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.withColumn("__h", h).withColumn("__k", F.xxhash64("doc_id", "__h"))
    once = keyed.join(repeated, ["__k", "__h"], "left_semi").dropDuplicates(["__k", "__h"])
    return keyed.join(gone, ["__k", "__h"], "left_anti").unionByName(once).select(*docs.columns)


def _small(ids: DataFrame) -> DataFrame:
    """Broadcast if the counted size allows it; the same join is a shuffle otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op8_ngram_join": op8_ngram_join}
