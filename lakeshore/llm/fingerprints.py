"""Document fingerprints by consistent weighted sampling.

A text's terms are its white-space separated words, weighted by their counts. Each of the
``SAMPLES`` samples draws, for every term, r and c from Gamma(2, 1) and b from [0, 1) by a hash
of term and sample. With t = floor(ln w / r + b) the term's rank is ln a = ln c - r (t - b) - r;
the sample is the (term, t) of least rank. Two texts agree on a sample with the probability of
their generalised Jaccard similarity, the sum of the smaller weights over that of the greater.

The Gamma draws come from the distribution's quantiles: hash bits pick one of ``GRID`` equal steps and a place
in it, between the quantiles of its ends. Among many terms the least ranks come from the smallest c and the
greatest r, so in the first step of c and the last of r the quantile is computed, from further hash bits. The work per term and
sample is a hash and some arithmetic in generated code. A term
row is repeated per lane of samples and reduced by a plain minimum over one long per sample
that holds rank and sample; no list of terms is ever built.

DataFrame functions only. Defined results: a null text is empty; an empty text, or one of white space, has the empty
word as its one term, so such texts are alike; rows equal in id and text are one document in
the order of neighbours and all get its result; among different texts with one id the order is
by a hash; a null id comes last; a single document is its own neighbour; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import global_rank, table

LANES, PER_LANE = 8, 8
SAMPLES = LANES * PER_LANE
GRID = 256
WIDTH = 4
SPACE = r"[\x20\x09-\x0D]+"
KEY = ["k1", "k2"]


WHITE = " \t\n\x0b\x0c\r"


def _low_quantile(u: Column) -> Column:
    """Gamma(2, 1) quantile for a small u: the series of the inverse of 1 - (1 + x) exp(-x) in sqrt(2 u)."""
    s = F.sqrt(2 * u)
    return s * (1 + s * (1 / 3 + s * (11 / 72 + s * (43 / 540 + s * (769 / 17280)))))


def _high_quantile(v: Column, steps: int = 4) -> Column:
    """Gamma(2, 1) quantile for 1 - v with a small v: (1 + x) exp(-x) = v, as a fixed point."""
    log = -F.log(v)
    x = log + F.log(log)
    for _ in range(steps):
        x = log + F.log1p(x)
    return x


def gamma_edges(n: int = GRID) -> list[float]:
    """Gamma(2, 1) quantiles at the ends of ``n`` equal steps, by bisection of its CDF; the last is at 1 - 1 / 4n."""
    out = [0.0]
    for i in range(1, n + 1):
        p, lo, hi = min(i / n, 1 - 0.25 / n), 0.0, 50.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if 1 - (1 + mid) * math.exp(-mid) < p else (lo, mid)
        out.append((lo + hi) / 2)
    return out


def _tables() -> dict[str, Column]:
    """Constants: the low end of every step and its width, for r and for ln c."""
    edges = gamma_edges()
    logs = [math.log(x) for x in edges[1:]]
    logs.insert(0, logs[0])  # the first step of c is computed
    constant = lambda values: F.array(*[F.lit(x) for x in values])
    steps = lambda v: constant([b - a for a, b in zip(v, v[1:])])
    return {"r": constant(edges[:-1]), "r_step": steps(edges), "c": constant(logs[:-1]), "c_step": steps(logs)}


def _sample(term: Column, log_weight: Column, sample: Column, tables: dict[str, Column]) -> Column:
    """Rank (upper bits) and sample (lower 24 bits) of a term, as one long whose minimum wins.

    Of the hash's 64 bits 8 pick the step of r, 8 that of c, 12 each the place inside, 24 are b.
    """
    h = F.xxhash64(term, sample)
    bits = lambda at, n: F.shiftright(h, at).bitwiseAND((1 << n) - 1).cast("int")
    i_r, i_c = bits(0, 8), bits(8, 8)
    place = lambda at: (bits(at, 12).cast("double") + 0.5) * (1 / 4096)
    tail = lambda salt: (F.shiftrightunsigned(F.xxhash64(term, sample, F.lit(salt)), 11).cast("double") + 0.5) * (2.0 ** -53 / GRID)
    r = F.when(i_r == GRID - 1, _high_quantile(tail(1))).otherwise(tables["r"][i_r] + place(16) * tables["r_step"][i_r])
    log_c = F.when(i_c == 0, F.log(_low_quantile(tail(2)))).otherwise(tables["c"][i_c] + place(28) * tables["c_step"][i_c])
    b = F.shiftrightunsigned(h, 40).cast("double") * (2.0 ** -24)
    t = F.floor(log_weight / r + b)
    rank = log_c - r * (t.cast("double") - b) - r
    level = F.floor((rank + 96.0) * float(1 << 29))
    mark = (F.shiftrightunsigned(h, 40) + t * 40503).bitwiseAND((1 << 24) - 1)
    return F.shiftleft(level, 24).bitwiseOR(mark)


def signatures(texts: DataFrame, keys: list[str], part: str = "part", text: str = "text") -> DataFrame:
    """``keys, part, samples``: the samples of each text (one row per keys and part), ``WIDTH`` hexadecimal digits each.

    If ``texts`` is already dealt by ``keys``, nothing is shuffled here.
    """
    tables = _tables()
    words = F.split(F.btrim(F.col(text), F.lit(WHITE)), SPACE)
    terms = (texts.select(*keys, part, F.explode(words).alias("word")).select(*keys, part, F.xxhash64("word").alias("term"))
             .groupBy(*keys, part, "term").agg(F.log(F.count(F.lit(1))).alias("log_weight")))
    lanes = terms.select(*keys, part, "term", "log_weight",
                         F.explode(F.array(*[F.lit(i) for i in range(LANES)])).alias("lane"))
    least = lanes.groupBy(*keys, part, "lane").agg(*[
        F.min(_sample(F.col("term"), F.col("log_weight"), F.col("lane") * PER_LANE + j, tables)).alias(f"m{j}")
        for j in range(PER_LANE)])
    hexes = F.array(*[F.lpad(F.lower(F.hex(F.col(f"m{j}").bitwiseAND(0xFFFF))), 4, "0") for j in range(PER_LANE)])
    return (least.groupBy(*keys, part)
            .agg(F.array_sort(F.collect_list(F.struct("lane", hexes.alias("s")))).alias("lanes"))
            .select(*keys, part, F.array_join(F.flatten(F.col("lanes.s")), "").alias("samples")))


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing samples: an estimate of the generalised Jaccard similarity."""
    at = lambda s, i: F.substr(s, i * WIDTH + 1, F.lit(WIDTH))
    same = F.aggregate(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), F.lit(0),
                       lambda n, i: n + (at(a, i) == at(b, i)).cast("int"))
    return same / F.lit(float(SAMPLES))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness (columns doc_id, text).

    The edited text has its last third replaced by the beginning of the next document in
    descending doc_id. Texts cross one shuffle, the replacing beginnings another; both joins are by sorted
    merge, which spills.
    """
    whole = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = whole.withColumn("k2", F.xxhash64("text")).withColumn("k1", F.xxhash64("doc_id", "k2"))
    ids = keyed.groupBy("doc_id", *KEY).agg(F.count(F.lit(1)).alias("copies"), F.first(F.length("text")).alias("n"))
    ranked = materialize(global_rank(ids, [F.col("doc_id").desc_nulls_last(), F.col("k2").asc()], "fp_ids"), "fp_ranks")
    total = max(1, ranked.count())
    nexts = ranked.select((F.pmod(F.col("rank") - 1, F.lit(total))).alias("rank"), F.col("k1").alias("n1"),
                          F.col("k2").alias("n2"))
    links = materialize(ranked.join(nexts, "rank"), "fp_links")  # a document and the next one
    # one row per document: repeated rows meet here, in a hash aggregate of the partition, and nowhere later
    texts = keyed.select(*KEY, "text").repartition(*KEY).groupBy(*KEY, "text").agg(F.count(F.lit(1)).alias("rows")).drop("rows")
    # what each document lends to the one before it: as many code points as that one replaces
    lent = links.select(F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.col("k1").alias("p1"),
                        F.col("k2").alias("p2"), F.floor(F.col("n") / 3).cast("int").alias("cut"))
    heads = texts.join(lent, KEY).select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "cut",
                                         F.expr("substring(text, 1, cut)").alias("head"))
    both = texts.join(heads, KEY).select(
        *KEY, "text", F.expr("concat(substring(text, 1, length(text) - cut), head)").alias("edited"))
    parts = both.select(*KEY, F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("part"), F.col("edited").alias("text")))).alias("x")).select(
        *KEY, "x.part", "x.text")
    signed = signatures(parts, KEY)
    signed = signed.groupBy(*KEY).agg(F.first(F.when(F.col("part") == 0, F.col("samples")), True).alias("fp"),
                                      F.first(F.when(F.col("part") == 1, F.col("samples")), True).alias("efp"))
    digests = both.select(*KEY, F.sha2("edited", 256).alias("edited_sha256"))
    done = materialize(signed.join(digests, KEY).join(links, KEY), "fp_signed")
    other = done.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("fp").alias("nfp"))
    return done.join(other, ["n1", "n2"]).select(
        "doc_id", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        F.col("fp").alias("fingerprint"), F.col("efp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("nfp")).alias("near_next")).drop("copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every whole text."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = texts.select("doc_id", F.xxhash64("text").alias("k2"), F.xxhash64("doc_id", "text").alias("k1"),
                       F.lit(0).alias("part"), "text")
    once = key.groupBy("doc_id", *KEY, "part", "text").agg(F.count(F.lit(1)).alias("times"))
    out = signatures(once.drop("doc_id", "times"), KEY)
    return out.join(once.select("doc_id", *KEY, "times"), KEY).select(
        "doc_id", F.col("samples").alias("fingerprint"),
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")


def op2_fingerprint(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op2_fingerprint": op2_fingerprint}
