"""Mixing sources to target weights by dependent (pivotal) rounding.

Every document of a source has the same expected number of copies, its source's target over
its source's size. The whole part is certain; the fraction is a copy probability. The pivotal
method rounds the fractions together: two documents fight, words move from one to the other
until one of the probabilities is 0 or 1, and the other one fights on. A move keeps the
expected words of the pair, so a source ends within one document of its target, and a move's
direction is drawn so that each document's probability is kept in expectation. A few last
exchanges of one document per source then close what that last document left open.

Fights run in a reduction tree: documents are hashed into blocks of about ``block`` rows,
each block is folded to one undecided document, and those documents form the next level's
blocks. A source of any size is spread over its blocks; nothing gathers a whole source.

DataFrame functions only. Defined results: a null or empty text has size 0 and takes 0 words;
a null source is a source (sorted last); rows equal in id, source and size are one unit, whose
rows all get the same number of copies; an empty table gives an empty result; other columns of
the input are ignored by ``mix_plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import global_rank, uniform

WORD = r"[^\x20\x09-\x0D]+"
#: Exchanges of one document per source after the rounding.
EXCHANGES = 3
_UNIT = "struct<doc_id:{t},source:string,size:bigint,mult:bigint,base:bigint>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=(5.0, 2.0, 1.0), limit: float = 3.0) -> DataFrame:
    """One row per source: ``source, source_size, units, target``.

    Sources in code point order (null last) take the weights in turn and share all words in
    proportion; a target stops at ``limit`` times its source's size and the excess is shared
    again by weight among the others, until none is above. Each round is one aggregate over
    the sources that returns two numbers.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("units"))
    ranked = global_rank(per, [F.col("source").asc_nulls_last()], "mix_sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight), "mix_weights")
    cap = F.col("source_size") * F.lit(limit)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, fixed = None, -1
    while True:
        over = F.lit(False) if level is None else (F.col("weight") * F.lit(level) > cap)
        n, held, free = ranked.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == fixed or free == 0:
            break
        fixed, level = n, (total - held) / free
    share = cap if level is None else F.least(cap, F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", "units", share.cast("double").alias("target"))


def _fold(items: str, unit: str) -> str:
    """SQL that folds an array of (k, p, s) to the decided units and at most one undecided."""
    carry = f"cast(null as struct<k:{unit},p:double,s:double>)"
    done = f"cast(array() as array<struct<k:{unit},extra:bigint>>)"
    # a: words that acc may gain from x; b: words that acc may give to x; up: acc gains
    fight = ("transform(array(struct(least((1 - acc.cur.p) * acc.cur.s, x.p * x.s) as a, "
             "least(acc.cur.p * acc.cur.s, (1 - x.p) * x.s) as b)), f -> struct(f.a as a, f.b as b, "
             "pmod(xxhash64(acc.cur.k, x.k, 17L), 9007199254740992L) / 9007199254740992D "
             "* (f.a + f.b) < f.b as up))")
    # of the two, one is decided: (decided unit, its copies, the other, the other's probability)
    outcome = (
        "case "
        "when f.up and f.a >= (1 - acc.cur.p) * acc.cur.s then "
        "struct(acc.cur.k as k, 1L as extra, x.k as rk, x.p - f.a / x.s as rp, x.s as rs) "
        "when f.up then "
        "struct(x.k as k, 0L as extra, acc.cur.k as rk, acc.cur.p + f.a / acc.cur.s as rp, acc.cur.s as rs) "
        "when f.b >= acc.cur.p * acc.cur.s then "
        "struct(acc.cur.k as k, 0L as extra, x.k as rk, x.p + f.b / x.s as rp, x.s as rs) "
        "else struct(x.k as k, 1L as extra, acc.cur.k as rk, acc.cur.p - f.b / acc.cur.s as rp, acc.cur.s as rs) end")
    merge = (f"if(acc.cur is null, struct(struct(x.k as k, x.p as p, x.s as s) as cur, acc.done as done), "
             f"transform(transform({fight}, f -> {outcome}), o -> struct("
             f"struct(o.rk as k, greatest(0D, least(1D, o.rp)) as p, o.rs as s) as cur, "
             f"concat(acc.done, array(struct(o.k as k, o.extra as extra))) as done))[0])")
    return f"aggregate({items}, struct({carry} as cur, {done} as done), (acc, x) -> {merge})"


def mix_plan(docs: DataFrame, weights=(5.0, 2.0, 1.0), limit: float = 3.0, block: int = 64,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, n_rows, copies, source_size, target``: one row per unit."""
    id_type = docs.schema[id_col].dataType.simpleString()
    unit = _UNIT.format(t=id_type)
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"),
                                    F.col(source_col).cast("string").alias("source"),
                                    word_count(F.col(text_col).cast("string")).alias("size")), "mix_sizes")
    targets = materialize(source_targets(sized, weights, limit), "mix_targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.round(rate)
    rate = F.when(F.abs(rate - near) < 1e-9, near).otherwise(rate)
    units = (sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("mult"))
             .join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
             .withColumn("__rate", rate)
             .withColumn("base", F.floor("__rate").cast("long"))
             .select(F.struct("doc_id", "source", "size", "mult", "base").cast(unit).alias("k"),
                     (F.col("__rate") - F.col("base")).alias("p"),
                     (F.col("size") * F.col("mult")).cast("double").alias("s"), "units"))
    open_ = (F.col("p") > 0) & (F.col("s") > 0)
    # documents without words move no words: each is drawn for itself
    alone = F.when(F.col("p") > uniform("k", F.lit(29)), 1).otherwise(0)
    units = materialize(units, "mix_units")
    decided = [units.filter(~open_).select("k", F.when(F.col("p") > 0, alone).otherwise(0)
                                           .cast("long").alias("extra"))]
    level = units.filter(open_)
    most = targets.agg(F.max("units")).first()[0] or 0
    depth = 0
    while most > 1:
        depth += 1
        blocks = F.ceil(F.col("units") / F.lit(block))
        folded = materialize(
            level.groupBy("k.source", "units",
                          F.pmod(F.xxhash64("k", F.lit(depth)), blocks).alias("b"))
            .agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("k", F.lit(depth + 1000)).alias("o"),
                                                      "k", "p", "s"))).alias("items"))
            .select("units", F.expr(_fold("items", unit)).alias("r"))
            .select("units", "r.cur", "r.done"), f"mix_level{depth}")
        decided.append(folded.select(F.explode("done").alias("d")).select("d.k", "d.extra"))
        level = folded.select("cur.k", "cur.p", "cur.s", F.ceil(F.col("units") / F.lit(block)).alias("units"))
        most = -(-most // block)
    # what is left of a source: one document, drawn by its probability
    last = F.when(F.col("p") > uniform("k", F.lit(31)), 1).otherwise(0).cast("long")
    decided.append(level.select("k", last.alias("extra")))
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    plan = materialize(
        out.select("k.*", "extra")
        .join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        .withColumn("open", (F.col("target") < F.col("source_size") * F.lit(limit)) & (F.col("size") > 0))
        .drop("__s"), "mix_rounded")
    for k in range(EXCHANGES):
        plan = materialize(_settle(plan), f"mix_settled{k}")
    return plan.select("doc_id", "source", "size", F.col("mult").alias("n_rows"),
                                (F.col("base") + F.col("extra")).alias("copies"), "source_size", "target")


def _settle(plan: DataFrame) -> DataFrame:
    """One exchange per source: the unit whose change brings the words taken nearest the target.

    The last undecided document of a source may be a long one. Per source one aggregate finds
    the unit that, taken once more or once less, closes most of the gap, if any does. What is left is
    closed by smaller units: the plan is settled EXCHANGES times.
    """
    words = F.col("size") * F.col("mult")
    gaps = plan.groupBy("source").agg(
        (F.first("target") - F.sum((F.col("base") + F.col("extra")) * words)).alias("gap"))
    gaps = gaps.withColumnRenamed("source", "__s")
    at = F.col("source").eqNullSafe(F.col("__s"))
    step = F.when(F.col("extra") == 0, words).otherwise(-words)
    left = F.abs(F.col("gap") - step)
    best = (plan.filter("open").join(gaps, at).filter(left < F.abs("gap"))
            .groupBy("source").agg(F.min(F.struct(left.alias("left"), F.xxhash64("doc_id", "size").alias("o"),
                                                  "doc_id", "size")).alias("m"))
            .select(F.col("source").alias("__s"), F.col("m.doc_id").alias("__d"), F.col("m.size").alias("__z")))
    hit = F.col("__z").isNotNull()
    return (plan.join(best, at & F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("size") == F.col("__z")), "left")
            .withColumn("extra", F.when(hit, 1 - F.col("extra")).otherwise(F.col("extra"))).select(*plan.columns))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed table: every row of ``docs`` as often as the plan takes it, same columns."""
    id_col, text_col, source_col = (kw.get(k, d) for k, d in
                                    (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    plan = mix_plan(docs, **kw).filter("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
        F.col("size").alias("__size"), F.col("copies").alias("__copies"))
    # the right side has one row per unit, so the join repeats no row
    joined = docs.join(plan, F.col(id_col).eqNullSafe(F.col("__id"))
                       & F.col(source_col).cast("string").eqNullSafe(F.col("__source"))
                       & (word_count(F.col(text_col).cast("string")) == F.col("__size")))
    return (joined.withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op1_mix(spark, sf_dir: str) -> DataFrame:
    from .common import table
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return (plan.withColumn("__r", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"))


QUERIES = {"op1_mix": op1_mix}
