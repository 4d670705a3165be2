"""Order-to-campaign attribution: the best campaign within a look-back window.

``best_in_window`` returns, per order row, the campaign that ranks first (highest
discount, then latest date, then highest id) among the campaigns of the same customer with
``campaign_ts <= order_ts <= campaign_ts + days``, *without* forming the order x campaign
pairs. With d the order's UTC day and h its hour, the window [t - W, t] (W = days) is cut
into

* campaigns of day d, hour h, at or before t       -> running max in (customer, d, h)
* campaigns of day d - days, hour h, from t - W on -> campaigns moved forward by W,
                                                      reverse running max in (customer, d, h)
* everything else                                  -> per-(customer, day, hour) maxima:
  earlier hours of day d, later hours of the moved day d - days, and whole days
  d - days + 1 .. d - 1 (a range frame over the day number)

On TIMESTAMP columns the window is N calendar days of the session time zone, as in SQL: the
moved copy sits at the true end, cells are half days (so that a window always leaves its first
cell), and since a clock change can shorten or lengthen a window by a cell, the whole cells in
between are looked up by each campaign's own span. Offset changes must be under 12 hours.

The raw rows meet only in (customer, day, hour) partitions, so the work is linear in
orders + campaigns and a busy customer is split by day and hour; the third part works on
aggregated rows only (a few per customer-hour). "Ranks first" is the maximum of a struct
whose leading fields are the ranking columns; in a struct NULL is the smallest value,
which matches ``ORDER BY ... DESC`` (NULLS LAST).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .joins import DAY_US, band_pairs, band_sides, day_of, epoch_micros, window_end

RANK = ("discount", "marketingdate", "marketingid")


def _rank_struct(cols: Sequence[str], rest: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in list(cols) + [c for c in rest if c not in cols]])


HOUR_US = 3_600_000_000


def best_in_window(orders: DataFrame, campaigns: DataFrame, *, days: int,
                   order_key: str = "customerid", order_ts: str = "transactiondate",
                   campaign_key: str = "targetedcustomerid", campaign_ts: str = "marketingdate",
                   rank: Sequence[str] = RANK, split_us: int = HOUR_US) -> DataFrame:
    """Every order row with the columns of its best campaign appended (NULL when none).

    ``split_us`` (a divisor of a day) cuts each customer-day once more: the raw rows meet
    in windows over (customer, day, split) only, and the parts of the order's own day
    outside its split come from per-split maxima (aggregated, at most 3 * day / split
    rows per customer-day). ``split_us = DAY_US`` keeps whole days.
    """
    if days < 1:
        raise ValueError("the attribution window must be at least one day")
    if split_us <= 0 or DAY_US % split_us:
        raise ValueError("split_us must divide a day")
    zoned = isinstance(campaigns.schema[campaign_ts].dataType, T.TimestampType)
    cell = DAY_US // 2 if zoned else DAY_US
    cells = days * DAY_US // cell
    spans = (cells - 1, cells, cells + 1) if zoned else (cells,)
    split_us = min(split_us, cell)
    if cell % split_us:
        raise ValueError("split_us must divide half a day for TIMESTAMP columns")
    camp_cols, ocols = campaigns.columns, orders.columns
    vtype = campaigns.select(_rank_struct(rank, camp_cols).alias("v")).schema["v"].dataType

    def sub(t: Column) -> Column:
        return (F.pmod(t, F.lit(cell)) / F.lit(split_us)).cast("bigint") \
            if split_us < cell else F.lit(0).cast("bigint")

    ok = F.col(order_key).isNotNull() & F.col(order_ts).isNotNull()
    o_us = epoch_micros(orders, order_ts)
    o = orders.filter(ok).select(F.col(order_key).alias("__c"), o_us.alias("__t"),
                                 F.struct(*[F.col(f"`{c}`") for c in ocols]).alias("__o"),
                                 day_of(o_us, cell).alias("__d"), sub(o_us).alias("__h"))
    otype = T.StructType([T.StructField(f.name, f.dataType, True) for f in orders.schema])
    none_o = F.lit(None).cast(otype).alias("__o")
    none_v = F.lit(None).cast(vtype).alias("__v")

    c = (campaigns.filter(F.col(campaign_key).isNotNull() & F.col(campaign_ts).isNotNull())
         .select(F.col(campaign_key).alias("__c"), epoch_micros(campaigns, campaign_ts).alias("__t"),
                 window_end(campaigns, campaign_ts, days).alias("__e"), _rank_struct(rank, camp_cols).alias("__v")))
    # tag 0: a campaign in its own day; tag 2: the campaign moved forward by the window
    # (both copies from one scan)
    copies = F.array(F.struct(F.col("__t").alias("t"), F.lit(0).alias("tag")),
                     F.struct(F.col("__e").alias("t"), F.lit(2).alias("tag")))
    xt = F.col("__x.t")
    span = (day_of(F.col("__e"), cell) - day_of(F.col("__t"), cell)).cast("int")
    raw = (c.select("__c", "__v", span.alias("__s"), F.explode(copies).alias("__x"))
           .select("__c", xt.alias("__t"), "__v", F.col("__x.tag").alias("__tag"), "__s",
                   day_of(xt, cell).alias("__d"), sub(xt).alias("__h")))
    # One aggregation (partial before the shuffle) gives, per (customer, day, split): the
    # best same-day campaign (tag 0), the best moved campaign (tag 2), and whether orders
    # fall there (tag 1).
    no_span = F.lit(0).alias("__s")
    per_split = (raw.select("__c", "__d", "__h", "__tag", "__s", "__v")
                 .unionByName(o.select("__c", "__d", "__h", F.lit(1).alias("__tag"), no_span, none_v))
                 .groupBy("__c", "__d", "__h", "__tag", "__s").agg(F.max("__v").alias("__v")))
    # For each (customer, day, split) holding orders, the best campaign outside that split:
    # same-day campaigns of earlier splits, moved campaigns of later splits, and same-day
    # campaigns of the whole days d - days + 1 .. d - 1 (a range frame over the day number, one
    # for each span that a window can have).
    # These rows are aggregates (at most 3 * day / split per customer and active day), so
    # partitioning them by customer alone is bounded by the time span, not by the data.
    # At equal split: moved (g=0) < order key (g=1) < same-day (g=2).
    grid = (per_split.select("*", F.when(F.col("__tag") == 2, 0)
                             .when(F.col("__tag") == 1, 1).otherwise(2).alias("__g"))
            .repartition("__c"))
    in_day = Window.partitionBy("__c", "__d").orderBy("__h", "__g")
    others = [F.max(F.when(F.col("__g") == 2, F.col("__v"))).over(
                  in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
              # the splits after this one: a running maximum in descending order
              F.max(F.when(F.col("__g") == 0, F.col("__v"))).over(
                  Window.partitionBy("__c", "__d").orderBy(F.col("__h").desc(), F.col("__g").desc())
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))]
    for n in spans:
        if n >= 2:
            back_to = Window.partitionBy("__c").orderBy("__d").rangeBetween(-(n - 1), -1)
            whole = (F.col("__g") == 2) & (F.col("__s") == n) if zoned else F.col("__g") == 2
            others.append(F.max(F.when(whole, F.col("__v"))).over(back_to))
    outside = (grid.select("__c", "__d", "__h", "__g", F.greatest(*others).alias("__v"))
               .filter(F.col("__g") == 1).drop("__g"))

    parts = [o.select("__c", "__d", "__h", "__t", F.lit(1).alias("__tag"), none_v, "__o"),
             raw.select("__c", "__d", "__h", "__t", "__tag", "__v", none_o)]
    parts.append(outside.select("__c", "__d", "__h", F.lit(None).cast("bigint").alias("__t"),
                                F.lit(3).alias("__tag"), "__v", none_o))
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)

    w = Window.partitionBy("__c", "__d", "__h").orderBy("__t", "__tag")

    # running maxima forth and back: a frame that ends with the partition would read the rest
    # of it again for every row
    back = Window.partitionBy("__c", "__d", "__h").orderBy(F.col("__t").desc(), F.col("__tag").desc())

    def pick(tag: int, over, hi=Window.currentRow) -> Column:
        return F.max(F.when(F.col("__tag") == tag, F.col("__v"))).over(
            over.rowsBetween(Window.unboundedPreceding, hi))

    best = [pick(0, w), pick(2, back), pick(3, w, Window.unboundedFollowing)]
    scored = u.select("__tag", "__o", F.greatest(*best).alias("__best")).filter(F.col("__tag") == 1)
    matched = scored.select(*[F.col("__o").getField(x).alias(x) for x in ocols],
                            *[F.col("__best").getField(x).alias(x) for x in camp_cols])
    unmatched = orders.filter(~ok).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in campaigns.schema])
    return matched.unionByName(unmatched)


def rank_order(rank: Sequence[str] = RANK) -> list[Column]:
    return [F.col(c).desc() for c in rank]


def double_attribution_flag(pairs: DataFrame, *, key: str = "orderid",
                            rank: Sequence[str] = RANK,
                            name: str = "double_attribution") -> DataFrame:
    """``CASE WHEN lag(key) OVER (PARTITION BY key ORDER BY rank DESC) = key THEN 1 ELSE 0``.

    1 on every row but the first of its key; 0 on the first row and on every row whose key
    is NULL (the comparison is NULL there).

    A window over the key would hold all pairs of one order in one task, and an order of a
    busy customer can have very many. Instead the first row per key is found by a partial +
    final aggregate (the maximum of the row as a struct led by the ranking columns), joined
    back on the key (AQE may split a heavy key), and only exact copies of that first row meet
    in a window, to give the flag 0 to one of them: every other row gets a partition of its
    own through a salt made of its content (the same on every rerun of a task).
    """
    cols = pairs.columns
    row = _rank_struct(rank, cols)
    best = (pairs.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__bk"))
            .agg(F.max(row).alias("__best")))
    j = pairs.join(best, F.col(key) == F.col("__bk"), "left")
    is_best = F.coalesce(row.eqNullSafe(F.col("__best")), F.lit(False))
    j = (j.withColumn("__isb", is_best)
         .withColumn("__salt", F.when(~F.col("__isb"), F.xxhash64(*[F.col(f"`{c}`") for c in cols]))))
    w = Window.partitionBy(key, "__isb", "__salt").orderBy(*rank_order(rank))
    flag = (F.when(F.col(key).isNull(), 0)
            .when(F.col("__isb") & (F.row_number().over(w) == 1), 0).otherwise(1))
    return j.withColumn(name, flag).select(*[F.col(f"`{c}`") for c in cols], name)


#: Orders of one customer from which on its pairs are joined day by day.
BUSY_ORDERS = 10_000


def flagged_pairs(orders: DataFrame, campaigns: DataFrame, *, days: int, key: str = "orderid",
                  order_key: str = "customerid", order_ts: str = "transactiondate",
                  campaign_key: str = "targetedcustomerid", campaign_ts: str = "marketingdate",
                  rank: Sequence[str] = RANK, name: str = "double_attribution") -> DataFrame:
    """``orders LEFT JOIN campaigns`` within the window, all pairs, with their ``double_attribution_flag``.

    A busy customer's pairs are as many as its orders times its campaigns, so they are neither
    written nor shuffled: they leave the join with their flag. What is written is the two sides
    of the join, a row per order and the campaigns' copies (two, or one per day for a busy customer).
    Which pair is the first of its key follows from the best campaign of each order row
    (``best_in_window``, which forms no pairs): ``double_attribution_flag`` over those rows marks
    the order row that holds it, and a pair is the first if its order row is marked and its
    campaign is that row's best. Of identical campaigns one is; of identical order rows one is marked.
    """
    ocols, ccols = orders.columns, campaigns.columns
    best = best_in_window(orders, campaigns, days=days, order_key=order_key, order_ts=order_ts,
                          campaign_key=campaign_key, campaign_ts=campaign_ts, rank=rank)
    # read twice by the flag: one row per order row
    best = materialize(best, "order_best")
    flagged = double_attribution_flag(best, key=key, rank=rank, name="__flag")
    own = [F.col(f"`{c}`").alias(f"__best{i}") for i, c in enumerate(ccols)]
    marked = flagged.select(*[F.col(f"`{c}`") for c in ocols], "__flag", *own)
    copies = campaigns.withColumn("__copy", F.row_number().over(
        Window.partitionBy(*[F.col(f"`{c}`") for c in ccols]).orderBy(F.col(f"`{ccols[0]}`"))))
    lb, rb = band_sides(marked, copies, left_key=order_key, right_key=campaign_key, left_ts=order_ts,
                        right_ts=campaign_ts, days=days, busy_rows=BUSY_ORDERS, spread_unmatched=True)
    pairs = band_pairs(materialize(lb, "order_marks"), materialize(rb, "campaign_buckets"), marked.columns,
                       copies.columns, order_key, campaign_key, "left")
    first = (F.col("__flag") == 0) & (F.coalesce(F.col("__copy"), F.lit(1)) == 1)
    for i, c in enumerate(ccols):
        first = first & F.col(f"`{c}`").eqNullSafe(F.col(f"__best{i}"))
    flag = F.when(F.col(key).isNull() | first, 0).otherwise(1)
    return pairs.select(*[F.col(f"`{c}`") for c in [*ocols, *ccols]], flag.alias(name))


def first_per_key(df: DataFrame, *, key: str = "orderid", rank: Sequence[str] = RANK,
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key under ``rank DESC`` (``row_number() = 1``); ties go by
    ``tie_break`` and then by the other columns, so reruns agree.

    ``rank() = 1`` is planned with a partial WindowGroupLimit before the shuffle and leaves only
    exact copies of a key's first row, which a second window of the same partitioning and order
    tells apart. Rows with a NULL key are all kept (as the lag-based flag keeps them): each
    content is a partition of its own, so they neither meet in one task nor need a second pass.
    """
    named = [*rank, *tie_break]
    order = [F.col(f"`{c}`").desc() for c in named + [c for c in df.columns if c not in named and c != key]]
    content = F.when(F.col(key).isNull(), F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    w = Window.partitionBy(key, "__own").orderBy(*order)
    first = (df.select("*", content.alias("__own")).select("*", F.rank().over(w).alias("__rank"))
             .filter(F.col("__rank") == 1))
    return (first.select("*", F.row_number().over(w).alias("__rn"))
            .filter((F.col("__rn") == 1) | F.col(key).isNull()).select(*[f"`{c}`" for c in df.columns]))
