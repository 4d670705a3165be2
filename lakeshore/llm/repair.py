"""Repair of conversation structure: the cheapest edits, decided by one integer minimum.

A conversation is right if its role initials read ``(s?(ua)+)?``. Every row may be kept (K, 0),
given another role (R, 3) or deleted (D, 4, and a must for blank and repeated rows), empty turns may
be inserted anywhere (I, 3), and a truncated row that stays costs 3 more. Among the cheapest
edits the ones whose initials are least in ASCII order win.

Both wishes are one number. An edge of the repair graph weighs its cost in the high digits and its
audit letters in the low ones: every row owns a slot of three octal digits (at most two inserts,
then the row's own letter), left-aligned and padded with zeros at the end. The row's letter closes
its slot, so no slot is a prefix of another and the order of the digits is the order of the
letters. Weights add along a path, and the plain minimum of integers over the graph (rows by four
states: nothing yet, after a system, user, assistant turn) is the answer; its digits are the audit.

How it is spread: rows are sorted over the whole table and written once (no task sees a
conversation as a group), repeats are found by a map-side minimum per (conversation, digest) that is
joined back, and the graph is cut into blocks of ``BLOCK`` rows. A block's answer is a 4 x 4
table of least weights, and ``FAN`` neighbouring tables are multiplied (minimum, plus) per step
until one is left per conversation. Only letters move there, three per byte. Writing the repaired
rows needs them in order, so a conversation's rows stream through one task in Arrow batches (sorted
by Spark, which spills); the audit itself, a letter per row in one value, is what bounds a conversation.

Defined results: null role or text is one space (such a text is blank, such a role is none of the
three). Initials are the first characters as they are; an empty role has none and is never legal. A null
``conv_id`` is a conversation of its own; null turns come first. Rows of one turn go by role and a
64-bit hash of the text; equal rows are repeats. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import crc32_mod, join_same, sorted_copy, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows per block of the graph, and blocks per step of the multiplication.
BLOCK, FAN = 256, 32
#: Letters and digits; the digits' order is the letters' order, 0 is the padding.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
SLOT_BITS = 9
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
         (USER, "a"): ASSISTANT}
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
#: A row's code: its initial, and whether it is sound (lower case), truncated (upper case) or must go.
SOUND, CUT, GONE = "suax", "SUAX", "1234"
INITIAL = {c: i for codes in (SOUND, CUT, GONE) for c, i in zip(codes, SOUND)}


# --- the graph: plain integers --------------------------------------------------------------

def _inserts(state: int) -> Iterator[tuple[int, int]]:
    """States that up to two inserted turns lead to, with their number."""
    yield state, 0
    for role in "ua":
        if (one := AFTER.get((state, role))) is not None:
            yield one, 1
            for other in "ua":
                if (two := AFTER.get((one, other))) is not None:
                    yield two, 2


def _slot(inserted: int, letter: str = "") -> int:
    digits = [DIGIT["I"]] * inserted + [DIGIT[c] for c in letter]
    return sum(d << 3 * (2 - k) for k, d in enumerate(digits))


def _edges(code: str) -> list[list[tuple[int, int, int]]]:
    """For every state before the row: (state after, cost, slot) of each way to treat it."""
    extra = TRUNCATED if code in CUT else 0
    out = []
    for state in range(4):
        ways = []
        for mid, n in _inserts(state):
            ways.append((mid, n * INSERT + DELETE, _slot(n, "D")))
            if code in GONE:
                continue
            kept = AFTER.get((mid, INITIAL[code]))
            if kept is not None:
                ways.append((kept, n * INSERT + KEEP + extra, _slot(n, "K")))
            ways += [(AFTER[mid, role], n * INSERT + REROLE + extra, _slot(n, "R"))
                     for role in "ua" if (mid, role) in AFTER]
        out.append(ways)
    return out


EDGES = {c: _edges(c) for c in SOUND + CUT + GONE}
#: What may follow the last row: inserts alone.
CLOSING = [[(mid, n * INSERT, _slot(n)) for mid, n in _inserts(state) if mid in ENDS] for state in range(4)]

Weights = list[list[int | None]]


def _least(slots: list[list[list[tuple[int, int, int]]]]) -> Weights:
    """Least weight from every state before the slots to every state after them."""
    n = len(slots)
    out: Weights = []
    for first in range(4):
        best: list[int | None] = [None] * 4
        best[first] = 0
        for k, edges in enumerate(slots):
            at, top = SLOT_BITS * (n - 1 - k), SLOT_BITS * n
            new: list[int | None] = [None] * 4
            for state, weight in enumerate(best):
                if weight is None:
                    continue
                for to, cost, slot in edges[state]:
                    w = weight + (cost << top) + (slot << at)
                    if new[to] is None or w < new[to]:
                        new[to] = w
            best = new
        out.append(best)
    return out


def _product(a: Weights, b: Weights, rows_a: int, rows_b: int) -> Weights:
    """Weights over a's rows and then b's: costs add, a's letters stand before b's."""
    low = SLOT_BITS * rows_b
    mask, top = (1 << low) - 1, SLOT_BITS * (rows_a + rows_b)
    moved = [[None if w is None else (w >> low << top) + (w & mask) for w in row] for row in b]
    return [[min((wa + moved[mid][to] for mid, w in enumerate(row) if w is not None and moved[mid][to] is not None
                  for wa in (w << low,)), default=None) for to in range(4)] for row in a]


def _summary(codes: str) -> tuple[int, int, str, str, Weights]:
    """(rows, illegal pairs, first initial, last initial, weights) of a block."""
    roles = [INITIAL[c] for c in codes]
    illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))
    return len(codes), illegal, roles[0], roles[-1], _least([EDGES[c] for c in codes])


def _joined(a: tuple, b: tuple) -> tuple:
    return (a[0] + b[0], a[1] + b[1] + (a[3] + b[2] not in LEGAL), a[2], b[3], _product(a[4], b[4], a[0], b[0]))


def _pack(s: tuple) -> str:
    return "|".join([*map(str, s[:4]), ",".join("" if w is None else f"{w:x}" for row in s[4] for w in row)])


def _unpack(text: str) -> tuple:
    rows, illegal, first, last, weights = text.split("|")
    flat = [int(w, 16) if w else None for w in weights.split(",")]
    return int(rows), int(illegal), first, last, [flat[k:k + 4] for k in range(0, 16, 4)]


def _decided(s: tuple) -> tuple[int, int, str]:
    """(illegal pairs, cost, audit) of a whole conversation."""
    rows = s[0] + 1
    weight = min(w for w in _product(s[4], _least([CLOSING]), s[0], 1)[START] if w is not None)
    low = SLOT_BITS * rows
    letters = format(weight & (1 << low) - 1, "o").replace("0", "").translate(str.maketrans("1234", "DIKR"))
    return s[1], weight >> low, letters


# --- on tables --------------------------------------------------------------------------------

def sorted_rows(conversations: DataFrame, name: str = "repair_rows") -> DataFrame:
    """All rows with ``rank``, their order by conversation and turn; written once."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"))
    return sorted_copy(rows, [F.col("conv_id"), F.col("turn"), F.col("role"), F.xxhash64("text")], name)


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, rank, first, initial`` and the row's first fault: blank, duplicate, truncated."""
    rest = F.rtrim(F.col("text"), F.lit(WHITE))
    slim = rows.select(
        "conv_id", "turn", "rank", F.substring("role", 1, 1).alias("initial"), (rest == "").alias("blank"),
        (~F.right(rest, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.sha2(F.concat_ws("", F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"))
    seen = slim.groupBy("conv_id", "digest").agg(F.min("rank").alias("seen"))
    starts = slim.groupBy("conv_id").agg(F.min("rank").alias("first"))
    slim = join_same(join_same(slim, seen, ["conv_id", "digest"]), starts, ["conv_id"])
    duplicate = ~F.col("blank") & (F.col("rank") > F.col("seen"))
    return slim.select("conv_id", "turn", "rank", "first", "initial", "blank", duplicate.alias("duplicate"),
                       (~F.col("blank") & ~duplicate & F.col("cut")).alias("truncated"))


def _code() -> Column:
    at = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.col("initial")), F.lit(0)), F.lit(4))
    at = F.when(F.col("initial") == "", F.lit(4)).otherwise(at)
    codes = F.when(F.col("blank") | F.col("duplicate"), F.lit(GONE)).when(F.col("truncated"), F.lit(CUT))
    return F.substring(codes.otherwise(F.lit(SOUND)), at, F.lit(1))


def audits(found: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit`` of every conversation that has rows, from :func:`faults`."""
    @F.pandas_udf("string")
    def block(codes: pd.Series) -> pd.Series:
        known: dict[str, str] = {}
        for c in codes.unique():
            known[c] = _pack(_summary(c))
        return codes.map(known)

    @F.pandas_udf("string")
    def product(parts: pd.Series) -> pd.Series:
        def one(texts) -> str:
            out = _unpack(texts[0])
            for t in texts[1:]:
                out = _joined(out, _unpack(t))
            return _pack(out)
        return parts.map(one)

    @F.pandas_udf("illegal long, cost long, audit string")
    def decided(parts: pd.Series) -> pd.DataFrame:
        known = {p: _decided(_unpack(p)) for p in parts.unique()}
        return pd.DataFrame([known[p] for p in parts], columns=["illegal", "cost", "audit"])

    def in_order(value: str, by: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(by, value))), lambda x: x[value])

    place = F.col("rank") - F.col("first")
    coded = found.select("conv_id", place.alias("place"), F.floor(place / BLOCK).alias("block"), _code().alias("code"))
    # at most BLOCK letters a group
    blocks = (coded.groupBy("conv_id", "block").agg(F.array_join(in_order("code", "place"), "").alias("codes"))
              .select("conv_id", "block", block("codes").alias("part")))
    last = coded.agg(F.max("block")).first()[0] or 0
    while last:
        blocks = (blocks.groupBy("conv_id", F.floor(F.col("block") / FAN).alias("block"))
                  .agg(in_order("part", "block").alias("parts"))
                  .select("conv_id", "block", product("parts").alias("part")))
        last //= FAN
    return blocks.select("conv_id", decided("part").alias("d")).select("conv_id", "d.*")


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """The conversations after their edits: ``conv_id, place, edit, turn, role, text``, in order.

    ``rows`` as :func:`sorted_rows` gives them. Inserted rows have an empty text and no turn. The
    result's partitions hold whole conversations, sorted; the order holds for narrow steps.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()
    marks = audit.select("conv_id", F.lit(-1).cast("long").alias("rank"), F.lit(None).cast(turn).alias("turn"),
                         F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    # conv_id and turn cross to Python as text: pandas turns integers with nulls among them into floats
    both = rows.select("conv_id", "rank", "turn", "role", "text").unionByName(marks)
    dealt = (both.select(*(F.col(c).cast("string").alias(c) for c in ("conv_id", "turn")), "rank", "role", "text")
             .repartition("conv_id").sortWithinPartitions("conv_id", "rank"))
    columns = ["conv_id", "place", "edit", "turn", "role", "text"]

    def edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, at, closing, place, state = "", 0, 0, 0, START

        def turned(conv, letter, turn, role, text):
            nonlocal at, place, state
            if letter in "IR":
                role = "assistant" if state == USER else "user"
            at, place, state = at + 1, place + 1, AFTER[state, role[0]]
            return conv, place - 1, letter, turn, role, text

        def inserts(conv):
            while at < len(letters) and letters[at] == "I":
                yield turned(conv, "I", None, None, "")

        def applied(conv, rank, turn, role, text):
            nonlocal letters, at, closing, place, state
            if rank < 0:  # the conversation's audit comes before its rows
                letters, at, closing, place, state = text, 0, len(text.rstrip("I")), 0, START
                return
            yield from inserts(conv)
            if letters[at] == "D":
                at += 1
            else:
                yield turned(conv, letters[at], turn, role, text)
            if at == closing:
                yield from inserts(conv)

        for b in batches:
            rows = zip(*(b[c] for c in ("conv_id", "rank", "turn", "role", "text")))
            yield pd.DataFrame([out for row in rows for out in applied(*row)], columns=columns)

    out = dealt.mapInPandas(edit, "conv_id string, place long, edit string, turn string, role string, text string")
    return out.withColumns({"conv_id": F.col("conv_id").cast(kind), "turn": F.col("turn").cast(turn)})


def text_digests(turns: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of ``role:text`` lines joined by newlines, for :func:`repaired`'s result.

    One pass over whole, sorted conversations: the hash takes a batch at a time.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for b in batches:
            out = []
            for conv, place, line in zip(b["conv_id"], b["place"], b["line"]):
                if place == 0:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode("utf-8", "surrogatepass"))
            yield pd.DataFrame(out, columns=["conv_id", "sha256"])
        if state is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["conv_id", "sha256"])

    out = (turns.select(F.col("conv_id").cast("string").alias("conv_id"), "place",
                        F.concat("role", F.lit(":"), "text").alias("line"))
           .mapInPandas(digest, "conv_id string, sha256 string"))
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))


def report(found: DataFrame, audit: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` per conversation."""
    total = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    turns = found.groupBy("conv_id", "turn").agg(*(total(c) for c in ("blank", "duplicate", "truncated")))
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(total(c) for c in ("blank", "duplicate", "truncated")))
    return join_same(counts, audit, ["conv_id"])


# --- the registered query ---------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32(`conv_id:turn`) % 20, see the query; nulls are one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                crc32_mod(key, 20).alias("fault"))
    text = (F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.filter("fault <> 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")).drop("copy"))


def op11_repair(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = sorted_rows(damaged(conversations))
    found = materialize(faults(rows), "repair_faults")
    audit = materialize(audits(found), "repair_audits")
    told = report(found, audit)
    digests = text_digests(repaired(rows, audit)).withColumnRenamed("sha256", "repaired_sha256")
    every = conversations.select("conv_id").distinct()
    out = join_same(join_same(every, told, ["conv_id"], "left"), digests, ["conv_id"], "left")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.withColumns(zeros | {
        "audit": F.coalesce("audit", F.lit("")),
        "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})


QUERIES = {"op11_repair": op11_repair}

# The same in SQL: crc32 by its byte table, and the least (cost, audit) per state, row by row. A way is
# (state before, state after, cost, letters, lines written before the row's own); the row's own line may follow.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES = {"op11_repair": f"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_concat([4294967295], list_transform(
           string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
           lambda d: cast(ascii(d) as bigint))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as fault
  from conversations, crc_table),
damaged as (
  select conv_id, turn, case fault when 4 then 'user' else role end as role,
         case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from keyed, range(2) copies(copy) where fault <> 0 and (copy = 0 or fault = 3)),
every as (select distinct conv_id from conversations),
convs as (select conv_id, row_number() over () as conv from every),
placed as (
  select c.conv, d.*, left(d.role, 1) as initial, rtrim(d.text, {_WHITE}) as body,
         row_number() over (partition by c.conv order by d.turn nulls first, d.role, d.text) as i
  from damaged d join convs c on c.conv_id is not distinct from d.conv_id),
judged as (
  select *, body = '' as blank, body <> '' and row_number() over (partition by conv, role, text order by i) > 1 as duplicate,
         lag(initial) over (partition by conv order by i) || initial as pair from placed),
rows_ as (select *, not blank and not duplicate and right(body, 1) not in ('.', '!', '?') as truncated from judged),
put(a, b, cost, letters, lines) as (values
  ('', '', 0, '', []::varchar[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
  ('', 'u', {INSERT}, 'I', ['user:']), ('s', 'u', {INSERT}, 'I', ['user:']), ('a', 'u', {INSERT}, 'I', ['user:']), ('u', 'a', {INSERT}, 'I', ['assistant:']),
  ('', 'a', {2 * INSERT}, 'II', ['user:', 'assistant:']), ('s', 'a', {2 * INSERT}, 'II', ['user:', 'assistant:']),
  ('a', 'a', {2 * INSERT}, 'II', ['user:', 'assistant:']), ('u', 'u', {2 * INSERT}, 'II', ['assistant:', 'user:'])),
step(a, initial, b) as (values ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
treat as (
  select r.conv, r.i, q.a as a, q.a as b, {DELETE} as cost, 'D' as letter, []::varchar[] as line
  from rows_ r, (select distinct a from put) q
  union all
  select r.conv, r.i, s.a, s.b, {TRUNCATED} * cast(r.truncated as int), 'K', [r.role || ':' || r.text]
  from rows_ r join step s on s.initial = r.initial where not r.blank and not r.duplicate
  union all
  select r.conv, r.i, s.a, s.b, {REROLE} + {TRUNCATED} * cast(r.truncated as int), 'R',
         [case s.initial when 'u' then 'user' else 'assistant' end || ':' || r.text]
  from rows_ r, step s where s.initial <> 's' and not r.blank and not r.duplicate),
best(conv, i, state, w) as (
  select conv, cast(0 as bigint), '', {{'cost': cast(0 as bigint), 'audit': '', 'lines': []::varchar[]}} from convs
  union all
  select x.conv, x.i + 1, t.b, min({{'cost': cast(x.w.cost + p.cost + t.cost as bigint), 'audit': x.w.audit || p.letters || t.letter,
                                    'lines': list_concat(list_concat(x.w.lines, p.lines), t.line)}})
  from best x join put p on p.a = x.state join treat t on t.conv = x.conv and t.i = x.i + 1 and t.a = p.b
  group by x.conv, x.i, t.b),
lengths as (select conv, count(*) as n from rows_ group by conv),
done as (
  select x.conv, min({{'cost': cast(x.w.cost + p.cost as bigint), 'audit': x.w.audit || p.letters, 'lines': list_concat(x.w.lines, p.lines)}}) as w
  from best x join lengths l on l.conv = x.conv and l.n = x.i join put p on p.a = x.state and p.b in ('', 'a') group by x.conv),
told as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
         count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
         count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from rows_ group by conv)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(w.cost, 0) as cost, coalesce(w.audit, '') as audit,
       sha256(coalesce(array_to_string(w.lines, chr(10)), '')) as repaired_sha256
from convs c left join told using (conv) left join done using (conv)"""}
