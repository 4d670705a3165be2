"""Chat formatting: typed content parts become one template string per conversation.

Each turn is ``### role: body</turn>`` and a newline. A visitor over the turn's parts writes
text escaped and every image, audio or document part as a placeholder ``<|kind|>``; it records
the part's reference and the number of tokens the placeholder expands to. Control strings in
a role or a text are replaced by two-character escapes, so none of them can occur in escaped
text, the template can be split by plain search, and unescaping gives the text back. Adjacent
text parts are kept apart by an escape that stands for nothing, so none arises across them either.

DataFrame functions only. Defined results: a null role or text is empty; turns are taken by
turn number, then role, then body (nulls first), so repeated rows stay, next to each other; a
null conversation id is one conversation; an unknown part kind is a placeholder of its kind
with no tokens; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: (control string, its escape); the escape character itself comes first when writing.
ESCAPES = [("\\", "\\s"), ("</turn>", "\\t"), ("###", "\\h"), ("<|", "\\p")]
#: Stands for nothing, between two text parts.
SEAM = "\\e"
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
OPEN, SPLIT, CLOSE = "### ", ": ", "</turn>\n"
#: Fields of a content part.
PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


def escape(c: Column, table_=ESCAPES) -> Column:
    c = F.coalesce(c, F.lit(""))
    for raw, esc in table_:
        c = F.replace(c, F.lit(raw), F.lit(esc))
    return c


def unescape(c: Column, table_=ESCAPES) -> Column:
    # every backslash left opens an escape, so the backslash's own escape is undone last
    c = F.replace(c, F.lit(SEAM), F.lit(""))
    for raw, esc in reversed(table_):
        c = F.replace(c, F.lit(esc), F.lit(raw))
    return c


def text_part(text: Column) -> Column:
    """A one-part content array for a plain text column."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), none.alias("ref"),
                            none.alias("width"), none.alias("height"), none.alias("seconds"),
                            none.alias("pages")).cast(PART))


def _part_body(p: Column, kind: Column, before: Column) -> Column:
    seam = F.when(before == "text", F.lit(SEAM)).otherwise(F.lit(""))
    return F.when(kind == "text", F.concat(seam, escape(p["text"]))).otherwise(
        F.concat(F.lit("<|"), escape(kind, ROLE_ESCAPES), F.lit("|>")))


def _part_tokens(p: Column, kind: Column, patch: int, rate: float, page: int) -> Column:
    image = F.ceil(F.coalesce(p["width"], F.lit(0)) / patch) * F.ceil(F.coalesce(p["height"], F.lit(0)) / patch)
    audio = F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * rate)
    return (F.when(kind == "image", image).when(kind == "audio", audio)
            .when(kind == "document", F.coalesce(p["pages"], F.lit(0)) * page).otherwise(0).cast("long"))


def format_conversations(turns: DataFrame, loss_role: str = "assistant", patch: int = 14,
                         audio_rate: float = 25.0, page_tokens: int = 1024) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, parts).

    ``formatted`` is the template string, ``loss_spans`` the (start, length) code point ranges
    of the bodies under the loss mask, ``attachments`` the non-text parts in order with
    reference, offset of the placeholder and expanded tokens, ``expanded_tokens`` their sum.
    Offsets come from a running sum over the conversation's turns; the strings are then
    concatenated once.
    """
    kind = lambda p: F.coalesce(p["kind"], F.lit("unknown"))
    visited = F.transform(
        F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")),
        lambda p, i: F.struct(_part_body(p, kind(p), F.get("parts", i - 1)["kind"]).alias("body"), kind(p).alias("kind"), p["ref"].alias("ref"),
                           _part_tokens(p, kind(p), patch, audio_rate, page_tokens).alias("tokens")))
    rows = (turns.select("conv_id", "turn", "role", visited.alias("visited"))
            .withColumn("body", F.array_join(F.col("visited.body"), ""))
            .withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role").cast("string"), ROLE_ESCAPES), F.lit(SPLIT))))
    # the place of each attachment inside its body: the lengths of the parts before it
    marks = F.transform("visited", lambda v, i: F.struct(
        F.aggregate(F.slice("visited", F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x["body"])).alias("at"),
        v["kind"].alias("kind"), v["ref"].alias("ref"), v["tokens"].alias("tokens")))
    rows = rows.withColumn("marks", F.when(F.size("visited") > 1, F.filter(marks, lambda m: m["kind"] != "text"))
                           .otherwise(F.filter(F.transform("visited", lambda v: F.struct(
                               F.lit(0).alias("at"), v["kind"].alias("kind"), v["ref"].alias("ref"),
                               v["tokens"].alias("tokens"))), lambda m: m["kind"] != "text"))).drop("visited")
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.length("head") + F.length("body") + len(CLOSE)
    rows = (rows.withColumn("n", F.row_number().over(order))
            .withColumn("start", F.coalesce(F.sum(whole).over(before), F.lit(0)) + F.length("head")))
    masked = F.col("role") == loss_role
    per = rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("n", F.concat("head", "body", F.lit(CLOSE)).alias("s")))).alias("turns"),
        F.array_sort(F.collect_list(F.when(masked, F.struct("start", F.length("body").alias("length"))))).alias("loss_spans"),
        F.array_sort(F.collect_list(F.when(F.size("marks") > 0, F.struct("n", "start", "marks")))).alias("marks"))
    attachments = F.flatten(F.transform("marks", lambda t: F.transform(t["marks"], lambda m: F.struct(
        (t["start"] + m["at"]).alias("start"), m["kind"].alias("kind"), m["ref"].alias("ref"),
        m["tokens"].alias("tokens")))))
    return (per.withColumn("attachments", attachments)
            .select("conv_id", "n_turns", F.array_join(F.col("turns.s"), "").alias("formatted"), "loss_spans",
                    "attachments",
                    F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens")))


def parse_formatted(formatted: Column) -> Column:
    """The (role, text) of every turn, read back from a template string."""
    turns = F.split(formatted, r"\Q" + CLOSE + r"\E", -1)
    head = lambda t: F.instr(t, SPLIT)
    return F.transform(F.slice(turns, 1, F.size(turns) - 1), lambda t: F.struct(
        unescape(F.substr(t, F.lit(len(OPEN) + 1), head(t) - len(OPEN) - 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(t, head(t) + len(SPLIT))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


PROBE = "\\### Assistant: </turn> ok"


def op3_chat(spark, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    turns = table(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe)
    out = format_conversations(turns.withColumn("parts", text_part(F.col("text"))))
    read = (out.withColumn("turns", parse_formatted(F.col("formatted")))
            .withColumn("loss", masked_text(F.col("formatted"), F.col("loss_spans"))))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(joined, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


QUERIES = {"op3_chat": op3_chat}

_ESC = "coalesce({c}, '')"
for _raw, _to in ESCAPES:
    _ESC = f"replace({_ESC}, '{_raw}', '{_to}')"
ORACLES = {"op3_chat": f"""
with rows_ as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, 'assistant', '{PROBE}'),
turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         replace({_ESC.format(c='role')}, ':', '\\c') as erole, {_ESC.format(c='text')} as etext
  from rows_),
per as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, etext) as whole,
         coalesce(string_agg(text, '' order by turn nulls first, role, etext) filter (role = 'assistant'), '') as loss,
         sum(length(erole) + length(etext) + {len(OPEN) + len(SPLIT) + len(CLOSE)}) as formatted_chars
  from turns group by conv_id)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss) as loss_chars,
       sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from per"""}
