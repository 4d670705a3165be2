"""Conversation repair against an enumeration of all edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakeshore.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
RIGHT = re.compile("(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def _rows_after_damage(rows):
    """conversation -> [(turn, role, text)] in order"""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


def _status(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _brute(rows, status):
    """Least (cost, audit) over every sequence of edits, by enumeration."""
    best = None
    ways = []
    for (_, role, text), s in zip(rows, status):
        extra = 3 if s == "truncated" else 0
        ways.append([(4, "D", None)] + ([] if s in ("blank", "duplicate") else
                    [(extra, "K", (role, text)), (3 + extra, "R", ("user", text)), (3 + extra, "R", ("assistant", text))]))
    gaps = [[], [("user", "")], [("assistant", "")], [("user", ""), ("assistant", "")], [("assistant", ""), ("user", "")]]
    for picked in itertools.product(*ways):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            turns, audit, cost = [], "", 0
            for k, new in enumerate(put):
                turns += new
                audit += "I" * len(new)
                cost += 3 * len(new)
                if k < len(picked):
                    cost += picked[k][0]
                    audit += picked[k][1]
                    turns += [picked[k][2]] if picked[k][2] else []
            initials = "".join(r[:1] or "?" for r, _ in turns)
            if RIGHT.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in turns))
    return best


def _want(rows):
    status = _status(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, text = _brute(rows, status) if rows else (0, "", "")
    return (gaps, *(status.count(s) for s in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def _run(spark, tmp, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{tmp}/conversations.parquet")
    out = repair.op11_repair(spark, str(tmp))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r[1:]) for r in out.collect()}


def test_repair_equals_enumeration(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher"]),
             rng.choice(["Yes.", "No", "Ünd so!", "", None, " \n\t", "Done?  \n", "what. next"]))
            for c in [*range(60), None] for t in rng.sample(range(6), rng.randint(1, 4))]
    rows += [(70, None, "user", "no turn."), (70, 1, "assistant", "ok."), (71, None, "user", "a.")]
    got = _run(spark, tmp_path, rows)
    want = {c: _want(r) for c, r in _rows_after_damage(rows).items()}
    assert got == want
    assert len({w[4] for w in want.values()}) > 2 and any(w[6] == "" for w in want.values())


def test_blocks_give_the_same_as_one_graph(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", "", f"t{t}.", "x" * 3000 + "."]))
            for c, n in [(1, 300), (2, 40), (3, 1)] for t in range(n)]
    whole = _run(spark, tmp_path, rows)
    monkeypatch.setattr(repair, "BLOCK", 7)
    monkeypatch.setattr(repair, "FAN", 3)
    assert _run(spark, tmp_path, rows) == whole
    for conv, after in _rows_after_damage(rows).items():
        gaps, blank, duplicate, truncated, illegal, cost, audit, _ = whole[conv]
        status = _status(after)
        assert [blank, duplicate, truncated] == [status.count(s) for s in ("blank", "duplicate", "truncated")]
        assert (cost, audit) == _shortest(after, status)


def _shortest(rows, status):
    """Least (cost, audit) by a dynamic program on tuples, for conversations too long to enumerate."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "")}

    def insert(now):
        for _ in range(2):
            for q, (c, a) in list(now.items()):
                for r in "ua":
                    if (to := step.get((q, r))) is not None:
                        now[to] = min(now.get(to, (9e9, "")), (c + 3, a + "I"))
        return now

    for (_, role, _), s in zip(rows, status):
        new = {}
        for q, (c, a) in insert(dict(best)).items():
            ways = [(q, 4, "D")]
            if s not in ("blank", "duplicate"):
                extra = 3 if s == "truncated" else 0
                ways += [(step.get((q, role[:1])), extra, "K")] + [(step.get((q, r)), 3 + extra, "R") for r in "ua"]
            for to, w, x in ways:
                if to is not None:
                    new[to] = min(new.get(to, (9e9, "")), (c + w, a + x))
        best = new
    return min(v for q, v in insert(best).items() if q in ("", "a"))


def test_odd_tables(spark, tmp_path):
    assert _run(spark, tmp_path, []) == {}
    dropped = next((c, t) for c in range(50) for t in range(50) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    extra = [(*dropped, "user", "Hi.", 1, 2, "x"), (None, None, None, None, 1, 2, "x")]
    got = _run(spark, tmp_path, extra, SCHEMA + ", rank int, `first` int, audit string")
    assert got[dropped[0]] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert got[None] == (0, 1, 0, 0, 0, 4, "D", EMPTY)
    same_row = [(1, 1, "user", "Same.")] * 500 + [(1, 2, "assistant", "Long " * 100_000 + ".")]
    got = _run(spark, tmp_path, same_row)[1]
    assert got == _run(spark, tmp_path, same_row[::-1])[1] and got[2] >= 499 and len(got[6]) >= 501


def test_repaired_rows(spark):
    df = spark.createDataFrame([(5, 0, "user", "A."), (5, 1, "user", "B."), (5, 2, "assistant", "C")], SCHEMA)
    rows = repair.sorted_rows(df)
    audit = repair.audits(repair.faults(rows))
    assert (audit.first().cost, audit.first().audit) == (6, "KIKK")
    got = [tuple(r) for r in repair.repaired(rows, audit).orderBy("place").collect()]
    assert got == [(5, 0, "K", 0, "user", "A."), (5, 1, "I", None, "assistant", ""), (5, 2, "K", 1, "user", "B."),
                   (5, 3, "K", 2, "assistant", "C")]
