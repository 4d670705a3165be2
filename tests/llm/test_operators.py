"""The operators against brute force, round trips and held-out accuracy, on small tables."""

import hashlib
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeshore.llm import (chat, fingerprints, html, jaccard, langid, mixing, packing, queries, topk, toxicity,
                           wordpiece)
from lakeshore.llm.components import connected_components
from tests.conftest import SF_ORACLE
from tests.oracle import compare, duck

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, part string"
ODD = [(0, "", "en", "a", 0, 1, "x"), (1, None, "en", None, 0, 1, "x"), (2, "one two", None, "a", 7, 1, "x"),
       (2, "one two", None, "a", 7, 1, "x"), (None, "solo words here", "fr", "b", 15, 1, None),
       (3, "w " * 30_000, "de", "b", 60_000, 2, None), (4, "a b c d e f g h", "en", "b", 15, 2, None),
       (5, "A  B c d\te f g h", "en", None, 16, 2, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    problems, rows = compare(queries.queries()[name](spark, SF_ORACLE), duck(SF_ORACLE), queries.oracle_sql()[name])
    assert not problems and rows


def test_mix(spark, odd, none):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, "w " * rng.randint(1, 300), f"s{i % 7}" if i % 50 else None)
                                  for i in range(1500)], "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs).toPandas()
    assert len(plan) == 1500 and (plan.copies <= 3).all()
    per = plan.assign(taken=plan.copies * plan["size"]).groupby("source", dropna=False).agg(
        size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert abs(per.target.sum() - per["size"].sum()) < 1e-6 * per["size"].sum()
    assert (per.target <= 3 * per["size"] + 1e-6).all() and (abs(per.taken - per.target) <= 20).all()
    again = mixing.mix_plan(docs.repartition(5)).toPandas()
    key = ["doc_id", "copies"]
    assert sorted(map(tuple, plan[key].values)) == sorted(map(tuple, again[key].values))
    assert mixing.mix(docs).count() == plan.copies.sum()
    assert mixing.mix_plan(odd).agg(F.sum("n_rows")).first()[0] == len(ODD)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix_plan(none).count() == 0 and mixing.mix(none).count() == 0


def _jaccard(a, b):
    import re
    a, b = (Counter(re.split("[ \t-\r]+", x)) for x in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def test_fingerprints(spark, odd, none):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.randint(1, 200)))
             for _ in range(120)]
    texts[7] = texts[3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = fingerprints.edited_fingerprints(docs).toPandas().set_index("doc_id")
    errors = []
    for i, text in enumerate(texts):
        other = texts[i - 1] if i else texts[-1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + other[:cut]
        assert got.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest() and got.n_chars[i] == len(text)
        errors += [got.near_edited[i] - _jaccard(text, edited), got.near_next[i] - _jaccard(text, other)]
    assert np.sqrt(np.mean(np.square(errors))) < 0.09 and abs(np.mean(errors)) < 0.03
    assert got.fingerprint[7] == got.fingerprint[3]
    out = fingerprints.edited_fingerprints(odd).toPandas()
    assert len(out) == len(ODD) and out.fingerprint.notna().all()
    assert fingerprints.fingerprints(odd).count() == len(ODD)
    assert fingerprints.edited_fingerprints(none).count() == 0


@pytest.mark.parametrize("terms,pairs", [(20_000, 30), (3000, 60)])
def test_fingerprints_of_many_terms_are_unbiased(spark, terms, pairs):
    rng = np.random.default_rng(terms)
    texts, true = [], []
    for p in range(pairs):
        a = rng.integers(1, 5, terms)
        b = np.where(rng.random(terms) < 0.5, a, np.where(rng.random(terms) < 0.4, 0, rng.integers(1, 5, terms)))
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        for part, weights in enumerate((a, b)):
            texts.append((p, part, " ".join(f"{p}.{k}" for k, n in enumerate(weights) for _ in range(n))))
    docs = spark.createDataFrame(texts, "k long, part int, text string").repartition(8, "k")
    signed = fingerprints.signatures(docs, ["k"]).groupBy("k").pivot("part", [0, 1]).agg(F.first("samples"))
    got = signed.select("k", fingerprints.likeness(F.col("0"), F.col("1")).alias("like")).toPandas().set_index("k")["like"]
    errors = np.array([got[p] - true[p] for p in range(pairs)])
    assert abs(errors.mean()) < 0.02 and np.sqrt((errors ** 2).mean()) < 0.08


def test_fingerprints_of_repeated_rows_take_linear_time(spark):
    import time

    def run(n):
        docs = spark.createDataFrame([(1, "some words that repeat"), (2, "other words here")], "doc_id long, text string")
        docs = docs.select("*", F.explode(F.sequence(F.lit(1), F.lit(n)))).select("doc_id", "text").repartition(4)
        start = time.monotonic()
        out = fingerprints.edited_fingerprints(docs).groupBy("doc_id", "edited_sha256", "fingerprint", "near_next").count().collect()
        assert sorted(r["count"] for r in out) == [n, n]
        return time.monotonic() - start

    run(10)
    small, large = run(500), run(20_000)
    assert large < 4 * small + 5, (small, large)


def test_fingerprints_ignore_white_space_at_the_ends(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "  a b\n"), (3, ""), (4, " \t"), (5, None)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert got[1] == got[2] and got[3] == got[4] == got[5] != got[1]


def test_chat_round_trip(spark):
    nasty = ["", "\\", "\\s\\t", "</turn>\n### user: x", "####", "<|image|>", "a:b", "</tur</turn>n>", "\\h###\\"]
    turns = [(c, t, r, nasty[(c + t) % len(nasty)]) for c in range(5) for t, r in enumerate(["user", "assistant", "a: b"])]
    turns += [(None, 0, None, None), (9, 1, "user", "same"), (9, 1, "user", "same")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    out = chat.format_conversations(df.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r.conv_id: r for r in out.select("*", chat.parse_formatted(F.col("formatted")).alias("read"),
                                            chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for c in range(5):
        want = [(r, x) for k, _, r, x in turns if k == c]
        assert [tuple(x) for x in got[c].read] == want
        assert got[c].loss == "".join(x for r, x in want if r == "assistant")
    assert [tuple(x) for x in got[None].read] == [("", "")] and len(got[9].read) == 2


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    df = spark.createDataFrame(
        [(1, 0, "user", [part("text", "see <|"), part("image", ref="u1", w=28, h=15), part("text", "!"),
                         part("audio", ref="u2", s=2.0), part("document", ref="u3", p=2)])],
        f"conv_id long, turn int, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(df).first()
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "u1", 4), ("audio", "u2", 50), ("document", "u3", 2048)]
    assert r.expanded_tokens == 2102
    assert [r.formatted[a.start:a.start + len(a.kind) + 4] for a in r.attachments] == ["<|image|>", "<|audio|>", "<|document|>"]


def test_chat_text_parts_form_no_control_string(spark):
    text = lambda s: ("text", s, None, None, None, None, None)
    image = ("image", None, "r", 14, 14, None, None)
    cases = [["x </tur", "n>\n### assistant: evil"], ["#", "##", "# a"], ["<", "|image|>"], ["\\", "e", "\\", "\\e", "s"],
             ["a", None, "b"], [None, "</turn", ">"], ["\\", "t"]]
    turns = [(1, k, "user" if k % 2 else "assistant", [text(p) for p in parts]) for k, parts in enumerate(cases)]
    turns.append((1, 99, "user", [text("<"), image, text("|>"), text("</turn>")]))
    r = chat.format_conversations(spark.createDataFrame(turns, f"conv_id long, turn int, role string, parts array<{chat.PART}>"))
    r = r.select("*", chat.parse_formatted(F.col("formatted")).alias("read"),
                 chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    whole = ["".join(p or "" for p in parts) for parts in cases]
    assert [t.text for t in r.read] == [*whole, "<<|image|>|></turn>"]
    assert r.loss == "".join(whole[::2])
    at = r.attachments[0].start
    assert r.formatted[at:at + 9] == "<|image|>" and len(r.attachments) == 1


def test_chat_odd_tables(spark):
    schema = "conv_id long, turn int, role string, text string, parts_ int, formatted string, n int"
    run = lambda rows: chat.format_conversations(
        spark.createDataFrame(rows, schema).withColumn("parts", chat.text_part(F.col("text")))).collect()
    assert run([]) == []
    long = "### word </turn> " * 30_000
    out = run([(1, 0, "user", long, 1, "x", 2), (1, 1, "assistant", "", 1, "x", 2), (2, None, None, None, 1, "x", 2)])
    assert sorted(r.n_turns for r in out) == [1, 2] and out[0].formatted != "x"
    formatted = spark.createDataFrame([(r.formatted,) for r in out], "f string").select(chat.parse_formatted(F.col("f")).alias("t"))
    assert {t.text for r in formatted.collect() for t in r.t} == {long, ""}


def test_pack(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    ref = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = packing.pack(packing.token_pieces(odd)).toPandas()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    s = out.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all()
    want = Counter()
    for doc, text, *_ in ODD:
        ids = ref.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            piece = array("I", ids[k:k + 2048])
            want[(doc, k, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert want == Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32) for r in out.itertuples())
    assert packing.pack(packing.token_pieces(none)).count() == 0


def test_pack_plan_places_every_piece_once():
    rng = random.Random(3)
    counts = Counter(rng.randint(1, 64) for _ in range(2000))
    used, seen = {}, Counter()
    for length, rank, ranks, first, each, offset in packing.plan_histogram(counts, 64):
        seen[length] += ranks
        for i in range(ranks):
            used.setdefault(first + i // each, []).append((offset + i % each * length, length))
    assert seen == counts
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(used) <= 1.02 * sum(k * v for k, v in counts.items()) / 64 + 1


def test_chunk_tokenizer_equals_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    file = public_tokenizers.path("word_bpe_49k.json")
    ref, mine, rng = Tokenizer.from_file(file), packing.WordBpe(file), random.Random(4)
    alphabet = list("abcABC 0129 '!?.<|>#$-_\t\n\x0b\x1c\x85\xa0éÉßÀ×µİΣσǾ̈ﬁ½²中🙂") + ["<|endoftext|>", "'s", "'ll", "0"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(10_000)]
    texts += ["".join(map(chr, rng.sample(range(256), 30))) for _ in range(3000)] + ["don't WON'T we'll", "Naïve Straße 12½ x²y"]
    for lo in range(0, len(texts), 2000):
        for t, got in zip(texts[lo:lo + 2000], mine.encode(texts[lo:lo + 2000])):
            assert ref.encode(t, add_special_tokens=False).ids == list(array("I", got)), repr(t)


def test_langid(spark, odd, none):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    held = langid.held_out_remainder()
    field = langid.fit(docs, ~held)
    got = langid.predict(docs, field).join(docs.select("doc_id", "lang"), "doc_id").filter(held).toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()
    out = langid.predict(odd, field).toPandas()
    assert len(out) == len(ODD) and set(out[out.n_words == 0].lang_pred) == {"und"}
    assert langid.predict(none, field).count() == 0 and langid.fit(none, F.lit(True)) is None
    assert langid.predict(odd, None).count() == len(ODD)


def test_langid_number_signs_are_no_letters():
    model = _two_languages()
    assert [langid.label(model, [t])[0][::2] for t in ("²  ½ ①", "Ⅷ ⅷ", "12 ٣", "")] == [("und", 0)] * 4
    assert langid.label(model, ["aa²bb ½aaa"])[0][2] == 3 and langid.words_of("aa²b ª1é") == ["aa", "b", "ª", "é"]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    field = langid.Field(["a", "b"], {}, np.zeros((1, 2)), rng.normal(size=(2, 2)), np.zeros(2))
    field.scores = rng.normal(size=(300, 2))
    for n in (1, 2, 7, 130, 300):
        rows = np.arange(n)
        post = field.marginals([rows, rows[:1]])[0]
        e, step = np.exp(field.scores[rows]), np.exp(field.trans)
        alpha, beta = np.zeros((n, 2)), np.ones((n, 2))
        alpha[0] = e[0] / e[0].sum()
        for t in range(1, n):
            alpha[t] = alpha[t - 1] @ step * e[t]
            alpha[t] /= alpha[t].sum()
        for t in range(n - 2, -1, -1):
            beta[t] = step @ (e[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        want = alpha * beta
        assert np.allclose(post, want / want.sum(1, keepdims=True))


def test_html(spark):
    page = """<html><head><title>T</title></head><body><nav><a href=1>Menu</a></nav><div class="cookie-notice">Cookies!</div>
    <article><h1>Head &amp; more</h1><p>A  first\nparagraph with <b>bold</b> words, long enough.<p>Short<div class="share">Share</div>
    </article><section id="comments"><p>Great post, I really liked reading it a lot. Thanks.</p></section>
    <form><p>Mail</p></form><script>var t="</p>";</script><footer>&copy; me</footer></body></html>"""
    df = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "y"), (None, "v", "", "z"),
                                (3, "w", "<p>" + "word " * 50_000, "l")], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert got[1] == "Head & more\nA first paragraph with bold words, long enough.\nShort"
    assert got[2] == "" and got[None] == "" and len(got[3]) == 249_999


LAYOUTS = [
    # a blog: unclosed paragraphs, comments, a related list
    ("""<body><div id=wrap><div class="topbar"><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div>
     <div class="post"><h2>A day &mdash; at sea</h2><p>We left the harbour early, before the wind was up.
     <p>By noon there was <i>nothing</i> but water around us, and nobody spoke.</div>
     <div class="related"><h3>More posts</h3><ul><li><a href=1>Another day</a><li><a href=2>The harbour</a></ul></div>
     <ol class="commentlist"><li><p>Lovely text, I was there too once upon a time.</li></ol>
     <div id="footer">&copy; 2020 The sailor</div></div>""",
     "A day \u2014 at sea\nWe left the harbour early, before the wind was up.\nBy noon there was nothing but water around us, and nobody spoke."),
    # a table layout: the menu in one cell, the text in another
    ("""<table><tr><td class=menu><a href=1>News</a><br><a href=2>Sport</a><td class=content>
     <h1>Council votes</h1><p>The council voted on Monday, after a long debate, to keep the old bridge.</p>
     <p>It will be repaired next year.</p></td></tr></table><form><p>Your e-mail</p><input></form>""",
     "Council votes\nThe council voted on Monday, after a long debate, to keep the old bridge.\nIt will be repaired next year."),
    # an article with its own header, a list, code and a cookie banner over it
    ("""<div role="dialog" class="cookie-consent"><p>We use cookies to improve this site, please accept them all.</p></div>
     <main><article><header><h1>Sorting lists</h1></header><p>A list is sorted in place, which needs no second list.</p>
     <ul><li>It is stable.</li><li>It is fast.</li></ul><pre>xs.sort()</pre><script>track()</script></article></main>
     <aside><p>Subscribe to our newsletter for more of this kind.</p></aside>""",
     "Sorting lists\nA list is sorted in place, which needs no second list.\nIt is stable.\nIt is fast.\nxs.sort()")]


@pytest.mark.parametrize("page,text", LAYOUTS)
def test_html_layouts(page, text):
    assert html.main_text(page) == text


def test_html_of_unclosed_markup_takes_linear_time():
    import time
    makes = [lambda n: "<div>x " * n, lambda n: "<b>x" * n + "</i>" * n, lambda n: "<div class=nav>x " * n,
             lambda n: "<b>" * n + "<p>t</p>" * n, lambda n: "<li>a<b>" * n, lambda n: "<article><header>x " * n]
    for make in makes:
        took = []
        for n in (3000, 24_000):
            start = time.process_time()
            html.main_text(make(n))
            took.append(time.process_time() - start)
        assert took[1] < 24 * took[0] + 0.5, took                             # eight times the page; its square would be 64


def test_html_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, block int"
    page = "<article><p>Some words of text, long enough to stay here.</p></article>"
    rows = [(1, "u", page, "x", "y", 1)] * 3 + [(None, None, None, None, None, None), (9007199254740993, "v", "</p></div>", "x", "y", 1)]
    got = html.extract(spark.createDataFrame(rows, schema).repartition(2))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = "Some words of text, long enough to stay here."
    assert Counter(map(tuple, got.collect())) == Counter({(1, "u", text, len(text)): 3, (None, None, "", 0): 1, (9007199254740993, "v", "", 0): 1})
    assert html.extract(spark.createDataFrame([], schema)).count() == 0


def test_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 1.5)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        cost = lambda side: (sum(-x if s else 0 for x, s in zip(odds, side) if x < 0) +  # noqa: E731
                             sum(x for x, s in zip(odds, side) if x > 0 and not s) +
                             sum(c for a, b, c in edges if side[a] != side[b]))
        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert abs(cost(html.minimum_cut(odds, edges)) - best) < 1e-6


def test_wordpiece_equals_greedy(spark, odd, none):
    rng = random.Random(7)
    make = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
    for _ in range(40):
        starts, inner = {make() for _ in range(6)}, {make() for _ in range(6)}
        m = wordpiece.LongestMatch(sorted(starts), sorted(inner))
        for _ in range(80):
            w = "".join(rng.choice("abc" if rng.random() < 0.05 else "ab") for _ in range(rng.randint(1, 12)))
            at = n = 0
            while at < len(w):
                end = next((e for e in range(len(w), at, -1) if w[at:e] in (starts if at == 0 else inner)), None)
                if end is None:
                    n = 0
                    break
                at, n = end, n + 1
            assert m.count(w) == n, (w, starts, inner)
    assert wordpiece.wordpiece_counts(odd).count() == len(ODD) and wordpiece.wordpiece_counts(none).count() == 0


def _links(texts):
    sets = {}
    for i, t in texts:
        w = tuple(jaccard.WORD.findall((t or "").translate(jaccard.LOWER)))
        sets[i] = {w[k:k + 5] for k in range(len(w) - 4)} if len(w) >= 5 else ({w} if w else set())
    comp = {i: i for i in sets}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in linked:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def test_ngram_join_equals_brute_force(spark, odd, none, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 4)  # several chunks and tiles
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefgh") + rng.choice("ijklmnop") + str(rng.randint(0, 60))
    passage = [word() for _ in range(25)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(rng.randint(6, 60))]
        for _ in range(9):
            t = [w if rng.random() > 0.015 else word() for w in base]
            texts.append(" ".join(t + (passage if rng.random() < 0.4 else [])))
    texts += ["", None, "x", "X", "x y", "a b c d e", "a b c d e", " ".join(passage)]
    rows = list(enumerate(texts))
    got = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _links(rows)
    out = jaccard.link_components(odd).toPandas()
    assert len(out) == len(ODD) and out[out.n_shingles == 4].component_id.eq(4).all()
    kept = jaccard.one_per_component(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 2
    assert jaccard.link_components(none).count() == 0 and jaccard.one_per_component(none).count() == 0


def test_ngram_join_with_one_large_family(spark, monkeypatch):
    """A third of all rows in one component, a passage that many others share, copies; chunks and tiles of a few sets."""
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    monkeypatch.setattr(jaccard, "VISITORS", 3)
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 400))
    base, passage, texts = [word() for _ in range(60)], [word() for _ in range(25)], []
    for k in range(70):
        t = list(base)
        for _ in range(k % 3):
            t[rng.randrange(60)] = word()
        texts.append(" ".join(t))
    for _ in range(60):
        t = [word() for _ in range(rng.randint(8, 40))]
        texts.append(" ".join(t + passage if rng.random() < 0.5 else passage + t))
    texts += [texts[50]] * 20 + [texts[0]] * 10
    rows = list(enumerate(texts))
    got = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = _links(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    sizes = Counter(c for _, c in want.values())
    assert sizes.most_common(1)[0][1] >= len(rows) / 3


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)]
    comp = {v: v for e in edges for v in e if e[0] != e[1]}
    for _ in range(300):
        for a, b in edges:
            if a != b:
                comp[a] = comp[b] = min(comp[a], comp[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert {r.id: r.component for r in got} == comp


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(10)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + 20 * (i % 9 == 0))]) for i in range(400)]
    rows += [(401, None), (402, [1.0, None]), (403, [float("nan")] * 6), (404, [1.0, 2.0]), (400, [0.0] * 6), (50, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = df.filter(topk.usable(F.col("embedding"))).select("vec_id", topk.scaled(F.col("embedding")).alias("v"))
    got = topk.top_k(v, F.pmod("vec_id", F.lit(50)) == 0, bucket_rows=37, tile_rows=4).toPandas()
    good = [(i, np.floor(256.0 * np.float32(e).astype(float))) for i, e in rows
            if e is not None and None not in e and np.isfinite(e).all()]
    want = Counter()
    for a, (i, q) in enumerate(good):
        if i % 50 == 0:
            s = sorted((-int(q @ c), j) for b, (j, c) in enumerate(good) if a != b and len(c) == len(q))[:5]
            want.update((i, r + 1, j, -x) for r, (x, j) in enumerate(s))
    assert want == Counter(map(tuple, got[["query_id", "rank", "vec_id", "score"]].astype(int).values.tolist()))


def test_topk_odd_tables(spark):
    big = 9007199254740993
    rows = [(big, [1.0, 0.0]), (None, [2.0, 0.0]), (None, [1.0, 0.0]), (100, [1.0, 1.0]), (big + 1, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, v array<double>, score double, `row` int")
    got = topk.top_k(df, F.col("vec_id").isNotNull(), k=4).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: (r.query_id, r["rank"])) if r.query_id == 100] == [
        (1, None, 2), (2, big, 1), (3, big + 1, 1), (4, None, 1)]
    assert {r.query_id for r in got} == {100, big, big + 1}
    asked = topk.top_k(df, F.lit(True), k=1).collect()
    assert Counter(r.query_id for r in asked) == Counter([None, None, 100, big, big + 1])
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(df.filter("vec_id = 100"), F.lit(True)).count() == 0  # nobody but the query


def test_toxicity_with_few_or_one_sided_labels(spark):
    docs = spark.createDataFrame([(i, f"harmless words number {i} of some text") for i in range(40)], "doc_id long, text string")
    for labels in ([(i, int(i < 3)) for i in range(6)], [(i, 1) for i in range(6)], [(i, 0) for i in range(6)], [(0, 1), (1, 0)], []):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert toxicity.keep_below(docs, model, 0.3).count() == 40, labels
        assert all(0 <= r.score < 0.3 for r in toxicity.score(docs, model).collect()), labels
    bad = docs.withColumn("text", F.when(F.col("doc_id") < 8, F.concat(F.lit("you zorgface moron "), "text")).otherwise(F.col("text")))
    model = toxicity.fit(bad, spark.createDataFrame([(i, int(i < 4)) for i in [0, 1, 2, 3, *range(20, 32)]], "doc_id long, toxic int"), F.lit(True))
    assert [r.doc_id for r in toxicity.keep_below(bad, model, 0.3).orderBy("doc_id").collect()] == list(range(8, 40))


def test_toxicity_sample_has_one_row_per_label(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    assert toxicity._labelled(docs, labels, 100, F.lit(True)).count() <= 4


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.held_out_remainder()
    model = toxicity.fit(docs, labels, ~held)
    got = toxicity.score(docs, model).join(labels, "doc_id").filter(held).toPandas()
    assert ((got.score >= 0.3) == (got.toxic == 1)).mean() > 0.93 and got.score.between(0, 1).all()
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(none, model).count() == 0
    empty = toxicity.fit(none, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}
    assert toxicity.keep_below(odd, model, 0.3).columns == odd.columns


def test_lexicon_matches_misspellings():
    lex = toxicity.Lexicon({"idiot": 2.0, "scum": 1.0}, {"bomente": 1.5})
    assert lex.match("idiot") == (2.0, 0) and lex.match("scum") == (1.0, 0) and lex.match("scumm") == (0.0, 0)
    for w in ("idoit",):  # two errors
        assert lex.match(w)[0] == 0
    for w in ("id1ot", "idiott", "idiiot", "diot", "idio"):
        assert lex.match(w) == (2.0, 1), w
    assert lex.match("bomenteco") == (1.5, 0) and lex.match("bomentx") == (0.0, 0)
    score = toxicity.Scorer(lex).features
    assert score('he said "idiot" to me')[2] > 0 and score("you idiot")[0] > 0 and score("") == [0.0] * 6


def test_scores_do_not_depend_on_the_cache(monkeypatch):
    lex = toxicity.Lexicon({"idiot": 2.0, "moron": 1.0, "scum": 1.0}, {"bomente": 1.5})
    texts = ["you idiot and moron", "an idiott, a moronn: bomenter!", "plain words", "scum \"idiots\" bomented",
             "you idiot and moron"]
    whole = [toxicity.Scorer(lex).features(t) for t in texts]
    monkeypatch.setattr(toxicity, "CACHED_CHUNKS", 1)
    scorer = toxicity.Scorer(lex)
    assert [scorer.features(t) for t in texts] == whole and len(scorer.hits) <= 1


def _two_languages():
    """A field that tells words of a from words of b by their letters."""
    index = {f: k for k, c in enumerate("ab") for f in (c * 2, c * 3)}
    index = {f: i for i, f in enumerate(index)}
    weights = np.array([[2.0, -2.0] if f[0] == "a" else [-2.0, 2.0] for f in index])
    return langid.Field(["a", "b"], index, weights, np.zeros((2, 2)), np.zeros(2))


def test_langid_long_runs_are_read_to_the_end():
    lang, share, n = langid.label(_two_languages(), ["a" * 40 + "b" * 120])[0][:3]
    assert (lang, n) == ("b", 1) and abs(share - 0.75) < 0.05
    assert langid.label(_two_languages(), ["a" * 40 + " " + "b" * 41 + " aa"])[0][2] == 3


def test_langid_trains_on_every_window_and_feature(monkeypatch):
    words = {"a": "kala", "b": "\u4e00\u4e8c"}
    segments = pd.DataFrame([(x, [w + f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for w in (word, word)])
                             for x, word in words.items() for i in range(60)], columns=["lang", "words"])
    field = langid.train(segments, ["a", "b"], sequences=1, rounds=2, min_count=1)
    vocabulary = {w for ws in segments["words"] for w in ws}
    assert all(np.abs(field.emit([w])).sum() > 0 and np.abs(field.weights[field.index[f"^{w}$"]]).sum() > 0
               for w in vocabulary)
    # past the rows of the frequent features the others share rows, in whatever script they are
    monkeypatch.setattr(langid, "DIMENSION", 8)
    small = langid.train(segments, ["a", "b"], sequences=1, rounds=2, min_count=1)
    assert small.weights.shape == (32, 2) and set(small.index) == set(field.index)
    blocks = langid.train(segments, ["a", "b"], sequences=300, rounds=3)
    monkeypatch.setattr(langid, "BLOCK", 7)
    again = langid.train(segments, ["a", "b"], sequences=300, rounds=3)
    assert np.allclose(blocks.weights, again.weights) and np.allclose(blocks.trans, again.trans)


def test_langid_knows_rare_languages(spark, monkeypatch):
    rows = [(i, "zu zu", f"l{i % 250:03}") for i in range(500)]
    monkeypatch.setattr(langid, "train", lambda windows, langs: (len(windows), langs))
    windows, langs = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert windows == 1500 and langs == [f"l{i:03}" for i in range(250)]


def test_language_stage_keeps_mixed_documents(spark):
    index = {c * 2: i for i, c in enumerate("abc")}
    field = langid.Field(["a", "b", "c"], index, 8 * np.eye(3) - 4, np.zeros((3, 3)), np.zeros(3))
    docs = spark.createDataFrame([(1, "aaaa bbbb cccc"), (2, "aaaa aaaa"), (3, "12 !"), (4, None), (5, "xyz zyx"), (6, "")],
                                 "doc_id long, text string")
    kept = langid.keep_identified(docs, field, 0.4)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == docs.columns
