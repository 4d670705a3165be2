"""corpus_pipeline: every stage and the whole run against versions in plain Python."""

import random
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeshore.llm import jaccard, langid, mixing, toxicity
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """The small documents with planted copies, near copies, abuse, mixed languages and odd rows."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rng = random.Random(1)
    add = lambda text, lang="en", source="planted": docs.append((10_000 + len(docs), text, lang, source, len(text or "")))
    long = [d for d in docs if len(d[1].split()) > 60][:6]
    for d in long:
        add(d[1], d[2])                                                       # an exact copy
        words = d[1].split(" ")
        words[rng.randrange(len(words) // 2)] = "changed"
        add(" ".join(words), d[2])                                            # one word differs
    first, second = (next(d[1] for d in docs if d[2] == x) for x in ("de", "fr"))
    add(f"{first} {second}", None, None)                                      # two languages
    for text in ("", None, "123 + 456 !!", "ok", "word " * 5000):
        add(text, None, None)
    docs.append((None, "a text without an id but with words of its own", "en", "src0", 10))
    docs.append(docs[3])                                                      # a repeated row
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    bad = labels.join(spark.createDataFrame(docs, SCHEMA), "doc_id").filter("toxic = 1").select("text").collect()
    for r in bad[:3]:
        add("Once more, " + r.text)                                           # abuse without a label
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def staged(spark, sf):
    """What every stage gets and gives: the rows as Counters, and the written frames."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = corpus_pipeline.materialize(stage(spark, given, sf), f"t_{name}")
        out.append((given, docs))
    return out


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _same(a, b):
    gone, new = list((a - b).items())[:2], list((b - a).items())[:2]
    assert not gone and not new, (str(gone)[:300], str(new)[:300])


def test_stages_keep_the_columns(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mix", "pack"]
    for given, got in staged[:-1]:
        assert got.columns == given.columns and [f.dataType for f in got.schema] == [f.dataType for f in given.schema]
    assert all(given.count() and got.count() for given, got in staged)


def test_toxic_documents_go(spark, sf, staged):
    given, got = staged[0]
    model = toxicity.fit(given, spark.read.parquet(f"{sf}/labels.parquet"), F.lit(True))
    scorer = toxicity.Scorer(toxicity.Lexicon(model["terms"], model["stems"]))

    def score(text):
        x = scorer.features(text or "")
        p = 1 / (1 + np.exp(-(np.dot(x, model["weights"][:-1]) + model["weights"][-1])))
        return p if x[-1] else min(p, toxicity.NO_EVIDENCE)

    _same(_rows(got), Counter({r: n for r, n in _rows(given).items() if score(r[1]) < corpus_pipeline.TOXIC_FROM}))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r[0] for r in _rows(got)}
    clean = [r[0] for r in _rows(given) if labels.get(r[0]) == 0]
    assert len(clean) > 50 and sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert len(kept) < len({r[0] for r in _rows(given)})                      # eleven labels are few, yet some abuse is found


def test_documents_without_a_language_go(staged):
    given, got = staged[1]
    field = langid.fit(given, F.lit(True))
    keep = lambda text: (lambda x: x[2] > 0 and x[3] >= corpus_pipeline.LANGUAGE_LEAST)(langid.label(field, [text or ""])[0])
    _same(_rows(got), Counter({r: n for r, n in _rows(given).items() if keep(r[1])}))
    texts = {r[1] for r in _rows(got)}
    assert not texts & {"", None, "123 + 456 !!"}
    assert sum(_rows(got).values()) >= sum(_rows(given).values()) - 10        # clean ones stay, in one language or two


def _shingles(text):
    words = tuple(jaccard.WORD.findall((text or "").translate(jaccard.LOWER)))
    return {words[k:k + 5] for k in range(len(words) - 4)} if len(words) >= 5 else {words} if words else set()


def test_one_document_of_each_group_stays(staged):
    given, got = staged[2]
    rows = sorted(_rows(given).elements(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sets = [_shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    want = Counter(rows[i] for i in range(len(rows)) if not sets[i] or root(i) == i)
    kept = _rows(got)
    assert sum(kept.values()) == sum(want.values()) and {r[0] for r in kept} == {r[0] for r in want}
    _same(kept, want)


def test_the_mix_takes_every_row_as_often_as_its_plan_says(staged):
    given, got = staged[3]
    sizes = {}
    for r, n in _rows(given).items():
        sizes[r[3]] = sizes.get(r[3], 0) + n * len(jaccard.WORD.findall(r[1] or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, free = {}, set(sizes)
    while free:                                                               # share, cut at three times the size, share the rest
        left, weight = sum(sizes.values()) - sum(target.values()), sum(weights[s] for s in free)
        capped = {s for s in free if left * weights[s] / weight > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] if s in capped else left * weights[s] / weight for s in (capped or free)}
        free -= capped or free
    plan = mixing.mix_plan(given).collect()
    for r in plan:
        assert r.target == pytest.approx(target[r.source], rel=1e-9) and 0 <= r.copies <= 3 * r.n_rows
        share = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert not r.size or share - 1 - 1e-6 < r.copies < share + 1 + 1e-6   # rounded down or up
    taken, kept = Counter(), _rows(got)
    for r, n in kept.items():
        taken[r[3]] += n * len(jaccard.WORD.findall(r[1] or ""))
    had = _rows(given)
    assert set(kept) <= set(had) and all(n <= 3 * had[r] for r, n in kept.items())
    assert sum(kept.values()) == sum(r.copies for r in plan)
    for s, want in target.items():
        longest = max(len(jaccard.WORD.findall(r[1] or "")) for r in had if r[3] == s)
        assert abs(taken[s] - want) <= max(longest, 0.05 * want)


def test_pieces_are_the_tokenizers_and_fill_sequences(staged):
    import public_tokenizers
    from tokenizers import Tokenizer
    given, got = staged[4]
    ref = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r, n in _rows(given).items():
        ids = ref.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            piece = array("I", ids[k:k + 2048])
            want[(r[0], k // 2048, k, len(piece), zlib.crc32(piece.tobytes()))] += n
    out = got.collect()
    _same(Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), want)
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= 2048
    assert len(used) <= _best_fit([r.length for r in out])


def _best_fit(lengths, capacity=2048):
    """Sequences that best fit decreasing needs, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_run_applies_the_stages_in_order(spark, sf, staged):
    got = corpus_pipeline.run(spark, sf)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    _same(_rows(got.select(*columns)), _rows(staged[-1][1].select(*columns)))


def test_an_empty_table_and_odd_columns(spark, sf, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, sf)
        assert none.count() == 0, name
    more = spark.read.parquet(f"{sf}/documents.parquet").limit(40).withColumns(
        {"score": F.lit("x"), "rank": F.lit(1), "size": F.lit("y"), "id": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert set(stage(spark, more, sf).columns) == set(more.columns), name


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_every_stage_keeps_batches_small(spark, tmp_path, stage):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    none = spark.createDataFrame([], SCHEMA)
    lengths = spark.range(2000).coalesce(1).mapInPandas(_lengths, "n long")
    try:
        for given, most in ((None, 512), ("100", 100), ("0", 512)):  # Spark's own, smaller and unlimited
            for key in keys:
                spark.conf.unset(key)
            if given:
                spark.conf.set(keys[0], given)
            corpus_pipeline.STAGES[stage][1](spark, none, str(tmp_path))
            got = [r.n for r in lengths.select("n").collect()]
            assert sum(got) == 2000 and max(got) == most
            assert int(spark.conf.get(keys[1])) == 512
    finally:
        for key in keys:
            spark.conf.unset(key)


def _lengths(batches):
    for batch in batches:
        yield batch.head(1).assign(n=len(batch))[["n"]]
