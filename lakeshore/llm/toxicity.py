"""Toxicity by a learned lexicon, matched with spelling errors, scored in context.

The lexicon is learned from labelled rows: whole words, and stems that start many words, that
occur far more often in toxic texts. Its terms form a trie; a Levenshtein automaton runs on it,
so a word is matched if it is a term up to one error (terms of five characters or more) or
begins with a stem. The intersection is made deterministic as words are read: a state is a set
of (trie node, errors), every state and step is remembered, and most words leave it within a
few characters. Each hit is weighed in a window of words around it: other hits and words of
address raise it, quotation marks around it lower it. A logistic model over a text's weighted
hits gives the score.

Learning uses a bounded sample of labelled rows (``sample_rows``, by a hash of the id); word
counts are pre-aggregated in the tasks. Scoring covers every whole text.

Defined results: a null or empty text has no hits and gets the score of such texts; a null id
counts as training row 0 but has no label; documents with several labels count once per label, and
documents that share an id are one labelled row; repeated rows are scored each. A text without a
hit has nothing against it: its score is what the model gives such texts, ``NO_EVIDENCE`` at
most. So is every score (the share of toxic labels, likewise bounded) where labels are missing or
all alike and nothing can be learned, and no document is rejected then. If a part of the
sample lacks a class, both parts are the whole sample. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import crc32_mod, table
from .packing import _spans

STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”«»„’‘…—–¡¿"
QUOTES = '"“”«»„'
ADDRESS = frozenset("you your you're u tu te vous du dich ihr tú usted vosotros".split())
WINDOW = 5
FEATURES = 6
#: Highest score of a text without a hit.
NO_EVIDENCE = 0.25
CACHED_CHUNKS = 200_000
#: Determinised states that are kept before the automaton starts afresh.
KEPT_STATES = 30_000
DEAD = 0


class Lexicon:
    """Terms with weights; ``stems`` match any word that begins with them."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.edges: list[dict[str, int]] = [{}]
        self.term: list[float] = [0.0]
        self.stem: list[float] = [0.0]
        self.most: list[int] = [0]  # errors that a term below the node may have
        for words, values in ((terms, self.term), (stems, self.stem)):
            for w, weight in words.items():
                node, allowed = 0, int(words is terms and len(w) >= 5)
                self.most[0] = max(self.most[0], allowed)
                for c in w:
                    nxt = self.edges[node].get(c)
                    if nxt is None:
                        nxt = self.edges[node][c] = len(self.edges)
                        self.edges.append({})
                        self.term.append(0.0)
                        self.stem.append(0.0)
                        self.most.append(0)
                    node = nxt
                    self.most[node] = max(self.most[node], allowed)
                values[node] = weight
        self.allowed = {}  # terminal nodes that may be reached with an error
        for w in terms:
            if len(w) >= 5:
                node = 0
                for c in w:
                    node = self.edges[node][c]
                self.allowed[node] = True
        self._restart()

    def _restart(self) -> None:
        """No determinised states but the dead one and the start."""
        self.ids: dict[frozenset, int] = {frozenset(): DEAD}
        self.steps: list[dict[str, int]] = [{}]
        self.sets: list[frozenset] = [frozenset()]
        self.results: list[tuple[float, int]] = [(0.0, 0)]
        self.stems_hit: list[float] = [0.0]
        self.first = self._state({(0, 0)})

    def _state(self, pairs: set) -> int:
        todo = list(pairs)
        while todo:  # a term's character that the word left out
            node, errors = todo.pop()
            if errors < self.most[node]:
                for nxt in self.edges[node].values():
                    if (nxt, errors + 1) not in pairs and self.most[nxt] > errors:
                        pairs.add((nxt, errors + 1))
                        todo.append((nxt, errors + 1))
        key = frozenset(p for p in pairs if not (p[1] and (p[0], 0) in pairs))
        if key in self.ids:
            return self.ids[key]
        self.ids[key] = at = len(self.sets)
        self.sets.append(key)
        self.steps.append({})
        ends = [(self.term[n], e) for n, e in key if self.term[n] and (not e or n in self.allowed)]
        self.results.append(min(ends, key=lambda x: (x[1], -x[0]), default=(0.0, 0)))
        self.stems_hit.append(max((self.stem[n] for n, e in key if not e), default=0.0))
        return at

    def _step(self, state: int, c: str) -> int:
        pairs = set()
        for node, errors in self.sets[state]:
            nxt = self.edges[node].get(c)
            if nxt is not None and (not errors or self.most[nxt] >= errors):
                pairs.add((nxt, errors))
            if errors < self.most[node]:
                pairs.add((node, errors + 1))  # a character too many
                for other in self.edges[node].values():
                    if self.most[other] > errors:
                        pairs.add((other, errors + 1))  # a character for another
        self.steps[state][c] = to = self._state(pairs)
        return to

    def match(self, word: str) -> tuple[float, int]:
        """(weight, errors) of the best term or stem; weight 0 if none."""
        if len(self.sets) > KEPT_STATES:
            self._restart()
        state, best = self.first, 0.0
        for c in word:
            nxt = self.steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state == DEAD:
                return (best, 0)
            if self.stems_hit[state] > best:
                best = self.stems_hit[state]
        weight, errors = self.results[state]
        if weight and (not errors or not best):
            return (max(weight, best), errors)
        return (best, 0)


class Scorer:
    """Features of texts under a lexicon.

    Remembered chunks only save matching again: a text is scored by its own hits, and either
    memory is cleared when it is full.
    """

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.hits: dict[str, tuple[float, int]] = {}
        self.misses: set[str] = set()

    def features(self, text: str) -> list[float]:
        """Weights of exact, misspelled and quoted hits, best window, hits per word, hits."""
        chunks = text.lower().split()
        found = set(chunks)
        new = found - self.misses
        hits = {}
        if new:
            if len(self.misses) > CACHED_CHUNKS:
                self.misses.clear()
            for c in new:
                hit = self.hits.get(c)
                if hit is None:
                    hit = self.lexicon.match(c.strip(STRIP))
                    if not hit[0]:
                        self.misses.add(c)
                        continue
                    if len(self.hits) >= CACHED_CHUNKS:
                        self.hits.clear()
                    self.hits[c] = hit
                hits[c] = hit
        if not hits:
            return [0.0] * FEATURES
        places = [i for i, c in enumerate(chunks) if c in hits]
        exact = near = quoted = best = 0.0
        quoted_at = _quoted(chunks, places)
        for k, i in enumerate(places):
            weight, errors = hits[chunks[i]]
            around = sum(1 for j in (places[k - 1] if k else -99, places[k + 1] if k + 1 < len(places) else -99)
                         if abs(j - i) <= WINDOW)
            you = any(c.strip(STRIP) in ADDRESS for c in chunks[max(0, i - WINDOW):i + WINDOW + 1])
            score = weight * (1 + 0.5 * around + 0.5 * you)
            if quoted_at[k]:
                quoted += weight
                score *= 0.25
            elif errors:
                near += weight
                score *= 0.6
            else:
                exact += weight
            best = max(best, score)
        return [math.log1p(exact), math.log1p(near), math.log1p(quoted), math.log1p(best),
                math.log1p(100 * len(places) / len(chunks)), math.log1p(len(places))]


def _quoted(chunks: list[str], places: list[int]) -> list[bool]:
    """Whether each place lies between an opening and a closing quotation mark nearby."""
    out = []
    for i in places:
        before = chunks[max(0, i - WINDOW):i]
        after = chunks[i + 1:i + WINDOW + 1]
        opens = chunks[i][0] in QUOTES or any(c[0] in QUOTES and c[-1] not in QUOTES for c in before)
        closes = (any(q in chunks[i][1:] for q in QUOTES)
                  or any(c.rstrip(".,;:!?")[-1:] in QUOTES and c[0] not in QUOTES for c in after))
        out.append(bool(opens and closes))
    return out


def learn_counts(labelled: DataFrame) -> DataFrame:
    """term, stem flag, toxic and clean documents that hold it, from (text, toxic) rows."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()

        def flush():
            for is_stem in (False, True):
                keys = [k for k in toxic.keys() | clean.keys() if k.endswith("*") == is_stem]
                for lo in range(0, len(keys), 50_000):
                    some = keys[lo:lo + 50_000]
                    yield pd.DataFrame({"term": [k.rstrip("*") for k in some], "stem": is_stem,
                                        "toxic": [toxic[k] for k in some], "clean": [clean[k] for k in some]})
            toxic.clear()
            clean.clear()

        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                words = {c.strip(STRIP) for c in set(text.lower().split())}
                seen = set(w for w in words if len(w) >= 3 and "*" not in w)
                seen |= {w[:k] + "*" for w in seen for k in range(3, min(len(w), 9))}
                (toxic if label == 1 else clean).update(seen)
                if len(toxic) + len(clean) > 400_000:
                    yield from flush()
        yield from flush()

    return (labelled.mapInPandas(count, "term string, stem boolean, toxic long, clean long")
            .groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def choose_terms(counts: list, n_toxic: int, n_clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Weights (log odds) of words and of stems; a stem replaces the words it explains."""
    def odds(t: int, c: int) -> float:
        return math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))

    terms = {r.term: odds(r.toxic, r.clean) for r in counts if not r.stem}
    stems = {r.term: odds(r.toxic, r.clean) for r in counts if r.stem}
    # a stem that says no more than a longer stem or a single word is left out
    words = sorted(terms)
    import bisect
    for s in sorted(stems, key=len):
        lo, hi = bisect.bisect_left(words, s), bisect.bisect_left(words, s + "\U0010ffff")
        if hi - lo < 3:
            del stems[s]
    return terms, stems


def _labelled(docs: DataFrame, labels: DataFrame, sample_rows: int, keep) -> DataFrame:
    some = (labels.filter(keep & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("doc_id", F.lit(5)), "toxic").limit(sample_rows))
    # the sample is bounded by its parameter, so it may be broadcast
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialize(docs.select("doc_id", text.alias("text")).join(F.broadcast(some), "doc_id"), "tox_sample")
    once = rows.groupBy("doc_id", "toxic")
    if once.count().filter("count > 1").isEmpty():
        return rows
    # an id that many rows share is one row
    return materialize(once.agg(F.min_by("text", F.xxhash64("text")).alias("text")), "tox_sample_once")


def fit(docs: DataFrame, labels: DataFrame, keep, sample_rows: int = 20_000,
        max_terms: int = 4000, min_docs: int = 3, min_odds: float = 2.0) -> dict:
    """Lexicon and logistic weights from at most ``sample_rows`` labelled documents.

    Two thirds of the sample give the lexicon, the rest the logistic weights, so that rare
    words which only look toxic in the counted texts are weighed by texts they were not
    counted in. The driver gets at most ``max_terms`` terms and a few numbers per row.
    """
    rows = _labelled(docs, labels, sample_rows, keep)
    part = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(3)) < 2
    sizes = {(r.lexicon, r.toxic): r.n for r in rows.groupBy(part.alias("lexicon"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_class = [sum(n for (_, toxic), n in sizes.items() if (toxic == 1) == kind) for kind in (False, True)]
    model = {"terms": {}, "stems": {}, "weights": None, "prior": per_class[1] / max(1, sum(per_class))}
    if not all(per_class):
        return model
    counted = weighed = rows
    if all(any((toxic == 1) == kind and lexicon == side for lexicon, toxic in sizes) for kind in (False, True) for side in (False, True)):
        counted, weighed = rows.filter(part), rows.filter(~part)
        per_class = [sum(n for (lexicon, toxic), n in sizes.items() if lexicon and (toxic == 1) == kind) for kind in (False, True)]
    n_clean, n_toxic = per_class
    ratio = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    counts = (learn_counts(counted).filter((F.col("toxic") >= min_docs) & (ratio >= min_odds))
              .orderBy((ratio * F.log1p("toxic")).desc(), "term", "stem").limit(max_terms).collect())
    model["terms"], model["stems"] = choose_terms(counts, n_toxic, n_clean)
    found = _features(weighed, model, ["toxic"]).toPandas()  # a few numbers a row
    x = np.stack(found["features"].to_numpy())
    model["weights"] = _logistic(x, found["toxic"].to_numpy() == 1)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Newton steps; the last weight is the intercept. Quoted hits may not raise the score."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = l2 * np.r_[np.ones(len(w) - 1), 0]
        grad = x.T @ (p - y) + penalty * len(y) * w / 100
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty * len(y) / 100 + 1e-6)
        w -= np.linalg.solve(hess, grad)
    return w


def _features(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns and the features of every whole text (columns doc_id, text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model["terms"], model["stems"]))  # at most max_terms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(Lexicon(*shared.value))
        for batch in batches:
            for lo, hi in _spans(batch["text"], 4_000_000):
                part = batch.iloc[lo:hi]
                yield part[keep].assign(features=[scorer.features(t) for t in part["text"]])

    types = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInPandas(
        run, ", ".join(f"{c} {types[c]}" for c in keep) + ", features array<double>")


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    id_type = dict(docs.dtypes)["doc_id"]
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = _features(texts, model, ["doc_id"]).withColumn("doc_id", F.col("doc_id").cast(id_type))
    if model["weights"] is None:
        return out.select("doc_id", F.lit(min(float(model["prior"]), NO_EVIDENCE)).alias("score"))
    w = [float(x) for x in model["weights"]]
    z = F.lit(w[-1])
    for i in range(FEATURES):
        z = z + F.col("features")[i] * F.lit(w[i])
    p = 1 / (1 + F.exp(-z))
    return out.select("doc_id", F.when(F.col("features")[FEATURES - 1] == 0, F.least(p, F.lit(NO_EVIDENCE)))
                      .otherwise(p).alias("score"))


def keep_below(docs: DataFrame, model: dict, limit: float) -> DataFrame:
    """Rows of ``docs`` whose text scores below ``limit``, with all columns.

    Texts are judged where they are read: the rows stay in the JVM and only the text column goes
    to the scorer, so no join is needed to bring rows and scores together.
    """
    if model["weights"] is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model["terms"], model["stems"], model["weights"]))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms, stems, weights = shared.value
        scorer = Scorer(Lexicon(terms, stems))
        for texts in batches:
            x = np.array([scorer.features(t) for t in texts]).reshape(len(texts), FEATURES)
            p = 1 / (1 + np.exp(-(x @ weights[:-1] + weights[-1])))
            yield pd.Series(np.where(x[:, -1] == 0, np.minimum(p, NO_EVIDENCE), p))

    return docs.filter(scores(F.coalesce(F.col("text").cast("string"), F.lit(""))) < limit)


def held_out_remainder():
    return crc32_mod(F.col("doc_id"), 4) == 2


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels, ~held_out_remainder())
    return (score(docs, model)
            .select("doc_id", held_out_remainder().alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


QUERIES = {"op10_toxicity": op10_toxicity}
