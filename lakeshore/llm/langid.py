"""Language identification by a linear-chain conditional random field over words.

Words are labelled with languages; affixes, character n-grams and a lexicon of frequent words
give each word its scores, learned transitions tie neighbours together, and forward-backward
gives every word's marginals, so a text that switches its language is labelled part by part. A
document's language is the one with the greatest expected share of its words' letters.

The field is trained by the gradient of its conditional likelihood on sequences spliced from
segments of texts of different languages, taken from a bounded, hashed sample of the labelled
documents (``sample_docs`` per language, ``segments`` windows from anywhere in each); every
labelled language and every sampled window is used. Past ``4 * DIMENSION`` features the rarer
ones share weights by hash. Prediction
reads whole texts: words are cut into stretches of ``STRETCH``, a product of transfer matrices
per stretch links them exactly, so texts of any length take a bounded number of vector steps.
Runs of more than 40 letters (scripts without spaces, joined text) are cut into successive
pieces that are labelled each; ``n_words`` counts the runs.

Defined results: a null text or one without a letter is ``und`` with score 0; repeated rows
are labelled each; without any labelled row everything is ``und``; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import crc32_mod, table, uniform
from .packing import _spans

RUN = re.compile(r"[^\W\d_]+")
LONGEST = 40
#: Runs of letters; longer ones in successive pieces.
WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")
STRETCH = 128
BATCH_WORDS = 120_000
CACHED_WORDS = 150_000
SEGMENT = 32
DIMENSION = 1 << 16
#: Training sequences, times languages, whose marginals are held at a time.
BLOCK = 1 << 14


def words_of(text: str, pattern: re.Pattern = WORD) -> list[str]:
    """Runs of letters. The patterns also take number signs that are no letters (² ½ ①); they part words."""
    found = pattern.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in pattern.findall("".join(c if c.isalpha() else " " for c in run))]


def word_features(word: str) -> list[str]:
    """Affixes, inner n-grams and the word itself (the lexicon feature)."""
    w = f"^{word}$"
    grams = {w[i:i + 2] for i in range(len(w) - 1)}
    grams.update(w[i:i + 3] for i in range(len(w) - 2))
    grams.update((w[:4], w[-4:], w[:5], w[-5:], w))
    return list(grams)


class Field:
    """Languages, feature weights (feature -> row) and log transitions."""

    def __init__(self, langs: list[str], index: dict[str, int], weights: np.ndarray, trans: np.ndarray,
                 start: np.ndarray):
        self.langs, self.index, self.weights, self.trans, self.start = langs, index, weights, trans, start
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(langs)))

    def rows(self, words: list[list[str]]) -> list[np.ndarray]:
        """For each text its words' rows in ``scores``."""
        known = self.known
        new = [w for w in set().union(*words) if w not in known] if words else []
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = list(set().union(*words))
            self.scores = self.scores[:0]
        if new:
            parts = [self.emit(new[i:i + 20_000]) for i in range(0, len(new), 20_000)]
            self.scores = np.vstack([self.scores, *parts])
            known.update(zip(new, range(len(known), len(known) + len(new))))
        return [np.fromiter(map(known.__getitem__, ws), np.int64, len(ws)) for ws in words]

    def emit(self, words: list[str]) -> np.ndarray:
        get = self.index.get
        ids, ends = [], []
        for w in words:
            ids.extend([i for i in map(get, word_features(w)) if i is not None])
            ends.append(len(ids))
        total = np.vstack([np.zeros(len(self.langs)), np.cumsum(self.weights[ids], axis=0)]) if ids \
            else np.zeros((1, len(self.langs)))
        ends = np.array([0, *ends])
        return total[ends[1:]] - total[ends[:-1]]

    def marginals(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Posterior label probabilities of every word of every (non-empty) sequence."""
        k = len(self.langs)
        step = np.exp(self.trans - self.trans.max())
        lengths = np.array([len(r) for r in rows])
        per = -(-lengths // STRETCH)
        first = np.r_[0, np.cumsum(per)[:-1]]
        n = int(per.sum())
        # stretches are right-padded; a padded step is the identity
        e = self.scores[np.concatenate(rows)]
        e = np.exp(e - e.max(1, keepdims=True))
        place = np.concatenate([f * STRETCH + np.arange(m) for f, m in zip(first, lengths)])
        pot = np.ones((n * STRETCH, k))
        pot[place] = e
        pot = pot.reshape(n, STRETCH, k).transpose(1, 0, 2).copy()
        real = np.zeros(n * STRETCH, bool)
        real[place] = True
        real = real.reshape(n, STRETCH).T.copy()
        opening = np.zeros(n, bool)
        opening[first] = True
        # transfer matrix of each stretch: labels before it -> labels at its end
        linked = int(per.max()) > 1
        whole = np.broadcast_to(np.eye(k), (n, k, k)).copy() if linked else None
        for t in range(STRETCH if linked else 0):  # single stretches need none
            on = np.nonzero(real[t])[0]
            if not len(on):
                break
            m = (whole[on].reshape(-1, k) @ step).reshape(-1, k, k)
            if t == 0:  # a text's first word has no word before it
                m[opening[on]] = np.eye(k)
            m *= pot[t][on][:, None, :]
            whole[on] = m / m.max((1, 2), keepdims=True)
        # messages at the stretches' borders, stretch by stretch of all texts at once
        into = np.empty((n, k))
        out = np.ones((n, k))
        into[first] = np.exp(self.start - self.start.max())
        for s in range(1, int(per.max())):
            at = first[per > s] + s
            v = np.einsum("ni,nij->nj", into[at - 1], whole[at - 1])
            into[at] = v / v.sum(1, keepdims=True)
        for s in range(int(per.max()) - 1, 0, -1):
            at = first[per > s] + s
            v = np.einsum("nij,nj->ni", whole[at], out[at])
            out[at - 1] = v / v.sum(1, keepdims=True)
        # inside the stretches
        alpha = np.empty((STRETCH, n, k))
        last = into
        for t in range(STRETCH):
            move = last @ step if t else np.where(opening[:, None], last, last @ step)
            now = move * pot[t]
            now /= now.sum(1, keepdims=True)
            last = np.where(real[t][:, None], now, last)
            alpha[t] = last
        beta = out
        for t in range(STRETCH - 1, -1, -1):
            alpha[t] *= beta
            back = (beta * pot[t]) @ step.T
            back /= back.sum(1, keepdims=True)
            beta = np.where(real[t][:, None], back, beta)
        post = alpha.transpose(1, 0, 2).reshape(-1, k)[place]
        post /= post.sum(1, keepdims=True)
        return np.split(post, np.cumsum(lengths)[:-1])


def train(segments: pd.DataFrame, langs: list[str], sequences: int = 3000, parts: int = 4, rounds: int = 60,
          min_count: int = 2, seed: int = 7) -> Field:
    """Fit the field by Adam on spliced sequences; ``segments`` has lang and words.

    There are at least ``sequences``, and as many more as it takes to use every segment.
    """
    rng = np.random.default_rng(seed)
    k, code = len(langs), {lang: i for i, lang in enumerate(langs)}
    seen: dict[str, int] = {}
    for words in segments["words"]:
        for w in set(words):
            for f in word_features(w):
                seen[f] = seen.get(f, 0) + 1
    # the most frequent features have rows of their own, the others share them by hash
    often = sorted((f for f, n in seen.items() if n >= min_count), key=lambda f: (-seen[f], f))
    index = {f: i if i < 4 * DIMENSION else zlib.crc32(f.encode("utf-8", "surrogatepass")) % (4 * DIMENSION)
             for i, f in enumerate(often)}
    by = [[] for _ in langs]
    for ws, lang in zip(segments["words"], segments["lang"]):
        if len(ws):
            by[code[lang]].append(ws)
    present = [i for i in range(k) if by[i]]
    order, used = {y: rng.permutation(len(by[y])) for y in present}, dict.fromkeys(present, 0)
    words, gold = [], []
    while len(words) < sequences or any(used[y] < len(by[y]) for y in present):
        ws, ys = [], []
        y = int(rng.choice(present))
        for _ in range(parts):
            seg = by[y][order[y][used[y] % len(by[y])]]
            used[y] += 1
            cut = int(rng.integers(4, SEGMENT + 1))
            ws.extend(seg[:cut])
            ys.extend([y] * len(seg[:cut]))
            if rng.random() < 0.3:
                y = int(rng.choice(present))
        words.append(ws)
        gold.append(np.array(ys))
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))}
    ids, owner = [], []
    for w, i in vocabulary.items():
        fs = [index[f] for f in word_features(w) if f in index]
        ids.extend(fs)
        owner.extend([i] * len(fs))
    ids, owner = np.array(ids, np.int64), np.array(owner, np.int64)
    rows = [np.array([vocabulary[w] for w in ws]) for ws in words]
    flat, ys = np.concatenate(rows), np.concatenate(gold)
    first = np.r_[0, np.cumsum([len(r) for r in rows])]
    inner = np.ones(len(flat), bool)
    inner[first[:-1]] = False
    height = max(1, min(len(index), 4 * DIMENSION))
    field = Field(langs, index, np.zeros((height, k)), np.zeros((k, k)), np.zeros(k))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (field.weights, field.trans)]
    true_pairs = np.zeros((k, k))
    np.add.at(true_pairs, (ys[:-1][inner[1:]], ys[1:][inner[1:]]), 1)
    n, block = len(flat), max(1, BLOCK // k)
    for r in range(1, rounds + 1):
        field.scores = np.zeros((len(vocabulary), k))
        for j in range(k):
            field.scores[:, j] = np.bincount(owner, field.weights[ids, j], len(vocabulary))
        off, pairs = np.zeros((len(vocabulary), k)), np.zeros((k, k))
        for lo in range(0, len(rows), block):
            a, b = first[lo], first[min(lo + block, len(rows))]
            post = np.concatenate(field.marginals(rows[lo:lo + block]))
            # expected neighbours, from the marginals of adjacent words under the current step
            pairs += _expected_pairs(field, post, inner[a:b])
            post[np.arange(b - a), ys[a:b]] -= 1
            for j in range(k):
                off[:, j] += np.bincount(flat[a:b], post[:, j], len(vocabulary))
        g_weights = np.zeros_like(field.weights)
        for j in range(k):
            g_weights[:, j] = np.bincount(ids, off[owner, j], len(g_weights))
        for p, g, (m, v) in zip((field.weights, field.trans), (g_weights / n + 1e-6 * field.weights,
                                                                (pairs - true_pairs) / n), state):
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            p -= 0.15 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.98 ** r)) + 1e-8)
    field.known, field.scores = {}, np.zeros((0, k))
    return field


def _expected_pairs(field: Field, post: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected label pairs of neighbouring words.

    p(y, y') is proportional to post(y) step(y, y') / sum over y'' of step(y, y'') r(y'') * r(y'),
    with r(y') = post(y') over the forward message into it; fitted by scaling to both marginals.
    """
    step = np.exp(field.trans - field.trans.max())
    a, b = post[:-1][inner[1:]], post[1:][inner[1:]]
    u, v = np.ones_like(a), np.ones_like(b)
    for _ in range(8):  # a chain's pair marginal has this form, so scaling finds it
        u = a / np.maximum(v @ step.T, 1e-300)
        v = b / np.maximum(u @ step, 1e-300)
    return step * (u.T @ v)


def _segments(docs: DataFrame, segments: int) -> DataFrame:
    """``segments`` windows of SEGMENT words, spread by hash over each whole text."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text in zip(batch["lang"], batch["text"]):
                words = words_of(text.lower())
                if not words:
                    continue
                seed = zlib.crc32(text.encode("utf-8", "replace"))
                for s in range(segments):
                    room = max(1, len(words) - SEGMENT + 1)
                    at = (seed * (2 * s + 1) + s * room // segments) % room
                    out.append((lang, words[at:at + SEGMENT]))
            yield pd.DataFrame(out, columns=["lang", "words"])

    return docs.mapInPandas(cut, "lang string, words array<string>")


def fit(docs: DataFrame, keep: Column, sample_docs: int = 1000, segments: int = 3) -> Field | None:
    """Train on at most about ``sample_docs`` labelled documents per language.

    The driver gets sample_docs * segments windows of SEGMENT words per language, so its work
    grows with the number of languages; none is left out.
    """
    rows = docs.filter(keep & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    shares = docs.sparkSession.createDataFrame(
        [(lang, min(1.0, sample_docs / n)) for lang, n in sorted(counts.items())], "lang string, share double")
    some = (rows.join(F.broadcast(shares), "lang")  # a row per language
            .filter(uniform("doc_id", F.lit(11)) < F.col("share")).select("lang", "text"))
    windows = materialize(_segments(some, segments), "lang_segments").toPandas()
    if not len(windows):
        return None
    return train(windows.sort_values(["lang", "words"], key=lambda c: c if c.name == "lang" else c.map(tuple))
                 .reset_index(drop=True), sorted(counts))


def _lined(rows: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, r in enumerate(rows):
        if size and size + len(r) > BATCH_WORDS:
            yield lo, i
            lo, size = i, 0
        size += len(r)
    if rows:
        yield lo, len(rows)


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, lang_pred, score, n_words`` of every whole text (columns doc_id, text)."""
    id_type = dict(docs.dtypes)["doc_id"]
    if field is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("long").alias("n_words"))
    # bounded by the training sample's features
    shared = docs.sparkSession.sparkContext.broadcast(
        (field.langs, field.index, field.weights, field.trans, field.start))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Field(*shared.value)
        for batch in batches:
            for lo, hi in _spans(batch["text"], 1_000_000):
                frame = pd.DataFrame(label(model, batch["text"].iloc[lo:hi]), columns=["lang_pred", "score", "n_words", "sure"])
                frame = frame.drop(columns="sure")
                frame.insert(0, "doc_id", batch["doc_id"].iloc[lo:hi].to_numpy())
                yield frame

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (texts.mapInPandas(run, "doc_id string, lang_pred string, score double, n_words long")
            .withColumn("doc_id", F.col("doc_id").cast(id_type)))


def label(model: Field, texts) -> list[tuple[str, float, int, float]]:
    """(language, its share of the letters, words, how sure each letter's language is) of each text."""
    lower = [t.lower() for t in texts]
    words = [words_of(t) for t in lower]
    out = [("und", 0.0, 0, 0.0)] * len(words)
    filled = [i for i, w in enumerate(words) if w]
    rows = model.rows([words[i] for i in filled])
    for a, b in _lined(rows):
        for i, post in zip(filled[a:b], model.marginals(rows[a:b])):
            letters = np.fromiter(map(len, words[i]), float, len(words[i]))
            share = letters @ post / letters.sum()
            best = int(share.argmax())
            n = len(words[i]) if letters.max() < LONGEST else len(words_of(lower[i], RUN))
            out[i] = (model.langs[best], min(1.0, float(share[best])), n,
                      min(1.0, float(letters @ post.max(1) / letters.sum())))
    return out


def keep_identified(docs: DataFrame, field: Field | None, least: float) -> DataFrame:
    """Rows of ``docs`` whose text's letters have languages that are sure to ``least`` on average.

    Each word counts with its own best language, so a text of several languages is as good as a
    text of one. A text without a letter is left out.
    Without a model nothing can be told, and every row stays. Rows stay in the JVM; only the
    text column goes to the model.
    """
    if field is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(
        (field.langs, field.index, field.weights, field.trans, field.start))

    @F.pandas_udf("boolean")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Field(*shared.value)
        for texts in batches:
            kept = []
            for lo, hi in _spans(texts, 1_000_000):
                kept.extend(n > 0 and sure >= least for _, _, n, sure in label(model, texts.iloc[lo:hi]))
            yield pd.Series(kept, dtype=bool)

    return docs.filter(identified(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def held_out_remainder() -> Column:
    return crc32_mod(F.col("doc_id"), 3) == 1


def op5_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs, ~held_out_remainder()))
    return found.select("doc_id", held_out_remainder().alias("held_out"), "lang_pred", "score", "n_words")


QUERIES = {"op5_langid": op5_langid}
