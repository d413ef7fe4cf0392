"""Toxic spans and document scores by a linear-chain conditional random field.

Only documents are labelled, so tokens get their labels first: over the labelled
sample, features of words (the word, its beginnings) that stand in toxic
documents far more often than chance allows given the clean ones are cues, and
a token of a toxic document that shows a cue is a toxic token.  The field is
trained on windows of such labelled tokens: hashed word features give the
emission scores, a 2x2 table the transitions.  Forward-backward over a whole
text gives each token's marginal probability; the strongest marginal and the
expected number of toxic tokens make the document's score through a logistic
curve fitted on the same sample, and tokens over one half give the offsets.

Training reads labels of ``fit_on`` documents only and at most ``SAMPLE``
documents of each class, chosen by a hash of the key, of at most
``SAMPLE_CHARS`` characters each; scoring reads every text whole.  Neither
language, source nor key is an input of a score.  Without a labelled document
of each class every text scores 0.

A null or empty text has no token and scores the curve's value for none.
Repeated rows score alike; labels of unknown documents are ignored; of several
labels of one document the highest counts; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm import common

SAMPLE = 4000  # labelled documents of each class that training reads, at most
SAMPLE_CHARS = 20_000  # longest document that training reads
TABLE = 1 << 18  # hashed emission weights
WINDOW = 24  # tokens in a training window
TOXIC_SHARE = 0.15  # weight of the toxic class in the score's curve
WORDS_KEPT = 400_000  # bound on remembered words per worker
TOKEN = re.compile("[^\\x20\\x09-\\x0D]+")
EDGE = b".,;:!?()[]{}\"'*#%&$|<>-_"
FAR = 30.0  # bound on scores, in log odds


def tokens(text: str) -> list[bytes]:
    return text.lower().encode("utf-8").split()


def features(word: bytes) -> list[bytes]:
    w = word.strip(EDGE).decode("utf-8")
    out = ["w " + w, "e " + w[-3:]]
    out += ["b " + w[:k] for k in (2, 3, 4, 5, 6) if len(w) > k]
    return [x.encode("utf-8") for x in out]


def slots(word: bytes) -> list[int]:
    return [zlib.crc32(f) % TABLE for f in features(word)]


@dataclass
class Model:
    emission: np.ndarray  # TABLE weights, log odds of toxic
    start: float
    step: np.ndarray  # 2x2 transition scores
    curve: np.ndarray  # intercept, strongest marginal (log odds), log(1 + expected tokens)
    fitted: bool = True


def _run(odds: np.ndarray, lengths: np.ndarray, start: float, step: np.ndarray) -> np.ndarray:
    """Marginal odds of toxic per token; ``odds`` is time x texts with lengths
    falling, so the texts still running at a time are the first ones."""
    t = np.exp(step)
    running = np.searchsorted(-lengths, -np.arange(1, len(odds) + 1), side="right")
    fwd, back = np.zeros_like(odds), np.zeros_like(odds)
    fwd[0] = odds[0] * np.exp(start)
    low, high = 1e-13, 1e13
    for i in range(1, len(odds)):
        k = running[i]
        x = fwd[i - 1, :k]
        fwd[i, :k] = np.clip(odds[i, :k] * (t[0, 1] + t[1, 1] * x) / (t[0, 0] + t[1, 0] * x), low, high)
    back[lengths - 1, np.arange(odds.shape[1])] = 1.0
    for i in range(len(odds) - 2, -1, -1):
        k = running[i + 1]
        x = odds[i + 1, :k] * back[i + 1, :k]
        back[i, :k] = np.clip((t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x), low, high)
    return fwd * back


class Tagger:
    def __init__(self, model: Model):
        self.model, self.weights, self.known = model, array("f", model.emission.astype("f").tobytes()), {}

    def _emission(self, word: bytes) -> float:
        w = self.weights
        return sum(w[s] for s in slots(word))

    def emissions(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._emission(w)
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Marginal odds of every token of every text."""
        scores = [self.emissions(tokens(t)) for t in texts]
        out: list[np.ndarray] = [np.zeros(0)] * len(texts)
        order = sorted((i for i in range(len(texts)) if len(scores[i])), key=lambda i: -len(scores[i]))
        at = 0
        while at < len(order):
            longest = len(scores[order[at]])
            group = order[at:at + max(1, min(400, 600_000 // longest))]
            at += len(group)
            lengths = np.array([len(scores[i]) for i in group])
            odds = np.zeros((longest, len(group)))
            for j, i in enumerate(group):
                odds[:lengths[j], j] = scores[i]
            odds = np.exp(np.clip(odds, -FAR, FAR))
            found = _run(odds, lengths, self.model.start, self.model.step)
            for j, i in enumerate(group):
                out[i] = found[:lengths[j], j].copy()
        return out

    @staticmethod
    def summary(odds: np.ndarray) -> tuple[float, float]:
        """Strongest marginal in log odds, log(1 + expected toxic tokens)."""
        if not len(odds):
            return -FAR, 0.0
        top = float(np.clip(np.log(max(odds.max(), 1e-13)), -FAR, FAR))
        return top, float(np.log1p((odds / (1 + odds)).sum()))

    def score(self, odds: np.ndarray) -> float:
        if not self.model.fitted:
            return 0.0
        top, much = self.summary(odds)
        z = float(np.clip(self.model.curve @ np.array([1.0, top / 10, much]), -500, 500))
        return 1 / (1 + np.exp(-z))


def spans(text: str, odds: np.ndarray) -> list[tuple[int, int]]:
    """Source offsets of runs of tokens more likely toxic than not."""
    if not len(odds) or odds.max() <= 1:
        return []
    out: list[tuple[int, int]] = []
    before = False
    for m, o in zip(TOKEN.finditer(text), odds.tolist()):
        if o > 1:
            out.append((out.pop()[0] if before else m.start(), m.end()))
        before = o > 1
    return out


def cues(toxic: list[list[bytes]], clean: list[list[bytes]]) -> set[bytes]:
    """Features found in toxic documents beyond what the clean ones explain:
    the log-likelihood ratio against a common rate is over 14, the rate at
    least tenfold, in three documents or more."""
    counts = []
    for docs in (toxic, clean):
        n: Counter = Counter()
        for words in docs:
            n.update({f for w in set(words) for f in features(w) if not f.startswith(b"e ")})
        counts.append(n)
    out = set()
    for f, k in counts[0].items():
        expected = len(toxic) * (counts[1][f] + 0.5) / (len(clean) + 0.5)
        if k >= 3 and k > 10 * expected and k * np.log(k / expected) - (k - expected) > 14:
            out.add(f)
    return out


def train(toxic: list[str], clean: list[str], rounds: int = 12, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    if not toxic or not clean:
        return Model(np.zeros(TABLE), 0.0, np.zeros((2, 2)), np.array([-FAR, 0, 0]), fitted=False)
    sets = [[tokens(t) for t in toxic], [tokens(t) for t in clean]]
    cue = cues(*sets)
    is_cue: dict[bytes, bool] = {}
    windows, labels = [], []

    def add(words, marks, at):
        a = max(0, min(at, len(words) - WINDOW))
        windows.append(words[a:a + WINDOW])
        labels.append(marks[a:a + WINDOW])

    for kind, docs in enumerate(sets):
        for words in docs:
            if not words:
                continue
            marks = np.zeros(len(words))
            if kind == 0:
                for w in set(words).difference(is_cue):
                    is_cue[w] = any(f in cue for f in features(w))
                marks[:] = [is_cue[w] for w in words]
                for at in np.flatnonzero(marks)[:8]:
                    add(words, marks, int(at) - int(rng.integers(0, WINDOW)))
            for _ in range(2 if kind == 0 else 6):
                add(words, marks, int(rng.integers(0, max(1, len(words)))))
    number: dict[bytes, int] = {}
    n, width = len(windows), WINDOW
    ids, gold, mask = np.zeros((n, width), np.int64), np.zeros((n, width)), np.zeros((n, width), bool)
    for i, (ws, ms) in enumerate(zip(windows, labels)):
        ids[i, :len(ws)] = [number.setdefault(w, len(number)) for w in ws]
        gold[i, :len(ws)], mask[i, :len(ws)] = ms, True
    table = np.full((len(number), 7), TABLE)  # the last weight stays 0
    for w, k in number.items():
        s = slots(w)
        table[k, :len(s)] = s
    weight, seen = np.zeros(TABLE + 1), np.full(TABLE + 1, 1e-2)
    step, start = np.array([[0.5, -2.0], [0.5, 0.0]]), -2.0
    step_seen = np.full((2, 2), 1.0)
    for r in range(rounds):
        order = rng.permutation(n)
        for a in range(0, n, 256):
            rows = order[a:a + 256]
            rows = rows[np.argsort(-mask[rows].sum(1), kind="stable")]
            y, live = gold[rows].T, mask[rows].T
            slot = table[ids[rows]]  # texts, time, features
            e = weight[slot].sum(2).T
            lengths = live.sum(0)
            odds = np.where(live, np.exp(np.clip(e, -FAR, FAR)), 0.0)
            t = np.exp(step)
            marg = _run(odds, lengths, start, step)
            p = marg / (1 + marg)
            grad = np.where(live, p - y, 0.0).T  # texts, time
            g = np.zeros(TABLE + 1)
            np.add.at(g, slot, grad[:, :, None])
            g[:TABLE] += 1e-4 * len(rows) / n * weight[:TABLE]
            g[TABLE] = 0
            seen += g * g
            weight -= 0.5 * g / np.sqrt(seen)
            # pairs: expected minus observed transitions
            fwd = np.zeros_like(odds)
            fwd[0] = odds[0] * np.exp(start)
            for i in range(1, len(odds)):
                fwd[i] = np.clip(odds[i] * (t[0, 1] + t[1, 1] * fwd[i - 1]) / (t[0, 0] + t[1, 0] * fwd[i - 1]), 1e-13, 1e13)
            back = marg / np.maximum(fwd, 1e-13)
            f0, b1 = fwd[:-1], odds[1:] * back[1:]
            joint = np.stack([np.full_like(f0, t[0, 0]), t[0, 1] * b1, t[1, 0] * f0, t[1, 1] * f0 * b1])
            joint /= joint.sum(0)
            pair = live[1:]
            y0, y1 = y[:-1], y[1:]
            observed = np.stack([(1 - y0) * (1 - y1), (1 - y0) * y1, y0 * (1 - y1), y0 * y1])
            gs = ((joint - observed) * pair).sum((1, 2)).reshape(2, 2) / len(rows)
            step_seen += gs * gs
            step -= 0.2 * gs / np.sqrt(step_seen)
    model = Model(weight[:TABLE], start, step, np.zeros(3))
    tagger = Tagger(model)
    x = np.array([(1.0, s[0] / 10, s[1]) for t in (toxic, clean) for s in map(tagger.summary, tagger.marginals(t))])
    z = np.r_[np.ones(len(toxic)), np.zeros(len(clean))]
    balance = np.where(z > 0, TOXIC_SHARE / len(toxic), (1 - TOXIC_SHARE) / len(clean)) * len(z)
    w = np.zeros(3)
    for _ in range(60):  # Newton steps of a logistic regression with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        h = (x * (balance * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
        w -= np.linalg.solve(h, x.T @ (balance * (p - z)) + 0.5 * w)
    model.curve = w
    return model


def sample(docs: DataFrame, labels: DataFrame, label: str, fit_on: Column) -> tuple[list[str], list[str]]:
    """At most ``SAMPLE`` labelled texts of each class.  The keys are chosen from
    the labels alone; only the chosen texts are read to the driver."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull()).filter(fit_on)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    draw = F.xxhash64(F.col("doc_id"), F.lit(11))
    picked = None
    for y in (1, 0):
        one = known.filter(F.col("y") == y).orderBy(draw, "doc_id").limit(2 * SAMPLE)
        picked = one if picked is None else picked.unionByName(one)
    rows = (common.id_and_text(docs).join(F.broadcast(picked), "doc_id")  # at most 4 * SAMPLE keys
            .filter(F.length("text").between(1, SAMPLE_CHARS))
            .select("doc_id", "text", "y", draw.alias("draw")))
    out = []
    for y in (1, 0):
        got = rows.filter(F.col("y") == y).orderBy("draw", "doc_id", "text").limit(SAMPLE).select("text").collect()
        out.append([r[0] for r in got])
    return out[0], out[1]


def _tagger(shared) -> Tagger:
    """The tagger of this worker process for a broadcast model."""
    return common.worker_state(("tagger", shared.value.curve.tobytes()), lambda: Tagger(shared.value))


SCORED = f"{common.OWN}score double, {common.OWN}spans string"


def with_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the score and the toxic spans (start:end, comma-joined)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        tagger, score, offsets = _tagger(shared), [], []
        texts = common.texts_of(batch, text_col)
        for a in range(0, len(texts), 1000):
            part = texts[a:a + 1000]
            for text, odds in zip(part, tagger.marginals(part)):
                score.append(tagger.score(odds))
                offsets.append(",".join(f"{x}:{y}" for x, y in spans(text, odds)))
        return {common.OWN + "score": score, common.OWN + "spans": offsets}

    return common.add_columns(docs, run, SCORED)


def scores(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    s = F.col(common.OWN + "score")
    return (with_scores(common.id_and_text(docs), model)
            .select("doc_id", s.alias("score"), (s >= threshold).cast("int").alias("predicted"),
                    F.col(common.OWN + "spans").alias("spans")))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Whole rows of the documents below the threshold."""
    return with_scores(docs, model).filter(F.col(common.OWN + "score") < threshold).select(*docs.columns)
