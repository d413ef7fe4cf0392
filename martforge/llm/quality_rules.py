"""Document quality by weak supervision.

Rules look at measures of a text and vote good, bad or abstain; none decides
alone.  A text's votes form a pattern, one of 3^rules.  Spark counts the
patterns over all documents; expectation-maximisation over these counts (a
bounded table, whatever the corpus) estimates for every rule how often it votes
what on good and on bad texts, and the share of good texts.  The posterior
probability that a text is good, given its votes, replaces the demand that all
rules pass.

Measures are exact over whole texts: windows of eight words are compared by
word identity, never by a hash.  A null or empty text has no words: it fails
the base test and abstains everywhere.  Repeated rows count each; an empty
table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import common
from martforge.session import cut_lineage

WINDOW = 8
STRETCH = 1000  # words whose distinct share is taken together, since it falls with length
SYMBOLS = "#*$%&|<>"  # fixed values: the counted symbols
GOOD, BAD, ABSTAIN = 2, 0, 1

# rule -> (measure, bad from, good up to); between the two the rule abstains,
# and a rule without a last number sees one defect only: it never votes good
RULES: dict[str, tuple[str, float, float | None]] = {
    "repeated_windows": ("repeat_share", 0.10, None),
    "symbols": ("symbols_per_word", 0.15, None),
    "shouting": ("upper_share", 0.20, None),
    "exclamations": ("exclaims_per_word", 0.15, None),
    "stutter": ("stutter_share", 0.10, None),
    "repeated_lines": ("dup_line_share", 0.34, None),
    "wordless_words": ("wordless_share", 0.08, None),
    "odd_words": ("odd_share", 0.15, 0.06),
    "few_distinct": ("sameness", 0.80, 0.65),
}
ACCUSED = 0.01  # a rule is taken to accuse at most this share of the good texts
PLAIN = re.compile(r"[(\"'«]?\w+(?:['’-]\w+)*[.,;:!?)\"'»]{0,1}").fullmatch


def covered_by_repeats(ids: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur at least twice.

    Windows get equal numbers exactly when they are equal word by word: pairs
    are numbered, then pairs of pairs, then pairs of those."""
    number, width = ids, 1
    while width < WINDOW:
        if len(number) <= width:
            return 0
        pair = number[:-width].astype(np.int64) * (int(number.max()) + 1) + number[width:]
        distinct, number, count = np.unique(pair, return_inverse=True, return_counts=True)
        if len(distinct) == len(pair):
            return 0
        width *= 2
    mark = np.zeros(len(ids) + 1, np.int64)
    start = np.flatnonzero(count[number] > 1)
    np.add.at(mark, start, 1)
    np.add.at(mark, start + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(mark[:-1])))


def measure(text: str) -> dict:
    data = text.encode("utf-8")
    words = data.split()
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    distinct = sum(len(set(words[i:i + STRETCH])) for i in range(0, n, STRETCH)) if n > STRETCH else len(number)
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeat = covered_by_repeats(ids) if n > WINDOW else 0
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    per = max(n, 1)
    lower, upper = text.lower(), text.upper()
    uppers = sum(map(str.__ne__, text, lower)) if len(lower) == len(text) else sum(c.isupper() for c in text)
    cased = sum(map(str.__ne__, upper, lower)) if len(lower) == len(upper) else sum(c.isalpha() for c in text)
    times = np.bincount(ids, minlength=len(number)).tolist()
    odd = wordless = 0
    for w, k in zip(number, times):
        if not w.isalpha():  # anything but ASCII letters
            word = w.decode("utf-8")
            if not PLAIN(word):
                odd += k
                if not any(map(str.isalnum, word)):
                    wordless += k
    return {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeat,
        "repeat_share": repeat / per, "symbols_per_word": symbols / per, "upper_share": uppers / max(cased, 1),
        "exclaims_per_word": text.count("!") / per, "stutter_share": float(np.count_nonzero(ids[1:] == ids[:-1])) / per,
        "dup_line_share": dup_lines / max(len(lines), 1), "wordless_share": wordless / per,
        "odd_share": odd / per, "sameness": (1 - distinct / per) if n >= 100 else 0.7,
    }


def votes(m: dict) -> int:
    """The rules' votes as one number in base three."""
    pattern = 0
    for name, (what, bad, good) in RULES.items():
        v = ABSTAIN if not m["n_words"] else BAD if m[what] >= bad else ABSTAIN if good is None or m[what] > good else GOOD
        pattern = 3 * pattern + v
    return pattern


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = ", ".join(f"{common.OWN}{c} long" for c in COUNTS) + f", {common.OWN}votes int"


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        common.worker_state("quality rules", dict)  # nothing to remember; drops what others did
        found = [measure(t) for t in common.texts_of(batch, text_col)]
        out = {common.OWN + c: pa.array([m[c] for m in found], pa.int64()) for c in COUNTS}
        return out | {common.OWN + "votes": pa.array([votes(m) for m in found], pa.int32())}

    return common.add_columns(docs, run, MEASURED)


def _digits(patterns: np.ndarray) -> np.ndarray:
    """patterns x rules, each 0, 1 or 2."""
    k = len(RULES)
    return (patterns[:, None] // 3 ** np.arange(k - 1, -1, -1)) % 3


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, dict]:
    """Posterior probability of good for each pattern, and the estimates.

    Two assumptions keep the classes from changing places: a rule accuses at
    most ``ACCUSED`` of the good texts, and a few pseudo-counts hold every rule
    to being better than chance."""
    votes_ = np.eye(3)[_digits(patterns)]  # pattern, rule, vote
    k = len(RULES)
    prior = np.empty((2, k, 3))
    prior[1] = (0.01, 5.0, 5.0)  # a good text: no rule sees a defect
    prior[0] = (2.0, 5.0, 3.0)  # a bad text: some rule sees it, others need not
    table, share = prior / prior.sum(2, keepdims=True), 0.8
    weight = counts.astype(float)
    for _ in range(rounds):
        score = np.einsum("prv,crv->pc", votes_, np.log(table)) + np.log([1 - share, share])
        good = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
        got = np.einsum("p,prv->rv", weight * good, votes_), np.einsum("p,prv->rv", weight * (1 - good), votes_)
        new = np.stack([got[1], got[0]]) + prior
        new /= new.sum(2, keepdims=True)
        new[1, :, 0] = np.minimum(new[1, :, 0], ACCUSED)
        new[1] /= new[1].sum(1, keepdims=True)
        new_share = (weight @ good + 8) / (weight.sum() + 10)
        done = np.abs(new - table).max() < 1e-9 and abs(new_share - share) < 1e-9
        table, share = new, new_share
        if done:
            break
    return good, {"share": share, "table": dict(zip(RULES, table.transpose(1, 0, 2)))}


def score(measured: DataFrame) -> DataFrame:
    """``measured`` (written, not recomputed) with base_failed, posterior and
    kept as own columns."""
    spark: SparkSession = measured.sparkSession
    v = common.OWN + "votes"
    rows = measured.groupBy(v).count().collect()  # at most 3^rules rows
    patterns = np.array(sorted(r[0] for r in rows), np.int64)
    counts = np.array([c for _, c in sorted((r[0], r[1]) for r in rows)], float)
    good = fit(patterns, counts)[0] if len(rows) else np.zeros(0)
    table = spark.createDataFrame([(int(p), float(g)) for p, g in zip(patterns, good)],
                                  f"{v} int, {common.OWN}posterior double")
    words, repeat = F.col(common.OWN + "n_words"), F.col(common.OWN + "n_repeat_words")
    failed = (words < 20) | (100 * repeat > 30 * words)
    return (measured.join(F.broadcast(table), v, "left")
            .withColumn(common.OWN + "base_failed", failed)
            .withColumn(common.OWN + "kept", ~failed & (F.col(common.OWN + "posterior") >= 0.5)))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, posterior, kept."""
    scored = score(cut_lineage(with_measures(common.id_and_text(docs)).drop("text"), "quality"))
    return scored.select("doc_id", *[F.col(common.OWN + c).alias(c) for c in
                                     (*COUNTS, "base_failed", "posterior", "kept")])


def keep_good(docs: DataFrame) -> DataFrame:
    """Whole rows of the documents that are kept."""
    scored = score(cut_lineage(with_measures(docs), "quality"))
    return scored.filter(F.col(common.OWN + "kept")).select(*docs.columns)
