"""Scores of texts by a log-bilinear model trained with noise-contrastive estimation.

Tokens are the text's words and one end.  Spark counts every word of the
training documents; those met ``MIN_COUNT`` times, and ``OUTPUTS`` minus two at
least, are outputs of the model, next to the end and one output for all other
words, so the outputs grow with the corpus.  The outputs
are cut into classes, about as many as make class and word equally dear: the
model gives the class after the last ``CONTEXT`` tokens, then the word in its class, so
the exact normaliser costs two short sums.  Both are a token vector per place, weighted per
place, summed, against the vector and bias of each class or output.  At scoring
time token probabilities sum to one.  A word outside the outputs gets the
probability of that output times its share among such words,
(c + 0.5) / (N' + 0.5 (V' + 1)).

Every training document is learned from in each of ``EPOCHS`` rounds: tasks
tell true tokens from noise on their part of the documents, each on a copy of
the parameters; the copies' moves are added up by Spark, a row of parameters
weighed by what each task learned about it, and the driver holds parameters
only.  Class noise follows the counts, word noise is even within the class; tokens
of a step share it, so that telling true from noise is a few matrix products.

Counts meet texts block by block: a task turns its documents into blocks of
local word numbers with the block's own word list.  The outputs' words are
broadcast, as the parameters are, about 35 numbers an output, since a block needs
nearly every class; all other words of a block (a word once per block, whatever
its frequency) are joined with the counts, and sums by text come back.  Only these
words are shuffled: the blocks stay where they were written.

A null text is the empty text: only the end is scored.  Repeated rows score
alike; other columns are ignored; an empty table gives an empty result, and
without training tokens every word is unknown and the model is uniform.
"""


from __future__ import annotations

import copy
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm import common
from martforge.operators.ranking import with_global_rank
from martforge.session import cut_lineage

OUTPUTS = 384  # outputs of the model at least, the end and the rest included
MIN_COUNT = 20  # a word met so often is an output
CONTEXT = 3  # tokens that a prediction looks back on
WIDTH = 16  # vector length; a row of parameters has a bias behind it
EPOCHS = 3  # rounds over the training documents
NOISE = 8  # noise tokens for a true one
SHARED = 16  # noise classes or words that tokens share, each counting NOISE / SHARED
ALIKE, TOGETHER = 80, 8  # tokens that share noise classes; tokens of a class in one matrix product
STEP = 2000  # tokens of one gradient step
RUN = 8  # neighbouring tokens that stay together when tokens are shuffled
GROUP = 500_000  # tokens that are shuffled together
CHUNK = 4096  # parameter rows that are added up together
BLOCK_CHARS = 3_000_000  # text in a block before it is closed
BLOCK_DOCS = 4000
EXPS = 1 << 18  # exponentials taken together, which stay in the processor's cache
END, REST = 0, 1  # the first outputs; as context, the number of outputs stands for the start


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in the place of ``x``."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _log_sums(x: np.ndarray) -> np.ndarray:
    """Log of the sum of each row's exponentials; ``x`` is used up."""
    top = 0.0
    if max(x.max(), -x.min()) > 60:
        top = x.max(1, keepdims=True)
        x -= top
        top = top[:, 0].astype(float)
    np.exp(x, out=x)
    return top + np.log(x @ np.ones(x.shape[1], "f"), dtype=float)


def _within(seq: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place of each token in its text."""
    return np.arange(len(seq)) - np.repeat(starts, np.diff(np.r_[starts, len(seq)]))


def _order(*keys: np.ndarray) -> np.ndarray:
    """Order by the keys, whole numbers from 0 to 2**32, the last key first; 16 bits at a time, which numpy sorts by radix."""
    order = None
    for key in keys:
        for shift in (0, 16) if len(key) and int(key.max()) >> 16 else (0,):
            part = (key >> shift).astype(np.uint16)
            order = np.argsort(part, kind="stable") if order is None else order.take(np.argsort(part.take(order), kind="stable"))
    return order


def _summed(where: np.ndarray, rows: np.ndarray, few: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``where``, which is sorted, and the sum of each one's rows."""
    first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
    times = np.diff(np.r_[first, len(where)])
    out, more = rows.take(first, 0), np.flatnonzero(times > 1)
    # second rows, third rows and so on; values with many rows by themselves
    some, at = more[times[more] <= few], 1
    while len(some):
        out[some] += rows.take(first[some] + at, 0)
        at += 1
        some = some[times[some] > at]
    many = more[times[more] > few]
    if len(many):
        n = times[many]
        ends = np.cumsum(n)
        out[many] = np.add.reduceat(rows.take(np.arange(ends[-1]) + np.repeat(first[many] - ends + n, n), 0), np.r_[0, ends[:-1]], axis=0)
    return where[first], out


class Model:
    """``rows`` holds, below each other, the vectors of the context tokens (the
    outputs and the start), outputs, classes and places; ``seen`` the summed squared gradients of each row."""

    def __init__(self, counts: np.ndarray, seed: int = 5):
        self.n = n = len(counts)
        share = (counts + 0.1) / (counts + 0.1).sum()
        # classes of consecutive outputs with the same sum of square roots
        roots = np.cumsum(np.sqrt(share))
        at = np.minimum((roots * (np.ceil(roots[-1]) / roots[-1])).astype(np.int64), int(np.ceil(roots[-1])) - 1)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        self.bounds = np.r_[first, n]
        self.sizes = np.diff(self.bounds)
        self.class_of = np.repeat(np.arange(len(first)), self.sizes)
        self.class_share = np.add.reduceat(share, first)
        self.cumulative = np.cumsum(self.class_share)
        # log of how often a class or word is noise for a token
        self.class_shift = np.log(NOISE * self.class_share).astype("f")
        self.word_shift = np.log(NOISE / self.sizes).astype("f")
        rng = np.random.default_rng(seed)
        self.at_outputs, self.at_classes = n + 1, 2 * n + 1
        self.at_places = self.at_classes + len(first)
        self.rows = rng.normal(0, 0.1, (self.at_places + CONTEXT, WIDTH + 1)).astype("f")
        self.rows[:n + 1, WIDTH] = 0
        if not counts.any():
            self.rows[self.at_outputs:self.at_places] = 0
        self.rows[self.at_outputs:self.at_classes, WIDTH] = np.log(share / self.class_share[self.class_of])
        self.rows[self.at_classes:self.at_places, WIDTH] = np.log(self.class_share)
        self.rows[self.at_places:] = 1 / np.arange(1, CONTEXT + 1)[:, None]
        self.rows[self.at_places:, WIDTH] = 0
        self.seen = np.full(len(self.rows), 1e-2)

    def copy(self) -> "Model":
        out = copy.copy(self)
        out.rows, out.seen = self.rows.copy(), self.seen.copy()
        return out

    def contexts(self, seq: np.ndarray, within: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tokens before each token of ``at``, the nearest first."""
        return np.stack([np.where(within[at] > j, seq[at - j - 1], self.n) for j in range(CONTEXT)])

    def hidden(self, vectors: np.ndarray) -> np.ndarray:
        out = (vectors * self.rows[self.at_places:, None]).sum(0)
        out[:, WIDTH] = 1
        return out

    def log_probabilities(self, seq: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probability of each token of texts laid end to end."""
        within = _within(seq, starts)
        classes = self.rows[self.at_classes:self.at_places].T.copy()
        outputs = self.rows[self.at_outputs:self.at_classes]

        def chosen(hidden: np.ndarray, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
            scores = hidden @ vectors
            target = scores[np.arange(len(scores)), which].astype(float)
            return target - _log_sums(scores)

        out = np.empty(len(seq))
        for a in range(0, len(seq), 1 << 16):
            at = np.arange(a, min(a + (1 << 16), len(seq)))
            word = seq[at]
            of = self.class_of[word]
            order = _order(of)
            at, word, of = at[order], word[order], of[order]
            hidden = self.hidden(self.rows.take(self.contexts(seq, within, at), 0))
            n = max(64, EXPS // classes.shape[1])
            each = np.concatenate([chosen(hidden[i:i + n], classes, of[i:i + n]) for i in range(0, len(at), n)])
            ends = np.searchsorted(of, np.arange(len(self.sizes) + 1))
            for c in np.flatnonzero((self.sizes > 1) & (np.diff(ends) > 0)).tolist():
                lo, hi = self.bounds[c], self.bounds[c + 1]
                vectors, n = outputs[lo:hi].T, max(64, EXPS // (hi - lo))
                for i in range(ends[c], ends[c + 1], n):
                    some = slice(i, min(i + n, ends[c + 1]))
                    each[some] += chosen(hidden[some], vectors, word[some] - lo)
            out[at] = each
        return out

    def learn(self, seq: np.ndarray, starts: np.ndarray, epoch: int, rng: np.random.Generator) -> None:
        """One pass over texts laid end to end, in steps of shuffled runs of tokens.

        The tokens of a step are ordered by output, hence by class.  ``ALIKE`` of
        them share noise classes; those of a class share noise words, spread evenly
        over the class from a random start, and are told from them ``TOGETHER`` at a time."""
        if not len(seq):
            return
        rate, n_steps = 0.1 / (1 + epoch), max(1, len(seq) // STEP)
        # texts behind CONTEXT starts each, cut into runs, and runs into steps
        at = np.arange(len(seq)) + CONTEXT * np.repeat(np.arange(1, len(starts) + 1), np.diff(np.r_[starts, len(seq)]))
        at += rng.integers(RUN)
        runs = rng.permutation(int(at[-1]) // RUN + 1)
        laid = np.full(CONTEXT + len(runs) * RUN, self.n, np.int32)
        laid[CONTEXT + at] = seq
        around = np.lib.stride_tricks.sliding_window_view(laid, CONTEXT + RUN - 1)[::RUN]
        cut = np.r_[0, np.cumsum([len(x) for x in np.array_split(runs, n_steps)])]
        rank = np.empty(len(runs), np.int64)
        rank[runs] = np.arange(len(runs))
        rank = rank[at // RUN]
        step = np.searchsorted(cut, rank, side="right") - 1
        order = _order(seq, step)
        step = step[order]
        spots, outputs, classes = (rank[order] - cut[step]) * RUN + at[order] % RUN, seq[order], self.class_of[seq[order]]
        # the tokens of a class in a step, in rows of TOGETHER
        first = np.flatnonzero(np.r_[True, (classes[1:] != classes[:-1]) | (step[1:] != step[:-1])])
        length = np.diff(np.r_[first, len(seq)])
        first_row = np.r_[0, np.cumsum(-(-length // TOGETHER))]
        places = np.repeat(first_row[:-1] * TOGETHER - first, length) + np.arange(len(seq))
        of_row = np.repeat(np.arange(len(first)), np.diff(first_row))
        class_of = classes[first]
        spread = (np.arange(SHARED) + rng.random((len(first), 1))) * (self.sizes[class_of] / SHARED)[:, None]
        noise = self.bounds[class_of][:, None] + np.minimum(spread.astype(np.int64), self.sizes[class_of][:, None] - 1)
        of_step = np.searchsorted(step, np.arange(n_steps + 1))
        firsts = np.searchsorted(first, of_step)
        with np.errstate(over="ignore"):
            for s in range(n_steps):
                a, b, i, j = of_step[s], of_step[s + 1], firsts[s], firsts[s + 1]
                if a < b:
                    row, next_row = first_row[i], first_row[j]
                    self._step(around[runs[cut[s]:cut[s + 1]]], spots[a:b], outputs[a:b], classes[a:b], class_of[i:j], noise[i:j],
                               places[a:b] - row * TOGETHER, of_row[row:next_row] - i, rate, rng)

    def _step(self, around: np.ndarray, spots: np.ndarray, y: np.ndarray, k: np.ndarray, class_of: np.ndarray, noise: np.ndarray,
              places: np.ndarray, of_row: np.ndarray, rate: float, rng: np.random.Generator) -> None:
        """One gradient step: the tokens in and before each run; the spots among the runs'
        tokens, outputs and classes of the tokens learned; of each class among them, itself
        and its noise words; the tokens' places in rows, and the class of each row."""
        n, m, wide = self.n, len(y), WIDTH + 1
        rows, per_place = self.rows, self.rows[self.at_places:]
        of_outputs, of_classes = rows[self.at_outputs:self.at_classes], rows[self.at_classes:self.at_places]
        share = np.float32(NOISE / SHARED)
        vectors = rows.take(around, 0)
        before = [slice(CONTEXT - 1 - j, CONTEXT - 1 - j + RUN) for j in range(CONTEXT)]
        grid = vectors[:, before[0]] * per_place[0]
        for j in range(1, CONTEXT):
            grid += vectors[:, before[j]] * per_place[j]
        full = np.zeros((-(-m // ALIKE) * ALIKE, wide), "f")
        hidden = full[:m]
        hidden[:] = grid.reshape(-1, wide).take(spots, 0)
        hidden[:, WIDTH] = 1
        # noise classes, which follow the counts
        alike = full.reshape(-1, ALIKE, wide)
        z = np.minimum(np.searchsorted(self.cumulative, rng.random((len(alike), SHARED))), len(self.cumulative) - 1)
        false = of_classes.take(z, 0)
        minus = np.negative(false)
        minus[:, :, WIDTH] += self.class_shift[z]
        g = _logistic(alike @ minus.transpose(0, 2, 1))
        g *= share
        g_hidden = (g @ false).reshape(-1, wide)[:m]
        g_z = (g.transpose(0, 2, 1) @ alike).reshape(-1, wide)
        # noise words, even within the class, and behind them the true class
        false = np.concatenate([of_outputs.take(noise, 0), of_classes.take(class_of, 0)[:, None]], 1)
        minus = np.negative(false)
        minus[:, :SHARED, WIDTH] += self.word_shift[class_of][:, None]
        minus[:, SHARED, WIDTH] += self.class_shift[class_of]
        padded = np.zeros((len(of_row) * TOGETHER, wide), "f")
        padded[places] = hidden
        padded = padded.reshape(-1, TOGETHER, wide)
        g = _logistic(padded @ minus.take(of_row, 0).transpose(0, 2, 1))
        g[:, :, :SHARED] *= share
        g[:, :, SHARED] -= 1
        g_hidden += (g @ false.take(of_row, 0)).reshape(-1, wide).take(places, 0)
        g_false = _summed(of_row, (g.transpose(0, 2, 1) @ padded).reshape(len(g), -1))[1].reshape(false.shape)
        # the true word
        true = of_outputs.take(y, 0)
        g = (_logistic(self.word_shift[k] - np.einsum("ij,ij->i", hidden, true)) - 1)[:, None]
        true *= g
        g_hidden += true
        g_hidden[:, WIDTH] = 0
        hidden *= g
        where = np.concatenate([y, noise.ravel(), n + class_of, n + z.ravel()])
        order = _order(where)
        touched, g_rows = _summed(where.take(order), np.concatenate(
            [hidden, g_false[:, :SHARED].reshape(-1, wide), g_false[:, SHARED], g_z]).take(order, 0))
        # the tokens before
        grid[:] = 0
        grid.reshape(-1, wide)[spots] = g_hidden
        g_vectors, g_places = np.zeros_like(vectors), np.empty((CONTEXT, wide), "f")
        for j in range(CONTEXT):
            g_vectors[:, before[j]] += grid * per_place[j]
            g_places[j] = (grid * vectors[:, before[j]]).reshape(-1, wide).sum(0)
        around = around.ravel()
        order = _order(around)
        used, g_used = _summed(around.take(order), g_vectors.reshape(-1, wide).take(order, 0))
        # rows move by their own summed squares
        touched = np.concatenate([used, self.at_outputs + touched, self.at_places + np.arange(CONTEXT)])
        g = np.concatenate([g_used, g_rows, g_places])
        g /= np.float32(m ** 0.5)
        seen = self.seen.take(touched) + np.einsum("ij,ij->i", g, g) / wide
        self.seen[touched] = seen
        g *= (rate / np.sqrt(seen)).astype("f")[:, None]
        rows[touched] = rows.take(touched, 0) - g


def train(texts: list[np.ndarray], epochs: int = EPOCHS, seed: int = 5) -> Model:
    """A model of ``OUTPUTS`` outputs; ``texts`` hold output numbers."""
    counts = np.bincount(np.concatenate(texts), minlength=OUTPUTS) if texts else np.zeros(OUTPUTS, np.int64)
    model, rng = Model(counts, seed), np.random.default_rng(seed)
    for epoch in range(epochs if texts else 0):
        model.learn(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])[:-1]], epoch, rng)
    return model


def texts_of_block(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: which texts are trained on, their lengths, and their numbers laid end to end."""
    return (np.array(batch.column("trains")[i].as_py(), bool), np.array(batch.column("lengths")[i].as_py(), np.int64),
            np.frombuffer(batch.column("numbers")[i].as_buffer(), "<i4"))


def training_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of training texts laid end to end, and starts, some blocks at a time."""
    texts: list[tuple[np.ndarray, np.ndarray]] = []

    def together() -> tuple[np.ndarray, np.ndarray]:
        lengths = np.concatenate([n for n, _ in texts])
        return np.concatenate([x for _, x in texts]), np.cumsum(lengths) - lengths

    for batch in batches:
        for i in range(batch.num_rows):
            trains, lengths, numbers = texts_of_block(batch, i)
            texts.append((lengths[trains], numbers[np.repeat(trains, lengths)]))
            if sum(len(x) for _, x in texts) >= GROUP:
                yield together()
                texts.clear()
    if any(len(x) for _, x in texts):
        yield together()


def train_on(numbered: DataFrame, counts: np.ndarray) -> Model:
    """The model of every training document of the blocks ``numbered`` (trains, lengths, numbers)."""
    context = numbered.sparkSession.sparkContext
    model = Model(counts)
    texts = numbered.select("trains", "lengths", "numbers").coalesce(max(1, context.defaultParallelism))
    for epoch in range(EPOCHS if counts.any() else 0):
        shared = context.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            task = TaskContext.get().partitionId()
            start, rng = shared.value, np.random.default_rng([5, epoch, task])
            own = start.copy()
            for seq, starts in training_groups(batches):
                own.learn(seq, starts, epoch, rng)
            weight = (own.seen - start.seen).astype("<f4")
            for a in range(0, len(weight), CHUNK):
                at = np.flatnonzero(weight[a:a + CHUNK]).astype("<i4")
                if len(at):
                    w = weight[a + at]
                    moved = (own.rows[a + at] - start.rows[a + at]) * w[:, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([a // CHUNK], pa.int32()), pa.array([task], pa.int32()),
                         *(pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((at, "<i4"), (w, "<f4"), (moved, "<f4")))],
                        ["chunk", "task", "at", "weight", "moved"])

        def add(parts: pa.Table) -> pa.Table:
            weight, moved = np.zeros(CHUNK), np.zeros((CHUNK, WIDTH + 1))
            for r in sorted(parts.to_pylist(), key=lambda r: r["task"]):
                at = np.frombuffer(r["at"], "<i4")
                weight[at] += np.frombuffer(r["weight"], "<f4")
                moved[at] += np.frombuffer(r["moved"], "<f4").reshape(-1, WIDTH + 1)
            moved /= np.where(weight > 0, weight, 1)[:, None]
            return pa.table({"chunk": pa.array([parts.column("chunk")[0].as_py()], pa.int32()),
                             "weight": pa.array([weight.astype("<f4").tobytes()], pa.binary()),
                             "moved": pa.array([moved.astype("<f4").tobytes()], pa.binary())})

        moves = (texts.mapInArrow(run, "chunk int, task int, at binary, weight binary, moved binary")
                 .groupBy("chunk").applyInArrow(add, "chunk int, weight binary, moved binary").collect())
        model = model.copy()
        for r in moves:
            part = slice(r["chunk"] * CHUNK, min((r["chunk"] + 1) * CHUNK, len(model.rows)))
            size = part.stop - part.start
            model.seen[part] += np.frombuffer(r["weight"], "<f4")[:size]
            model.rows[part] += np.frombuffer(r["moved"], "<f4").reshape(-1, WIDTH + 1)[:size]
        shared.destroy()
    return model


BLOCK = ("block long, ids array<long>, trains array<boolean>, lengths array<int>, numbers binary, "
         "words array<string>, counts array<long>")


def blocks(texts: DataFrame) -> DataFrame:
    """(doc_id, text, trains) as blocks of local word numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        ids, trains, numbers, chars = [], [], [], 0

        def numbering() -> defaultdict[bytes, int]:
            out: defaultdict[bytes, int] = defaultdict()
            out.default_factory = out.__len__
            return out

        number = numbering()

        def close():
            nonlocal number, ids, trains, numbers, chars, block
            counts = np.zeros(len(number), np.int64)
            for x, train in zip(numbers, trains):
                if train:
                    counts += np.bincount(x, minlength=len(number))
            row = pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([trains], pa.list_(pa.bool_())), pa.array([[len(x) for x in numbers]], pa.list_(pa.int32())),
                pa.array([b"".join(x.astype("<i4").tobytes() for x in numbers)], pa.binary()),
                pa.array([[w.decode("utf-8") for w in number]], pa.list_(pa.string())),
                pa.array([counts.tolist()], pa.list_(pa.int64()))],
                ["block", "ids", "trains", "lengths", "numbers", "words", "counts"])
            number, ids, trains, numbers, chars = numbering(), [], [], [], 0
            block += 1
            return row

        for batch in batches:
            for doc, text, train in zip(batch.column(0).to_pylist(), common.texts_of(batch), batch.column(2).to_pylist()):
                words = tokens(text)
                ids.append(doc)
                trains.append(train)
                numbers.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                chars += len(text)
                if chars >= BLOCK_CHARS or len(ids) >= BLOCK_DOCS:
                    yield close()
        if ids:
            yield close()

    return texts.mapInArrow(run, BLOCK)


NUMBERED = ("block long, ids array<long>, trains array<boolean>, lengths array<int>, numbers binary, "
            "rest array<string>, rest_lengths array<int>, rest_numbers binary")


def with_outputs(blocked: DataFrame, outputs: pa.Array) -> DataFrame:
    """Blocks with output numbers and an end behind each text; the words that are no
    outputs go with them, as the block's ``rest``, by local numbers of their own."""
    shared = blocked.sparkSession.sparkContext.broadcast(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column("words").slice(i, 1).flatten()
                found = pa.compute.index_in(words, value_set=shared.value)
                known = found.is_valid().to_numpy(zero_copy_only=False)
                as_output = np.where(known, found.fill_null(0).to_numpy() + 2, REST).astype("<i4")
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                local = np.frombuffer(batch.column("numbers")[i].as_buffer(), "<i4")
                numbers = np.full(len(local) + len(lengths), END, "<i4")
                is_word = np.ones(len(numbers), bool)
                is_word[np.cumsum(lengths + 1) - 1] = False
                numbers[is_word] = as_output[local]
                is_rest = ~known[local]
                before = np.r_[0, np.cumsum(is_rest)]
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(n).slice(i, 1) for n in ("block", "ids", "trains")),
                    pa.array([lengths + 1], pa.list_(pa.int32())), pa.array([numbers.tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(words) - int(known.sum())], pa.int32()), words.filter(pa.array(~known))),
                    pa.array([before[ends] - before[ends - lengths]], pa.list_(pa.int32())),
                    pa.array([(np.cumsum(~known) - 1)[local[is_rest]].astype("<i4").tobytes()], pa.binary())],
                    ["block", "ids", "trains", "lengths", "numbers", "rest", "rest_lengths", "rest_numbers"])

    return blocked.select("block", "ids", "trains", "lengths", "numbers", "words").mapInArrow(run, NUMBERED)


def score(docs: DataFrame, fit_on: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.coalesce(fit_on, F.lit(False)).alias("trains"))
    blocked = cut_lineage(blocks(texts), "lm-blocks")
    counted = cut_lineage(
        blocked.select(F.explode(F.arrays_zip("words", "counts")).alias("x"))
        .select(F.col("x.words").alias("word"), F.col("x.counts").alias("c")).filter("c > 0")
        .groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    n_words, v_words = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_docs = blocked.select(F.coalesce(F.sum(F.expr("size(filter(trains, t -> t))")), F.lit(0))).first()[0]
    n_top = max(OUTPUTS - 2, counted.filter(F.col("c") >= MIN_COUNT).count())
    least = MIN_COUNT if n_top > OUTPUTS - 2 else 1
    ranked = cut_lineage(with_global_rank(counted.filter(F.col("c") >= least), [F.desc("c"), F.asc("word")], "place")
                         .filter(F.col("place") <= n_top), "lm-outputs")
    top = ranked.select("place", "word", "c").toArrow().sort_by("place").combine_chunks()  # a word and a number an output
    top_counts = top.column("c").to_numpy().astype(np.int64)
    outputs = pa.concat_arrays([pa.array([], pa.string()), *top.column("word").cast(pa.string()).chunks])
    total, distinct = n_words + n_docs, v_words + (1 if n_docs else 0)
    rest_total, rest_distinct = n_words - int(top_counts.sum()), v_words - len(top_counts)
    counts = np.zeros(max(OUTPUTS, len(top_counts) + 2), np.int64)
    counts[2:len(top_counts) + 2] = top_counts
    counts[END], counts[REST] = n_docs, rest_total
    numbered = cut_lineage(with_outputs(blocked, outputs), "lm-numbers")
    shared = spark.sparkContext.broadcast((train_on(numbered, counts), counts))

    # the words that are no outputs, a word once per block, meet their counts
    asked = numbered.select(F.col("block").alias("of_block"), F.posexplode("rest").alias("pos", "word"))
    answers = asked.join(counted, "word").select("of_block", "pos", "c")

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        lengths = np.array(left.column("rest_lengths")[0].as_py(), np.int64)
        local = np.frombuffer(left.column("rest_numbers")[0].as_py(), "<i4")
        c = np.zeros(left.column("n_rest")[0].as_py())
        c[right.column("pos").to_numpy()] = right.column("c").to_numpy()
        ends = np.cumsum(lengths)

        def by_text(x: np.ndarray) -> np.ndarray:
            return np.bincount(np.repeat(np.arange(len(lengths)), lengths), x[local], len(lengths)).astype(float)

        return pa.table({
            "of_block": np.full(len(ends), left.column("block")[0].as_py(), np.int64), "of_text": np.arange(len(ends), dtype=np.int32),
            "rest_known": by_text(c > 0).astype(np.int64),
            "rest_base": by_text(np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))),
            "share": by_text(np.log10((c + 0.5) / (rest_total + 0.5 * (rest_distinct + 1))))})

    placed = numbered.select("block", "rest_lengths", "rest_numbers", F.size("rest").alias("n_rest"))
    rest = placed.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(
        sums, "of_block long, of_text int, rest_known long, rest_base double, share double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = shared.value
        base = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))
        base[REST] = 0  # these words have counts of their own
        known = counts > 0
        known[REST] = False
        for batch in batches:
            for i in range(batch.num_rows):
                trains, lengths, numbers = texts_of_block(batch, i)
                starts = np.cumsum(lengths) - lengths
                scores = np.add.reduceat(model.log_probabilities(numbers, starts), starts)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, batch.column("block")[i].as_py(), np.int64)), pa.array(np.arange(n, dtype=np.int32)),
                    batch.column("ids").slice(i, 1).flatten(), pa.array(~trains), pa.array(lengths),
                    pa.array(np.add.reduceat(known[numbers].astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base[numbers], starts)), pa.array(scores / np.log(10))],
                    ["block", "at", "doc_id", "held_out", "n_tokens", "known", "base", "score"])

    scored = numbered.select("block", "ids", "trains", "lengths", "numbers").mapInArrow(
        run, "block long, at int, doc_id long, held_out boolean, n_tokens long, known long, base double, score double")
    return scored.join(rest, (F.col("block") == F.col("of_block")) & (F.col("at") == F.col("of_text"))).select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rest_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.col("rest_base")).alias("base_score"),
        (F.col("score") + F.col("share")).alias("score"))
