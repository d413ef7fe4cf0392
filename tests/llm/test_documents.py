"""Quality rules, near duplicates, toxicity and the language model on small tables."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martforge.llm import components, log_bilinear, near_dedup, quality_rules, toxicity
from martforge.llm.common import crc_mod, documents
from martforge.llm.queries import op1_quality_rules, op2_near_dedup, op3_toxicity, op5_log_bilinear, queries, vocabulary
from martforge.session import scratch_path

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
ROWS = [(1, "a b c d e f g h i j " * 5), (2, None), (3, ""), (4, LONG), (4, LONG), (None, "no key here at all"),
        (5, "a B c"), (6, "A b C"), (7, " \n\t "), (8, LONG + " tail"), (9, "a b c d"), (10, "ab c d")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "x", 1.5, [1], True) for i, t in rows],
                                 "doc_id long, text string, digest string, score double, bands array<int>, kept boolean")


# --- quality rules

def brute_repeats(words):
    w = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(w)
    return len({i + k for i, x in enumerate(w) if n[x] > 1 for k in range(8)})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_windows(words):
    assert quality_rules.measure(" ".join(words))["n_repeat_words"] == (brute_repeats(words) if len(words) > 8 else 0)


def test_quality_counts_and_posterior(spark):
    got = quality_rules.judge(frame(spark))
    assert got.count() == len(ROWS)
    for r in got.collect():
        words = ((dict(ROWS)[r.doc_id]) or "").encode().split()
        assert r.n_words == len(words) and r.word_chars == sum(len(w.decode()) for w in words)
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert quality_rules.judge(frame(spark).limit(0)).count() == 0
    kept = quality_rules.keep_good(frame(spark))
    assert kept.columns == frame(spark).columns and {r.doc_id for r in kept.collect()} == {4, 8}


def test_quality_keeps_a_long_clean_text(spark):
    rng = np.random.default_rng(6)
    words = np.array(["".join(x) for x in rng.choice(list("abcdefghijklmnop"), (20_000, 6))])
    share = 1 / np.arange(1, len(words) + 1)

    def text(n):
        return " ".join(rng.choice(words, n, p=share / share.sum()))

    long = text(500_000)
    assert quality_rules.measure(long)["sameness"] < 0.65
    assert quality_rules.measure("spam " * 500_000)["sameness"] > 0.99
    got = quality_rules.judge(frame(spark, [(i, text(1500)) for i in range(300)] + [(1000, long)])).collect()
    assert all(r.kept for r in got)


def test_quality_finds_labelled_junk(spark):
    labels = documents(spark, "/root/testdata/sf0.01", "labels")
    got = op1_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    junk = [r.kept for r in got if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.1


# --- near duplicates

def shingle_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    name = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(name[a], name[b])
            changed |= name[a] != m or name[b] != m
            name[a] = name[b] = m
    return sets, name


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.integers(0, len(out))] = f"e{rng.integers(0, 10**9)}"
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(12):  # groups of copies, near copies and chains at all distances
        base = [f"b{rng.integers(0, 10**9)}" for _ in range(int(rng.integers(3, 160)))]
        for k in range(14):
            rows.append((len(rows), " ".join(edited(rng, base, k // 2))))
            if k % 3 == 0:
                base = edited(rng, base, 1)
    sets, name = brute_components(rows)
    for r in near_dedup.near_duplicates(frame(spark, rows)).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), name[r.doc_id])


def test_members_of_open_buckets_meet_across_blocks(spark, monkeypatch):
    """Copies about the threshold, dealt over many blocks of a bucket and of a region."""
    monkeypatch.setattr(near_dedup, "BUCKET_ROWS", 7)
    monkeypatch.setattr(near_dedup, "BLOCK", 600)
    rng, met = np.random.default_rng(4), []
    region_links = near_dedup._region_links

    def watched(members):
        met.append(members.groupBy("region").count().agg({"count": "max"}).first()[0])
        return region_links(members)

    monkeypatch.setattr(near_dedup, "_region_links", watched)
    rows = []
    for g in range(2):
        base = [f"g{g}w{i}" for i in range(150)]
        for i in range(70):
            words = list(base)
            for j in rng.choice(150, 4, replace=False):
                words[j] = f"x{g}_{i}_{j}" if rng.random() < 0.5 else f"y{j}"
            rows.append((g * 1000 + i, " ".join(words)))
    _, name = brute_components(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == name
    assert len(set(name.values())) > 4 and met[0] > 20


def test_near_duplicates_edge_cases(spark):
    got = near_dedup.near_duplicates(frame(spark)).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert by[6].component_id == 5 and by[8].component_id == 4 and not by[8].kept
    assert by[2].n_shingles == by[3].n_shingles == by[7].n_shingles == 0
    assert by[2].kept and by[9].component_id == 9 and by[10].component_id == 10
    kept = near_dedup.keep_first(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 9, 10]
    assert near_dedup.near_duplicates(frame(spark).limit(0)).count() == 0


def test_one_row_of_a_group_stays_when_keys_repeat(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(2, a, "en"), (5, a, "en"), (5, b, "fr"), (5, b, "en"), (7, b, "en"), (5, b, "fr"), (None, b, "de"), (8, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [tuple(r) for n in (1, 7) for r in near_dedup.keep_first(docs.repartition(n)).collect()]
    half = sorted(got[:len(got) // 2], key=str)
    assert half == sorted(got[len(got) // 2:], key=str)  # whatever the partitions
    assert [(r[0], r[1]) for r in sorted(half, key=lambda r: (r[0] is None, r[0]))] == [(2, a), (5, b), (8, None), (None, b)]


def test_near_duplicates_of_the_tables(spark):
    rows = [tuple(r) for r in documents(spark, SF_SMALL).select("doc_id", "text").collect()]
    _, name = brute_components(rows)
    assert {r.doc_id: r.component_id for r in op2_near_dedup(spark, SF_SMALL).collect()} == name


def test_components_of_a_chain(spark):
    links = spark.range(1, 60).selectExpr("id as a", "id + 1 as b")
    got = components.components(links).collect()
    assert len(got) == 60 and {r.component for r in got} == {1}


# --- toxicity

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    step, start = rng.normal(size=(2, 2)), 0.3
    for n in (1, 2, 5):
        e = rng.normal(size=n)
        total, one = 0.0, np.zeros(n)
        for mask in range(1 << n):
            y = [(mask >> i) & 1 for i in range(n)]
            s = start * y[0] + sum(e[i] * y[i] for i in range(n)) + sum(step[y[i], y[i + 1]] for i in range(n - 1))
            total += math.exp(s)
            one += np.array(y) * math.exp(s)
        odds = toxicity._run(np.exp(e)[:, None], np.array([n]), start, step)[:, 0]
        assert np.allclose(odds / (1 + odds), one / total)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = documents(spark, sf, "labels")
    rows = op3_toxicity(spark, sf)
    assert rows.count() == documents(spark, sf).count()
    got = rows.filter("held_out").join(labels, "doc_id").collect()
    clean = [r.predicted for r in got if r.toxic == 0]
    toxic = [r.score for r in got if r.toxic == 1]
    assert np.mean(clean) < 0.05
    assert np.mean([t > np.median([r.score for r in got if r.toxic == 0]) for t in toxic]) > 0.8


def test_toxicity_edge_cases(spark):
    toxic, clean = ["you vile " + f"t{i} x y z" for i in range(40)], [f"all fine c{i} x y z" for i in range(200)]
    model = toxicity.train(toxic, clean)
    rows = {r.doc_id: r for r in toxicity.scores(frame(spark, ROWS + [(20, "é so vile, you")]), model).collect()}
    assert rows[20].predicted == 1 and rows[20].spans.split(",")[0].startswith("5:")
    assert rows[2].score == rows[3].score < 0.5
    assert toxicity.scores(frame(spark).limit(0), model).count() == 0
    nothing = toxicity.train([], clean)
    assert {r.score for r in toxicity.scores(frame(spark), nothing).collect()} == {0.0}
    assert toxicity.drop_toxic(frame(spark), model).columns == frame(spark).columns


# --- language model

def test_language_model_counts_and_sum(spark):
    got = {}
    for r in log_bilinear.score(frame(spark), crc_mod("doc_id", 5) != 1).collect():
        got[r.doc_id] = r
    train = [(i, t) for i, t in ROWS if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for _, t in train for w in (t or "").encode().lower().split())
    total, distinct = sum(c.values()) + len(train), len(c) + 1
    for i, t in dict(ROWS).items():
        words = (t or "").encode().lower().split()
        base = sum(math.log10((k + 0.5) / (total + 0.5 * (distinct + 1))) for k in [c[w] for w in words] + [len(train)])
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, sum(c[w] > 0 for w in words) + 1, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 1)
    assert log_bilinear.score(frame(spark).limit(0), crc_mod("doc_id", 5) != 1).count() == 0


def test_token_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    texts = [rng.integers(2, 20, 30) for _ in range(40)]
    model = log_bilinear.train(texts, epochs=1)
    before = np.array([3, 4, 5])
    each = [model.log_probabilities(np.r_[before, y], np.array([0]))[-1] for y in range(log_bilinear.OUTPUTS)]
    assert abs(np.exp(each).sum() - 1) < 1e-4


def test_language_model_beats_the_base_on_held_out(spark):
    rows = op5_log_bilinear(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_learns_from_long_texts_and_every_task(spark):
    # two kinds of texts of over 20,000 characters, each in its own partitions
    rows = [(i, " ".join(["one two three four", "five six seven eight"][i % 2] for _ in range(1500))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    got = log_bilinear.score(docs, F.lit(True)).collect()
    assert all(r.score / r.n_tokens > r.base_score / r.n_tokens + 0.4 for r in got)


def test_language_model_outputs_grow_with_the_counts(spark):
    # 600 words, each always followed by its own partner: more than the least number of outputs
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"a{x} b{x}" for x in rng.integers(0, 600, 400))) for i in range(200)]
    model = {}
    fit, log_bilinear.train_on = log_bilinear.train_on, lambda *a: model.setdefault("m", fit(*a))
    try:
        got = log_bilinear.score(frame(spark, rows), F.lit(True)).collect()
    finally:
        log_bilinear.train_on = fit
    m = model["m"]
    assert m.n == 1202 and m.bounds[-1] == 1202
    each = [m.log_probabilities(np.array([700, 5, y]), np.array([0]))[-1] for y in range(m.n)]
    assert abs(np.exp(each).sum() - 1) < 1e-4
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_shuffles_only_words_that_are_no_outputs(spark, monkeypatch):
    # 500 words met often, and words met once, in several blocks: every count by hand
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, 300)) + f" Once{i} once{i % 7}") for i in range(60)] + [(99, None)]
    monkeypatch.setattr(log_bilinear, "BLOCK_DOCS", 9)
    plans, cut = {}, log_bilinear.cut_lineage

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return cut(df, name)

    monkeypatch.setattr(log_bilinear, "cut_lineage", seen)
    got = {r.doc_id: r for r in log_bilinear.score(frame(spark, rows), F.col("doc_id") % 3 != 0).collect()}
    assert "Exchange" not in plans["lm-numbers"]
    split = {i: (t or "").encode().lower().split() for i, t in rows}
    c = Counter(w for i, ws in split.items() if i % 3 for w in ws)
    n_docs = sum(i % 3 != 0 for i in split)
    outputs = sorted(c, key=lambda w: (-c[w], w))[:max(log_bilinear.OUTPUTS - 2, sum(n >= log_bilinear.MIN_COUNT for n in c.values()))]
    assert len(outputs) > log_bilinear.OUTPUTS and len(c) > len(outputs) + 20
    total, distinct = sum(c.values()) + n_docs, len(c) + 1
    for i, words in split.items():
        base = sum(math.log10((n + 0.5) / (total + 0.5 * (distinct + 1))) for n in [c[w] for w in words] + [n_docs])
        assert (got[i].n_tokens, got[i].n_known) == (len(words) + 1, sum(c[w] > 0 for w in words) + 1)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and got[i].held_out == (i % 3 == 0)


def test_language_model_shares_noise_among_the_tokens_of_a_step():
    rng, drawn = np.random.default_rng(4), []

    class Counted:
        def random(self, size=None):
            drawn.append(np.prod(size or 1))
            return rng.random(size)

        def __getattr__(self, name):
            return getattr(rng, name)

    texts = [rng.zipf(1.3, 50) % 900 for _ in range(400)]
    model = log_bilinear.Model(np.bincount(np.concatenate(texts), minlength=900))
    before = model.log_probabilities(np.concatenate(texts), np.arange(400) * 50).sum()
    for epoch in range(2):
        model.learn(np.concatenate(texts), np.arange(400) * 50, epoch, Counted())
    assert sum(drawn) < 2 * 20_000 * log_bilinear.NOISE / 4  # 8 for each token and 200 for each step before
    assert model.log_probabilities(np.concatenate(texts), np.arange(400) * 50).sum() > before


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 18), max_size=60), st.integers(0, 40))
def test_sums_of_rows_by_key(keys, again):
    where = np.array(keys + keys[:1] * again + [7], np.int64)
    rows = np.random.default_rng(1).random((len(where), 3)).astype("f")
    order = log_bilinear._order(where)
    assert (where[order] == np.sort(where)).all()
    distinct, sums = log_bilinear._summed(where[order], rows[order])
    assert distinct.tolist() == sorted(set(where.tolist()))
    for k, s in zip(distinct, sums):
        assert np.allclose(s, rows[where == k].sum(0), rtol=1e-5)


def test_log_sums_of_large_scores():
    x = np.array([[100.0, 99.0, -300.0], [1.0, 2.0, 3.0]], "f")
    assert np.allclose(log_bilinear._log_sums(x.copy()), np.log(np.exp(x.astype(float)).sum(1)), rtol=1e-6)


def test_every_query_is_listed(spark):
    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 14)]


# --- the pipeline

def test_pipeline_on_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and keys, and clashing names
    go through the whole pipeline; what leaves is the packed ids of what a
    stage-by-stage run keeps."""
    import corpus_pipeline as c
    from tokenizers import Tokenizer
    folder = scratch_path(spark, "test-pipeline-odd")
    docs, labels = documents(spark, SF_SMALL), documents(spark, SF_SMALL, "labels")
    clean = docs.join(labels, "doc_id").filter("toxic = 0 and quality = 1").orderBy("doc_id").first()
    text = clean.text
    mine = [(9_000_001, None), (9_000_002, ""), (9_000_003, text + " write bob@mail.com"), (9_000_003, text + " write bob@mail.com"),
            (9_000_004, "odd " * 50_000), (None, None)]
    extra = spark.createDataFrame([(i, t) for i, t in mine], "doc_id long, text string")
    odd = docs.unionByName(extra, allowMissingColumns=True).selectExpr("*", "1 score", "'x' spans", "2 sequence_id", "3 kept")
    odd.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    left = documents(spark, folder)
    for name, stage in c.STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, left, folder).write.parquet(path)
        left = spark.read.parquet(path)
        assert left.columns == odd.columns
    kept = {r.doc_id: r.text for r in left.select("doc_id", "text").collect()}
    assert len(kept) == left.count() and not kept.keys() & {9_000_001, 9_000_002, 9_000_004, None}
    assert kept[clean.doc_id] and 9_000_003 not in kept  # a near copy of a document with a smaller key
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {k: len(t.encode(v or "", add_special_tokens=False).ids) + 1 for k, v in kept.items()}
    got, places = {}, {}
    for r in c.run(spark, folder).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for pieces in places.values():
        pieces.sort()
        assert [a for a, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 2048


def test_pipeline_stages(spark):
    import corpus_pipeline as c
    docs = documents(spark, SF_SMALL)
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
    rows = c.run(spark, SF_SMALL).collect()
    assert rows and sum(r.length for r in rows) > 0
    empty = documents(spark, SF_SMALL).limit(0)
    for name, stage in c.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
