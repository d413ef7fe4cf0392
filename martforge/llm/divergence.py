"""How far the word use of sources differs, within each language.

Terms are runs of letters and non-ASCII characters, A to Z lower-cased.  A
language keeps the terms of at least ``LEAST_DOCS`` of its documents (V of them).
Every group, a source in a language, and every language as a whole gives each kept term a
price p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the counts' sum; two prices
differ by f(p, q) = floor((p - q)^2 / (p + q)).  Part ``pair`` sums f over all kept
terms for every two sources of a language, part ``term`` ranks each group's
own terms priced above the language.

Counts are added up inside the reading tasks first, so a source with a third of the rows
is a few rows a term.  Kept terms are dealt to blocks of about BLOCK_ROWS counts; in a
block each group is one array of term numbers, ascending, and one of counts.
The pair tasks co-group the arrays of two tiles of sources in a block and take
the two groups of each unordered pair at a time: a galloping intersection finds
the terms that both have, those of one side only are priced against the other's
price of an absent term, and terms that neither has in the block are counted
by what is left of V.  f is symmetric, so one price serves both ways.  A block's part of
a pair is one row; nothing as long as a vocabulary meets in one task.

Arithmetic is exact: prices are divided digit by digit in 64 bits, or in
decimals.  Null text, language or source count as empty, which is a group of its
own; repeated rows count again; a group without terms has N = 0 and still meets
the others; a language with one source has no pairs; without kept terms every
pair is 0; equal values rank by item in byte order.  Only the three columns
named are read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import cut_lineage

LEAST_DOCS = 10
TERMS_RANKED = 10
SCALE = 1_000_000_000
BLOCK_ROWS = 200_000  # counts in a block, about
TILE = 32  # sources whose arrays a pair task holds, twice
HELD = 300_000  # counts that a reading task adds up before it sends them

# letters as lower case, other ASCII as spaces, the rest as it is
TERM_BYTES = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def _sums(held: dict) -> pa.RecordBatch:
    keys = [(group, term) for group, (n, _) in held.items() for term in n]
    return pa.RecordBatch.from_arrays(
        [pa.array([g[0] for g, _ in keys], pa.string()), pa.array([g[1] for g, _ in keys], pa.string()),
         pa.array([t for _, t in keys], pa.binary()).cast(pa.string()),
         pa.array([held[g][0][t] for g, t in keys], pa.int64()), pa.array([held[g][1][t] for g, t in keys], pa.int64())],
        ["lang", "source", "term", "n", "docs"])


def term_counts(groups: DataFrame) -> DataFrame:
    """lang, source, term, n, docs as far as a task has added them up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (lang, source) not in held:
                    held[lang, source] = Counter(), Counter()
                n, docs = held[lang, source]
                found = terms(text.as_py())
                before = len(n)
                n.update(found)
                docs.update(set(found))
                size += len(n) - before
                if size > HELD:
                    yield _sums(held)
                    held, size = {}, 0
        yield _sums(held)

    return (groups.withColumn("text", F.col("text").cast("binary"))
            .mapInArrow(run, "lang string, source string, term string, n long, docs long"))


def kept_counts(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, all_n (of the language), one (a single row of the
    term is marked) for the terms of at least ``least`` documents.  One shuffle, by
    language and term."""
    summed = (counts.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")
    return (summed.withColumn("all_docs", F.sum("docs").over(term)).withColumn("all_n", F.sum("n").over(term))
            .withColumn("one", F.col("source") == F.min("source").over(term))
            .filter(F.col("all_docs") >= least).select("lang", "source", "term", "n", "all_n", "one"))


def price(count: Column, total: Column, v: Column) -> Column:
    wide = "decimal(20,0)"
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast(wide)
    return 1 + F.call_function("div", top, (total + 2 * v).cast(wide))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


# --- inside the pair tasks

def prices(count: np.ndarray, total: int, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 v)), three digits at a time, which
    stays within 64 bits as long as the total is below 9 * 10^15."""
    d = max(total + 2 * v, 1)
    out, rest = np.divmod(np.asarray(count, np.int64) + 2, d)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, d)
        out = out * 1000 + more
    return out + 1


def differ(p, q):
    return (p - q) * (p - q) // (p + q)


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of ``few`` the place in ``many`` of the first not smaller; both
    ascend.  Every 64th is looked up; from there the others step on by 1, 2, 4, ...
    until they have passed their value, then halve the last step."""
    if not len(few) or not len(many):
        return np.zeros(len(few), np.int64)

    def below(at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (at < len(many)) & (many[np.minimum(at, len(many) - 1)] < x)

    low = np.repeat(np.searchsorted(many, few[::64]), 64)[:len(few)] - 1  # many[low] < few
    step = np.ones(len(few), np.int64)
    going = np.arange(len(few))
    while len(going):
        going = going[below(low[going] + step[going], few[going])]
        low[going] += step[going]
        step[going] *= 2
    step //= 2
    while step.any():
        low += np.where((step > 0) & below(low + step, few), step, 0)
        step //= 2
    return low + 1


class Side:
    """One group in a block: term numbers, their prices, the price of an absent term."""

    def __init__(self, source: str, total: int, v: int, ids: np.ndarray, counts: np.ndarray) -> None:
        self.source, self.ids = source, ids
        self.p = prices(counts, total, v)
        self.absent = int(prices(np.zeros(1, np.int64), total, v)[0])


def pair_price(a: Side, b: Side) -> tuple[int, int]:
    """Sum of f over the terms that either has, and their number."""
    if len(a.ids) > len(b.ids):
        a, b = b, a
    at = gallop(a.ids, b.ids)
    both = np.flatnonzero((at < len(b.ids)) & (b.ids[np.minimum(at, len(b.ids) - 1)] == a.ids)) if len(b.ids) else at[:0]
    at = at[both]
    only_a, only_b = differ(a.p, b.absent), differ(b.p, a.absent)
    total = differ(a.p[both], b.p[at]).sum() + only_a.sum() - only_a[both].sum() + only_b.sum() - only_b[at].sum()
    return int(total), len(a.ids) + len(b.ids) - len(both)


PRICED = "lang string, a string, b string, v long, absent_a long, absent_b long, priced long, n_priced long"


def _pair_task(left: pa.Table, right: pa.Table) -> pa.Table:
    def sides(t: pa.Table) -> list[Side]:
        return [Side(r["source"], r["total"], r["v"], np.array(r["ids"] or [], np.int64), np.array(r["counts"] or [], np.int64))
                for r in t.select(["source", "total", "v", "ids", "counts"]).to_pylist()]

    out = []
    if left.num_rows and right.num_rows:
        lang, v = left.column("lang")[0].as_py(), left.column("v")[0].as_py()
        same = left.column("tile")[0].as_py() == left.column("other")[0].as_py()
        mine = sides(left)
        for b in (mine if same else sides(right)):
            for a in mine:
                if a.source < b.source or not same:
                    out.append((lang, a.source, b.source, v, a.absent, b.absent, *pair_price(a, b)))
    names = ["lang", "a", "b", "v", "absent_a", "absent_b", "priced", "n_priced"]
    kinds = [pa.string()] * 3 + [pa.int64()] * 5
    columns = list(zip(*out)) or [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value for each unordered pair of sources of a language.
    ``groups``: lang, source, total, v, blocks, tile, tiles."""
    lang = groups.groupBy("lang").agg(F.max("blocks").alias("blocks"))
    in_block = kept.join(lang, "lang").withColumn("block", F.expr("pmod(xxhash64(term), blocks)"))
    number = F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term")).cast("long")
    arrays = (in_block.withColumn("id", number).groupBy("lang", "block", "source")
              .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("own")))
    every = groups.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = cut_lineage(every.join(arrays, ["lang", "block", "source"], "left").select(
        "lang", "block", "source", "total", "v", "tile", "tiles", F.col("own.id").alias("ids"), F.col("own.n").alias("counts")),
        "term-arrays")
    # the lower tile of a task comes from the left, the upper one from the right
    left = rows.withColumn("other", F.explode(F.expr("sequence(tile, tiles - 1)"))).withColumn("low", F.col("tile")).withColumn("high", F.col("other"))
    right = rows.withColumn("other", F.explode(F.expr("sequence(0L, tile)"))).withColumn("low", F.col("other")).withColumn("high", F.col("tile"))
    key = ["lang", "block", "low", "high"]
    priced = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_pair_task, PRICED)
    return (priced.groupBy("lang", "a", "b").agg(
        F.sum("priced").alias("priced"), F.sum("n_priced").alias("n_priced"),
        *[F.first(c).alias(c) for c in ("v", "absent_a", "absent_b")])
        .select("lang", "a", "b", (F.col("priced") + (F.col("v") - F.col("n_priced")) * divergence(
            F.col("absent_a"), F.col("absent_b"))).alias("value")))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS,
          ranked: int = TERMS_RANKED) -> DataFrame:
    """lang, source, part, item, value, rank."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = cut_lineage(kept_counts(term_counts(named), least), "term-counts")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("one").cast("long")).alias("v"),
                                     F.count(F.lit(1)).alias("rows"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    groups = cut_lineage(
        named.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("lang_total", zero).alias("lang_total"),
                F.coalesce("v", zero).alias("v"), F.expr(f"coalesce(rows, 0L) div {BLOCK_ROWS} + 1").alias("blocks"),
                F.floor((place - 1) / TILE).alias("tile"))
        .withColumn("tiles", F.max("tile").over(Window.partitionBy("lang")) + 1), "groups")

    pairs = pair_values(kept, groups)
    both = pairs.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way"), "value")
    pair_part = both.select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    priced = kept.join(groups.select("lang", "source", "total", "lang_total", "v"), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), price(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        price(F.col("all_n"), F.col("lang_total"), F.col("v")).alias("q"))
    term_part = priced.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order).cast("int")
    return pair_part.withColumn("rank", rank).unionByName(
        term_part.withColumn("rank", rank).filter(F.col("rank") <= ranked))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs
), kept AS (SELECT lang, term, count(*) AS all_n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 10
), langs AS (SELECT lang, count(*) AS v, sum(all_n) AS lang_total FROM kept GROUP BY ALL
), counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(l.lang_total, 0) AS lang_total,
    coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l USING (lang)
), grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (k.all_n + 2)) // (g.lang_total + 2 * g.v))::BIGINT AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM grid WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""
