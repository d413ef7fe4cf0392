"""Phrase collocations from a weighted de Bruijn graph.

Texts are lower-cased (A to Z only), split into pieces at ``. , ; : ! ?`` and
line ends, and pieces into words at spaces and tabs.  The edges of the graph are
the four-word grams of the pieces, weighted by their occurrences; an edge runs
from the node of its first three words to that of its last three.  Nothing
shorter is counted by itself: a gram occurs once for each of its continuations
and once for each place where a piece ends behind it, so the count of a node is
the weight of its outgoing edges plus its ends, that of two words the sum over
nodes that begin with them plus ends, and that of one word likewise.

Only phrases met ``least`` times matter, and a part of such a phrase is met as
often.  A first pass therefore adds the occurrences of words, pairs and triples
up in a table of 2^FILTER_BITS counters.  A gram with a part whose counter stays
below ``least`` is certainly rare.  The second pass reads from each word on the
longest gram, of four words at most, that may be frequent; where the next word makes it rare
it ends like at the end of a piece.  Every occurrence of a frequent gram thus
begins exactly one longer or equal gram, and the sums above are exact.  Counters
may be shared, which lets rare grams through but never stops a frequent one:
results do not depend on the size of the table, which is fixed (8 MB of bits reach
the driver and the tasks; a counting task holds 64 MB).

Unary paths of frequent edges are compacted: a node with one edge in, one out,
the same weight on both and no end passes everything on, so
its edges merge.  Paths are ranked by pointer doubling, in as many rounds as the
logarithm of the longest; edges on a pure cycle stay single.  A merged node lies
inside a phrase of the same count, so only the other nodes are scored.

A phrase of two to four words is scored at each cut by floor(2000000 a / (l + r)),
with the counts of the phrase and the two parts; its least cut counts, of equal
ones the first.  A phrase inside a longer frequent phrase with at least 80 percent of
its count is dropped.

Null or empty texts have no words; a null language is ``und``.  Repeated rows
count again, ties go by phrase in byte order, long texts are read in one go,
and only the two columns named are read.  An empty table, or one without any phrase met
``least`` times, gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import cut_lineage

LONGEST = 4  # words of a gram; nodes have one less
LEAST = 30
INSIDE = 80  # percent of a phrase's count at which a longer one replaces it
TOP = 2000
FILTER_BITS = 26
SLICE_BITS = 16  # counters are summed in slices of this many
CHUNK = 4 << 20  # bytes of text that are counted together

END = b"\xff"  # stands for the end of a piece; no byte of UTF-8
FOLD = bytes(0xFF if chr(i) in ".,;:!?\n\x0b\x0c\r" else i for i in range(256)).lower()


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the words of all texts, 0 at the end of each piece, and the
    words by number.  The last piece is ended too."""
    words = END.join(texts).translate(FOLD).replace(END, b" \xff ").split() + [END]
    number = {END: 0}
    number.update((w, i) for i, w in enumerate((w for w in dict.fromkeys(words) if w != END), 1))
    return np.fromiter(map(number.__getitem__, words), np.int32, len(words)), list(number)


def buckets(ids: np.ndarray, words: list[bytes], lang: str, n_bits: int) -> list[np.ndarray]:
    """Counters of the word, the pair and the triple that begin at each place, as
    int32; -1 where a piece ends before."""
    shift = np.uint64(64 - n_bits)
    h = _mix(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) + np.uint64(zlib.crc32(lang.encode())))
    at, ended, out = h[ids], ids == 0, []
    gram, over = at, ended
    for k in range(LONGEST - 1):
        if k:  # one more word; behind the last place everything has ended
            with np.errstate(over="ignore"):
                gram = _mix(gram * np.uint64(0x9E3779B97F4A7C15) + np.append(at[k:], np.zeros(k, np.uint64)))
            over = over | np.append(ended[k:], np.ones(k, bool))
        counter = (gram >> shift).astype(np.int32)
        counter[over] = -1
        out.append(counter)
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about CHUNK bytes at a time."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held[lang].append(text.as_py())
            size += len(held[lang][-1])
            if size > CHUNK:
                yield from held.items()
                held, size = defaultdict(list), 0
    yield from held.items()


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.filter(F.length(text) > 0).select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("string").cast("binary").alias("text"))


def frequent_bits(texts: DataFrame, least: int, n_bits: int = FILTER_BITS) -> np.ndarray:
    """One bit for each counter that reaches ``least``.

    Each task sends the counters that it touched, slice by slice; slices are summed
    as they stream in."""
    small = np.dtype("u1" if least <= 255 else "<u4")  # counters stop at its largest number
    cap = np.iinfo(small).max

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << n_bits, small)
        for lang, chunk in _chunks(batches):
            for b in buckets(*tokens(chunk), lang, n_bits):
                at, n = np.unique(b[b >= 0], return_counts=True)
                seen[at] = np.minimum(seen[at].astype(np.int64) + n, cap)
        rows: dict[str, list] = {"slice": [], "at": [], "n": []}
        for i, part in enumerate(seen.reshape(-1, 1 << SLICE_BITS)):
            at = np.flatnonzero(part)
            if len(at):
                rows["slice"].append(i)
                rows["at"].append(at.astype("<u2").tobytes())
                rows["n"].append(part[at].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows["slice"], pa.int32()), pa.array(rows["at"], pa.binary()),
                                          pa.array(rows["n"], pa.binary())], ["slice", "at", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(1 << SLICE_BITS, np.int64))
        for batch in batches:
            for i, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                total[i][np.frombuffer(at, "<u2")] += np.frombuffer(n, small)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.packbits(t >= least, bitorder="little").tobytes() for t in total.values()], pa.binary())],
            ["slice", "bits"])

    sums = (texts.mapInArrow(count, "slice int, at binary, n binary").repartition("slice")
            .mapInArrow(add, "slice int, bits binary"))
    out = np.zeros((1 << (n_bits - SLICE_BITS), 1 << (SLICE_BITS - 3)), np.uint8)
    for row in sums.collect():  # one row a slice, a bit for each counter
        out[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _grouped(ids: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of each distinct gram of k words among those at ``at``."""
    rows = np.stack([ids[at + i] for i in range(k)])
    key = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for r in rows:
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + r.astype(np.uint64) + np.uint64(1))
    _, first, of, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    if (rows != rows[:, first[of]]).any():  # two grams of one hash
        _, first, n = np.unique(rows, axis=1, return_index=True, return_counts=True)
    return at[first], n


def longest(ids: np.ndarray, words: list[bytes], lang: str, bits: np.ndarray) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """The longest gram from each place on that may be frequent, as (k, grams,
    counts): edges (k = 4) and ends (k = 1 to 3).  Certainly rare words are left out."""
    one, two, three = (
        (b >= 0) & ((bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)
        for b in buckets(ids, words, lang, (len(bits) * 8).bit_length() - 1))
    three &= two & np.append(two[1:], False)
    four = three & np.append(three[1:], False)
    for k, at in ((1, one & ~two), (2, two & ~three), (3, three & ~four), (4, four)):
        at = np.flatnonzero(at)
        if len(at):
            first, n = _grouped(ids, at, k)
            grams = [b" ".join([words[j] for j in g]) for g in np.stack([ids[first + i] for i in range(k)], 1).tolist()]
            yield k, grams, n


def grams(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """lang, k, gram, n: edges (k = 4), ends (k = 1 to 3) and, with k = 0, all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _chunks(batches):
            ids, words = tokens(chunk)
            for k, found, n in [(0, [b""], np.array([(ids > 0).sum()])), *longest(ids, words, lang, bits)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array([k] * len(found), pa.int32()),
                     pa.array(found, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["lang", "k", "gram", "n"])

    return (texts.mapInArrow(run, "lang string, k int, gram string, n long")
            .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")))


def _first(gram: str, words: int) -> Column:
    return F.substring_index(gram, " ", words)


def graph(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (lang, gram, source, target, n) and nodes (lang, gram, n, passes) of
    the counted grams; ``passes`` marks nodes inside a unary path."""
    edges = counted.filter(f"k = {LONGEST}").select(
        "lang", "gram", _first("gram", LONGEST - 1).alias("source"), _first("gram", 1 - LONGEST).alias("target"), "n")
    zero = F.lit(0).cast("long")

    def side(df: DataFrame, name: str, **given: Column) -> DataFrame:
        return df.select("lang", F.col(name).alias("gram"), *[given.get(c, zero).alias(c) for c in
                                                             ("outs", "out_n", "ins", "in_n", "ends")])

    one, n = F.lit(1).cast("long"), F.col("n")
    around = (side(edges, "source", outs=one, out_n=n).unionByName(side(edges, "target", ins=one, in_n=n))
              .unionByName(side(counted.filter(f"k = {LONGEST - 1}"), "gram", ends=n)))
    sums = around.groupBy("lang", "gram").agg(*[F.sum(c).alias(c) for c in ("outs", "out_n", "ins", "in_n", "ends")])
    nodes = sums.select("lang", "gram", (F.col("out_n") + F.col("ends")).alias("n"),
                        F.expr("outs = 1 and ins = 1 and ends = 0 and out_n = in_n").alias("passes"))
    return edges, nodes


def unary_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """lang, path (words), n: edges merged over the nodes that pass everything on.

    Every edge points at the one before it; pointers double until they reach the
    head of the path.  A round that finishes no edge leaves only cycles."""
    inner = nodes.filter("passes").select("lang", F.col("gram").alias("source"))
    before = edges.select("lang", F.col("target").alias("source"), F.col("gram").alias("at")).join(
        inner, ["lang", "source"])
    state = cut_lineage(edges.join(before, ["lang", "source"], "left").select(
        "lang", "gram", "n", F.coalesce("at", "gram").alias("at"),
        F.when(F.col("at").isNull(), 0).otherwise(1).cast("long").alias("far"), F.col("at").isNull().alias("done")), "paths")
    todo = state.filter("not done").count()
    while todo:
        jump = state.select("lang", F.col("gram").alias("at"), F.col("at").alias("next"),
                            F.col("far").alias("more"), F.col("done").alias("over"))
        state = cut_lineage(state.filter("done").unionByName(
            state.filter("not done").join(jump, ["lang", "at"]).select(
                "lang", "gram", "n", F.col("next").alias("at"), (F.col("far") + F.col("more")).alias("far"),
                F.col("over").alias("done"))), "paths")
        left = state.filter("not done").count()
        if left == todo:
            break
        todo = left
    head = F.when(F.col("done"), F.col("at")).otherwise(F.col("gram"))  # on a cycle an edge is its own path
    steps = F.sort_array(F.collect_list(F.struct("far", F.substring_index("gram", " ", -1).alias("word"))))
    return (state.withColumn("head", head).withColumn("far", F.when(F.col("done"), F.col("far")).otherwise(0))
            .groupBy("lang", "head").agg(F.max("n").alias("n"), steps.alias("steps"))
            .select("lang", F.concat(F.split("head", " "), F.expr("transform(slice(steps, 2, size(steps)), s -> s.word)")).alias("path"), "n"))


def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """phrases (lang, phrase, k, a) with the l, r and score of their least cut."""
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("left"), F.expr("substring_index(phrase, ' ', cut - k)").alias("right"))
    left, right = (counts.select("lang", F.col("gram").alias(s), F.col("n").alias(c)) for s, c in (("left", "l"), ("right", "r")))
    score = F.expr("cast(cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    return (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
            .groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least"))
            .select("lang", "phrase", "a", "least.l", "least.r", "least.score"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, inside: int = INSIDE,
                 top: int = TOP, n_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases."""
    texts = _texts(docs, text, lang)
    counted = cut_lineage(grams(texts, frequent_bits(texts, least, n_bits)), "grams")
    edges, nodes = graph(counted)
    nodes = cut_lineage(nodes, "nodes")
    heavy = edges.filter(F.col("n") >= least)
    paths = unary_paths(heavy, nodes.filter(F.col("n") >= least))
    windows = F.expr(f"transform(sequence(0, size(path) - {LONGEST}), i -> array_join(slice(path, i + 1, {LONGEST}), ' '))")

    # counts of shorter grams by flow: continuations plus ends
    def shorter(longer: DataFrame, k: int) -> DataFrame:
        return (longer.select("lang", _first("gram", k).alias("gram"), "n")
                .unionByName(counted.filter(f"k = {k}").select("lang", "gram", "n"))
                .groupBy("lang", "gram").agg(F.sum("n").alias("n")))

    pairs = cut_lineage(shorter(nodes, 2), "pairs")
    words = shorter(pairs, 1)
    counts = cut_lineage(
        paths.select("lang", F.explode(windows).alias("gram"), "n", F.lit(4).alias("k"), F.lit(False).alias("passes"))
        .unionByName(nodes.select("lang", "gram", "n", F.lit(3).alias("k"), "passes"))
        .unionByName(pairs.select("lang", "gram", "n", F.lit(2).alias("k"), F.lit(False).alias("passes")))
        .unionByName(words.select("lang", "gram", "n", F.lit(1).alias("k"), F.lit(False).alias("passes")))
        .filter(F.col("n") >= least), "counts")

    phrases = counts.filter("k > 1 and not passes").select("lang", F.col("gram").alias("phrase"), "k", F.col("n").alias("a"))
    parts = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1),"
                   " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")
    longer = (phrases.filter("k > 2").select("lang", F.explode(parts).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    free = phrases.join(longer, ["lang", "phrase"], "left").filter(
        f"most is null or cast(100 as decimal(3,0)) * cast(most as decimal(20,0)) < cast({inside} as decimal(3,0)) * cast(a as decimal(20,0))").drop("most")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = (_scored(free, counts).withColumn("rank", F.row_number().over(order).cast("long"))
            .filter(F.col("rank") <= top))
    total = counted.filter("k = 0").select("lang", F.col("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, piece FROM (
    SELECT lang, unnest(string_split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?' || chr(11) || chr(12) || chr(13) || chr(9),
      'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 9) || ' '), chr(10))) AS piece FROM documents WHERE text IS NOT NULL)
), split AS (
  SELECT lang, p, list_filter(string_split(piece, ' '), lambda x: x <> '') AS w FROM pieces
), words AS (
  SELECT lang, p, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0
), placed AS (
  SELECT lang, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c, lead(w, 3) OVER o AS d
  FROM words WINDOW o AS (PARTITION BY lang, p ORDER BY i)
), grams AS (
  SELECT lang, 1 AS k, a AS g, count(*) AS f FROM placed GROUP BY ALL
  UNION ALL SELECT lang, 2, a || ' ' || b, count(*) FROM placed WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c, count(*) FROM placed WHERE c IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d, count(*) FROM placed WHERE d IS NOT NULL GROUP BY ALL
), many AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM grams WHERE f >= 30
), covered AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS g, max(f) AS most
  FROM many, (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) AS t(m, s) WHERE k > 2 AND m < k AND s + m - 1 <= k GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, c.cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM (SELECT *, array_to_string(w[1:cut], ' ') AS gl, array_to_string(w[cut + 1:], ' ') AS gr
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM many)) c
  JOIN many l ON l.lang = c.lang AND l.g = c.gl
  JOIN many r ON r.lang = c.lang AND r.g = c.gr
  LEFT JOIN covered v ON v.lang = c.lang AND v.g = c.g
  WHERE c.k > 1 AND (v.most IS NULL OR 100::HUGEINT * v.most < 80::HUGEINT * c.f)
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM lowest
), total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang)
SELECT lang, rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
