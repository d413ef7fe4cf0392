"""Secrets in texts, found by way of a trigram index, in DataFrame functions only.

Each rule is a regular expression.  From its parse tree a Boolean query of
trigrams is derived: every match must hold all trigrams of one of the query's
clauses (texts and trigrams in lower case, so that case never loses a match).
The index keeps, for every trigram that some rule asks for, the texts that hold
it: posting lists of text hashes in ascending order, dealt to segments of about
SEGMENT texts by the hash, so that equal texts are one posting and no list grows with
the input.  A query intersects the lists of each clause and unites the clauses,
segment by segment.  Candidates are then verified: the rule's expression runs on
their whole texts, and on no others.  A rule without mandatory trigrams (the
hexadecimal runs) scans all texts.

Candidates meet the texts again by text hash.  Spark broadcasts them if their
written table is below the session's threshold; beyond it both sides are
shuffled once, and a hash held by many copies is split by adaptive execution.

A span is where a match of the rule lies, in code points, end exclusive; matches of a rule
are leftmost, do not overlap, and those that are too short are dropped without
another try.  Null texts count as empty; empty texts have no span; repeated rows
give repeated results; texts are read whole; other columns, whatever their
names, play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.session import cut_lineage

SEGMENT = 8192  # texts in a segment of the index, about
SPELLINGS = 64  # a part of an expression with more spellings than this has no mandatory trigrams


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read alike by Java and Python.  A match counts if its group
    ``measured`` has ``least`` characters."""
    kind: str
    pattern: str
    least: int = 0
    measured: int = 0


# fixed values: the three kinds asked for, then common shapes of keys
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("url_login", r"://[^\s/:@]+:[^\s/:@]+@[A-Za-z0-9]"),  # a long run in front would be tried at each letter
)


# --- from an expression to its query

Query = frozenset  # of clauses, each a frozenset of trigrams; any clause will do
ANY: Query = frozenset([frozenset()])


def _all_of(a: Query, b: Query) -> Query:
    """Both queries.  Of too many clauses the longer query is kept alone, which asks for less."""
    both = frozenset(x | y for x in a for y in b)
    both = frozenset(x for x in both if not any(y < x for y in both))
    return both if len(both) <= SPELLINGS else max(a, b, key=lambda q: min(map(len, q)))


def _grams(spellings: set[str]) -> Query:
    """Clauses of the trigrams in each spelling."""
    out = frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in spellings)
    return frozenset(x for x in out if not any(y < x for y in out))


def _spellings(op, arg) -> set[str] | None:
    """All lower-case spellings of one part of an expression, None if there are too many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        found: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                found.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < SPELLINGS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:  # negations and classes
                return None
        return found if len(found) <= 8 else None
    if name == "SUBPATTERN":
        return _sequence(arg[-1])
    if name == "BRANCH":
        parts = [_sequence(x) for x in arg[1]]
        return None if None in parts else _few(set().union(*parts))
    if name in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, what = arg
        one = _sequence(what)
        if one is None or high > 4:
            return None
        out, now = set(), {""}
        for n in range(high + 1):
            out |= now if n >= low else set()
            now = {x + y for x in now for y in one}
        return _few(out)
    return None


def _few(spellings: set[str]) -> set[str] | None:
    return spellings if len(spellings) <= SPELLINGS else None


def _sequence(parts) -> set[str] | None:
    out: set[str] | None = {""}
    for op, arg in parts:
        more = _spellings(op, arg)
        out = None if out is None or more is None else _few({x + y for x in out for y in more})
    return out


def _query(parts) -> Query:
    out, open_ = ANY, {""}  # what is asked for so far; the spellings that end here
    for op, arg in parts:
        more = _spellings(op, arg)
        joined = None if more is None else _few({x + y for x in open_ for y in more})
        if joined is not None:
            open_ = joined
            continue
        out, open_ = _all_of(out, _grams(open_)), more or {""}
        name = str(op)
        if more is None and name == "SUBPATTERN":
            out = _all_of(out, _query(arg[-1]))
        elif more is None and name == "BRANCH":
            out = _all_of(out, frozenset().union(*[_query(x) for x in arg[1]]))
        elif more is None and name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
            out = _all_of(out, _query(arg[2]))
    return _all_of(out, _grams(open_))


def trigram_query(pattern: str) -> Query:
    """The clauses of mandatory trigrams of an expression; ``ANY`` if it has none."""
    out = _query(re._parser.parse(pattern))
    return ANY if frozenset() in out else out


# --- the index

def text_key(text: str = "text") -> Column:
    return F.xxhash64(text)


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """segment, gram, keys: ascending text hashes of each segment that hold the trigram."""
    segments = max(1, -(-texts.count() // SEGMENT))
    low = texts.select(text_key().alias("key"), F.lower("text").alias("low"))
    tests = ", ".join("if(contains(low, '{0}'), '{0}', null)".format(g.replace("\\", "\\\\").replace("'", "\\'")) for g in trigrams)
    held = F.expr(f"filter(array({tests}), g -> g is not null)")
    met = low.select("key", F.explode(held).alias("gram"))
    return (met.groupBy(F.pmod("key", F.lit(segments)).alias("segment"), "gram")
            .agg(F.sort_array(F.collect_set("key")).alias("keys")))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """key, kinds: the rules whose query the text with that hash answers."""
    lists = index.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def answer(query: Query) -> Column:
        clauses = [reduce(F.array_intersect, [F.coalesce(F.col("lists")[g], none) for g in sorted(c)])
                   for c in sorted(query, key=sorted)]
        return reduce(F.array_union, clauses)

    found = lists.select(F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), answer(q).alias("keys")) for kind, q in queries.items()])).alias("f"))
    return (found.select("f.kind", F.explode("f.keys").alias("key"))
            .groupBy("key").agg(F.sort_array(F.collect_list("kind")).alias("kinds")))


# --- verification

def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of the rule's matches: array of (start, order, kind, stop).

    The pieces between matches and the matches add up to the places of the matches."""
    pattern = rule.pattern
    if pattern == r"[0-9a-f]+":  # a run is matched whole, so that short ones need not be listed
        pattern = rf"[0-9a-f]{{{rule.least},}}"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(whole, F.char_length)
    measured = sizes if not rule.measured else F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.measured)), F.char_length)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    steps = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), measured.alias("measured"))
    kind = "array<struct<start:int,order:int,kind:string,stop:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def add(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        stop = begin + F.coalesce(s["size"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), stop.alias("stop"))
        good = F.coalesce(s["measured"] >= max(rule.least, 1), F.lit(False))
        return F.struct(stop.alias("at"), F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(steps, start, add)["spans"]).otherwise(F.array().cast(kind))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, spans (array of start, order, kind, stop, ordered), one row per row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ANY}
    trigrams = sorted(set().union(*[c for q in indexed.values() for c in q]))
    index = cut_lineage(postings(texts, trigrams), "trigram-index")
    found = cut_lineage(candidates(index, indexed), "candidates")
    rows = texts.withColumn("key", text_key()).join(found, "key", "left")
    none = F.array().cast("array<struct<start:int,order:int,kind:string,stop:int>>")
    spans = [F.when(F.array_contains("kinds", r.kind), rule_spans(F.col("text"), r, i)).otherwise(none)
             if r.kind in indexed else rule_spans(F.col("text"), r, i) for i, r in enumerate(rules)]
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["order"] < len(BASE))
    return found.select("doc_id", *[of(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def _oracle() -> str:
    def one(i: int, r: Rule) -> str:
        p = "'" + r.pattern.replace("'", "''") + "'"
        return (f"SELECT r, {i} AS o, '{r.kind}' AS kind, {max(r.least, 1)} AS least, regexp_extract_all(text, {p}) AS hit, "
                f"regexp_extract_all(text, {p}, {r.measured}) AS part, string_split_regex(text, {p}) AS gap FROM texts")

    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), matched AS ({' UNION ALL '.join(one(i, r) for i, r in enumerate(BASE + MORE))}
), hits AS (
  SELECT r, o, kind, least, unnest(hit) AS hit, unnest(part) AS part, unnest(gap[1:len(hit)]) AS gap,
    unnest(range(1, len(hit) + 1)) AS i FROM matched WHERE len(hit) > 0
), placed AS (
  SELECT *, (sum(length(gap) + length(hit)) OVER (PARTITION BY r, o ORDER BY i))::BIGINT AS stop FROM hits
), spans AS (
  SELECT r, o, kind, stop - length(hit) AS start, kind || ':' || (stop - length(hit)) || ':' || stop AS span
  FROM placed WHERE length(part) >= least
), joined AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, o) FILTER (o < 3) AS base, string_agg(span, ',' ORDER BY start, o) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (r)
"""


ORACLE = _oracle()
