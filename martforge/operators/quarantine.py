"""Quarantine: good rows go on, bad rows go to a table of rejects, and so do
the children of rejected parents.

Every table has a row key (``ROW``, given by the caller or numbered here) that
names a row even where its own key is null or repeated.  Rules are of two kinds:

* row rules and uniqueness, judged once.  Of rows that share a unique value the
  first in the order of all columns stays;
* references.  A child whose value is not null and not among the *kept* rows
  of its parent is rejected, which may in turn orphan its own children.  The first
  round compares all values with all keys, each later one only the keys that the
  round before took away.  Rounds go on until one rejects nothing; a
  self-reference takes a round for each level below a rejected row.

What is written after each round is only keys: (table, row, reason, round).
Kept rows are the input without the rejected keys, so kept and rejected rows add up to
the input.  A reference that the caller marks ``warn`` rejects nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.quality import ERROR, Check
from martforge.session import cut_lineage

ROW = "_mf_row"
REJECT_COLUMNS = ["table_name", ROW, "reason", "round"]


@dataclass
class Quarantine:
    kept: dict[str, DataFrame]
    rejects: DataFrame       # table_name, ROW, reason, round; a row rejected for several reasons has several
    rounds: int              # of references that rejected something


def with_rows(df: DataFrame) -> DataFrame:
    """The table with a key for each row, fixed by writing it once."""
    if ROW in df.columns:
        return df
    return cut_lineage(df.withColumn(ROW, F.monotonically_increasing_id()), "quarantine-rows")


def _bad_rows(df: DataFrame, check: Check):
    c = F.col(check.column)
    return {
        "not_null": lambda: c.isNull(),
        "non_negative": lambda: c < 0,
        "accepted_values": lambda: ~c.isin(*check.values),
        "expression": lambda: ~F.expr(check.condition),
    }[check.test]()


def _row_rules(checks: Sequence[Check]) -> list[Check]:
    return [c for c in checks if c.test not in ("unique", "relationships")]


def _own_rejects(name: str, df: DataFrame, checks: Sequence[Check]) -> list[list[DataFrame]]:
    """Rows that break the table's own rules, each reason a row: by row rules, and by uniqueness."""
    by_row, by_value = [], []
    rules = _row_rules(checks)
    if rules:  # all row rules in one scan
        reasons = F.filter(F.array(*[F.when(_bad_rows(df, c), F.lit(c.check_name)) for c in rules]), lambda r: r.isNotNull())
        by_row.append(df.select(ROW, F.explode(reasons).alias("reason")))
    for c in (c for c in checks if c.test == "unique"):
        order = [F.col(x).asc_nulls_last() for x in df.columns if x not in (ROW, c.column)] + [F.col(ROW).asc()]
        value = Window.partitionBy(c.column)
        # only values that repeat are ordered, so one hot value is as many rows as it has copies
        again = df.filter(F.col(c.column).isNotNull()).groupBy(c.column).count().filter("count > 1").select(c.column)
        by_value.append(df.join(_shuffled(again), c.column, "left_semi").withColumn("_mf_n", F.row_number().over(value.orderBy(*order)))
                        .filter("_mf_n > 1").select(ROW, F.lit(c.check_name).alias("reason")))
    return [[df.select(F.lit(name).alias("table_name"), ROW, "reason", F.lit(0).alias("round")) for df in part]
            for part in (by_row, by_value)]


def _shuffled(keys: DataFrame) -> DataFrame:
    """Keys grow with the tables: they are joined by shuffle, never built into a broadcast table on the driver."""
    return keys.hint("merge")


def _values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(ROW, F.col(column).alias("_mf_value")).filter("_mf_value is not null")


def quarantine(tables: dict[str, DataFrame], checks: Sequence[Check]) -> Quarantine:
    """Split ``tables`` by the error-severity checks on them (see the module)."""
    spark = next(iter(tables.values())).sparkSession
    tables = {t: with_rows(df) for t, df in tables.items()}
    checks = [c for c in checks if c.severity == ERROR and c.model in tables]
    none = spark.createDataFrame([], f"table_name string, {ROW} long, reason string, round int")
    own = {t: _own_rejects(t, df, [c for c in checks if c.model == t]) for t, df in tables.items()}
    repeats = cut_lineage(reduce(DataFrame.unionByName, [r for _, by_value in own.values() for r in by_value], none), "rejects")
    rejects = cut_lineage(reduce(DataFrame.unionByName, [r for by_row, _ in own.values() for r in by_row], none),
                          "rejects").unionByName(repeats)
    references = [c for c in checks if c.test == "relationships" and c.to_model in tables]

    def rows_of(found: DataFrame, table: str) -> DataFrame:
        return _shuffled(found.filter(F.col("table_name") == table).select(ROW).distinct())

    def sound(table: str) -> DataFrame:
        """Rows that keep the table's own rules, with the columns that references name."""
        mine = [c for c in checks if c.model == table]
        named = dict.fromkeys([c.column for c in references if c.model == table] +
                              [c.to_column for c in references if c.to_model == table])
        df = tables[table]
        for c in _row_rules(mine):
            df = df.filter(~F.coalesce(_bad_rows(df, c), F.lit(False)))
        df = df.select(ROW, *named)
        if any(c.test == "unique" for c in mine):
            df = cut_lineage(df.join(rows_of(repeats, table), ROW, "left_anti"), "quarantine-sound")
        return df

    rounds = 0
    if references:
        rows = {t: sound(t) for t in dict.fromkeys([c.model for c in references] + [c.to_model for c in references])}
        unique = {(c.model, c.column) for c in checks if c.test == "unique"}
        repeated = {}  # rows whose key other rows have as well: such a key is lost with the last of them
        for c in references:
            at = c.to_model, c.to_column
            if at not in repeated and at not in unique:
                keys = _values(rows[c.to_model], c.to_column)
                again = keys.groupBy("_mf_value").count().filter("count > 1").select("_mf_value")
                repeated[at] = cut_lineage(keys.join(_shuffled(again), "_mf_value", "left_semi"), "quarantine-repeated")

    new, lost_from = None, {c.to_model for c in references}
    while lost_from:
        orphans = []
        for c in (c for c in references if c.to_model in lost_from):
            child, keys = _values(rows[c.model], c.column), _values(rows[c.to_model], c.to_column)
            if new is None:
                found = child.join(_shuffled(keys.select("_mf_value").distinct()), "_mf_value", "left_anti")
            else:  # after the first round only what the round before took away can orphan rows
                lost = keys.join(rows_of(new, c.to_model), ROW, "left_semi").select("_mf_value").distinct()
                again = repeated.get((c.to_model, c.to_column))
                if again is not None:
                    still = again.join(rows_of(rejects, c.to_model), ROW, "left_anti").select("_mf_value").distinct()
                    lost = lost.join(_shuffled(still), "_mf_value", "left_anti")
                found = child.join(_shuffled(lost), "_mf_value", "left_semi").join(rows_of(rejects, c.model), ROW, "left_anti")
            orphans.append(found.select(F.lit(c.model).alias("table_name"), ROW, F.lit(c.check_name).alias("reason"),
                                        F.lit(rounds + 1).alias("round")))
        new = cut_lineage(reduce(DataFrame.unionByName, orphans), "rejects")
        lost_from = {t for t, in new.select("table_name").distinct().collect()}  # names of tables
        if lost_from:
            rounds += 1
            rejects = rejects.unionByName(new)
            lost_from &= {c.to_model for c in references}
    return Quarantine({t: df.join(rows_of(rejects, t), ROW, "left_anti").drop(ROW) for t, df in tables.items()}, rejects, rounds)


def reject_counts(tables: dict[str, DataFrame], result: Quarantine) -> DataFrame:
    """table_name, n_input, n_kept, n_rejected."""
    rejected = result.rejects.groupBy("table_name").agg(F.count_distinct(ROW).alias("n_rejected"))

    def counted(frames: dict[str, DataFrame], name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias(name)).select(
            F.lit(t).alias("table_name"), name) for t, df in frames.items()])

    return (counted(tables, "n_input").join(counted(result.kept, "n_kept"), "table_name")
            .join(rejected, "table_name", "left")
            .select("table_name", "n_input", "n_kept", F.coalesce("n_rejected", F.lit(0).cast("long")).alias("n_rejected")))
