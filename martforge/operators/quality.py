"""Declarative data-quality checks.

Each check operator returns the *violations* as a DataFrame (empty = pass),
with the counting rules of the source's test framework:

* ``not_null``          rows where the column is NULL
* ``unique``            values seen more than once (NULL ignored), one row each
* ``accepted_values``   distinct values outside the list (NULL passes)
* ``relationships``     child rows whose non-NULL value has no parent
* ``non_negative``      rows where the column is < 0
* ``expression``        rows where a condition is false (NULL passes)

``run_suite`` evaluates a list of ``Check`` specs into one report frame
(one row per check, ``failing_rows``).  Row-level checks on the same model
(NULL, list, sign, expression) are folded into one aggregation pass over
that model; all uniqueness and relationship checks share one shuffle for
each kind of key.
``raise_on_errors`` gathers only the report - one row per check - to the
driver and fails on an error-severity check with failures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = "error"
WARN = "warn"


# --- single-check operators (violations) ------------------------------------------

def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """Duplicated values with their counts (partial counts map-side, so a
    value holding a third of the rows costs one partial row per task)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def dq_accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    bad = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
    return bad.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def dq_relationships(child: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose value is missing from the parent's key (anti join)."""
    keys = parent.select(F.col(key).alias("_mf_key")).filter(F.col("_mf_key").isNotNull()).distinct()
    c = child.filter(F.col(col).isNotNull())
    return c.join(keys, c[col] == keys["_mf_key"], "left_anti")


def dq_non_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


def dq_check(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where ``condition`` is false; a NULL result passes (SQL CHECK)."""
    return df.filter(~condition)


def dq_deferred_self_fk(df: DataFrame, parent_col: str, key: str) -> DataFrame:
    """Self-reference checked once the whole table is loaded (the source
    defers this foreign key to the end of its transaction)."""
    return dq_relationships(df, parent_col, df, key)


def dq_returned_has_return(orders: DataFrame, items: DataFrame, returns: DataFrame) -> DataFrame:
    """Orders with status 'returned' that own no return row."""
    returned_orders = returns.select("order_item_key").join(
        items.select("order_item_key", "order_key"), "order_item_key", "inner").select("order_key").distinct()
    return (orders.filter(F.col("order_status") == "returned")
            .join(returned_orders, "order_key", "left_anti"))


# --- suites ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values | relationships |
                                   # non_negative | expression
    severity: str = ERROR
    values: tuple = ()             # accepted_values
    to_model: str | None = None    # relationships
    to_column: str | None = None
    condition: str | None = None   # expression, Spark SQL text over the model's columns
    name: str = field(default="")

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        suffix = f"_{self.to_model}" if self.to_model else ""
        return f"{self.test}_{self.model}_{self.column}{suffix}"


ROW_TESTS = ("not_null", "accepted_values", "non_negative", "expression")


def _row_metric(check: Check) -> Column:
    c = F.col(check.column)
    if check.test == "not_null":
        return F.count_if(c.isNull())
    if check.test == "non_negative":
        return F.count_if(c < 0)
    if check.test == "expression":
        return F.count_if(~F.expr(check.condition))
    if check.test == "accepted_values":
        return F.count_distinct(F.when(c.isNotNull() & ~c.isin(*check.values), c))
    raise ValueError(check.test)


def _report_row(check: Check, failing: Column) -> list[Column]:
    return [
        F.lit(check.check_name).alias("check_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.test).alias("test"),
        F.lit(check.severity).alias("severity"),
        failing.cast("long").alias("failing_rows"),
    ]


def _key_kind(*columns: T.DataType) -> str:
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return "long" if all(isinstance(c, whole) for c in columns) else "string"


def _key_metrics(checks: Sequence[Check], model: Callable[[str], DataFrame]) -> list[DataFrame]:
    """Uniqueness and relationships, one shuffle for all checks whose keys are of
    one kind (whole numbers, or anything as text).

    Every check sends its values with its number; a relationship also sends the
    parent's keys.  Values are counted map-side, so a value that a third of the
    rows hold is a row a task.  A unique check fails on values met more than once,
    a relationship on the rows of values that no parent has."""
    groups: dict[str, list[tuple[Check, list[DataFrame]]]] = {}

    def values(df: DataFrame, column: str, kind: str, parent: bool) -> DataFrame:
        return df.select(F.col(column).cast(kind).alias("value"), F.lit(parent).alias("parent")).filter("value is not null")

    for ch in checks:
        df, types = model(ch.model), [model(ch.model).schema[ch.column].dataType]
        if ch.test == "relationships":
            types.append(model(ch.to_model).schema[ch.to_column].dataType)
        kind = _key_kind(*types)
        sides = [values(df, ch.column, kind, False)]
        if ch.test == "relationships":
            sides.append(values(model(ch.to_model), ch.to_column, kind, True))
        groups.setdefault(kind, []).append((ch, sides))
    out = []
    for group in groups.values():
        sent = reduce(DataFrame.unionByName, [
            side.select(F.lit(i).alias("i"), "value", "parent") for i, (_, sides) in enumerate(group) for side in sides])
        met = sent.groupBy("i", "value").agg(F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("parent"))
        metrics = met.agg(*[
            (F.count_if((F.col("i") == i) & (F.col("n") > 1)) if ch.test == "unique"
             else F.coalesce(F.sum(F.when((F.col("i") == i) & ~F.col("parent"), F.col("n"))), F.lit(0))).alias(f"m{i}")
            for i, (ch, _) in enumerate(group)])
        out.append(_report([ch for ch, _ in group], metrics))
    return out


def _report(checks: Sequence[Check], metrics: DataFrame) -> DataFrame:
    """The one row of metrics m0, m1, ... as one row per check."""
    rows = F.array(*[F.struct(*_report_row(ch, F.col(f"m{i}"))) for i, ch in enumerate(checks)])
    return metrics.select(F.explode(rows).alias("r")).select("r.*")


def run_suite(checks: Sequence[Check], model: Callable[[str], DataFrame]) -> DataFrame:
    """One report row per check.  ``model(name)`` returns the frame of a model."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.test in ROW_TESTS:
            by_model.setdefault(ch.model, []).append(ch)
    for name, group in by_model.items():  # a single scan of each model
        parts.append(_report(group, model(name).agg(*[_row_metric(ch).alias(f"m{i}") for i, ch in enumerate(group)])))
    parts += _key_metrics([ch for ch in checks if ch.test in ("unique", "relationships")], model)
    return reduce(DataFrame.unionByName, parts)


class DataQualityError(RuntimeError):
    pass


def raise_on_errors(report: DataFrame) -> list[dict]:
    """Fail when an error-severity check has failures; return warnings.
    Only the report (one row per check) reaches the driver."""
    failing = [r.asDict() for r in report.filter(F.col("failing_rows") > 0).collect()]
    errors = [r for r in failing if r["severity"] == ERROR]
    if errors:
        names = ", ".join(f"{r['check_name']} ({r['failing_rows']})" for r in errors)
        raise DataQualityError(f"data-quality checks failed: {names}")
    return [r for r in failing if r["severity"] == WARN]
