"""Keyed loads into stored tables against a dictionary that keeps the first writer."""
import datetime as dt
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martforge.plans import updates as U
from martforge.plans.loads import Load, load_batch
from martforge.plans.publish import current_version
from martforge.session import scratch_path

AT = dt.datetime(2002, 1, 1)
SCHEMA = "id string, v string"


def root_of(spark):
    return scratch_path(spark, f"loads-{uuid.uuid4().hex}")


def parents(spark, rows):
    return Load("parent", ("id",), lambda now: spark.createDataFrame(rows, SCHEMA), "parent_key")


def children(spark, rows):
    def of(now):
        return spark.createDataFrame(rows, "child long, id string").join(now["parent"], "id").select("child", "parent_key")
    return Load("child", ("child",), of)


def table(spark, root, name):
    return sorted(tuple(r) for r in U.read_table_of(spark, root, name).collect())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdefg"), st.none() | st.sampled_from("xyz")), max_size=8), min_size=1, max_size=3))
def test_first_writer_wins(spark, batches):
    root, want, keys = root_of(spark), {}, {}
    for i, rows in enumerate(batches):
        load_batch(spark, root, f"batch {i}", [parents(spark, rows)], AT)
        brought = {}
        for k, v in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or "")):
            brought.setdefault(k, v)
        for k in sorted(brought):
            if k not in want:
                want[k], keys[k] = brought[k], len(keys) + 1
        assert table(spark, root, "parent") == sorted((keys[k], k, v) for k, v in want.items())


def test_batches_replays_and_references(spark):
    root = root_of(spark)
    first = [parents(spark, [("b", "1"), ("a", "1"), ("a", "0")]), children(spark, [(1, "a"), (2, "z")])]
    one = load_batch(spark, root, "one", first, AT)
    assert load_batch(spark, root, "one", first, AT) == one == current_version(spark, root)
    # child 2 was left until its parent came; "a" keeps its first value
    second = [parents(spark, [("z", "9"), ("a", "7")]), children(spark, [(1, "b"), (2, "z")])]
    two = load_batch(spark, root, "two", second, AT)
    assert table(spark, root, "parent") == [(1, "a", "0"), (2, "b", "1"), (3, "z", "9")]
    assert table(spark, root, "child") == [(1, 1), (2, 3)]
    before = U.folders_of(spark, root, two)
    three = load_batch(spark, root, "three", second, AT)  # the same rows under another name
    after = U.folders_of(spark, root, three)
    assert all(after[t] == before[t] for t in ("parent", "child")) and len(after["parent"]) == 2
    log = sorted((r.batch_id, r.table_name, r.rows) for r in U.read_table_of(spark, root, U.LOG).collect())
    assert log == [("one", "child", 1), ("one", "parent", 2), ("three", "child", 0), ("three", "parent", 0),
                   ("two", "child", 1), ("two", "parent", 1)]


def test_a_broken_batch_publishes_nothing(spark):
    root = root_of(spark)
    one = load_batch(spark, root, "one", [parents(spark, [("a", "1")])], AT)
    with pytest.raises(U.RejectedBatch, match="1 rows for child have a null in their key"):
        load_batch(spark, root, "two", [parents(spark, [("b", "1")]), children(spark, [(None, "b")])], AT)
    assert current_version(spark, root) == one and table(spark, root, "parent") == [(1, "a", "1")]
    load_batch(spark, root, "empty", [parents(spark, [])], AT)
    assert table(spark, root, "parent") == [(1, "a", "1")]
