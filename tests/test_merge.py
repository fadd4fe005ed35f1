import pytest
from pyspark.sql import functions as F

from helpers import at, clock, found
from voltframe.operators import merge

KV = "k int, v int"


def test_conditional_upsert_and_second_run(frame):
    target, source = frame(KV, [(1, 5), (2, None), (3, 7)]), frame(KV, [(1, 5), (2, None), (3, 8), (4, 9)])
    once = merge.merge(target, source, ["k"])
    assert found(once) == [(1, 5, "keep"), (2, None, "keep"), (3, 8, "update"), (4, 9, "insert")]
    again = merge.merge(merge.result(once), source, ["k"])
    assert {a for *_, a in found(again)} == {"keep"}


def test_guard_keeps_observed_values(frame):
    schema = "k int, src string, v int"
    target = frame(schema, [(1, "archive", 1), (2, "forecast", 1), (3, None, 1)])
    source = frame(schema, [(1, "forecast", 2), (2, "archive", 2), (3, "forecast", 2)])

    def guard(old, new):
        return ~((old("src") == "archive") & (new("src") == "forecast"))

    # a guard that is NULL does not hold
    assert found(merge.merge(target, source, ["k"], guard=guard), "k", "_action") == [(1, "keep"), (2, "update"), (3, "keep")]


def test_lineage_alone_is_no_change_but_is_written_with_one(frame):
    schema = "k int, v int, f string"
    target, source = frame(schema, [(1, 1, "a"), (2, 1, "a")]), frame(schema, [(1, 1, "b"), (2, 2, "b")])
    assert found(merge.merge(target, source, ["k"], lineage=["f"])) == [(1, 1, "a", "keep"), (2, 2, "b", "update")]


def test_snapshot_merge(frame):
    schema = "k string, v int"
    target, source = frame(schema, [("A", 1), ("B", 1), ("C", 1)]), frame(schema, [("A", 1), ("B", 2)])
    merged = merge.merge(target, source, ["k"], delete_missing=True)
    assert found(merged, "k", "_action") == [("A", "keep"), ("B", "update"), ("C", "delete")]
    assert found(merge.result(merged)) == [("A", 1), ("B", 2)]
    empty = merge.merge(target, source.where("false"), ["k"], delete_missing=True)
    assert found(merge.action_counts(empty)) == [("delete", 3)]


def test_switches_are_set_on_insert_only(frame):
    schema = "k string, name string, is_active boolean"
    target, source = frame(schema, [("A", "a", True)]), frame(schema, [("A", "a2", False), ("B", "b", False)])
    assert found(merge.merge(target, source, ["k"], insert_only=["is_active"])) == [
        ("A", "a2", True, "update"), ("B", "b", False, "insert")]


def test_null_keys_never_match(frame):
    target, source = frame(KV, [(None, 1), (1, 1)]), frame(KV, [(None, 1), (None, 1), (1, 2)])
    assert found(merge.merge(target, source, ["k"])) == [
        (1, 2, "update"), (None, 1, "insert"), (None, 1, "insert"), (None, 1, "keep")]


def test_repeated_source_key_is_an_error(frame):
    with pytest.raises(Exception, match="repeats a key"):
        merge.merge(frame(KV, [(1, 1)]), frame(KV, [(1, 2), (1, 3)]), ["k"]).collect()


def test_insert_missing(frame):
    assert found(merge.insert_missing(frame(KV, [(1, 1)]), frame(KV, [(1, 2), (2, 2)]), ["k"])) == [(1, 1, "keep"), (2, 2, "insert")]


def test_replace_window(frame):
    schema = "ts timestamp, v int"
    old = frame(schema, [(at("2024-01-01"), 1), (at("2024-01-02"), 1), (at("2024-01-03"), 1)])
    new = frame(schema, [(at("2024-01-02"), 2)])
    assert clock(merge.replace_window(old, new, "ts", "2024-01-02")) == [("2024-01-01 00:00", 1), ("2024-01-02 00:00", 2)]


def test_diff(frame):
    old, new = frame(KV, [(1, 1), (2, 1), (3, None)]), frame(KV, [(1, 1), (2, 2), (4, 1)])
    assert found(merge.diff(old, new, ["k"])) == [
        (2, 1, "update_before"), (2, 2, "update_after"), (3, None, "delete"), (4, 1, "insert")]
    assert merge.diff(old, old, ["k"]).isEmpty()


SCD = "psr string, factor double, src string, valid_from timestamp, valid_to timestamp, is_current boolean"


def test_scd2(frame):
    t0, now = at("2000-01-01"), "2024-05-01 12:00:00"
    dim = frame(SCD, [("same", 1.0, "a", t0, None, True), ("value", 1.0, "a", t0, None, True), ("null", None, None, t0, None, True),
                      ("gone", 4.0, "a", t0, None, True), ("value", 0.5, "a", at("1999-01-01"), t0, False)])
    src = frame("psr string, factor double, src string", [("same", 1.0, "a"), ("value", 2.0, "a"), ("null", 3.0, ""), ("new", 9.0, "b")])
    out = merge.scd2(dim, src, "psr", {"factor": -1, "src": ""}, now)
    assert clock(out, "psr", "factor", "valid_from", "valid_to", "is_current", "_action") == [
        ("gone", 4.0, "2000-01-01 00:00", None, True, "keep"),
        ("new", 9.0, "2024-05-01 12:00", None, True, "insert"),
        ("null", 3.0, "2024-05-01 12:00", None, True, "insert"),
        ("null", None, "2000-01-01 00:00", "2024-05-01 12:00", False, "close"),
        ("same", 1.0, "2000-01-01 00:00", None, True, "keep"),
        ("value", 0.5, "1999-01-01 00:00", "2000-01-01 00:00", False, "keep"),
        ("value", 1.0, "2000-01-01 00:00", "2024-05-01 12:00", False, "close"),
        ("value", 2.0, "2024-05-01 12:00", None, True, "insert")]
    settled = merge.scd2(out.drop("_action"), src, "psr", {"factor": -1, "src": ""}, "2024-06-01 00:00:00")
    assert {a for *_, a in found(settled)} == {"keep"}


def test_scd2_first_load_covers_all_history(frame):
    src = frame("psr string, factor double, src string", [("a", None, "x")])
    out = merge.scd2(frame(SCD, []), src, "psr", {"factor": -1, "src": ""}, "2024-05-01 00:00:00")
    assert clock(out, "psr", "valid_from", "is_current") == [("a", "2000-01-01 00:00", True)]


def test_null_stand_in_equals_null(frame):
    dim = frame(SCD, [("a", None, None, at("2000-01-01"), None, True)])
    src = frame("psr string, factor double, src string", [("a", -1.0, "")])
    assert found(merge.scd2(dim, src, "psr", {"factor": -1, "src": ""}, "2024-05-01 00:00:00"), "_action") == [("keep",)]


def test_null_keys_are_spread(frame):
    """The join key of a NULL-keyed row includes a hash of the row."""
    df = frame(KV, [(None, i) for i in range(100)]).select(F.col("k"), F.col("v"))
    assert merge._side(df, ["k"], "t_").select("t__salt").distinct().count() == 100
