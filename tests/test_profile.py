import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rollcall.operators.profile import findings, profile, value_counts
from rollcall.plans.training import p7_profile

PATTERN = {"j": r"^[a-z]+\z"}


def made(spark, tmp_path, loads, row_group_size):
    rows = [(load, *r) for load, rs in loads for r in rs]
    t = pa.table({"load": pa.array([r[0] for r in rows], pa.int32()), "n": pa.array([r[1] for r in rows], pa.int32()), "j": pa.array([r[2] for r in rows], pa.string()), "grp": pa.array(["x"] * len(rows))})
    pq.write_table(t, tmp_path / "t.parquet", row_group_size=row_group_size)
    return value_counts(spark, str(tmp_path / "t.parquet"), "load", ["n", "j"])


LOADS = [(1, [(1, "a"), (2, "b"), (3, "c"), (4, "d")]), (2, [(None, "a"), (2, "B1"), (2, "b"), (2, None)]), (3, [(-5, "a"), (100, "a"), (200, "a"), (100001, "a")]), (4, [(7, "a")] * 4), (5, [(None, None)] * 4)]
WANT = {(2, "n", "null_rate"), (2, "n", "distinct"), (2, "j", "pattern"), (3, "n", "value_range"), (3, "n", "shift"), (3, "n", "null_rate"), (4, "n", "distinct"), (4, "n", "shift"), (5, "n", "null_rate"), (5, "n", "distinct")}


@pytest.mark.parametrize("size", [4, 3, 100, 1])
def test_findings_do_not_depend_on_row_groups(spark, tmp_path, size):
    counts = made(spark, tmp_path, LOADS, size)
    p = profile(counts, ["n"], (0, 100_000), PATTERN)
    assert {tuple(r) for r in findings(p, ["n"], ["j"]).collect()} == WANT


def test_profile_values_and_footer_use(spark, tmp_path):
    counts = made(spark, tmp_path, LOADS, 4)
    p = {(r.grp, r.column_name): r for r in profile(counts, ["n"], (0, 100_000), PATTERN).collect()}
    assert (p[1, "n"].rows, p[1, "n"].nulls, p[1, "n"].n_distinct, p[1, "n"].low, p[1, "n"].high, p[1, "n"].sum_in) == (4, 0, 4, 1, 4, 10)
    assert (p[2, "j"].nulls, p[2, "j"].n_bad) == (1, 1)
    source = {(r.grp, r.column_name): r.source for r in counts.collect()}
    assert source[4, "n"] == "footer" and source[5, "j"] == "footer" and source[1, "n"] == "data"


@pytest.mark.parametrize("codec,version", [("zstd", "1.0"), ("snappy", "2.0"), ("none", "1.0"), ("gzip", "2.0")])
def test_dictionaries_are_enough_where_nothing_is_counted(spark, tmp_path, codec, version):
    texts = [f"v{i % 50}é" for i in range(400)] + [None] * 100 + ["B1"] * 500
    t = pa.table({"load": pa.array([1] * 500 + [2] * 500, pa.int32()), "j": pa.array(texts), "k": pa.array([i % 7 for i in range(1000)], pa.int64()), "u": pa.array([f"{i:06d}" * 20 for i in range(1000)])})
    pq.write_table(t, tmp_path / "t.parquet", row_group_size=500, compression=codec, data_page_version=version, data_page_size=256, dictionary_pagesize_limit=8192, write_batch_size=64)
    p = {(r.grp, r.column_name): r for r in profile(value_counts(spark, str(tmp_path / "t.parquet"), "load", None, [], {"j": r"^v\d+é\z"}), [], (0, 1), {"j": r"^v\d+é\z"}, ["k"]).collect()}
    assert (p[1, "j"].rows, p[1, "j"].nulls, p[1, "j"].n_distinct, p[1, "j"].n_bad, p[1, "j"].scanned, p[1, "j"].chunks) == (500, 100, 50, 0, 0, 1)
    assert (p[2, "j"].n_distinct, p[2, "j"].n_bad, p[2, "j"].scanned) == (1, 500, 1)  # a violation is counted
    assert (p[1, "k"].n_distinct, p[1, "k"].low, p[1, "k"].high, p[1, "k"].scanned) == (7, 0, 6, 0)
    assert (p[1, "u"].n_distinct, p[1, "u"].scanned) == (500, 1)  # the dictionary got too large


def test_empty_file(spark, tmp_path):
    assert made(spark, tmp_path, [], 4).collect() == []


@pytest.mark.parametrize("size", [2, 3, 100])
def test_every_column_and_null_groups_are_profiled(spark, tmp_path, size):
    at = [datetime.datetime(2020, 1, d, tzinfo=datetime.UTC) for d in (1, 2, 3, 4, 5)]
    maps = [[("b", 1), ("a", 2)], [("a", 2), ("b", 1)], [], None, [("c", None)]]
    pq.write_table(pa.table({"load": pa.array([1, 1, 2, 2, None], pa.int32()), "id": pa.array([9, 10, 11, 12, 13], pa.int64()), "at": pa.array(at, pa.timestamp("us", "UTC")),
                             "m": pa.array(maps, pa.map_(pa.string(), pa.int64())), "ok": pa.array([True, True, None, False, True])}), tmp_path / "t.parquet", row_group_size=size)
    p = {(r.grp, r.column_name): r for r in profile(value_counts(spark, str(tmp_path / "t.parquet"), "load"), [], (0, 1), whole=["id", "load"]).collect()}
    assert {k for k in p} == {(g, c) for g in (1, 2, None) for c in ("load", "id", "at", "m", "ok")}
    assert [(p[g, "m"].rows, p[g, "m"].nulls, p[g, "m"].n_distinct, p[g, "m"].low_text) for g in (1, 2, None)] == [(2, 0, 1, '{"a": 2, "b": 1}'), (2, 1, 1, "{}"), (1, 0, 1, '{"c": null}')]
    assert (p[1, "id"].low, p[1, "id"].high, p[1, "id"].low_text, p[1, "id"].high_text) == (9, 10, "9", "10")
    assert (p[2, "at"].low_text[:10], p[2, "at"].high_text[:10], p[2, "at"].low) == ("2020-01-03", "2020-01-04", None)
    assert (p[1, "ok"].n_distinct, p[1, "ok"].low_text, p[2, "ok"].nulls) == (1, "true", 1)


def test_profile_query_covers_the_table_and_its_changes(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.load_no, r.column_name): r for r in p7_profile(spark, sf).collect()}
    rows = pq.read_table(f"{sf}/session_quality_report.parquet").to_pylist()
    loads = {r["load_no"] for r in rows}
    assert {k for k in got} == {(g, c) for g in loads for c in rows[0]}
    for (load, column), r in got.items():
        freeze = lambda v: tuple(sorted(v)) if isinstance(v, list) else v
        values = {g: [freeze(x[column]) for x in rows if x["load_no"] == g] for g in (load, load - 1)}
        rate, distinct = ({g: f(v) if v else None for g, v in values.items()} for f in (lambda v: v.count(None) / len(v), lambda v: len(set(v) - {None})))
        assert (r.rows, r.null_rate, r.n_distinct) == (len(values[load]), rate[load], distinct[load])
        if load - 1 in loads:
            assert (r.null_rate_change, r.n_distinct_change) == (rate[load] - rate[load - 1], distinct[load] - distinct[load - 1])
        else:
            assert r.before is None and r.null_rate_change is None
