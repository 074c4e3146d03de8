"""Versioned table lifecycle (a table of buoys) and its invariants."""

import random
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators.read import GuardError
from shoreline.operators.schema import SchemaError, normalize_layout, to_struct
from shoreline.operators.table import CommitConflict, NotNullViolation, VersionedTable
from shoreline.sources.grid import GridError, grid_to_frame

BUOYS = [
    {"name": "id", "type": "INT64", "mode": "REQUIRED"},
    {"name": "bay", "type": "STRING"},
    {"name": "depth", "type": "FLOAT64"},
    {"name": "visits", "type": "INT64"},
    {"name": "seen_at", "type": "TIMESTAMP"},
]
ROWS = [["id", "bay", "depth", "visits", "seen_at"],
        [31, "north", 61.5, 19, datetime(2023, 6, 4, 7, 15)],
        [37, "east", 88.25, 3, datetime(2023, 6, 9, 21, 40)],
        [44, "south", 12.75, 27, datetime(2023, 7, 2, 5, 5)]]


@pytest.fixture
def buoys(spark, scratch):
    t = VersionedTable.create(spark, scratch("buoys"), BUOYS,
                              partition_by=["DATE(seen_at)"], cluster_by=["id"])
    res = t.insert(grid_to_frame(spark, ROWS, t.schema))
    assert res["inserted"] == 3
    return t


def test_lifecycle(spark, buoys):
    t = buoys
    got = t.get_values(columns=["id", "bay", "depth"], where="depth > 50.0", order_by="id")
    assert got.columns == ["id", "bay", "depth"]
    assert [r.id for r in got.collect()] == [31, 37]
    v_before = t.version
    assert t.update({"visits": "visits + 4"}, "id = 31")["updated"] == 1
    assert t.read(where="id = 31").first().visits == 23
    assert t.as_of(version=v_before).read(where="id = 31").first().visits == 19
    assert t.delete("id = 44")["deleted"] == 1
    assert t.read(where="id = 44").count() == 0
    assert t.row_count() == 2 == t.read().count()


def test_time_travel_by_timestamp(spark, buoys):
    t = buoys
    first = t.log()[-1].time
    t.update({"depth": "depth * 2"}, "id = 37")
    assert t.as_of(timestamp=first).read(where="id = 37").first().depth == 88.25
    assert t.read(where="id = 37").first().depth == 176.5
    with pytest.raises(ValueError):
        t.as_of(timestamp="1999-01-01T00:00:00Z")


def test_delete_keeps_null_predicate_rows(spark, scratch):
    t = VersionedTable.create(spark, scratch("nulls"), "id bigint, v int")
    t.insert(spark.createDataFrame([(1, 1), (2, None), (3, 5)], "id bigint, v int"))
    t.delete("v > 2")
    assert sorted(r.id for r in t.read().collect()) == [1, 2]


def test_update_sees_old_values(spark, scratch):
    t = VersionedTable.create(spark, scratch("swap"), "id bigint, a int, b int")
    t.insert(spark.createDataFrame([(1, 1, 2)], "id bigint, a int, b int"))
    t.update({"a": "b", "b": "a"}, "id = 1")
    r = t.read().first()
    assert (r.a, r.b) == (2, 1)


def test_not_null_error_and_reject(spark, scratch):
    t = VersionedTable.create(spark, scratch("nn"), BUOYS)
    bad = spark.createDataFrame([(None, "x"), (7, "y")], "id bigint, bay string")
    v = t.version
    with pytest.raises(NotNullViolation):
        t.insert(bad)
    assert t.log(refresh=True)[-1].version == v  # nothing committed
    res = t.insert(bad, on_null="reject")
    assert (res["inserted"], res["rejected"]) == (1, 1)


def test_mandatory_predicate_and_guard(spark, buoys):
    with pytest.raises(ValueError):
        buoys.delete("")
    with pytest.raises(GuardError):
        buoys.delete("id = 1; DROP TABLE x")
    with pytest.raises(GuardError):
        buoys.get_values(where="id = 1;\n")
    # a semicolon inside a literal is fine
    assert buoys.get_values(where="bay = 'a;b'").count() == 0


def test_limit_rules(spark, buoys):
    assert buoys.get_values(limit=0).count() == 0
    with pytest.raises(ValueError):
        buoys.get_values(limit=-1)


def test_schema_validation():
    with pytest.raises(SchemaError, match="index 1"):
        to_struct([{"name": "a", "type": "INT64"}, {"type": "STRING"}])
    s = to_struct([{"name": "ts", "type": "TIMESTAMP"}, {"name": "n", "type": "INT64"},
                   {"name": "a", "type": "STRING"}])
    lay = normalize_layout(s, ["DATE(ts)", "n"], None)
    assert lay.partition_by == ["to_date(ts)"] and lay.cluster_by == ["n"]
    lay = normalize_layout(s, None, ["a", "a", "zz", "n", "ts", "a"])
    assert lay.cluster_by == ["a", "n", "ts"]


def test_grid_checks(spark):
    with pytest.raises(GridError):
        grid_to_frame(spark, [["a"]])
    with pytest.raises(GridError, match="row 2"):
        grid_to_frame(spark, [["a", "b"], [1, 2], [1]])


def test_commit_conflict(spark, buoys):
    with pytest.raises(CommitConflict):
        buoys.apply("INSERT", data=buoys.read(where="id = 31"), expected_version=1)


def _changes(t, *span):
    return sorted((r.id, r._change) for r in t.changes(*span).collect())


def test_changes_and_compact(spark, buoys):
    t = buoys
    v1 = t.version
    t.update({"visits": "visits + 1"}, "id = 37")
    t.update({"visits": "visits"}, "id = 44")  # the same values: still a change
    t.delete("id = 31")
    want = [(31, "removed"), (37, "added"), (37, "removed"), (44, "added"), (44, "removed")]
    assert _changes(t, v1) == want
    rows = sorted(t.read().collect())
    before = t.version
    assert t.compact()["rows"] == 2
    assert sorted(t.read().collect()) == rows
    assert _changes(t, v1) == want  # one meaning whatever the compaction state
    assert _changes(t, v1, before) == want and _changes(t, before) == []
    t.update({"visits": "0"}, "id = 37")
    assert _changes(t, before) == [(37, "added"), (37, "removed")] == _changes(t, before + 1)
    assert t.as_of(version=v1).read().count() == 3 and t.row_count() == 2


class Raced(VersionedTable):
    """Another handle commits right after this one has read its rows."""

    other = None

    def live(self, *args, **kw):
        out = super().live(*args, **kw)
        if self.other:
            act, self.other = self.other, None
            act(VersionedTable(self.spark, self.path))
        return out


@pytest.mark.parametrize("act", [
    lambda t: t.update({"visits": "visits + 1"}, "id = 31"), lambda t: t.delete("id = 31"), lambda t: t.compact()])
def test_racing_writers_conflict(spark, buoys, act):
    raced = Raced(spark, buoys.path)
    raced.other = lambda t: t.update({"visits": "visits + 100"}, "id = 31")
    with pytest.raises(CommitConflict):
        act(raced)
    rows = buoys.read().collect()
    assert sorted((r.id, r.visits) for r in rows) == [(31, 119), (37, 3), (44, 27)]
    assert buoys.row_count() == 3
    act(VersionedTable(spark, buoys.path))  # alone it goes through


def test_commit_file_is_exclusive_and_whole(spark, scratch):
    from shoreline import fs
    path = scratch("commit") + "/0.json"
    fs.mkdirs(spark, path.rsplit("/", 1)[0])
    assert fs.create_exclusive(spark, path, "first") and not fs.create_exclusive(spark, path, "second")
    assert fs.read_text(spark, path) == "first"
    assert fs.list_names(spark, path.rsplit("/", 1)[0]) == ["0.json"]
    with pytest.raises(Exception):  # not a lost race: an error
        fs.create_exclusive(spark, path + "/below/1.json", "x")


def test_pinned_handles_do_not_write(spark, buoys):
    with pytest.raises(ValueError, match="read-only"):
        buoys.as_of(version=buoys.version).delete("id = 31")


def test_random_model(spark, scratch):
    """Random inserts / updates / deletes against a dict; every past
    version must read back as the dict did then."""
    rnd = random.Random(7)
    t = VersionedTable.create(spark, scratch("model"), "k bigint, v bigint")
    model, snaps, nxt = {}, {}, 0
    for _ in range(10):
        op = rnd.choice(["ins", "ins", "upd", "del", "cmp"])
        if op == "cmp":
            t.compact()
        elif op == "ins":
            rows = [(nxt + i, rnd.randint(0, 9)) for i in range(rnd.randint(1, 12))]
            nxt += len(rows)
            t.insert(spark.createDataFrame(rows, "k bigint, v bigint").repartition(3))
            model.update(dict(rows))
        elif op == "upd":
            x = rnd.randint(0, 9)
            t.update({"v": "v + 100"}, f"v = {x}")
            model = {k: (v + 100 if v == x else v) for k, v in model.items()}
        else:
            x = rnd.randint(0, 9)
            t.delete(f"v = {x}")
            model = {k: v for k, v in model.items() if v != x}
        snaps[t.version] = dict(model)
        assert t.row_count() == len(model)
    for v, m in snaps.items():
        got = {r.k: r.v for r in t.as_of(version=v).read().collect()}
        assert got == m, v


def test_random_model_with_merge_and_changes(spark, scratch):
    """Random mutations including guarded merges; every version reads back
    as the model did, and the net rows changed between two versions equal
    the model's difference."""
    from collections import Counter
    from shoreline.operators import merge as M
    rnd = random.Random(11)
    t = VersionedTable.create(spark, scratch("model_merge"), "k bigint, v bigint")
    model, snaps, nxt = {}, {t.version: {}}, 0
    ops = []
    for _ in range(9):
        op = rnd.choice(["ins", "mrg", "mrg", "upd", "del", "cmp"])
        ops.append(op)
        if op == "cmp":
            t.compact()
        elif op == "ins":
            rows = [(nxt + i, rnd.randint(0, 9)) for i in range(rnd.randint(1, 12))]
            nxt += len(rows)
            t.insert(spark.createDataFrame(rows, "k bigint, v bigint").repartition(2))
            model.update(dict(rows))
        elif op == "upd":
            x = rnd.randint(0, 9)
            t.update({"v": "v + 100"}, f"v = {x}")
            model = {k: (v + 100 if v == x else v) for k, v in model.items()}
        elif op == "del":
            x = rnd.randint(0, 9)
            t.delete(f"v = {x}")
            model = {k: v for k, v in model.items() if v != x}
        else:
            keys = sorted(model)
            chosen = rnd.sample(keys, min(len(keys), rnd.randint(0, 4)))
            changes = [(k, rnd.randint(0, 9), "UPDATE") for k in chosen[: len(chosen) // 2]]
            changes += [(k, None, "DELETE") for k in chosen[len(chosen) // 2:]]
            changes += [(nxt + i, rnd.randint(0, 9), "INSERT") for i in range(rnd.randint(1, 3))]
            nxt += 3
            df = spark.createDataFrame(changes, "k bigint, v bigint, _action string")
            res = M.merge(t, df, key="k", version_col="updated_at")
            assert res.conflicts == 0 and res.affected == len(changes)
            for k, v, a in changes:
                if a == "DELETE":
                    model.pop(k)
                else:
                    model[k] = v
        snaps[t.version] = dict(model)
        assert t.row_count() == len(model)
    for v, m in snaps.items():
        assert {r.k: r.v for r in t.as_of(version=v).read().collect()} == m, v
    assert {"mrg", "upd", "del"} <= set(ops), ops
    versions = sorted(snaps)
    for _ in range(4):
        a, b = sorted(rnd.sample(versions, 2))
        ch = t.changes(a, b).collect()
        added = Counter((r.k, r.v) for r in ch if r._change == "added")
        removed = Counter((r.k, r.v) for r in ch if r._change == "removed")
        before, after = Counter(snaps[a].items()), Counter(snaps[b].items())
        assert added - removed == after - before and removed - added == before - after, (a, b)


def test_accessors_values_and_latest(spark, buoys):
    t = buoys
    assert t.set_storage_uri(" gs-like://bucket/x ").storage_uri == "gs-like://bucket/x"
    assert t.full_path.startswith("`") and t.name in t.full_path
    pinned = t.as_of(version=1)
    t.insert_values([["id", "bay"], [52, "new"]])
    assert pinned.read().count() == 0 and pinned.latest().read().count() == 4


def test_grid_rows(spark, buoys):
    from shoreline.operators import export as X
    vals = X.to_values(buoys.read().select("id", "seen_at"), order_by="id")
    assert vals[0] == ["id", "seen_at"] and vals[1] == ["31", "2023-06-04T07:15:00.000Z"]


def test_other_handle_commits_are_seen(spark, buoys):
    other = VersionedTable(spark, buoys.path)
    other.delete("id = 37")
    assert buoys.read().count() == 2 and buoys.row_count() == 2


def test_cluster_hot_value_is_split(spark, scratch):
    """A third of the rows share one cluster value; the write still spreads
    them over several files and the range read finds them all."""
    df = spark.range(30000).selectExpr("id", "case when id % 3 = 0 then -7 else id end as k")
    # AQE would (rightly) merge this tiny shuffle into one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = VersionedTable.create(spark, scratch("hot"), "id bigint, k bigint", cluster_by=["k"], data=df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = t.read(where="k = -7").selectExpr("input_file_name() f").distinct().count()
    assert files > 1
    assert t.read(where="k = -7").count() == 10000


def test_row_numbers_follow_the_files(spark, scratch):
    """Row numbers are given after the clustering shuffle: one task's numbers,
    one file."""
    df = spark.range(4000).selectExpr("id", "(id * 7919) % 4000 as k").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = VersionedTable.create(spark, scratch("numbers"), "id bigint, k bigint", cluster_by=["k"], data=df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    seen = t.live().selectExpr("shiftright(_rn, 33) g", "input_file_name() f").distinct().collect()
    assert len(seen) > 1 and len({r.g for r in seen}) == len({r.f for r in seen}) == len(seen)


def test_partitioned_write_makes_few_files_per_value(spark, scratch):
    df = spark.range(20000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 5 as int)) as day").repartition(16)
    t = VersionedTable.create(spark, scratch("days"), "id bigint, day date", partition_by=["day"], data=df)
    files = t.live().selectExpr("_p0", "input_file_name() f").distinct().groupBy("_p0").count().collect()
    assert len(files) == 5 and all(r["count"] <= 2 for r in files)


def test_vector_length_fixed_per_table(spark, scratch):
    from shoreline.operators.table import VectorLengthError
    t = VersionedTable.create(spark, scratch("vec"), "id bigint, embedding array<double>",
                              vector_dims={"embedding": 3})
    ok = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None)], "id bigint, embedding array<double>")
    assert t.insert(ok)["inserted"] == 2
    bad = spark.createDataFrame([(3, [1.0, 2.0])], "id bigint, embedding array<double>")
    with pytest.raises(VectorLengthError):
        t.insert(bad)
    assert t.insert(bad.unionByName(ok.limit(1)), on_null="reject")["rejected"] == 1
    with pytest.raises(VectorLengthError):
        t.update({"embedding": "array(1.0D)"}, "id = 1")
    assert t.compact()["rows"] == 3 and t.layout.vector_dims == {"embedding": 3}


def test_insert_counts_once_on_clustered_table(spark, scratch):
    # The clustering shuffle's boundary sampling re-reads the input; counts
    # must still be taken once per row.
    df = spark.range(0, 20000, 1, 6).selectExpr(
        "id", "cast(id % 7 as string) as grp", "if(id % 10 = 0, null, id) as v")
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("grp", T.StringType()),
                           T.StructField("v", T.LongType(), False)])
    t = VersionedTable.create(spark, scratch("clustered_counts"), schema, cluster_by=["grp"])
    res = t.insert(df, on_null="reject", count_nulls=("grp",), count_where={"big": F.col("id") >= 10000})
    assert (res["seen"], res["rejected"], res["inserted"]) == (20000, 2000, 18000)
    assert (res["null_grp"], res["big"]) == (0, 10000)
    assert t.read().count() == 18000 and t.row_count() == 18000
