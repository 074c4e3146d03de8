"""Plan shape: pushdown, pruning, broadcast anti join, top-k plans."""

import contextlib
import io

from shoreline.operators import vector as VS
from shoreline.operators.table import VersionedTable


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_read_pushes_filters_below_anti_join(spark, scratch):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    t = VersionedTable.create(spark, scratch("ev"), ev.schema, partition_by=["DATE(ts)"], data=ev)
    t.delete("event_type = 'view'")
    df = t.read(where="value > 100", between=("ts", "2024-01-05 00:00:00", "2024-01-06 00:00:00"))
    p = formatted(df.select("event_id"))
    assert "GreaterThan(value,100.0)" in p
    assert "PartitionFilters: [isnotnull(_p0" in p
    assert "BroadcastHashJoin LeftAnti" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double,_rv:int,_rn:bigint>" in p


def test_search_is_take_ordered(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert "TakeOrderedAndProject" in formatted(VS.search(emb, [0.1] * 64, k=5, columns=["vec_id"]))


def test_batch_search_limits_per_query_before_shuffle(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    qs = emb.where("vec_id < 3").selectExpr("vec_id as query_id", "embedding as vector")
    p = formatted(VS.search_batch(emb, qs, k=5, key="vec_id"))
    assert "MapInArrow" in p and "WindowGroupLimit" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_diff_shuffles_each_side_once(spark):
    from shoreline.operators import cdc
    from shoreline.plans import fixtures as FX
    base = FX.products(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = formatted(cdc.diff(base, FX.edited_products(base), now=FX.COMMIT_TIME))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange per side (the key aggregations); the full outer join reuses them
    assert "SortMergeJoin FullOuter" in p
    assert p.count(" Exchange (") == 2


def test_merge_scan_gets_the_key_range(spark, scratch):
    from shoreline.operators import merge as M
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    t = VersionedTable.create(spark, scratch("ev_keys"), ev.schema, cluster_by=["event_id"], data=ev)
    keys = spark.createDataFrame([(40,), (45,)], "_k long")
    p = formatted(M.matched_rows(t, keys, key="event_id", key_range=(40, 45)))
    assert "GreaterThanOrEqual(event_id,40)" in p and "LessThanOrEqual(event_id,45)" in p


def test_few_merge_keys_become_the_scan_filter(spark, scratch):
    """No join, and on a table clustered by the key files without a key are skipped."""
    from shoreline.operators import merge as M
    df = spark.range(8000).selectExpr("id as event_id", "id * 2 as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = VersionedTable.create(spark, scratch("exact"), df.schema, cluster_by=["event_id"], data=df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keys = spark.createDataFrame([(40,), (45,)], "_k long")
    m = M.matched_rows(t, keys, key="event_id", exact=[40, 45])
    p = formatted(m)
    assert "In(event_id, [40,45])" in p and "Join" not in p
    assert sorted(r._tk for r in m.collect()) == [40, 45]
    res = M.merge(t, spark.createDataFrame([(40, 1, "UPDATE"), (9000, 2, "INSERT")], "event_id long, v long, _action string"), key="event_id")
    assert res.affected == 2 and t.read(where="event_id in (40, 9000)").count() == 2
