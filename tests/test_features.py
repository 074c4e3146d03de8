"""Sketches, paging, the pivot index and the clustering curve."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoreline.operators import curve as CV
from shoreline.operators import paging as PG
from shoreline.operators import pivots as PV
from shoreline.operators import sketches as SK
from shoreline.operators import vector as VS
from shoreline.operators.table import VersionedTable


def rows_scanned(df) -> int:
    """Rows that the Parquet scans of an executed plan gave out."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name == "FileSourceScanExec":
            total += node.metrics().get("numOutputRows").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
    return total


@pytest.fixture
def many_files(spark):
    """Sixteen files per clustered write, however small."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# ------------------------------------------------------------- sketches
def test_sketches_merge_to_any_range(spark):
    """Estimates of merged days within their stated errors of the exact answers; a third of the rows on one day."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 20).alias("day"),
                                    (F.col("id") * 7919 % 9000).alias("user"), (F.col("id") * 31 % 10_007).cast("double").alias("v"))
    daily = SK.summarize(df, ["day"], "user", "v").cache()
    assert daily.count() == 20
    for lo, hi in ((0, 20), (3, 6), (5, 6)):
        part = df.where(F.col("day").between(lo, hi - 1))
        got = SK.estimate(SK.combine(daily.where(F.col("day").between(lo, hi - 1))), {"p10": .1, "p50": .5, "p99": .99}, []).first()
        exact = part.agg(F.count(F.lit(1)), F.count_distinct("user")).first()
        assert got.n == exact[0] and abs(got.distinct_estimate - exact[1]) <= SK.distinct_error() * exact[1]
        for q in (.1, .5, .99):
            v = got[f"p{round(q * 100)}"]
            share = part.agg(F.avg((F.col("v") < v).cast("double")), F.avg((F.col("v") <= v).cast("double"))).first()
            assert share[0] - SK.rank_error() <= q <= share[1] + SK.rank_error()
    # merging merged rows gives what merging the days gives
    twice = SK.combine(SK.combine(daily.withColumn("half", F.col("day") < 10), ["half"]))
    assert abs(SK.estimate(twice, {}, []).first().distinct_estimate - 9000) <= SK.distinct_error() * 9000


def test_sketches_of_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, float("nan")), (2, "a", 3.0), (2, "a", None)], "d int, u string, v double")
    daily = SK.summarize(df, ["d"], "u", "v")
    got = {r.d: r for r in SK.estimate(daily, {"m": .5}, ["d"]).collect()}
    assert (got[1].n, got[1].distinct_estimate, got[1].m) == (2, 0, None) and (got[2].n, got[2].distinct_estimate, got[2].m) == (2, 1, 3.0)
    both = SK.estimate(SK.combine(daily), {"m": .5}, []).first()
    assert (both.n, both.distinct_estimate, both.m) == (4, 1, 3.0)
    assert SK.summarize(df.limit(0), ["d"], "u", "v").count() == 0


# --------------------------------------------------------------- paging
def walk(table, order, size, write=None, **options):
    out, token = [], None
    while True:
        page = PG.page_rows(table, order, size, token, **options)
        out.append([tuple(r) for r in page.rows.collect()])
        token = page.token
        if write:
            write()
        if token is None:
            return out


@pytest.mark.parametrize("size", [1, 4, 7, 100])
def test_pages_hold_every_row_once(spark, scratch, size):
    rows = [(i, random.Random(i).choice([None, 1.5, -2.0, 7.25, float("inf")]), f"n{i % 3}" if i % 5 else None) for i in range(14)]
    t = VersionedTable.create(spark, scratch("paged"), "id bigint, price double, name string")
    t.insert(spark.createDataFrame(rows, "id bigint, price double, name string"))

    def write():
        VersionedTable(spark, t.path).insert(spark.createDataFrame([(1000 + random.randrange(10**6), 1.5, "late")], "id bigint, price double, name string"))
        t.delete("id = 3")
    for order, key in ((["price DESC", "name", "id"], lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or "", r[0])),
                       (["name", "price", "id DESC"], lambda r: (r[2] is not None, r[2] or "", r[1] is not None, r[1] or 0, -r[0]))):
        here = sorted([tuple(r) for r in t.read().collect()], key=key)
        pages = walk(t, order, size, write)
        assert [r for p in pages for r in p] == here
        assert all(len(p) == size for p in pages[:-1])


def test_page_tokens_and_refusals(spark, scratch):
    t = VersionedTable.create(spark, scratch("tokens"), "id bigint, day date, at timestamp_ntz, d decimal(10,2)", cluster_by=["id"])
    t.insert(spark.range(30).selectExpr("id", "date_add(DATE '2024-01-01', cast(id % 4 as int)) AS day",
                                        "timestamp_ntz '2024-01-01 00:00:00.000001' AS at", "cast(id / 3 AS decimal(10,2)) AS d"))
    for order in (["day", "id"], ["at", "d DESC", "id"]):
        assert sorted(r[0] for p in walk(t, order, 8, columns=["id"]) for r in p) == list(range(30))
    assert [r[0] for p in walk(t, "id", 9, columns=["id"], where="id % 2 = 0") for r in p] == list(range(0, 30, 2))
    first = PG.page_rows(t, "id", 10)
    second = PG.page_rows(t, "id", 10, first.token)
    assert "PushedFilters: [GreaterThanOrEqual(id,9)" in second.rows._jdf.queryExecution().toString().replace("IsNotNull(id), ", "")
    assert [r.id for r in second.rows.collect()] == list(range(10, 20))
    with pytest.raises(ValueError, match="another order"):
        PG.page_rows(t, "day", 10, first.token)
    with pytest.raises(ValueError, match="not a page token"):
        PG.page_rows(t, "id", 10, "rubbish")
    for bad in (dict(size=0, order_by="id"), dict(size=3, order_by="nope"), dict(size=3, order_by="id; DROP"), dict(size=3, order_by=[])):
        with pytest.raises(ValueError):
            PG.page_rows(t, bad["order_by"], bad["size"])
    empty = VersionedTable.create(spark, scratch("no_rows"), "id bigint")
    page = PG.page_rows(empty, "id", 5)
    assert page.token is None and page.rows.count() == 0


# --------------------------------------------------------------- pivots
def test_pivot_search_equals_full_scan_and_reads_less(spark, scratch, many_files):
    rnd = np.random.default_rng(2)
    centers = rnd.normal(size=(12, 6)) * 20
    rows = [(i, (centers[i % 12] + rnd.normal(size=6)).round(3).tolist(), i % 4) for i in range(3000)]
    rows += [(5000 + i, [0.0] * 6, 9) for i in range(3)] + [(6000 + i, rows[17][1], 8) for i in range(40)]  # zero and tied vectors
    rows += [(7000, None, 0), (7001, [1.0, 2.0], 0), (7002, [None] + [1.0] * 5, 0), (7003, [float("nan")] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    index = PV.build(df, scratch("pivots"), "vec_id", columns=["label"])
    assert index.table.row_count() == 3043
    usable = df.where("vec_id < 7000")
    read = []
    for q, k in ((rows[17][1], 10), (rows[17][1], 60), ([0.0] * 6, 5), ((centers[3] + 0.5).tolist(), 7), ([500.0] * 6, 3), (rows[5][1], 1)):
        got = [tuple(r) for r in PV.search(index, q, k=k, columns=["vec_id", "label"]).collect()]
        want = [tuple(r) for r in VS.search(usable, q, k=k, columns=["vec_id", "label"], metric="EUCLIDEAN", key="vec_id").collect()]
        assert got == want
        hit = PV.candidates(index, q, k)
        assert hit.count() >= k
        read.append(rows_scanned(hit) if hit.collect() is not None else 0)
    assert sorted(read)[2] < 3043 / 2  # most searches pass over more than half of the rows
    assert PV.search(index, rows[17][1], k=5000).count() == 3043
    assert PV.search(index, [1.0, 2.0], k=5).count() == 0
    with pytest.raises(ValueError, match="usable"):
        PV.build(df.where("vec_id = 7000"), scratch("nopivots"), "vec_id")


# ---------------------------------------------------------------- curve
def test_curve_skips_on_the_second_column(spark, scratch, many_files):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("a"), (F.col("id") * 104_729 % 39_989).alias("b"), F.col("id").alias("v"))
    scanned = {}
    for curve in (False, True):
        t = VersionedTable.create(spark, scratch("curve"), df.schema, data=df, cluster_by=["a", "b"], curve=curve)
        assert t.row_count() == 40_000 and t.layout.curve == curve and t.columns == ["a", "b", "v"]
        for name in "ab":
            hit = t.read(where=f"{name} BETWEEN 3000 AND 3400")
            assert sorted(r.v for r in hit.collect()) == sorted(r.v for r in df.where(f"{name} BETWEEN 3000 AND 3400").collect())
            scanned[curve, name] = rows_scanned(hit)
    assert scanned[False, "b"] > 36_000  # sorted by a alone, b is everywhere
    assert scanned[True, "b"] < 20_000 and scanned[True, "a"] < 20_000
    t = VersionedTable.create(spark, scratch("curve_c"), df.schema, data=df.limit(1000), cluster_by=["a", "b"], curve=True)
    assert t.compact()["rows"] == 1000 and t.layout.curve


def test_curve_with_nulls_texts_and_three_columns(spark, scratch):
    rows = [(i, None if i % 7 == 0 else f"t{i % 50}", float("nan") if i % 11 == 0 else i * 0.5, i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b string, c double, d boolean")
    for keys in (["b", "a"], ["c", "b", "a"], ["a", "b", "c", "d"]):
        t = VersionedTable.create(spark, scratch("curve3"), df.schema, data=df, cluster_by=keys, curve=True)
        assert sorted(r.a for r in t.read().collect()) == list(range(400))
    empty = VersionedTable.create(spark, scratch("curve0"), df.schema, data=df.limit(0), cluster_by=["a", "b"], curve=True)
    assert empty.row_count() == 0


def test_ranks_and_interleaving(spark):
    cuts = [10, 20, 30]
    got = spark.createDataFrame([(v,) for v in (5, 10, 15, 20, 29, 30, 99, None)], "v int").select(CV.rank(F.col("v"), cuts).alias("r")).collect()
    assert [r.r for r in got] == [0, 1, 1, 2, 2, 3, 3, 3]
    x = spark.createDataFrame([(0b101, 0b011)], "a int, b int").select(CV.interleave([F.col("a"), F.col("b")], 3).alias("z")).first().z
    assert x == 0b100111
