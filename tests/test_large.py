"""Queries whose tables outgrow a bound that small tables keep."""

import json
import os
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shoreline import fs
from shoreline.functions import embed as E
from shoreline.operators import assets as A
from shoreline.operators import export as X
from shoreline.operators import joins as J
from shoreline.operators import objects as O
from shoreline.operators import paging as PG
from shoreline.operators import partitioning as P
from shoreline.operators import vector as VS
from shoreline.operators.schema import conform
from shoreline.operators.table import VersionedTable, _null_guarded
from shoreline.plans import queries as Q
from shoreline.session import local_path
from shoreline.sources import files as SF
from shoreline.streaming import assets as SA


def _table(spark, folder, name, df):
    df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_grids_beyond_the_cell_guard(spark, scratch):
    n = X.MAX_CELLS // 4 + 7  # four columns: one grid does not hold them
    rows = spark.range(n).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), F.col("id") % 9).alias("s_name"),
                                 F.when(F.col("id") % 5 > 0, (F.col("id") % 25).cast("int")).alias("s_nationkey"),
                                 (F.col("id") / 7).alias("s_acctbal"))
    got = Q.insert_grid(spark, _table(spark, scratch("many_suppliers"), "supplier", rows))
    assert {r.inserted for r in got.select("inserted").distinct().collect()} == {n}
    assert got.count() == n and got.drop("inserted").exceptAll(rows).count() == 0


def test_grids_hold_what_the_guard_allows(spark):
    df = spark.range(10).select("id", F.lit("x").alias("t")).coalesce(1)
    assert [len(g) for g in X.grids(df, max_cells=8)] == [5, 5, 3] and [len(g) for g in X.grids(df, max_cells=20)] == [11]
    assert [r for g in X.grids(df, max_cells=7) for r in g[1:]] == [[i, "x"] for i in range(10)]
    assert next(X.grids(df))[0] == ["id", "t"] and not list(X.grids(df.limit(0)))
    with pytest.raises(X.ExportTooLarge):
        list(X.grids(df, max_cells=1))


def test_tree_files_equal_the_text_writers(spark, scratch):
    rows = [("de", "one"), ("de", "two\nlines"), (None, "three"), ("", None), ("a/b=c%[x] \xe9", "\xe9\n"), ("de", "one")] * 20
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    ours, theirs = scratch("ours"), scratch("theirs")
    assert SF.write_texts(df, "lang", "text", ours) == 120
    df.write.partitionBy("lang").option("maxRecordsPerFile", 1).text(theirs)

    def found(root):
        files = SF.as_blobs(SF.read_files(spark, root), root).select(F.element_at("meta", F.lit("folder")), F.col("data").cast("string"), "content_type")
        return sorted(map(tuple, files.collect()))
    assert found(ours) == found(theirs) and len(found(ours)) == 120
    assert SF.read_files(spark, ours).rdd.getNumPartitions() <= P.ROUNDS * spark.sparkContext.defaultParallelism


def test_required_columns_are_worked_out_once(spark, scratch):
    """The check of required columns stays above the columns it reads: no filter repeats their expressions."""
    t = A.create_asset_table(spark, scratch("once"))
    blobs = spark.range(3).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("data"), F.concat("id", F.lit(".txt")).alias("name"),
                                  F.create_map(F.lit("url"), F.col("id").cast("string")).alias("meta"))
    rows = _null_guarded(conform(A.to_assets(A.harmonize(blobs), t.schema), t.schema), t.schema, "once")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Filter ", 1)[1].split("\n", 1)[0].count("element_at") == 0
    with pytest.raises(Exception, match="NOT NULL violated"):
        _null_guarded(rows.select(*[F.when(F.col("name") != "1.txt", F.col(c)).alias(c) if c == "id" else F.col(c) for c in rows.columns]),
                      t.schema, "once").count()


def test_stream_keeps_the_sessions_settings(spark, scratch):
    n, key = 40, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
                                 F.when(F.col("id") % 2 == 0, "de").otherwise("en").alias("lang"))
    got = Q.stream_assets(spark, _table(spark, scratch("docs"), "documents", rows)).collect()
    assert len(got) == n == len({r.md5 for r in got}) and {r.lang for r in got} == {"de", "en"} and spark.conf.get(key) == before


def _tree(root, names):
    for name in names:
        path = f"{local_path(root)}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(b"" if "empty" in name else name.encode() * 3)


ODD_FILES = ["top.txt", "a/b/c/deep.txt", "a/empty.txt", "a/x.md", "_skip/x.txt", "a/.h.txt", "a/_h.txt", "_k=v/y.txt", "a/_metadata", "a/_metadata.txt",
             "sp ace/\xe9 [1]*{2}%20#.txt", "a/z.txt._COPYING_", "t.TXT"]


@pytest.mark.parametrize("glob", [None, "*.txt", "*.{txt,md}", "[!t]*"])
def test_listed_files_equal_the_readers(spark, scratch, glob):
    root = scratch("odd_tree")
    _tree(root, ODD_FILES)
    ours = SF.read_listed(SF.list_files(spark, root, glob))
    theirs = SF.read_files(spark, root, glob=glob)
    assert ours.columns == theirs.columns
    found = sorted(map(tuple, theirs.collect()))
    assert sorted(map(tuple, ours.collect())) == found and len(found) > 3
    os.remove(f"{local_path(root)}/_k=v/y.txt")
    listed = spark.createDataFrame([(f"file:{local_path(root)}/{n}",) for n in ("_k=v/y.txt", "a/empty.txt", "top.txt")], "path string")
    assert [r.path.rsplit("/", 1)[1] for r in SF.read_listed(listed).collect()] == ["top.txt"]  # gone or empty: no row


def test_stream_leaves_no_file_names_with_the_driver(spark, scratch):
    """The stream follows lists of files; how many there are does not reach the driver. A later run takes only what is new."""
    root, at = scratch("many"), scratch("many_ckpt")
    _tree(root, [f"k={i % 3}/{i}.txt" for i in range(95)] + ODD_FILES)
    t = A.create_asset_table(spark, scratch("many_assets"))

    def run(**options):
        SA.stream_assets(spark, root, t, at, files_per_batch=10, glob="*.txt", **options)
        log = f"{local_path(at)}/sources/0"
        lines = [x for n in os.listdir(log) if not n.startswith(".") for x in open(f"{log}/{n}").read().split("\n")[1:] if x]
        return t.read().select("file_id").collect(), {json.loads(x)["path"] for x in lines}
    rows, named = run()
    want = {r.file_id for r in SF.as_blobs(SF.read_files(spark, root, glob="*.txt"), root).select(F.element_at("meta", F.lit("file_id")).alias("file_id")).collect()}
    assert sorted(r.file_id for r in rows) == sorted(want) and len(want) == 95 + 4
    assert len(named) == 10 and sum(c.operation == "INSERT" for c in t.latest().log()) == 10  # 100 files, one of them empty
    _tree(root, ["k=0/new.txt", "k=9/new.txt"])
    _tree(root, ["top.txt"])  # written again: seen
    rows, named = run()
    assert sorted(r.file_id for r in rows) == sorted(want | {"k=0/new.txt", "k=9/new.txt"}) and len(named) == 11
    os.utime(f"{local_path(root)}/k=1/1.txt", (1, 1))
    _tree(root, ["old.txt"])
    os.utime(f"{local_path(root)}/old.txt", (1, 1))  # older by more than a week than the newest one seen
    assert run()[0] == rows


def test_stream_takes_the_oldest_files_first(spark, scratch):
    root, at = scratch("aged"), scratch("aged_ckpt")
    _tree(root, [f"{i}.txt" for i in range(30)])
    for i in range(30):
        os.utime(f"{local_path(root)}/{i}.txt", (1_700_000_000 - i * 1_000_000, 1_700_000_000 - i * 1_000_000))
    t = A.create_asset_table(spark, scratch("aged_assets"))
    SA.stream_assets(spark, root, t, at, files_per_batch=8)
    got = sorted((r._version, int(r.name.split(".")[0])) for r in t.read(with_version=True).select("_version", "name").collect())
    assert [len([1 for v, _ in got if v == n]) for n in (2, 3, 4, 5)] == [8, 8, 8, 6]
    assert all(29 - i in range(8 * (v - 2), 8 * (v - 1)) for v, i in got)


def test_stream_goes_on_from_the_readers_own_checkpoint(spark, scratch, monkeypatch):
    root, at = scratch("plain"), scratch("plain_ckpt")
    _tree(root, [f"{i}.txt" for i in range(12)])
    t = A.create_asset_table(spark, scratch("plain_assets"))
    with monkeypatch.context() as m:
        m.setattr(fs, "is_local", lambda *_: False)
        SA.stream_assets(spark, root, t, at)
    _tree(root, ["new.txt"])
    SA.stream_assets(spark, root, t, at)
    assert t.read().count() == 13 and not fs.exists(spark, f"{at}/lists")


def test_a_row_group_holds_few_packs(spark, scratch):
    store, size = scratch("groups"), 1_000_000
    n = 3 * O.GROUP_PACKS
    data = spark.range(0, n, 1, 1).select(F.repeat(F.format_string("%010d", "id"), size // 10).cast("binary").alias("data"))
    before, O.PACK_BYTES = O.PACK_BYTES, size
    try:
        assert O.put(data.select(F.md5("data").alias("object_key"), "data"), store).count() == n
    finally:
        O.PACK_BYTES = before
    meta = [pq.ParquetFile(f"{local_path(store)}/{x}").metadata for x in fs.list_names(spark, store) if x.endswith(".parquet")]
    groups = [m.row_group(i).num_rows for m in meta for i in range(m.num_row_groups)]
    assert sum(groups) == n and max(groups) <= O.GROUP_PACKS
    assert O.read_all(spark, store).where(F.md5("data") == F.col("object_key")).count() == n


def test_inline_assets_do_not_meet_in_one_task(spark, scratch):
    pages = spark.range(0, 2000, 1, 4).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), "id").alias("url"), F.concat(
        F.repeat(F.lit("p"), F.when(F.col("id") % 50 == 0, 9000).otherwise(10).cast("int")), "id").alias("html"))
    got = Q.asset_externalize(spark, _table(spark, scratch("pages"), "pages", pages))
    assert got.count() == 2000 and got.where("route = 'external' AND stored_md5 = object_key AND NOT has_data").count() == 40
    assert got.where("route = 'inline' AND stored_md5 IS NULL AND object_key IS NULL AND has_data").count() == 1960
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1500


@pytest.mark.parametrize("large", [0, 1_000])
def test_large_pages_equal_top_k(spark, scratch, monkeypatch, large):
    monkeypatch.setattr(PG, "TOP_K_ROWS", large)
    df = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 5 * 1.5).alias("a"), F.to_date(F.lit("2024-01-01")).alias("d"))
    t = VersionedTable.create(spark, scratch("paged"), df.schema, data=df.repartition(5))
    for order, size in ((["a DESC", "id"], 71), (["a", "id DESC"], 100), (["d", "a", "id"], 299), (["id"], 301)):
        pages = [[r.id for r in p.rows.collect()] for p in PG.all_pages(t, order, size)]
        rows = sorted(df.collect(), key=lambda r: (r.id if order[-1] == "id" else -r.id))
        if order[0] != "id":
            down = order[0] == "a DESC"
            rows.sort(key=lambda r: (r.a is None, -(r.a or 0)) if down else (r.a is not None, r.a or 0))
        ids = [r.id for r in rows]
        assert pages == [ids[i:i + size] for i in range(0, 300, size)] + ([[]] if 300 % size == 0 else [])


def test_large_page_through_one_key(spark, scratch, monkeypatch):
    monkeypatch.setattr(PG, "TOP_K_ROWS", 0)
    df = spark.range(90).select("id", (F.col("id") % 3).alias("k"))
    t = VersionedTable.create(spark, scratch("ties"), df.schema, data=df.repartition(4))
    page = PG.page_rows(t, "k", 40)
    assert sorted(r.k for r in page.rows.collect()) == [0] * 30 + [1] * 10
    assert [r.k for r in PG.page_rows(t, "k", 40, page.token).rows.collect()] == [2] * 30  # rows that share the border's key


def test_hot_bins_give_few_copies(spark, monkeypatch):
    """Cells are shares of all rows: with more rows a row is not copied more often."""
    seen = []
    kept = J._split_hot
    monkeypatch.setattr(J, "HOT_ROWS", 1)
    monkeypatch.setattr(J, "_split_hot", lambda a, b, keys: seen.append(kept(a, b, keys)) or seen[-1])
    for n in (3_000, 12_000):
        points = spark.range(n).select("id", (F.col("id") % 10).cast("double").alias("t"))
        spans = spark.range(n // 10).select(F.col("id").alias("w"), (F.col("id") % 10).cast("double").alias("s"), (F.col("id") % 10 + 1.0).alias("e"))
        want = n // 10 * (n // 100) * 19  # two of ten values for each span, one for the last
        assert J.range_join(points, spans, "t", ("s", "e")).count() == want
    copies = [a.count() + b.count() for a, b in seen]
    assert copies[1] < 5.5 * copies[0]


def test_vectors_of_a_batch_are_cut(spark, monkeypatch):
    out = list(VS._local_topk("v", "id", [], np.array([0], dtype=object), SimpleNamespace(value=np.array([[1.0, 0.0]])), "COSINE", 3, 1e-6)(
        iter([pd.DataFrame({"id": range(5000), "v": [np.array([1.0, i / 50]) for i in range(5000)]})])))
    assert out[0].sort_values("_d")["id"].tolist() == [0, 1, 2]

    def model(texts):
        return [[float(len(texts))] for _ in texts]
    docs = spark.range(0, 1000, 1, 1).select("id", F.col("id").cast("string").alias("text"))
    most = docs.select(E.embed_column(F.col("text"), model=model)[0].alias("n"), "id").agg(F.max("n"), F.count("id"), F.count("n")).first()
    assert most[0] <= E.EMBED_ROWS and most[1] == most[2] == 1000
