"""The registered queries: one per operator group, each ``(spark, sf_dir) ->
DataFrame`` over whole test tables. Queries that need a table first build it
as a versioned table under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.functions import convert as C
from shoreline.functions import embed as E
from shoreline.functions import text as TX
from shoreline.functions import times as TM
from shoreline.functions import vectors as VF
from shoreline.operators import assets as A
from shoreline import fs
from shoreline.operators import cdc
from shoreline.operators import digests as DG
from shoreline.operators import export as X
from shoreline.operators import joins as J
from shoreline.operators import merge as M
from shoreline.operators import paging as PG
from shoreline.operators import pivots as PV
from shoreline.operators import quality as Q
from shoreline.operators import read as R
from shoreline.operators import sketches as SK
from shoreline.operators import vector as VS
from shoreline.operators.catalog import Catalog
from shoreline.operators.partitioning import spread
from shoreline.operators.table import VersionedTable
from shoreline.plans import fixtures as FX
from shoreline.session import apply_session_defaults, scratch_path
from shoreline.sources import files as SF
from shoreline.sources.tables import TABLES, load


def _prep(spark: SparkSession) -> None:
    apply_session_defaults(spark)


def _table_from(spark: SparkSession, name: str, df: DataFrame, not_null=(), **layout) -> VersionedTable:
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name not in not_null)
                           for f in df.schema.fields])
    return VersionedTable.create(spark, scratch_path(spark, name), schema, name=name, data=df,
                                 now=FX.COMMIT_TIME, **layout)


# ---------------------------------------------------------------- reads
def scan_filter_project(spark, sf_dir):
    _prep(spark)
    part = load(spark, sf_dir, "part")
    return R.get_values(part, columns=["p_partkey", "p_name", "p_retailprice", "p_size"],
                        where="p_retailprice > 990 and p_size between 10 and 20")


def get_values(spark, sf_dir):
    _prep(spark)
    orders = load(spark, sf_dir, "orders")
    return R.get_values(orders, columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                        where="WHERE o_orderstatus = 'F'",
                        order_by="ORDER BY o_totalprice DESC, o_orderkey", limit=100)


# ------------------------------------------------------ table lifecycle
def create_insert_read(spark, sf_dir):
    _prep(spark)
    sup = load(spark, sf_dir, "supplier")
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name != "s_suppkey")
                           for f in sup.schema.fields])
    t = VersionedTable.create(spark, scratch_path(spark, "suppliers"), schema, now=FX.COMMIT_TIME)
    t.insert(sup.where("s_nationkey < 12"))
    t.insert(sup.where("s_nationkey >= 12 or s_nationkey is null"))
    return (t.read(with_version=True)
            .select("s_suppkey", "s_name", "s_nationkey", "s_acctbal",
                    (F.col("_version") - 1).alias("batch")))


def not_null_check(spark, sf_dir):
    _prep(spark)
    docs = load(spark, sf_dir, "documents").select("doc_id")
    labels = load(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id", "left")
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False),
                           T.StructField("quality", T.IntegerType(), False),
                           T.StructField("toxic", T.IntegerType(), True)])
    t = VersionedTable.create(spark, scratch_path(spark, "labelled"), schema, now=FX.COMMIT_TIME)
    res = t.insert(rows, on_null="reject")
    stored = t.read().agg(F.count(F.lit(1)).alias("n"))
    return stored.select(F.lit("accepted").alias("status"), F.col("n")).unionByName(
        spark.range(1).select(F.lit("rejected").alias("status"), F.lit(res["rejected"]).cast("bigint").alias("n")))


def partition_prune(spark, sf_dir):
    _prep(spark)
    events = load(spark, sf_dir, "events")
    t = _table_from(spark, "events_by_day", events, partition_by=["DATE(ts)"])
    df = t.read(between=("ts", "2024-01-10 00:00:00", "2024-01-20 23:59:59"))
    return (df.groupBy(F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")))


def cluster_layout(spark, sf_dir):
    _prep(spark)
    li = load(spark, sf_dir, "lineitem")
    t = _table_from(spark, "lineitem_clustered", li, cluster_by=["l_shipdate", "l_orderkey"])
    return t.get_values(columns=["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"],
                        where="l_shipdate >= '1995-01-01' and l_shipdate < '1995-04-01'")


def update_rows(spark, sf_dir):
    _prep(spark)
    t = _table_from(spark, "suppliers_upd", load(spark, sf_dir, "supplier"))
    res = t.update({"s_acctbal": "s_acctbal * 1.1"}, "s_nationkey = 3", now=FX.COMMIT_TIME)
    return t.read().withColumn("updated", F.lit(res["updated"]).cast("bigint"))


def delete_rows(spark, sf_dir):
    _prep(spark)
    t = _table_from(spark, "events_del", load(spark, sf_dir, "events"))
    try:
        t.delete("  ")
        refused = False
    except ValueError:  # a delete needs a predicate
        refused = True
    res = t.delete("event_type = 'error'", now=FX.COMMIT_TIME)
    return t.read().withColumns({"deleted": F.lit(res["deleted"]).cast("bigint"), "empty_refused": F.lit(refused)})


def _supplier_history(spark, sf_dir) -> VersionedTable:
    t = _table_from(spark, "suppliers_hist", load(spark, sf_dir, "supplier"))
    t.update({"s_acctbal": "s_acctbal * 1.1"}, "s_nationkey = 3", now=FX.COMMIT_TIME)
    t.delete("s_nationkey = 5", now=FX.COMMIT_TIME_2)
    return t


def time_travel(spark, sf_dir):
    _prep(spark)
    t = _supplier_history(spark, sf_dir)
    return t.as_of(timestamp=FX.COMMIT_TIME).read()


def snapshot_diff(spark, sf_dir):
    _prep(spark)
    t = _supplier_history(spark, sf_dir)
    t.compact(now=FX.COMMIT_TIME_2)  # the changes stay the same
    return t.changes(1)


# ------------------------------------------------------- change capture
def cdc_diff(spark, sf_dir):
    _prep(spark)
    base = FX.products(spark, sf_dir)
    edited = FX.edited_products(base)
    sheet = edited.toDF(*[f" {c.upper()} " for c in edited.columns])  # headers as typed in a sheet
    return cdc.diff(base, sheet, key="id", version_col="updated_at", now=FX.COMMIT_TIME)


def cdc_summary(spark, sf_dir):
    _prep(spark)
    base = FX.products(spark, sf_dir)
    changes = cdc.diff(base, FX.edited_products(base), now=FX.COMMIT_TIME)
    return cdc.summary(changes)


def epoch_normalize(spark, sf_dir):
    _prep(spark)
    e = load(spark, sf_dir, "events")
    m = F.col("event_id") % 5
    ts_ltz = F.col("ts").cast("timestamp")
    raw = (F.when(m == 0, F.unix_seconds(ts_ltz).cast("string"))
           .when(m == 1, F.unix_millis(ts_ltz).cast("string"))
           .when(m == 2, TM.iso_millis(F.col("ts")))
           .when(m == 3, F.concat(F.lit("ts:"), F.col("event_type")))
           .otherwise(F.lit("   ")))
    return e.select("event_id", raw.alias("raw")).withColumn("parsed", TM.normalize_time(F.col("raw")))


def literal_convert(spark, sf_dir):
    _prep(spark)
    p = load(spark, sf_dir, "part")
    m = F.col("p_size") % 4
    special = (F.when(m == 0, F.lit(C.NAN_TEXT)).when(m == 1, F.lit(C.POS_INF_TEXT))
               .when(m == 2, F.lit(C.NEG_INF_TEXT)).otherwise(F.col("p_size").cast("string")))
    b64 = F.base64(F.encode(F.col("p_name"), "UTF-8"))
    return p.select(
        F.col("p_partkey").alias("id"),
        C.clean_text(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("name_trimmed"),
        C.clean_header(F.col("p_type")).alias("type_header"),
        b64.alias("name_b64"),
        (F.decode(C.from_base64(b64), "UTF-8") == F.col("p_name")).alias("b64_roundtrip"),
        C.int_floor(F.col("p_retailprice")).alias("price_floor"),
        C.finite_or_null(C.special_double(special)).alias("finite_value"),
        C.parse_number(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "))).alias("size_number"),
        C.parse_number(F.concat(F.col("p_size").cast("string"), F.lit("kg"))).alias("prefix_number"),
        C.json_text(id=F.col("p_partkey"), brand=F.col("p_brand")).alias("json"),
        F.lit(FX.COMMIT_TIME).cast("timestamp_ntz").alias("stamp"),
        VF.literal_vector([0.5, -1.25, 3.0]).alias("weights"),
    )


def merge_source(spark, sf_dir):
    _prep(spark)
    base = FX.products(spark, sf_dir)
    changes = cdc.diff(base, FX.edited_products(base), now=FX.COMMIT_TIME)
    schema = base.schema
    return M.merge_source(changes, schema, key="id", version_col="updated_at")


def _events_table(spark, sf_dir, name) -> VersionedTable:
    return _table_from(spark, name, load(spark, sf_dir, "events"), not_null=("event_id",))


def merge_occ(spark, sf_dir):
    _prep(spark)
    t = _events_table(spark, sf_dir, "events_occ")
    M.merge(t, FX.event_changes(spark, sf_dir), key="event_id", version_col="ts",
            mode="partial", now=FX.COMMIT_TIME)
    return t.read()


def merge_conflicts(spark, sf_dir):
    _prep(spark)
    t = _events_table(spark, sf_dir, "events_conf")
    res = M.merge(t, FX.event_changes(spark, sf_dir), key="event_id", version_col="ts",
                  mode="partial", now=FX.COMMIT_TIME)
    return res.conflict_rows


def merge_noop(spark, sf_dir):
    """A diff without changes: no commit, the table keeps its version."""
    _prep(spark)
    t = _table_from(spark, "products_noop", FX.products(spark, sf_dir), not_null=("id",))
    base = M.refresh_baseline(t)
    res = M.merge(t, cdc.diff(base, base, now=FX.COMMIT_TIME), now=FX.COMMIT_TIME)
    return t.read().agg(F.count(F.lit(1)).alias("rows")).withColumns({
        "version": F.lit(t.version).cast("bigint"), "affected": F.lit(res.affected).cast("bigint")})


def baseline_refresh(spark, sf_dir):
    _prep(spark)
    t = _table_from(spark, "products_wb", FX.products(spark, sf_dir), not_null=("id",))
    edit = F.col("id") % FX.EDIT_MOD == 1
    b1 = M.refresh_baseline(t)
    first = b1.withColumn("price", F.when(edit, F.col("price") + 1.0).otherwise(F.col("price")))
    M.merge(t, cdc.diff(b1, first, now=FX.COMMIT_TIME), now=FX.COMMIT_TIME)
    b2 = M.refresh_baseline(t)
    second = b2.withColumn("price", F.when(edit, F.col("price") + 1.0).otherwise(F.col("price")))
    M.merge(t, cdc.diff(b2, second, now=FX.COMMIT_TIME_2), now=FX.COMMIT_TIME_2)
    return t.read()


def dq_split(spark, sf_dir):
    _prep(spark)
    p = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.lit("part").alias("src"),
        F.col("p_retailprice").alias("price"), (F.col("p_size") - 3).cast("bigint").alias("stock"))
    li = load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") - 3).alias("id"), F.lit("lineitem").alias("src"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) - 1000.0).alias("price"),
        (F.col("l_quantity").cast("bigint") - 5).alias("stock"))
    a = Q.annotate(p.unionByName(li))
    return a.select("id", "src", F.col("_valid").alias("valid"),
                    F.concat_ws(",", F.col("_failed")).alias("failed"))


# --------------------------------------------------------------- export
def cell_guard(spark, sf_dir):
    _prep(spark)
    return X.cell_guard({t: load(spark, sf_dir, t) for t in TABLES})


def export_rows(spark, sf_dir):
    _prep(spark)
    nation = load(spark, sf_dir, "nation")
    path = scratch_path(spark, "export_nation")
    X.export(nation, path, order_by="n_nationkey")
    return X.read_export(spark, path)


def grid_format(spark, sf_dir):
    _prep(spark)
    e = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return X.to_grid(e)


# ------------------------------------------------------------- flagship
def writeback_flow(spark, sf_dir):
    """Baseline read → edited copy → diff → guarded merge (strict) → the
    committed table."""
    _prep(spark)
    t = _table_from(spark, "products_flow", FX.products(spark, sf_dir), not_null=("id",))
    baseline = M.refresh_baseline(t)
    changes = cdc.diff(baseline, FX.edited_products(baseline), now=FX.COMMIT_TIME)
    M.merge(t, changes, key="id", version_col="updated_at", mode="strict", now=FX.COMMIT_TIME)
    return t.read()


# -------------------------------------------------------- vector search
def _first_vector(spark, sf_dir, vec_id: int = 0):
    """The query vector: one row of ``embeddings`` fetched by key."""
    row = (load(spark, sf_dir, "embeddings").where(F.col("vec_id") == vec_id)
           .select(F.col("embedding").cast("array<double>").alias("v")).first())
    return list(row["v"])


def vector_topk_cosine(spark, sf_dir):
    _prep(spark)
    emb = load(spark, sf_dir, "embeddings")
    return VS.search(emb, _first_vector(spark, sf_dir), k=10, columns=["vec_id", "label"],
                     metric="COSINE", key="vec_id")


def vector_topk_euclidean(spark, sf_dir):
    _prep(spark)
    emb = load(spark, sf_dir, "embeddings")
    return VS.search(emb, _first_vector(spark, sf_dir), k=10, columns=["vec_id", "label"],
                     metric="EUCLIDEAN", key="vec_id")


def vector_filter_topk(spark, sf_dir):
    _prep(spark)
    emb = load(spark, sf_dir, "embeddings")
    return VS.search(emb, _first_vector(spark, sf_dir), k=10, columns=["vec_id", "label"],
                     where="label = 3", key="vec_id")


def vector_defaults(spark, sf_dir):
    """Default projection (id, file_id, name, size) and default k (0 gives 5)."""
    _prep(spark)
    emb = load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("file_id"),
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("name"), F.size("embedding").alias("size"), "embedding")
    return VS.search(emb, _first_vector(spark, sf_dir), k=0)


def vector_label_knn(spark, sf_dir):
    """Every vector of one label as a query, top 5 each over the corpus."""
    _prep(spark)
    emb = load(spark, sf_dir, "embeddings")
    queries = emb.where("label = 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    out = VS.search_batch(emb, queries, k=5, key="vec_id", metric="COSINE")
    return out.select("query_id", "vec_id", "distance", F.col("rank").cast("bigint").alias("rank"))


def vector_batch_knn(spark, sf_dir):
    """One query per label (its lowest vec_id), top 5 each over the corpus."""
    _prep(spark)
    emb = load(spark, sf_dir, "embeddings")
    firsts = emb.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    queries = emb.join(firsts.select("vec_id"), "vec_id", "left_semi").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    out = VS.search_batch(emb, queries, k=5, key="vec_id", columns=["label"], metric="COSINE")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


def _doc_embeddings(spark, sf_dir) -> DataFrame:
    docs = spread(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", E.embed_column(F.col("text")).alias("embedding"))


def hash_embed(spark, sf_dir):
    """Hashed-term embedding of every document, as its non-zero entries."""
    _prep(spark)
    emb = _doc_embeddings(spark, sf_dir)
    return (emb.select("doc_id", F.explode(E.sparse_weights(F.col("embedding"))).alias("e"))
            .select("doc_id", F.col("e.bucket").cast("bigint").alias("bucket"),
                    F.round(F.col("e.weight"), 6).alias("weight")))


def vector_text_query(spark, sf_dir):
    """A text query (the first benchmark passage) embedded with the same model,
    top 10 documents by cosine distance."""
    _prep(spark)
    text = (load(spark, sf_dir, "benchmark").orderBy("item_id").select("text").first()["text"])
    return VS.search(_doc_embeddings(spark, sf_dir), text, k=10, columns=["doc_id"], key="doc_id")


def _picky_model(texts):
    """The offline model, failing on texts with an at sign."""
    if any("@" in t for t in texts if t):
        raise ValueError("no addresses, please")
    return E.embed_texts(texts)


def insert_with_embedding(spark, sf_dir):
    """Texts the model fails on get NULL; the others of their batch do not."""
    _prep(spark)
    from shoreline.operators.embedding import insert_with_embedding as insert_emb
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False),
                           T.StructField("text", T.StringType()),
                           T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    t = VersionedTable.create(spark, scratch_path(spark, "docs_emb"), schema, now=FX.COMMIT_TIME)
    res = insert_emb(t, docs, source_col="text", target_col="embedding", model=_picky_model)
    e = F.col("embedding")
    return t.read().select(
        "doc_id",
        F.when(e.isNotNull(), F.size(e)).cast("bigint").alias("dims"),
        F.when(e.isNotNull(), F.size(F.filter(e, lambda x: x != 0))).cast("bigint").alias("nonzero"),
        F.round(F.array_max(e), 6).alias("max_weight"),
        F.lit(res["without_embedding"]).cast("bigint").alias("without_embedding"))


# --------------------------------------------------------------- assets
def _asset_table(spark, name, schema=None) -> VersionedTable:
    return A.create_asset_table(spark, scratch_path(spark, name), schema=schema, name=name, now=FX.COMMIT_TIME)


def asset_ingest(spark, sf_dir):
    _prep(spark)
    t = _asset_table(spark, "assets")
    rows = A.to_assets(FX.document_blobs(spark, sf_dir), t.schema, now=FX.COMMIT_TIME)
    t.insert(rows, now=FX.COMMIT_TIME)
    return t.read().select("id", "file_id", "name", "mime_type", "size", "metadata",
                           F.col("data").isNotNull().alias("has_data"), "updated_at")


def asset_column_map(spark, sf_dir):
    """A narrower table with its own names: doc_key, title, content_type and a
    ``category`` column filled from metadata."""
    _prep(spark)
    schema = T.StructType([
        T.StructField("doc_key", T.StringType(), False), T.StructField("file_id", T.StringType()),
        T.StructField("title", T.StringType()), T.StructField("content_type", T.StringType()),
        T.StructField("size", T.LongType()), T.StructField("metadata", T.StringType()),
        T.StructField("data", T.BinaryType()), T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("category", T.StringType())])
    t = VersionedTable.create(spark, scratch_path(spark, "knowledge"), schema, now=FX.COMMIT_TIME)
    blobs = FX.document_blobs(spark, sf_dir).withColumn(
        "meta", F.map_concat(F.col("meta"), F.create_map(F.lit("category"), F.element_at("meta", F.lit("lang")))))
    cmap = {"id": "doc_key", "name": "title", "mimeType": "content_type"}
    t.insert(A.to_assets(blobs, t.schema, column_map=cmap, now=FX.COMMIT_TIME), now=FX.COMMIT_TIME)
    return t.read().select("doc_key", "title", "content_type", "size", "category", "metadata")


def asset_metadata(spark, sf_dir):
    """Promoted keys (``category``) and bundled keys (``summary``, and a given
    ``metadata`` value kept under its own key)."""
    _prep(spark)
    schema = A.asset_schema(extra=[("category", "string", True)])
    t = _asset_table(spark, "assets_meta", schema)
    d = load(spark, sf_dir, "documents")
    meta = F.map_filter(F.create_map(
        F.lit("id"), F.col("doc_id").cast("string"),
        F.lit("category"), F.col("lang"),
        F.lit("summary"), F.when(F.col("lang") != "en", F.col("source")),
        F.lit("metadata"), F.lit("doc")), lambda k, v: v.isNotNull())
    blobs = d.select(F.encode("text", "UTF-8").alias("data"), F.lit("text/plain").alias("content_type"),
                     F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"), meta.alias("meta"))
    t.insert(A.to_assets(blobs, t.schema, now=FX.COMMIT_TIME), now=FX.COMMIT_TIME)
    return t.read().select("id", "category", "metadata")


EXTERNAL_TEST_THRESHOLD = 8192


def asset_externalize(spark, sf_dir):
    """Pages as HTML assets; those above a low threshold go to the object
    store (size kept, bytes dropped from the row). The stored bytes are read
    back by url: their MD5 is the last column."""
    _prep(spark)
    pages = load(spark, sf_dir, "pages")
    blobs = pages.select(F.encode("html", "UTF-8").alias("data"), F.lit("text/html").alias("content_type"),
                         F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("name"),
                         F.create_map(F.lit("id"), F.col("page_id").cast("string")).alias("meta"))
    assets = A.to_assets(blobs, A.asset_schema(), now=FX.COMMIT_TIME)
    store = scratch_path(spark, "object_store")
    out = A.externalize(assets, store, threshold=EXTERNAL_TEST_THRESHOLD)
    stored = A.read_external(spark, store).select("url", F.md5("data").alias("stored_md5"))
    # without the bytes; inline rows have no url and would all meet in one task of the join
    rows = out.select("id", "size", F.col("_route").alias("route"), F.col("_object_key").alias("object_key"),
                      F.col("data").isNotNull().alias("has_data"), "url")
    external = F.col("route") == "external"
    return (rows.where(external).join(stored, "url", "left").drop("url")
            .unionByName(rows.where(~external).drop("url").withColumn("stored_md5", F.lit(None).cast("string"))))


def ingest_convert(spark, sf_dir):
    """HTML pages ingested as plain text (type map), with both types kept."""
    _prep(spark)
    pages = load(spark, sf_dir, "pages")
    blobs = pages.select(F.encode("html", "UTF-8").alias("data"), F.lit("text/html").alias("content_type"),
                         F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("name"),
                         F.create_map(F.lit("id"), F.col("page_id").cast("string")).alias("meta"))
    t = _asset_table(spark, "converted")
    res = A.ingest(t, blobs, mime_map={"text/html": "text/plain"}, now=FX.COMMIT_TIME)
    text = t.read().select("id", F.md5("data").alias("text_md5"))
    return A.ingested(t, res).join(text, "id").select("id", "name", "source_mime_type", "mime_type", "size", "text_md5")


def asset_checksum(spark, sf_dir):
    _prep(spark)
    b = FX.document_blobs(spark, sf_dir)
    return b.select("doc_id", F.octet_length("data").cast("bigint").alias("size"),
                    A.content_md5_base64(F.col("data")).alias("md5_base64"))


def mime_harmonize(spark, sf_dir):
    _prep(spark)
    pages = load(spark, sf_dir, "pages")
    m = F.col("page_id") % 3
    p = pages.select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("name"),
        F.when(m == 0, F.lit(A.OCTET_STREAM)).when(m == 2, F.lit("text/html")).alias("mime"),
        F.when(m == 0, F.lit("application/vnd.google-apps.document")).when(m == 1, F.lit("text/plain"))
         .otherwise(F.lit("text/html")).alias("source_mime"))
    d = load(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        F.when(F.col("lang") == "en", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".TXT")))
         .otherwise(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))).alias("name"),
        F.lit("text/plain").alias("mime"), F.lit("text/plain").alias("source_mime"))
    rows = p.unionByName(d)
    verified = A.verified_mime(F.col("mime"), F.col("source_mime"))
    return rows.select("kind", "id", verified.alias("mime_type"), F.col("source_mime").alias("source_mime_type"),
                       A.harmonized_name(F.col("name"), verified).alias("name"))


def html_to_text(spark, sf_dir):
    _prep(spark)
    pages = load(spark, sf_dir, "pages")
    return pages.select("page_id", TX.html_to_text(F.col("html")).alias("text"))


def embed_source(spark, sf_dir):
    """Each document asset embedded by the text chosen for it: caption for
    German documents, decoded bytes for English and French (text/plain),
    nothing for the rest (sent as octet-stream)."""
    _prep(spark)
    d = load(spark, sf_dir, "documents")
    mime = F.when(F.col("lang").isin("en", "fr"), F.lit("text/plain")).otherwise(F.lit(A.OCTET_STREAM))
    caption = F.when(F.col("lang") == "de", F.col("source"))
    meta = F.map_filter(F.create_map(F.lit("id"), F.col("doc_id").cast("string"), F.lit("caption"), caption),
                        lambda k, v: v.isNotNull())
    blobs = spread(d.select(F.encode("text", "UTF-8").alias("data"), mime.alias("content_type"), meta.alias("meta"), "doc_id",
                            F.col("text"), mime.alias("mime"), caption.alias("caption")))
    e = F.col("embedding")
    assets = A.to_assets(blobs, A.asset_schema(), embed=True, now=FX.COMMIT_TIME)
    return assets.select(F.col("id").cast("bigint").alias("doc_id"),
                         F.when(e.isNotNull(), F.size(F.filter(e, lambda x: x != 0))).cast("bigint").alias("nonzero"),
                         F.round(F.array_max(e), 6).alias("max_weight"))


def _write_doc_tree(spark, sf_dir) -> str:
    """Documents written as a folder tree, one text file per document (in a
    folder per language), the input of the file-tree ingest."""
    root = scratch_path(spark, "doc_tree")
    docs = spread(load(spark, sf_dir, "documents").select("lang", "text"))
    if fs.is_local(spark, root):
        SF.write_texts(docs, "lang", "text", root)
    else:
        # committer version 2: tasks move their many files themselves, not the driver
        (docs.write.partitionBy("lang").option("maxRecordsPerFile", 1)
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(root))
    return root


def _tree_files(files: DataFrame) -> DataFrame:
    return files.withColumn("lang", F.regexp_extract("file_id", r"^lang=([^/]+)/", 1))


def folder_ingest(spark, sf_dir):
    """Recursive folder read, MIME list and folder predicate filter, common
    metadata, one commit; one row per file, with the number put in."""
    _prep(spark)
    root = _write_doc_tree(spark, sf_dir)
    blobs = SF.as_blobs(SF.read_files(spark, root, recursive=True), root)
    blobs = SF.mime_filter(blobs, ["text/plain"])
    blobs = SF.mime_filter(blobs, ~(F.element_at("meta", F.lit("folder")) == "lang=de"))
    t = _asset_table(spark, "folder_assets")
    res = A.ingest(t, blobs, common_metadata={"ingestion_source": "folder"}, now=FX.COMMIT_TIME)
    more = t.read().select("id", "data", "url", F.get_json_object("metadata", "$.ingestion_source").alias("ingestion_source"))
    files = _tree_files(A.ingested(t, res).join(more, "id"))
    return files.select("lang", "source_mime_type", "mime_type", "size", F.md5("data").alias("md5"),
                        F.col("url").endswith(F.col("file_id")).alias("has_url"), "ingestion_source",
                        F.lit(res["inserted"]).cast("bigint").alias("files"))


# -------------------------------------------------------------- catalog
CATALOG_TABLES = ("region", "nation", "supplier", "customer")


def _catalog(spark, sf_dir) -> Catalog:
    cat = Catalog(spark, scratch_path(spark, "warehouse"), "sales").ensure("test catalog")
    for name in CATALOG_TABLES:
        df = load(spark, sf_dir, name)
        cat.create(name, df.schema, data=df, now=FX.COMMIT_TIME)
    staged = load(spark, sf_dir, "nation")
    cat.create("_staging", staged.schema, data=staged, now=FX.COMMIT_TIME)
    return cat


def catalog_tables(spark, sf_dir):
    _prep(spark)
    return _catalog(spark, sf_dir).tables().select("table_name", "rows", "columns")


def table_columns(spark, sf_dir):
    _prep(spark)
    cat = Catalog(spark, scratch_path(spark, "warehouse"), "lake").ensure()
    li = load(spark, sf_dir, "lineitem")
    t = cat.create("lineitem", li.schema, data=li, now=FX.COMMIT_TIME)
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(t.schema.fields)]
    n = t.row_count()
    return spark.createDataFrame(rows, "position int, column_name string, data_type string").withColumn(
        "rows", F.lit(n).cast("bigint"))


def drop_table(spark, sf_dir):
    _prep(spark)
    cat = _catalog(spark, sf_dir)
    cat.drop("supplier")
    return cat.tables().select("table_name", "rows", "columns")


def catalog_teardown(spark, sf_dir):
    """Look-ups by name and what each handle reads (rows and the sum of the
    first column), then the catalog dropped with all its tables."""
    _prep(spark)
    cat = _catalog(spark, sf_dir)
    read = None
    for n in cat.table_names():
        handle = cat.table_by_name(n)
        rows = handle.read()
        one = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(rows.columns[0]).cast("bigint").alias("key_sum")).withColumn(
            "table_name", F.lit(n)).withColumn("handle", F.lit(handle.name))
        read = one if read is None else read.unionByName(one)
    read = read.checkpoint()  # the tables are gone afterwards
    names = [*cat.table_names(), "missing"]
    found = {n: cat.table_by_name(n) is not None for n in names}
    cat.drop_catalog()
    gone = spark.createDataFrame([(n, found[n], cat.table_by_name(n) is not None) for n in names],
                                 "table_name string, found boolean, left_over boolean")
    return gone.join(read, "table_name", "left").withColumn("catalog_exists", F.lit(cat.exists()))


SQL_JOIN_AGG = """
WITH rev AS (
  SELECT r.r_name AS region, n.n_name AS nation, o.o_orderkey AS orderkey,
         CAST(l.l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l.l_discount AS DECIMAL(15, 2))) AS revenue
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE o.o_orderdate >= DATE '1996-01-01' AND o.o_orderdate < DATE '1998-01-01'),
rolled AS (
  SELECT region, nation, CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS revenue,
         COUNT(DISTINCT orderkey) AS orders
  FROM rev GROUP BY ROLLUP (region, nation)),
quiet AS (
  SELECT n_name FROM nation
  EXCEPT
  SELECT n.n_name FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey),
ranked AS (
  SELECT region, nation, revenue, orders,
         RANK() OVER (PARTITION BY region ORDER BY revenue DESC, nation) AS rnk
  FROM rolled WHERE region IS NOT NULL AND nation IS NOT NULL)
SELECT k.region, k.nation, k.revenue, k.orders, CAST(k.rnk AS BIGINT) AS rnk,
       q.n_name IS NOT NULL AS no_suppliers
FROM ranked k LEFT JOIN quiet q ON k.nation = q.n_name
UNION ALL
SELECT region, nation, revenue, orders, CAST(NULL AS BIGINT) AS rnk, CAST(NULL AS BOOLEAN) AS no_suppliers
FROM rolled WHERE nation IS NULL
"""


def sql_join_agg(spark, sf_dir):
    """Raw SQL over versioned tables registered as views: joins, rollup,
    except, rank."""
    _prep(spark)
    cat = Catalog(spark, scratch_path(spark, "warehouse"), "star").ensure()
    for name in ("region", "nation", "supplier", "customer", "orders", "lineitem"):
        df = load(spark, sf_dir, name)
        cat.create(name, df.schema, data=df, now=FX.COMMIT_TIME)
    cat.register_views()
    return spark.sql(SQL_JOIN_AGG)


# ---------------------------------------------------------------- joins
def range_join(spark, sf_dir):
    """Events inside order windows of minutes, some of a day; a third of the
    events fall into ten minutes."""
    _prep(spark)
    hot = F.timestamp_add("SECOND", (F.col("event_id") % 600).cast("int"), F.lit(FX.HOT_TIME).cast("timestamp_ntz"))
    events = load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("ts")).alias("at"))
    opens = F.timestamp_add("SECOND", (F.col("o_orderkey") * 173 % 2_592_000).cast("int"), F.lit(FX.PRODUCT_EPOCH).cast("timestamp_ntz"))
    size = 60 + F.col("o_custkey") % 600 + F.when(F.col("o_orderkey") % 2000 == 0, 86_400).otherwise(0)
    windows = (load(spark, sf_dir, "orders").select("o_orderkey", opens.alias("opens"), size.cast("int").alias("size"))
               .select("o_orderkey", "opens", F.timestamp_add("SECOND", F.col("size"), F.col("opens")).alias("closes")))
    return J.range_join(events, windows, "at", ("opens", "closes"), closed="left").select("event_id", "o_orderkey")


def asof_join(spark, sf_dir):
    """Each purchase or error with its user's last view before; one user has a
    third of all events."""
    _prep(spark)
    user = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    e = load(spark, sf_dir, "events").withColumn("user", user)
    acts = e.where("event_type IN ('purchase', 'error')").select("event_id", "user", "event_type", "ts")
    views = e.where("event_type = 'view'").select("user", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed_at"))
    out = J.asof_join(acts, views, ("ts", "viewed_at"), on="user", order="view_id")
    return out.select("event_id", "user", "event_type", "view_id", TM.whole_seconds_between(F.col("ts"), F.col("viewed_at")).alias("seconds"))


# The same text runs on both engines: cube, grouping sets, set operations.
SQL_CUBE = """
WITH s AS (
  SELECT l_returnflag AS flag, l_linestatus AS status, CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT) AS y,
         l_quantity AS quantity, l_orderkey AS orderkey
  FROM lineitem)
SELECT 'cube' AS part, flag, status, CAST(NULL AS BIGINT) AS y, CAST(2 * GROUPING(flag) + GROUPING(status) AS BIGINT) AS grp,
       COUNT(*) AS n, COUNT(DISTINCT orderkey) AS orders, CAST(SUM(quantity) AS DOUBLE) AS quantity
FROM s GROUP BY CUBE (flag, status)
UNION ALL
SELECT 'sets', flag, NULL, y, CAST(2 * GROUPING(flag) + GROUPING(y) AS BIGINT), COUNT(*), COUNT(DISTINCT orderkey),
       CAST(SUM(quantity) AS DOUBLE)
FROM s GROUP BY GROUPING SETS ((flag, y), (y), ())
UNION ALL
SELECT 'intersect', CONCAT('', k), NULL, NULL, NULL, COUNT(*), NULL, NULL
FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) i GROUP BY k
UNION ALL
SELECT 'union', CONCAT('', k), NULL, NULL, NULL, COUNT(*), NULL, NULL
FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) u GROUP BY k
"""


def cube_agg(spark, sf_dir):
    """Raw SQL over registered views: CUBE, GROUPING SETS, INTERSECT, UNION DISTINCT."""
    _prep(spark)
    cat = Catalog(spark, scratch_path(spark, "warehouse"), "cubes").ensure()
    for name in ("supplier", "customer", "lineitem"):
        df = load(spark, sf_dir, name)
        cat.create(name, df.schema, data=df, now=FX.COMMIT_TIME)
    cat.register_views()
    return spark.sql(SQL_CUBE)


def sketch_rollup(spark, sf_dir):
    """Daily sketches of the events, kept as a table and merged per week and
    over all days (span -1), beside the exact answers: is the distinct count
    within its stated error, and the median's rank within its own?"""
    _prep(spark)
    events = load(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = SK.summarize(events, ["day"], "user_id", "value")
    kept = _table_from(spark, "daily_sketches", daily)
    week = F.floor(F.datediff("day", F.lit(FX.PRODUCT_EPOCH[:10]).cast("date")) / 7).cast("bigint")
    spans = F.explode(F.array(week, F.lit(-1).cast("bigint")))
    merged = SK.estimate(SK.combine(kept.read().withColumn("span", spans), ["span"]), {"median": 0.5}, ["span"])
    exact = events.withColumn("span", spans).join(F.broadcast(merged.select("span", "median")), "span").groupBy("span").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("distinct_exact"),
        F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"))
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_exact"))
    return merged.join(exact, "span").select(
        "span", "n", "distinct_exact", (off <= SK.distinct_error() * F.col("distinct_exact")).alias("distinct_ok"),
        ((F.col("below") - SK.rank_error() <= 0.5) & (F.col("upto") + SK.rank_error() >= 0.5)).alias("median_ok"))


def cluster_curve(spark, sf_dir):
    """A table along a curve through two columns, filtered by the second alone."""
    _prep(spark)
    t = _table_from(spark, "lineitem_curve", load(spark, sf_dir, "lineitem"), cluster_by=["l_shipdate", "l_partkey"], curve=True)
    return t.get_values(columns=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], where="l_partkey BETWEEN 20 AND 59")


def vector_pivot_topk(spark, sf_dir):
    """The ten nearest by euclidean distance, through a pivot index."""
    _prep(spark)
    index = PV.build(load(spark, sf_dir, "embeddings"), scratch_path(spark, "pivots"), "vec_id", columns=["label"], now=FX.COMMIT_TIME)
    return PV.search(index, _first_vector(spark, sf_dir), k=10, columns=["vec_id", "label"])


PAGES = 7


def page_rows(spark, sf_dir):
    """All orders in pages, by price and key, while another writer adds rows."""
    _prep(spark)
    t = _table_from(spark, "orders_paged", load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    size, out = t.row_count() // PAGES + 1, None
    for number, page in enumerate(PG.all_pages(t, ["o_totalprice DESC", "o_orderkey"], size)):
        rows = page.rows.withColumn("page", F.lit(number).cast("bigint"))
        out = rows if out is None else out.unionByName(rows)
        VersionedTable(spark, t.path).insert(
            load(spark, sf_dir, "orders").where("o_orderkey % 100 = 0").select(
                (F.col("o_orderkey") + FX.NEW_KEY_OFFSET).alias("o_orderkey"), "o_custkey", "o_totalprice"))
    return out.select("o_orderkey", "o_totalprice", "page")


def diff_ranges(spark, sf_dir):
    """A copy edited in the last tenth of its keys, found by digests of key ranges."""
    _prep(spark)
    base = FX.products(spark, sf_dir)
    cut = base.agg(F.max("id")).first()[0] * 9 // 10
    edited = base.where(F.col("id") < cut).unionByName(FX.edited_products(base.where(F.col("id") >= cut)))
    changes, info = DG.diff_ranges(base, edited, now=FX.COMMIT_TIME)
    return changes.select("id", F.col("_action").alias("action"), F.lit(info["compared"] < base.count()).alias("compared_less"))


def insert_grid(spark, sf_dir):
    """Suppliers as grids of values (a header row, then rows; each under the cell guard), inserted and read."""
    _prep(spark)
    sup = load(spark, sf_dir, "supplier")
    t = VersionedTable.create(spark, scratch_path(spark, "suppliers_grid"), sup.schema, now=FX.COMMIT_TIME)
    inserted = sum(t.insert_values(values)["inserted"] for values in X.grids(sup))
    return t.read().withColumn("inserted", F.lit(inserted).cast("bigint"))


def single_file(spark, sf_dir):
    """One file, given by its path: all benchmark passages, a line each."""
    _prep(spark)
    folder = scratch_path(spark, "passages")
    load(spark, sf_dir, "benchmark").repartition(1).sortWithinPartitions("item_id").select("text").write.text(folder)
    path = f"{folder}/{next(n for n in fs.list_names(spark, folder) if n.startswith('part-'))}"
    t = _asset_table(spark, "one_file")
    res = A.ingest(t, SF.as_blobs(SF.read_files(spark, path, recursive=False), folder), now=FX.COMMIT_TIME)
    return t.read().select("mime_type", "source_mime_type", "size", F.md5("data").alias("md5"),
                           (F.col("name") == F.lit(path.rsplit("/", 1)[1])).alias("named"), F.lit(res["inserted"]).cast("bigint").alias("files"))


#: (case, kind, text): what is refused, and what only looks like it.
GUARDED = (("plain", "where", "p_size > 10"), ("quoted", "where", "p_name <> 'a;b' AND p_size > 10"), ("second statement", "where", "p_size > 10; DROP TABLE x"),
           ("line end", "where", "p_size > 10;"), ("order", "order_by", "p_partkey; DROP TABLE x"), ("keyword", "where", "WHERE p_size > 10"),
           ("negative limit", "limit", "-1"), ("delete", "delete", "1 = 1; DROP TABLE x"), ("update", "update", "p_size > 10; --"), ("no predicate", "update", " "))


def predicate_guard(spark, sf_dir):
    """Each text as a read, delete or update of the part table: refused, or the rows it gives."""
    _prep(spark)
    t = _table_from(spark, "part_guarded", load(spark, sf_dir, "part"))
    out = None
    for case, kind, text in GUARDED:
        try:
            if kind == "delete":
                t.delete(text)
            elif kind == "update":
                t.update({"p_size": "0"}, text)
            rows = t.get_values(**{kind: int(text) if kind == "limit" else text}) if kind in ("where", "order_by", "limit") else t.read()
            refused = False
        except ValueError:
            rows, refused = t.read().limit(0), True
        one = rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(case).alias("case"), F.lit(refused).alias("refused"), "rows")
        out = one if out is None else out.unionByName(one)
    for case, schema in (("schema without a type", [{"name": "a"}]), ("schema with a name twice", [{"name": "a", "type": "INT64"}, {"name": "A", "type": "STRING"}]),
                         ("empty schema", [])):
        try:
            VersionedTable.create(spark, scratch_path(spark, "never"), schema)
            refused = False
        except ValueError:
            refused = True
        out = out.unionByName(t.read().limit(0).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(case).alias("case"), F.lit(refused).alias("refused"), "rows"))
    return out


# ------------------------------------------------------------ streaming
def stream_merge(spark, sf_dir):
    """The event change set arrives as a stream of files, one per micro-batch;
    older changes of some keys come after the newer ones, in later files, and
    don't count. Each micro-batch goes through the guarded merge (partial
    mode), replay-safe. The table's rows and the changes that could not be
    applied."""
    _prep(spark)
    from shoreline.streaming.writeback import read_conflicts, stream_merge as run
    t = _events_table(spark, sf_dir, "events_stream")
    src = scratch_path(spark, "change_stream")
    changes = FX.event_changes(spark, sf_dir).withColumn("seq", F.lit(2))
    older = changes.where("_action = 'UPDATE'").withColumns({"value": F.lit(-1.0), "seq": F.lit(1)})
    for part in (changes, older):  # files are read in the order of their times
        part.repartition(2, "event_id").write.mode("append").parquet(src)
    run(spark, src, changes.schema, t, scratch_path(spark, "stream_ckpt"), key="event_id",
        version_col="ts", order_col="seq", files_per_batch=1)
    none = F.lit(None).cast("string")
    return t.read().select("event_id", "event_type", "value", none.alias("action"), none.alias("reason")).unionByName(
        read_conflicts(t).select("event_id", none.alias("event_type"), F.lit(None).cast("double").alias("value"),
                                 F.col("_action").alias("action"), F.col("_reason").alias("reason")))


def stream_assets(spark, sf_dir):
    """New files of a folder tree appended by a stream, one row per file."""
    _prep(spark)
    from shoreline.streaming.assets import stream_assets as run
    root = _write_doc_tree(spark, sf_dir)
    t = _asset_table(spark, "stream_assets")
    run(spark, root, t, scratch_path(spark, "asset_ckpt"), files_per_batch=5000, glob="*.txt",
        common_metadata={"ingestion_source": "stream"}, now=FX.COMMIT_TIME)
    return _tree_files(t.read()).select("lang", "mime_type", "size", F.md5("data").alias("md5"))
