"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The CTEs rebuild the same fixtures as ``shoreline.plans.fixtures`` from the
test tables; each statement computes the operator's result independently
(diff, guard, merge outcome…) in plain SQL.
"""

from __future__ import annotations

EPOCH0 = "TIMESTAMP '1970-01-01 00:00:00'"
T1 = "TIMESTAMP '2024-02-01 12:00:00'"
T2 = "TIMESTAMP '2024-02-02 08:30:00'"

PRODUCTS = """products AS (
  SELECT p_partkey AS id, p_name AS product, p_retailprice AS price, CAST(p_size AS BIGINT) AS stock,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey) AS updated_at
  FROM part)"""

EDITED = """edited AS (
  SELECT id,
         CASE WHEN id % 50 = 2 THEN '  ' || product || '  '
              WHEN id % 50 = 5 THEN product || ' v2' ELSE product END AS product,
         CASE WHEN id % 50 = 1 THEN price + CAST(1.0 AS DOUBLE)
              WHEN id % 50 = 3 THEN price + CAST(1e-7 AS DOUBLE) ELSE price END AS price,
         CASE WHEN id % 50 = 4 THEN stock + 5 ELSE stock END AS stock,
         updated_at
  FROM products WHERE id % 50 <> 0
  UNION ALL
  SELECT id + 1000000000, 'new ' || product, price, CAST(1 AS BIGINT), CAST(NULL AS TIMESTAMP)
  FROM products WHERE id % 50 = 6)"""

DIFF = f"""joined AS (
  SELECT COALESCE(a.id, b.id) AS id,
         a.id AS a_id, a.product AS a_product, a.price AS a_price, a.stock AS a_stock, a.updated_at AS a_updated_at,
         b.id AS b_id, b.product AS b_product, b.price AS b_price, b.stock AS b_stock, b.updated_at AS b_updated_at
  FROM edited a FULL OUTER JOIN products b ON a.id = b.id),
classified AS (
  SELECT *, CASE
      WHEN b_id IS NULL THEN 'INSERT'
      WHEN a_id IS NULL THEN 'DELETE'
      WHEN ((a_product IS NULL) <> (b_product IS NULL)) OR COALESCE(trim(a_product) <> trim(b_product), false)
        OR ((a_price IS NULL) <> (b_price IS NULL)) OR COALESCE(abs(a_price - b_price) > 1e-6, false)
        OR ((a_stock IS NULL) <> (b_stock IS NULL)) OR COALESCE(a_stock <> b_stock, false) THEN 'UPDATE'
    END AS _action
  FROM joined),
diff AS (
  SELECT id,
         CASE WHEN _action = 'DELETE' THEN b_product ELSE a_product END AS product,
         CASE WHEN _action = 'DELETE' THEN b_price ELSE a_price END AS price,
         CASE WHEN _action = 'DELETE' THEN b_stock ELSE a_stock END AS stock,
         CASE WHEN _action = 'UPDATE' THEN {T1}
              WHEN _action = 'INSERT' THEN COALESCE(a_updated_at, {T1})
              ELSE b_updated_at END AS updated_at,
         _action,
         CASE WHEN _action <> 'INSERT' THEN b_updated_at END AS _orig_updated_at,
         CASE WHEN _action = 'INSERT' AND NOT COALESCE(a_id > 0, false) THEN 'invalid new key' END AS _error
  FROM classified WHERE _action IS NOT NULL)"""

EVENT_CHANGES = f"""ch AS (
  SELECT event_id, {T1} AS ts, user_id, event_type, value + CAST(1.0 AS DOUBLE) AS value, props,
         'UPDATE' AS _action,
         CASE event_id % 20 WHEN 0 THEN ts WHEN 1 THEN ts + INTERVAL 400 MILLISECOND
                            WHEN 2 THEN ts - INTERVAL 5 SECOND END AS _orig_ts
  FROM events WHERE event_id % 20 IN (0, 1, 2, 3)
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, props, 'DELETE',
         CASE WHEN event_id % 20 = 4 THEN ts ELSE ts + INTERVAL 5 SECOND END
  FROM events WHERE event_id % 20 IN (4, 5)
  UNION ALL
  SELECT CASE WHEN event_id % 20 = 6 THEN event_id ELSE event_id + 1000000000 END, ts, user_id, event_type,
         value, props, 'INSERT', CAST(NULL AS TIMESTAMP)
  FROM events WHERE event_id % 20 IN (6, 7)),
src AS (
  SELECT event_id,
         CASE WHEN _action = 'DELETE' THEN {EPOCH0} ELSE COALESCE(ts, {EPOCH0}) END AS ts,
         CASE WHEN _action = 'DELETE' THEN NULL ELSE user_id END AS user_id,
         CASE WHEN _action = 'DELETE' THEN NULL ELSE event_type END AS event_type,
         CASE WHEN _action = 'DELETE' THEN NULL ELSE value END AS value,
         CASE WHEN _action = 'DELETE' THEN NULL ELSE props END AS props,
         _action,
         CASE WHEN _action = 'INSERT' THEN {EPOCH0} ELSE _orig_ts END AS _orig_ts
  FROM ch),
cls AS (
  SELECT s.*, e.event_id IS NOT NULL AS found,
         (COALESCE(date_sub('second', s._orig_ts, e.ts) = 0, false) OR s._orig_ts IS NULL
          OR s._orig_ts = {EPOCH0} OR e.ts IS NULL) AS ok
  FROM src s LEFT JOIN events e ON e.event_id = s.event_id),
outcome AS (
  SELECT *, CASE WHEN found AND _action = 'UPDATE' AND ok THEN 'UPDATE'
                 WHEN found AND _action = 'DELETE' AND ok THEN 'DELETE'
                 WHEN NOT found AND _action = 'INSERT' THEN 'INSERT'
                 ELSE 'CONFLICT' END AS result
  FROM cls)"""

CELL_COLUMNS = {  # Fixed values: column counts of the test tables.
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
    "benchmark": 2, "labels": 3, "conversations": 4,
}

ISO_MS = "'%Y-%m-%dT%H:%M:%S.%gZ'"


def _cell_guard() -> str:
    parts = []
    for t, n in CELL_COLUMNS.items():
        parts.append(f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({n} AS BIGINT) AS columns, "
                     f"count(*) * {n} AS cells, count(*) * {n} <= 100000 AS allowed FROM {t}")
    return "\nUNION ALL\n".join(parts)


ORACLE: dict[str, str] = {
    "scan_filter_project": """
SELECT p_partkey, p_name, p_retailprice, p_size FROM part
WHERE p_retailprice > 990 AND p_size BETWEEN 10 AND 20""",

    "get_values": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",

    "create_insert_read": """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
       CASE WHEN s_nationkey < 12 THEN 1 ELSE 2 END AS batch FROM supplier""",

    "not_null_check": """
SELECT 'accepted' AS status, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
UNION ALL
SELECT 'rejected' AS status, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL""",

    "partition_prune": """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'
GROUP BY 1""",

    "cluster_layout": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-04-01'""",

    "update_rows": """
SELECT s_suppkey, s_name, s_nationkey,
       CASE WHEN s_nationkey = 3 THEN s_acctbal * CAST(1.1 AS DOUBLE) ELSE s_acctbal END AS s_acctbal,
       (SELECT count(*) FROM supplier WHERE s_nationkey = 3) AS updated
FROM supplier""",

    "delete_rows": """
SELECT event_id, ts, user_id, event_type, value, props,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS deleted, true AS empty_refused FROM events
WHERE NOT COALESCE(event_type = 'error', false)""",

    "time_travel": """
SELECT s_suppkey, s_name, s_nationkey,
       CASE WHEN s_nationkey = 3 THEN s_acctbal * CAST(1.1 AS DOUBLE) ELSE s_acctbal END AS s_acctbal
FROM supplier""",

    "snapshot_diff": """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal * CAST(1.1 AS DOUBLE) AS s_acctbal, 'added' AS _change
FROM supplier WHERE s_nationkey = 3
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'removed' AS _change
FROM supplier WHERE s_nationkey IN (3, 5)""",

    "cdc_diff": f"WITH {PRODUCTS}, {EDITED}, {DIFF}\nSELECT * FROM diff",

    "cdc_summary": f"""WITH {PRODUCTS}, {EDITED}, {DIFF}
SELECT _action, count(*) AS n, count(_error) AS errors FROM diff GROUP BY _action""",

    "merge_source": f"""WITH {PRODUCTS}, {EDITED}, {DIFF}
SELECT id,
       CASE WHEN _action = 'DELETE' THEN NULL ELSE product END AS product,
       CASE WHEN _action = 'DELETE' THEN NULL ELSE price END AS price,
       CASE WHEN _action = 'DELETE' THEN NULL ELSE stock END AS stock,
       CASE WHEN _action = 'DELETE' THEN {EPOCH0} ELSE COALESCE(updated_at, {EPOCH0}) END AS updated_at,
       _action,
       CASE WHEN _action = 'INSERT' THEN {EPOCH0} ELSE _orig_updated_at END AS _orig_updated_at
FROM diff""",

    "epoch_normalize": f"""
WITH r AS (
  SELECT event_id, CASE event_id % 5
      WHEN 0 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
      WHEN 1 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
      WHEN 2 THEN strftime(ts, {ISO_MS})
      WHEN 3 THEN 'ts:' || event_type
      ELSE '   ' END AS raw
  FROM events),
n AS (SELECT event_id, raw, trim(raw) AS t, TRY_CAST(trim(raw) AS DOUBLE) AS x FROM r)
SELECT event_id, raw,
       CASE WHEN regexp_full_match(t, '(0|[1-9][0-9]*)(\\.[0-9]*[1-9])?')
            THEN CASE WHEN x > 1e6 THEN epoch_ms(CAST(floor(CASE WHEN x < 1e10 THEN x * 1000 ELSE x END) AS BIGINT)) END
            WHEN t <> '' THEN TRY_CAST(regexp_replace(t, 'Z$', '') AS TIMESTAMP)
       END AS parsed
FROM n""",

    "literal_convert": """
WITH s AS (
  SELECT *, CASE p_size % 4 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
                            WHEN 2 THEN CAST('-Infinity' AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS v
  FROM part)
SELECT p_partkey AS id,
       trim('  ' || p_name || ' ') AS name_trimmed,
       lower(trim(p_type)) AS type_header,
       to_base64(encode(p_name)) AS name_b64,
       decode(from_base64(to_base64(encode(p_name)))) = p_name AS b64_roundtrip,
       CAST(floor(p_retailprice) AS BIGINT) AS price_floor,
       CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS finite_value,
       TRY_CAST(trim(' ' || CAST(p_size AS VARCHAR) || ' ') AS DOUBLE) AS size_number,
       TRY_CAST(trim(CAST(p_size AS VARCHAR) || 'kg') AS DOUBLE) AS prefix_number,
       to_json({'id': p_partkey, 'brand': p_brand}) AS json,
       TIMESTAMP '2024-02-01 12:00:00' AS stamp,
       [CAST(0.5 AS DOUBLE), CAST(-1.25 AS DOUBLE), CAST(3.0 AS DOUBLE)] AS weights
FROM s""",

    "merge_occ": f"""WITH {EVENT_CHANGES}
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE event_id NOT IN (SELECT event_id FROM outcome WHERE result IN ('UPDATE', 'DELETE'))
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props FROM outcome WHERE result IN ('UPDATE', 'INSERT')""",

    "merge_conflicts": f"""WITH {EVENT_CHANGES}
SELECT event_id, _action, _orig_ts,
       CASE WHEN found AND _action = 'INSERT' THEN 'key exists'
            WHEN NOT found AND _action <> 'INSERT' THEN 'key missing'
            WHEN found AND NOT ok THEN 'stale version' END AS _reason
FROM outcome WHERE result = 'CONFLICT'""",

    "merge_noop": """
SELECT count(*) AS rows, CAST(1 AS BIGINT) AS version, CAST(0 AS BIGINT) AS affected FROM part""",

    "baseline_refresh": f"""WITH {PRODUCTS}
SELECT id, product,
       CASE WHEN id % 50 = 1 THEN price + CAST(1.0 AS DOUBLE) + CAST(1.0 AS DOUBLE) ELSE price END AS price,
       stock,
       CASE WHEN id % 50 = 1 THEN {T2} ELSE updated_at END AS updated_at
FROM products""",

    "dq_split": """
WITH r AS (
  SELECT p_partkey AS id, 'part' AS src, p_retailprice AS price, CAST(p_size - 3 AS BIGINT) AS stock FROM part
  UNION ALL
  SELECT l_orderkey - 3, 'lineitem', l_extendedprice * (1 - l_discount) - CAST(1000.0 AS DOUBLE),
         CAST(l_quantity AS BIGINT) - 5 FROM lineitem),
f AS (
  SELECT id, src, concat_ws(',',
           CASE WHEN price IS NOT NULL AND NOT COALESCE(price > 0, false) THEN 'price_positive' END,
           CASE WHEN stock IS NOT NULL AND NOT COALESCE(stock >= 0, false) THEN 'stock_non_negative' END,
           CASE WHEN id IS NOT NULL AND NOT COALESCE(id > 0, false) THEN 'id_positive' END) AS failed
  FROM r)
SELECT id, src, failed = '' AS valid, failed FROM f""",

    "cell_guard": _cell_guard(),

    "export_rows": """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
FROM nation""",

    "grid_format": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, {ISO_MS}) AS ts,
       CAST(user_id AS VARCHAR) AS user_id, event_type FROM events""",
}


# ------------------------------------------------------------ batch two
DIM = 768
TOKENS = rf"""tok AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\pL\pN]+')) AS t FROM documents),
cnt AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {DIM} AS BIGINT) AS bucket,
         count(*) AS c
  FROM tok WHERE t <> '' GROUP BY 1, 2),
w AS (
  SELECT doc_id, bucket, c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)) AS weight FROM cnt)"""

QUERY_TOKENS = rf"""qtok AS (
  SELECT unnest(regexp_split_to_array(lower((SELECT text FROM benchmark ORDER BY item_id LIMIT 1)),
                                      '[^\pL\pN]+')) AS t),
qcnt AS (
  SELECT CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {DIM} AS BIGINT) AS bucket, count(*) AS c
  FROM qtok WHERE t <> '' GROUP BY 1),
qw AS (SELECT bucket, c / sqrt(sum(c * c) OVER ()) AS weight FROM qcnt)"""


def _vector_topk(fn: str, extra: str = "") -> str:
    return f"""
WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0),
d AS (
  SELECT e.vec_id, e.label, {fn}(CAST(e.embedding AS DOUBLE[]), q.v) AS dist
  FROM embeddings e, q
  WHERE e.embedding IS NOT NULL AND len(e.embedding) = len(q.v) {extra})
SELECT vec_id, label, round(dist, 6) AS distance, round(1 - dist, 4) AS similarity
FROM d WHERE dist IS NOT NULL
ORDER BY round(dist, 6), vec_id LIMIT 10"""


HTML_TEXT = r"""trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script\s*>', ' ', 'g'),
      '(?is)<style\b.*?</style\s*>', ' ', 'g'),
      '(?s)<!--.*?-->', ' ', 'g'),
      '(?s)<[^>]*>', ' ', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
  '\s+', ' ', 'g'))"""

CATALOG_SQL = {"region": 2, "nation": 3, "supplier": 4, "customer": 5}


def _catalog_rows(skip: tuple = ()) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, {n} AS columns FROM {t}"
        for t, n in CATALOG_SQL.items() if t not in skip) + (
        "\nUNION ALL\nSELECT '_staging' AS table_name, count(*) AS rows, 3 AS columns FROM nation")


def _oracle_batch_two() -> dict[str, str]:
    from shoreline.plans import fixtures as FX
    from shoreline.plans.queries import EXTERNAL_TEST_THRESHOLD as EXT, PAGES, SQL_CUBE, SQL_JOIN_AGG
    merge_final = ORACLE["merge_occ"]
    return {
        "vector_topk_cosine": _vector_topk("list_cosine_distance"),
        "vector_topk_euclidean": _vector_topk("list_distance"),
        "vector_filter_topk": _vector_topk("list_cosine_distance", "AND (e.label = 3)"),
        "vector_batch_knn": """
WITH q AS (
  SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label) AND embedding IS NOT NULL),
d AS (
  SELECT q.query_id, e.vec_id, e.label,
         list_cosine_distance(CAST(e.embedding AS DOUBLE[]), q.v) AS dist
  FROM embeddings e CROSS JOIN q
  WHERE e.embedding IS NOT NULL AND len(e.embedding) = len(q.v)),
r AS (
  SELECT query_id, vec_id, label, round(dist, 6) AS distance, round(1 - dist, 4) AS similarity,
         row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 6), vec_id) AS rank
  FROM d WHERE dist IS NOT NULL)
SELECT * FROM r WHERE rank <= 5""",
        "vector_defaults": """
WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0),
d AS (SELECT e.*, list_cosine_distance(CAST(e.embedding AS DOUBLE[]), q.v) AS dist FROM embeddings e, q
  WHERE e.embedding IS NOT NULL AND len(e.embedding) = len(q.v))
SELECT vec_id AS id, CAST(label AS VARCHAR) AS file_id, 'vec_' || vec_id AS name, CAST(len(embedding) AS INTEGER) AS size,
  round(dist, 6) AS distance, round(1 - dist, 4) AS similarity
FROM d WHERE dist IS NOT NULL ORDER BY round(dist, 6), vec_id LIMIT 5""",
        "vector_label_knn": """
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = 3 AND embedding IS NOT NULL),
d AS (SELECT q.query_id, e.vec_id, list_cosine_distance(CAST(e.embedding AS DOUBLE[]), q.v) AS dist
  FROM embeddings e CROSS JOIN q WHERE e.embedding IS NOT NULL AND len(e.embedding) = len(q.v)),
r AS (SELECT query_id, vec_id, round(dist, 6) AS distance,
  row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 6), vec_id) AS rank FROM d WHERE dist IS NOT NULL)
SELECT * FROM r WHERE rank <= 5""",
        "hash_embed": f"WITH {TOKENS}\nSELECT doc_id, bucket, round(weight, 6) AS weight FROM w",
        "vector_text_query": f"""WITH {TOKENS}, {QUERY_TOKENS},
dots AS (SELECT w.doc_id, sum(w.weight * q.weight) AS s FROM w JOIN qw q ON w.bucket = q.bucket GROUP BY 1),
docs AS (SELECT DISTINCT doc_id FROM w),
d AS (SELECT docs.doc_id, 1 - COALESCE(dots.s, 0) AS dist FROM docs LEFT JOIN dots ON docs.doc_id = dots.doc_id)
SELECT doc_id, round(dist, 6) AS distance, round(1 - dist, 4) AS similarity
FROM d ORDER BY round(dist, 6), doc_id LIMIT 10""",
        "insert_with_embedding": f"""WITH {TOKENS},
agg AS (SELECT doc_id, count(*) AS n, max(weight) AS mx FROM w GROUP BY 1)
SELECT d.doc_id, CASE WHEN agg.n IS NOT NULL THEN CAST({DIM} AS BIGINT) END AS dims,
       agg.n AS nonzero, round(agg.mx, 6) AS max_weight, sum(CASE WHEN agg.n IS NULL THEN 1 ELSE 0 END) OVER ()::BIGINT AS without_embedding
FROM documents d LEFT JOIN agg ON d.doc_id = agg.doc_id AND NOT contains(d.text, '@')""",
        "asset_ingest": f"""
SELECT CAST(doc_id AS VARCHAR) AS id, '' AS file_id, 'doc_' || CAST(doc_id AS VARCHAR) AS name,
       'text/plain' AS mime_type, CAST(strlen(text) AS BIGINT) AS size,
       CAST(json_object('lang', lang, 'source', source) AS VARCHAR) AS metadata,
       strlen(text) > 0 AS has_data, {T1} AS updated_at
FROM documents""",
        "asset_column_map": """
SELECT CAST(doc_id AS VARCHAR) AS doc_key, 'doc_' || CAST(doc_id AS VARCHAR) AS title,
       'text/plain' AS content_type, CAST(strlen(text) AS BIGINT) AS size, lang AS category,
       CAST(json_object('id', CAST(doc_id AS VARCHAR), 'lang', lang, 'source', source) AS VARCHAR) AS metadata
FROM documents""",
        "asset_metadata": """
SELECT CAST(doc_id AS VARCHAR) AS id, lang AS category,
       CASE WHEN lang = 'en' THEN 'doc'
            ELSE CAST(json_object('summary', source, 'metadata', 'doc') AS VARCHAR) END AS metadata
FROM documents""",
        "asset_externalize": f"""
SELECT CAST(page_id AS VARCHAR) AS id, CAST(strlen(html) AS BIGINT) AS size,
       CASE WHEN strlen(html) > {EXT} THEN 'external' ELSE 'inline' END AS route,
       CASE WHEN strlen(html) > {EXT} THEN md5(html) END AS object_key,
       strlen(html) <= {EXT} AND strlen(html) > 0 AS has_data,
       CASE WHEN strlen(html) > {EXT} THEN md5(html) END AS stored_md5
FROM pages""",
        "ingest_convert": f"""
WITH t AS (SELECT page_id, {HTML_TEXT} AS text FROM pages)
SELECT CAST(page_id AS VARCHAR) AS id, 'page_' || page_id || '.txt' AS name, 'text/html' AS source_mime_type,
       'text/plain' AS mime_type, CAST(strlen(text) AS BIGINT) AS size, CASE WHEN text <> '' THEN md5(text) END AS text_md5
FROM t""",
        "asset_checksum": """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size, to_base64(unhex(md5(text))) AS md5_base64
FROM documents""",
        "mime_harmonize": """
WITH p AS (
  SELECT 'page' AS kind, page_id AS id, 'page_' || CAST(page_id AS VARCHAR) AS name,
         CASE page_id % 3 WHEN 0 THEN 'application/octet-stream' WHEN 2 THEN 'text/html' END AS mime,
         CASE page_id % 3 WHEN 0 THEN 'application/vnd.google-apps.document' WHEN 1 THEN 'text/plain'
              ELSE 'text/html' END AS source_mime
  FROM pages
  UNION ALL
  SELECT 'document', doc_id,
         CASE WHEN lang = 'en' THEN 'doc_' || CAST(doc_id AS VARCHAR) || '.TXT'
              ELSE 'doc_' || CAST(doc_id AS VARCHAR) END,
         'text/plain', 'text/plain'
  FROM documents),
v AS (
  SELECT *, CASE WHEN mime IS NULL OR trim(mime) = '' OR mime = 'application/octet-stream'
                 THEN CASE WHEN starts_with(source_mime, 'application/vnd.google-apps.') THEN 'application/pdf'
                           ELSE COALESCE(CASE WHEN trim(source_mime) <> '' THEN source_mime END,
                                         'application/octet-stream') END
                 ELSE mime END AS vm
  FROM p)
SELECT kind, id, vm AS mime_type, source_mime AS source_mime_type,
       CASE WHEN vm = 'application/pdf' AND NOT ends_with(lower(name), '.pdf') THEN name || '.pdf'
            WHEN vm = 'text/plain' AND NOT ends_with(lower(name), '.txt') THEN name || '.txt'
            ELSE name END AS name
FROM v""",
        "html_to_text": f"SELECT page_id, {HTML_TEXT} AS text FROM pages",
        "embed_source": rf"""
WITH c AS (
  SELECT doc_id,
         CASE WHEN lang = 'de' AND trim(source) <> '' THEN 'caption'
              WHEN lang IN ('en', 'fr') AND trim(text) <> '' THEN 'data' END AS chosen,
         CASE WHEN lang = 'de' AND trim(source) <> '' THEN source
              WHEN lang IN ('en', 'fr') AND trim(text) <> '' THEN text END AS t
  FROM documents)
, tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(t), '[^\pL\pN]+')) AS t FROM c),
cnt AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {DIM} AS BIGINT) AS bucket, count(*) AS c
  FROM tok WHERE t <> '' GROUP BY 1, 2),
agg AS (SELECT doc_id, count(*) AS n, max(c) / sqrt(sum(c * c)) AS mx FROM cnt GROUP BY 1)
SELECT d.doc_id, agg.n AS nonzero, round(agg.mx, 6) AS max_weight FROM documents d LEFT JOIN agg ON d.doc_id = agg.doc_id""",
        "folder_ingest": """
SELECT lang, 'text/plain' AS source_mime_type, 'text/plain' AS mime_type, CAST(strlen(text) + 1 AS BIGINT) AS size,
       md5(text || chr(10)) AS md5, true AS has_url, 'folder' AS ingestion_source, count(*) OVER () AS files
FROM documents WHERE lang <> 'de'""",
        "catalog_tables": _catalog_rows(),
        "catalog_teardown": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, true AS found, '{t}' AS handle, false AS left_over, false AS catalog_exists, count(*) AS rows, "
            f"CAST(sum({key}) AS BIGINT) AS key_sum FROM {source}"
            for t, source, key in (("region", "region", "r_regionkey"), ("nation", "nation", "n_nationkey"), ("supplier", "supplier", "s_suppkey"),
                                   ("customer", "customer", "c_custkey"), ("_staging", "nation", "n_nationkey")))
        + "\nUNION ALL\nSELECT 'missing', false, NULL, false, false, NULL, NULL",
        "table_columns": """
SELECT CAST(ordinal_position AS INTEGER) AS position, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                      ELSE lower(data_type) END AS data_type,
       (SELECT count(*) FROM lineitem) AS rows
FROM information_schema.columns WHERE table_name = 'lineitem'""",
        "drop_table": _catalog_rows(skip=("supplier",)),
        "sql_join_agg": SQL_JOIN_AGG,
        "stream_merge": f"""WITH rows AS ({merge_final}), conflicts AS ({ORACLE["merge_conflicts"]})
SELECT event_id, event_type, value, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS VARCHAR) AS reason FROM rows
UNION ALL
SELECT event_id, NULL, NULL, _action, _reason FROM conflicts""",
        "cube_agg": SQL_CUBE,
        "sketch_rollup": f"""
WITH e AS (SELECT *, date_diff('day', DATE '{FX.PRODUCT_EPOCH[:10]}', CAST(ts AS DATE)) // 7 AS week FROM events),
s AS (SELECT week AS span, user_id FROM e UNION ALL SELECT -1, user_id FROM e)
SELECT CAST(span AS BIGINT) AS span, count(*) AS n, count(DISTINCT user_id) AS distinct_exact, true AS distinct_ok, true AS median_ok
FROM s GROUP BY span""",
        "cluster_curve": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_partkey BETWEEN 20 AND 59",
        "page_rows": f"""
SELECT o_orderkey, o_totalprice,
  (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // ((SELECT count(*) FROM orders) // {PAGES} + 1) AS page FROM orders""",
        "diff_ranges": f"""
WITH p AS (SELECT p_partkey AS id, p_partkey % {FX.EDIT_MOD} AS m FROM part WHERE p_partkey >= (SELECT max(p_partkey) * 9 // 10 FROM part))
SELECT id, CASE WHEN m = 0 THEN 'DELETE' ELSE 'UPDATE' END AS action, true AS compared_less FROM p WHERE m IN (0, 1, 4, 5)
UNION ALL SELECT id + {FX.NEW_KEY_OFFSET}, 'INSERT', true FROM p WHERE m = 6""",
        "insert_grid": "SELECT *, (SELECT count(*) FROM supplier) AS inserted FROM supplier",
        "single_file": """
WITH t AS (SELECT string_agg(text || chr(10), '' ORDER BY item_id) AS text FROM benchmark)
SELECT 'text/plain' AS mime_type, 'text/plain' AS source_mime_type, CAST(strlen(text) AS BIGINT) AS size, md5(text) AS md5,
  true AS named, CAST(1 AS BIGINT) AS files FROM t""",
        "predicate_guard": "\nUNION ALL\n".join(
            [f"SELECT '{c}' AS \"case\", false AS refused, count(*) AS rows FROM part WHERE p_size > 10" for c in ("plain", "quoted", "keyword")]
            + [f"SELECT '{c}', true, 0" for c in ("second statement", "line end", "order", "negative limit", "delete", "update", "no predicate",
                                                  "schema without a type", "schema with a name twice", "empty schema")]),
        "range_join": f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '{FX.HOT_TIME}' + to_seconds(event_id % 600) ELSE ts END AS at FROM events),
w AS (SELECT o_orderkey, TIMESTAMP '{FX.PRODUCT_EPOCH}' + to_seconds(o_orderkey * 173 % 2592000) AS opens,
  60 + o_custkey % 600 + CASE WHEN o_orderkey % 2000 = 0 THEN 86400 ELSE 0 END AS size FROM orders)
SELECT event_id, o_orderkey FROM e JOIN w ON e.at >= w.opens AND e.at < w.opens + to_seconds(size)""",
        "asof_join": """
WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS u FROM events),
v AS (SELECT u, ts, max(event_id) AS view_id FROM e WHERE event_type = 'view' GROUP BY u, ts)
SELECT a.event_id, a.u AS "user", a.event_type, v.view_id, date_sub('second', v.ts, a.ts) AS seconds
FROM (SELECT * FROM e WHERE event_type IN ('purchase', 'error')) a ASOF LEFT JOIN v ON a.u = v.u AND a.ts >= v.ts""",
        "stream_assets": """
SELECT lang, 'text/plain' AS mime_type, CAST(strlen(text) + 1 AS BIGINT) AS size, md5(text || chr(10)) AS md5
FROM documents""",
    }


ORACLE.update(_oracle_batch_two())
ORACLE["vector_pivot_topk"] = ORACLE["vector_topk_euclidean"]
