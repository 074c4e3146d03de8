"""The registered queries of this folder, with the parameters used in production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoreline.llm import attribution, bpe, bytebpe, chat, convtrie, langid, linededup, merkle, mixing, quality, rules, simhash, vectors
from shoreline.llm.common import only, table
from shoreline.llm.sampling import crc_mod

TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    model = langid.train(docs, usable=crc_mod("doc_id", 3) != 1)
    return langid.predict(docs, model).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    out = linededup.apply_bitmaps(docs, linededup.line_keep_bitmaps(docs))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      linededup.sha256_hex("text").alias("kept_sha256"))


def op3_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(only(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))[0]


def op4_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(only(table(spark, sf_dir, "documents"), "doc_id", "text"), shingle=3, max_bits=2)


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of the documents that ``labels`` covers."""
    return (docs.select("doc_id", F.col("lang").alias("domain")).where("domain IS NOT NULL")
            .join(labels.select("doc_id").distinct(), "doc_id"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return mixing.mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TARGETS)[0]


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable=crc_mod("doc_id", 4) != 2)
    return quality.score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, fields ``source`` and ``text``
    encoded as one text, tokens across a line end given to the larger part."""
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "source", "text")
    return attribution.token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                    fields=("source", "text"), lines=True, rule="majority")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.line_frequency_rules(only(table(spark, sf_dir, "documents"), "doc_id", "text", "source"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations share openings: the first few turns of each hundred's first one."""
    own = convtrie.ordered_turns(only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"))
    convs, turns = convtrie.shared_openings(own, F.col("c") - F.col("c") % 100, crc_mod("c", 6))
    return convtrie.trie(convs, turns)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 is even are checked with the line ends of their text lost."""
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "source", "lang", "n_chars", "text")
    found = F.when(crc_mod("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.verify(docs, found)
    return out.select("doc_id", *[merkle.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                      F.sha2(merkle.hexed(F.col("proof")), 256).alias("proof_sha256"),
                      merkle.hexed(F.col("folded")).alias("folded_root"), "verified")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    return bytebpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_line_dedup, op3_embedding_near_dup, op4_simhash_near_dup, op5_source_mixing,
    op6_quality_classifier, op7_bpe, op8_token_counts, op9_quality_rules, op10_chat_formatting,
    op11_conversation_trie, op12_merkle_manifest, op13_byte_bpe, pipeline)}

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"



def crc32_sql(text: str) -> str:
    """Unsigned crc32 of ASCII ``text`` in DuckDB: bit by bit, eight steps a character."""
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)), "
            "lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), "
            "4294967295::UBIGINT)")


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE: dict[str, str] = {
    "op2_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {WS}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= 10 GROUP BY key)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (k.doc_id > f.least) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.least IS NULL OR k.doc_id <= f.least), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY k.doc_id""",
    "op3_embedding_near_dup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN c ON c.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id""",
    "op9_quality_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT *, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    regexp_replace(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), '[0-9]', '0', 'g') AS key
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
f AS (SELECT source, key FROM k GROUP BY source, key HAVING count(DISTINCT doc_id) > 20),
r AS (SELECT k.doc_id, count(*) AS n_removed_lines, sum(chars) AS removed_chars
  FROM k JOIN f ON k.key = f.key AND k.source IS NOT DISTINCT FROM f.source GROUP BY k.doc_id),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM k GROUP BY doc_id),
p AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
g AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM p),
t AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
o AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM t) GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines,
    coalesce(removed_chars, 0)::BIGINT AS removed_chars
  FROM d LEFT JOIN u ON u.doc_id = d.doc_id LEFT JOIN o ON o.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id),
q AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND word_chars - removed_chars >= 0.5 * word_chars AS kept FROM q""",
    "op11_conversation_trie": f"""
WITH t AS (SELECT conv_id AS c, length(coalesce(text, '')) AS chars, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), g) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT DISTINCT c, c - c % 100 AS base, {crc32_sql("c::VARCHAR")} % 6 AS h FROM t),
o AS (SELECT v.c, pos, g, chars FROM v JOIN t ON t.c = v.base AND pos < h),
k AS (SELECT c, count(*) AS n FROM o GROUP BY c),
b AS (SELECT * FROM o UNION ALL SELECT v.c, coalesce(k.n, 0) + pos - h, g, chars FROM v JOIN t ON t.c = v.c AND pos >= h LEFT JOIN k ON k.c = v.c),
p AS (SELECT c, pos + 1 AS depth, string_agg(g, '') OVER (PARTITION BY c ORDER BY pos) AS prefix, chars FROM b UNION ALL SELECT c, 0, '', 0 FROM v),
q AS (SELECT *, min(c) OVER w AS m, count(*) OVER w AS n_convs FROM p WINDOW w AS (PARTITION BY depth, prefix)),
n AS (SELECT q.m, q.depth, u.m AS up, q.n_convs, (q.n_convs - 1) * q.chars AS saved FROM q LEFT JOIN q u ON u.c = q.c AND u.depth = q.depth - 1 WHERE q.c = q.m),
f AS (SELECT up AS m, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
x AS (SELECT q.m, q.depth, count(*) FILTER (f.m IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM n JOIN q ON q.c = n.m AND q.depth <= n.depth LEFT JOIN f ON f.m = n.m AND f.depth = n.depth GROUP BY q.m, q.depth),
e AS (SELECT m, depth, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM q
  WHERE depth = (SELECT max(z.depth) FROM p z WHERE z.c = q.c) GROUP BY m, depth)
SELECT n.m AS conv_id, n.depth, n.up AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children, x.n_leaves::BIGINT AS n_leaves,
  x.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM n JOIN x ON x.m = n.m AND x.depth = n.depth LEFT JOIN f ON f.m = n.m AND f.depth = n.depth LEFT JOIN e ON e.m = n.m AND e.depth = n.depth""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source, sha256({_FIELDS} || {_field("text")}) AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN sha256({_FIELDS} || {_field("replace(text, chr(10), '')")}) END AS bad FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)),
l AS (SELECT rid, doc_id, tree, leaf, coalesce(bad, leaf) AS found,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
u AS (SELECT tree, 0 AS lvl, idx, leaf AS digest FROM l
  UNION ALL SELECT tree, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM u) WHERE n > 1 GROUP BY tree, lvl + 1, idx // 3),
r AS (SELECT tree, arg_max(digest, lvl) AS subroot, max(lvl) AS height FROM u GROUP BY tree),
t AS (SELECT 0 AS lvl, tree AS idx, subroot AS digest FROM r
  UNION ALL SELECT lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM t) WHERE n > 1 GROUP BY lvl + 1, idx // 3),
a AS (SELECT u.*, lvl = height AS top FROM u JOIN r USING (tree)
  UNION ALL SELECT -1, lvl, idx, digest, lvl = (SELECT max(lvl) FROM t) FROM t),
n AS (SELECT *, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM a WINDOW w AS (PARTITION BY tree, lvl, idx // 3 ORDER BY idx)),
c AS (SELECT rid, tree, 0 AS lvl, idx, found AS folded, '' AS proof FROM l
  UNION ALL SELECT rid, CASE WHEN top THEN -1 ELSE c.tree END, CASE WHEN top THEN 0 ELSE c.lvl + 1 END,
    CASE WHEN top THEN c.tree ELSE c.idx // 3 END, CASE WHEN top THEN folded ELSE sha256(lft || folded || rgt) END,
    CASE WHEN top THEN proof ELSE proof || lft || rgt END
  FROM c JOIN n ON c.tree = n.tree AND c.lvl = n.lvl AND c.idx = n.idx WHERE NOT (top AND c.tree = -1))
SELECT l.doc_id, l.leaf, r.subroot, n.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = n.digest AS verified
FROM c JOIN n ON c.tree = -1 AND n.tree = -1 AND n.top AND c.lvl = n.lvl JOIN l USING (rid) JOIN r ON r.tree = l.tree""",
    "op10_chat_formatting": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, CASE WHEN role = 'user' THEN regexp_replace(speaker, '[^\p{L}\p{N}_.-]', '_', 'g') END AS name FROM r),
s AS (SELECT *, '<|im_start|>' || role || CASE WHEN name IS NULL THEN '' ELSE ' name=' || name END || chr(10) AS head FROM h),
g AS (SELECT *, head || replace(replace(text, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')
  || '<|im_end|>' || chr(10) AS segment FROM s),
o AS (SELECT *, sum(length(segment)) OVER w AS upto, row_number() OVER w - 1 AS message_no FROM g
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, message_no, turn, role, name, (upto - length(segment))::BIGINT AS start,
  CASE WHEN role = 'assistant' THEN (upto - length(segment) + length(head))::BIGINT END AS loss_start,
  CASE WHEN role = 'assistant' THEN (upto - 1)::BIGINT END AS loss_end, segment FROM o""",
}
