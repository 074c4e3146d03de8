"""Merkle manifest of a dataset and its verification by a recursive climb.

Every row is a leaf; the leaves of a source, by id, form a tree in which runs
of ``FAN`` nodes have a parent, and the sources' roots form a tree of their
own. The built levels are stored as parent-linked rows: a row holds a node and
the ``SPAN`` levels below it, names its parent's row, and says at which place
it stands there. A recursive query then ascends from every leaf, one stored row
a step: it appends the siblings on the way and folds the hash at hand (a
tampered one, or the leaf's own) into the next.

Near the top all leaves pass through few rows. A stored row that more than
``LEAVES`` leaves reach is therefore kept in several copies, and leaves are
dealt over them, so no join key holds more rows than that. Leaves are ranked by
range partitions, so a source may hold any share of the rows; texts are hashed
where they lie and are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoreline.llm.common import materialise
from shoreline.llm.ordered import join_hot, numbered

FAN = 3
#: Levels that a stored row covers (so it holds up to FAN ** SPAN leaves' digests), and leaves that one copy serves.
SPAN, LEAVES = 6, 200_000
#: The tree of the sources' roots; a source's own tree is numbered by its rank.
TOP = -1


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 (binary) of the fields: ``-`` if null, else byte count, colon and value."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return _hash(F.concat(*map(part, fields)))


def _raised(nodes: Column) -> Column:
    """The level above: a digest for every run of FAN (the last may be shorter)."""
    def run(i: Column) -> Column:
        return _hash(hexed(F.aggregate(F.slice(nodes, i * FAN + 1, FAN), F.lit(b""), lambda s, x: F.concat(s, x))))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")), run)


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves: how many powers of FAN lie under n."""
    return F.size(F.filter(F.array(*[F.lit(FAN ** k) for k in range(39)]), lambda p: p < n))


def _stored_rows(nodes: DataFrame, span: int) -> DataFrame:
    """Stored rows of all trees in ``nodes`` (tree, n, idx, digest, reached),
    ``n`` being the tree's leaves and ``reached`` the leaves under a node:
    (tree, base, block, n, levels, reached, final)."""
    out, base = None, 0
    most = nodes.agg(F.max(_height(F.col("n")))).first()[0]
    while base == 0 or base * span < (most or 0):
        steps = F.least(F.lit(span), _height(F.col("n")) - base * span)
        raised = F.aggregate(F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
                             F.array("leaves"), lambda ls, _: F.concat(ls, F.array(_raised(F.element_at(ls, -1)))))
        rows = materialise(
            nodes.groupBy("tree", "n", F.floor(F.col("idx") / FAN ** span).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("idx", "digest")))["digest"].alias("leaves"), F.sum("reached").alias("reached"))
            .select("tree", F.lit(base).alias("base"), "block", "n", raised.alias("levels"), "reached",
                    (_height(F.col("n")) <= (base + 1) * span).alias("final")))
        out = rows if out is None else out.unionByName(rows)
        nodes = rows.where(~F.col("final")).select("tree", "n", F.col("block").alias("idx"), "reached",
                                                   F.element_at(F.element_at("levels", -1), 1).alias("digest"))
        base += 1
    return out


def build(leaves: DataFrame, order: list[str], span: int = SPAN, most: int = LEAVES) -> tuple[DataFrame, DataFrame]:
    """(placed leaves, stored rows) for ``leaves`` with a string ``source``
    (null or not), a binary ``leaf`` and the ``order`` columns.

    A placed leaf has ``tree`` and ``idx``. A stored row has (tree, base, block,
    copy), ``levels`` (arrays of digests from its lowest nodes to itself), and
    its parent as (up_tree, up_base, up_idx, up_copies), null at the root.
    """
    keyed = materialise(leaves.withColumn("g", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    placed = materialise(numbered(keyed, "g", order).withColumnRenamed("pos", "idx"))
    sources = materialise(placed.groupBy("g").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0)))
    ranked = materialise(numbered(sources, "all", ["g"]).select("g", "n", F.col("pos").alias("tree")))
    placed = materialise(join_hot(placed, ranked, "g", "n"))
    own = _stored_rows(placed.select("tree", "n", "idx", F.col("leaf").alias("digest"), F.lit(1).cast("long").alias("reached")), span)
    subroots = own.where("final").select("tree", F.element_at(F.element_at("levels", -1), 1).alias("digest"), "reached")
    n_sources = ranked.count()
    above = _stored_rows(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n_sources).cast("long").alias("n"),
                                         F.col("tree").alias("idx"), "digest", "reached"), span)
    stored = own.unionByName(above).withColumn("copies", F.ceil(F.col("reached") / most))
    is_top = F.col("tree") == TOP
    linked = (stored
              .withColumn("up_tree", F.when(~F.col("final"), F.col("tree")).when(~is_top, F.lit(TOP).cast("long")))
              .withColumn("up_base", F.when(~F.col("final"), F.col("base") + 1).when(~is_top, F.lit(0)))
              .withColumn("up_idx", F.when(~F.col("final"), F.col("block")).when(~is_top, F.col("tree"))))
    # only rows in several copies need to be looked up; there are at most a few per `most` leaves
    shared = stored.where("copies > 1").select(F.col("tree").alias("up_tree"), F.col("base").alias("up_base"),
                                               F.col("block").alias("up_block"), F.col("copies").alias("up_copies"))
    linked = (linked.withColumn("up_block", F.floor(F.col("up_idx") / FAN ** span))
              .join(shared, ["up_tree", "up_base", "up_block"], "left")
              .withColumn("up_copies", F.coalesce("up_copies", F.lit(1).cast("long")))
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))))
    return placed, materialise(linked.select("tree", "base", "block", "copy", "levels", "up_tree", "up_base", "up_idx", "up_copies"))


#: One step folds the levels of a stored row. A run's nodes before and after ours are its siblings.
_LEFT = "aggregate(slice(l, a.at - a.at % {fan} + 1, a.at % {fan}), X'', (s, x) -> concat(s, x))"
_RIGHT = "aggregate(slice(l, a.at + 2, {fan} - 1 - a.at % {fan}), X'', (s, x) -> concat(s, x))"
CLIMB = f"""
WITH RECURSIVE climb(key, leaf, tree, base, idx, copy, node, proof, subroot, root) AS (
  SELECT key, leaf, tree, 0, idx, 0L, found, X'', CAST(NULL AS BINARY), CAST(NULL AS BINARY) FROM {{leaves}}
  UNION ALL
  SELECT key, leaf, up_tree, up_base, up_idx, pmod(xxhash64(key, leaf), up_copies), up.node, up.proof,
    coalesce(subroot, CASE WHEN up_tree = {{top}} THEN own END), CASE WHEN up_tree IS NULL THEN own END
  FROM (
    SELECT c.key, c.leaf, c.subroot, n.up_tree, n.up_base, n.up_idx, n.up_copies, element_at(element_at(n.levels, -1), 1) AS own,
      aggregate(slice(n.levels, 1, size(n.levels) - 1),
        named_struct('node', c.node, 'at', CAST(c.idx % {{width}} AS INT), 'proof', c.proof),
        (a, l) -> named_struct(
          'node', unhex(sha2(lower(hex(concat({_LEFT}, a.node, {_RIGHT}))), 256)),
          'at', CAST(a.at DIV {{fan}} AS INT),
          'proof', concat(a.proof, {_LEFT}, {_RIGHT}))) AS up
    FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.base = n.base AND c.idx DIV {{width}} = n.block AND c.copy = n.copy))
SELECT key, leaf, subroot, root, proof, node AS folded FROM climb WHERE root IS NOT NULL
"""
#: Settings of a recursive query here: its rows are as many as the leaves, its levels a logarithm of them.
LIMITS = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "100"}


def climb(leaves: DataFrame, nodes: DataFrame, span: int = SPAN) -> DataFrame:
    """(key, leaf, subroot, root, proof, folded) for ``leaves`` (key, leaf,
    found, tree, idx): ``found`` is the hash that is folded with the stored
    siblings, ``proof`` the siblings (32 bytes each) from the leaf's level to
    the root, left to right; all digests are binary."""
    spark = leaves.sparkSession
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    try:
        return materialise(spark.sql(CLIMB, leaves=leaves, nodes=nodes, top=TOP, fan=FAN, width=FAN ** span))
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def verify(docs: DataFrame, tampered: Column, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
           fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), span: int = SPAN,
           most: int = LEAVES) -> DataFrame:
    """Manifest of ``docs`` and the check of each row against it: (``id_col``,
    leaf, subroot, root, proof, folded, verified), one row per row of ``docs``.

    A leaf hashes ``fields`` (a null is ``-``). ``tampered`` is the text found
    at checking time, an expression over the columns of ``docs``; the hash of
    the row with that text is folded up with the stored siblings and must come
    out at ``root``. Leaves of a source ascend by id, null first, equal ids by
    leaf digest; repeated rows are leaves of their own, null sources form one
    source, the first. An empty table gives no rows; other columns are not
    read. Texts of any length are hashed where they lie.
    """
    f = {n: F.col(f"`{n}`") for n in (id_col, source_col, text_col, *fields)}
    leaf = leaf_digest(*[f[n] for n in fields])
    found = leaf_digest(*[tampered if n == text_col else f[n] for n in fields])
    leaves = docs.select(f[id_col].alias("key"), f[source_col].cast("string").alias("source"), leaf.alias("leaf"),
                         F.when(tampered.eqNullSafe(f[text_col]), leaf).otherwise(found).alias("found"))
    placed, nodes = build(leaves, ["key", "leaf"], span, most)
    out = climb(placed.select("key", "leaf", "found", "tree", "idx"), nodes, span)
    return out.withColumn("verified", F.col("folded") == F.col("root")).withColumnRenamed("key", id_col)
