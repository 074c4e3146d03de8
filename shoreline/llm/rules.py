"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per document: counts over words, symbols, repeated lines and repeated 8-word
windows. Across documents: lines are normalised (lower case, digits to 0,
white space to one blank) and hashed; a line that more than ``max_docs``
distinct documents of one host hold is removed, and a document that keeps less
than ``min_left`` of its words' characters is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoreline.llm.common import let, materialise

WORD = "[^\\x20\\x09-\\x0D]+"
WINDOW = 8


def _repeated_windows(words: Column) -> Column:
    """Words that lie in a ``WINDOW``-word window found at least twice."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(at: Column) -> Column:
        # ascending window starts: each covers WINDOW words less its overlap with the next
        return F.aggregate(at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
                           lambda s, p: F.struct(p.alias("last"),
                                                 (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).cast("long").alias("n")),
                           lambda s: s["n"])

    def starts(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        last = F.size(h) - 1

        def twins(s: Column) -> Column:
            return F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                            | ((k < last) & (F.get(s, k + 1)["h"] == x["h"])))
        return F.sort_array(F.transform(let(ranked, twins), lambda x: x["i"]))

    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                  .otherwise(covered(starts(h))))
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(counted)


def line_key(line: Column) -> Column:
    """Hash of a line in lower case, digits as 0, white space runs as one blank."""
    return F.xxhash64(F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, "[\\x20\\x09-\\x0D]+", " "))),
                                                        "[0-9]", "0"), "^ | $", ""))


def base_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long) and base_failed. Null text: no words."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_windows(w).alias("n_repeat_words")))
    out = (docs.withColumn("_c", counts)
           .withColumn("n_words", F.col("_c.n_words"))
           .withColumn("word_chars", F.length(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")).cast("long"))
           .withColumn("n_symbols", F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"))
           .withColumn("n_dup_lines", let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")))
           .withColumn("n_repeat_words", F.col("_c.n_repeat_words")).drop("_c"))
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def line_frequency_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         host: Column | None = None, max_docs: int = 20, min_left: float = 0.5,
                         keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: ``id_col``, the columns of ``base_rules``,
    ``n_removed_lines`` and ``removed_chars`` (word characters on removed
    lines), ``kept``; with ``keep_text`` also ``kept_text`` (the lines left).

    ``host`` defaults to the column ``source``; rows without host form one
    host. Documents are told apart by id: rows that repeat an id are one
    document in the counts and each gets its own row. A null id counts as one
    document. Null and empty texts have no lines and fail the base rules. An
    empty table gives no rows; other columns, also of clashing names, are not
    read.
    """
    host = F.col("source") if host is None else host
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), host.alias("_host"),
                         F.xxhash64(F.col(f"`{id_col}`"), text, host).alias("_row"))
    raw = F.filter(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    each = F.transform(raw, lambda x: F.struct(line_key(x).alias("key"),
                                               F.length(F.regexp_replace(x, "[\\x20\\x09-\\x0D]+", "")).alias("chars")))
    # One row per line; rows of the input that are alike in id, text and host count once.
    lines = materialise(narrow.select("_id", "_host", "_row", F.posexplode(each).alias("pos", "l"))
                        .select("_row", "pos", F.xxhash64("_host", F.col("l.key")).alias("key"), "_id",
                                F.col("l.chars").cast("long").alias("chars"))
                        .dropDuplicates(["_row", "pos"]))
    docs_of = lines.groupBy("key", F.xxhash64("_id").alias("_d")).agg(F.lit(1).alias("one")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_docs"))
    frequent = materialise(docs_of.where(F.col("n_docs") > max_docs).select("key"))
    removed = (lines.join(frequent, "key").groupBy("_row")
               .agg(F.count(F.lit(1)).alias("n_removed_lines"), F.sum("chars").alias("removed_chars"),
                    *([F.collect_set("key").alias("_gone")] if keep_text else [])))
    out = base_rules(narrow, "_text")
    out = (out if keep_text else out.drop("_text")).join(removed, "_row", "left").fillna(0, ["n_removed_lines", "removed_chars"])
    left = F.col("word_chars") - F.col("removed_chars")
    out = out.withColumn("kept", ~F.col("base_failed") & (left >= min_left * F.col("word_chars")))
    if keep_text:
        out = out.withColumn("kept_text", F.array_join(F.filter(
            F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1),
            lambda x: ~F.coalesce(F.array_contains("_gone", F.xxhash64(F.col("_host"), line_key(x))), F.lit(False))), "\n"))
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "n_removed_lines", "removed_chars", "kept", *(["kept_text"] if keep_text else []))
