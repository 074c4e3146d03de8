"""Samples bounded by rows, very long texts, and stages with columns of any name."""

import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shoreline.llm import attribution, bpe, langid, linededup, mixing, quality, rules, sampling, simhash

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RUNS = {"blanks": " " * 2_000_000 + "a", "line ends": "\n" * 2_000_000, "letters": "a" * 2_000_000, "han": "中" * 2_000_000}


@pytest.fixture(scope="module")
def long_texts(spark):
    rows = [(i, RUNS[k], "en", "s") for i, k in enumerate(RUNS)] + [(9, "plain words of a short text here", "en", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5).cache()


def test_op8_long_runs(long_texts):
    out = attribution.token_counts(long_texts, RANKS, public_tokenizers.PATTERN, fields=("source", "text"), lines=True)
    got = {r.doc_id: (r.n, r.s) for r in out.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("s")).collect()}
    from shoreline.llm.bytebpe import Codec
    codec = Codec(RANKS, public_tokenizers.PATTERN)
    for i, k in enumerate(RUNS):
        assert got[i] == (len(codec.encode("s\n" + RUNS[k])), 2 + RUNS[k].count("\n")), k


def test_op8_pieces_equal_library():
    enc, lengths = attribution.load_encoding(RANKS, public_tokenizers.PATTERN)
    for text in ("a  b\n\n c's é中\U0001f600 12", " " * 50 + "x", ""):
        assert attribution._encode_pieces(text, enc).tolist() == enc.encode_ordinary(text)


def test_op7_long_words():
    coder, own = bpe.ChunkCoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for word in ("a" * 30_000, "abcdefghij" * 3_000, "é" * 15_000, "x" * bpe.TRIE_SYMBOLS, "x" * (bpe.TRIE_SYMBOLS + 1), "the" * 4_000 + "s"):
        want = own.encode(word, add_special_tokens=False).ids
        assert [int(i) for i in coder.encode_batch([word])[0][0].split()] == want
    began = time.time()
    coder.encode_batch(["q" * 800_000])
    assert time.time() - began < 10


@pytest.mark.parametrize("run", [
    lambda d: langid.predict(d, langid.BiGru(["en", "fr"])), lambda d: simhash.near_duplicates(d),
    lambda d: linededup.apply_bitmaps(d, linededup.line_keep_bitmaps(d)), lambda d: rules.line_frequency_rules(d),
    lambda d: bpe.encode_documents(d, WORD_BPE), lambda d: quality.score(d, None), lambda d: mixing.memberships(d, mixing.Softmax(
        ["a", "b"], np.zeros((len(mixing.features("x")), 2)), np.zeros(2)))],
    ids=["langid", "simhash", "lines", "rules", "bpe", "quality", "mixing"])
def test_operators_take_megabyte_texts(long_texts, run):
    assert sorted(r.doc_id for r in run(long_texts).select("doc_id").collect()) == [0, 1, 2, 3, 9]


# ------------------------------------------------------------- samples
@pytest.fixture(scope="module")
def hot(spark):
    """One id on a third of 9,000 rows."""
    d = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("doc_id"),
                                 F.concat(F.lit("some words number "), F.col("id").cast("string")).alias("text"),
                                 F.when(F.col("id") % 2 == 0, "en").otherwise("fr").alias("lang"))
    return d.repartition(6).cache()


def test_sample_counts_an_id_once(hot):
    got, sizes = sampling.per_class(hot, "doc_id", F.col("lang"), 100)
    rows = got.collect()
    assert sizes == {"en": 4500, "fr": 4500} and len(rows) == 200 == len({(r.doc_id, r.label) for r in rows})
    only = hot.where("doc_id = 7")
    assert sorted(tuple(r) for r in sampling.per_class(only, "doc_id", F.col("lang"), 100)[0].collect()) == [(7, "en"), (7, "fr")]


def test_ranked_rows_are_few(hot, spark, monkeypatch):
    """What is ranked stays near SPARE times the sample, also with a hot id."""
    seen = []
    plain = sampling.F.row_number
    monkeypatch.setattr(sampling.F, "row_number", lambda: seen.append(1) or plain())
    got, _ = sampling.per_class(hot, "doc_id", F.col("lang"), 50)
    plan = got.count()
    assert plan == 100 and seen
    ids = {r.doc_id for r in got.collect()}
    assert len(ids) >= 95


def test_fits_take_bounded_rows(hot, spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(langid, "fit", lambda parts, langs: taken.setdefault("langid", (parts, langs)) and langid.BiGru(["en", "fr"]))
    monkeypatch.setattr(quality, "fit", lambda rows, y, prior: taken.setdefault("quality", (rows, y)))
    monkeypatch.setattr(mixing, "fit_softmax", lambda x, names, shares: taken.setdefault("mixing", (x, names)))
    langid.train(hot, per_lang=40)
    assert len(taken["langid"][0]) == 80 and all(0 < len(p) <= langid.WINDOW for p in taken["langid"][0])
    labels = hot.select("doc_id", (F.col("lang") == "en").cast("int").alias("quality"))
    quality.train(hot.select("doc_id", "text"), labels, per_label=30)
    assert len(taken["quality"][0]) == 60
    mixing.train(hot, hot.select("doc_id", F.col("lang").alias("domain")), per_domain=20)
    assert len(taken["mixing"][0]) <= 40


def test_windows_cover_whole_texts(spark):
    text = "".join(f"{i:07d}|" for i in range(1000))
    df = spark.createDataFrame([(1, text, "en"), (2, text, "en"), (3, "é" * 100, "fr"), (4, "", "fr"), (5, None, "fr")], "doc_id long, text string, lang string")
    got = sampling.windows_per_class(df, "text", F.col("lang"), 10_000, 128).collect()
    assert sorted(bytes(r.piece) for r in got if r.label == "en") == sorted({text.encode()[a:a + 128] for a in range(0, 8000, 128)})
    assert sorted(bytes(r.piece) for r in got if r.label == "fr") == sorted([("é" * 100).encode()[:128], ("é" * 100).encode()[128:]])


def test_resample_in_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_BYTES", 50)
    df = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(40)] + [(99, None)], "doc_id long, text string").coalesce(1)
    model = mixing.Softmax(["a"], np.zeros((len(mixing.features("x")), 1)), np.zeros(1))
    out = mixing.resample(df, model, mixing.Rates([[2.0]], 1.0))
    assert out.groupBy("doc_id").count().agg(F.min("count"), F.max("count"), F.count("count")).first()[:] == (3, 3, 41)


# -------------------------------------------------------------- stages
@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_of_any_name(spark, tmp_path, name):
    rows = [(i, f"some good text with many words number {i % 5}\nand a shared line of text", "en" if i % 2 else "fr", f"s{i % 3}") for i in range(12)]
    rows += [(None, None, None, None), (3, "", "de", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    odd = ["_n_lines", "_n_dropped", "a.b", "row", "key", "label", "u", "_id", "_text", "_h", "doc", "rid", "keep", "x`y", "domain", "score"]
    df = df.withColumns({c: F.lit(i) for i, c in enumerate(odd)})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, df, str(tmp_path))
    if name == "bpe":
        assert out.count() == len(rows)
        return
    assert out.columns == df.columns
    got = out.collect()
    assert got and all(tuple(r)[5:] == tuple(range(len(odd))) for r in got)
    empty = dict(corpus_pipeline.STAGES)[name](spark, df.limit(0), str(tmp_path))
    assert empty.columns == df.columns and empty.count() == 0
