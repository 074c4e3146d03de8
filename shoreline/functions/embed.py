"""Offline text embedding: hashed term counts, L2-normalised.

Tokens are maximal runs of letters and digits, lower-cased. Each token goes
to bucket ``int(md5(token)[:8], 16) mod dim``; the vector is the bucket counts
divided by their L2 norm. The same buckets can be computed in SQL
(``md5`` + hex prefix), which is how the results are checked.

The embedder is an Arrow-batched ``pandas_udf``: each batch tokenises its
texts, hashes each distinct token once, and builds the count matrix with
NumPy; it is a per-row helper inside a Spark stage, not a separate engine.
Another model can be plugged in as a function over a list of texts, or as a
``pandas_udf`` (``Series[str] -> Series[list[float]]``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Embedding length of the asset tables and the token pattern.
DEFAULT_DIM = 768
#: Texts embedded together; an Arrow batch holds many more, whose vectors would be held at once.
EMBED_ROWS = 256
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
_SPLIT = regex.compile(TOKEN_SPLIT)


def tokens(text: str) -> list[str]:
    return [t for t in _SPLIT.split(text.lower()) if t]


def bucket(token: str, dim: int = DEFAULT_DIM) -> int:
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % dim


def embed_texts(texts, dim: int = DEFAULT_DIM) -> list[np.ndarray | None]:
    """Embed a batch of texts; blank or token-less texts give None."""
    cache: dict[str, int] = {}
    out: list[np.ndarray | None] = []
    for text in texts:
        if text is None or not isinstance(text, str) or not text.strip():
            out.append(None)
            continue
        toks = tokens(text)
        if not toks:
            out.append(None)
            continue
        ids = np.empty(len(toks), dtype=np.int64)
        for i, t in enumerate(toks):
            b = cache.get(t)
            if b is None:
                b = cache[t] = bucket(t, dim)
            ids[i] = b
        counts = np.bincount(ids, minlength=dim).astype(np.float64)
        out.append(counts / np.sqrt(np.dot(counts, counts)))
    return out


def embed_text(text: str, dim: int = DEFAULT_DIM) -> list[float] | None:
    """One text on the driver (a query string); same model as the UDF."""
    v = embed_texts([text], dim)[0]
    return None if v is None else v.tolist()


def model_udf(model: Callable[[list[str | None]], list]):
    """A model over a batch of texts as a ``pandas_udf`` returning
    ``array<double>``, ``EMBED_ROWS`` texts at a time. If a batch fails its
    texts are tried one by one, and those that fail alone get NULL; the others
    go on."""

    def embedded(batch: list[str | None]) -> list:
        try:
            return list(model(batch))
        except Exception:
            vectors = []
            for text in batch:
                try:
                    vectors.append(list(model([text]))[0])
                except Exception:
                    vectors.append(None)
            return vectors

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for at in range(0, len(texts), EMBED_ROWS):
                yield pd.Series(embedded(texts.iloc[at:at + EMBED_ROWS].tolist()), dtype=object)

    # Flagged non-deterministic so Catalyst never copies the call into a
    # pushed-down filter (``embedding IS NOT NULL``) and evaluates the model
    # twice per row.
    return _embed.asNondeterministic()


def hashed_embedding(dim: int = DEFAULT_DIM):
    """The offline model as a vectorised UDF."""
    return model_udf(lambda texts: embed_texts(texts, dim))


def embed_column(text: Column, dim: int = DEFAULT_DIM, model=None) -> Column:
    """``model`` is a function over a batch of texts (guarded by
    ``model_udf``), or a ``pandas_udf``, which handles its own failures."""
    if model is not None and not hasattr(model, "returnType"):
        model = model_udf(model)
    return (model or hashed_embedding(dim))(text)


def sparse_weights(vector: Column) -> Column:
    """``array<struct<bucket:int, weight:double>>`` of the non-zero entries,
    for exploding a dense vector into rows without a shuffle."""
    indexed = F.transform(vector, lambda x, i: F.struct(i.alias("bucket"), x.alias("weight")))
    return F.filter(indexed, lambda s: s["weight"] != 0)
