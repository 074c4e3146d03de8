"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

A text is a set of hashed n-grams: byte 3-grams, words, word pairs, and up to
three words in a row that each repeat the word before. Each indicator is scaled
by the log-count ratio of its n-gram between the classes, rows are brought to
length one, and a linear model with hinge loss is fitted by dual coordinate
descent (Hsieh et al., 2008). Platt scaling turns margins into probabilities at
the classes' true shares. The model is fitted on a bounded, documented sample
of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shoreline.llm.common import whole_row
from shoreline.llm.sampling import one_each, per_class

BITS = 18
SIZE = 1 << BITS
#: Bytes looked at together; bounds a task's arrays whatever the text's length.
BLOCK = 1 << 20


def ngrams(text: str | None) -> np.ndarray:
    """The distinct hashed n-grams of a text (sorted)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = []
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    for at in range(0, max(0, len(b) - 2), BLOCK):
        x = b[at:at + BLOCK + 2]
        gram = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
        found.append(np.unique(gram * np.uint32(2654435761) >> np.uint32(32 - BITS)))
    words = raw.split()
    if words:
        for at in range(0, len(words), BLOCK):
            part = words[at:at + BLOCK + 1]
            h = np.fromiter(map(zlib.crc32, part), dtype=np.uint32, count=len(part))
            found.append(np.unique(h * np.uint32(2246822519) >> np.uint32(32 - BITS)))
            pair = h[:-1] * np.uint32(3266489917) + h[1:]
            found.append(np.unique(pair * np.uint32(668265263) >> np.uint32(32 - BITS)))
        runs = run = 0
        for a, b2 in zip(words, words[1:]):
            run = run + 1 if a == b2 else 0
            if run > runs:
                runs = run
                if runs == 3:
                    break
        found.append(np.arange(runs, dtype=np.uint32) * np.uint32(97) + np.uint32(11))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.uint32)


class NbSvm:
    """Weights per hashed n-gram, bias, and the two numbers of Platt scaling."""

    def __init__(self, weights: np.ndarray, scale: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.scale, self.bias, self.slope, self.shift = weights, scale, bias, slope, shift

    def margin(self, grams: np.ndarray) -> float:
        if not len(grams):
            return self.bias
        r = self.scale[grams]
        norm = float(np.sqrt(r @ r))
        return self.bias + (float(r @ self.weights[grams]) / norm if norm else 0.0)

    def score(self, grams: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(grams) + self.shift, -50, 50))))


def fit(rows: list[np.ndarray], y: np.ndarray, prior: float, alpha: float = 1.0, c: float = 1.0,
        epochs: int = 30, seed: int = 7) -> NbSvm:
    """``y`` is 1 or 0; ``prior`` the share of 1 among all labelled rows."""
    counts = np.full((2, SIZE), alpha)
    for g, k in zip(rows, y):
        counts[k, g] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = []
    for g in rows:
        r = ratio[g]
        norm = np.sqrt(r @ r)
        values.append(r / norm if norm else r)
    # the bias is a further feature of value 1, so a row's squared length is at most 2
    sign = np.where(np.asarray(y) == 1, 1.0, -1.0)
    n = len(rows)
    upper = c * np.where(sign > 0, n / (2 * max(1, (sign > 0).sum())), n / (2 * max(1, (sign < 0).sum())))
    w, bias, dual = np.zeros(SIZE), 0.0, np.zeros(n)
    length = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(n):
            g, v = rows[i], values[i]
            grad = sign[i] * (w[g] @ v + bias) - 1
            new = min(max(dual[i] - grad / length[i], 0.0), upper[i])
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                dual[i] = new
                w[g] += step * v
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    margins = np.array([w[g] @ v + bias for g, v in zip(rows, values)])
    slope, shift = _platt(margins, sign, prior)
    return NbSvm(w.astype(np.float32), ratio.astype(np.float32), float(bias), slope, shift)


def _platt(margins: np.ndarray, sign: np.ndarray, prior: float) -> tuple[float, float]:
    """Weighted logistic fit by Newton steps; targets smoothed as Platt advises."""
    pos, neg = max(1, (sign > 0).sum()), max(1, (sign < 0).sum())
    prior = min(max(prior, 0.01), 0.99)
    weight = np.where(sign > 0, prior / pos, (1 - prior) / neg)
    target = np.where(sign > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.array([1.0, np.log(prior / (1 - prior))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-4 * np.array([theta[0], 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = [ngrams(t.as_py()).astype(np.int32) for t in batch.column("_text")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("_id", "label", "_h")), pa.array(grams, pa.list_(pa.int32()))],
                                         ["_id", "label", "_h", "grams"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", usable: Column | None = None, per_label: int = 2500) -> NbSvm | None:
    """Model from up to ``per_label`` labelled documents of each class (smallest
    id hashes) among the rows of ``labels`` where ``usable`` holds; None if no
    such document exists. Labels that are null or not 0 or 1 are not used; an id
    enters once per class, with one of its rows if it has several."""
    label = F.col(f"`{label_col}`").cast("int")
    rows = labels.where(label.isin(0, 1)) if usable is None else labels.where(label.isin(0, 1) & usable)
    chosen, shares = per_class(rows, id_col, label, per_label)
    chosen = chosen.withColumnRenamed(id_col, "_id")
    # at most 2 * per_label ids: a bounded broadcast
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = dict(texts.dtypes)["_id"]
    made = (texts.join(F.broadcast(chosen), "_id").select("_id", "label", F.xxhash64("_text").alias("_h"), "_text")
            .mapInArrow(_grams, f"_id {kind}, label int, _h long, grams array<int>"))
    got = one_each(made, "_id", "label").select("label", "grams").toArrow()
    if not got.num_rows:
        return None
    y = got.column("label").to_numpy()
    rows = [np.asarray(g.values.to_numpy(), dtype=np.int64) for g in got.column("grams")]
    # collected in no fixed order: sort, so that the fit is repeatable
    order = sorted(range(len(rows)), key=lambda i: (int(y[i]), len(rows[i]), rows[i].tobytes()))
    return fit([rows[i] for i in order], y[order], shares.get(1, 0) / max(1, sum(shares.values())))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(ngrams(t.as_py())) if model else 0.0 for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in batch.schema.names if n != "_text"), pa.array(scores, pa.float64())],
                [*(n for n in batch.schema.names if n != "_text"), "score"])
    return run


def score(docs: DataFrame, model: NbSvm | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """(``id_col``, score, predicted) per row; null and empty texts are scored by
    the bias alone; without a model every score is 0. Ids may be null or
    repeated; an empty table gives no rows; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = dict(narrow.dtypes)["_id"]
    return (narrow.mapInArrow(_score(shared), f"_id {kind}, score double")
            .withColumnRenamed("_id", id_col).withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: NbSvm | None, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``;
    without a model nothing has been judged, and all rows stay."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            good = [m.score(ngrams(t.as_py())) >= threshold for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(good, pa.bool_()))], ["row"])
    # the row travels as one struct, so that no name can clash
    packed = docs.select(whole_row(docs), F.col(f"`{text_col}`").alias("text"))
    return packed.mapInArrow(run, packed.select("row").schema).select("row.*")
