"""Mixing to target weights with soft domain membership.

A classifier fitted on a labelled table gives every document a probability per
domain. Document rates ``x >= 0`` are then fitted so that the expected tokens
of each domain, the sum of rate * tokens * probability, match the targets in
least squares: projected gradient descent from rate one, in the norm weighted
by tokens and with each domain's step scaled by its tokens. (The scaled system
is a matrix of non-negative rows that add up to one, so a step of one
converges; longer steps follow Barzilai and Borwein, 1988.) A document's rate is a fold over the steps taken so far, computed
from its own probabilities; a round is one aggregate over a narrow table, and
only one number per domain comes back to the driver.

By default no rate may fall below one: documents are repeated, not dropped. The
descent projects on ``x >= 1`` then, and the budget begins at the smallest total
at which no domain must be cut. Documents that belong to several domains can
make that too small, so every few rounds it rises to what the fullest domain
holds, by a tenth at most. What the targets still miss is reported.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from shoreline.llm.common import materialise, whole_row
from shoreline.llm.sampling import one_each, per_class

#: Rounds without progress after which the fit ends; bound of the spectral step length.
STALLED, LONGEST_STEP = 10, 50.0
#: Without a budget: rounds between two rises of it, and by how much at most.
RISE_AFTER, RISE = 5, 1.1
#: Share of all expected tokens by which a target may be missed unreported.
NOTABLE = 1e-3
FEATURES = 4096
BLOCK = 1 << 22


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs; zeros without a pair."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    total = np.zeros(FEATURES)
    for at in range(0, max(0, len(b) - 1), BLOCK):
        x = b[at:at + BLOCK + 1].astype(np.uint32)
        pair = (x[:-1] << np.uint32(8) | x[1:]) * np.uint32(2654435761) >> np.uint32(20)
        total += np.bincount(pair, minlength=FEATURES)
    return np.sqrt(total / max(1.0, total.sum()))


class Softmax:
    """Multinomial logistic regression: ``weights`` (FEATURES, K), ``bias`` (K)."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def posterior(self, text: str | None) -> np.ndarray:
        z = features(text) @ self.weights + self.bias
        p = np.exp(z - z.max())
        return p / p.sum()


def fit_softmax(x: np.ndarray, y: list[str], shares: dict[str, float], rounds: int = 200, l2: float = 1e-4) -> Softmax:
    """Adam on the whole sample, classes weighted to their true ``shares``."""
    names = sorted(set(y))
    index = np.array([names.index(k) for k in y])
    counts = np.bincount(index, minlength=len(names))
    weight = np.array([shares[n] for n in names])[index] / counts[index]
    weight /= weight.sum()
    w, b = np.zeros((x.shape[1], len(names))), np.zeros(len(names))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for step in range(1, rounds + 1):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(index)), index] -= 1
        p *= weight[:, None]
        for k, (value, grad) in enumerate(((w, x.T @ p + l2 * w), (b, p.sum(axis=0)))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Softmax(names, w, b)


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          domain_col: str = "domain", per_domain: int = 400) -> Softmax | None:
    """Classifier from up to ``per_domain`` documents of each domain (smallest
    id hashes) of the table ``labelled`` (``id_col``, ``domain_col``); None if
    no labelled document has a text. Of rows that share an id one is learnt
    from; features are made where the texts lie, one vector of fixed length a
    row reaches the driver."""
    domain = F.col(f"`{domain_col}`").cast("string")
    chosen, shares = per_class(labelled, id_col, domain, per_domain)
    chosen = chosen.select(F.col(f"`{id_col}`").alias("_id"), "label").distinct()
    # at most per_domain ids a domain: a bounded broadcast
    texts = (docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).where("_text IS NOT NULL")
             .join(F.broadcast(chosen), "_id").withColumn("_h", F.xxhash64("_text")))
    kind = dict(texts.dtypes)["_id"]
    made = texts.select("_id", "label", "_h", "_text").mapInArrow(_made, f"_id {kind}, label string, _h long, at binary, x binary")
    got = one_each(made, "_id", "label").select("label", "at", "x").toArrow()
    if not got.num_rows:
        return None
    # collected in no fixed order: sort, so that the fit is repeatable
    rows = sorted(zip(*(got.column(n).to_pylist() for n in ("label", "at", "x"))))
    del got
    dense = np.zeros((len(rows), FEATURES))
    for i, (_, at, x) in enumerate(rows):
        dense[i, np.frombuffer(at, dtype=np.uint16)] = np.frombuffer(x)
    return fit_softmax(dense, [r[0] for r in rows], shares)


def _made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, values = [], []
        for t in batch.column("_text"):  # only what is not zero: positions and values
            x = features(t.as_py())
            found = np.flatnonzero(x)
            at.append(found.astype(np.uint16).tobytes())
            values.append(x[found].tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("_id", "label", "_h")), pa.array(at, pa.binary()),
                                          pa.array(values, pa.binary())], ["_id", "label", "_h", "at", "x"])


def _members(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([len((t or "").encode("utf-8", "surrogatepass").split()) for t in texts], pa.int64()),
                 pa.array([model.posterior(t) for t in texts], pa.list_(pa.float64()))], ["_id", "n_tokens", "p"])
    return run


def memberships(docs: DataFrame, model: Softmax, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, p): words and domain probabilities per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = dict(narrow.dtypes)["_id"]
    return (narrow.mapInArrow(_members(shared), f"_id {kind}, n_tokens long, p array<double>")
            .withColumnRenamed("_id", id_col))


class Rates:
    """A document's rate: the fold over the descent's ``steps``, never under
    ``least``. ``missed``: by domain, the target less the expected share."""

    def __init__(self, steps: list[list[float]], least: float = 0.0, missed: dict[str, float] | None = None):
        self.steps, self.least, self.missed = steps, least, missed or {}

    def of(self, p: np.ndarray) -> float:
        x = 1.0
        for s in self.steps:
            x = max(self.least, x + float(p @ np.asarray(s)))
        return x

    def column(self, p: Column, k: int) -> Column:
        """``of`` as a column over the array ``p`` of ``k`` probabilities."""
        if not self.steps:
            return F.lit(1.0)
        history = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in self.steps])
        return F.aggregate(history, F.lit(1.0), lambda x, s: F.greatest(
            F.lit(self.least), x + sum((p[i] * s[i] for i in range(1, k)), p[0] * s[0])))


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], budget: float | None = None,
              tolerance: float = 1e-6, rounds: int = 60, keep: bool = False) -> tuple[Rates, dict[str, float]]:
    """(rates, expected tokens per domain) of the fit.

    ``targets`` are weights (normalised here; domains not named get 0). The
    ``budget`` is the total of tokens to expect. Without one, no rate is under
    one, so that every document stays, and the budget begins at the smallest at
    which no domain must be cut and rises (see above) while that is too small;
    or it is the tokens there are if a domain that has some is to have none.
    With ``keep`` every document stays also then: domains not named keep their
    present share (the targets divide the rest), no rate is under one, and
    ``budget`` must be None.
    Stops when no domain is off by more than
    ``tolerance`` of the budget, when ``STALLED`` rounds bring the residual down
    by less than a hundredth (the targets can't be met), or after ``rounds``;
    the best round counts. Shares missed by more than ``NOTABLE`` are warned of.
    A domain without tokens can't be reached and is left out of the fit, which
    is warned of if it has a target; ``missed`` is against the targets as given.
    """
    if keep and budget is not None:
        raise ValueError("a budget can cut documents: give either budget or keep")
    k = len(domains)
    p = F.col("p")

    def expected(rates: Rates) -> np.ndarray:
        x = members.select("n_tokens", "p", rates.column(p, k).alias("x"))
        row = x.agg(*[F.sum(F.col("n_tokens") * F.col("x") * p[i]).alias(f"e{i}") for i in range(k)]).first()
        return np.array([v or 0.0 for v in row])

    now = expected(Rates([]))
    start = now
    some = start > 0
    asked = {d: max(0.0, float(v)) for d, v in targets.items()}
    lacking = sorted(d for d, v in asked.items() if v > 0 and d not in set(np.array(domains, dtype=object)[some]))
    if lacking:
        warnings.warn(f"mixing: targets without any tokens of their domain: {', '.join(lacking)}", stacklevel=2)
    weight = np.array([asked.get(d, 0.0) for d in domains]) * some
    steps: list[list[float]] = []
    if not weight.sum():
        return Rates(steps, missed=_missed(asked, domains, now)), dict(zip(domains, now.tolist()))
    other = np.array([d not in asked for d in domains]) * start / start.sum() * keep
    weight = weight / weight.sum() * (1 - other.sum()) + other
    uncut = keep or budget is None and bool((weight[some] > 0).all())
    least = 1.0 if uncut else 0.0
    if budget is None:
        meant = weight > 0
        budget = float((start[meant] / weight[meant]).max()) if uncut else float(start.sum())
    length, best = 1.0, (np.inf, 0, now)
    for number in range(rounds + 1):
        if uncut and number and number % RISE_AFTER == 0:
            budget = max(budget, min(float((now[meant] / weight[meant]).max()), RISE * budget))
        off = weight * budget - now
        far = float(np.linalg.norm(off)) / budget
        if far < 0.99 * best[0]:
            best = (far, len(steps), now)
        if np.abs(off).max() <= tolerance * budget or len(steps) - best[1] >= STALLED or number == rounds:
            break
        step = length * off / np.where(some, start, np.inf)
        steps.append(step.tolist())
        before = now
        now = expected(Rates(steps, least))
        gained = now - before
        square = float(gained @ (gained / np.where(some, start, np.inf)))
        length = min(max(float(step @ gained) / square, 1.0), LONGEST_STEP) if square > 0 else 1.0
    if far > best[0]:
        _, kept, now = best
        steps = steps[:kept]
    missed = _missed(asked, domains, now, dict(zip(domains, other.tolist())))
    if max(map(abs, missed.values())) > NOTABLE:
        warnings.warn("mixing: expected shares miss their targets by "
                      + ", ".join(f"{d} {v:+.4f}" for d, v in missed.items()), stacklevel=2)
    return Rates(steps, least, missed), dict(zip(domains, now.tolist()))


def _missed(asked: dict[str, float], domains: list[str], now: np.ndarray, other: dict[str, float] | None = None) -> dict[str, float]:
    """By domain, the share asked for less that of the tokens ``now``; ``other``
    has the shares to keep of domains that ``asked`` does not name."""
    total, kept = sum(asked.values()) or 1.0, other or {}
    rest = 1 - sum(kept.values())
    has = dict(zip(domains, (now / max(1.0, now.sum())).tolist()))
    return {d: (asked[d] / total * rest if d in asked else kept.get(d, 0.0)) - has.get(d, 0.0)
            for d in [*domains, *(d for d in asked if d not in has)]}


def copies(rate: Column, *key: Column) -> Column:
    """Whole copies for a rate: its integer part, and one more with the
    probability of the rest, decided by a hash of ``key``."""
    u = (F.xxhash64(*key).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        domain_col: str = "domain", budget: float | None = None, keep: bool = False) -> tuple[DataFrame, Softmax | None, Rates]:
    """((``id_col``, n_tokens, domain, posterior, rate, copies) per row, the
    classifier, the fitted rates).

    ``domain`` is the likeliest domain. Null and empty texts have no tokens and
    get a rate like any other. Ids may be null or repeated: each row has its
    own rate, equal rows equal ones. ``budget`` and ``keep`` as for ``fit_rates``:
    with ``keep`` no rate is under one, whatever domains there are. Without any labelled text every rate is
    one and the domain null. An empty table gives no rows, other columns are
    not read.
    """
    model = train(docs, labelled, id_col, text_col, domain_col)
    if model is None:
        out = docs.select(F.col(f"`{id_col}`"), F.size(F.regexp_extract_all(
            F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"), 0)).cast("long").alias("n_tokens"))
        return (out.withColumn("domain", F.lit(None).cast("string")).withColumn("posterior", F.lit(None).cast("double"))
                .withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1).cast("long"))), None, Rates([])
    members = materialise(memberships(docs, model, id_col, text_col))
    rates, _ = fit_rates(members, model.domains, targets, budget, keep=keep)
    p = F.col("p")
    names = F.array(*[F.lit(d) for d in model.domains])
    return (members.withColumn("rate", rates.column(p, len(model.domains)))
            .select(F.col(f"`{id_col}`"), "n_tokens", names[F.array_position(p, F.array_max(p)).cast("int") - 1].alias("domain"),
                    F.array_max(p).alias("posterior"), "rate", copies(F.col("rate"), F.col(f"`{id_col}`")).alias("copies"))), model, rates


#: Text bytes of the copies that a task sends on at once.
SLICE_BYTES = 64_000_000


def resample(docs: DataFrame, model: Softmax | None, rates: Rates, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs``, all columns, each row as often as its rate says (``copies``).
    Rates are recomputed where the text lies, so no text is shuffled."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model, rates))
    key = F.col(f"`{id_col}`")
    u = F.xxhash64(key).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, r = shared.value
        for batch in batches:
            x = np.array([r.of(m.posterior(t.as_py())) for t in batch.column("text")])
            times = np.floor(x) + (batch.column("u").to_numpy() < x - np.floor(x))
            at = np.repeat(np.arange(batch.num_rows), times.astype(np.int64))
            # copies of long texts go out in slices of about SLICE_BYTES
            held = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)[at])
            for rows in np.split(at, np.searchsorted(held, np.arange(SLICE_BYTES, held[-1], SLICE_BYTES)) + 1 if len(at) else []):
                if len(rows):
                    yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(rows))], ["row"])
    # the row travels as one struct, so that no name can clash
    packed = docs.select(whole_row(docs), F.col(f"`{text_col}`").alias("text"), u.alias("u"))
    return packed.mapInArrow(run, packed.select("row").schema).select("row.*")
