"""A quality classifier learned from positive and unlabelled documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Batches, column, map_texts, pairs, ship_by_value, stored

# Classes of UTF-8 bytes. Later entries overrule earlier ones.
_CLASSES: tuple[tuple[int, bytes], ...] = (
    (0, bytes(range(128))),
    (1, b" \t\r\x0b\x0c"),
    (2, b"\n"),
    (3, b"abcdefghijklmnopqrstuvwxyz"),
    (4, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (5, b"0123456789"),
    (6, b".,;:?"),
    (7, b"!"),
    (8, b"'\"()-"),
    (9, b"#*$%&@^~"),
    (10, b"|<>{}[]\\/_=+"),
    (11, bytes(range(128, 192))),
    (12, bytes(range(192, 256))),
)
_N_CLASSES = 13
_STATISTICS = 10
N_FEATURES = _N_CLASSES**2 + _STATISTICS


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int16)
    for number, members in _CLASSES:
        table[list(members)] = number
    return table


_TABLE = _class_table()


def features(text: str) -> np.ndarray:
    """What the classifier sees of a text: how often each pair of byte classes meets, and
    statistics of length and repetition. The whole text is read; an empty one gives 0s."""
    out = np.zeros(N_FEATURES, np.float32)
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return out
    kinds = _TABLE[np.frombuffer(raw, np.uint8)]
    meeting = np.bincount(kinds[:-1] * _N_CLASSES + kinds[1:], minlength=_N_CLASSES**2)
    out[: _N_CLASSES**2] = np.sqrt(meeting / len(raw))
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    if not words:
        return out
    n, distinct = len(words), len(set(words))
    pairs_ = list(zip(words, words[1:]))
    out[_N_CLASSES**2 :] = (
        np.log1p(n),
        np.log1p(len(lines)),
        distinct / n,
        distinct / n**0.75,
        sum(a == b for a, b in pairs_) / n,
        len(set(pairs_)) / max(1, len(pairs_)),
        len(set(lines)) / len(lines),
        sum(map(len, words)) / n / 10,
        max(map(len, words)) / 100,
        n / len(lines) / 100,
    )
    return out


@dataclass
class Network:
    """One hidden layer on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.hidden, self.hidden_bias, self.out, self.out_bias]

    def copy(self) -> Network:
        return Network(self.mean, self.scale, *[w.copy() for w in self.weights])

    def standardised(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.standardised(x) @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x).astype(np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def start(mean: np.ndarray, scale: np.ndarray, hidden: int = 16, seed: int = 7) -> Network:
    """A network with small random weights."""
    rng, d = np.random.default_rng(seed), len(mean)
    return Network(
        mean,
        scale,
        rng.normal(0, d**-0.5, (d, hidden)).astype(np.float32),
        np.zeros(hidden, np.float32),
        rng.normal(0, hidden**-0.5, hidden).astype(np.float32),
        np.zeros(1, np.float32),
    )


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Both parts of the unbiased risk of logits under logistic loss: that of positives, and
    that of negatives, ``R(U, -) - prior * R(P, -)``, which may come out below zero."""
    return (
        float(prior * _softplus(-positive).mean()),
        float(_softplus(unlabelled).mean() - prior * _softplus(positive).mean()),
    )


def slopes(net: Network, xp: np.ndarray, xu: np.ndarray, prior: float | None) -> list[np.ndarray]:
    """The direction of a step, for each weight of a network on standardised rows.

    With a ``prior``, the slopes of the non-negative unbiased risk of Kiryo et al. (2017),
    ``prior * R(P, +) + max(0, R(U, -) - prior * R(P, -))``: where the second part falls
    below zero on a batch, the step goes the other way, which stops the network from
    fitting the unlabelled rows as negatives. Without one, those of telling positives from
    unlabelled rows, which is what the prior is estimated with.
    """
    x = np.concatenate([xp, xu])
    h = np.tanh(x @ net.hidden + net.hidden_bias)
    g = h @ net.out + net.out_bias
    gp, gu = g[: len(xp)], g[len(xp) :]
    if prior is None:
        of_p, of_u = -_sigmoid(-gp), _sigmoid(gu)
    elif risk(gp, gu, prior)[1] >= 0:
        of_p, of_u = -prior * (_sigmoid(-gp) + _sigmoid(gp)), _sigmoid(gu)
    else:
        of_p, of_u = prior * _sigmoid(gp), -_sigmoid(gu)
    slope = np.concatenate([of_p / len(xp), of_u / len(xu)]).astype(np.float32)
    back = np.outer(slope, net.out) * (1 - h * h)
    return [x.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]


def steps(
    net: Network,
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float | None,
    rng: np.random.Generator,
    epochs: int = 7,
    batch: int = 512,
    rate: float = 3e-3,
    decay: float = 1e-4,
) -> None:
    """Train a network in place, by Adam: every unlabelled row is met ``epochs`` times, in
    batches that meet as many positives, drawn anew."""
    p, u = net.standardised(positive), net.standardised(unlabelled)
    weights = net.weights
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    n = epochs * -(-len(u) // batch)
    order = np.resize(np.concatenate([rng.permutation(len(u)) for _ in range(epochs)]), n * batch)
    for step in range(1, n + 1):
        xu = u[order[(step - 1) * batch : step * batch]]
        xp = p[rng.integers(0, len(p), batch)]
        for w, s, m, v in zip(weights, slopes(net, xp, xu, prior), first, second):
            s = s + decay * w
            m += 0.1 * (s - m)
            v += 0.001 * (s * s - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


# Rows that a task trains on at a time.
_CHUNK = 16_384


def _chunks(batches: Batches) -> Iterator[np.ndarray]:
    waiting: list[bytes] = []
    for batch in batches:
        waiting += batch.column("vector").to_pylist()
        while len(waiting) >= _CHUNK:
            yield _matrix(waiting[:_CHUNK])
            waiting = waiting[_CHUNK:]
    if waiting:
        yield _matrix(waiting)


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float32).reshape(-1, N_FEATURES)


def _moments(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature over all rows, summed up in tasks."""

    def run(batches: Batches) -> Batches:
        for x in _chunks(batches):
            x = x.astype(np.float64)
            columns = [np.arange(N_FEATURES), np.full(N_FEATURES, len(x)), x.sum(0), (x * x).sum(0)]
            kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["i", "n", "s", "q"])

    parts = vectors.mapInArrow(run, "i int, n bigint, s double, q double")
    rows = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in "nsq"]).orderBy("i").collect()
    n, s, q = (np.array([r[c] for r in rows], np.float64) for c in "nsq")
    mean = s / n
    deviation = np.sqrt(np.maximum(q / n - mean * mean, 0))
    return mean.astype(np.float32), deviation.astype(np.float32) + np.float32(1e-3)


def _round(
    vectors: DataFrame, net: Network, positive: np.ndarray, prior: float | None, seed: int = 0, epochs: int = 7, rate: float = 3e-3
) -> None:
    """All tasks train from the same network on all their rows; the weights are averaged by
    the number of rows behind them. Sums are made by Spark, weight by weight."""

    def run(batches: Batches) -> Batches:
        own = net.copy()
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        rows = 0
        for x in _chunks(batches):
            steps(own, positive, x, prior, rng, epochs, rate=rate)
            rows += len(x)
        if rows:
            flat = np.concatenate([w.ravel() for w in own.weights]).astype(np.float64) * rows
            columns = [np.arange(len(flat)), np.full(len(flat), rows), flat]
            kinds = [pa.int32(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["i", "n", "s"])

    parts = vectors.mapInArrow(run, "i int, n bigint, s double")
    sums = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    flat = np.array([r.s / r.n for r in sums], np.float64)
    at = 0
    for w in net.weights:
        w[...] = flat[at : at + w.size].reshape(w.shape)
        at += w.size


def prior_from(above_p: np.ndarray, above_u: np.ndarray, n_p: int, n_u: int, delta: float = 0.1) -> float:
    """The share of positives among unlabelled rows, by best bin estimation (Garg et al. 2021).

    Given are the shares of held-out positives and unlabelled rows above each threshold. The
    latter over the former is the share of positives wherever only positives lie above
    it. Of all thresholds the one with the lowest upper bound counts.
    """
    slack = np.sqrt(np.log(4 / delta) / 2) * (n_u**-0.5 + n_p**-0.5)
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def _estimate_prior(vectors: DataFrame, net: Network, positive: np.ndarray) -> float:
    """A classifier is learned on one half of the keys; of the other half, all unlabelled
    rows are counted by threshold, in tasks."""
    _round(vectors.filter("half = 0"), net, positive[::2], None, epochs=10)
    held = positive[1::2] if len(positive) > 1 else positive
    logits = np.sort(net.logit(held))
    cuts = np.quantile(logits, np.linspace(0, 0.95, 96))
    above_p = 1 - np.searchsorted(logits, cuts) / len(held)

    def run(batches: Batches) -> Batches:
        for x in _chunks(batches):
            above = len(x) - np.searchsorted(np.sort(net.logit(x)), cuts)
            columns = [np.arange(len(cuts)), above, np.full(len(cuts), len(x))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["i", "above", "n"])

    parts = vectors.filter("half = 1").mapInArrow(run, "i bigint, above bigint, n bigint")
    rows = parts.groupBy("i").agg(F.sum("above").alias("above"), F.sum("n").alias("n")).orderBy("i").collect()
    if not rows:
        return 0.5
    return prior_from(above_p, np.array([r.above / r.n for r in rows]), len(held), rows[0].n)


def in_split(key: Column, remainder: int, parts: int = 4) -> Column:
    """BOOLEAN: crc32 of the key as text has this remainder; false for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == remainder, F.lit(False))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    held_out: int = 2,
    max_positive: int = 6_000,
    rounds: int = 6,
) -> Network | None:
    """Learn from a bounded sample of trusted positives and from all unlabelled documents.

    Rows whose crc32(key as text) mod 4 is ``held_out`` are never looked at. A positive is
    a key whose labels are all 1; of these the first ``max_positive`` by hash of the key
    are taken (all, if there are fewer), and the driver holds them. All documents count as
    unlabelled, and stay in a stored table of their features (0.7 kB each): means, the class
    prior and every round of training are sums over all of its rows, made in tasks. None
    if either kind is missing.
    """
    usable = ~in_split(F.col("key"), held_out) & F.col("key").isNotNull()
    marked = labels.select(column(labels, key).alias("key"), column(labels, label).alias("label")).filter(usable)
    trusted = marked.groupBy("key").agg(F.min("label").alias("label")).filter("label = 1").select("key")
    order = F.xxhash64("key"), F.col("key")

    def run(texts: list[str]) -> list[pa.Array]:
        return [pa.array([features(t).tobytes() for t in texts], pa.binary())]

    rows = map_texts(pairs(documents, key, text).filter(usable), run, "vector binary")
    vectors = stored(rows.withColumn("half", F.pmod(F.xxhash64("key"), F.lit(2))), "features")
    known = trusted.join(vectors.select("key").distinct(), "key", "left_semi")
    # At most ``max_positive`` keys, so this broadcast has a fixed size. Of a repeated key
    # one row counts.
    first = F.broadcast(known.orderBy(*order).limit(max_positive))
    chosen = vectors.join(first, "key", "left_semi").groupBy("key").agg(F.min("vector").alias("vector"))
    positive = _matrix([r.vector for r in chosen.orderBy(*order).collect()])
    if not len(positive):
        return None
    # Few rows make few tasks, or each would learn from next to nothing.
    size = vectors.count()
    vectors = vectors.select("vector", "half").coalesce(max(1, size // _CHUNK))
    net = start(*_moments(vectors))
    prior = _estimate_prior(vectors, net.copy(), positive)
    for i in range(rounds):
        _round(vectors, net, positive, prior, seed=i, rate=3e-3 if i < rounds - 1 else 1e-3)
    return net


def with_score(
    df: DataFrame, model: Network | None, output: str = "score", keep_text: bool = True
) -> DataFrame:
    """Add the score of ``text``, 0 to 1; 0.5 throughout without a model.

    One pass over the rows, nothing is shuffled. NULL texts are scored as empty ones. A
    column named like the output is replaced.
    """
    df = df.drop(output)
    if model is None:
        return df.withColumn(output, F.lit(0.5))

    def run(texts: list[str]) -> list[pa.Array]:
        if not texts:
            return [pa.array([], pa.float64())]
        return [pa.array(model.score(np.stack([features(t) for t in texts])), pa.float64())]

    return map_texts(df, run, f"`{output}` double", keep_text)


def quality_scores(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", held_out: int = 2
) -> DataFrame:
    """Rows (key, score), one for each document, repeated rows and NULL keys included."""
    model = fit(documents, labels, key, text, held_out=held_out)
    scored = with_score(pairs(documents, key, text), model, keep_text=False)
    return scored.select(F.col("key").alias(key), "score")


ship_by_value(__name__)
