"""Scoring texts by masked pseudo-likelihood: each token predicted from both sides."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from .store import Batches, column, pairs, ship_by_value, stored

@dataclass(frozen=True)
class Shape:
    """Sizes of the network. Tokens are ``classes * per_class`` words by frequency, the last
    ``unknown`` of them shared by all rarer words, which a hash deals out; ``Tail`` tells
    the words of such a bucket apart."""

    classes: int = 32
    per_class: int = 64
    unknown: int = 256
    side: int = 2
    width: int = 24

    @property
    def tokens(self) -> int:
        return self.classes * self.per_class

    @property
    def kind(self) -> type:
        """What a stored token is: 16 bits as long as the edge fits."""
        return np.uint16 if self.tokens < 1 << 16 else np.uint32

    @classmethod
    def of(cls, distinct: int) -> Shape:
        """The shape for so many distinct words: 3 times their sixth root in classes (32 at
        least), twice as many tokens in each, an eighth of all for rare words. So tokens
        grow with the cube root, the outputs a token costs with the sixth root."""
        classes = max(32, math.ceil(3 * distinct ** (1 / 6)))
        return cls(classes, 2 * classes, classes * classes // 4)


def _utf8(texts: list[str]) -> pa.Array:
    """Texts as Arrow has them; lone surrogates are let through."""
    data = pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.binary())
    return pa.Array.from_buffers(pa.string(), len(data), data.buffers())


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many words each text has, the words of all texts as numbers, and the distinct
    words in the order of these numbers, A-Z lowered and no other letter changed."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.string()))))
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    held = pc.greater(pc.binary_length(words), 0)
    if not pc.all(held).as_py():  # a text without words has an empty one
        sizes = np.bincount(pc.list_parent_indices(lists).filter(held).to_numpy(), minlength=len(lists))
        words = words.filter(held)
    words = words.dictionary_encode()
    return sizes, words.indices.to_numpy(), words.dictionary


class Scratch:
    """Arrays that each batch overwrites, kept from batch to batch: memory that is given back
    and asked for anew may cost a page fault every 4 kB."""

    def __init__(self) -> None:
        self._held: dict[tuple[str, np.dtype], np.ndarray] = {}

    def __call__(self, name: str, kind: np.dtype | type, *shape: int) -> np.ndarray:
        """The array of that name, with anything in it; what it held before is lost."""
        key, size = (name, np.dtype(kind)), math.prod(shape)
        if key not in self._held or self._held[key].size < size:
            self._held[key] = np.empty(size, kind)
        return self._held[key][:size].reshape(shape)


@dataclass
class Network:
    """A window network: the embeddings of ``side`` tokens on either side, one table for
    each place, are summed into a hidden layer, which predicts first the class of the
    masked token, then the token within it (Goodman 2001), so that a token costs
    ``classes + per_class`` outputs instead of all. Token ``tokens`` is the text's edge."""

    shape: Shape
    words: dict[bytes, int]
    weights: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def start(cls, shape: Shape, words: list[bytes], counts: np.ndarray, seed: int = 11) -> Network:
        """Small random embeddings; biases that give each token its frequency."""
        rng = np.random.default_rng(seed)
        share = ((counts + 1.0) / (counts + 1.0).sum()).reshape(shape.classes, shape.per_class)
        weights = [
            rng.normal(0, 0.1, (2 * shape.side, shape.tokens + 1, shape.width)),
            np.zeros(shape.width),
            rng.normal(0, 0.1, (shape.width, shape.classes)),
            np.log(share.sum(1)),
            rng.normal(0, 0.1, (shape.classes, shape.width, shape.per_class)),
            np.log(share / share.sum(1, keepdims=True)),
        ]
        return cls(shape, {w: i for i, w in enumerate(words)}, [w.astype(np.float32) for w in weights])

    def encode(self, text: str) -> np.ndarray:
        """The tokens of a text, with edges around them."""
        return self.encoded(_utf8([text]))[0]

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """The tokens of all texts with edges around each, and where each text starts among
        them; then the index of the rare word at each place (-1 at others), and these words."""
        shape = self.shape
        sizes, codes, words = _words(texts)
        cuts = np.append(0, np.cumsum(sizes + 2 * shape.side))
        known = pc.index_in(words, value_set=pa.array(list(self.words), pa.binary()).cast(pa.string()))
        token = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(token < 0)
        rare = words.take(pa.array(new))
        buckets = (zlib.crc32(w) % shape.unknown for w in rare.cast(pa.binary()).to_numpy(zero_copy_only=False))
        token[new] = shape.tokens - shape.unknown + np.fromiter(buckets, np.int64, len(new))
        index = np.full(len(words), -1)
        index[new] = np.arange(len(new))
        at = np.arange(len(codes)) + shape.side * (2 * np.repeat(np.arange(len(sizes)), sizes) + 1)
        stream = np.full(cuts[-1], shape.tokens, shape.kind)
        stream[at] = token[codes]
        indexes = np.full(cuts[-1], -1)
        indexes[at] = index[codes]
        return stream, cuts, indexes, rare

    def _shifts(self) -> list[int]:
        return [*range(-self.shape.side, 0), *range(1, self.shape.side + 1)]

    def hidden(self, around: list[np.ndarray], scratch: Scratch) -> np.ndarray:
        """The hidden layer of places, given the tokens at each shift from them."""
        tables, bias = self.weights[:2]
        total, part = (scratch(name, bias.dtype, len(around[0]), len(bias)) for name in ("hidden", "inner"))
        total[:] = bias
        for table, seen in zip(tables, around):
            total += np.take(table, seen, axis=0, out=part, mode="clip")
        return np.tanh(total, out=total)

    def log_probabilities(
        self, stream: np.ndarray, at: np.ndarray, back: list[np.ndarray] | None = None, scratch: Scratch | None = None
    ) -> np.ndarray:
        """log P(token | both sides) of the tokens at the given places of a stream.

        With ``back``, a list of arrays like the weights, the slopes of the mean loss are
        added to it. Places are worked through in the order of their tokens, so that those
        of a class are one slice: products are by class, all else is for all places at once.
        Whoever works through many batches hands the same ``scratch`` to each.
        """
        shape, scratch = self.shape, scratch or Scratch()
        _, _, class_w, class_b, word_w, word_b = self.weights
        order = np.argsort(stream[at], kind="stable")
        at = at[order]
        token = stream[at]
        group, member = np.divmod(token, shape.per_class)
        cuts = np.searchsorted(token, np.arange(shape.classes + 1) * shape.per_class).tolist()
        slices = [(g, slice(*cuts[g : g + 2])) for g in range(shape.classes) if cuts[g] < cuts[g + 1]]
        around = list(scratch("around", np.intp, 2 * shape.side, len(at)))
        for seen, shift in zip(around, self._shifts()):
            np.add(at, shift, out=seen)
            seen[:] = stream[seen]
        h = self.hidden(around, scratch)
        # A last column of ones takes the biases in.
        one = scratch("one", h.dtype, len(at), shape.width + 1)
        one[:, :-1], one[:, -1] = h, 1
        class_w = np.vstack([class_w, class_b])
        word_w = np.concatenate([word_w, word_b[:, None]], axis=1)

        classes = np.matmul(one, class_w, out=scratch("classes", h.dtype, len(at), shape.classes))
        class_found, class_norm = _softmax(classes, class_w, group, [slice(None)])
        words = scratch("words", h.dtype, len(at), shape.per_class)
        for g, own in slices:
            np.matmul(one[own], word_w[g], out=words[own])
        found, norm = _softmax(words, word_w, member, [own for _, own in slices])
        found += class_found
        if back is not None:
            share = one.dtype.type(1 / len(at))
            _slopes(classes, class_norm, group, share)
            sums = one.T @ classes
            back[2] += sums[:-1]
            back[3] += sums[-1]
            slope = np.matmul(classes, class_w[:-1].T, out=scratch("slope", h.dtype, *h.shape))
            _slopes(words, norm, member, share)
            inner = scratch("inner", h.dtype, *h.shape)
            sums = scratch("word sums", h.dtype, *word_w.shape)
            sums.fill(0)
            for g, own in slices:
                p = words[own]
                np.matmul(one[own].T, p, out=sums[g])
                np.matmul(p, word_w[g, :-1].T, out=inner[own])
            back[4] += sums[:, :-1]
            back[5] += sums[:, -1]
            slope += inner
            np.multiply(h, h, out=h)
            slope *= np.subtract(1, h, out=h)
            back[1] += np.ones(len(at), h.dtype) @ slope
            _add_rows(back[0], slope, around, scratch)
        result = np.empty_like(found)
        result[order] = found
        return result

    def train(self, streams: Iterator[np.ndarray], batch: int = 8192, rate: float = 0.1) -> int:
        """One pass of Adagrad over streams of tokens; the number of tokens predicted."""
        squares = [np.full_like(w, 1e-6) for w in self.weights]
        back = [np.empty_like(w) for w in self.weights]
        # Weights are changed a part at a time, which stays in the cache for all steps.
        parts = [
            [x.reshape(-1)[at : at + _PART] for x in own]
            for own in zip(self.weights, squares, back)
            for at in range(0, own[0].size, _PART)
        ]
        total, scratch = 0, Scratch()
        for stream in streams:
            places = np.flatnonzero(stream < self.shape.tokens)
            for first in range(0, len(places), batch):
                at = places[first : first + batch]
                for b in back:
                    b.fill(0)
                self.log_probabilities(stream, at, back, scratch)
                for w, s, b in parts:
                    x = scratch("part", b.dtype, b.size)
                    s += np.multiply(b, b, out=x)
                    b *= rate
                    b /= np.sqrt(s, out=x)
                    w -= b
                total += len(at)
        return total


# Weights that are changed at once.
_PART = 16_384

# Beyond this, exp() of 32 bits could overflow in a sum.
_SAFE = 60.0


def _places(p: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted output of each row is in the rows laid out one after another."""
    return np.arange(0, p.size, p.shape[1]) + wanted


def _softmax(p: np.ndarray, w: np.ndarray, wanted: np.ndarray, slices: list[slice]) -> tuple[np.ndarray, np.ndarray]:
    """Each row's log-probability of its wanted output, and the scale of the row; the outputs
    ``p`` become probabilities times that, which are summed up slice by slice. No input is beyond 1, which bounds the outputs;
    only if that is not enough is the largest of each row taken off."""
    if np.abs(w).sum(-2).max() > _SAFE:
        p -= p.max(1, keepdims=True)
    found = p.ravel().take(_places(p, wanted))
    np.exp(p, out=p)
    one, norm = np.ones(p.shape[1], p.dtype), np.empty(len(p), p.dtype)
    for own in slices:
        np.matmul(p[own], one, out=norm[own])
    return found - np.log(norm), norm


def _slopes(p: np.ndarray, norm: np.ndarray, wanted: np.ndarray, share: float) -> None:
    """Make of the probabilities of ``_softmax`` the slopes of a loss to which each row adds its ``share``."""
    p *= (share / norm)[:, None]
    p.ravel()[_places(p, wanted)] -= share


def _add_rows(tables: np.ndarray, slope: np.ndarray, around: list[np.ndarray], scratch: Scratch) -> None:
    """Add the slope of each place to the row of the token seen there, in each table."""
    _, rows, width = tables.shape
    if width % 2:
        for table, seen in zip(tables, around):
            np.add.at(table, seen, slope)
        return
    # Two numbers at a time, as a complex one: half as many steps.
    kind = np.result_type(slope, np.complex64)
    cells = np.arange(rows * width // 2).reshape(rows, -1)
    index = scratch("cells", np.intp, len(slope), width // 2)
    for table, seen in zip(tables, around):
        np.take(cells, seen, axis=0, out=index, mode="clip")
        np.add.at(table.reshape(-1).view(kind), index.reshape(-1), slope.reshape(-1).view(kind))


@dataclass
class Tail:
    """How the probability of a bucket is shared out among the rare words in it: a word of
    ``n`` occurrences has ``n / (mass + 1)`` of it, ``mass`` being those of all words of the
    bucket; a word that was not counted has the remaining one. ``words`` are the rows
    (word, n) of rare words that occur more than once, a Spark table of any size."""

    words: DataFrame
    masses: np.ndarray


# Distinct words that a task counts before it hands them in.
_COUNTED = 400_000


def word_counts(documents: DataFrame) -> DataFrame:
    """Rows (word, n) of all documents, A-Z lowered and no other letter changed.

    Tasks count words before they are shuffled, at most so many distinct ones at a time
    (and those of one slice of texts) in memory.
    """

    def run(batches: Batches) -> Batches:
        counted = []
        for texts, _ in _slices(batches):
            _, codes, words = _words(texts)
            n = pa.array(np.bincount(codes, minlength=len(words)))
            counted = [_summed([*counted, pa.table([words, n], names=["word", "n"])])]
            if counted[0].num_rows >= _COUNTED:
                yield from counted.pop().to_batches()
        for rest in counted:
            yield from rest.to_batches()

    return documents.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _summed(counted: list[pa.Table]) -> pa.Table:
    if len(counted) == 1:
        return counted[0]
    return pa.concat_tables(counted).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])


def _slices(batches: Batches, chunk: int = 8_000_000) -> Iterator[tuple[pa.Array, pa.RecordBatch]]:
    """The texts of batches in slices of about so many bytes, each with its part of the batch."""
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + chunk)))
            yield texts[start:stop], batch.slice(start, stop - start)
            start = stop


def vocabulary(documents: DataFrame, shape: Shape) -> tuple[list[bytes], np.ndarray]:
    """The words of all documents that get a token of their own, and the counts of all tokens.

    The most frequent words do, ties by the word. Only they come to the driver, with one
    sum for the rest.
    """
    counts = word_counts(documents)
    seen = Observation()
    top = _most_frequent(counts.observe(seen, F.sum("n").alias("total")), shape)
    return _tokens(top, seen.get["total"] or 0, shape)


def _most_frequent(counts: DataFrame, shape: Shape) -> list[Row]:
    return counts.orderBy(F.desc("n"), "word").limit(shape.tokens - shape.unknown).collect()


def _tokens(top: list[Row], total: int, shape: Shape) -> tuple[list[bytes], np.ndarray]:
    own = [r.n for r in top]
    rest = max(0, total - sum(own)) / shape.unknown
    spare = [0.0] * (shape.tokens - shape.unknown - len(own))
    return [r.word.encode() for r in top], np.array([*own, *spare, *[rest] * shape.unknown], np.float64)


def _tail(counts: DataFrame, top: list[Row], shape: Shape) -> Tail:
    """The rare words, which all come after the last of ``top``; the driver gets one number per bucket."""
    last = top[-1]
    rare = counts.filter((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("word") > last.word)))
    bucket = (F.crc32(F.col("word").cast("binary")) % shape.unknown).cast("int").alias("bucket")
    masses = np.zeros(shape.unknown)
    for r in rare.groupBy(bucket).agg(F.sum("n").alias("mass")).collect():
        masses[r.bucket] = r.mass
    return Tail(rare.filter("n > 1"), masses)


def learn(
    documents: DataFrame, text: str = "text", shape: Shape | None = None, rounds: int = 2
) -> tuple[Network, Tail] | None:
    """Learn a network and its tail from every token of all documents; None if they have no word.

    The network has the shape that ``Shape.of`` gives for the distinct words, unless one is
    given. In a round every task starts from the same network, makes one pass over its
    documents and hands in its weights, which are averaged by the number of tokens behind
    them (parameter mixing, McDonald et al. 2010); the next round starts from the average.
    What is gathered grows with the number of tasks and with the network; it is summed up
    as it streams in, block by block, first within one of 16 shares of the tasks, so that
    no task holds more than one network. The driver gets one.

    Texts are read twice, to count words and to write their tokens, which the rounds read.
    """
    learned = _learn(documents.select(F.lit(0).alias("key"), F.coalesce(column(documents, text).cast("string"), F.lit("")).alias("text")), shape, rounds)
    return learned and learned[:2]


def _learn(rows: DataFrame, shape: Shape | None = None, rounds: int = 2) -> tuple[Network, Tail, DataFrame] | None:
    """Network and tail of rows (key, text), and the stored rows of ``encode_rows``."""
    counts = stored(word_counts(rows), "words")
    seen = counts.agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("total")).first()
    if not seen.distinct:
        return None
    shape = shape or Shape.of(seen.distinct)
    top = _most_frequent(counts, shape)
    network = Network.start(shape, *_tokens(top, seen.total, shape))
    encoded = stored(encode_rows(rows, network), "tokens")
    for _ in range(rounds):
        network.weights = _average(encoded, network)
    return network, _tail(counts, top, shape), encoded


_ENCODED = "row bigint, key {}, tokens binary, rare array<struct<word:string,rows:array<bigint>>>"


def encode_rows(rows: DataFrame, network: Network) -> DataFrame:
    """Rows (row, key, tokens, rare) of rows (key, text), to be stored before they are read.

    ``tokens`` are those of the text with edges around them. ``rare`` of the first row of
    a slice of rows lists the rare words of the whole slice with the rows they occur in,
    once for each occurrence, so that a word is shuffled once a slice; that of others is empty.
    """

    def run(batches: Batches) -> Batches:
        for texts, part in _slices(batches):
            stream, cuts, rare, new = network.encoded(texts)
            data = pa.py_buffer(stream.tobytes())
            offsets = pa.array(cuts * stream.itemsize, pa.int32())
            tokens = pa.Array.from_buffers(pa.binary(), len(texts), [None, offsets.buffers()[1], data])
            at = np.flatnonzero(rare >= 0)
            which = rare[at].astype(np.int32)
            owner = np.repeat(part.column("row").to_numpy(), np.diff(cuts))
            ids = owner[at[np.argsort(which)]]
            first = np.append(0, np.cumsum(np.bincount(which, minlength=len(new))))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int64()))
            listed = pa.StructArray.from_arrays([new, lists], ["word", "rows"])
            ends = pa.array([0] + [len(new)] * len(texts), pa.int32())
            columns = [part.column("row"), part.column("key"), tokens, pa.ListArray.from_arrays(ends, listed)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "tokens", "rare"])

    key = rows.schema["key"].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    return numbered.mapInArrow(run, _ENCODED.format(key))


def fit(documents: DataFrame, text: str = "text", shape: Shape | None = None, rounds: int = 2) -> Network | None:
    """The network alone, for which the words of a bucket are one."""
    learned = learn(documents, text, shape, rounds)
    return learned and learned[0]


_SHARES = 16
_BLOCK = 16_384
_SUMS = "block int, share int, tokens bigint, sums binary"


def _average(encoded: DataFrame, network: Network) -> list[np.ndarray]:
    def run(batches: Batches) -> Batches:
        own = Network(network.shape, network.words, [w.copy() for w in network.weights])
        share = zlib.crc32(b"%d" % (TaskContext.get().partitionId())) % _SHARES

        def streams() -> Iterator[np.ndarray]:
            for batch in batches:
                tokens = batch.column("tokens")
                for at in range(0, batch.num_rows, 256):
                    yield np.frombuffer(b"".join(tokens.slice(at, 256).to_pylist()), own.shape.kind)

        n = own.train(streams())
        flat = np.concatenate([w.ravel() for w in own.weights]).astype(np.float64) * n
        if n:
            yield _batch({i // _BLOCK: (n, flat[i : i + _BLOCK]) for i in range(0, len(flat), _BLOCK)}, share)

    def add(batches: Batches) -> Batches:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        share = 0
        for batch in batches:
            for block, n, values in zip(*(batch.column(c).to_pylist() for c in ("block", "tokens", "sums"))):
                old, total = sums.get(block, (0, 0.0))
                sums[block] = old + n, total + np.frombuffer(values, np.float64)
        if sums:
            yield _batch(sums, share)

    within = encoded.select("tokens").mapInArrow(run, _SUMS).repartition(64, "block", "share").mapInArrow(add, _SUMS)
    total = within.repartition(16, "block").mapInArrow(add, _SUMS).orderBy("block").collect()
    flat = np.concatenate([np.frombuffer(r.sums, np.float64) / r.tokens for r in total])
    weights, at = [], 0
    for w in network.weights:
        weights.append(flat[at : at + w.size].reshape(w.shape).astype(np.float32))
        at += w.size
    return weights


def _batch(sums: dict[int, tuple[int, np.ndarray]], share: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([share] * len(sums), pa.int32()),
            pa.array([n for n, _ in sums.values()], pa.int64()),
            pa.array([v.tobytes() for _, v in sums.values()], pa.binary()),
        ],
        names=["block", "share", "tokens", "sums"],
    )


def pseudo_log_likelihood(
    texts: list[str], network: Network, batch: int = 32_768, masses: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The number of tokens of each text, and the sum of their log-probabilities.

    With the ``masses`` of a tail, a rare word has the share of its bucket that a word of
    one occurrence has, otherwise all of it.
    """
    stream, cuts, _, _ = network.encoded(_utf8(texts))
    return _sums(stream, np.diff(cuts), network, batch, masses)


def _sums(
    stream: np.ndarray,
    sizes: np.ndarray,
    network: Network,
    batch: int = 32_768,
    masses: np.ndarray | None = None,
    scratch: Scratch | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """``pseudo_log_likelihood`` of a stream of texts that have so many tokens, edges included."""
    scratch = scratch or Scratch()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = np.flatnonzero(stream < network.shape.tokens)
    sums = np.zeros(len(sizes))
    for first in range(0, len(places), batch):
        at = places[first : first + batch]
        sums += np.bincount(owner[at], network.log_probabilities(stream, at, scratch=scratch).astype(np.float64), len(sizes))
    if masses is not None:
        low = network.shape.tokens - network.shape.unknown
        rare = places[stream[places] >= low]
        sums -= np.bincount(owner[rare], np.log1p(masses)[stream[rare] - low], len(sizes))
    return np.bincount(owner[places], minlength=len(sizes)), sums


def _occurrences(encoded: DataFrame, tail: Tail) -> DataFrame:
    """Rows (row, extra): the log of the count of each rare word of a row, summed up.

    No rare word has more occurrences than the least frequent of the others, so the join
    is even. Its tasks hold their share of the distinct words; nothing is sorted.
    """
    counted = encoded.select(F.inline("rare")).join(tail.words.hint("shuffle_hash"), "word")
    return counted.select(F.ln("n").alias("log"), F.explode("rows").alias("row")).groupBy("row").agg(F.sum("log").alias("extra"))


def scored(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    network: Network | None = None,
    tail: Tail | None = None,
) -> DataFrame:
    """Rows (key, n_tokens, log_prob, mean_log_prob), one for each document.

    Network and tail are learned from the same documents unless a network is given; without
    a tail, a rare word then has the probability of its whole bucket. Repeated rows and
    NULL keys are kept; a text without words (NULL, empty) has 0 tokens, log_prob 0 and
    mean NULL. Texts stay where they are read; rare words are shuffled, to meet their counts.
    """
    rows = pairs(documents, key, text)
    encoded = None
    if network is None:
        network, tail, encoded = _learn(rows) or (None, None, None)
    if network is None:
        found = rows.select("key", F.lit(0).cast("bigint").alias("n_tokens"), F.lit(0.0).alias("log_prob"))
    else:
        if encoded is None:
            encoded = stored(encode_rows(rows, network), "tokens")
        found = _scores(encoded, network, tail)
    mean = F.try_divide("log_prob", "n_tokens").alias("mean_log_prob")
    return found.select(F.col("key").alias(key), "n_tokens", "log_prob", mean)


# Places that are scored at once; each is scored for itself, so many stay in the cache.
_SCORED = 8192


def _scores(encoded: DataFrame, network: Network, tail: Tail | None) -> DataFrame:
    """Rows (key, n_tokens, log_prob) of stored rows of ``encode_rows``."""
    masses = None if tail is None else tail.masses

    def run(batches: Batches) -> Batches:
        scratch = Scratch()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                tokens = part.column("tokens").to_pylist()
                stream = np.frombuffer(b"".join(tokens), network.shape.kind)
                sizes = np.array([len(t) for t in tokens]) // stream.itemsize
                n, sums = _sums(stream, sizes, network, _SCORED, masses, scratch)
                columns = [part.column("row"), part.column("key"), pa.array(n, pa.int64()), pa.array(sums, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "n_tokens", "log_prob"])

    key = encoded.schema["key"].dataType.simpleString()
    rows = encoded.select("row", "key", "tokens")
    found = rows.mapInArrow(run, f"row bigint, key {key}, n_tokens bigint, log_prob double")
    if tail is None:
        return found.drop("row")
    total = F.col("log_prob") + F.coalesce("extra", F.lit(0.0))
    return found.join(_occurrences(encoded, tail), "row", "left").select("key", "n_tokens", total.alias("log_prob"))


ship_by_value(__name__)
