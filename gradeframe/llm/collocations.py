"""Phrases of words that come together more often than chance, with exact counts.

Counting follows ERA (Mansour et al. 2011), a suffix tree builder that partitions vertically:
the suffixes of a text are grouped by their first words so that a group fits a memory
budget, and each group's subtree is built by itself. Here a subtree is cut off at the longest
phrase, and only its leaf totals are kept: a phrase occurs as often as the leaves below it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Batches, column, ship_by_value, stored

MIN_COUNT = 100
MOST_WORDS = 5
BUDGET = 1_000_000  # suffixes of a group

_FLUSH = 2_000_000  # words that a task gathers before it hands in counts
_END = b"."  # ends of pieces, as a word; no word holds this byte
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", _END * 9)
_NO_LANG = "und"


def split(text: str) -> list[bytes]:
    """The words of a text, A-Z lowered, with ``.`` after each piece."""
    found = text.encode("utf-8", "surrogatepass").lower().translate(_ENDS).replace(_END, b" . ").split()
    return [*found, _END]


@dataclass(frozen=True)
class Filter:
    """A set of hashes as one bit each. It may hold a phrase too many, never one too few: a
    suffix is then longer than it need be, no count is wrong. Its size follows the
    number of phrases, 16 bits each, up to ``1 << MOST_BITS``."""

    bits: np.ndarray
    log: int

    MOST_BITS = 27

    @classmethod
    def of(cls, phrases: DataFrame) -> Filter:
        """The filter of rows (lang, phrase): it is put together in Spark, 64 bits a row."""
        log = min(cls.MOST_BITS, max(16, (16 * phrases.count()).bit_length()))

        def run(batches: Batches) -> Batches:
            for batch in batches:
                rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                hashes = [_phrase_hash([_word_hash(lang, w) for w in phrase.encode().split(b" ")]) for lang, phrase in rows]
                yield pa.RecordBatch.from_arrays([pa.array(_bit(np.array(hashes, np.uint64), log), pa.int64())], names=["bit"])

        bits = phrases.select("lang", "phrase").mapInArrow(run, "bit bigint")
        one = F.expr("shiftleft(1L, int(bit & 63))")
        found = bits.groupBy(F.shiftright("bit", 6).alias("place")).agg(F.bit_or(one).alias("mask")).collect()
        full = np.zeros((1 << log) // 64, np.uint64)
        for r in found:
            full[r.place] = np.uint64(r.mask & (1 << 64) - 1)
        return cls(full, log)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = _bit(hashes, self.log)
        return (self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed odd factor of multiplicative hashing


def _word_hash(lang: str, word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode() + b" " + word, digest_size=8).digest(), "little")


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (left * _STEP) ^ right


def _phrase_hash(words: list[int]) -> int:
    found = np.uint64(words[0])
    for w in words[1:]:
        found = _pair_hash(np.array([found]), np.array([w], np.uint64))[0]
    return int(found)


def _bit(hashes: np.ndarray, log: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((hashes * _STEP) >> np.uint64(64 - log)).astype(np.int64)


class _Words(dict):
    """Numbers of the words of a language within a task, from 1; 0 for those that the
    filter does not hold, and for ends of pieces."""

    def __init__(self, lang: str, keep: Filter):
        super().__init__({_END: 0})
        self.lang, self.keep = lang, keep
        self.names: list[bytes] = [b""]
        self.hashes: list[int] = [0]

    def learn(self, words: list[bytes]) -> None:
        new = [w for w in set(words) if w not in self]
        hashes = np.array([_word_hash(self.lang, w) for w in new], np.uint64)
        for word, h, kept in zip(new, hashes.tolist(), self.keep.has(hashes).tolist()):
            self[word] = len(self.names) if kept else 0
            if kept:
                self.names.append(word)
                self.hashes.append(h)


def _gather(batches: Batches, count: Callable[[str, list[bytes]], Iterator[tuple]], names: list[str]) -> Batches:
    """Hand the words of texts to ``count`` by language, when ``_FLUSH`` have come together."""
    waiting: dict[str, list[bytes]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, words in waiting.items():
            for columns in count(lang, words):
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(columns[0]), np.int32)))
                yield pa.RecordBatch.from_arrays([langs, *columns], names=names)
        waiting.clear()

    gathered = 0
    for batch in batches:
        texts = batch.column(1)
        for i, lang in enumerate(batch.column(0).to_pylist()):
            words = split(texts[i].as_py())
            waiting.setdefault(lang, []).extend(words)
            gathered += len(words)
            if gathered >= _FLUSH:
                yield from flush()
                gathered = 0
    yield from flush()


def _rows(phrases: pa.Array, counts: np.ndarray, *more: pa.Array) -> Iterator[tuple]:
    """Columns in batches that Arrow and Spark can take whatever the phrases' length."""
    sizes = np.cumsum(pc.binary_length(phrases).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(phrases):
        before = sizes[start - 1] if start else 0
        stop = int(np.searchsorted(sizes, before + 16_000_000, "right"))
        stop = min(max(stop, start + 1), start + 50_000)
        texts = [m[start:stop].cast(pa.string()) for m in (phrases, *more)]
        yield texts[0], pa.array(counts[start:stop], pa.int64()), *texts[1:]
        start = stop


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """Rows (lang, phrase, n): each word of (lang, text), and all words of a language as ''."""

    def count(lang: str, words: list[bytes]) -> Iterator[tuple]:
        seen = Counter(words)
        seen.pop(_END, None)
        counts = np.array([sum(seen.values()), *seen.values()], np.int64)
        yield from _rows(_strings([b"", *seen]), counts)

    def run(batches: Batches) -> Batches:
        return _gather(batches, count, ["lang", "phrase", "n"])

    return _summed(texts.mapInArrow(run, "lang string, phrase string, n bigint"))


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.large_binary()).cast(pa.large_string())


def _numbered(words: _Words, some: list[bytes]) -> np.ndarray:
    words.learn(some)
    return np.fromiter(map(words.__getitem__, some), np.int64, len(some))


def _joined(names: pa.Array, table: np.ndarray) -> pa.Array:
    """The phrases of rows of word numbers; 0 is no word."""
    parts = [names.take(pa.array(c, mask=c == 0)) for c in table.T]
    return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()), null_handling="skip")


def _distinct(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of a table, in order, and how often each occurs."""
    keys = list(table.T)
    if len(table) and table.max() < 1 << 21:  # three numbers in one key
        keys = []
        for first in range(0, table.shape[1], 3):
            key = np.zeros(len(table), np.int64)
            for c in table.T[first : first + 3]:
                key = key << 21 | c
            keys.append(key)
    table = table[np.lexsort(keys[::-1])]
    fresh = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(1)]))
    return table[fresh], np.diff(np.append(fresh, len(table)))


def pair_counts(texts: DataFrame, keep: Filter) -> DataFrame:
    """Rows (lang, phrase, n): two words that the filter holds, side by side in a piece."""

    def run(batches: Batches) -> Batches:
        langs: dict[str, _Words] = {}

        def count(lang: str, some: list[bytes]) -> Iterator[tuple]:
            words = langs.setdefault(lang, _Words(lang, keep))
            ids = _numbered(words, some)
            both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            pairs, n = np.unique(ids[both] << 32 | ids[both + 1], return_counts=True)
            table = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], 1)
            yield from _rows(_joined(_strings(words.names), table), n)

        return _gather(batches, count, ["lang", "phrase", "n"])

    return _summed(texts.mapInArrow(run, "lang string, phrase string, n bigint"))


def suffixes(texts: DataFrame, keep: Filter, pairs: Filter, large: dict[str, list[str]], most_words: int) -> DataFrame:
    """Rows (lang, phrase, n, prefix): suffixes of pieces from three words on, and how often
    they were seen. A suffix ends with its piece, before a pair of words that is rare, or
    after ``most_words``. ``prefix`` is its first two words, or three if those are ``large``.
    """
    width = most_words

    def run(batches: Batches) -> Batches:
        langs: dict[str, _Words] = {}

        def count(lang: str, some: list[bytes]) -> Iterator[tuple]:
            words = langs.setdefault(lang, _Words(lang, keep))
            ids = _numbered(words, some)
            hashes = np.array(words.hashes, np.uint64)
            good = (ids[:-1] > 0) & (ids[1:] > 0)
            good[good] = pairs.has(_pair_hash(hashes[ids[:-1][good]], hashes[ids[1:][good]]))
            good = np.concatenate([good, np.zeros(width, bool)])
            at = np.flatnonzero(good[:-1] & good[1:])
            if not len(at):
                return
            table = np.zeros((len(at), width), np.int64)
            alive = np.ones(len(at), bool)
            table[:, 0] = ids[at]
            for j in range(1, width):
                alive &= good[at + j - 1]
                table[alive, j] = ids[at[alive] + j]
            table, n = _distinct(table)
            names = _strings(words.names)
            two, three = _joined(names, table[:, :2]), _joined(names, table[:, :3])
            split_more = pc.is_in(two, value_set=pa.array(large.get(lang, []), pa.large_string()))
            yield from _rows(_joined(names, table), n, pc.if_else(split_more, three, two))

        return _gather(batches, count, ["lang", "phrase", "n", "prefix"])

    return texts.mapInArrow(run, "lang string, phrase string, n bigint, prefix string")


def subtree_counts(suffixes: DataFrame, groups: int, min_count: int) -> DataFrame:
    """Rows (lang, phrase, n): the nodes, from three words on, that occur ``min_count`` times.

    Suffixes with the same prefix are in the same group; a group is a partition. Its
    suffixes are sorted, so that those below a node are neighbours, and the node's total
    is one sum; a group of more rows than expected is sorted on disk, and read in batches.
    """

    def run(batches: Batches) -> Batches:
        last: list[tuple] = []  # rows below the first three words that were read last
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns[:3])))
            heads = [(lang, phrase.split(" ", 3)[:3]) for lang, phrase, _ in rows]
            cut = len(rows)
            while cut and heads[cut - 1] == heads[-1]:
                cut -= 1
            if cut:
                yield from _tree(last + rows[:cut], min_count)
                last = []
            elif last and rows and (last[0][0], last[0][1].split(" ", 3)[:3]) != heads[0]:
                yield from _tree(last, min_count)
                last = []
            last = _combined(last + rows[cut:])
        yield from _tree(last, min_count)

    grouped = suffixes.repartition(groups, "lang", "prefix").sortWithinPartitions("lang", "phrase")
    return grouped.select("lang", "phrase", "n").mapInArrow(run, "lang string, phrase string, n bigint")


def _combined(rows: list[tuple]) -> list[tuple]:
    sums: dict[tuple, int] = {}
    for lang, phrase, n in rows:
        sums[lang, phrase] = sums.get((lang, phrase), 0) + n
    return [(*k, n) for k, n in sums.items()]


def _tree(rows: list[tuple], min_count: int) -> Batches:
    """The totals of all nodes over leaves (lang, phrase, n)."""
    totals: dict[tuple[str, str], int] = {}
    for lang, phrase, n in rows:
        words = phrase.split(" ")
        for size in range(3, len(words) + 1):
            node = lang, " ".join(words[:size])
            totals[node] = totals.get(node, 0) + n
    found = [(*node, n) for node, n in totals.items() if n >= min_count]
    if found:
        langs, phrases, counts = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
            names=["lang", "phrase", "n"],
        )


def phrase_counts(
    documents: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, most_words: int = MOST_WORDS, budget: int = BUDGET
) -> DataFrame:
    """Stored rows (lang, phrase, n) of all phrases of one to ``most_words`` words that occur
    ``min_count`` times in a language, and '' with the number of its words.

    The text is read once for each level of prefixes: words, pairs of words that are both
    frequent, then suffixes made of frequent pairs. Counts are summed up within the task
    before they are shuffled, so a word or passage that fills the corpus is one row a task
    and flush. The driver holds the pairs that are too large for a group, fewer than words
    / ``budget`` times two, and two filters.
    """
    if min_count < 1 or most_words < 1:
        raise ValueError("min_count and most_words must be at least 1")
    source = documents.select(
        F.coalesce(column(documents, lang).cast("string"), F.lit(_NO_LANG)).alias("lang"),
        F.coalesce(column(documents, text).cast("string"), F.lit("")).alias("text"),
    )
    frequent = (F.col("phrase") == "") | (F.col("n") >= min_count)
    found = stored(word_counts(source).filter(frequent), "words")
    if most_words > 1:
        words = Filter.of(found.filter("phrase != ''"))
        two = stored(pair_counts(source, words).filter(frequent), "pairs")
        found = found.unionByName(two)
    if most_words > 2:
        pairs = Filter.of(two)
        large: dict[str, list[str]] = {}
        for r in two.filter(F.col("n") > budget).collect():
            large.setdefault(r.lang, []).append(r.phrase)
        total = two.agg(F.sum("n").alias("n")).first().n or 0
        # Prefixes of at most a budget are dealt out by hash; half of it is left for chance.
        groups = max(1, 2 * total // budget)
        parts = suffixes(source, words, pairs, large, most_words)
        found = found.unionByName(stored(subtree_counts(parts, groups, min_count), "subtrees"))
    return found


def collocations(
    documents: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, most_words: int = MOST_WORDS, top: int = 2000, budget: int = BUDGET
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    Phrases are 2 to ``most_words`` words of a piece that occur ``a >= min_count`` times in a
    language (NULL: ``und``) with ``n`` words. The score is the least of floor(1000 a n / (l r))
    over all cuts into a first part that occurs ``l`` times and a rest that occurs ``r``
    times, in whole numbers of 38 digits. A phrase inside a longer one that occurs as often
    is dropped. Ranks are by score, ``a`` (both descending) and phrase, from 1 to ``top``.
    NULL and empty texts have no words; repeated rows count as often as they come; a table
    without frequent phrases gives no rows. No other column is read.
    """
    counts = phrase_counts(documents, lang, text, min_count, most_words, budget)
    words = F.split("phrase", " ")
    size = F.size(words)
    candidates = counts.filter(F.col("phrase").contains(" ")).select("lang", "phrase", F.col("n").alias("a"), words.alias("w"), size.alias("m"))
    cut = F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "a", "m", "w", cut)
    first = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice("w", F.col("k") + 1, F.col("m") - F.col("k")), " ")
    cuts = cuts.select("lang", "phrase", "a", "m", "k", first.alias("first"), rest.alias("rest"))
    parts = counts.filter("phrase != ''")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = stored(cuts, "cuts")

    # A phrase in a longer one that occurs as often is in one that is longer by a word.
    inner = cuts.filter("k = m - 1 AND l = a").select("lang", F.col("first").alias("phrase"))
    inner = inner.union(cuts.filter("k = 1 AND r = a").select("lang", F.col("rest").alias("phrase")))
    totals = counts.filter("phrase = ''").select("lang", F.col("n"))
    score = F.expr("(CAST(1000 AS DECIMAL(38, 0)) * a * n) DIV (CAST(l AS DECIMAL(38, 0)) * r)")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(least).join(inner, ["lang", "phrase"], "left_anti")
    best = best.select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ship_by_value(__name__)
