"""The languages of texts: scores per word, smoothed by Viterbi into spans."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Batches, column, map_texts, ship_by_value

# Code point ranges of scripts. Letters elsewhere are of script 0.
SCRIPTS: tuple[tuple[str, tuple[tuple[int, int], ...]], ...] = (
    ("other", ()),
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F))),
    ("han", ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF))),
)
_BUCKETS = 1 << 15
_PLANE = 1 << 16
# What a word costs a language whose script it does not have.
_WRONG_SCRIPT = -1000.0


def _tables() -> tuple[np.ndarray, np.ndarray]:
    letters = np.fromiter((chr(i).isalpha() for i in range(_PLANE)), np.bool_, _PLANE)
    scripts = np.zeros(_PLANE, np.int8)
    for number, (_, ranges) in enumerate(SCRIPTS):
        for low, high in ranges:
            scripts[low : high + 1] = number
    return letters, scripts


_LETTER, _SCRIPT = _tables()


def _lowered(text: str) -> str:
    """Lower-case letters, one for each code point, so that offsets stay."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Words:
    """The words of several texts: runs of letters, with hashed trigrams of each letter."""

    hashes: np.ndarray  # of each letter
    first: np.ndarray  # index of each word's first letter, in ``hashes``
    start: np.ndarray  # where each word starts and ends in its text
    end: np.ndarray
    text: np.ndarray  # which text each word is in
    script: np.ndarray  # of each word's first letter


def split_words(texts: list[str]) -> Words:
    """Trigrams reach over a word's ends, so that they know first and last letters."""
    lowered = [_lowered(t) for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTER[np.minimum(points, _PLANE - 1)]
    beyond = np.flatnonzero(points >= _PLANE)
    if len(beyond):
        rare, which = np.unique(points[beyond], return_inverse=True)
        letter[beyond] = np.fromiter((chr(i).isalpha() for i in rare), np.bool_, len(rare))[which]
    code = np.where(letter, points, 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none, none)
    before = np.where(at > 0, code[at - 1], 0)
    mixed = before * np.uint32(0x9E3779B1) + code[at] * np.uint32(0x85EBCA77) + code[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    starts = before == 0
    first = np.flatnonzero(starts)
    start = at[first]
    end = at[np.append(first[1:], len(at)) - 1] + 1
    text = np.searchsorted(offsets, start, "right") - 1
    # Beyond the first plane, the second and third hold ideographs, the others letters of script 0.
    ideograph = (points[start] >= 2 * _PLANE) & (points[start] < 4 * _PLANE)
    script = np.where(points[start] < _PLANE, _SCRIPT[np.minimum(points[start], _PLANE - 1)], np.where(ideograph, len(SCRIPTS) - 1, 0))
    return Words(
        (mixed & np.uint32(_BUCKETS - 1)).astype(np.int64), first, start - offsets[text], end - offsets[text], text, script
    )


@dataclass
class Languages:
    """What is learned: log-probabilities of trigrams, and the scripts of each language."""

    names: list[str]
    trigrams: np.ndarray  # _BUCKETS x languages
    allowed: np.ndarray  # scripts x languages
    switch: float

    def word_scores(self, words: Words) -> np.ndarray:
        scores = np.add.reduceat(self.trigrams[words.hashes], words.first, axis=0)
        return scores + np.where(self.allowed, 0.0, _WRONG_SCRIPT).astype(np.float32)[words.script]

    def paths(self, words: Words, n_texts: int) -> np.ndarray:
        """The language of each word, on the best path through its text.

        Every change of language costs ``switch``. Texts are worked through side by side,
        one word of each at a time, longest texts first.
        """
        scores = self.word_scores(words)
        counts = np.bincount(words.text, minlength=n_texts)
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
        order = np.argsort(-counts, kind="stable")
        begin, counts = begin[order], counts[order]
        longest = int(counts[0])
        # How many texts have a word at each step.
        alive = np.searchsorted(-counts, -np.arange(longest), "left")
        back = np.empty(scores.shape, np.int16)
        value = np.zeros((int(alive[0]), len(self.names)), np.float64)
        for step in range(longest):
            at = begin[: alive[step]] + step
            value = value[: alive[step]]
            best = value.argmax(1)
            jump = value[np.arange(len(best)), best] - self.switch
            moves = value < jump[:, None]
            back[at] = np.where(moves, best[:, None], np.arange(len(self.names)))
            value = np.where(moves, jump[:, None], value) + scores[at]
            if step + 1 == longest or alive[step + 1] < len(value):
                done = slice(int(alive[step + 1]) if step + 1 < longest else 0, len(value))
                scores[at[done], 0] = value[done].argmax(1)  # the last state, kept in a spent cell
        path = np.empty(len(scores), np.int16)
        state = np.zeros(int(alive[0]), np.int64)
        for step in range(longest - 1, -1, -1):
            at = begin[: alive[step]] + step
            ends = slice(int(alive[step + 1]) if step + 1 < longest else 0, int(alive[step]))
            state[ends] = scores[at[ends], 0].astype(np.int64)
            now = state[: alive[step]]
            path[at] = now
            state[: alive[step]] = back[at, now]
        return path


def fit(
    documents: DataFrame,
    usable: Column,
    text: str = "text",
    language: str = "lang",
    smoothing: float = 0.5,
    switch: float = 12.0,
    script_share: float = 0.01,
) -> Languages | None:
    """Learn from all ``usable`` documents with a language; None if there are none.

    Tasks count trigrams and scripts by language and send the sums, so what reaches the
    driver is bounded by the number of languages, not of documents. A language has the
    scripts that at least ``script_share`` of its words are written in.
    """
    source = documents.filter(usable & column(documents, language).isNotNull()).select(
        column(documents, language).cast("string").alias("lang"), column(documents, text).cast("string").alias("text")
    )

    def count(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = np.array([t or "" for t in batch.column("text").to_pylist()], dtype=object)
            for name in sorted(set(names)):
                own = [str(t) for t in texts[names == name]]
                total = sums.setdefault(name, np.zeros(_BUCKETS + len(SCRIPTS), np.int64))
                for at in range(0, len(own), 256):
                    words = split_words(own[at : at + 256])
                    total[:_BUCKETS] += np.bincount(words.hashes, minlength=_BUCKETS)
                    total[_BUCKETS:] += np.bincount(words.script, minlength=len(SCRIPTS))
        for name, total in sums.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen)), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())],
                names=["lang", "place", "n"],
            )

    counted = source.mapInArrow(count, "lang string, place int, n bigint")
    table = counted.groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    if table.empty:
        return None
    names = sorted(set(table["lang"]))
    sums = np.zeros((_BUCKETS + len(SCRIPTS), len(names)))
    sums[table["place"], table["lang"].map(names.index)] = table["n"]
    grams, scripts = sums[:_BUCKETS], sums[_BUCKETS:]
    trigrams = np.log((grams + smoothing) / (grams.sum(0) + smoothing * _BUCKETS)).astype(np.float32)
    share = scripts / np.maximum(1, scripts.sum(0))
    allowed = share >= script_share
    allowed[~allowed.any(1)] = True  # a script that no language has rules none out
    return Languages(names, trigrams, allowed, switch)


UNKNOWN = "und"


def identify(texts: list[str], model: Languages | None) -> list[tuple[str, float, list[dict]]]:
    """(language, share of the letters in it, spans) for each text."""
    words = split_words(texts)
    if model is None or not len(words.text):
        return [(UNKNOWN, 0.0, []) for _ in texts]
    path = model.paths(words, len(texts))
    length = words.end - words.start
    letters = np.zeros((len(texts), len(model.names)))
    np.add.at(letters, (words.text, path), length)
    best, total = letters.argmax(1), letters.sum(1)
    changes = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (words.text[1:] != words.text[:-1])))
    last = np.append(changes[1:], len(path)) - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for text, lang, start, end in zip(
        words.text[changes].tolist(), path[changes].tolist(), words.start[changes].tolist(), words.end[last].tolist()
    ):
        spans[text].append({"start": start, "end": end, "lang": model.names[lang]})
    return [
        (model.names[best[i]], float(letters[i, best[i]] / total[i]), spans[i]) if total[i] else (UNKNOWN, 0.0, [])
        for i in range(len(texts))
    ]


def with_language(df: DataFrame, model: Languages | None, keep_text: bool = False) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``spans`` (start, end, lang) of ``text``.

    A text is labelled with the language most of its letters are in, ties by name, and
    scored by the share of those letters; spans are in code points, from the first letter
    of a span to its last. A text without letters (NULL, empty) is ``und``, score 0.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(texts: list[str]) -> list[pa.Array]:
        names, scores, spans = zip(*identify(texts, model)) if texts else ((), (), ())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span)]

    schema = "lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>"
    return map_texts(df, run, schema, keep_text, chunk_chars=2_000_000)


ship_by_value(__name__)
