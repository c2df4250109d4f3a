"""Encoding texts with a given SentencePiece BPE model, and decoding them again.

Merges are made in rounds over all words of a slice at once: flat arrays of symbols, the
best pair of each word, all its leftmost occurrences merged, arrays compacted, until no
pair is left. The model is read from its file; nothing is trained.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .store import map_texts, pairs, ship_by_value

_SPACE = "▁"
_WORDS = re.compile(f"[ {_SPACE}]*[^ {_SPACE}]+|[ {_SPACE}]+")
_NONE = np.int64(1) << 40  # the rank of what cannot be merged

_LONG = 512  # symbols of a part that may be finished one pair at a time

# Values of the model's file format: kinds of pieces.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, message[at : at + size]
        at += size


@dataclass
class Pieces:
    """Tables of a model. Symbols are the ids of pieces, then characters that occur only
    inside of pieces; the last symbol stands for all other characters."""

    names: list[str]
    kinds: np.ndarray
    begin: int
    end: int
    unknown_text: str
    symbols: int
    chars: np.ndarray  # code points that have a symbol, ascending
    char_symbols: np.ndarray
    pair_keys: np.ndarray  # left * symbols + right, ascending
    pair_pieces: np.ndarray
    inside: np.ndarray  # pairs of neighbouring characters inside of pieces, ascending
    ranks: np.ndarray  # of pieces; equal scores have equal ranks
    hasty: np.ndarray  # by rank: a merge may at once open another one that is as good
    byte_ids: np.ndarray
    longest: int  # characters of a piece

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self.pair_keys.tolist(), self.pair_pieces.tolist()))

    @classmethod
    def read(cls, path: str) -> Pieces:
        """The tables of a model file.

        Refuses, with a ValueError, what this module would not encode exactly: other
        models than BPE, a normaliser that changes characters, pieces defined by the user,
        no fallback to bytes, or pieces that reach from one word into the next.
        """
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        trainer = dict(_fields(next((v for f, v in fields if f == 2), b"")))
        normal = dict(_fields(next((v for f, v in fields if f == 3), b"")))
        names, scores, kinds = [], [], []
        for piece in (dict(_fields(v)) for f, v in fields if f == 1):
            names.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, _NORMAL))
        usable = [i for i, k in enumerate(kinds) if k == _NORMAL]
        wanted = {
            "a BPE model": trainer.get(3) == 2,
            "byte fallback": trainer.get(35) == 1,
            "an identity normaliser": not normal.get(2),
            "a space put before the text": normal.get(3, 1) == 1,
            "spaces kept as they are": normal.get(4, 1) == 0 and normal.get(5, 1) == 1,
            "spaces at the start of words": trainer.get(24, 0) == 0,
            "no pieces defined by the user or unused": not {_USER, _UNUSED} & set(kinds),
            "pieces of one word": not any(_SPACE in names[i].lstrip(_SPACE) for i in usable),
        }
        if not all(wanted.values()):
            raise ValueError("the model must have " + ", ".join(k for k, ok in wanted.items() if not ok))

        ids = {names[i]: i for i in usable}
        chars = sorted({c for name in ids for c in name})
        extra = [c for c in chars if c not in ids]
        symbol = {**ids, **{c: len(names) + i for i, c in enumerate(extra)}}
        symbols = len(names) + len(extra) + 1
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in usable}, reverse=True))}
        ranks = np.full(symbols, _NONE, np.int64)
        ranks[usable] = [order[scores[i]] for i in usable]

        merges: dict[int, int] = {}
        hasty = np.zeros(len(order), bool)
        for name, piece in ids.items():
            for cut in range(1, len(name)):
                left, right = symbol.get(name[:cut]), symbol.get(name[cut:])
                if left is None or right is None:
                    continue
                merges[left * symbols + right] = piece
                for part in (left, right):
                    if ranks[piece] <= ranks[part] < _NONE:
                        hasty[ranks[part]] = True
        keys = np.array(sorted(merges), np.int64)
        inside = {ord(a) << 32 | ord(b) for name in ids for a, b in zip(name, name[1:])}
        byte_ids = np.full(256, -1, np.int64)
        for i, kind in enumerate(kinds):
            if kind == _BYTE:
                byte_ids[int(names[i][3:-1], 16)] = i
        return cls(
            names=names,
            kinds=np.array(kinds),
            begin=names.index(trainer.get(46, b"<s>").decode()),
            end=names.index(trainer.get(47, b"</s>").decode()),
            unknown_text=trainer.get(44, " ⁇ ".encode()).decode(),
            symbols=symbols,
            chars=np.array([ord(c) for c in chars], np.int64),
            char_symbols=np.array([symbol[c] for c in chars], np.int64),
            pair_keys=keys,
            pair_pieces=np.array([merges[k] for k in keys.tolist()], np.int64),
            inside=np.array(sorted(inside), np.int64),
            ranks=ranks,
            hasty=hasty,
            byte_ids=byte_ids,
            longest=max(map(len, ids), default=1),
        )

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that each pair of symbols makes, and its rank."""
        key = left * self.symbols + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        piece = np.where(self.pair_keys[at] == key, self.pair_pieces[at], self.symbols - 1)
        return piece, self.ranks[piece]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers.

        A word is cut where no piece has the two neighbouring characters side by side: no
        merge can cross that place, so the parts are merged independently.
        """
        if not words:
            return []
        text = "".join(words).replace(" ", _SPACE)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        known = self.chars[at] == code
        start = np.where(known, self.char_symbols[at], self.symbols - 1)
        last = np.ones(len(code), bool)
        if len(self.inside):
            key = code[:-1] << 32 | code[1:]
            near = np.minimum(np.searchsorted(self.inside, key), len(self.inside) - 1)
            last[:-1] = self.inside[near] != key
        last[ends[lengths > 0] - 1] = True
        symbol = self._merge(start, last)

        # Characters without a piece become the pieces of their bytes.
        place = np.flatnonzero(symbol >= 0)
        symbol = symbol[place]
        odd = np.flatnonzero(symbol >= len(self.names))
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in code[place[odd]].tolist()]
        width = np.ones(len(symbol), np.int64)
        width[odd] = [len(b) for b in raw]
        ids = np.repeat(symbol, width)
        if len(odd):
            bytes_at = np.repeat(np.isin(np.arange(len(symbol)), odd), width)
            ids[bytes_at] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        before = np.concatenate([[0], np.cumsum(width)])
        cuts = before[np.searchsorted(place, np.concatenate([[0], ends]))] * 4
        flat = ids.astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _merge(self, symbol: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The symbols that are left, each at the place of its first character, else -1.

        In each round the pairs of least rank of a part are merged, all its occurrences
        from the left that do not overlap. Merging one pair at a time leads to the same,
        unless the new piece may be in a pair as good or better, which then comes first. All
        that follows at once from a merge lies within a piece's length; so of occurrences
        nearer than twice that, only the first is merged in a round. Long parts, where this
        may take as many rounds as symbols, are finished one pair at a time.
        """
        out = np.full(len(symbol), -1, np.int64)
        place = np.arange(len(symbol))
        piece = np.full(len(symbol), self.symbols - 1, np.int64)
        rank = np.full(len(symbol), _NONE)
        open_ = np.flatnonzero(~last)
        piece[open_], rank[open_] = self.merged(symbol[open_], symbol[open_ + 1])
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            sizes = np.diff(np.append(starts, len(symbol)))
            least = np.minimum.reduceat(rank, starts)
            hasty = (least < _NONE) & self.hasty[np.minimum(least, len(self.hasty) - 1)]
            single = hasty & (sizes > _LONG)
            for s in np.flatnonzero(single).tolist():
                a, b = starts[s], starts[s] + sizes[s]
                for i, value in self._one_by_one(symbol[a:b].tolist()):
                    out[place[a + i]] = value
            closed = np.repeat(least == _NONE, sizes)
            out[place[closed]] = symbol[closed]
            keep = ~(closed | np.repeat(single, sizes))
            pick = np.flatnonzero((rank == np.repeat(least, sizes)) & keep)
            # Of neighbours that overlap, every second one.
            fresh = np.concatenate([[True], np.diff(pick) != 1]) if len(pick) else np.zeros(0, bool)
            order = np.arange(len(pick))
            even = (order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0
            part = np.repeat(np.arange(len(starts)), sizes)[pick]
            alone = np.ones(len(pick), bool)
            alone[1:] = (np.diff(part) > 0) | (np.diff(pick) > 2 * self.longest)
            pick = pick[np.where(hasty[part], alone, even)]
            symbol[pick] = piece[pick]
            last[pick] = last[pick + 1]
            keep[pick + 1] = False
            new_place = np.cumsum(keep) - 1
            symbol, last, place, piece, rank = (x[keep] for x in (symbol, last, place, piece, rank))
            changed = new_place[pick]
            changed = np.concatenate([changed, changed[changed > 0] - 1])
            ended = last[changed]
            rank[changed[ended]] = _NONE
            changed = changed[~ended]
            if len(changed):
                piece[changed], rank[changed] = self.merged(symbol[changed], symbol[changed + 1])
        return out

    def _one_by_one(self, symbol: list[int]) -> list[tuple[int, int]]:
        """(place, symbol) of what is left of one part, best pair first, then leftmost."""
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap: list[tuple[int, int, int, int, int]] = []

        def add(left: Iterable[int]) -> None:
            for i in left:
                if i >= 0 and after[i] < n:
                    p = self.pairs.get(symbol[i] * self.symbols + symbol[after[i]])
                    if p is not None:
                        heapq.heappush(heap, (ranks[p], i, symbol[i], symbol[after[i]], p))

        add(range(n - 1))
        while heap:
            _, i, a, b, p = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbol[i] != a or symbol[j] != b:
                continue
            symbol[i], symbol[j] = p, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            add((before[i], i))
        return [(i, s) for i, s in enumerate(symbol) if s >= 0]


class Encoder:
    """Ids of texts. Words met before are looked up; what is remembered is bounded by
    ``most`` words and forgotten when full, which changes no id."""

    def __init__(self, pieces: Pieces, edges: bool = True, most: int = 200_000):
        self.pieces, self.most = pieces, most
        self.known: dict[str, bytes] = {}
        self.edges = tuple(struct.pack("<I", i) if edges else b"" for i in (pieces.begin, pieces.end))

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [_WORDS.findall(" " + t) if t else [] for t in texts]
        wanted = {w for text in words for w in text}
        if len(self.known) + len(wanted) > self.most:
            self.known.clear()
        new = [w for w in wanted if w not in self.known]
        self.known.update(zip(new, self.pieces.encode_words(new)))
        look = self.known.__getitem__
        return [self.edges[0] + b"".join(map(look, text)) + self.edges[1] for text in words]


class Decoder:
    """Texts of ids. Control pieces have no text; the space before the first piece goes;
    bytes that are no UTF-8 become U+FFFD, one each."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        kinds = pieces.kinds
        self.high = np.zeros(len(kinds), bool)
        self.text = []
        for i, name in enumerate(pieces.names):
            if kinds[i] == _BYTE:
                value = int(name[3:-1], 16)
                self.high[i] = value >= 128
                self.text.append(chr(value))
            elif kinds[i] in (_CONTROL, _UNKNOWN):
                self.text.append("" if kinds[i] == _CONTROL else pieces.unknown_text)
            else:
                self.text.append(name.replace(_SPACE, " "))

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        if not len(ids):
            return ""
        high = self.high[ids]
        first = next((i for i in ids.tolist() if self.pieces.kinds[i] != _CONTROL), None)
        look = self.text.__getitem__
        if not high.any():
            text = "".join(map(look, ids.tolist()))
        else:
            parts = []
            cuts = np.flatnonzero(np.diff(high)) + 1
            for run, is_high in zip(np.split(ids, cuts), high[np.concatenate([[0], cuts])]):
                part = "".join(map(look, run.tolist()))
                parts.append(_utf8(part.encode("latin-1")) if is_high else part)
            text = "".join(parts)
        led = first is not None and self.pieces.kinds[first] == _NORMAL and text.startswith(" ")
        return text[1:] if led else text


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    found, at = [], 0
    while at < len(raw):
        size = next((n for n in (2, 3, 4) if _valid(raw[at : at + n], n)), 0)
        found.append(raw[at : at + size].decode() if size else "�")
        at += size or 1
    return "".join(found)


def _valid(raw: bytes, size: int) -> bool:
    try:
        return len(raw) == size and len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def encoded(documents: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text", edges: bool = True) -> DataFrame:
    """Rows (key, ids), one for each document: its ids as little-endian unsigned 32-bit
    integers in a binary, with the begin and end ids if ``edges``.

    NULL and empty texts have no ids but the edges. Repeated rows and NULL keys are kept;
    no other column is read. Texts are handled where they are read, without a shuffle; a
    word of any length is encoded whole. The tables of the model (4 MB) go to every task.
    """
    cache: list[Encoder] = []

    def run(texts: list[str]) -> list[pa.Array]:
        if not cache:
            cache.append(Encoder(pieces, edges))
        return [pa.array(cache[0].encode(texts), pa.binary())]

    return map_texts(pairs(documents, key, text), run, "ids binary", chunk_chars=1_000_000).withColumnRenamed("key", key)


def decoded(rows: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of a column of packed ids, as ``encoded`` makes them (NULL: NULL)."""
    if text in rows.columns:
        raise ValueError(f"there is a column {text} already")
    out = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(pieces)
        for batch in batches:
            texts = [None if p is None else decoder.decode(p) for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=out.names)

    return rows.mapInArrow(run, out)


ship_by_value(__name__)
