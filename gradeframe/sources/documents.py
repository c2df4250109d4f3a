"""Reading large JSON documents by many tasks.

Spark's text reader splits a file at any byte, if there is a separator to resume at. With
``}`` as the separator it deals out pieces of a JSON document that end where an object
may end. Whether one does depends on all before it: on being inside a string, and
on how many brackets are open. A first pass works that out for each split under both
assumptions about strings; chained from split to split, it gives the state each starts in.
The second pass then knows the ends of records. One that reaches over a split comes
in fragments, which are put together by record.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]

_STRING = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
_BRACKET = re.compile(rb"[\[\]{}]")
_LIST = re.compile(rb'(?:\xef\xbb\xbf)?\s*(\[|\{\s*"samples"\s*:\s*\[)')
_COMPRESSED = (".gz", ".gzip", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".xz")
_EXPECTED = "an evaluation set is a list of objects, or an object with such a list as samples"


@dataclass
class _Scan:
    """Goes through pieces of a document; depth 0 is inside the list of records."""

    in_string: bool = False
    depth: int = 0
    lowest: int = 0

    def piece(self, piece: bytes) -> None:
        """Take in a piece and the ``}`` that ends it."""
        plain = _STRING.sub(b"", (b'"' if self.in_string else b"") + piece)
        odd = plain.find(b'"')
        self.in_string = odd >= 0
        if self.in_string:
            plain = plain[:odd]
        for bracket in _BRACKET.findall(plain):
            self.depth += 1 if bracket in b"[{" else -1
            self.lowest = min(self.lowest, self.depth)
        if not self.in_string:
            self.depth -= 1
            self.lowest = min(self.lowest, self.depth)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    pieces = spark.read.option("lineSep", "}").text(path)
    where = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_size")]
    return pieces.select(*where, F.col("value").cast("binary").alias("piece"))


_SPLITS = (
    "file string, start bigint, size bigint, bytes bigint, kind string, "
    "splits array<struct<in_string: boolean, depth: int, lowest: int, ends: array<int>>>"
)


def _survey(batches: Batches) -> Batches:
    """One row for each split: what it does to either state it may start in."""
    current: tuple | None = None

    def done() -> pa.RecordBatch:
        file, start, size, n, kind, scans, ends = current
        after = [
            {"in_string": s.in_string, "depth": s.depth, "lowest": s.lowest, "ends": sorted(e)} for s, e in zip(scans, ends)
        ]
        schema = pa.schema(
            [
                ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("kind", pa.string()),
                ("splits", pa.list_(pa.struct([("in_string", pa.bool_()), ("depth", pa.int32()), ("lowest", pa.int32()), ("ends", pa.list_(pa.int32()))]))),
            ]
        )
        return pa.RecordBatch.from_pylist(
            [{"file": file, "start": start, "size": size, "bytes": n, "kind": kind, "splits": after}], schema
        )

    for batch in batches:
        for file, start, size, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or current[:2] != (file, start):
                if current is not None:
                    yield done()
                head = _LIST.match(piece) if start == 0 else None
                kind = None if start else "list" if head and head.group(1) == b"[" else "wrapper" if head else "other"
                current = file, start, size, 0, kind, (_Scan(), _Scan(True)), (set(), set())
                rest = piece[head.end() :] if head else piece
            else:
                rest = piece
            current = (*current[:3], current[3] + len(piece) + 1, *current[4:])
            for scan, ends in zip(current[5], current[6]):
                scan.piece(rest)
                # Lower than ever, or the list has ended before.
                if not scan.in_string and scan.depth == scan.lowest:
                    ends.add(scan.depth)
    if current is not None:
        yield done()


@dataclass(frozen=True)
class _Start:
    """What a split has to know: its state, which records its first and last fragment belong
    to, and whether the file ends with its last piece, and that without a ``}``."""

    in_string: bool
    depth: int
    ended: bool
    head: int
    tail: int
    last: bool
    open_end: bool
    kind: str


def _starts(splits: list) -> dict[tuple[str, int], _Start]:
    """Chain the splits of each file; one small row for each split that Spark schedules."""
    files: dict[str, list] = {}
    for s in splits:
        files.setdefault(s.file, []).append(s)
    found = {}
    for file, own in files.items():
        own.sort(key=lambda s: s.start)
        kind = own[0].kind or "other"
        if kind == "other":
            continue
        in_string, depth, ended, group = False, 0, False, 0
        # Pieces are a byte longer with their separator, which the last one may lack.
        read = sum(s.bytes for s in own)
        # A byte order mark is not read.
        open_end = read - own[0].size in (1, -2) if not file.endswith(_COMPRESSED) else kind == "list"
        for i, s in enumerate(own):
            after = s.splits[in_string]
            head = group
            if not ended and -depth in after.ends:
                group += 1
            found[file, s.start] = _Start(in_string, depth, ended, head, group, i == len(own) - 1, open_end, kind)
            ended = ended or depth + after.lowest < 0
            in_string, depth = after.in_string, depth + after.depth
    return found


_FRAGMENTS = "file string, grp int, place bigint, part int, whole boolean, kind string, text binary"


def _cut(batches: Batches, starts: dict[tuple[str, int], _Start], other: frozenset[str]) -> Batches:
    """Whole records of the splits, and fragments of those that reach over their ends.

    What follows the last record of a file, the end of the list included, is one more
    record, ``kind`` tells which sort of document it is the end of.
    """
    names = ["file", "grp", "place", "part", "whole", "kind", "text"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.binary()]
    rows: list[tuple] = []
    weight = 0

    def batch() -> Batches:
        nonlocal rows, weight
        for first in range(0, len(rows), 10_000):
            columns = zip(*rows[first : first + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        rows, weight = [], 0

    at: tuple[str, int] | None = None
    here: _Start | None = None
    text: list[bytes] = []
    scan = _Scan()
    cut, ended = False, False

    def finish() -> None:
        if here is not None:
            rest = b"".join(text)
            if here.last and here.open_end and rest.endswith(b"}"):
                rest = rest[:-1]
            group = here.tail if cut else here.head
            rows.append((at[0], group, at[1], 1 if cut else 0, False, here.kind if here.last else None, rest))

    for each in batches:
        for file, start, _, piece in zip(*(c.to_pylist() for c in each.columns)):
            if file in other:
                continue
            if at != (file, start):
                finish()
                at = file, start
                here = starts.get(at)
                if here is None:
                    raise ValueError(f"the splits of {file} have changed while it was read; read it again")
                text, cut, ended = [], False, here.ended
                scan = _Scan(here.in_string, here.depth)
                scan.piece(piece[_LIST.match(piece).end() :] if start == 0 else piece)
            else:
                scan.piece(piece)
            text.append(piece + b"}")
            ended = ended or scan.lowest < 0
            if scan.depth == 0 and not scan.in_string and not ended:
                whole = cut
                rows.append((file, here.tail if cut else here.head, start, 0, whole, None, b"".join(text)))
                weight += len(rows[-1][-1])
                text, cut = [], True
        if weight > 8_000_000 or len(rows) > 10_000:
            yield from batch()
    finish()
    yield from batch()


def _end(kind: str, first: bool, text: bytes) -> None:
    """Check what follows the last record of a document."""
    head = _LIST.match(text) if first else None
    rest = text[head.end() :] if head else text
    if kind == "list":
        if len(json.loads((b"[" if first else b"[0") + rest)) != (0 if first else 1):
            raise ValueError(_EXPECTED)
        return

    def once(pairs: list[tuple]) -> dict:
        if [k for k, _ in pairs].count("samples") > 1:
            raise ValueError("a document names samples twice")
        return dict(pairs)

    json.loads(b'{"samples": [' + rest, object_pairs_hook=once)


def _lines(batches: Batches) -> Batches:
    """Each record as one line of JSON, parsed and checked."""
    for batch in batches:
        lines = []
        for group, first, kind, text in zip(*(batch.column(c).to_pylist() for c in ("grp", "first", "kind", "text"))):
            if kind is not None:
                _end(kind, first, text)
                continue
            head = _LIST.match(text) if first else re.match(rb"\s*,", text)
            if head is None:
                raise ValueError(_EXPECTED)
            record = json.loads(text[head.end() :])
            if not isinstance(record, dict):
                raise ValueError(_EXPECTED)
            lines.append(json.dumps(record, ensure_ascii=False))
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])


def _whole_lines(batches: Batches) -> Batches:
    """The records of documents that are not cut."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            document = json.loads(text)
            if isinstance(document, dict):
                document = document.get("samples", [])
            if not isinstance(document, list) or not all(isinstance(r, dict) for r in document):
                raise ValueError(_EXPECTED)
            lines = [json.dumps(r, ensure_ascii=False) for r in document]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])


def document_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (line): each record of whole-file JSON documents, as one line of JSON.

    A document is a list of objects, or an object with such a list as ``samples``. Files are
    read by as many tasks as they have splits if they are lists, or wrappers whose
    first key is ``samples``; a record is put together by one task, and so is all that
    follows the list in a wrapper. Other documents, which may have ``samples`` anywhere or
    nowhere, are read whole, by one task a file. An empty file has no rows. Broken JSON,
    records that are no objects and anything after the document fail the query.

    The first pass over the files runs when this is called; files that change before the
    second one fail it.
    """
    splits = _pieces(spark, path).mapInArrow(_survey, _SPLITS).collect()
    starts = _starts(splits)
    cut = {file for file, _ in starts}
    other = frozenset(s.file for s in splits) - cut
    lines = None
    if cut:

        def run(batches: Batches) -> Batches:
            return _cut(batches, starts, other)

        found = _pieces(spark, path).mapInArrow(run, _FRAGMENTS)
        whole = found.filter("whole").select("grp", F.lit(False).alias("first"), "kind", "text")
        parts = found.filter("NOT whole").groupBy("file", "grp").agg(
            F.array_sort(F.collect_list(F.struct("place", "part", "text"))).alias("parts"), F.max("kind").alias("kind")
        )
        text = F.aggregate("parts", F.lit(b""), lambda t, p: F.concat(t, p["text"])).alias("text")
        joined = parts.select("grp", (F.col("grp") == 0).alias("first"), "kind", text)
        lines = whole.unionByName(joined).mapInArrow(_lines, "line string")
    if other or lines is None:
        uncut = F.col("_metadata.file_path").isin(*other) if other else F.lit(False)
        texts = spark.read.text(path, wholetext=True).filter(uncut)
        texts = texts.select("value").mapInArrow(_whole_lines, "line string")
        lines = texts if lines is None else lines.unionByName(texts)
    return lines


def write_documents(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows (line) of JSON objects as lists, one document for each partition.

    Rows stream into the file of their partition. A partition without rows is ``[]``.
    """

    def run(batches: Batches) -> Batches:
        before = "["
        for batch in batches:
            if batch.num_rows:
                rows = [f"{before if i == 0 else ','}{line}" for i, line in enumerate(batch.column(0).to_pylist())]
                before = ","
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if before == "[" else "]"], pa.string())], names=["value"])

    lines.mapInArrow(run, "value string").write.mode(mode).text(path)


# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
