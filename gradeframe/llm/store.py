"""What the operators of this package share: stored tables, row keys, Arrow columns."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder

Batches = Iterator[pa.RecordBatch]

# Small tables are broadcast up to this measured size, joined by a shuffle beyond it.
BROADCAST_BYTES = 32 * 1024 * 1024


def ship_by_value(module: str) -> None:
    """Send the functions of a module to executors by value: they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage in a way that outlives executors, and computes ``df`` once however
    often the result is read. The files go with the shared folder.
    """
    path = f"{shared_folder(df.sparkSession)}/gradeframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, name: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Store a table whose size is not known beforehand, and mark it for a broadcast if
    its measured size allows; otherwise joins with it shuffle. The rows are the same."""
    kept = stored(df, name)
    width = sum(_bytes(column(kept, f.name), f.dataType) for f in df.schema.fields)
    size = kept.agg(F.sum(F.lit(32) + width).alias("n")).first().n or 0
    return F.broadcast(kept) if size <= limit else kept


def _bytes(c: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in a row, all it holds included."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(c).cast("bigint")
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(c, F.lit(0).cast("bigint"), lambda n, e: n + _bytes(e, kind.elementType))
    elif isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        size = _bytes(F.map_keys(c), keys) + _bytes(F.map_values(c), values)
    elif isinstance(kind, T.StructType):
        size = sum((_bytes(c.getField(f.name), f.dataType) for f in kind.fields), F.lit(0).cast("bigint"))
    else:
        return F.lit(16).cast("bigint")
    return F.lit(16) + F.coalesce(size, F.lit(0))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns, lengthened until the table has none like them in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return df["`" + name.replace("`", "``") + "`"]


def pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator reads, as ``key`` and ``text`` (NULL texts become '').

    Whatever else the table holds, clashing names included, is left out.
    """
    return df.select(
        column(df, key).alias("key"), F.coalesce(column(df, text).cast("string"), F.lit("")).alias("text")
    )


def map_texts(
    df: DataFrame,
    function: Callable[[list[str]], list[pa.Array]],
    schema: str,
    keep_text: bool = False,
    chunk_chars: int = 4_000_000,
) -> DataFrame:
    """Add columns that Python works out from ``text``, and drop ``text`` unless it is kept.

    NULL texts count as empty. Texts are handed over in slices of about ``chunk_chars`` characters, so that memory
    is bounded by the longest text, not by the batch. One row in, one row out.
    """
    kept = [f for f in df.schema.fields if keep_text or f.name != "text"]
    out = T.StructType([*kept, *T._parse_datatype_string(schema).fields])
    names = [f.name for f in kept]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text")
            start = 0
            while start < batch.num_rows:
                stop, size = start, 0
                while stop < batch.num_rows and (stop == start or size < chunk_chars):
                    size += len(texts[stop].as_buffer()) if texts[stop].is_valid else 0
                    stop += 1
                part = batch.slice(start, stop - start)
                values = part.column("text").to_pylist()
                added = function(["" if t is None else t for t in values])
                arrays = [part.column(n) for n in names] + added
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)
                start = stop

    return df.mapInArrow(run, out)


ship_by_value(__name__)
