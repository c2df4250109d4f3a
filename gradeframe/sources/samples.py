"""Reading and writing evaluation sets.

An evaluation set is a table of (id, prompt, reference, model_output, task_type,
metadata). Ids need not be unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.scoring import CLASSIFICATION, GENERATION
from .documents import document_lines, write_documents

RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("reference", T.StringType()),
        T.StructField("model_output", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("metadata", T.VariantType()),
    ]
)
SAMPLE_COLUMNS = RECORD.fieldNames()

# A line is a record, or an object that wraps a list of them.
LINE = T.StructType([*RECORD.fields, T.StructField("samples", T.VariantType())])

# Spellings that mean classification. All others mean generation.
CLASSIFICATION_NAMES = ("classification", "classify", "cls")

# Metadata that counts as none, as JSON text.
_EMPTY_METADATA = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")


def coerce_task_type(c: Column | str) -> Column:
    named = strip(F.lower(F.col(c) if isinstance(c, str) else c)).isin(*CLASSIFICATION_NAMES)
    return F.when(named, F.lit(CLASSIFICATION)).otherwise(F.lit(GENERATION))


def _metadata(df: DataFrame) -> Column:
    none = F.parse_json(F.lit("{}"))
    if "metadata" not in df.columns:
        return none
    kind, value = df.schema["metadata"].dataType, F.col("metadata")
    if isinstance(kind, T.StringType):
        value = F.parse_json(value)
    elif not isinstance(kind, T.VariantType):
        value = F.to_variant_object(value)
    return F.when(value.isNull() | F.to_json(value).isin(*_EMPTY_METADATA), none).otherwise(
        value
    )


def conform_samples(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bring any table with an ``id`` into the sample schema.

    Missing or NULL texts become ``''``, missing metadata ``{}``; further columns
    are dropped, but for those to ``keep``. A row without an id fails the query.
    """

    def text(name: str) -> Column:
        return (
            F.coalesce(F.col(name).cast("string"), F.lit(""))
            if name in df.columns
            else F.lit("")
        )

    task = F.col("task_type") if "task_type" in df.columns else F.lit(None).cast("string")
    # A condition rather than a default: it holds even where the id is not read,
    # and leaves the id a plain column, so that filters on it reach the scan.
    has_id = F.when(F.col("id").isNotNull(), F.lit(True)).otherwise(
        F.raise_error(F.lit("sample without an id")).cast("boolean")
    )
    return df.filter(has_id).select(
        F.col("id").cast("string").alias("id"),
        text("prompt").alias("prompt"),
        text("reference").alias("reference"),
        text("model_output").alias("model_output"),
        coerce_task_type(task).alias("task_type"),
        _metadata(df).alias("metadata"),
        *keep,
    )


def _document_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of whole-file JSON documents, which are cut where that is possible."""
    parsed = F.from_json("line", RECORD, {"mode": "FAILFAST"})
    return document_lines(spark, path).select(parsed.alias("r")).select("r.*")


def line_records(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The records of JSON lines, read with ``LINE``.

    A line is a record, or a wrapper: an object with a list as ``samples`` and no ``id``.
    In a record, ``samples`` is a key like any other unknown one.
    """
    is_list = F.coalesce(F.schema_of_variant("samples").startswith("ARRAY"), F.lit(False))
    wrapper = F.col("id").isNull() & is_list
    itself = F.array(F.lit(None).cast("variant"))
    inner = F.when(wrapper, F.try_variant_get("samples", "$", "array<variant>")).otherwise(itself)
    rows = lines.withColumn("__wrapper", wrapper).withColumn("__item", F.explode(inner))

    def field(f: T.StructField) -> Column:
        kind = f.dataType.simpleString()
        own = F.try_variant_get("__item", f"$.{f.name}", kind)
        return F.when(F.col("__wrapper"), own).otherwise(F.col(f.name)).alias(f.name)

    return rows.select(*[field(f) for f in RECORD.fields], *keep)


def read_samples(spark: SparkSession, path: str, format: str = "ndjson") -> DataFrame:
    """Read an evaluation set.

    ``ndjson`` holds a record per line, or a wrapper ``{"samples": [...]}`` per line.
    ``json`` is one document per file, a list of records or one wrapper; a large one is
    read by many tasks (see ``document_lines``), after a first pass when this is called.
    A file that is not of the given format fails the query.
    """
    if format == "json":
        records = _document_records(spark, path)
    elif format == "ndjson":
        records = line_records(spark.read.schema(LINE).option("mode", "FAILFAST").json(path))
    else:
        records = spark.read.format(format).load(path)
    return conform_samples(records)


def write_samples(
    df: DataFrame, path: str, format: str = "ndjson", mode: str = "errorifexists"
) -> None:
    """Write the six sample columns, as a directory of part files.

    ``read_samples`` with the same format reads them back. As ``json``, each part file is
    a document, a list of samples.
    """
    if format == "json":
        line = F.to_json(F.struct(*SAMPLE_COLUMNS), {"ignoreNullFields": "false"})
        write_documents(df.select(line.alias("line")), path, mode)
        return
    writer = df.select(*SAMPLE_COLUMNS).write.mode(mode)
    if format == "ndjson":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.format(format).save(path)
