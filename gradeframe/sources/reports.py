"""Writing and reading reports: a run is readable as a whole or not at all."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.report import report_results, report_statistics

_RESULTS = (
    "sample_id string, task_type string, passed boolean, scores map<string, double>, "
    "reference string, model_output string"
)
_STATISTICS = (
    "generated_at string, total bigint, passed bigint, pass_rate double, "
    "avg_scores map<string, double>"
)
_MANIFEST = "results bigint, statistics bigint, finished_at string"


def _folder(path: str, run: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
        raise ValueError(f"not a name for a run: {run!r}")
    return f"{path}/run={run}"


def write_report(results: DataFrame, summary: DataFrame, path: str, run: str | None = None) -> str:
    """Write ``results``, ``statistics`` and then a manifest below ``path/run=<run>``.

    Returns the name of the run, a new one unless given. All three are JSON lines. The
    manifest says how many rows the others have; a run without it did not finish, and
    ``read_report`` refuses it. A run is never overwritten: what a stopped one left stays
    there under its own name, so its name cannot be used again.

    Pass results that are already stored: they are read here, and were read for the
    summary.
    """
    run = run or uuid.uuid4().hex
    folder = _folder(path, run)
    counts = {}
    for name, rows in (("results", report_results(results)), ("statistics", report_statistics(summary))):
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("error").json(f"{folder}/{name}")
        counts[name] = F.lit(seen.get["n"]).cast("bigint").alias(name)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at")
    manifest = results.sparkSession.range(1).coalesce(1).select(*counts.values(), now)
    manifest.write.mode("error").json(f"{folder}/manifest")
    return run


def report_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows (run, results, statistics, finished_at), one for each finished run below ``path``."""
    schema = f"{_MANIFEST}, run string"
    try:
        found = spark.read.schema(schema).option("basePath", path).json(f"{path}/run=*/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], schema)
    return found.select("run", "results", "statistics", "finished_at")


def read_report(spark: SparkSession, path: str, run: str) -> tuple[DataFrame, DataFrame]:
    """The results and statistics of a finished run; ValueError for any other.

    A job of one row reads the manifest. Files lost since then fail this call too, as rows
    are counted against it.
    """
    folder = _folder(path, run)
    try:
        manifest = spark.read.schema(_MANIFEST).json(f"{folder}/manifest").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        manifest = None
    if manifest is None:
        raise ValueError(f"run {run} below {path} is not finished")
    found = {}
    for name, schema in (("results", _RESULTS), ("statistics", _STATISTICS)):
        found[name] = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{folder}/{name}")
        lines = spark.read.text(f"{folder}/{name}").count()
        if lines != manifest[name]:
            raise ValueError(f"run {run} has {lines} rows of {name}, {manifest[name]} were written")
    return found["results"], found["statistics"]
