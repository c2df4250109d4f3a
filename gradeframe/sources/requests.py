"""Files of requests to a judge, written again only for what has no answer yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.judge import ANSWERED, read_replies

_SCHEMA = "id string, request string"


def pending_requests(requests: DataFrame, replies: DataFrame, response: str = "response") -> DataFrame:
    """The requests (id, request) whose id has no answer among the replies (id, response).

    An API error, a reply without content and one that is not JSON are no answers, so they
    are asked again; one good reply is enough whatever else came for the id. Ids may be
    repeated on both sides. The join carries each answered id once.
    """
    answered = read_replies(replies, response).filter(F.col("status") == ANSWERED).select("id").distinct()
    return requests.join(answered, "id", "left_anti")


def write_requests(
    requests: DataFrame, path: str, replies: DataFrame | None = None, rows_per_file: int = 10_000
) -> int:
    """Write requests (id, request) as JSON lines, at most ``rows_per_file`` in a file.

    With the ``replies`` that have come in so far, only those still without an answer are
    written. Each call writes a folder of its own (``path`` must be new), which has a
    ``_SUCCESS`` file when it is whole. Returns how many requests there are; 0 says that all
    are answered.
    """
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be at least 1")
    rows = requests.select("id", "request")
    if replies is not None:
        rows = pending_requests(rows, replies)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("error").option("maxRecordsPerFile", rows_per_file).json(path)
    return seen.get["n"]


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Rows (id, request) that ``write_requests`` wrote."""
    return spark.read.schema(_SCHEMA).option("mode", "FAILFAST").json(path)
