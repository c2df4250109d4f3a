from __future__ import annotations


def physical(df) -> str:
    """The physical plan as text, one operator per line."""
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)
