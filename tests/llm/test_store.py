from __future__ import annotations

from gradeframe.llm import store


def is_broadcast(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_small_measures_what_a_value_holds(spark):
    words = ["tenletters"] * 10
    row = (1, "x" * 50, words, {"k": "v" * 40}, {"a": words, "b": None})
    schema = "n bigint, s string, w array<string>, m map<string,string>, t struct<a:array<string>,b:string>"
    tables = {name: spark.createDataFrame([row] * 10, schema).select(name) for name in "nswmt"}
    for name, least in (("n", 16), ("s", 50), ("w", 100), ("m", 41), ("t", 100)):
        assert not is_broadcast(store.small(tables[name], "t", limit=10 * least)), name
        assert is_broadcast(store.small(tables[name], "t", limit=10 * 500)), name
    nulls = spark.createDataFrame([(None,) * 5], schema)
    assert store.small(nulls, "t").collect() == nulls.collect()
    assert is_broadcast(store.small(nulls.filter("false"), "t", limit=0))
