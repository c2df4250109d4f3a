from __future__ import annotations

import json
import math

import pytest
from plans import physical
from pyspark.sql import functions as F

from gradeframe.operators import judge as J


def test_rule_judge(spark, samples):
    rows = {r.id: r for r in J.rule_judge(samples).withColumn("raw", F.to_json("raw")).collect()}
    assert rows["n01"].score == rows["n08"].score == rows["n11"].score == 1.0
    assert 0.0 < rows["n02"].score < 1.0
    assert rows["n05"].score == rows["n07"].score == rows["n10"].score == 0.0
    # One word of five: token F1 is 2 * 1 / (1 + 5).
    cosine = 1 / math.sqrt(1 + 4 * (math.log(1.5) + 1) ** 2)
    assert rows["n09"].score == round(0.5 / 3 + 0.5 * cosine, 4) == 0.3343
    assert rows["n09"].reason == "离线规则裁判：token F1=0.333，余弦相似度=0.335，加权得分=0.334"
    assert json.loads(rows["n09"].raw) == pytest.approx({"f1": 1 / 3, "cosine": cosine})


def test_row_judge(spark, samples):
    def judge(prompt, reference, answer):
        return float(reference == answer), prompt, json.dumps({"n": len(answer)})

    judged = J.apply_judge(samples, J.row_judge(judge))
    rows = {r.id: r for r in judged.withColumn("raw", F.to_json("raw")).collect()}
    assert rows["n11"].score == 1.0 and rows["n01"].score == 0.0
    assert rows["n05"].reason == "Which metal?"
    assert rows["n10"].raw == '{"n":2}'
    assert physical(judged.filter("score > 0.5").select("id", "score")).count("ArrowEvalPython") == 1
    with pytest.raises(ValueError, match="score, reason, raw"):
        J.apply_judge(samples, lambda df: df)


def test_requests(samples):
    row = J.judge_requests(samples, model="m").filter("id = 'n05'").first()
    request = json.loads(row.request)
    assert list(request) == ["model", "messages", "temperature"]
    assert request["model"] == "m" and request["temperature"] == 0
    assert [m["role"] for m in request["messages"]] == ["system", "user"]
    assert request["messages"][0]["content"] == J.SYSTEM_PROMPT
    assert request["messages"][1]["content"] == (
        "【题目】\nWhich metal?\n\n【参考答案】\ncopper\n\n【模型输出】\ntin and zinc\n"
    )


REPLIES = [
    ('{"score": 0.8, "reason": "ok"}', 0.8, "ok"),
    ('{"score": "0.7"}', 0.7, ""),
    ('{"score": " 7e-1 ", "reason": "好"}', 0.7, "好"),
    ('{"score": "1d"}', 0.0, None),
    ('{"score": "high", "reason": "x"}', 0.0, None),
    ('{"score": "nan"}', 1.0, ""),
    ('{"score": 3}', 1.0, ""),
    ('{"score": -1}', 0.0, ""),
    ('{"score": 1}', 1.0, ""),
    ('{"reason": "x"}', 0.0, "x"),
    ("{}", 0.0, ""),
    ('{"score": null, "reason": "x"}', 0.0, None),
    ('{"score": [1]}', 0.0, None),
    ('{"score": true}', 1.0, ""),
    ('{"score": 0.5, "reason": null}', 0.5, "None"),
    ('{"score": 0.5, "reason": 3}', 0.5, "3"),
    ('{"score": 0.5, "reason": true}', 0.5, "True"),
    ("not json", 0.0, None),
    ('```json\n{"score": 1}\n```', 0.0, None),
    ("[1,2]", 0.0, None),
    ("0.9", 0.0, None),
    ('"0.9"', 0.0, None),
    ("", 0.0, None),
]


def response(content):
    return json.dumps({"choices": [{"message": {"content": content}}], "id": "r"})


def test_replies(spark):
    table = [(str(i), response(c)) for i, (c, _, _) in enumerate(REPLIES)]
    df = spark.createDataFrame(table, "id string, response string")
    got = {r.id: r for r in J.read_replies(df).withColumn("raw", F.to_json("raw")).collect()}
    for i, (content, score, reason) in enumerate(REPLIES):
        row = got[str(i)]
        expected = content if reason is None else reason
        assert (row.score, row.reason) == (score, expected), content
        assert json.loads(row.raw) == json.loads(response(content))


def test_replies_without_a_verdict(spark):
    table = [
        ("error", '{"error": {"code": "rate_limit"}}', J.NO_CONTENT),
        ("none", '{"choices": []}', J.NO_CONTENT),
        ("html", "<html>502</html>", J.NOT_JSON),
        ("null", None, J.NOT_JSON),
        ("list", "[1]", J.NO_CONTENT),
        ("null content", '{"choices": [{"message": {"content": null}}]}', J.ANSWERED),
        ("good", response('{"score": 1, "reason": "r"}'), J.ANSWERED),
    ]
    df = spark.createDataFrame([r[:2] for r in table], "id string, response string")
    rows = {r.id: r for r in J.read_replies(df).collect()}
    assert {k: r.status for k, r in rows.items()} == {k: status for k, _, status in table}
    for r in rows.values():
        assert (r.score is None and r.reason is None) == (r.status != J.ANSWERED)
    assert (rows["null content"].score, rows["null content"].reason) == (0.0, "")
    good = J.read_replies(df.filter("id = 'good'"), mode="fail")
    assert good.first().score == 1.0
    for name in ("error", "html"):
        with pytest.raises(Exception, match="a judge reply is"):
            J.read_replies(df.filter(F.col("id") == name), mode="fail").collect()


def test_attach_verdicts_keeps_every_sample(spark, samples):
    df = samples.unionByName(samples.filter("id = 'n03'"))
    table = [("n03", response('{"score": 0.9, "reason": "r"}')), ("zz", response("{}"))]
    verdicts = J.read_replies(spark.createDataFrame(table, "id string, response string"))
    rows = J.attach_verdicts(df, verdicts).collect()
    assert len(rows) == 12
    assert [r.score for r in rows if r.id == "n03"] == [0.9, 0.9]
    assert all(r.score is None for r in rows if r.id != "n03")


def test_batch_judge_starts_once_per_worker(spark, samples, tmp_path):
    """Many tasks of two queries: each worker starts the judge once, calls are bounded."""
    log = tmp_path / "starts"
    log.mkdir()

    def start():
        import os
        import uuid

        (log / f"{os.getpid()}-{uuid.uuid4().hex}").write_text("")

        def judged(texts):
            assert 1 <= len(texts) <= 3
            return [(float(len(p)), f"{r}|{a}", None) for p, r, a in texts]

        return judged

    many = samples.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).repartition(24)
    judge = J.batch_judge(start, rows=3)
    for _ in range(2):
        rows = J.apply_judge(many, judge).collect()
        assert len(rows) == 220
        assert all(r.score == len(r.prompt) and r.reason == f"{r.reference}|{r.model_output}" for r in rows)
    workers = [f.name.split("-")[0] for f in log.iterdir()]
    assert len(workers) == len(set(workers)) and len(workers) < 24
    # Another judge has a start of its own.
    assert J.apply_judge(samples, J.batch_judge(start, rows=1)).count() == 11
    assert J.apply_judge(samples.limit(0), judge).isEmpty()


def test_batch_judge_checks_what_it_gets(spark, samples):
    with pytest.raises(Exception, match="verdicts for"):
        J.apply_judge(samples, J.batch_judge(lambda: lambda texts: [(1.0, "", None)], rows=5)).collect()
    with pytest.raises(ValueError):
        J.batch_judge(lambda: list, rows=0)
