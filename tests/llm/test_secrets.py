from __future__ import annotations

from pyspark.sql import functions as F

import hashlib
import random
import re

from helpers import ODD, documents

from gradeframe.llm import queries, secrets

SF = "/root/testdata/sf0.001"
KEY = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
BASE = {
    "assign": (re.compile(f"({KEY})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def base(text):
    """Base spans as they are defined."""
    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, (pattern, good)) in enumerate(BASE.items())
        for m in pattern.finditer(text or "")
        if good(m)
    ]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def spans(spark, texts, **options):
    rows = secrets.secret_spans(documents(spark, texts), **options).collect()
    assert len(rows) == len(texts)

    def text(s):
        return f"{s.kind}:{s.start}:{s.end}"

    return {r.doc_id: ([text(s) for s in r.base], [text(s) for s in r.spans]) for r in rows}


def test_base_spans(spark):
    rng = random.Random(2)
    bits = ["password=", "PassWd : ", "toKen\"='", "api_key=", "APIKEY =", "ſecret=abcdefghijklmn", "toKen=", "AKIA", "AKIA" + "X" * 14]
    bits += ["deadbeef" * 2, "0123456789abcde", "abc123DEF456+/=-_.", "\n", " ", "é中", "\n\n", "secret: short12"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)] + ODD
    got = spans(spark, texts)
    for i, text in enumerate(texts):
        assert got[i][0] == base(text), text
        assert set(got[i][0]) <= set(got[i][1])


OPAQUE = "Zx9" + "kQ7w" * 6
URL = "https://db.example.org/x"


def weak(spark, text, **options):
    return [s.split(":")[0] for s in spans(spark, [text], **options)[0][1]]


def test_weak_parts_need_complementary_ones_nearby(spark):
    assert weak(spark, f"just {OPAQUE} here") == []
    assert weak(spark, f"just {URL} here") == []
    assert weak(spark, f"see {URL} and {OPAQUE}") == ["endpoint", "opaque"]
    assert weak(spark, f"user=anna {OPAQUE}") == ["user", "opaque"]
    assert weak(spark, f"user=anna at {URL}") == []
    assert weak(spark, f"user=anna, password=hunter2") == ["user", "short"]
    assert weak(spark, f"{OPAQUE} and {OPAQUE}") == []
    assert weak(spark, f"AKIA{'Q' * 16} {OPAQUE}") == ["access", "opaque"]
    assert weak(spark, f"{URL} {'-' * 300} {OPAQUE}") == []
    assert weak(spark, f"{URL} {'- ' * 90} {OPAQUE}") == ["endpoint", "opaque"]
    assert weak(spark, f"{URL}\n\n{OPAQUE}") == []
    assert weak(spark, f"{URL}\n{OPAQUE}") == ["endpoint", "opaque"]


def brute_links(parts, within):
    return {
        i
        for i, (kind, sure, scope, start, end) in enumerate(parts)
        if not sure
        and any(
            s == scope
            and (
                (secrets.ROLES[k] == "secret") != (secrets.ROLES[kind] == "secret")
                or secrets.ROLES[kind] == "secret" and other_sure and a < end and b > start
            )
            and a <= end + within
            and b >= start - within
            for k, other_sure, s, a, b in parts
        )
    }


def test_interval_join_against_all_pairs(spark):
    rng = random.Random(9)
    parts = []
    for _ in range(400):
        kind, start = rng.choice(list(secrets.ROLES)), rng.randint(0, 20_000)
        parts.append((kind, kind in secrets.SURE, rng.randint(0, 1), start, start + rng.choice([5, 40, 900])))
    rows = [(row, *p) for row in (1, 2) for p in parts]
    df = spark.createDataFrame(rows, "row bigint, kind string, sure boolean, scope int, start int, end int")
    got = {tuple(r) for r in secrets.linked_parts(df, within=60).collect()}
    linked = [parts[i] for i in brute_links(parts, 60)]
    assert got == {(row, k, s, e) for row in (1, 2) for k, _, _, s, e in linked}


def test_a_long_text_full_of_parts(spark):
    text = f"{URL} {OPAQUE}\n" * 3000
    (found,) = spans(spark, [text]).values()
    assert len(found[1]) == 6000


def test_nulls_repeats_and_masks(spark):
    rows = [(None, "token = abcdefghijklmnop", 1), (1, None, 2), (1, "clean", 3), (1, "clean", 3), (2, f"é {URL} {OPAQUE}.", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind int")
    assert secrets.secret_spans(df).count() == 5
    got = sorted(map(str, (tuple(r) for r in secrets.redacted(df).collect())))
    expected = [(None, "[SECRET]", 1), (1, None, 2), (1, "clean", 3), (1, "clean", 3), (2, "é [SECRET] [SECRET].", 4)]
    assert got == sorted(map(str, expected))
    assert secrets.redacted(df).columns == df.columns
    assert secrets.redacted(df.filter("false")).count() == secrets.secret_spans(df.filter("false")).count() == 0


def test_a_weak_secret_around_a_sure_one_goes_whole(spark):
    token = "Zx9Kq_deadbeef01234567deadbeef_Q7wTail"
    link = "https://db.example.org/x?token=abcdefghijklmnop&user=a"
    texts = [f"a {token} b", f"go {link} with password: hunter2 now", "hex 0123456789abcdef0123 only"]
    df = documents(spark, texts)
    got = {r.doc_id: r.text for r in secrets.redacted(df).collect()}
    assert got[0] == "a [SECRET] b"
    assert "hunter2" not in got[1] and "abcdefghijklmnop" not in got[1] and got[1].startswith("go [SECRET] with ")
    assert got[2] == "hex [SECRET] only"


def test_overlapping_spans_are_one_mask(spark):
    df = documents(spark, ["a token=0123456789abcdef0123 b"])
    assert secrets.redacted(df).first().text == "a [SECRET] b"


def test_registered_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_secrets(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        expected = base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in expected) for k in BASE)
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert set(expected) <= set(r.spans.split(",")) | {""}


def test_redacted_keeps_columns_of_any_name(spark):
    docs = documents(spark, ["password = hunter2hunter2", "nothing", None])
    names = ["parts", "row", "base", "spans", "linked", "__null", "a.b", "_0"]
    odd = docs.withColumns({n: F.lit(7) for n in names})
    found = secrets.redacted(odd)
    assert found.columns == odd.columns
    rows = {r.doc_id: r for r in found.collect()}
    assert all(rows[i][n] == 7 for i in range(3) for n in names)
    assert "hunter2" not in rows[0].text and rows[1].text == "nothing" and rows[2].text is None
