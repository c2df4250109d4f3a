"""Secrets in texts: sure ones by pattern, weak ones by the parts they occur with."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Batches, map_texts, pairs, ship_by_value, stored

# Kinds in the order that settles ties, with the part of a credential each is.
# The first three are sure; the others count only beside a complementary part.
ROLES = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "short": "secret",
    "opaque": "secret",
    "user": "identifier",
    "endpoint": "endpoint",
}
SURE = ("assign", "access", "hex")
_ORDER = {kind: i for i, kind in enumerate(ROLES)}

_FLAGS = re.ASCII
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+", _FLAGS)
_HEX = re.compile(r"[0-9a-f]{16,}", _FLAGS)
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])", _FLAGS)
_USER = re.compile(
    r"""(?i:\b(user|username|login|account|client_?id|access_?key(_?id)?))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""",
    _FLAGS,
)
_ENDPOINT = re.compile(
    r"""(?i:https?)://[A-Za-z0-9][^\s"'<>]*|(?i:\b(host|hostname|endpoint|server))["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+""",
    _FLAGS,
)
_BLANK_LINES = re.compile(r"\n[\x20\t\r]*\n")

PARTS = "parts array<struct<kind:string,sure:boolean,scope:int,start:int,end:int>>"


def _looks_random(token: str) -> bool:
    return bool(re.search("[0-9]", token) and re.search("[a-z]", token) and re.search("[A-Z]", token))


def find_parts(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every sure secret and every weak part, in code points.

    Sure ones are leftmost, non-overlapping matches per kind. A weak secret is a value of
    under 12 characters assigned to a key of the same names (``short``), or a long token of
    mixed letters and digits (``opaque``); one that lies wholly inside a sure one is no part.
    """
    assigned = list(_ASSIGN.finditer(text)) if "=" in text or ":" in text else []
    found = [("assign", *m.span()) for m in assigned if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    weak = [("short", *m.span()) for m in assigned if 6 <= len(m[2]) < 12]
    weak += [("opaque", *m.span()) for m in _OPAQUE.finditer(text) if _looks_random(m[0])]
    if "=" in text or ":" in text:
        weak += [("user", *m.span()) for m in _USER.finditer(text)]
        weak += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    if not weak or not found:
        return found + weak
    taken = sorted((start, end) for _, start, end in found)
    kept, i, reach = [], 0, 0
    for kind, start, end in sorted(weak, key=lambda p: p[1:]):
        while i < len(taken) and taken[i][0] <= start:
            reach = max(reach, taken[i][1])
            i += 1
        if reach < end:
            kept.append((kind, start, end))
    return found + kept


def _scoped(text: str) -> list[dict]:
    parts = sorted(find_parts(text), key=lambda p: (p[1], _ORDER[p[0]]))
    if not parts:
        return []
    breaks = [m.start() for m in _BLANK_LINES.finditer(text)] if any(k not in SURE for k, _, _ in parts) else []
    rows, scope = [], 0
    for kind, start, end in parts:
        while scope < len(breaks) and breaks[scope] < start:
            scope += 1
        rows.append({"kind": kind, "sure": kind in SURE, "scope": scope, "start": start, "end": end})
    return rows


def with_parts(df: DataFrame, keep_text: bool = False) -> DataFrame:
    """Add ``parts``, all that is found in ``text``, by start."""

    def run(texts: list[str]) -> list[pa.Array]:
        kind = pa.list_(
            pa.struct(
                [("kind", pa.string()), ("sure", pa.bool_()), ("scope", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
            )
        )
        return [pa.array([_scoped(t) for t in texts], kind)]

    return map_texts(df, run, PARTS, keep_text)


def linked_parts(parts: DataFrame, row: str = "row", within: int = 200) -> DataFrame:
    """The weak ones of the parts (row, kind, sure, scope, start, end) that count.

    An interval join: a weak part counts if a part of another role lies within ``within``
    characters of it in the same scope (text between blank lines) of the same row. A weak
    identifier or endpoint needs a secret, a weak secret needs either of the others, or to
    overlap a sure secret, which is then a piece of it.
    Intervals meet in bins of ``within`` characters, so that a very long text with very
    many parts is spread over tasks, and a bin holds few.
    """
    role = F.create_map(*[F.lit(v) for kv in ROLES.items() for v in kv])
    roles = parts.withColumn("role", role[F.col("kind")])

    def bins(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / within), F.floor(end / within)))

    weak = roles.filter("NOT sure").withColumn(
        "bin", bins(F.greatest(F.col("start") - within, F.lit(0)), F.col("end") + within)
    )
    other = roles.select(
        F.col(row).alias("o_row"),
        F.col("scope").alias("o_scope"),
        F.col("role").alias("o_role"),
        F.col("sure").alias("o_sure"),
        F.col("start").alias("o_start"),
        F.col("end").alias("o_end"),
        bins(F.col("start"), F.col("end")).alias("o_bin"),
    )
    piece = (
        (weak["role"] == "secret")
        & (other["o_role"] == "secret")
        & other["o_sure"]
        & (other["o_start"] < weak["end"])
        & (other["o_end"] > weak["start"])
    )
    meet = (
        (weak[row] == other["o_row"])
        & (weak["scope"] == other["o_scope"])
        & (weak["bin"] == other["o_bin"])
        & (((weak["role"] == "secret") != (other["o_role"] == "secret")) | piece)
        & (other["o_start"] <= weak["end"] + within)
        & (other["o_end"] >= weak["start"] - within)
    )
    return weak.join(other, meet, "left_semi").select(row, "kind", "start", "end").distinct()


def _ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    rank = F.create_map(*[F.lit(v) for kv in _ORDER.items() for v in kv])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"]))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"]))


def _attach_spans(found: DataFrame, within: int) -> DataFrame:
    """Add ``base`` and ``spans`` to stored rows (row, parts, ...).

    Only rows with weak parts take part in a join.
    """
    fields = ["kind", "start", "end"]
    base = F.transform(F.filter("parts", lambda p: p["sure"]), lambda p: F.struct(*[p[f] for f in fields]))
    unsure = F.exists("parts", lambda p: ~p["sure"])
    listed = found.filter(unsure).select("row", F.inline("parts"))
    linked = linked_parts(listed, within=within).groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("linked"))
    plain = found.filter(~unsure).withColumn("linked", F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    some = found.filter(unsure).join(linked, "row", "left")
    every = plain.unionByName(some).withColumn("base", base)
    spans = F.concat("base", F.coalesce("linked", F.slice("base", 1, 0)))
    return every.withColumn("spans", _ordered(spans)).withColumn("base", _ordered(F.col("base"))).drop("linked", "parts")


def secret_spans(df: DataFrame, key: str = "doc_id", text: str = "text", within: int = 200) -> DataFrame:
    """Rows (key, base, spans), one for each document, repeated rows and NULL keys included.

    ``base`` are the sure secrets, ``spans`` those and the weak candidates that
    complementary parts confirm; both are ARRAY<STRUCT<kind, start, end>> in code points,
    by start, then kind. NULL and empty texts have none. The text is read once and not
    shuffled; a table of parts is written to the shared folder.
    """
    parts = with_parts(pairs(df, key, text)).withColumn("row", F.monotonically_increasing_id())
    found = _attach_spans(stored(parts, "parts"), within)
    return found.select(F.col("key").alias(key), "base", "spans")


def redacted(df: DataFrame, text: str = "text", mask: str = "[SECRET]", within: int = 200) -> DataFrame:
    """The same rows and columns, with every span of ``secret_spans`` in ``text`` masked.

    Overlapping spans become one mask. Rows without spans are as they were; a NULL text
    stays NULL. Columns may have any names.
    """
    columns = df.columns
    # Helper columns and the table's own cannot clash: the latter get numbers for names.
    null = df.toDF(*["text" if c == text else f"_{i}" for i, c in enumerate(columns)])
    null = null.withColumn("__null", F.col("text").isNull())
    found = stored(with_parts(null, keep_text=True).withColumn("row", F.monotonically_increasing_id()), "parts")
    spans = _attach_spans(found, within)
    clean = spans.filter(F.size("spans") == 0)
    schema = spans.schema

    def run(batches: Batches) -> Batches:
        for batch in batches:
            masked = []
            for value, places in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                pieces, at = [], 0
                for place in places:
                    if place["start"] >= at:
                        pieces += [value[at : place["start"]], mask]
                    at = max(at, place["end"])
                masked.append("".join(pieces) + value[at:])
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, batch.schema.field(i), pa.array(masked, batch.schema.field(i).type))

    hidden = spans.filter(F.size("spans") > 0).mapInArrow(run, schema)
    value = F.when(~F.col("__null"), F.col("text")).alias(text)
    rows = clean.unionByName(hidden)
    return rows.select(*[value if c == text else F.col(f"_{i}").alias(c) for i, c in enumerate(columns)])


ship_by_value(__name__)
