"""Multiset arithmetic on the token arrays of one row.

Every row carries both of its texts, so nothing here needs to move rows: the
arrays are sorted and compared in place. That keeps scoring free of shuffles and
indifferent to how often a text pair, an id or a source is repeated.

Set functions such as ``array_intersect`` run as tight hash loops, lambdas are
interpreted. So elements that occur once are handled by the former and lambdas
only see the further copies. Everything is at worst O(n log n) in the text length.

The expressions are SQL text over column names, since a tree of lambdas built
through the Python API takes thousands of calls into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ngrams_sql


def _let(bindings: dict[str, str], body: str) -> str:
    """``body`` with names for computed arrays, each worked out once.

    Without, a lambda that refers to such an array evaluates it for every element.
    """
    for name, value in reversed(bindings.items()):
        body = f"get(transform(array({value}), {name} -> {body}), 0)"
    return body


def _repeats(ordered: str) -> str:
    """A sorted array without the first copy of each element."""
    return f"filter({ordered}, (x, i) -> i > 0 AND get({ordered}, i - 1) = x)"


def _run_lengths(ordered: str) -> str:
    """ARRAY<INT> with the number of copies of each element of a sorted array."""
    starts = (
        f"filter(sequence(0, size({ordered}) - 1), "
        f"i -> i = 0 OR get({ordered}, i - 1) <> get({ordered}, i))"
    )
    lengths = f"transform(starts, (s, k) -> coalesce(get(starts, k + 1), size({ordered})) - s)"
    # ``sequence`` would count down for an empty array.
    return (
        f"if(size({ordered}) = 0, CAST(array() AS ARRAY<INT>), "
        f"{_let({'starts': starts}, lengths)})"
    )


def _merge_count(a: str, b: str) -> str:
    """Size of the multiset intersection of two sorted arrays, by merging them."""

    def state(i: str, j: str, n: str) -> str:
        return f"named_struct('i', {i}, 'j', {j}, 'n', {n})"

    x, y = f"get({a}, s.i)", f"get({b}, s.j)"
    step = f"""
        CASE WHEN {x} = {y} THEN {state('s.i + 1', 's.j + 1', 's.n + 1')}
             WHEN {x} < {y} THEN {state('s.i + 1', 's.j', 's.n')}
             WHEN {x} > {y} THEN {state('s.i', 's.j + 1', 's.n')}
             ELSE s END  -- one side is used up
    """
    return f"""
        if(arrays_overlap({a}, {b}),
           aggregate(sequence(1, size({a}) + size({b})), {state('0', '0', '0')},
                     (s, k) -> {step}, s -> s.n),
           0)
    """


def _intersection_size(a: str, b: str) -> str:
    # min(m, n) copies in common are one, plus those the repeats have in common.
    further = _let(
        {
            "ao": "sort_array(a)",
            "bo": "sort_array(b)",
            "ar": _repeats("ao"),
            "br": _repeats("bo"),
        },
        _merge_count("ar", "br"),
    )
    return _let(
        {"a": a, "b": b},
        f"""size(array_intersect(a, b))
            + if(size(array_distinct(a)) < size(a) AND size(array_distinct(b)) < size(b),
                 {further}, 0)""",
    )


def intersection_size(a: str, b: str) -> Column:
    """Size of the multiset intersection of two string array columns (INTERSECT ALL)."""
    return F.expr(_intersection_size(a, b))


def ngram_matches(pred: str, ref: str, n: int) -> Column:
    """Clipped n-gram matches of two token columns.

    An n-gram counts at most as often as it occurs in ``ref``.
    """
    size = _intersection_size(ngrams_sql(pred, n), ngrams_sql(ref, n))
    return F.expr(f"if(size({pred}) >= {n} AND size({ref}) >= {n}, {size}, 0)")


def unigram_overlap(pred: str, ref: str) -> Column:
    """STRUCT of BIGINT sums over the counts ``cp`` and ``cr`` of two token columns.

    ``common`` sums min(cp, cr) and ``dot`` cp * cr; ``pred_sq`` and ``ref_sq`` sum
    the squares, ``shared_pred_sq`` and ``shared_ref_sq`` those of the tokens found
    on both sides. Whole numbers, so the result does not depend on any order.
    """

    def counts(side: str, repeats: str) -> str:
        # Holding each token of ``several`` once more than ``side`` does, both sides
        # list the same tokens in the same order, also those with count 0.
        held = f"sort_array(concat({repeats}, array_intersect(several, {side}), several))"
        return _let({"held": held}, _run_lengths("held"))

    pairs = f"""
        zip_with({counts('p', 'pr')}, {counts('r', 'rr')},
                 (x, y) -> named_struct('cp', CAST(x - 1 AS BIGINT), 'cr', CAST(y - 1 AS BIGINT)))
    """

    # With every count taken as one the sums are set sizes; ``several`` holds the
    # tokens for which that is wrong on a side, and ``pairs`` their counts.
    def corrected(start: str, term: str, counted: str = "true") -> str:
        return f"aggregate(pairs, {start}, (acc, x) -> acc + if({counted}, {term}, 0))"

    both = "x.cp > 0 AND x.cr > 0"
    sums = {
        "common": corrected("shared", "least(x.cp, x.cr) - 1", both),
        "dot": corrected("shared", "x.cp * x.cr - 1", both),
        "pred_sq": corrected(
            "CAST(size(p) - size(pr) AS BIGINT)", "x.cp * x.cp - least(x.cp, 1)"
        ),
        "ref_sq": corrected(
            "CAST(size(r) - size(rr) AS BIGINT)", "x.cr * x.cr - least(x.cr, 1)"
        ),
        "shared_pred_sq": corrected("shared", "x.cp * x.cp - 1", both),
        "shared_ref_sq": corrected("shared", "x.cr * x.cr - 1", both),
    }
    fields = ", ".join(f"'{name}', {value}" for name, value in sums.items())
    return F.expr(
        _let(
            {
                "p": f"sort_array({pred})",
                "r": f"sort_array({ref})",
                "pr": _repeats("p"),
                "rr": _repeats("r"),
                "several": "array_union(pr, rr)",
                "pairs": pairs,
                "shared": "CAST(size(array_intersect(p, r)) AS BIGINT)",
            },
            f"named_struct({fields})",
        )
    )


def token_counts(tokens: str) -> Column:
    """ARRAY<STRUCT<token, count>> of a token column, sorted by token."""
    return F.expr(
        _let(
            {"t": f"sort_array({tokens})"},
            f"""zip_with(array_distinct(t), {_run_lengths('t')},
                         (x, n) -> named_struct('token', x, 'count', n))""",
        )
    )
