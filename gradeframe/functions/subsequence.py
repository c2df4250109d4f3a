"""Longest common subsequence, the one operator Spark's built-ins cannot carry.

A fold over the rows of the table of partial lengths is expressible with
``aggregate`` but measured two orders of magnitude slower, so this is an Arrow
function. It is the bit-parallel form (Crochemore et al. 2001; Hyyro 2004), which
keeps a row of that table as the bits of an integer: O(m * n / 64) time. Long texts
are cut into blocks of bits that hand their carries on, which bounds the memory. Long
texts that differ in few places are done by their edits instead: O((m + n) * edits).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import GRAM_SEPARATOR, ColumnOrName, as_column


# Tokens per block; a block's bit masks take at most 8192 ** 2 / 16 bytes, 4 MiB.
BLOCK = 8192


# What one step along a diagonal costs, in steps of the bit-parallel form over one block.
_DIAGONAL_STEP = 8


def subsequence_kernel(block: int = BLOCK) -> Callable[[list[str], list[str]], int]:
    # Nested functions travel to the executors by value, so that the package need
    # not be installed there.
    def by_edits(a: list[str], b: list[str], budget: int) -> int | None:
        """The length by the number of edits (Myers 1986), None beyond the budget.

        After ``edits`` insertions and deletions, ``reach`` holds for every diagonal how far
        in ``a`` one can get; equal stretches are compared in growing slices.
        """
        import numpy as np

        numbers: dict[str, int] = {}
        left, right = (
            np.array([numbers.setdefault(t, len(numbers)) for t in side], np.int32) for side in (a, b)
        )
        n, m = len(a), len(b)
        reach = {1: 0}
        spent = 0
        for edits in range(n + m + 1):
            spent += _DIAGONAL_STEP * (edits + 1)
            if spent > budget:
                return None
            for k in range(-edits, edits + 1, 2):
                down = k == -edits or k != edits and reach[k - 1] < reach[k + 1]
                x = reach[k + 1] if down else reach[k - 1] + 1
                y = x - k
                size = 16
                while x < n and y < m and a[x] == b[y]:
                    size = min(2 * size, n - x, m - y)
                    differs = left[x : x + size] != right[y : y + size]
                    first = int(differs.argmax())
                    equal = first if differs[first] else size
                    spent += equal // 256
                    x += equal
                    y += equal
                    if equal < size:
                        break
                if x >= n and y >= m:
                    return (n + m - edits) // 2
                # Beyond either end a diagonal leads nowhere; it stays as it is.
                reach[k] = x
        return None

    def by_bits(a: list[str], b: list[str]) -> int:
        found = 0
        carries = bytearray(len(b))
        for start in range(0, len(a), block):
            part = a[start : start + block]
            masks: dict[str, int] = {}
            for i, token in enumerate(part):
                masks[token] = masks.get(token, 0) | (1 << i)
            full = (1 << len(part)) - 1
            free = full
            handed_on = bytearray(len(b))
            for j, token in enumerate(b):
                mask = masks.get(token, 0)
                carry = carries[j]
                if mask or carry:
                    hit = free & mask
                    total = free + hit + carry
                    if total > full:
                        handed_on[j] = 1
                    free = (total | (free - hit)) & full
            found += len(part) - free.bit_count()
            carries = handed_on
        return found

    def length(a: list[str], b: list[str]) -> int:
        if len(a) < len(b):
            a, b = b, a
        # Common ends belong to a longest common subsequence.
        head, tail = 0, len(b)
        while head < tail and a[head] == b[head]:
            head += 1
        shift = len(a) - len(b)
        while tail > head and a[tail - 1 + shift] == b[tail - 1]:
            tail -= 1
        same = head + len(b) - tail
        a, b = a[head : tail + shift], b[head:tail]
        if not b:
            return same
        # Texts of several blocks may differ little, which is tried for a part of the time
        # that the bits would take.
        if len(a) > block:
            found = by_edits(a, b, len(b) * -(-len(a) // block) // 2)
            if found is not None:
                return same + found
        return same + by_bits(a, b)

    return length


def _lcs_function() -> Callable[[Column, Column], Column]:
    length = subsequence_kernel()

    def lengths(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if x is None or y is None else length(x.split(), y.split())
                for x, y in zip(a, b)
            ],
            dtype="Int32",
        )

    return F.pandas_udf(lengths, "int")


def lcs_length(
    pred: ColumnOrName,
    ref: ColumnOrName,
    where: Column | None = None,
    common: Column | None = None,
) -> Column:
    """INT length of the longest common subsequence of two token arrays.

    NULL where ``where`` does not hold. Rows whose answer follows from the arrays
    alone send no text to Python: equal arrays, an empty one, or, with the number
    of ``common`` tokens known, arrays that share none.
    """
    p, r = as_column(pred), as_column(ref)
    wanted = F.lit(True) if where is None else where
    undecided = wanted & (p != r) & (F.size(p) > 0) & (F.size(r) > 0)
    if common is not None:
        undecided = undecided & (common > 0)

    def joined(tokens: Column) -> Column:
        # One string per side crosses to Python instead of a list of strings.
        return F.when(undecided, F.array_join(tokens, GRAM_SEPARATOR))

    return F.when(
        wanted,
        F.coalesce(
            _lcs_function()(joined(p), joined(r)),
            F.when(p == r, F.size(p)).otherwise(F.lit(0)),
        ),
    )
