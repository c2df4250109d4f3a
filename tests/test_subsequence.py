from __future__ import annotations

import random
import time

import brute
import pytest

from gradeframe.functions.subsequence import subsequence_kernel


@pytest.mark.parametrize("block", [1, 2, 3, 5, 64, 8192])
def test_blocks_do_not_change_the_length(block):
    length = subsequence_kernel(block)
    rng = random.Random(block)
    for _ in range(300):
        a, b = (rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(0, 25)) for _ in "ab")
        assert length(a, b) == brute.lcs(tuple(a), tuple(b))


@pytest.mark.parametrize("block", [1, 3, 8])
def test_edits_of_nearly_equal_texts(block):
    """Texts over one block, with few and with too many edits, periodic ones among them."""
    length = subsequence_kernel(block)
    rng = random.Random(block)
    for _ in range(300):
        a = rng.choices("abcdefgh"[: rng.randint(1, 8)], k=rng.randint(8, 60))
        if rng.random() < 0.3:
            a = a[:3] * 15
        b = list(a)
        for _ in range(rng.choice([0, 1, 2, 5, 40])):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 2)] = rng.choices("abxy", k=rng.randint(0, 2))
        assert length(a, b) == length(b, a) == brute.lcs(tuple(a), tuple(b))


def test_a_million_tokens_with_a_hundred_edits():
    rng = random.Random(5)
    a = [f"w{i}" for i in rng.choices(range(50_000), k=1_000_000)]
    b = list(a)
    for at in rng.sample(range(1_000_000), 100):
        b[at] = "new"
    start = time.perf_counter()
    assert subsequence_kernel()(a, b) == 1_000_000 - 100
    assert time.perf_counter() - start < 5


def test_long_texts():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    a = rng.choices(words, k=20000)
    b = a[:5000] + rng.choices(words, k=2000) + a[9000:]
    short, long = subsequence_kernel(512), subsequence_kernel(10**6)
    assert short(a, b) == long(a, b) >= 16000
