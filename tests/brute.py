"""Metrics straight from their definitions, for small fixtures."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache


def words(text):
    return re.findall("[a-z0-9]+|[一-鿿]", text.lower())


def grams(tokens, n):
    return Counter(zip(*(tokens[k:] for k in range(n))))


def clipped(p, r, n):
    return (grams(p, n) & grams(r, n)).total()


def lcs(a, b):
    @lru_cache(maxsize=None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        if a[i] == b[j]:
            return 1 + best(i + 1, j + 1)
        return max(best(i + 1, j), best(i, j + 1))

    return best(0, 0)


def prf(hits, n_pred, n_ref):
    precision = hits / n_pred if n_pred else 0.0
    recall = hits / n_ref if n_ref else 0.0
    total = precision + recall
    return precision, recall, 2 * precision * recall / total if total else 0.0


def bleu(p, r, weights):
    if not p:
        return 0.0
    logs = 0.0
    for n, weight in enumerate(weights, start=1):
        hits = clipped(p, r, n)
        logs += weight * math.log(hits / (len(p) - n + 1) if hits else 1e-12)
    return (1.0 if len(p) > len(r) else math.exp(1 - len(r) / len(p))) * math.exp(logs)


def cosine(p, r):
    if not p or not r:
        return 0.0
    cp, cr = Counter(p), Counter(r)

    def idf(w):
        return math.log(3 / (1 + (w in cp) + (w in cr))) + 1

    dot = sum(cp[w] * cr[w] * idf(w) ** 2 for w in cp)
    norms = [math.sqrt(sum((c[w] * idf(w)) ** 2 for w in c)) for c in (cp, cr)]
    return max(0.0, min(1.0, dot / (norms[0] * norms[1])))
