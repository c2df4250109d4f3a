"""Text preparation as Column expressions: normalising, tokens, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip`` removes. Spark's plain
# ``trim`` only removes U+0020.
STRIP_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: a token is a run of ASCII letters and digits, or one CJK ideograph.
TOKEN_PATTERN = "[a-z0-9]+|[\u4e00-\u9fff]"

# No token contains a space, so it separates the tokens of a joined n-gram.
GRAM_SEPARATOR = " "

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Remove Unicode whitespace on both ends."""
    return F.btrim(as_column(c), F.lit(STRIP_CHARACTERS))


def normalize_text(c: ColumnOrName) -> Column:
    """Strip, then lower."""
    return F.lower(strip(c))


def tokenize(c: ColumnOrName) -> Column:
    """ARRAY<STRING> of tokens; a NULL text has none."""
    text = F.coalesce(as_column(c), F.lit(""))
    # Group index 0 is the whole match; Spark's default is group 1.
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def ngrams_sql(tokens: str, n: int) -> str:
    """SQL text for the n-grams of the token array ``tokens``."""
    if n <= 0:
        return "CAST(array() AS ARRAY<STRING>)"
    if n == 1:
        return tokens
    parts = f", '{GRAM_SEPARATOR}', ".join(f"get({tokens}, i + {k})" for k in range(n))
    # ``sequence`` would count down for a negative end.
    return (
        f"if(size({tokens}) < {n}, CAST(array() AS ARRAY<STRING>), "
        f"transform(sequence(0, size({tokens}) - {n}), i -> concat({parts})))"
    )


def ngrams(tokens: str, n: int) -> Column:
    """ARRAY<STRING> of the n-grams of a token column, tokens joined by a space.

    Empty if ``n`` is below 1 or above the number of tokens.
    """
    return F.expr(ngrams_sql(tokens, n))
