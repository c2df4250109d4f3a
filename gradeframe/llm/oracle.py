"""The queries of this package as plain SQL for a second engine, where SQL can express them.

Fingerprints (XXH64), trained networks, page trees, merges of pieces, places of regular matches and exact
binomial bounds are beyond it; those queries are tested against brute force.
"""

from __future__ import annotations

from . import licenses

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _words(text: str) -> str:
    return rf"regexp_extract_all({_lowered(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_DECONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents
),
items AS (
  SELECT item_id, w FROM (SELECT item_id, {_words('text')} AS w FROM benchmark) WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items)
),
places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows))
),
found AS (
  SELECT p.r, p.i, p.size, n.item_id FROM places p JOIN windows n ON n.phrase = p.phrase AND n.size = p.size
),
hits AS (
  SELECT r, count(*) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS at FROM found) GROUP BY r
),
owners AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(o.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(o.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.r = d.r LEFT JOIN owners o ON o.r = d.r"""

# As many as it takes until further ones change no digit that is compared.
_SWEEPS = 40
_MARGINS = ("source", "lang", "topic")


def _mixing() -> str:
    goals = ",\n".join(
        f"goal_{m} AS (SELECT {m}, p / sum(p) OVER () AS goal FROM "
        f"(SELECT {m}, pow(sum(mass), 0.85) AS p FROM cells GROUP BY {m} HAVING sum(mass) > 0))"
        for m in _MARGINS
    )
    start = (
        "w0 AS (SELECT c.*, CAST(mass AS DOUBLE) AS w, "
        + ", ".join(f"coalesce(goal_{m}.goal, 0) AS g_{m}" for m in _MARGINS)
        + " FROM cells c "
        + " ".join(f"LEFT JOIN goal_{m} ON goal_{m}.{m} IS NOT DISTINCT FROM c.{m}" for m in _MARGINS)
        + ")"
    )
    steps = [
        f"w{i + 1} AS (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {m}) > 0 "
        f"THEN w * g_{m} / sum(w) OVER (PARTITION BY {m}) ELSE 0 END AS w) FROM w{i})"
        for i, m in enumerate(_MARGINS * _SWEEPS)
    ]
    digits = " + ".join(
        f"(strpos('0123456789abcdef', substr(h, {i}, 1)) - 1) * {16 ** (8 - i)}" for i in range(1, 9)
    )
    return rf"""
WITH docs AS (
  SELECT doc_id, source, lang,
         CASE WHEN contains(text, 'icensed under') OR contains(text, 'MIT License') THEN 'licensed'
              WHEN contains(text, ' | ') THEN 'table'
              WHEN regexp_matches(text, '[0-9]{{4}}') THEN 'records' ELSE 'prose' END AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), text, '')) AS h
  FROM documents
),
cells AS (SELECT source, lang, topic, sum(n_tokens) AS mass FROM docs GROUP BY source, lang, topic),
{goals},
{start},
{", ".join(steps)},
rates AS (
  SELECT *, w / nullif(mass, 0) AS share, sum(mass) OVER () AS everything,
         max(w / nullif(mass, 0)) OVER () AS top FROM w{len(steps)}
)
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(r.share * r.everything, 6) AS weight,
       round(coalesce(r.share / r.top, 0), 6) AS probability,
       ({digits}) / 4294967296.0 < coalesce(r.share / r.top, 0) AS sampled
FROM docs d JOIN rates r ON r.source IS NOT DISTINCT FROM d.source
  AND r.lang IS NOT DISTINCT FROM d.lang AND r.topic IS NOT DISTINCT FROM d.topic"""


def _licenses() -> str:
    known = ", ".join(f"'{sentence}': '{name}'" for name, sentence in licenses.SENTENCES.items())

    bare = rf"regexp_replace(coalesce(text, ''), '{licenses.LEADERS}', '\1', 'g')"

    def ids(ends: str) -> str:
        plain = (
            f"list_transform(string_split_regex({bare}, '{ends}'), lambda s: trim(regexp_replace("
            rf"{_lowered('s')}, '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+', ' ', 'g')))"
        )
        return f"list_filter(list_transform({plain}, lambda s: MAP {{{known}}}[s]), lambda x: x IS NOT NULL)"

    def matched(sequence: str) -> str:
        hits: dict[str, str] = {}
        for name, rule in licenses.RULES:
            hit = f"contains({sequence}, '>{'>'.join(rule)}>')"
            hits[name] = f"{hits[name]} OR {hit}" if name in hits else hit
        for larger, smaller in licenses.INCLUDES:
            hits[smaller] = f"({hits[smaller]}) AND NOT ({hits[larger]})"
        cases = ", ".join(f"CASE WHEN {hit} THEN '{name}' END" for name, hit in hits.items())
        return f"[{cases}]"

    return f"""
WITH read AS (
  SELECT doc_id, {ids(licenses.ENDS[0])} AS a, {ids(licenses.ENDS[1])} AS b FROM documents
),
joined AS (
  SELECT doc_id, a, b, '>' || array_to_string(a, '>') || '>' AS sa, '>' || array_to_string(b, '>') || '>' AS sb
  FROM read
),
found AS (
  SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS s,
         list_sort(list_distinct(list_filter(list_concat({matched('sa')}, {matched('sb')}), lambda x: x IS NOT NULL)))
           AS l
  FROM joined
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, array_to_string(s, ',') AS sentences,
       array_to_string(l, ',') AS licences FROM found"""


_COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex({_lowered('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i
        FROM pieces, (SELECT unnest(range(1, 6)) AS m))
  GROUP BY ALL HAVING count(*) >= 100
),
cuts AS (
  SELECT lang, phrase, m, f AS a, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM counts WHERE m > 1)
),
scores AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, x.f AS l, y.f AS r, t.n,
         CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
),
best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM counts o WHERE o.lang = b.lang AND o.m > b.m AND o.f >= b.a
      AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000"""


def _merkle() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def row(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    # CRC-32 by bits: the polynomial is a fixed value.
    shift = "CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda y, i: {shift})"
    crc = (
        "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split("
        "CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))), lambda c, b: "
        f"{byte}), 4294967295)"
    )
    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, {row('n_chars')} AS leaf,
         {row(f"(n_chars + CASE WHEN {crc} % 7 = 0 THEN CAST(1 AS HUGEINT) ELSE 0 END)")} AS claimed
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM rows
),
nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
),
tops AS (
  SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
top_nodes AS (
  SELECT 0 AS level, pos, n, h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM top_nodes WHERE n > 1 GROUP BY level, pos // 2, n
),
top_steps AS (
  SELECT t.lang, list(CASE WHEN s.pos < o.pos THEN '<' ELSE '>' END || coalesce(s.h, '') ORDER BY o.level) AS steps
  FROM tops t JOIN top_nodes o ON o.n > 1 AND o.pos = t.pos >> o.level
  LEFT JOIN top_nodes s ON s.level = o.level AND s.pos = xor(o.pos, 1) GROUP BY t.lang
),
ids AS (SELECT *, row_number() OVER () AS id FROM leaves),
steps AS (
  SELECT i.id, list(CASE WHEN s.pos < o.pos THEN '<' ELSE '>' END || coalesce(s.h, '') ORDER BY o.level) AS steps
  FROM ids i JOIN nodes o ON o.n > 1 AND o.lang IS NOT DISTINCT FROM i.lang AND o.pos = i.pos >> o.level
  LEFT JOIN nodes s ON s.level = o.level AND s.lang IS NOT DISTINCT FROM i.lang AND s.pos = xor(o.pos, 1)
  GROUP BY i.id
),
proofs AS (
  SELECT i.doc_id, i.leaf, i.claimed, t.h AS subroot, (SELECT h FROM top_nodes WHERE n = 1) AS root,
         list_concat(coalesce(s.steps, []), coalesce(u.steps, [])) AS path
  FROM ids i JOIN tops t ON t.lang IS NOT DISTINCT FROM i.lang LEFT JOIN steps s ON s.id = i.id
  LEFT JOIN top_steps u ON u.lang IS NOT DISTINCT FROM i.lang
),
folded AS (
  SELECT *, list_reduce(list_prepend(claimed, path), lambda h, step:
           sha256(CASE WHEN step[1] = '<' THEN step[2:] || h ELSE h || step[2:] END)) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded"""


ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": _DECONTAMINATION,
    "op6_mixing": _mixing(),
    "op9_licenses": _licenses(),
    "op11_collocations": _COLLOCATIONS,
    "op13_merkle": _merkle(),
}
