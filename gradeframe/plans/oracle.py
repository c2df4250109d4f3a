"""The same queries as plain SQL for a second engine, for comparison only.

Written from the definitions of the metrics rather than from the Spark operators:
counts come from unnested n-grams and a GROUP BY, subsequence lengths from the
textbook table of partial lengths.
"""

from __future__ import annotations

from ..operators.judge import DEFAULT_MODEL, RULE_REASON, SYSTEM_PROMPT, USER_PROMPT
from ..operators.scoring import METRICS
from .queries import GATE_BAR, WEIGHTS


# Written out again, so that a slip in the operators shows.
STRIP_CHARACTERS = "".join(
    map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
)
TOKEN_PATTERN = "[a-z0-9]+|[一-鿿]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _norm(c: str) -> str:
    return f"lower(trim({c}, {_text(STRIP_CHARACTERS)}))"


def _tokens(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '{TOKEN_PATTERN}')"


def _grams(tokens: str, n: int) -> str:
    return (
        f"list_transform(range(1, greatest(len({tokens}) - {n} + 2, 1)), "
        f"lambda i: array_to_string({tokens}[i:i + {n} - 1], ' '))"
    )


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


_LONG = _text("  HIGH　\n")

_RAW = f"""
turns AS (
  SELECT c.conv_id, c.turn, c.conv_id || '-' || c.turn AS id,
         p.text AS prompt, c.text AS reference, length(c.text) // 2 AS half
  FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
  WHERE c.role = 'assistant'
),
samples AS (
  SELECT id, prompt, reference,
         CASE conv_id % 5
           WHEN 0 THEN reference
           WHEN 1 THEN replace(reference, 'th', 'd')
           WHEN 2 THEN prompt
           WHEN 3 THEN ''
           ELSE substr(reference, half + 1) || left(reference, half)
         END AS model_output,
         'generation' AS task_type,
         CASE WHEN turn % 2 = 1 THEN '{{"turn":' || turn || '}}' ELSE '{{}}' END AS metadata
  FROM turns
  UNION ALL
  SELECT 'doc-' || d.doc_id, d.text,
         CASE WHEN l.quality = 1 THEN 'high' ELSE 'low' END,
         CASE WHEN d.n_chars >= 500 THEN {_LONG} ELSE 'Low' END,
         'classification',
         '{{"lang":"' || d.lang || '","source":"' || d.source || '"}}'
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
)"""

_TOKENS = f"""
toks AS (
  SELECT id, task_type, p, r, len(p) AS np, len(r) AS nr
  FROM (SELECT id, task_type, {_tokens('model_output')} AS p, {_tokens('reference')} AS r
        FROM samples)
)"""

_UNNESTED = " UNION ALL ".join(
    f"SELECT id, {n} AS n, unnest({_grams(side, n)}) AS g, {pred} AS a, {1 - pred} AS b FROM toks"
    for n in (1, 2, 3, 4)
    for side, pred in (("p", 1), ("r", 0))
)

_COUNTS = f"""
grams AS (
  SELECT id, n, g, sum(a) AS cp, sum(b) AS cr FROM ({_UNNESTED}) GROUP BY id, n, g
),
counts AS (
  SELECT id,
         {", ".join(f"sum(least(cp, cr)) FILTER (n = {n}) AS m{n}" for n in (1, 2, 3, 4))},
         sum(CASE WHEN cp > 0 AND cr > 0 THEN 1 ELSE 0 END) FILTER (n = 1) AS shared,
         count(*) FILTER (n = 1) AS words,
         sum(cp * cr) FILTER (n = 1) AS dot,
         sum(cp * cp * CASE WHEN cr > 0 THEN 1 ELSE pow(ln(1.5) + 1, 2) END)
           FILTER (n = 1) AS norm_p,
         sum(cr * cr * CASE WHEN cp > 0 THEN 1 ELSE pow(ln(1.5) + 1, 2) END)
           FILTER (n = 1) AS norm_r
  FROM grams GROUP BY id
),
pairs AS (
  SELECT t.id, t.task_type, t.np, t.nr,
         {", ".join(f"coalesce(c.m{n}, 0) AS m{n}" for n in (1, 2, 3, 4))},
         coalesce(c.shared, 0) AS shared, coalesce(c.words, 0) AS words,
         CASE WHEN t.np = 0 OR t.nr = 0 THEN 0.0
              ELSE greatest(0.0, least(1.0, c.dot / sqrt(c.norm_p * c.norm_r))) END AS cosine,
         {", ".join(
             f"CASE WHEN t.np >= {n} THEN coalesce(c.m{n}, 0) / (t.np - {n} + 1) ELSE 0.0 END AS p{n}"
             for n in (1, 2, 3, 4))}
  FROM toks t LEFT JOIN counts c ON c.id = t.id
)"""


def _bleu(weights: tuple[float, ...]) -> str:
    logs = " + ".join(
        f"{w} * ln(greatest(p{n}, 1e-12))" for n, w in enumerate(weights, start=1)
    )
    brevity = "CASE WHEN np > nr THEN 1.0 ELSE exp(1 - CAST(nr AS DOUBLE) / np) END"
    return f"CASE WHEN np = 0 THEN 0.0 ELSE ({brevity}) * exp({logs}) END"


_LCS = """
lcs AS (
  SELECT id, CASE WHEN np = 0 OR nr = 0 THEN 0 ELSE list_last(
    list_reduce(p, lambda above, t:
      list_reduce(range(1, nr + 1), lambda line, j: list_append(line,
        CASE WHEN r[j] = t THEN coalesce(above[j - 1], 0) + 1
             ELSE greatest(above[j], coalesce(line[j - 1], 0)) END), CAST([] AS BIGINT[])),
      list_transform(r, lambda x: CAST(0 AS BIGINT)))) END AS lcs
  FROM toks WHERE task_type = 'generation'
)"""

_SCORES = f"""
prf AS (
  SELECT *, {_ratio('2.0 * precision * recall', 'precision + recall')} AS f1
  FROM (SELECT *, {_ratio('m1', 'np')} AS precision, {_ratio('m1', 'nr')} AS recall FROM pairs)
),
rouge AS (
  SELECT *, {_ratio('2.0 * precision * recall', 'precision + recall')} AS f1
  FROM (SELECT l.id, l.lcs, {_ratio('l.lcs', 't.np')} AS precision,
               {_ratio('l.lcs', 't.nr')} AS recall
        FROM lcs l JOIN toks t ON t.id = l.id)
),
scored AS (
  SELECT s.id AS sample_id, s.task_type, s.prompt, s.reference, s.model_output,
         CASE WHEN s.task_type = 'classification' THEN
           CAST({_norm('s.model_output')} = {_norm('s.reference')} AS DOUBLE)
         END AS exact_match,
         g.f1 AS rouge_l_f1, g.recall AS rouge_l_recall,
         CASE WHEN s.task_type = 'generation' THEN {_bleu((0.25,) * 4)} END AS bleu,
         f.f1 AS token_f1,
         CASE WHEN s.task_type = 'generation' THEN f.cosine END AS cosine_similarity
  FROM samples s JOIN prf f ON f.id = s.id LEFT JOIN rouge g ON g.id = s.id
),
results AS (
  SELECT *, coalesce(exact_match, rouge_l_f1, 0.0) >= 0.5 AS passed,
         CASE task_type WHEN 'classification' THEN 'exact_match' ELSE 'rouge_l_f1' END
           AS primary_metric
  FROM scored
)"""

_SUMMARY = f"""
summary AS (
  SELECT count(*) AS total, count(*) FILTER (passed) AS passed,
         CAST(count(*) FILTER (passed) AS DOUBLE) / count(*) AS pass_rate,
         {", ".join(f"avg({m}) AS {m}" for m in METRICS)}
  FROM results
)"""

_LABELS = f"""
aligned AS (
  SELECT d.doc_id, CASE WHEN d.n_chars >= 500 THEN {_LONG} ELSE 'Low' END AS pred,
         CASE WHEN l.quality = 1 THEN 'high' ELSE 'low' END AS label
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
)"""

_REFERENCE_LABELS = f"""
aligned AS (
  SELECT d.doc_id, CASE WHEN d.n_chars >= 500 THEN {_LONG} ELSE 'Low' END AS pred,
         CASE WHEN l.quality = 1 THEN 'high' WHEN l.quality = 0 THEN 'low'
              WHEN d.lang = 'en' THEN ' High' ELSE 'low' END AS label
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

_REPLIES = """
contents AS (
  SELECT id, conv_id % 11 AS kind, CASE conv_id % 11
      WHEN 0 THEN json_object('score', 0.75, 'reason', prompt)::VARCHAR
      WHEN 1 THEN json_object('score', '0.5', 'reason', prompt)::VARCHAR
      WHEN 2 THEN json_object('score', 3, 'reason', prompt)::VARCHAR
      WHEN 3 THEN json_object('score', -1, 'reason', prompt)::VARCHAR
      WHEN 4 THEN json_object('reason', prompt)::VARCHAR
      WHEN 5 THEN '{"score": null, "reason": "none"}'
      WHEN 6 THEN 'I would say: ' || prompt
      WHEN 7 THEN '```json' || chr(10) || json_object('score', 1, 'reason', prompt)::VARCHAR
           || chr(10) || '```'
    END AS content
  FROM turns
),
parsed AS (
  SELECT id, kind, content, CASE WHEN json_valid(content) THEN content::JSON END AS j FROM contents
),
verdicts AS (
  SELECT id,
         CASE WHEN kind = 10 THEN 'not json' WHEN kind >= 8 THEN 'no content' ELSE 'answered' END AS status,
         CASE WHEN kind >= 8 THEN NULL WHEN usable THEN
           greatest(0.0, least(1.0, coalesce(CAST(j->>'$.score' AS DOUBLE), 0.0)))
         ELSE 0.0 END AS score,
         CASE WHEN usable THEN coalesce(j->>'$.reason', '') ELSE content END AS reason
  FROM (SELECT *, j IS NOT NULL AND coalesce(json_type(j, '$.score'), 'MISSING') <> 'NULL'
                  AS usable FROM parsed)
)"""


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_EVALUATED = (_RAW, _TOKENS, _COUNTS, _LCS, _SCORES)
_COUNTED = (_RAW, _TOKENS, _COUNTS)
_ROW = f"sample_id, task_type, passed, {_round(*METRICS)}, primary_metric"
_SAMPLE = "id, task_type, prompt, reference, model_output"
_MEANS = " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS avg_score FROM summary" for m in METRICS)
_SORTED = sorted(METRICS)


def _fixed(c: str, digits: int) -> str:
    return f"printf('%.{digits}f', {c})"


def _cards() -> str:
    rows = [
        "SELECT 0 AS position, '样本总数' AS label, CAST(total AS VARCHAR) AS value, "
        "CAST(NULL AS VARCHAR) AS percent FROM summary",
        "SELECT 1, '通过数', CAST(passed AS VARCHAR), NULL FROM summary",
        f"SELECT 2, '通过率', {_fixed('pass_rate', 4)}, {_fixed('pass_rate * 100', 2)} || '%' "
        "FROM summary",
        *[
            f"SELECT {i}, '{m}', {_fixed(m, 4)}, NULL FROM summary"
            for i, m in enumerate(_SORTED, start=3)
        ],
    ]
    columns = "CAST(position AS BIGINT) AS position, label, value, percent"
    return f"SELECT {columns} FROM ({' UNION ALL '.join(rows)})"


def _precision_recall_f1(source: str) -> str:
    return f"SELECT id, {_round('precision', 'recall', 'f1')} FROM {source}"


_SCORE_TEXT = " || ', ' || ".join(f"'{m}=' || {_fixed(m, 4)}" for m in METRICS)
_CLS_TEXT = (
    f"'exact_match=' || {_fixed('exact_match', 4)} || ', token_f1=' || {_fixed('token_f1', 4)}"
)
_GEN_TEXT = " || ', ' || ".join(
    f"'{m}=' || {_fixed(m, 4)}" for m in METRICS if m != "exact_match"
)
_SAMPLES_SQL = _with(f"SELECT {_SAMPLE}, metadata FROM samples", _RAW)
_EVALUATE_SQL = _with(f"SELECT {_ROW} FROM results", *_EVALUATED)
_ALIGNED_SQL = _with("SELECT doc_id, pred, label FROM aligned", _LABELS)
_HIT = f"{_norm('pred')} = {_norm('label')}"
_MEAN = "0.5 * f1 + 0.5 * cosine"
_REQUEST = (
    f"json_object('model', {_text(DEFAULT_MODEL)}, 'messages', json_array("
    f"json_object('role', 'system', 'content', {_text(SYSTEM_PROMPT)}), "
    "json_object('role', 'user', 'content', "
    f"printf({_text(USER_PROMPT)}, prompt, reference, model_output))), "
    "'temperature', 0)::VARCHAR"
)

_OFF = {
    "bleu": "CASE WHEN sample_id LIKE '%-3' THEN bleu + 2 ELSE bleu END",
    "token_f1": "CASE WHEN sample_id LIKE 'doc-%7' THEN token_f1 - 2 ELSE token_f1 END",
}

ORACLE_SQL: dict[str, str] = {
    "load_samples": _SAMPLES_SQL,
    "stored_samples": _SAMPLES_SQL,
    "document_samples": _SAMPLES_SQL,
    "wrapped_samples": _with(
        f"SELECT {_SAMPLE} FROM samples UNION ALL SELECT id || '-swapped', 'classification', prompt, "
        "model_output, reference FROM samples",
        _RAW,
    ),
    "task_type_counts": _with(
        "SELECT task_type, count(*) AS n FROM samples GROUP BY task_type", _RAW
    ),
    "normalize_tokenize": f"""
        SELECT doc_id, normalized, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, {_norm('text')} AS normalized, {_tokens('text')} AS t
              FROM documents)""",
    "ngram_lists": f"""
        SELECT conv_id, turn, '' AS grams_0, array_to_string({_grams('t', 1)}, '|') AS grams_1,
               array_to_string({_grams('t', 2)}, '|') AS grams_2,
               array_to_string({_grams('t', 3)}, '|') AS grams_3,
               array_to_string({_grams('t', 4)}, '|') AS grams_4
        FROM (SELECT conv_id, turn, {_tokens('text')} AS t FROM conversations)""",
    "exact_match": _with(
        f"SELECT id, {_norm('model_output')} = {_norm('reference')} AS exact_match, "
        "model_output = reference AS exact_match_raw FROM samples",
        _RAW,
    ),
    "accuracy": _with(
        f"SELECT round(avg(CASE WHEN {_HIT} THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM aligned",
        _REFERENCE_LABELS,
    ),
    "label_scores": _with(
        f"""SELECT {_round('precision', 'recall')},
               round(2 * precision * recall / (precision + recall), 6) AS f1
        FROM (SELECT tp / (tp + fp) AS precision, tp / (tp + fn) AS recall
              FROM (SELECT CAST(count(*) FILTER ({_HIT}) AS DOUBLE) AS tp,
                           count(*) FILTER (NOT ({_HIT})) AS fp,
                           count(*) FILTER (NOT ({_HIT})) AS fn FROM aligned))""",
        _LABELS,
    ),
    "align_strict": _with("SELECT doc_id, pred, label FROM aligned", _REFERENCE_LABELS),
    "align_matched": _ALIGNED_SQL,
    "token_f1": _with(_precision_recall_f1("prf"), *_EVALUATED),
    "token_overlap": _with(
        "SELECT id, CAST(m1 AS BIGINT) AS common_tokens, CAST(shared AS BIGINT) AS shared_words, "
        "CAST(words AS BIGINT) AS all_words FROM pairs",
        *_COUNTED,
    ),
    "modified_precision": _with(
        "SELECT id, "
        + ", ".join(f"round(p{n}, 6) AS precision_{n}" for n in (1, 2, 3, 4))
        + " FROM pairs",
        *_COUNTED,
    ),
    "bleu": _with(f"SELECT id, round({_bleu((0.25,) * 4)}, 6) AS bleu FROM pairs", *_COUNTED),
    "bleu_weighted": _with(
        f"SELECT id, round({_bleu(WEIGHTS)}, 6) AS bleu FROM pairs", *_COUNTED
    ),
    "cosine": _with("SELECT id, round(cosine, 6) AS cosine_similarity FROM pairs", *_COUNTED),
    "term_frequency": f"""
        SELECT doc_id, term, count(*) AS n, round(count(*) / CAST(any_value(k) AS DOUBLE), 6) AS tf
        FROM (SELECT doc_id, len(t) AS k, unnest(t) AS term
              FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents))
        GROUP BY doc_id, term""",
    "corpus_idf": f"""
        SELECT term, count(*) AS document_frequency,
               round(ln((1.0 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1, 6) AS idf
        FROM (SELECT DISTINCT doc_id, unnest({_tokens('text')}) AS term FROM documents)
        GROUP BY term""",
    "evaluate": _EVALUATE_SQL,
    "evaluate_stream": _EVALUATE_SQL,
    "summary": _with(
        f"SELECT total, passed, {_round('pass_rate')} FROM summary", *_EVALUATED, _SUMMARY
    ),
    "summary_stream": _with(
        f"SELECT total, passed, {_round('pass_rate')} FROM summary", *_EVALUATED, _SUMMARY
    ),
    "avg_scores": _with(
        f"SELECT metric, {_round('avg_score')} FROM ({_MEANS})", *_EVALUATED, _SUMMARY
    ),
    "metric_names": _with(
        f"SELECT metric FROM ({_MEANS}) WHERE avg_score IS NOT NULL", *_EVALUATED, _SUMMARY
    ),
    "passed_rows": _with(f"SELECT {_ROW} FROM results WHERE passed", *_EVALUATED),
    "failed_rows": _with(f"SELECT {_ROW} FROM results WHERE NOT passed", *_EVALUATED),
    "gate": _with(
        f"SELECT total, passed, pass_rate >= {GATE_BAR} AS gate_ok FROM summary",
        *_EVALUATED,
        _SUMMARY,
    ),
    "score_range_violations": _with(
        "SELECT sample_id, metric, round(score, 6) AS score FROM ("
        + " UNION ALL ".join(
            f"SELECT sample_id, '{m}' AS metric, {_OFF.get(m, m)} AS score FROM results"
            for m in METRICS
        )
        + ") WHERE score < 0 OR score > 1",
        *_EVALUATED,
    ),
    "rule_judge": _with(
        f"""SELECT id, score, printf({_text(RULE_REASON)}, {_fixed('f1', 3)},
                      {_fixed('cosine', 3)}, {_fixed('score', 3)}) AS reason,
               {_round('f1', 'cosine')}
        FROM (SELECT id, f1, cosine, CAST({_fixed(_MEAN, 4)} AS DOUBLE) AS score FROM prf)""",
        *_EVALUATED,
    ),
    "apply_judge": _with(
        """SELECT id, round(least(a, b) / CAST(greatest(a, b, 1) AS DOUBLE), 6) AS score,
               a || ' of ' || b AS reason, c AS raw
        FROM (SELECT id, length(model_output) AS a, length(reference) AS b, length(prompt) AS c
              FROM samples)""",
        _RAW,
    ),
    "apply_batch_judge": _with(
        """SELECT id, round(least(a, b) / CAST(greatest(a, b, 1) AS DOUBLE), 6) AS score,
               a || ' of ' || b AS reason, c AS raw
        FROM (SELECT id, length(model_output) AS a, length(reference) AS b, length(prompt) AS c
              FROM samples)""",
        _RAW,
    ),
    "judge_requests": _with(f"SELECT id, {_REQUEST} AS request FROM samples", _RAW),
    "pending_requests": _with(
        f"SELECT id, {_REQUEST} AS request FROM samples "
        "WHERE id NOT IN (SELECT id FROM verdicts WHERE status = 'answered')",
        _RAW,
        _REPLIES,
    ),
    "judge_replies": _with(
        "SELECT id, round(score, 6) AS score, reason, status FROM verdicts", _RAW, _REPLIES
    ),
    "attach_verdicts": _with(
        "SELECT s.id, s.task_type, round(v.score, 6) AS score, v.reason "
        "FROM samples s LEFT JOIN verdicts v ON v.id = s.id",
        _RAW,
        _REPLIES,
    ),
    "report_results": _with(
        "SELECT sample_id, task_type, passed, "
        + ", ".join(f"CAST({_fixed(m, 6)} AS DOUBLE) AS {m}" for m in METRICS)
        + ", reference, model_output FROM results",
        *_EVALUATED,
    ),
    "report_statistics": _with(
        f"SELECT total, passed, {_round('pass_rate', *METRICS)} FROM summary",
        *_EVALUATED,
        _SUMMARY,
    ),
    "report_rows": _with(
        f"""SELECT sample_id, task_type, CASE WHEN passed THEN '通过' ELSE '未通过' END AS status,
               CASE task_type WHEN 'classification' THEN {_CLS_TEXT} ELSE {_GEN_TEXT} END
                 AS score_text, reference, model_output
        FROM results""",
        *_EVALUATED,
    ),
    "report_cards": _with(_cards(), *_EVALUATED, _SUMMARY),
    "first_n": _with(f"SELECT {_SAMPLE} FROM samples ORDER BY id LIMIT 4", _RAW),
    "first_n_repeated": _with(
        f"SELECT {_SAMPLE} FROM (SELECT * REPLACE (split_part(id, '-', 1) AS id) FROM samples) "
        "ORDER BY id, prompt, reference, model_output, task_type LIMIT 12",
        _RAW,
    ),
    "find_sample": _with(f"SELECT {_SAMPLE} FROM samples WHERE id = '0-1'", _RAW),
}
ORACLE_SQL["stored_report"] = ORACLE_SQL["report_results"]
# Subsequence lengths of every pair, also the labels', unlike in the evaluation.
ORACLE_SQL["rouge_l"] = _with(
    "SELECT id, CAST(lcs AS BIGINT) AS lcs, " + _round("precision", "recall", "f1") + " FROM rouge",
    _RAW,
    _TOKENS,
    _COUNTS,
    _LCS.replace("FROM toks WHERE task_type = 'generation'", "FROM toks"),
    _SCORES,
)
