"""The same results as DuckDB SQL over the same tables."""

from __future__ import annotations

from turnmill.functions.chat import CHATML, LLAMA3, ChatTemplate
from turnmill.functions.pii import NAME_PATTERNS, REDACT_RULES, SCRUB_PATTERNS
from turnmill.operators.perf import PRICES
from turnmill.operators.scoring import DOMAIN_RULES

NL = "chr(10)"
# Every character Python's str.strip() removes that the tables can hold.
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def lit(s: str) -> str:
    """A SQL string literal; newlines as chr(10)."""
    parts = ["'" + p.replace("'", "''") + "'" for p in s.split("\n")]
    return "(" + f" || {NL} || ".join(parts) + ")"


def strip(e: str) -> str:
    return f"trim({e}, {WS})"


def nested(e: str, rules: list[tuple[str, str]]) -> str:
    for tag, pattern in rules:
        e = f"regexp_replace({e}, {lit(pattern)}, '{tag}', 'g')"
    return e


def scrub(e: str) -> str:
    rules = [(f"[{k}_REDACTED]", p) for k, p in SCRUB_PATTERNS]
    return nested(e, rules + [("[NAME_REDACTED]", p) for p in NAME_PATTERNS])


def redact(e: str) -> str:
    return nested(e, [(f"[{k}]", p) for k, p in REDACT_RULES])


def half(e: str, second: bool = False) -> str:
    cut = f"ceil(length({e}) / 2.0)::BIGINT"
    return f"substr({e}, {cut} + 1)" if second else f"left({e}, {cut})"


def rnd(e: str, digits: int) -> str:
    """Round the binary value, ties to even: ``x * 10^d`` and its exact rounding error."""
    k = float(10**digits)
    split = "134217729::DOUBLE"
    k_hi = k * 134217729.0 - (k * 134217729.0 - k)
    product = f"(x * {k}::DOUBLE)"
    x_hi = f"(x * {split} - (x * {split} - x))"
    x_lo = f"(x - {x_hi})"
    err = (
        f"((({x_hi} * {k_hi}::DOUBLE - {product}) + {x_hi} * {k - k_hi}::DOUBLE "
        f"+ {x_lo} * {k_hi}::DOUBLE) + {x_lo} * {k - k_hi}::DOUBLE)"
    )
    over = f"({product} - floor({product}) - 0.5::DOUBLE)"
    up = f"({over} > 0 OR ({over} = 0 AND ({err} > 0 OR ({err} = 0 AND floor({product}) % 2 = 1))))"
    body = f"(floor({product}) + {up}::INT) / {k}::DOUBLE"
    return f"list_transform([({e})::DOUBLE], lambda x: {body})[1]"


A, B = half("text"), half("text", True)

# --- conversations ------------------------------------------------------------------

JOINED = f"string_agg(text, ' ' || {NL} || ' ' ORDER BY turn)"
REVIEW = f"string_agg('[' || upper(role) || ']' || {NL} || text, {NL} || {NL} ORDER BY turn)"


def rendered(t: ChatTemplate, where: str = "") -> str:
    before, _, after = t.turn_open.partition("{role}")
    content = strip("text") if t.strip_content else "text"
    turn = f"{lit(before)} || role || {lit(after)} || {content} || {lit(t.turn_close)}"
    return f"{lit(t.begin)} || coalesce(string_agg({turn}, '' ORDER BY turn) {where}, '')"


PROMPT_TAIL = CHATML.turn_open.replace("{role}", "assistant")

FIRST_TURNS = """
  SELECT conv_id, min_by(text, turn) FILTER (role = 'user') AS prompt,
         min_by(text, turn) FILTER (role = 'assistant') AS reference
  FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') > 0
"""

# --- normalised records -------------------------------------------------------------

NORMALIZED = f"""
  SELECT doc_id,
    CASE doc_id % 8 WHEN 0 THEN 'chat' WHEN 1 THEN 'prompt' WHEN 2 THEN 'instruction'
      WHEN 3 THEN 'qa' WHEN 4 THEN 'qa' WHEN 5 THEN 'text' WHEN 7 THEN 'prompt' END AS shape,
    CASE doc_id % 8 WHEN 6 THEN NULL WHEN 5 THEN text
      WHEN 2 THEN lang || CASE WHEN {A} <> '' THEN {NL} || {NL} || {A} ELSE '' END
      ELSE {A} END AS user_text,
    CASE doc_id % 8 WHEN 6 THEN NULL WHEN 5 THEN NULL WHEN 3 THEN n_chars::VARCHAR
      WHEN 7 THEN CASE WHEN n_chars > 1000 THEN 'True' ELSE 'False' END
      ELSE {B} END AS assistant_text,
    CASE doc_id % 8 WHEN 0 THEN doc_id::VARCHAR WHEN 7 THEN doc_id::VARCHAR
      WHEN 1 THEN 'd' || doc_id WHEN 3 THEN source ELSE doc_id::VARCHAR END AS id
  FROM documents
"""

ROUTE = """CASE WHEN n_chars IS NULL THEN 'schema' WHEN n_chars < 40 THEN 'short'
  WHEN n_chars > 32768 THEN 'long' ELSE 'kept' END"""


def sort_key(seed: int, e: str) -> str:
    return f"('0x' || left(md5('{seed}|' || {e}), 15))::BIGINT"


def coin(seed: int, e: str) -> str:
    return f"('0x' || left(md5('{seed}|' || {e}), 8))::BIGINT / 4294967296.0"


# --- greedy clustering --------------------------------------------------------------


def greedy(edges: str) -> str:
    """CTEs from ``edges(i, j, sim)``, i before j, to ``nearest(id, rep, sim)`` of duplicates.

    Walks the rows that have neighbours in order, carrying the list of kept ones.
    """
    return f"""
  edges AS MATERIALIZED ({edges}),
  nodes AS (SELECT id, row_number() OVER (ORDER BY id) AS n, prev FROM (
    SELECT u.id, list(e.i) FILTER (e.i IS NOT NULL) AS prev
    FROM (SELECT i AS id FROM edges UNION SELECT j FROM edges) u
    LEFT JOIN edges e ON e.j = u.id GROUP BY u.id)),
  walk(n, kept) AS (
    SELECT 0::BIGINT, []::BIGINT[]
    UNION ALL
    SELECT w.n + 1, CASE WHEN x.prev IS NOT NULL AND list_has_any(w.kept, x.prev) THEN w.kept
                         ELSE list_append(w.kept, x.id) END
    FROM walk w JOIN nodes x ON x.n = w.n + 1),
  leaders AS (SELECT unnest(kept) AS id FROM walk WHERE n = (SELECT max(n) FROM walk)),
  nearest AS (
    SELECT j AS id, i AS rep, sim FROM edges
    WHERE i IN (SELECT id FROM leaders) AND j NOT IN (SELECT id FROM leaders)
    QUALIFY row_number() OVER (PARTITION BY j ORDER BY sim DESC, i) = 1)"""


DENSE_EDGES = """
  SELECT a.vec_id AS i, b.vec_id AS j,
    list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim
  FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3
"""


PLANTED_PAIRS = """
  WITH e AS (SELECT 2 * vec_id AS id, embedding AS v FROM embeddings),
  moved AS (SELECT id + 1 AS id, list_transform(list_zip(v, list_reverse(v)), lambda z: (z[1]::DOUBLE + z[2]::DOUBLE * 0.2::DOUBLE)::FLOAT) AS v
    FROM e WHERE id % 4 = 0),
  lengths AS (SELECT id, v, sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])) AS n FROM moved),
  rows AS (SELECT id, v::DOUBLE[] AS v FROM e UNION ALL
    SELECT id, list_transform(v, lambda x: (x::DOUBLE / n)::FLOAT)::DOUBLE[] FROM lengths)
  SELECT a.id AS a, b.id AS b, round(list_dot_product(a.v, b.v), 5) AS sim
  FROM rows a JOIN rows b ON a.id < b.id WHERE list_dot_product(a.v, b.v) >= 0.92
"""


def gram_ctes(source: str) -> str:
    """CTEs ``counts(id, gram, c)`` and ``norms`` of word bigrams of ``source(id, text)``."""
    return f"""
  words AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r]+'), lambda x: x <> '') AS w
    FROM ({source})),
  grams AS (SELECT id, CASE WHEN len(w) = 1 THEN [w[1]]
      ELSE list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END AS g
    FROM words WHERE len(w) > 0),
  counts AS MATERIALIZED (SELECT id, gram, count(*) AS c FROM (SELECT id, unnest(g) AS gram FROM grams) GROUP BY ALL),
  norms AS MATERIALIZED (SELECT id, sum(c * c)::BIGINT AS n2, count(*) AS n_grams, sum(c)::BIGINT AS n_total
    FROM counts GROUP BY id)"""


GRAM_EDGES = """
  SELECT p.i, p.j, p.dot::DOUBLE / sqrt(a.n2::DOUBLE * b.n2::DOUBLE) AS sim
  FROM (SELECT x.id AS i, y.id AS j, sum(x.c * y.c) AS dot FROM counts x
        JOIN counts y ON x.gram = y.gram AND x.id < y.id GROUP BY ALL) p
  JOIN norms a ON a.id = p.i JOIN norms b ON b.id = p.j
  WHERE p.dot::DOUBLE / sqrt(a.n2::DOUBLE * b.n2::DOUBLE) >= 0.92
"""

DOCS = "SELECT doc_id AS id, text FROM documents"


def semantic(source: str) -> str:
    return f"WITH RECURSIVE {gram_ctes(source)}, {greedy(GRAM_EDGES)}"


CLUSTERS = f"""
  SELECT d.id, coalesce(m.rep, d.id) AS rep, coalesce(m.sim, 1.0) AS sim,
    CASE WHEN m.rep IS NULL THEN 'kept' ELSE 'dup' END AS state
  FROM ({DOCS}) d LEFT JOIN nearest m ON m.id = d.id
"""

# --- scores -------------------------------------------------------------------------

_S = "CASE WHEN quality = 1 THEN '4' ELSE '2' END"
SCORE_RESPONSES = f"""
  SELECT doc_id, CASE doc_id % 10
    WHEN 0 THEN '{{"clarity": 5, "overall": ' || {_S} || ', "reason": "ok"}}'
    WHEN 1 THEN 'Sure! {{"overall": ' || {_S} || ', "reason": "a {{b}} c"}} Bye.'
    WHEN 2 THEN '  {{"overall": "' || {_S} || '"}}' || {NL}
    WHEN 3 THEN '{{"overall": ' || {_S} || '.7, "domain_fit": 1}}'
    WHEN 4 THEN '{{"overall": 9}}'
    WHEN 5 THEN '{{"clarity": 2}}'
    WHEN 6 THEN '{{"overall": "high"}}'
    WHEN 7 THEN '[{{"overall": ' || {_S} || '}}]'
    WHEN 8 THEN 'no braces ' || {_S}
    ELSE '{{"overall": ' || {_S} || ', "extra": {{"x": 1}}}} and }} more' END AS response
  FROM labels
"""


def json_object(span: str) -> str:
    """The JSON object in ``s``: all of it, or the ``span`` match inside it."""
    return f"""CASE WHEN json_valid(s) THEN CASE WHEN s LIKE '{{%' THEN s END
      WHEN json_valid(regexp_extract(s, '{span}')) THEN nullif(regexp_extract(s, '{span}'), '') END"""


PARSED_SCORES = rf"""
  SELECT doc_id, s, obj,
    obj IS NULL OR (json_exists(obj, '$.overall') AND try_cast(obj ->> '$.overall' AS DOUBLE) IS NULL) AS failed
  FROM (SELECT doc_id, s, {json_object('(?s)[{].*[}]')} AS obj
        FROM (SELECT doc_id, {strip('response')} AS s FROM ({SCORE_RESPONSES})))
"""


def whole(key: str) -> str:
    return f"CASE WHEN NOT failed THEN trunc(try_cast(obj ->> '$.{key}' AS DOUBLE))::INT END"


SCORED = f"""
  SELECT d.doc_id, d.lang, coalesce({whole('overall')}, 3) AS overall
  FROM documents d LEFT JOIN ({PARSED_SCORES}) p USING (doc_id)
"""

VARIANT_RESPONSES = f"""
  SELECT conv_id::VARCHAR AS id, CASE WHEN length(prompt) % 5 = 0 THEN {NL} || ' 3.' || {NL}
    ELSE '1. ' || t || {NL} || {NL} || ' 2) - Please: ' || lower(t) || {NL} || '...' || {NL}
      || '- Or: ' || t || {NL} || '4. more' END AS response
  FROM (SELECT conv_id, prompt, replace(prompt, {NL}, ' ') AS t FROM ({FIRST_TURNS}))
"""


def variants(source: str, n: int) -> str:
    return rf"""
  SELECT id, v.j - 1 AS j, v.variant FROM (
    SELECT id, unnest(list_transform(l[1:{n}], lambda x, k: {{'j': k, 'variant': x}})) AS v FROM (
      SELECT id, list_filter(list_transform(string_split(response, {NL}),
        lambda x: regexp_replace({strip('x')}, '^(?:[0-9.)\-]\s*)+', '')), lambda x: x <> '') AS l
      FROM ({source})))
"""


# --- judging ------------------------------------------------------------------------

OUTPUTS = f"""
  SELECT conv_id AS id, CASE WHEN turn % 4 = 1 THEN 'base' ELSE 'finetune' END AS model,
    CASE WHEN length(text) >= 60 THEN ' ' || text || {NL} END AS output,
    ceil(length(text) / 4.0)::BIGINT AS tokens
  FROM conversations WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn % 4 = 1 ORDER BY turn) = 1
"""
PAIRED = f"""
  SELECT p.conv_id AS id, p.prompt, p.reference, {strip('b.output')} AS base_output, b.tokens AS base_tokens,
    {strip('f.output')} AS finetune_output, f.tokens AS finetune_tokens
  FROM ({FIRST_TURNS}) p
  JOIN ({OUTPUTS}) b ON b.id = p.conv_id AND b.model = 'base' AND b.output IS NOT NULL
  JOIN ({OUTPUTS}) f ON f.id = p.conv_id AND f.model = 'finetune' AND f.output IS NOT NULL
"""
VERDICT_RESPONSES = """
  SELECT doc_id AS id, CASE doc_id % 9
    WHEN 0 THEN '{"winner": "A", "reason": "clear"}'
    WHEN 1 THEN 'I say {"winner": "b"} ok'
    WHEN 2 THEN '{"winner": "TIE", "reason": null}'
    WHEN 3 THEN '{"winner": null}'
    WHEN 4 THEN 'So {"winner": "A", "why": {"x": 1}} done'
    WHEN 5 THEN 'unclear ' || text
    WHEN 6 THEN ' {"winner": "B", "why": {"x": 1}} '
    WHEN 7 THEN '[{"winner": "A"}]'
    ELSE '{"reason": "none"}' END AS response
  FROM documents
"""
VERDICTS = rf"""
  SELECT id, coalesce(lower(obj ->> '$.winner'), 'tie') AS verdict,
    CASE WHEN obj IS NULL THEN 'unparseable' ELSE coalesce(obj ->> '$.reason', '') END AS judge_reason,
    CASE WHEN obj IS NULL THEN left(s, 300) END AS unparsed
  FROM (SELECT id, s, {json_object('(?s)[{].*?[}]')} AS obj
        FROM (SELECT id, {strip('response')} AS s FROM ({VERDICT_RESPONSES})))
"""
JUDGED = f"""
  SELECT d.id, d.prompt, d.base_output, d.finetune_output, d.swapped, v.judge_reason,
    CASE WHEN v.verdict = 'a' THEN CASE WHEN swapped THEN 'finetune' ELSE 'base' END
         WHEN v.verdict = 'b' THEN CASE WHEN swapped THEN 'base' ELSE 'finetune' END
         ELSE 'tie' END AS judge_winner,
    'USER PROMPT:' || {NL} || prompt || {NL} || {NL} || 'RESPONSE A:' || {NL}
      || CASE WHEN swapped THEN finetune_output ELSE base_output END || {NL} || {NL} || 'RESPONSE B:' || {NL}
      || CASE WHEN swapped THEN base_output ELSE finetune_output END AS judge_prompt
  FROM (SELECT doc_id AS id, source AS prompt, {A} AS base_output, {B} AS finetune_output,
          {coin(42, 'doc_id')} < 0.5 AS swapped FROM documents) d
  JOIN ({VERDICTS}) v USING (id)
"""
WIN_RATES = f"""
  SELECT total, finetune_wins, base_wins, ties, {rnd('finetune_wins / total', 3)} AS finetune_win_rate,
    {rnd('base_wins / total', 3)} AS base_win_rate, {rnd('ties / total', 3)} AS tie_rate,
    CASE WHEN {rnd('finetune_wins / total', 3)} >= 0.6 THEN 'improved'
         WHEN {rnd('finetune_wins / total', 3)} >= 0.45 THEN 'comparable' ELSE 'worse' END AS interpretation
  FROM (SELECT count(*) AS total, count(*) FILTER (judge_winner = 'finetune') AS finetune_wins,
      count(*) FILTER (judge_winner = 'base') AS base_wins, count(*) FILTER (judge_winner = 'tie') AS ties
    FROM ({JUDGED}))
"""

# --- answers ------------------------------------------------------------------------

ANSWERS = f"""
  SELECT doc_id, source AS name, text AS generated,
    CASE lang WHEN 'en' THEN chr(9) || lower(text) || {NL} || ' ' WHEN 'de' THEN substr(text, 5)
      WHEN 'es' THEN 'zzz' END AS expected,
    ['exact_match', 'substring', 'llm_judge', 'other'][substr(source, 4)::INT % 4 + 1] AS metric_type,
    CASE WHEN doc_id % 3 = 0 THEN ' 1 yes' ELSE '0' END AS grade
  FROM documents
"""
EXACT = f"(lower({strip('generated')}) = lower({strip('expected')}))::INT::DOUBLE"
SUBSTRING = f"contains(lower({strip('generated')}), lower({strip('expected')}))::INT::DOUBLE"
GRADED = f"starts_with({strip('grade')}, '1')::INT::DOUBLE"
USABLE = "coalesce(expected, '') <> ''"

# --- requests -----------------------------------------------------------------------

REQUESTS = """
  SELECT event_id, event_type AS model, user_id AS batch, value AS total_ms,
    CASE WHEN event_id % 4 <> 0 THEN value / 8 END AS ttft_ms,
    (props ->> '$.k')::BIGINT AS output_tokens,
    CASE WHEN event_type = 'error' THEN 'HTTP 500' END AS error,
    epoch_us(ts) AS started_us, epoch_us(ts) + round(value / 1000 * 1000000)::BIGINT AS ended_us
  FROM events
"""


def quantile(value: str, q: float) -> str:
    """The value at 0-based index ``min(int(q * n), n - 1)``."""
    return f"list_sort(list({value}) FILTER ({value} IS NOT NULL))[least(floor(count({value}) * {q}), count({value}) - 1)::BIGINT + 1]"


def summary(group: str) -> str:
    speed = "CASE WHEN output_tokens > 0 AND total_ms > 0 THEN output_tokens / (total_ms / 1000.0) END"
    return f"""
  SELECT {group} AS model, count(total_ms) AS requests, count(ttft_ms) AS ttft_samples,
    {rnd('avg(total_ms)', 1)} AS latency_mean, {rnd('avg(ttft_ms)', 1)} AS ttft_mean,
    {rnd(f'avg({speed})', 1)} AS throughput_mean, {rnd(f'max({speed})', 1)} AS throughput_max,
    {rnd(quantile('total_ms', 0.5), 1)} AS latency_p50, {rnd(quantile('total_ms', 0.95), 1)} AS latency_p95,
    {rnd(quantile('total_ms', 0.99), 1)} AS latency_p99,
    {rnd(quantile('ttft_ms', 0.5), 1)} AS ttft_p50, {rnd(quantile('ttft_ms', 0.95), 1)} AS ttft_p95
  FROM ({REQUESTS}) WHERE error IS NULL GROUP BY 1
"""


PRICE_ROWS = ", ".join(f"('{p}', {i}::DOUBLE, {o}::DOUBLE)" for p, i, o in PRICES)


def costs(speeds: str) -> str:
    own = "0.05 / (3600.0 * tok_per_s) * 1000000.0"
    return f"""
  SELECT model, tok_per_s, {rnd(own, 4)} AS self_hosted_per_1m, provider, input_per_1m, output_per_1m,
    {rnd(f'output_per_1m / ({own})', 1)} AS factor
  FROM (SELECT model, throughput_mean AS tok_per_s FROM ({speeds}))
  CROSS JOIN (VALUES {PRICE_ROWS}) t(provider, input_per_1m, output_per_1m)
"""


# --- whole runs ---------------------------------------------------------------------

GATED = "SELECT doc_id AS id, text FROM documents WHERE length(text) BETWEEN 40 AND 32768"
ENRICHED = f"""
  {semantic(GATED)},
  fresh AS (SELECT id, text FROM ({GATED}) WHERE id NOT IN (SELECT id FROM nearest)),
  scored AS (SELECT f.id, f.text, s.overall FROM fresh f JOIN ({SCORED}) s ON s.doc_id = f.id),
  good AS (SELECT id, {redact('text')} AS text FROM scored WHERE overall >= 3),
  ranked AS (SELECT *, row_number() OVER (ORDER BY {sort_key(42, 'id')}, id) AS r, count(*) OVER () AS n FROM good),
  parts AS (SELECT id, text, CASE WHEN r <= greatest(1, floor(n * 0.05)) THEN 'eval' ELSE 'train' END AS split FROM ranked),
  added AS (SELECT id, split, k, CASE k WHEN 0 THEN 'variant of ' ELSE 'another of ' END || id AS text
    FROM parts CROSS JOIN (VALUES (0), (1)) t(k) WHERE split = 'train')
"""
_USER = lit(CHATML.turn_open.replace("{role}", "user"))
_END = lit(CHATML.turn_close)

_PATH = """'configs/extra/' || CASE page_id % 6 WHEN 0 THEN 'global-' WHEN 1 THEN 'client-acme-'
  WHEN 2 THEN 'client-other-' WHEN 3 THEN 'example-global-' WHEN 4 THEN 'global-' ELSE 'notes-' END
  || (page_id // 12) || '.yml'"""


def _domain() -> str:
    cases = [
        "WHEN " + " OR ".join(f"contains(lower(url), '{w}')" for w in words) + f" THEN '{tag}'"
        for tag, words in DOMAIN_RULES
    ]
    return "CASE " + " ".join(cases) + " END"


ORACLE = {
    "scan_jsonl": """
      SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, doc_id::VARCHAR AS id, length(text) AS n_chars
      FROM documents WHERE doc_id % 7 <> 5""",
    "scan_json_array": "SELECT doc_id::VARCHAR AS id, text FROM documents",
    "scan_csv": "SELECT doc_id::VARCHAR AS id, lang, text FROM documents",
    "scan_json_array_split": "SELECT doc_id::VARCHAR AS id, text FROM documents",
    "scan_csv_split": "SELECT doc_id::VARCHAR AS id, lang, text FROM documents",
    "scan_text_lines": f"""
      SELECT doc_id, l.k AS line_no, l.t AS text FROM (
        SELECT doc_id, unnest(list_transform(regexp_split_to_array(text, '\\r\\n|[\\r\\n]'),
          lambda x, k: {{'k': k, 't': {strip('x')}}})) AS l FROM documents)
      WHERE l.t <> ''""",
    "scan_text_file": f"""
      SELECT row_number() OVER (ORDER BY doc_id, l.k) - 1 AS ordinal, l.t AS text FROM (
        SELECT doc_id, unnest(list_transform(regexp_split_to_array(text, '\\r\\n|[\\r\\n]'),
          lambda x, k: {{'k': k, 't': {strip('x')}}})) AS l FROM documents)
      WHERE l.t <> ''""",
    "load_eval_set": "SELECT item_id, text FROM benchmark",
    "discover_specs": f"""
      SELECT path, min(priority) AS priority FROM (
        SELECT {_PATH} AS path, CASE WHEN page_id % 6 IN (0, 4) THEN 1 ELSE 2 END AS priority
        FROM pages WHERE page_id % 6 IN (0, 1, 4)
        UNION ALL SELECT 'configs/extra/global-1.yml', 0) GROUP BY path""",
    "route_kept_rejected": f"""
      SELECT doc_id, overall, CASE WHEN overall >= 3 THEN 'kept' ELSE 'rejected' END AS route FROM ({SCORED})""",
    "normalize_schema": f"""
      SELECT doc_id, shape, CASE WHEN shape = 'text' THEN 1 WHEN shape IS NOT NULL THEN 2 END::INT AS n_turns,
        user_text, assistant_text FROM ({NORMALIZED})""",
    "resolve_id": f"SELECT doc_id, id FROM ({NORMALIZED})",
    "fold_turns": f"""
      SELECT conv_id, count(*) AS n_turns, sum(length(text))::BIGINT AS n_chars, {REVIEW} AS transcript
      FROM conversations GROUP BY conv_id""",
    "length_gate": f"SELECT doc_id, n_chars, {ROUTE} AS route FROM (SELECT doc_id, length(text) AS n_chars FROM documents)",
    "funnel_counts": f"""
      SELECT count(*) AS total, count(*) FILTER (r = 'kept') AS kept, count(*) FILTER (r = 'schema') AS dropped_schema,
        count(*) FILTER (r = 'short') AS dropped_short, count(*) FILTER (r = 'long') AS dropped_long,
        count(*) FILTER (r = 'schema') / greatest(count(*), 1) > 0.2 AS high_schema_drop
      FROM (SELECT {ROUTE} AS r FROM (
        SELECT length(user_text) + length(coalesce(assistant_text, '')) AS n_chars FROM ({NORMALIZED})))""",
    "detect_format": """
      SELECT page_id, ['jsonl', 'json', 'csv', 'text', 'text', NULL, NULL][page_id % 7 + 1] AS format FROM pages""",
    "write_jsonl": """
      SELECT '{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || nullif(lang, 'en') || '"', 'null') || ',"n_chars":' || n_chars || '}' AS line
      FROM documents""",
    "rubric_prompt": f"""
      SELECT conv_id, md5('Rate it.' || {NL} || {NL} || 'Judge it as material on law.' || {NL} || {NL} || {REVIEW}) AS prompt_md5
      FROM conversations GROUP BY conv_id""",
    "row_text": f"SELECT conv_id, {JOINED} AS text FROM conversations GROUP BY conv_id",
    "review_text": f"SELECT conv_id, {REVIEW} AS text FROM conversations GROUP BY conv_id",
    "render_chat": f"""
      SELECT conv_id, {rendered(CHATML)} AS chatml, {rendered(LLAMA3)} AS llama3 FROM conversations GROUP BY conv_id""",
    "chat_template": f"""
      WITH placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS turns,
          first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'system' AS led,
          first_value(text) OVER (PARTITION BY conv_id ORDER BY turn) AS system FROM conversations),
      rest AS (SELECT *, CASE WHEN led THEN n - 1 ELSE n END AS i, CASE WHEN led THEN turns - 1 ELSE turns END AS length FROM placed)
      SELECT conv_id, '<s>' || coalesce(string_agg(CASE WHEN role = 'user'
          THEN '[INST] ' || CASE WHEN i = 1 AND led AND system <> '' THEN '<<SYS>>' || {strip('system')} || '<</SYS>>' || {NL} ELSE '' END
            || {strip('text')} || ' [/INST]'
          ELSE ' ' || i || '/' || length || ' ' || upper(role) || ': ' || text || '</s>' END, '' ORDER BY turn) FILTER (i > 0), '') AS text
      FROM rest GROUP BY conv_id""",
    "render_prompt": f"""
      SELECT conv_id, {rendered(CHATML, "FILTER (role <> 'assistant')")} || {lit(PROMPT_TAIL)} AS prompt
      FROM conversations GROUP BY conv_id""",
    "first_turns": FIRST_TURNS,
    "render_template": f"""
      SELECT doc_id, 'Review ' || source || ' (' || lang || '):' || {NL} || text || {NL} || 'Note: ' || n_chars
        || ' {{' || doc_id || '}}' AS prompt FROM documents""",
    "tag_domain": f"SELECT page_id, {_domain()} AS domain FROM pages",
    "pick_metric": f"""
      SELECT s.source AS task, upper(s.source) AS display_name,
        {rnd("CASE WHEN n % 2 = 0 THEN x ELSE q END", 4)} AS score
      FROM (SELECT source, avg(quality) AS q, avg(toxic) AS x, count(*) AS n
            FROM documents JOIN labels USING (doc_id) GROUP BY source) s
      WHERE s.source IN (SELECT source FROM documents WHERE lang = 'de')""",
    "scrub_text": f"""
      SELECT 'doc' AS kind, doc_id AS key, {scrub('text')} AS text FROM documents
      UNION ALL SELECT 'url', page_id, {scrub("'Dear Anna see ' || url")} FROM pages""",
    "scrub_messages": f"""
      SELECT conv_id, {JOINED} AS text FROM (
        SELECT conv_id, turn, {scrub('text')} AS text FROM conversations) GROUP BY conv_id""",
    "pii_counts": "SELECT source, "
    + ", ".join(
        f"sum(len(regexp_extract_all(text, {lit(p)})))::BIGINT AS {k.lower()}" for k, p in SCRUB_PATTERNS
    )
    + " FROM documents GROUP BY source",
    "redact_corpus": f"SELECT doc_id, text AS system_text, {redact('text')} AS user_text FROM documents",
    "embed_text": f"""
      WITH {gram_ctes(DOCS)}
      SELECT d.doc_id, coalesce(n_grams, 0) AS n_grams, coalesce(n_total, 0) AS n_total, coalesce(n2, 0) AS norm2,
        coalesce(v, '') AS counts
      FROM documents d LEFT JOIN norms n ON n.id = d.doc_id
      LEFT JOIN (SELECT id, string_agg(c::VARCHAR, ',' ORDER BY c) AS v FROM counts GROUP BY id) c ON c.id = d.doc_id""",
    "l2_normalize": """
      SELECT vec_id, round(CASE WHEN label = 0 THEN 0.0 ELSE 1.0 END, 4)::DOUBLE AS length,
        round(CASE WHEN label = 0 THEN 0.0 ELSE embedding[1]::DOUBLE / n END, 4) AS first,
        round(CASE WHEN label = 0 THEN 0.0 ELSE embedding[len(embedding)]::DOUBLE / n END, 4) AS last
      FROM (SELECT *, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)""",
    "cosine_pairs": f"SELECT i AS a, j AS b, round(sim, 6) AS sim FROM ({DENSE_EDGES})",
    # Bands may miss pairs; those planted here are so close that the chance is below 1e-9 each.
    "cosine_pairs_banded": PLANTED_PAIRS,
    "cosine_pairs_balls": PLANTED_PAIRS,
    "leader_clusters": f"""
      WITH RECURSIVE {greedy(DENSE_EDGES)},
      assigned AS (SELECT e.vec_id, coalesce(m.rep, e.vec_id) AS rep_id, m.rep IS NULL AS kept
        FROM embeddings e LEFT JOIN nearest m ON m.id = e.vec_id),
      ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS cluster_id FROM assigned WHERE kept)
      SELECT a.vec_id, a.rep_id, ids.cluster_id, a.kept FROM assigned a JOIN ids ON ids.vec_id = a.rep_id""",
    "exact_dedup": "SELECT min(doc_id) AS doc_id, count(*) AS n_copies, text FROM documents GROUP BY text",
    "semantic_dedup": f"""
      {semantic(DOCS)}, clusters AS ({CLUSTERS}),
      ids AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS cluster_id FROM clusters WHERE state = 'kept')
      SELECT c.id AS doc_id, c.rep AS rep_doc_id, round(c.sim, 6) AS similarity, c.state, ids.cluster_id
      FROM clusters c JOIN ids ON ids.id = c.rep""",
    "dedup_stats": f"""
      {semantic(DOCS)}, clusters AS ({CLUSTERS})
      SELECT count(*) AS total, count(*) FILTER (state = 'kept') AS kept,
        count(*) FILTER (state = 'dup') AS duplicates, count(DISTINCT rep) AS clusters, 0.92::DOUBLE AS threshold
      FROM clusters""",
    "parse_scores": f"""
      SELECT doc_id, {whole('clarity')} AS clarity, {whole('domain_fit')} AS domain_fit,
        coalesce({whole('overall')}, 3) AS overall, CASE WHEN NOT failed THEN obj ->> '$.reason' END AS reason,
        failed AS parse_failed, CASE WHEN failed THEN left(s, 200) END AS raw
      FROM ({PARSED_SCORES})""",
    "quality_filter": f"""
      SELECT doc_id, lang, overall, CASE WHEN overall >= 3 THEN 'kept' ELSE 'rejected' END AS route FROM ({SCORED})""",
    "score_histogram": f"""
      SELECT score::INT AS score, count(overall) AS rows FROM range(1, 6) b(score)
      LEFT JOIN ({SCORED}) s ON greatest(1, least(5, s.overall)) = b.score GROUP BY score""",
    "clean_variants": variants(VARIANT_RESPONSES, 3),
    "augment_rows": f"""
      WITH v AS ({variants(VARIANT_RESPONSES, 2)}),
      t AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1 AND role = 'user' AS hit
        FROM conversations)
      SELECT conv_id::VARCHAR AS id, NULL::VARCHAR AS aug_source, {JOINED} AS text FROM t GROUP BY conv_id
      UNION ALL
      SELECT conv_id || '_aug' || j, conv_id::VARCHAR,
        string_agg(CASE WHEN hit THEN variant ELSE text END, ' ' || {NL} || ' ' ORDER BY turn)
      FROM t JOIN v ON v.id = t.conv_id::VARCHAR GROUP BY conv_id, j""",
    "seeded_sample": f"SELECT doc_id, lang FROM documents ORDER BY {sort_key(42, 'doc_id')}, doc_id LIMIT 20",
    "train_eval_split": f"""
      SELECT doc_id, source, CASE WHEN r <= greatest(1, floor(n * 0.05)) THEN 'eval' ELSE 'train' END AS split
      FROM (SELECT doc_id, source, row_number() OVER (ORDER BY {sort_key(42, 'doc_id')}, doc_id) AS r,
        count(*) OVER () AS n FROM documents)""",
    "split_report": """
      SELECT 'example' AS base_model, count(*) AS total_rows,
        count(*) - greatest(1, floor(count(*) * 0.05))::BIGINT AS train_rows,
        greatest(1, floor(count(*) * 0.05))::BIGINT AS eval_rows, 0.05::DOUBLE AS eval_ratio
      FROM documents""",
    "head_rows": """
      WITH c AS (SELECT conv_id, count(*) FILTER (role = 'system') > 0 AS usable FROM conversations GROUP BY conv_id)
      (SELECT 'filter_first' AS mode, conv_id FROM c WHERE usable ORDER BY conv_id LIMIT 100)
      UNION ALL
      SELECT 'limit_first', conv_id FROM (SELECT * FROM c ORDER BY conv_id LIMIT 10) WHERE usable""",
    "report_samples": f"""
      SELECT id, prompt,
        CASE WHEN length(base_output) > 800 THEN left(base_output, 800) || '…' ELSE base_output END AS base_output,
        CASE WHEN length(finetune_output) > 800 THEN left(finetune_output, 800) || '…'
          ELSE finetune_output END AS finetune_output,
        judge_winner, judge_reason FROM ({JUDGED}) ORDER BY id LIMIT 8""",
    "pack_sequences": f"""
      WITH d AS (SELECT doc_id, ceil(length(text) / 4.0)::BIGINT AS n, {sort_key(42, 'doc_id')} AS h
        FROM documents WHERE length(text) BETWEEN 40 AND 32768),
      s AS (SELECT doc_id, n, (sum(n) OVER (ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS stop FROM d),
      f AS (SELECT *, stop - n AS start, unnest(range((stop - n) // 2048, (stop - 1) // 2048 + 1)) AS pack FROM s)
      SELECT pack, doc_id, greatest(start, pack * 2048) - start AS from_token,
        least(stop, (pack + 1) * 2048) - greatest(start, pack * 2048) AS n_tokens FROM f""",
    "pair_outputs": PAIRED,
    "unpaired_rows": f"""
      SELECT conv_id AS id, prompt FROM ({FIRST_TURNS}) WHERE conv_id NOT IN (SELECT id FROM ({PAIRED}))""",
    "parse_verdict": VERDICTS,
    "position_swap": f"SELECT id, swapped, judge_winner, md5(judge_prompt) AS prompt_md5 FROM ({JUDGED})",
    "win_rates": WIN_RATES,
    "score_exact": f"SELECT doc_id, {EXACT} AS score FROM ({ANSWERS}) WHERE {USABLE}",
    "score_substring": f"SELECT doc_id, {SUBSTRING} AS score FROM ({ANSWERS}) WHERE {USABLE}",
    "score_graded": f"SELECT doc_id, {GRADED} AS score FROM ({ANSWERS}) WHERE {USABLE}",
    "benchmark_scores": f"""
      SELECT name, metric_type, count(*) FILTER ({USABLE}) AS samples,
        {rnd(f'''coalesce(avg(CASE metric_type WHEN 'exact_match' THEN {EXACT} WHEN 'substring' THEN {SUBSTRING}
          WHEN 'llm_judge' THEN {GRADED} ELSE 0.0 END) FILTER ({USABLE}), 0.0)''', 4)} AS score
      FROM ({ANSWERS}) GROUP BY name, metric_type""",
    "latency_percentiles": f"""
      SELECT model, q::DOUBLE AS q, n, l[least(floor(n * q), n - 1)::BIGINT + 1] AS value
      FROM (SELECT model, count(total_ms) AS n, list_sort(list(total_ms)) AS l FROM ({REQUESTS}) GROUP BY model)
      CROSS JOIN (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) t(q)""",
    "latency_sketch": f"""
      SELECT model, q::DOUBLE AS q, n, true AS "within" FROM (SELECT model, count(total_ms) AS n FROM ({REQUESTS}) GROUP BY model)
      CROSS JOIN (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) t(q)""",
    "request_summary": summary("model"),
    "batch_throughput": f"""
      SELECT batch, tokens, {rnd('coalesce(tokens / nullif(wall, 0), 0.0)', 1)} AS tok_per_s FROM (
        SELECT batch, sum(CASE WHEN error IS NULL THEN output_tokens ELSE 0 END)::BIGINT AS tokens,
          (max(ended_us) - min(started_us)) / 1e6 AS wall FROM ({REQUESTS}) GROUP BY batch)""",
    "cost_comparison": costs(summary("model")),
    "headline_metrics": f"""
      WITH s AS ({summary("'all'")}), c AS ({costs(summary("'all'"))}), w AS ({WIN_RATES})
      SELECT 'perf_throughput' AS metric, throughput_mean AS value FROM s
      UNION ALL SELECT 'perf_ttft_p50', ttft_p50 FROM s
      UNION ALL SELECT 'perf_ttft_p95', ttft_p95 FROM s
      UNION ALL SELECT 'judge_finetune_pct', {rnd('finetune_win_rate * 100', 1)} FROM w
      UNION ALL SELECT 'self_hosted_cost', max(self_hosted_per_1m) FROM c
      UNION ALL SELECT 'provider_cost', output_per_1m FROM c WHERE provider = 'openai_gpt-4o'
      UNION ALL SELECT 'cost_savings_factor', factor FROM c WHERE provider = 'openai_gpt-4o'""",
    "enrich_corpus": f"""
      {ENRICHED}
      SELECT id::VARCHAR AS id, split, NULL::VARCHAR AS aug_source, {_USER} || text || {_END} AS text FROM parts
      UNION ALL SELECT id || '_aug' || k, split, id::VARCHAR, {_USER} || text || {_END} FROM added""",
    "enrich_report": f"""
      {ENRICHED},
      g AS (SELECT {ROUTE} AS r FROM (SELECT length(text) AS n_chars FROM documents)),
      m AS (
        SELECT 'gate' AS stage, unnest(['total', 'kept', 'dropped_schema', 'dropped_short', 'dropped_long', 'high_schema_drop']) AS metric,
          unnest([count(*), count(*) FILTER (r = 'kept'), 0, count(*) FILTER (r = 'short'), count(*) FILTER (r = 'long'), 0]) AS value FROM g
        UNION ALL SELECT 'dedup', unnest(['total', 'kept', 'duplicates', 'clusters']),
          unnest([(SELECT count(*) FROM ({GATED})), count(*), (SELECT count(*) FROM nearest), count(*)]) FROM fresh
        UNION ALL SELECT 'quality', unnest(['total', 'kept', 'rejected']),
          unnest([count(*), count(*) FILTER (overall >= 3), count(*) FILTER (overall < 3)]) FROM scored
        UNION ALL SELECT 'quality', 'score_' || b, count(overall) FROM range(1, 6) t(b)
          LEFT JOIN scored ON greatest(1, least(5, overall)) = b GROUP BY b
        UNION ALL SELECT 'augment', unnest(['input_rows', 'output_rows']), unnest([count(*), 3 * count(*)]) FROM parts WHERE split = 'train'
        UNION ALL SELECT 'final', 'rows', (SELECT count(*) FROM parts) + (SELECT count(*) FROM added))
      SELECT stage, metric, value::DOUBLE AS value FROM m
      UNION ALL SELECT 'dedup', 'threshold', 0.92
      UNION ALL SELECT 'config', unnest(['dedup', 'quality_filter', 'redact', 'augment', 'dedup_threshold',
        'quality_min_overall', 'augment_variants_per_row', 'eval_ratio']), unnest([1.0, 1, 1, 1, 0.92, 3, 2, 0.05])""",
    "stage_resume": """
      SELECT run::INT AS run, run = 1 AS reused, lang, count(*) AS rows
      FROM documents JOIN (VALUES (0, 40), (1, 40), (2, 400)) t(run, m) ON length(text) >= m GROUP BY run, lang""",
    "apply_model": """
      SELECT doc_id, CASE WHEN length(text) % 13 <> 0 THEN length(text)::VARCHAR END AS response,
        CASE WHEN length(text) % 13 = 0 THEN 'no answer' END AS error,
        CASE WHEN length(text) % 13 = 0 THEN 3 ELSE 1 END::INT AS attempts FROM documents""",
    "incremental_refresh": f"""
      {semantic(GATED)}
      SELECT id AS doc_id, {_USER} || {redact('text')} || {_END} AS text,
        CASE id % 3 WHEN 0 THEN 'd' WHEN 1 THEN '' ELSE '-' END || id AS id
      FROM ({GATED}) WHERE id NOT IN (SELECT id FROM nearest)""",
    "enrich_duplicates": f"""
      {semantic(GATED)}, clusters AS ({CLUSTERS})
      SELECT id::VARCHAR AS id, rep::VARCHAR AS covered_by, round(sim, 6) AS similarity FROM clusters WHERE state <> 'kept'""",
    "enrich_rejects": f"{ENRICHED} SELECT id::VARCHAR AS id, overall FROM scored WHERE overall < 3",
    "redact_model": """
      SELECT doc_id::VARCHAR AS id, CASE WHEN length(text) % 17 <> 0 THEN replace(text, 'e', '*') END AS text
      FROM documents WHERE length(text) BETWEEN 40 AND 32768""",
    "embedding_dedup": f"""
      WITH RECURSIVE {greedy(DENSE_EDGES.replace('0.3', '0.92'))},
      assigned AS (SELECT e.vec_id, coalesce(m.rep, e.vec_id) AS rep_id, coalesce(m.sim, 1.0) AS sim, m.rep IS NULL AS kept
        FROM embeddings e LEFT JOIN nearest m ON m.id = e.vec_id),
      ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS cluster_id FROM assigned WHERE kept)
      SELECT a.vec_id, a.rep_id AS rep_vec_id, round(a.sim, 6) AS similarity,
        CASE WHEN a.kept THEN 'kept' ELSE 'dup' END AS state, ids.cluster_id
      FROM assigned a JOIN ids ON ids.vec_id = a.rep_id""",
}
