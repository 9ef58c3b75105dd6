"""DuckDB SQL with the results of those operators that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS digest, row_number() OVER (PARTITION BY doc_id, source, text) - 1 AS nth
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([3, 1, 2][turn % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS whole
  FROM sources
), leveled AS (
  SELECT *, cap / weight AS need,
         (whole - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT max(level) FROM leveled WHERE need > level) * weight, cap)) AS target
  FROM leveled
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), '') || ':' || digest || ':' || nth), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rated
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM counted
"""

JACCARD = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END, ' ') AS s
  FROM cut, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * o >= 85 * (a.n + b.n - o)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
), degrees AS (
  SELECT x, count(*) AS n_links FROM links GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM documents d JOIN least l ON l.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN degrees g ON g.x = d.doc_id
"""

REPEATS = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM cut, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50
), least AS (
  SELECT s, min(doc_id) AS lo FROM wins GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, i + k AS at
  FROM (SELECT doc_id, i FROM wins JOIN least USING (s) WHERE doc_id > lo), unnest(range(0, 50)) AS t(k)
), kept AS (
  SELECT c.doc_id, string_agg(c.word, ' ' ORDER BY c.at) AS body, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM cut) c
  LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.at = c.at WHERE g.at IS NULL GROUP BY c.doc_id
)
SELECT cut.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""



def _repeated(k: int) -> str:
    """Per document the words in windows of k words that it has twice or more."""
    return f"""
  SELECT doc_id, count(DISTINCT i + j) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c
        FROM (SELECT doc_id, i, array_to_string(w[i:i + {k - 1}], ' ') AS s
              FROM cut, unnest(range(1, len(w) - {k - 2})) AS t(i))),
       unnest(range(0, {k})) AS u(j)
  WHERE c > 1 GROUP BY doc_id"""


# Repeats of 20 words or more cover what repeated windows of 20 words cover.
RULES = rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), five AS ({_repeated(5)}
), twenty AS ({_repeated(20)}
), longer AS ({_repeated(61)}
), counted AS (
  SELECT cut.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(five.n, 0) AS n_repeat_words, coalesce(twenty.n, 0) AS n_covered_words, coalesce(longer.n, 0) AS n_longer
  FROM cut LEFT JOIN five USING (doc_id) LEFT JOIN twenty USING (doc_id) LEFT JOIN longer USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       CAST(n_covered_words AS BIGINT) AS n_covered_words, base_failed,
       NOT base_failed AND n_covered_words <= 0.15::DOUBLE * n_words AND n_longer = 0 AS kept
FROM judged
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _crc_steps() -> list[int]:
    """What each low half-byte does to a CRC-32 register."""
    out = []
    for step in range(16):
        for _ in range(4):
            step = step >> 1 ^ (0xEDB88320 if step & 1 else 0)
        out.append(step)
    return out


RESAMPLED = rf"""
WITH docs AS (
  SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word FROM docs
), asked AS (
  SELECT unnest({_PLAIN_WORDS}) AS word FROM benchmark
), spelled AS (
  SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM words UNION SELECT word FROM asked)
), halves AS (
  SELECT word, flatten(list_transform(range(1, length(digits) // 2 + 1), lambda i: [
    strpos('0123456789ABCDEF', substr(digits, 2 * i, 1)) - 1, strpos('0123456789ABCDEF', substr(digits, 2 * i - 1, 1)) - 1])) AS half
  FROM spelled
), placed AS (
  SELECT word, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, half::BIGINT[]),
    lambda c, x: xor(c >> 4, ({_crc_steps()}::BIGINT[])[(xor(c, x) & 15) + 1]))) % 10000 AS bucket
  FROM halves
), source AS (
  SELECT bucket, count(*) AS s FROM words JOIN placed USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM asked JOIN placed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM source) + 10000) AS DOUBLE)
         / CAST((s + 1) * ((SELECT coalesce(sum(t), 0) FROM target) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM source LEFT JOIN target USING (bucket)
), weighed AS (
  SELECT doc_id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM words JOIN placed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs d LEFT JOIN weighed g ON g.doc_id = d.doc_id
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score,
       CASE WHEN rank <= 10 * (SELECT count(*) FROM ranked) // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id
"""


def _codes() -> str:
    """Six rounds over eight parts and sixteen entries, one after the other."""
    steps = []
    for i in range(7):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, p, min(16 * d + e) AS best
  FROM (SELECT c.vec_id, p, e, CAST(list_sum(list_transform(list_zip(c.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM cut c JOIN b{i} b USING (p))
  GROUP BY vec_id, p
)""")
        if i < 6:
            steps.append(f"""m{i} AS (
  SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS x
  FROM (SELECT p, best % 16 AS e, j, CAST(sum(x[j]) AS DOUBLE) AS s, count(*) AS n
        FROM a{i} JOIN cut USING (vec_id, p), unnest(range(1, len(x) + 1)) AS t(j) GROUP BY ALL)
  GROUP BY p, e
), b{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (p, e)
)""")
    return ", ".join(steps)


CODES = rf"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // 8 + 1:(p + 1) * len(v) // 8] AS x FROM kept, unnest(range(0, 8)) AS t(p)
), b0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x
  FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
), {_codes()}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % 16), '' ORDER BY p) AS code, CAST(sum(best // 16) AS BIGINT) AS error FROM a6 GROUP BY vec_id
), summed AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label
)
SELECT c.vec_id, code, error, label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b6) AS codebooks_sha256
FROM coded c JOIN kept k ON k.vec_id = c.vec_id JOIN summed s ON s.label IS NOT DISTINCT FROM k.label
"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": JACCARD,
    "op2_substring_dedup": REPEATS,
    "op5_mix_sources": MIX,
    "op6_repetition_rules": RULES,
    "op11_resample": RESAMPLED,
    "op13_vector_codes": CODES,
}
