"""The same results in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Rows of a table may repeat, so each gets a number of its own.
DOCUMENTS = f"docs AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, text, {WORDS} AS words FROM documents)"

OP2 = r"""
WITH low AS (
    SELECT doc_id, row_number() OVER () AS d,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
starts AS (SELECT item, words, unnest(range(0, greatest(len(words) - 9, 1))) AS k FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[k + 1 : k + 10], ' ') AS w FROM starts),
places AS (SELECT d, words, n, unnest(range(0, len(words) - n + 1)) AS k FROM low, (SELECT DISTINCT n FROM windows)),
hits AS (
    SELECT d, k, p.n, item FROM (SELECT d, k, n, array_to_string(words[k + 1 : k + n], ' ') AS w FROM places) p
    JOIN windows USING (w) WHERE windows.n = p.n),
covered AS (SELECT d, count(DISTINCT place) AS n_hit FROM (SELECT d, unnest(range(k, k + n)) AS place FROM hits) GROUP BY d),
found AS (SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT d, item FROM hits) GROUP BY d)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN covered USING (d) LEFT JOIN found USING (d)
"""

OP5 = f"""
WITH {DOCUMENTS},
places AS (SELECT d, unnest(range(1, len(words) + 1)) AS k FROM docs),
each AS (
    SELECT d, k, words[k] AS word,
           CASE WHEN k + 34 <= len(words) THEN array_to_string(words[k : k + 34], ' ') END AS w
    FROM places JOIN docs USING (d)),
counted AS (SELECT d, k, word, w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 AS twice FROM each),
gone AS (SELECT d, k, word, bool_or(twice) OVER (PARTITION BY d ORDER BY k ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
kept AS (SELECT d, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept FROM gone GROUP BY d)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (d)
"""

OP6 = """
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
places AS (SELECT d, h, unnest(range(0, length(h) // 2)) AS k FROM docs),
each AS (
    SELECT d, k, substr(h, 2 * k + 1, 2) AS b,
           CASE WHEN 2 * k + 400 <= length(h) THEN md5_number(substr(h, 2 * k + 1, 400)) END AS w
    FROM places),
counted AS (SELECT d, k, b, w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 AS twice FROM each),
gone AS (SELECT d, k, b, bool_or(twice) OVER (PARTITION BY d ORDER BY k ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone FROM counted),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY d ORDER BY k), false) AS opens FROM gone),
kept AS (
    SELECT d, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
           string_agg(b, '' ORDER BY k) FILTER (NOT gone) AS kept FROM edges GROUP BY d)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (d)
"""

OP8 = rf"""
WITH {DOCUMENTS},
places AS (SELECT d, unnest(range(1, len(words) - 1)) AS k FROM docs),
windows AS (SELECT d, k, array_to_string(words[k : k + 2], ' ') AS w FROM places JOIN docs USING (d)),
twice AS (SELECT d, k, count(*) OVER (PARTITION BY d, w) > 1 AS twice FROM windows),
repeated AS (SELECT d, count(DISTINCT place) AS n FROM (SELECT d, unnest([k, k + 1, k + 2]) AS place FROM twice WHERE twice) GROUP BY d),
lines AS (
    SELECT d, count(*) AS n, count(*) - count(DISTINCT line) AS dup
    FROM (SELECT d, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY d),
measured AS (
    SELECT doc_id, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(lines.n, 0) AS n_lines, coalesce(dup, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
           length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper,
           length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS n_letters
    FROM docs LEFT JOIN lines USING (d) LEFT JOIN repeated USING (d)),
judged AS (
    SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN n_letters > 0 AND 10 * n_upper > 8 * n_letters THEN 8 ELSE 0 END
        + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END + CASE WHEN word_chars > 25 * n_words THEN 64 ELSE 0 END AS bits
    FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & 3 <> 0 AS base_failed, bits & 15 = 0 AS kept,
       CAST(bits AS BIGINT) AS failed_bits
FROM judged
"""

OP11 = r"""
WITH bits AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i)),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tbl FROM bits),
texts AS MATERIALIZED (
    SELECT row_number() OVER () AS d, raw, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM (SELECT true AS raw, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark)),
grams AS MATERIALIZED (
    SELECT d, raw, unnest(words || list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) AS g FROM texts),
kinds AS (SELECT DISTINCT g, hex(encode(g)) AS h FROM grams),
bytes AS (SELECT g, list_transform(range(0, length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) AS b FROM kinds),
buckets AS MATERIALIZED (
    SELECT g, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tbl[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, crc),
counts AS (SELECT bucket, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM grams JOIN buckets USING (g) GROUP BY bucket),
totals AS (SELECT count(*) FILTER (raw) AS s_all, count(*) FILTER (NOT raw) AS t_all FROM grams),
gains AS MATERIALIZED (
    SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
    FROM counts, totals),
weights AS (
    SELECT d, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM grams JOIN buckets USING (g) JOIN gains USING (bucket) WHERE raw GROUP BY d),
scored AS (
    SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
               + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM texts LEFT JOIN weights USING (d) WHERE raw),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
           count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""


def _op13(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Each round is one assignment and one step of the means; the last assignment gives the codes."""
    steps = [
        f"""
whole AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
cut AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM whole, range({parts}) t(p)),
seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS e FROM whole QUALIFY e < {entries}),
c0 AS MATERIALIZED (SELECT p, e, x AS c FROM cut JOIN seeds USING (r))"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
    SELECT r, p, any_value(x) AS x,
           min(struct_pack(d := CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e := e)) AS best
    FROM cut JOIN c{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (
    SELECT p, e, list(m ORDER BY i) AS c FROM (
        SELECT p, best.e AS e, i, CAST(floor(sum(y)::DOUBLE / count(*)) AS BIGINT) AS m
        FROM (SELECT p, best, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY ALL) GROUP BY p, e),
c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (p, e))""")
    steps.append(f"""
coded AS (
    SELECT r, string_agg(lower(right('0' || hex(best.e), 2)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM a{rounds} GROUP BY r),
books AS (
    SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(c) AS y, generate_subscripts(c, 1) AS i FROM c{rounds}))""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM whole JOIN coded USING (r), books
"""


ORACLES = {
    "op2_decontaminate": OP2,
    "op5_substring_dedup": OP5,
    "op6_suffix_dedup": OP6,
    "op8_quality_rules": OP8,
    "op11_resampling": OP11,
    "op13_vector_codes": _op13(),
}
