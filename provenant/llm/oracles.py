"""DuckDB's SQL for the queries of this folder that SQL can express.

DuckDB has no CRC-32, so it is folded over the bytes with a table of 256 steps that the statement makes itself.
"""

from __future__ import annotations

BYTES = "list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)"
CRC_TABLE = """crc_steps AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(i)),
crc_table AS (SELECT list(v ORDER BY i) AS steps FROM crc_steps)"""
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a string column, where ``crc_table`` is joined."""
    return f"xor(list_reduce(list_prepend(4294967295, {BYTES.format(text)}), lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


IMPORTANCE = f"""
WITH {CRC_TABLE},
texts AS (SELECT doc_id AS id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
wanted AS (SELECT regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
doc_features AS (SELECT id, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM texts),
target_features AS (SELECT unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM wanted),
distinct_features AS (SELECT feature FROM doc_features UNION SELECT feature FROM target_features),
bucketed AS (SELECT feature, {crc32("feature")} % 10000 AS bucket FROM distinct_features, crc_table),
corpus AS (SELECT bucket, count(*) AS s FROM doc_features JOIN bucketed USING (feature) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM target_features JOIN bucketed USING (feature) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM corpus), 0)::DOUBLE AS s_all, coalesce((SELECT sum(t) FROM target), 0)::DOUBLE AS t_all),
gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
    FROM corpus LEFT JOIN target USING (bucket), totals),
sums AS (SELECT id, sum(gain)::BIGINT AS total, count(*) AS n FROM doc_features JOIN bucketed USING (feature) JOIN gains USING (bucket) GROUP BY id),
noise AS (SELECT doc_id AS id, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM documents),
scores AS (
    SELECT id, len(coalesce(words, [])) AS n_words, coalesce(n, 0) AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
        coalesce(floor(total::DOUBLE / n), 0)::BIGINT + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM texts LEFT JOIN sums USING (id) JOIN noise USING (id)),
places AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS place, count(*) OVER () AS n_all FROM scores WHERE n_words >= 20)
SELECT id AS doc_id, n_features, weight, score, CASE WHEN place <= 25 * n_all // 100 THEN place END AS rank FROM scores LEFT JOIN places USING (id)
"""

VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id AS id, unnest(regexp_extract_all({LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
per_document AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (SELECT run, n, {crc32("(id || ':' || run)")} AS h FROM per_document, crc_table),
results AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
vocabulary AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS MATERIALIZED (SELECT DISTINCT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM vocabulary)),
pairs AS (
    SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word FROM shorter a JOIN vocabulary b ON a.rest = b.word
    UNION SELECT b.word, a.word FROM shorter a JOIN vocabulary b ON a.rest = b.word),
near AS (SELECT p.word, count(*) AS n_near, min(struct_pack(less := -v.n, near := p.near)) AS best FROM pairs p JOIN vocabulary v ON v.word = p.near GROUP BY p.word),
forms AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 10 * n THEN best.near END AS form, CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n
    FROM vocabulary LEFT JOIN near USING (word)),
chain AS (
    SELECT word, word AS at FROM forms
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at WHERE e.form IS NULL
"""
