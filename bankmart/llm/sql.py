"""DuckDB SQL for the operators that SQL can express, by query name."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NGRAM_JACCARD_JOIN = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, gram FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
            ELSE list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                lambda i: array_to_string(w[i:i + 4], ' ')) END) AS gram FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 80 * ((SELECT n FROM sizes s WHERE s.doc_id = a.doc_id)
        + (SELECT n FROM sizes s WHERE s.doc_id = b.doc_id) - count(*))),
pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, x.b FROM reach r JOIN pairs x ON r.b = x.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

MIX_SOURCES = rf"""
WITH docs AS (
    SELECT d.doc_id, d.source, len({_WORDS}) AS size,
        -ln((CAST('0x' || substr(md5('0:' || d.doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
        / coalesce(w.weight, 1.0) AS key
    FROM documents d LEFT JOIN (
        SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight
        FROM labels GROUP BY doc_id) w ON w.doc_id = d.doc_id),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS weight
    FROM docs GROUP BY source),
capped AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS per_weight FROM sources),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
        - coalesce(sum(cap) OVER (ORDER BY per_weight, source IS NULL, source
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY per_weight, source IS NULL, source
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM capped),
first_free AS (SELECT level FROM levels WHERE per_weight > level ORDER BY per_weight LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN per_weight > f.level THEN f.level * weight ELSE cap END AS target
    FROM levels LEFT JOIN first_free f ON true),
goals AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
        target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS rest
    FROM targets),
placed AS (
    SELECT d.*, g.source_size, g.target, g.epochs, g.rest,
        g.rest > 0 AND sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
                                       ROWS UNBOUNDED PRECEDING) <= g.rest AS chosen
    FROM docs d JOIN goals g ON g.source IS NOT DISTINCT FROM d.source),
gaps AS (
    SELECT *, rest - sum(CASE WHEN chosen THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM placed),
filled AS (
    SELECT *, NOT chosen AND rest > 0 AND size > 0 AND abs(size - gap) < gap AS fits FROM gaps),
ranked AS (
    SELECT *, fits AND row_number() OVER (PARTITION BY source, fits ORDER BY abs(size - gap), key, doc_id) = 1
        AS last FROM filled)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    ((epochs + (chosen OR last)::INT) * size)::BIGINT AS taken FROM ranked
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v,
        label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND a.ok AND b.ok AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, x.b FROM reach r JOIN links x ON r.b = x.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id,
    e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""

_TERMS = r"""unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

RANKED_SEARCH = rf"""
WITH terms AS (SELECT doc_id, {_TERMS} AS term FROM documents),
lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM terms GROUP BY doc_id),
asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
held AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM terms
    WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, totals GROUP BY term, docs),
scores AS (
    SELECT a.item_id, h.doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // tokens))))::BIGINT AS score
    FROM asked a JOIN held h USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY a.item_id, h.doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

# One statement per rule: failures by host, their moments, the beta prior's strength.
_RULES = {
    "few_words": "n_words < 50", "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words", "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)",
}

QUALITY_RULES = rf"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i, w[i:i + 2] AS win FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeated AS (
    SELECT doc_id, count(DISTINCT place)::BIGINT AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows
        WHERE (doc_id, win) IN (SELECT (doc_id, win) FROM windows GROUP BY doc_id, win HAVING count(*) > 1))
    GROUP BY doc_id),
lines AS (
    SELECT doc_id, source, text, w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
counts AS (
    SELECT l.doc_id, coalesce('s' || source, '') AS host, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words
    FROM lines l LEFT JOIN repeated r ON r.doc_id = l.doc_id),
failures AS (
    {" UNION ALL ".join(f"SELECT '{r}' AS rule, doc_id, host, {x} AS failed FROM counts" for r, x in _RULES.items())}),
hosts AS (SELECT rule, host, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k FROM failures GROUP BY rule, host),
pooled AS (SELECT rule, sum(n) AS n, sum(k) / sum(n) AS m, sum(n * n) AS squares, count(*) AS hosts
    FROM hosts GROUP BY rule),
spread AS (SELECT rule, sum(h.n * (h.k / h.n - m) ** 2) AS s FROM hosts h JOIN pooled USING (rule) GROUP BY rule),
alike AS (
    SELECT rule, m, CASE WHEN m * (1 - m) > 0 AND p.n - squares / p.n - (hosts - 1) > 0
        THEN (s - m * (1 - m) * (hosts - 1)) / (m * (1 - m) * (p.n - squares / p.n - (hosts - 1))) ELSE 0 END AS a
    FROM pooled p JOIN spread USING (rule)),
rates AS (
    SELECT rule, host, m, CASE WHEN a <= 0 THEN m
        ELSE (k + m * greatest(1 / least(a, 1) - 1, 10)) / (n + greatest(1 / least(a, 1) - 1, 10)) END AS rate
    FROM hosts JOIN alike USING (rule)),
lost AS (
    SELECT doc_id, bool_or(rate >= 0.5 OR (failed AND rate >= 0.2 AND rate >= 2 * m)) AS gone
    FROM failures JOIN rates USING (rule, host) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    {_RULES["few_words"]} OR {_RULES["repeated_words"]} AS base_failed,
    NOT ({_RULES["few_words"]} OR {_RULES["repeated_words"]}) AND NOT gone AS kept
FROM counts JOIN lost USING (doc_id)
"""

ORACLE_SQL = {
    "op1_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
    "op5_mix_sources": MIX_SOURCES,
    "op8_embedding_dedup": EMBEDDING_DEDUP,
    "op12_quality_rules": QUALITY_RULES,
    "op13_ranked_search": RANKED_SEARCH,
}
