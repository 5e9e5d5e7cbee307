"""DuckDB SQL for the corpus queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

# Quality rules: measures by unnesting words and windows, sketches as counts in log-linear buckets.
OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, lang, source FROM documents),
w AS (SELECT r, doc_id, lang, source, t, regexp_extract_all(t, '{WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
windows AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
often AS (SELECT r, win FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM windows JOIN often USING (r, win), range(5) AS s(k) GROUP BY r),
m AS (SELECT r, doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_shouts,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
             len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_stutters FROM w LEFT JOIN covered USING (r)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length,
             CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
             CASE WHEN n_words > 0 THEN 1000 * n_shouts // n_words ELSE 0 END AS shouts,
             CASE WHEN word_chars > 0 THEN 1000 * n_capitals // word_chars ELSE 0 END AS capitals,
             CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
             CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_words,
             CASE WHEN n_words > 0 THEN 1000 * n_stutters // n_words ELSE 0 END AS stutter FROM m),
long AS (SELECT r, lang, source, base_failed, rule, value FROM v UNPIVOT (value FOR rule IN (word_length, symbols, shouts, capitals, dup_lines, repeat_words, stutter))),
b AS (SELECT lang, source, rule, CASE WHEN value < 32 THEN value ELSE (length(bin(value)) - 4) * 16 + (value >> (length(bin(value)) - 5)::INT) - 16 END AS bucket
      FROM long WHERE NOT base_failed),
sk AS (SELECT 0 AS grain, lang, source, rule, bucket, count(*) AS n FROM b GROUP BY ALL
       UNION ALL SELECT 1, lang, NULL, rule, bucket, count(*) FROM b GROUP BY ALL
       UNION ALL SELECT 2, NULL, NULL, rule, bucket, count(*) FROM b GROUP BY ALL),
seen AS (SELECT *, sum(n) OVER (PARTITION BY grain, lang, source, rule ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY grain, lang, source, rule) AS size FROM sk),
qb AS (SELECT grain, lang, source, rule, max(size) AS size, min(bucket) FILTER (4 * upto >= size)::INT AS b1,
              min(bucket) FILTER (4 * upto >= 3 * size)::INT AS b3 FROM seen GROUP BY ALL),
q AS (SELECT grain, lang, source, rule, size, CASE WHEN b1 < 32 THEN b1 ELSE (b1 % 16 + 16)::BIGINT << (b1 // 16 - 1) END AS q1,
             CASE WHEN b3 < 32 THEN b3 ELSE (b3 % 16 + 16)::BIGINT << (b3 // 16 - 1) END AS q3 FROM qb),
picked AS (SELECT o.lang, o.source, o.rule,
                  CASE WHEN o.size >= 200 THEN o.q1 WHEN m.size >= 200 THEN m.q1 ELSE a.q1 END AS q1,
                  CASE WHEN o.size >= 200 THEN o.q3 WHEN m.size >= 200 THEN m.q3 ELSE a.q3 END AS q3
           FROM q o JOIN q m ON m.grain = 1 AND m.rule = o.rule AND m.lang IS NOT DISTINCT FROM o.lang
           JOIN q a ON a.grain = 2 AND a.rule = o.rule WHERE o.grain = 0),
bounds AS (SELECT lang, source, rule, q1 - 3 * greatest(q3 - q1, CASE WHEN rule = 'dup_lines' THEN 120 WHEN rule IN ('word_length', 'capitals', 'repeat_words') THEN 60 ELSE 40 END) AS low,
                  q3 + 3 * greatest(q3 - q1, CASE WHEN rule = 'dup_lines' THEN 120 WHEN rule IN ('word_length', 'capitals', 'repeat_words') THEN 60 ELSE 40 END) AS high FROM picked),
out_of_line AS (SELECT l.r, bool_or(b.rule IS NULL OR l.value > b.high OR (l.rule = 'word_length' AND l.value < b.low)) AS bad
        FROM long l LEFT JOIN bounds b ON b.rule = l.rule AND b.lang IS NOT DISTINCT FROM l.lang AND b.source IS NOT DISTINCT FROM l.source GROUP BY l.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM v JOIN out_of_line USING (r)"""

# WARC audit: the records of both replicas by their digests, side by side.
_RECORD = (r"""'WARC/1.0' || E'\r\n' || 'WARC-Type: response' || E'\r\n' || 'WARC-Target-URI: ' || coalesce(url, '') || E'\r\n' || 'WARC-Record-ID: <urn:page:' """
           r"""|| coalesce(page_id::VARCHAR, '') || '>' || E'\r\n' || 'Content-Type: text/html; charset=utf-8' || E'\r\n' || 'Content-Length: ' """
           r"""|| strlen({body}) || E'\r\n\r\n' || {body} || E'\r\n\r\n'""")
OP4 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, coalesce(substr(md5(page_id::VARCHAR), 1, 2), '') AS damage FROM pages),
q AS (SELECT *, CASE damage WHEN '00' THEN '~' || substr(body, 2) WHEN '01' THEN left(body, length(body) // 2) ELSE body END AS broken FROM p),
r AS (SELECT page_id, damage, sha256({_RECORD.format(body="body")}) AS first_digest, strlen({_RECORD.format(body="body")}) AS length,
             CASE WHEN damage <> '02' THEN sha256({_RECORD.format(body="broken")}) END AS second_digest FROM q),
o AS (SELECT *, coalesce(page_id // 1000, -1) AS file FROM r),
s AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, first_digest, length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM o)
SELECT page_id, file, "offset", length, CASE WHEN second_digest IS NULL THEN 'missing' ELSE 'changed' END AS status, first_digest, second_digest
FROM s WHERE first_digest IS DISTINCT FROM second_digest"""

# Line dedup: a line goes if it lies in a run of 50 words or more that occurs earlier.
OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
x AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM d),
l AS (SELECT r, doc_id, line, no, len(regexp_extract_all(line, '{WORD}')) AS n, row_number() OVER (PARTITION BY r ORDER BY no) AS pos
      FROM x WHERE regexp_matches(line, '{WORD}')),
c AS (SELECT *, sum(n) OVER (PARTITION BY r ORDER BY pos) AS upto FROM l),
runs AS (SELECT a.r, a.doc_id, a.pos AS start, min(b.pos) AS stop FROM c a JOIN c b ON b.r = a.r AND b.pos >= a.pos AND b.upto - a.upto + a.n >= 50 GROUP BY ALL
         UNION SELECT a.r, a.doc_id, max(b.pos), a.pos FROM c a JOIN c b ON b.r = a.r AND b.pos <= a.pos AND a.upto - b.upto + b.n >= 50 GROUP BY ALL),
t AS (SELECT u.r, u.doc_id, u.start, u.stop, string_agg(l.line, chr(10) ORDER BY l.pos) AS content FROM runs u JOIN l ON l.r = u.r AND l.pos BETWEEN u.start AND u.stop GROUP BY ALL),
f AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS LAST, r, start) AS place FROM t),
gone AS (SELECT DISTINCT l.r, l.no FROM f JOIN l ON l.r = f.r AND l.pos BETWEEN f.start AND f.stop WHERE f.place > 1),
kept AS (SELECT x.r, string_agg(x.line, chr(10) ORDER BY x.no) AS text, count(*) AS n FROM x ANTI JOIN gone ON gone.r = x.r AND gone.no = x.no GROUP BY x.r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END - coalesce(kept.n, 0) AS n_deleted,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN kept USING (r)"""

# Mixing: targets by filling up from the smallest ratio of cap to weight; order and prefix sums by MD5.
OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM w),
p AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER () AS total FROM o),
lv AS (SELECT coalesce(min_by(level, k), 0) AS level FROM (SELECT k, (1.5 * total - filled) / rest AS level, 2 * source_size / weight AS bound FROM p) WHERE level < bound),
g AS (SELECT source, source_size, round(least((2 * source_size)::DOUBLE, level::DOUBLE * weight), 6) AS target FROM w, lv),
b AS (SELECT *, floor(target + 0.5)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS rounds FROM g),
c AS (SELECT d.*, b.source_size, b.target, b.rounds, b.budget - b.rounds * b.source_size
             - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size, d.r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
      FROM d JOIN b ON b.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, (rounds * size + greatest(0, least(size, rest)))::BIGINT AS taken FROM c"""

# Secrets: matches with the text before them give positions; weak parts are checked against all parts in scope.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_WEAK = r"""(?i:pwd|pass|credential|private_?key|auth)["'']?\x20*[:=]\x20*["'']?([^\x20\x09-\x0D"'',;]{4,})"""
_IDENTIFIER = r"""(?i:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9@._+-]{3,})"""
_ENDPOINT = r"""(?i:https?|ftp|sftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://([^\x20\x09-\x0D"''<>]+)"""


def _found(number: int, pattern: str, group: int) -> str:
    whole = f"(?s)(.*?)({pattern})"
    return (f"SELECT r, {number} AS kind, unnest(regexp_extract_all(t, '{whole}', 0)) AS step, unnest(regexp_extract_all(t, '{whole}', 2)) AS hit, "
            f"unnest(regexp_extract_all(t, '{whole}', {group})) AS part, unnest(range(len(regexp_extract_all(t, '{whole}', 0)))) AS no FROM d")


OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_found(0, _ASSIGN, 3)} UNION ALL {_found(1, "AKIA[A-Z0-9]{14,}", 2)} UNION ALL {_found(2, "[0-9a-f]{16,}", 2)}
      UNION ALL {_found(3, _WEAK, 3)} UNION ALL {_found(4, _IDENTIFIER, 3)} UNION ALL {_found(5, _ENDPOINT, 3)}),
e AS (SELECT *, sum(length(step)) OVER (PARTITION BY r, kind ORDER BY no) AS stop FROM m),
s AS (SELECT r, CASE WHEN kind = 0 AND length(part) < 12 THEN 3 ELSE kind END AS kind, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop FROM e WHERE kind <> 0 OR length(part) >= 4),
o AS (SELECT *, CASE WHEN kind = 5 THEN 'e' WHEN kind IN (1, 4) THEN 'i' ELSE 's' END AS role FROM s),
near AS (SELECT a.r, a.kind, a.start, a.stop, a.role, bool_or(b.role = 'i') AS i, bool_or(b.role = 's') AS x
         FROM o a JOIN o b ON b.r = a.r AND b.role <> a.role AND abs(a.start - b.start) <= 200 WHERE a.kind >= 3 GROUP BY ALL),
spans AS (SELECT r, kind, start, stop FROM s WHERE kind < 3
          UNION SELECT r, kind, start, stop FROM near WHERE CASE role WHEN 's' THEN i WHEN 'i' THEN x ELSE i AND x END),
a AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans
      FROM (SELECT *, ['assign', 'access', 'hex', 'weak', 'identifier', 'endpoint'][kind + 1] AS name FROM spans) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)"""

# Ranked search: every document against every item over the words they share.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    return f"regexp_extract_all(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"


OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS ts FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS length FROM d WHERE len(ts) > 0),
b AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_terms("text")}) AS ts FROM benchmark),
q AS (SELECT item, item_id, unnest(ts) AS term FROM b),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
m AS (SELECT r, doc_id, 100 - 50 + ((50::BIGINT * len(ts) * n_docs) // length) AS m FROM d, c WHERE len(ts) > 0),
s AS (SELECT item, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
      FROM s WHERE score > 0) WHERE rank <= 50"""


# Clusters: each round as a table of centroids made from the one before.
def _clusters(k: int, rounds: int) -> str:
    steps = ["""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: greatest(least(floor(256 * x::DOUBLE), 134217727), -134217728)::BIGINT) AS x FROM embeddings
         WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64)""",
             f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY draw, x) - 1)::INTEGER AS cluster, x AS c FROM
         (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS draw, x FROM v) ORDER BY draw, x LIMIT {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, x, best[2]::INTEGER AS cluster, best[1] AS distance FROM
         (SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min([list_sum(list_transform(range(1, 65), lambda j: (x[j] - c[j]) * (x[j] - c[j])))::BIGINT, cluster::BIGINT]) AS best
          FROM v, c{i} GROUP BY r))""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT cluster, j, sum(y) AS total, count(*) AS n FROM (SELECT cluster, unnest(x) AS y, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY ALL),
m{i} AS (SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY j) AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (cluster)"""


OP12 = _clusters(40, 5)
