"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages
), firsts AS (SELECT payload, min(page_id) AS first_id FROM payloads GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
    list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INTEGER * (16 >> j::INTEGER)))::INTEGER, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM payloads JOIN firsts USING (payload)
"""

#: The dynamic program by recursion over the turns of all conversations, and back over its
#: choices.  Ties of a turn's number, which these tables have none of, would go by content.
OP4 = r"""
WITH RECURSIVE follows(p, q) AS (VALUES (0, 1), (0, 2), (1, 2), (2, 3), (3, 2)),
roles(number, name) AS (VALUES (1, 'system'), (2, 'user'), (3, 'assistant')),
states(p) AS (VALUES (0), (1), (2), (3)),
ways AS (
  SELECT p, q, 0 AS cost, 0 AS kind, 0 AS x FROM follows
  UNION ALL SELECT number, number, 1, 1, 0 FROM roles
  UNION ALL SELECT a.p, b.q, 3, 2, a.q FROM follows a JOIN follows b ON a.q = b.p
), moves AS (
  SELECT r.role, p, q, arg_min({'cost': cost, 'kind': kind, 'x': x}, (cost, kind, x)) AS way,
    min(cost) + CASE WHEN q = r.role THEN 0 ELSE 2 END AS cost
  FROM ways, (SELECT p AS role FROM states) r GROUP BY r.role, p, q
), ends(q, cost) AS (VALUES (1, 6), (2, 3), (3, 0)),
turns AS (
  SELECT conv_id, turn, c.role, coalesce(replace(text, '<|', '< |'), '') AS said, coalesce(number, 0) AS number,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, c.role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations c
  LEFT JOIN roles r ON r.name = lower(regexp_replace(c.role, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'))
), forward AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, 0 AS p FROM turns WHERE i = 1
  UNION ALL
  SELECT conv_id, i, q, best[1], best[2] FROM (
    SELECT f.conv_id, t.i, m.q, min([f.cost + m.cost, f.q]) AS best
    FROM forward f JOIN turns t ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.i = f.i + 1
    JOIN moves m ON m.role = t.number AND m.p = f.q GROUP BY f.conv_id, t.i, m.q
  )
), last AS (
  SELECT f.conv_id, f.i, min([f.cost + e.cost, f.q])[2] AS q
  FROM forward f JOIN ends e USING (q) JOIN turns t ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.i = f.i AND t.i = t.n
  GROUP BY f.conv_id, f.i
), back AS (
  SELECT f.conv_id, f.i, f.p, f.q FROM forward f JOIN last l ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.i = f.i AND l.q = f.q
  UNION ALL
  SELECT f.conv_id, f.i, f.p, f.q FROM back b
  JOIN forward f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1 AND f.q = b.p WHERE f.i > 0
), steps AS (
  SELECT t.*, b.p, b.q, m.way, m.cost, CASE WHEN b.p = 0 THEN '' ELSE E'<|end|>\n' END AS closed, t.i = t.n AND b.q = 3 AS whole
  FROM back b JOIN turns t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i
  JOIN moves m ON m.role = t.number AND m.p = b.p AND m.q = b.q
), told AS (
  SELECT conv_id, NULL AS turn, 4 * (i - 1) AS seq, NULL AS role, way.x AS state, 'insert' AS action, 3 AS cost, closed AS before, '' AS said, '' AS after
  FROM steps WHERE way.x > 0
  UNION ALL
  SELECT conv_id, turn, 4 * (i - 1) + 1, role, q, CASE WHEN way.kind = 1 THEN 'merge' WHEN q != number THEN 'relabel' ELSE 'keep' END,
    cost - CASE WHEN way.x > 0 THEN 3 ELSE 0 END, CASE WHEN way.x > 0 THEN E'<|end|>\n' ELSE closed END, said,
    CASE WHEN whole THEN E'<|end|>\n' ELSE '' END
  FROM steps
  UNION ALL
  SELECT conv_id, NULL, 4 * (i - 1) + number - q + 1, NULL, number, 'insert', 3, E'<|end|>\n', '', CASE WHEN number = 3 THEN E'<|end|>\n' ELSE '' END
  FROM (SELECT conv_id, i, n, q FROM steps) JOIN roles ON number > q WHERE i = n
)
SELECT conv_id, turn::BIGINT AS turn, seq::BIGINT AS seq, role, name AS new_role, action, cost::BIGINT AS cost,
  CASE WHEN action = 'merge' THEN E'\n\n' ELSE before || '<|' || name || E'|>\n' END || said || after AS rendered
FROM told JOIN roles ON number = state
"""

OP6 = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), groups AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM digests JOIN groups USING (text_sha256)
"""


OP8 = r"""
WITH rules(verdict, rule, r_host, r_path) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), after_scheme AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM after_scheme
), fits AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM split JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN fits USING (page_id)
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """One step per round: all squared distances, the nearest entry, the floors of the means."""
    steps = [
        """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
)""",
        f"""pieces AS (
  SELECT vec_id, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS p FROM kept, range({parts}) AS r(part)
)""",
        f"""book0 AS (
  SELECT part, rn - 1 AS entry, p AS e
  FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id, p) AS rn FROM pieces) WHERE rn <= {entries}
)""",
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS (
  SELECT vec_id, part, any_value(p) AS p, min((d, entry)) AS best
  FROM (SELECT vec_id, part, p, entry, list_sum(list_transform(list_zip(p, e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
        FROM pieces JOIN book{k} USING (part)) GROUP BY vec_id, part
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS e FROM (
      SELECT part, best[2] AS entry, place, floor(sum(p[place + 1])::DOUBLE / count(*))::BIGINT AS mean
      FROM near{k}, range((SELECT max(len(p)) FROM pieces)) AS r(place) GROUP BY ALL
    ) GROUP BY part, entry
  ) m USING (part, entry)
)""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id
),
labelled AS (SELECT coded.*, label FROM coded JOIN kept USING (vec_id))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM labelled
"""


OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
      lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words FROM documents
), words AS (SELECT id, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(w.id) AS n
           FROM groups JOIN kept USING (lang) LEFT JOIN words w USING (lang, source, term) GROUP BY ALL),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5) // (sum(n) OVER w + 5 * count(*) OVER w))::BIGINT AS p
  FROM counts WINDOW w AS (PARTITION BY lang, source)
),
language AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5) // (sum(n) OVER w + 5 * count(*) OVER w))::BIGINT AS p
  FROM kept WINDOW w AS (PARTITION BY lang)
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term)
              WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, s.p - l.p AS value
  FROM shares s JOIN language l USING (lang, term) WHERE s.n > 0 AND s.p > l.p
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": OP2,
        "op4_role_repair": OP4,
        "op6_exact_dedup": OP6,
        "op8_url_rules": OP8,
        "op11_vector_codes": _op11(),
        "op13_source_divergence": OP13,
    }
