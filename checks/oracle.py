"""The registered queries as SQL for DuckDB, written independently of the Spark side.

Words are cleaned one by one instead of as a whole text, letters are classified one
after the other instead of by patterns, and quantiles are DuckDB's.  The density is binned
as on the Spark side, since that is part of its definition here; the tests hold it against
a direct sum.  Only fixed values are shared.
"""

from __future__ import annotations

from bandlex.functions.stem import DROPPED_SUFFIXES, LONG_SUFFIXES, SHORT_SUFFIXES
from checks.queries import N_DOCS_SAID, STEPS, STOPWORDS, TOP_BAND, TOP_N


def _ctes(*steps: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n"


# --- words ------------------------------------------------------------------------------

_PIECES = """
pieces AS (
  SELECT doc_id, source, unnest(range(len(p))) AS pos, unnest(p) AS piece
  FROM (SELECT doc_id, source, string_split_regex(text, '[ \\t\\r\\n-]') AS p FROM documents)
)"""
_TOKENS = """
tokens AS (
  SELECT * FROM (
    SELECT doc_id, source, pos, regexp_replace(lower(piece), '[^a-z]', '', 'g') AS token FROM pieces
  ) WHERE length(token) > 2
)"""
_STOPPED = f"""
words AS (
  SELECT * FROM tokens WHERE token NOT IN ({", ".join(f"'{w}'" for w in STOPWORDS)})
)"""

# --- stems ------------------------------------------------------------------------------


def _shape(word: str) -> str:
    """v and c per letter, read from left to right."""
    return f"""list_reduce(list_prepend('', string_split({word}, '')), lambda seen, ch: seen || CASE
        WHEN ch IN ('a', 'e', 'i', 'o', 'u') THEN 'v'
        WHEN ch = 'y' AND right(seen, 1) = 'c' THEN 'v'
        ELSE 'c' END)"""


def _with_shape(name: str, source: str, word: str) -> str:
    return f"""
{name} AS (
  SELECT token, w, {_shape("w")} AS sh, length(w) AS n FROM (SELECT token, {word} AS w FROM {source})
)"""


def _cvc(word: str, shape: str) -> str:
    return f"(right({shape}, 3) = 'cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y'))"


def _m1(shape: str) -> str:
    return f"({shape} LIKE '%vc%' AND {shape} NOT LIKE '%vc%vc%')"


def _replacing(rules: dict[str, str]) -> str:
    whens = "\n".join(
        f"    WHEN suffix(w, '{old}') THEN CASE WHEN left(sh, n - {len(old)}) LIKE '%vc%' "
        f"THEN left(w, n - {len(old)}) || '{new}' ELSE w END"
        for old, new in rules.items()
    )
    return f"CASE\n{whens}\n    ELSE w END"


def _dropping() -> str:
    whens = []
    for old in DROPPED_SUFFIXES:
        size = 3 if old in ("sion", "tion") else len(old)
        whens.append(
            f"    WHEN suffix(w, '{old}') THEN "
            f"CASE WHEN left(sh, n - {size}) LIKE '%vc%vc%' THEN left(w, n - {size}) ELSE w END"
        )
    return "CASE\n" + "\n".join(whens) + "\n    ELSE w END"


def _stems(source: str) -> str:
    """Steps from a table with ``token`` to the table ``stems`` with ``token, term``."""
    plural = """CASE WHEN suffix(w, 'sses') THEN left(w, n - 2) WHEN suffix(w, 'ies') THEN left(w, n - 2)
    WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN left(w, n - 1) ELSE w END"""
    past = """CASE WHEN suffix(w, 'eed') THEN CASE WHEN left(sh, n - 3) LIKE '%vc%' THEN left(w, n - 1) ELSE w END
    WHEN suffix(w, 'ed') AND left(sh, n - 2) LIKE '%v%' THEN left(w, n - 2) || '#'
    WHEN suffix(w, 'ing') AND left(sh, n - 3) LIKE '%v%' THEN left(w, n - 3) || '#' ELSE w END"""
    # the mark # says that an ending was removed; it is taken off again before the next shape
    mended = f"""CASE WHEN NOT cut THEN w
    WHEN suffix(w, 'at') OR suffix(w, 'bl') OR suffix(w, 'iz') THEN w || 'e'
    WHEN n > 1 AND right(w, 1) = left(right(w, 2), 1) AND right(sh, 1) = 'c'
      THEN CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE left(w, n - 1) END
    WHEN {_m1("sh")} AND {_cvc("w", "sh")} THEN w || 'e' ELSE w END"""
    final_y = "CASE WHEN suffix(w, 'y') AND left(sh, n - 1) LIKE '%v%' THEN left(w, n - 1) || 'i' ELSE w END"
    final_e = f"""CASE WHEN suffix(w, 'e') AND (sh LIKE '%vc%vc%'
      OR ({_m1("sh")} AND NOT {_cvc("left(w, n - 1)", "left(sh, n - 1)")})) THEN left(w, n - 1) ELSE w END"""
    final_l = "CASE WHEN suffix(w, 'll') AND sh LIKE '%vc%vc%' THEN left(w, n - 1) ELSE w END"
    return ",".join(
        [
            _with_shape("stem0", f"(SELECT DISTINCT token FROM {source})", "token"),
            _with_shape("stem1", "stem0", plural),
            f"\nstem2 AS (SELECT token, {past} AS marked FROM stem1)",
            f"""
stem3 AS (
  SELECT token, w, cut, {_shape("w")} AS sh, length(w) AS n
  FROM (SELECT token, rtrim(marked, '#') AS w, suffix(marked, '#') AS cut FROM stem2)
)""",
            _with_shape("stem4", "stem3", mended),
            _with_shape("stem5", "stem4", final_y),
            _with_shape("stem6", "stem5", _replacing(LONG_SUFFIXES)),
            _with_shape("stem7", "stem6", _replacing(SHORT_SUFFIXES)),
            _with_shape("stem8", "stem7", _dropping()),
            _with_shape("stem9", "stem8", final_e),
            f"\nstems AS (SELECT token, {final_l} AS term FROM stem9)",
        ]
    )


_STEMMED = _stems("words")
_WORD_STEPS = (_PIECES, _TOKENS, _STOPPED, _STEMMED)
_OCCURRENCES = """
occurrences AS (SELECT doc_id, source, pos, token, term FROM words JOIN stems USING (token))"""
_TOTAL = "(SELECT count(*) FROM documents)"


def _idf(n: str, d: str, below: str) -> str:
    return f"CASE WHEN {n} - {d} + 0.5 > 0 THEN log10(({n} - {d} + 0.5) / ({below} + 0.5)) ELSE 'NaN'::DOUBLE END"


# --- density ----------------------------------------------------------------------------


def _density(values: str) -> str:
    """Steps from a subquery with ``v`` to the table ``curve``."""
    return f"""
vals AS (SELECT v::DOUBLE AS v FROM ({values})),
spread AS (
  SELECT count(*) AS n, min(v) AS least, max(v) AS most, stddev_samp(v) AS sd,
         quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM vals
),
width AS (
  SELECT *, 0.9 * coalesce(nullif(least(sd, iqr / 1.34), 0), nullif(sd, 0), nullif(abs(least), 0), 1)
            * n ** -0.2 AS bw FROM spread
),
grid AS (
  SELECT *, least - 7 * bw AS lo, (most - least + 14 * bw) / 511 AS delta,
         least - 3 * bw AS x0, (most - least + 6 * bw) / 511 AS dx FROM width
),
placed AS (SELECT floor((v - lo) / delta) AS bin, (v - lo) / delta - floor((v - lo) / delta) AS part FROM vals, grid),
bins AS (
  SELECT bin, sum(w) AS w FROM (
    SELECT bin, 1 - part AS w FROM placed UNION ALL SELECT bin + 1, part FROM placed
  ) GROUP BY bin
),
kernel AS (
  SELECT g.i, sum(w * exp(-0.5 * ((g.i - bin) * delta / bw) ** 2)) / any_value(n * bw * sqrt(2 * pi())) AS y
  FROM range(512) AS g(i), bins, grid GROUP BY g.i
),
points AS (SELECT i, x0 + i * dx AS x, dx, (x0 + i * dx - lo) / delta AS place FROM range(512) AS g(i), grid),
heights AS (
  SELECT p.i, x, dx, a.y + (place - floor(place)) * (b.y - a.y) AS density
  FROM points p JOIN kernel a ON a.i = floor(place) JOIN kernel b ON b.i = floor(place) + 1
),
curve AS (
  SELECT i, x, dx, density, sum(area) OVER (ORDER BY x) AS cdf FROM (
    SELECT *, coalesce((density + lag(density) OVER (ORDER BY x)) / 2 * dx, 0) AS area FROM heights
  )
)"""


_THIRDS = """
lower_cut AS (SELECT min(x) AS lower FROM candidates WHERE cdf - (SELECT min(cdf) FROM candidates) > 1.0 / 3.0),
thirds AS (
  SELECT lower, (SELECT min(x) FROM candidates WHERE cdf - (SELECT min(cdf) FROM candidates WHERE x >= lower) > 1.0 / 3.0
  ) AS upper FROM lower_cut
)"""
_ON_CURVE = "\ncandidates AS (SELECT x, cdf FROM curve)"
_ON_STEPS = f"""
steps AS (SELECT {STEPS["lo"]}::DOUBLE + k * {STEPS["step"]}::DOUBLE AS x
          FROM range({int((STEPS["hi"] - STEPS["lo"]) / STEPS["step"]) + 1}) AS r(k)),
candidates AS (
  SELECT s.x, CASE
    WHEN s.x < (SELECT min(x) FROM curve)
      THEN (s.x - (SELECT min(x) FROM curve)) * (SELECT arg_min(density, x) FROM curve)
    WHEN b.i IS NULL THEN a.cdf + (s.x - a.x) * a.density
    ELSE a.cdf + (s.x - a.x) * (a.density + (s.x - a.x) / (b.x - a.x) * (b.density - a.density) / 2) END AS cdf
  FROM steps s
  ASOF LEFT JOIN curve a ON s.x >= a.x
  LEFT JOIN curve b ON b.i = a.i + 1
)"""
_SUPPLIER_CURVE = _density("SELECT s_acctbal AS v FROM supplier")

# --- bands ------------------------------------------------------------------------------

_SCORES = "\nscores AS (SELECT source, avg(n_chars) AS score FROM documents GROUP BY source)"
_BANDS = """
banded AS (
  SELECT source, score, CASE WHEN score < lower THEN 'LOW' WHEN score < upper THEN 'MID' ELSE 'HIGH' END AS band
  FROM scores, thirds
)"""
_BAND_STEPS = (_SCORES, _density("SELECT score AS v FROM scores"), _ON_CURVE, _THIRDS, _BANDS)
_BY_BAND = f"""
per_term AS (
  SELECT band, term, count(DISTINCT doc_id) AS df FROM occurrences JOIN banded USING (source) GROUP BY band, term
),
form_first AS (
  SELECT band, term, token, min((doc_id, pos)) AS place FROM occurrences JOIN banded USING (source)
  GROUP BY band, term, token
),
form_lists AS (SELECT band, term, string_agg(token, ' ' ORDER BY place) AS forms FROM form_first GROUP BY band, term),
idf_table AS (
  SELECT band, term, df, {_idf(_TOTAL, "df", _TOTAL)} AS idf, forms FROM per_term JOIN form_lists USING (band, term)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY idf, term) AS rk FROM idf_table),
top_terms AS (SELECT * FROM ranked WHERE rk <= 200),
distinctive AS (SELECT * FROM top_terms WHERE term IN (SELECT term FROM top_terms GROUP BY term HAVING count(*) = 1))"""
_LATER_FORMS = """
in_band AS (
  SELECT band, term, token, doc_id, pos, min(doc_id) OVER (PARTITION BY band, term) AS first_doc
  FROM occurrences JOIN banded USING (source)
),
later_first AS (
  SELECT band, term, token, min((doc_id, pos)) FILTER (doc_id > first_doc) AS place FROM in_band GROUP BY band, term, token
),
later AS (
  SELECT band, term, coalesce(string_agg(token, ' ' ORDER BY place) FILTER (place IS NOT NULL), '') AS forms
  FROM later_first GROUP BY band, term
)"""
_ALL = _ctes(*_WORD_STEPS, _OCCURRENCES, *_BAND_STEPS, _BY_BAND)
_WORDS = _ctes(*_WORD_STEPS, _OCCURRENCES)

# --- another analyser ---------------------------------------------------------------------

_LETTER_STEPS = (
    """
pieces AS (
  SELECT doc_id, source, unnest(range(len(p))) AS pos, unnest(p) AS piece
  FROM (SELECT doc_id, source, string_split(regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g'), ' ') AS p FROM documents)
),
tokens AS (SELECT doc_id, source, pos, piece AS token FROM pieces WHERE length(piece) >= 2)""",
    _STOPPED,
    "\nstems AS (SELECT DISTINCT token, token AS term FROM words)",
)

# --- phrases ------------------------------------------------------------------------------


def _cell(n: str, row: str, column: str) -> str:
    return f"CASE WHEN {n} > 0 THEN ({n}) * ln(({n}) / ({row}) * (total / ({column}))) ELSE 0 END"


_SCORE = " + ".join(
    (
        _cell("n", "n_first", "n_second"),
        _cell("n_first - n", "n_first", "total - n_second"),
        _cell("n_second - n", "total - n_first", "n_second"),
        _cell("total - n_first - n_second + n", "total - n_first", "total - n_second"),
    )
)
_PHRASES = f"""
pairs AS (
  SELECT a.doc_id, a.pos, a.term AS first, b.term AS second
  FROM occurrences a JOIN occurrences b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
),
counted AS (SELECT first, second, count(*) AS n FROM pairs GROUP BY first, second),
tabled AS (
  SELECT *, sum(n) OVER (PARTITION BY first)::BIGINT AS n_first, sum(n) OVER (PARTITION BY second)::BIGINT AS n_second,
         sum(n) OVER ()::BIGINT AS total FROM counted
),
phrases AS (
  SELECT first, second, n, 2 * ({_SCORE}) AS score
  FROM tabled WHERE n >= 5 AND n * total > n_first * n_second
),
places AS (
  SELECT doc_id, pos, first, second, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM pairs JOIN phrases USING (first, second) WHERE score >= 10.828
),
taken AS (
  SELECT first, second, count(*) AS taken
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS nth FROM places)
  WHERE nth % 2 = 1 GROUP BY first, second
)"""
_SHOW_PHRASES = """SELECT first, second, n, round(score, 4) AS score, coalesce(taken, 0) AS taken
FROM phrases LEFT JOIN taken USING (first, second) WHERE score >= 10.828"""

# --- term ids -----------------------------------------------------------------------------

_TERM_IDS = """
halves AS (SELECT token, term, min(doc_id % 2) AS half FROM occurrences GROUP BY token, term),
term_halves AS (SELECT term, min(half) AS half FROM halves GROUP BY term),
token_numbers AS (SELECT token, row_number() OVER (ORDER BY half, token) - 1 AS token_id FROM halves),
term_numbers AS (SELECT term, row_number() OVER (ORDER BY half, term) - 1 AS term_id FROM term_halves)"""

# --- suspects -----------------------------------------------------------------------------

_SUSPECTS = f"""
suspects AS (
  SELECT 'unscored' AS cause, doc_id::VARCHAR AS key, source AS detail FROM documents WHERE source LIKE '%1%'
  UNION ALL
  SELECT 'bad line', md5(line), left(line, 80) FROM (
    SELECT CASE lang WHEN 'de' THEN doc_id || ' ' || text ELSE 'x' || doc_id || chr(9) || text END AS line
    FROM documents WHERE lang IN ('de', 'fr'))
  UNION ALL
  SELECT 'undefined idf', band || ' ' || term, 'df ' || df FROM per_term WHERE df > {N_DOCS_SAID}
),
hashed AS (SELECT DISTINCT *, md5(concat_ws(chr(31), '42', cause, key)) AS priority FROM suspects)"""

# --- bootstrap ----------------------------------------------------------------------------


def _uniform(name: str) -> str:
    return f"((('0x' || left(md5('42 {name} ' || b || ' ' || cell), 13))::BIGINT + 0.5) / 16::DOUBLE ** 13)"


_BOOTSTRAP = f"""
cells AS (
  SELECT floor((v - lo) / delta)::BIGINT AS cell, count(*) AS n, sum((v - lo) / delta - floor((v - lo) / delta)) AS part
  FROM vals, grid GROUP BY 1
),
chances AS (
  SELECT n, k, sum(exp(k * ln(n) - n - lgamma(k + 1))) OVER (PARTITION BY n ORDER BY k) AS below
  FROM (SELECT DISTINCT n FROM cells WHERE n <= 64), range(200) AS r(k)
),
uniforms AS (SELECT cell, n, part, b, {_uniform("a")} AS u, {_uniform("b")} AS v FROM cells, range(1, 201) AS r(b)),
drawn AS (
  SELECT cell, n, part, b, coalesce(sum((below < u)::INT), any_value(
    greatest(floor(n + sqrt(n) * sqrt(-2 * ln(u)) * cos(2 * pi() * v) + 0.5), 0)))::DOUBLE AS w
  FROM uniforms LEFT JOIN chances USING (n) GROUP BY cell, n, part, b
  UNION ALL SELECT cell, n, part, 0, n FROM cells
),
weights AS (
  SELECT b, bin, sum(w) AS w FROM (
    SELECT b, cell AS bin, (n - part) * w / n AS w FROM drawn UNION ALL SELECT b, cell + 1, part * w / n FROM drawn
  ) GROUP BY b, bin
),
reach AS (SELECT i, x, points.dx, place, floor(place) AS below, place - floor(place) AS rest, delta, bw FROM points, grid),
tops AS (
  SELECT b, i, any_value(x) AS x, any_value(dx) AS dx,
    sum(w * ((1 - rest) * exp(-0.5 * ((below - bin) * delta / bw) ** 2) + rest * exp(-0.5 * ((below + 1 - bin) * delta / bw) ** 2)))
      / any_value(bw * sqrt(2 * pi())) AS y
  FROM weights, reach WHERE w > 0 GROUP BY b, i
),
totals AS (SELECT b, sum(w) AS whole FROM weights GROUP BY b),
areas AS (
  SELECT b, i, x, coalesce((y + lag(y) OVER (PARTITION BY b ORDER BY i)) / 2 * dx, 0) / whole AS area FROM tops JOIN totals USING (b)
),
curves AS (SELECT b, x, sum(area) OVER (PARTITION BY b ORDER BY i) AS cdf FROM areas),
lowers AS (SELECT b, min(x) AS lower, min(cdf) AS reached FROM curves WHERE cdf > 1.0 / 3.0 GROUP BY b),
cuts AS (SELECT b, lower, (SELECT min(x) FROM curves c WHERE c.b = l.b AND cdf - reached > 1.0 / 3.0) AS upper FROM lowers l),
ends AS (SELECT b, 'lower' AS cut, lower AS x FROM cuts UNION ALL SELECT b, 'upper', upper FROM cuts)"""


# --- score lines ------------------------------------------------------------------------


def _score_lines(name: str) -> str:
    return f"""
lines AS (
  SELECT c_custkey AS line_no, '"' || {name} || ' (X YY)",'
    || CASE WHEN c_nationkey = 3 THEN 'unknown' ELSE '  ' || c_acctbal::DECIMAL(12,2)::VARCHAR || ' ' END
    || CASE WHEN c_nationkey = 7 THEN '' ELSE ',0.1' END AS line
  FROM customer
),
fields AS (SELECT line_no, string_split(line, ',') AS f FROM lines),
parsed AS (
  SELECT line_no, substr(string_split(trim(f[1]), ' ')[1], 2) AS author, TRY_CAST(trim(f[2]) AS DOUBLE) AS score
  FROM fields WHERE len(f) > 2 AND TRY_CAST(trim(f[2]) AS DOUBLE) IS NOT NULL
)"""


_LINE_BY_LINE = """
WITH blank AS (SELECT string_agg(chr(c::INTEGER), '') AS chars FROM range(1, 33) AS r(c)),
lines AS (
  SELECT doc_id, unnest(range(len(l))) AS nth, unnest(l) AS line
  FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS l FROM documents)
)
SELECT doc_id, trim(string_agg(
  trim(regexp_replace(line, '[ \\t\\x0B\\f\\r]+', ' ', 'g'), chars), ' ' ORDER BY nth), any_value(chars)) AS text_norm
FROM lines, blank GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    letters = _ctes(*_LETTER_STEPS, _OCCURRENCES, *_BAND_STEPS, _BY_BAND)
    return {
        "phrases": _ctes(*_WORD_STEPS, _OCCURRENCES, _PHRASES) + _SHOW_PHRASES,
        "phrases_letters": _ctes(*_LETTER_STEPS, _OCCURRENCES, _PHRASES) + _SHOW_PHRASES,
        "idf_letters": letters + "SELECT band, term, df, round(idf, 9) AS idf, forms FROM idf_table",
        "term_ids": _ctes(*_WORD_STEPS, _OCCURRENCES, _TERM_IDS)
        + "SELECT term, term_id, token, token_id FROM halves JOIN token_numbers USING (token) JOIN term_numbers USING (term)",
        "document_frequency_by_ids": _ALL + "SELECT band, term, df FROM per_term",
        "suspect_sample": _ctes(*_WORD_STEPS, _OCCURRENCES, *_BAND_STEPS, _BY_BAND, _SUSPECTS)
        + """SELECT cause, key, detail, priority FROM hashed
QUALIFY row_number() OVER (PARTITION BY cause ORDER BY priority, key, detail) <= 20""",
        "cut_stability": _ctes(_SUPPLIER_CURVE, _BOOTSTRAP)
        + """SELECT cut, round(max(x) FILTER (b = 0), 6) AS value, round(quantile_cont(x, 0.025) FILTER (b > 0), 6) AS low,
  round(quantile_cont(x, 0.975) FILTER (b > 0), 6) AS high, round(avg(x) FILTER (b > 0), 6) AS mean,
  round(stddev_samp(x) FILTER (b > 0), 6) AS sd, count(*) FILTER (b > 0 AND x IS NULL) AS undefined FROM ends GROUP BY cut""",
        "idf_incremental": _ALL + "SELECT band, term, df, round(idf, 9) AS idf, forms FROM idf_table",
        "normalize_text": _LINE_BY_LINE,
        "corpus_line_parse": """
SELECT CASE WHEN lang IN ('de', 'fr') THEN NULL ELSE doc_id END AS doc_id,
  CASE lang WHEN 'de' THEN doc_id || ' ' || text WHEN 'fr' THEN 'x' || doc_id || chr(9) || text
    ELSE regexp_replace(text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') END AS text
FROM documents""",
        "name_key_extract": """
SELECT p_partkey, upper(string_split(p_name, ' ')[2]) AS name_key FROM part""",
        "score_parse": _ctes(_score_lines("c_name")) + "SELECT author, score FROM parsed",
        "score_last_wins": _ctes(_score_lines("c_mktsegment || c_nationkey"))
        + "SELECT author, arg_max(score, line_no) AS score FROM parsed GROUP BY author",
        "tokenize": _ctes(_PIECES, _TOKENS) + "SELECT doc_id, pos, token FROM tokens",
        "stopword_filter": _ctes(_PIECES, _TOKENS, _STOPPED) + "SELECT doc_id, pos, token FROM words",
        "stopword_anti_join": _ctes(_PIECES, _TOKENS)
        + f"""SELECT doc_id, pos, token FROM tokens ANTI JOIN
(SELECT unnest([{", ".join(f"'{w}'" for w in STOPWORDS)}]) AS token) USING (token)""",
        "stem_vocabulary": _ctes(_PIECES, _TOKENS, _stems("tokens")) + "SELECT token, term FROM stems",
        "doc_term_forms": _WORDS + "SELECT DISTINCT doc_id, term, token FROM occurrences",
        "document_frequency": _WORDS + "SELECT term, count(DISTINCT doc_id) AS df FROM occurrences GROUP BY term",
        "term_forms": _WORDS
        + """SELECT term, string_agg(token, ' ' ORDER BY place) AS forms
FROM (SELECT term, token, min((doc_id, pos)) AS place FROM occurrences GROUP BY term, token) GROUP BY term""",
        "term_forms_skip_first_doc": _WORDS
        + """SELECT term, coalesce(string_agg(token, ' ' ORDER BY place), '') AS forms
FROM (
  SELECT term, token, min((doc_id, pos)) FILTER (doc_id > first_doc) AS place
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY term) AS first_doc FROM occurrences) GROUP BY term, token
) GROUP BY term""".replace("string_agg(token, ' ' ORDER BY place)", "string_agg(token, ' ' ORDER BY place) FILTER (place IS NOT NULL)"),
        "idf": _WORDS
        + f"""SELECT term, df, round({_idf(_TOTAL, "df", _TOTAL)}, 9) AS idf
FROM (SELECT term, count(DISTINCT doc_id) AS df FROM occurrences GROUP BY term)""",
        "idf_bm25": _WORDS
        + f"""SELECT term, df, round({_idf(_TOTAL, "df", "df")}, 9) AS idf
FROM (SELECT term, count(DISTINCT doc_id) AS df FROM occurrences GROUP BY term)""",
        "score_density": _ctes(_SUPPLIER_CURVE)
        + "SELECT round(x, 6) AS x, round(density, 12) AS density, round(cdf, 9) AS cdf FROM curve",
        "density_thirds": _ctes(_SUPPLIER_CURVE, _ON_CURVE, _THIRDS)
        + "SELECT round(lower, 6) AS lower, round(upper, 6) AS upper FROM thirds",
        "density_thirds_stepped": _ctes(_SUPPLIER_CURVE, _ON_STEPS, _THIRDS)
        + "SELECT round(lower, 6) AS lower, round(upper, 6) AS upper FROM thirds",
        "score_band": _ctes(*_BAND_STEPS) + "SELECT source, round(score, 6) AS score, band FROM banded",
        "band_sizes": _ctes(*_BAND_STEPS)
        + "SELECT band, count(*) AS n FROM documents JOIN banded USING (source) GROUP BY band",
        "banded_corpus": _ctes(*_BAND_STEPS) + "SELECT doc_id, band FROM documents JOIN banded USING (source)",
        "idf_by_band": _ALL + "SELECT band, term, df, round(idf, 9) AS idf, forms FROM idf_table",
        "idf_by_band_drop_last_term": _ALL
        + """SELECT band, term, df, round(idf, 9) AS idf FROM idf_table
WHERE (band, term) NOT IN (SELECT (band, max(term)) FROM idf_table GROUP BY band)""",
        "idf_by_band_skip_first_doc": _ctes(*_WORD_STEPS, _OCCURRENCES, *_BAND_STEPS, _BY_BAND, _LATER_FORMS)
        + """SELECT band, term, df, round(idf, 9) AS idf, later.forms FROM idf_table JOIN later USING (band, term)""",
        "idf_report": _ALL
        + "SELECT band, printf('%.9f', idf) || chr(9) || term || chr(9) || forms AS line FROM idf_table ORDER BY band, idf, term",
        "topk_terms": _ALL + "SELECT band, rk, term, round(idf, 9) AS idf FROM top_terms",
        "distinctive_terms": _ALL + "SELECT band, term, round(idf, 9) AS idf, forms FROM distinctive ORDER BY term",
        "top_words": _ALL
        + f"""SELECT word, round(idf, 9) AS idf
FROM (SELECT string_split(forms, ' ')[1] AS word, idf FROM distinctive WHERE band = '{TOP_BAND}')
ORDER BY idf DESC, word DESC LIMIT {TOP_N}""",
    }
