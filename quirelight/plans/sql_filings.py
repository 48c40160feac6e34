"""DuckDB SQL of court papers: their spans, numbered margins, captions and roles."""

from quirelight.operators import pleading as P
from quirelight.operators import roles as R
from quirelight.sources import filings as G


def capital(words: str) -> str:
    return f"array_to_string(list_transform({words}, lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


_WORDS = r"regexp_extract_all(coalesce(max(CASE WHEN turn = {0} THEN text END), ''), '[A-Za-z]\p{{L}}+')".format
_HEAD = (
    (0, "conv_id % 4 <> 3", "[" + ", ".join(f"'{c}'" for c in G.COURTS) + "][conv_id % 3 + 1]", 220, 0, 14, "true"),
    (1, "conv_id % 4 = 3 AND len(a) >= 3", f"{capital('a[3:3]')} || ' Corporation'", 220, 0, 16, "true"),
    (2, "parties AND conv_id % 3 = 0", "one || ' v. ' || other", G.LEFT, 2, 12, "true"),
    (3, "parties AND conv_id % 3 = 1", "one || ' vs.'", G.LEFT, 2, 12, "true"),
    (4, "parties AND conv_id % 3 = 1", "other", G.LEFT, 3, 12, "false"),
    (5, "parties AND conv_id % 3 = 2", "one", G.LEFT, 2, 12, "true"),
    (6, "parties AND conv_id % 3 = 2", "'v.'", G.LEFT, 3, 12, "false"),
    (7, "parties AND conv_id % 3 = 2", "other", G.LEFT, 4, 12, "true"),
    (8, "conv_id % 7 = 0", "'12 v 14 of the lines'", G.LEFT, 5, 12, "false"),
    (9, "true", "'Case No. CV-' || (conv_id + 1000)", G.RIGHT, 2, 10, "false"),
    (10, "true", f"strftime(DATE '{G.FIRST_DAY}' + CAST(conv_id % 3650 AS INTEGER), '%B %-d, %Y')", G.RIGHT, 3, 11, "false"),
    (11, "conv_id % 5 = 0", "'Exhibit ' || chr(CAST(65 + conv_id % 26 AS INTEGER))", G.RIGHT, 4, 12, "true"),
    (12, "len(a) >= 6", f"'Motion For ' || {capital('a[3:6]')}", G.LEFT, 7, 20, "false"),
    (13, "true", f"'Page 1 of ' || (1 + CAST(ceil(n / {G.TURNS_A_PAGE}) AS BIGINT))", 280, 29, 8, "false"),
)
_PIECES = " UNION ALL ".join(f"SELECT conv_id, {k} AS k, {text} AS text, {x}::DOUBLE AS x, {G.TOP + G.PITCH * row}::DOUBLE AS y, {size}::DOUBLE AS font_size, {bold} AS bold FROM papers WHERE {when}" for k, when, text, x, row, size, bold in _HEAD)
FILINGS = rf"""
turns AS (SELECT conv_id, turn, coalesce(min(text), '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
word_papers AS (SELECT conv_id, {_WORDS(0)} AS a, {_WORDS(1)} AS b, count(*) AS n FROM turns GROUP BY conv_id),
papers AS (SELECT *, length(one) > 1 AND length(other) > 1 AS parties FROM (SELECT *, {capital("a[1:2]")} AS one, {capital("b[1:2]")} AS other FROM word_papers)),
pieces AS ({_PIECES} UNION ALL SELECT conv_id, 100 + k, CAST(k AS VARCHAR), {G.MARGIN}, {G.TOP} + {G.PITCH} * (k - 1), 10, false FROM papers, range(1, 29) r(k) WHERE conv_id % 2 = 0 OR k <= 12),
filing_spans AS (
  SELECT document_id, page, ord, text, x, y, least(length(text) * font_size * 0.5, 468)::DOUBLE AS width, font_size AS height, font_size, bold, 612.0::DOUBLE AS page_width, 792.0::DOUBLE AS page_height FROM (
    SELECT CAST(conv_id AS VARCHAR) AS document_id, 1 AS page, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS INTEGER) AS ord, text, x, y, font_size, bold FROM pieces
    UNION ALL
    SELECT CAST(conv_id AS VARCHAR), CAST(2 + turn // {G.TURNS_A_PAGE} AS INTEGER), CAST(1000 + turn AS INTEGER), trim(regexp_replace(text, '\s+', ' ', 'g')), 72, {G.TOP} + {G.TURN_PITCH} * (turn % {G.TURNS_A_PAGE}), 10 + 2 * (turn % 5), false FROM turns)
  WHERE text <> '')"""
#: Offsets are told apart by the heights of numbers less those of a first number that they would belong to.
NUMBERED = f"""
margin_numbers AS (SELECT document_id, page, ord, y, CAST(text AS INTEGER) AS value FROM filing_spans WHERE regexp_matches(text, '^[0-9]{{1,2}}$') AND x < page_width * {P.MARGIN} AND CAST(text AS INTEGER) BETWEEN 1 AND {P.LARGEST}),
number_steps AS (SELECT *, CASE WHEN lead(value) OVER w = value + 1 THEN lead(y) OVER w - y END AS step FROM margin_numbers WINDOW w AS (PARTITION BY document_id, page ORDER BY y, ord)),
number_pitch AS (SELECT document_id, page, median(step) AS pitch FROM number_steps GROUP BY document_id, page HAVING median(step) > 0),
number_runs AS (
  SELECT a.document_id, a.page, a.ord AS head, pitch, list(b.ord) AS ords, count(DISTINCT b.value) AS numbers, min(b.value) AS first, max(b.value) AS last
  FROM margin_numbers a JOIN margin_numbers b ON b.document_id = a.document_id AND b.page = a.page JOIN number_pitch p ON p.document_id = a.document_id AND p.page = a.page
  WHERE abs((b.y - b.value * pitch) - (a.y - a.value * pitch)) <= pitch / 4 GROUP BY a.document_id, a.page, a.ord, pitch HAVING count(DISTINCT b.value) >= {P.LEAST_NUMBERS}),
line_runs AS (SELECT * FROM number_runs QUALIFY row_number() OVER (PARTITION BY document_id, page ORDER BY numbers DESC, head) = 1),
spans AS (SELECT * FROM filing_spans s WHERE NOT EXISTS (SELECT 1 FROM line_runs r WHERE r.document_id = s.document_id AND r.page = s.page AND list_contains(r.ords, s.ord)))"""


def quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


_FULL = quoted(rf"(?:^|\s)({P.PARTY}),?\s+{P.VERSUS}\s+({P.PARTY})")
_WHOLE = lambda p: f"regexp_extract(trim(text), '{quoted(f'^{p}$')}', 1)"
CAPTIONS = rf"""
unit_kinds AS (
  SELECT document_id, page, ord, row_number() OVER (PARTITION BY document_id, page ORDER BY ord) AS k, regexp_extract(trim(text), '{_FULL}', 1) AS one, regexp_extract(trim(text), '{_FULL}', 2) AS other,
    {_WHOLE(rf"({P.PARTY}),?\s+{P.VERSUS}")} AS opens, {_WHOLE(rf"{P.VERSUS}\s+({P.PARTY}),?")} AS closes, {_WHOLE(f"({P.PARTY}),?")} AS party, regexp_matches(trim(text), '^{P.VERSUS}$') AS versus FROM units),
captions AS (
  SELECT document_id, page, ord, ord AS last, one AS plaintiff, other AS defendant FROM unit_kinds WHERE one <> ''
  UNION ALL SELECT u.document_id, u.page, u.ord, v.ord, u.opens, v.party FROM unit_kinds u JOIN unit_kinds v ON v.document_id = u.document_id AND v.page = u.page AND v.k = u.k + 1 WHERE u.one = '' AND u.opens <> '' AND v.party <> ''
  UNION ALL SELECT u.document_id, u.page, u.ord, v.ord, u.party, v.closes FROM unit_kinds u JOIN unit_kinds v ON v.document_id = u.document_id AND v.page = u.page AND v.k = u.k + 1 WHERE u.one = '' AND u.party <> '' AND v.closes <> ''
  UNION ALL SELECT u.document_id, u.page, u.ord, w.ord, u.party, w.party FROM unit_kinds u JOIN unit_kinds v ON v.document_id = u.document_id AND v.page = u.page AND v.k = u.k + 1
    JOIN unit_kinds w ON w.document_id = u.document_id AND w.page = u.page AND w.k = u.k + 2 WHERE u.one = '' AND u.party <> '' AND v.versus AND w.party <> '')"""
_PLACE = f"floor((1 - top_ratio) * {R.ABOVE} + 0.5) - CASE WHEN page > 1 THEN {R.FURTHER} ELSE 0 END"
_SHORT = f"CASE WHEN word_count <= {R.SHORT_WORDS} THEN {R.SHORT} ELSE 0 END"
_MARKS = {
    "case": ("(document_id, ord) IN (SELECT document_id, ord FROM captions)", "0"),
    "court": (f"regexp_matches(text, '{R.COURT}')", "0"),
    "exhibit": (f"regexp_matches(text, '{R.EXHIBIT}')", _SHORT),
    "date": ("date", _SHORT),
    "identifier": ("identifier", _SHORT),
    "source": (f"regexp_matches(text, '{R.SOURCE}')", "0"),
}
_EACH = " UNION ALL ".join([f"SELECT document_id, page, y, x, ord, '{r}' AS role, CAST({R.MARK} + {extra} + {_PLACE} AS INTEGER) AS score FROM scores WHERE {when}" for r, (when, extra) in _MARKS.items()] + ["SELECT document_id, page, y, x, ord, 'title', CAST(floor(score * 10000 + 0.5) AS INTEGER) FROM scores WHERE score IS NOT NULL"])
_ORDER = [f"o_{r}.place" for r in R.ROLES]
#: Every assignment: a unit or none for each role, no unit twice.
ROLES = (
    f"""
role_scores AS (SELECT * FROM ({_EACH}) WHERE score > 0),
role_options AS (SELECT *, dense_rank() OVER (PARTITION BY document_id ORDER BY page, y, x, ord) AS place FROM role_scores QUALIFY row_number() OVER (PARTITION BY document_id, role ORDER BY score DESC, page, y, x, ord) <= {len(R.ROLES)}),
"""
    + ",\n".join(f"{r}_options AS (SELECT document_id, ord, place, score FROM role_options WHERE role = '{r}' UNION ALL SELECT DISTINCT document_id, NULL, 1000000 + {k}, 0 FROM role_options)" for k, r in enumerate(R.ROLES))
    + f""",
assignments AS (
  SELECT o.document_id, {", ".join(f"o_{r}.ord AS {r}_ord, o_{r}.score AS {r}_score" for r in R.ROLES)} FROM (SELECT DISTINCT document_id FROM role_options) o
  {" ".join(f"JOIN {r}_options o_{r} ON o_{r}.document_id = o.document_id" + (f" AND o_{r}.place NOT IN ({', '.join(_ORDER[:k])})" if k else "") for k, r in enumerate(R.ROLES))}
  QUALIFY row_number() OVER (PARTITION BY o.document_id ORDER BY {" + ".join(f"o_{r}.score" for r in R.ROLES)} DESC, {", ".join(_ORDER)}) = 1),
roles AS ({" UNION ALL ".join(f"SELECT document_id, '{r}' AS role, {r}_ord AS ord, {r}_score AS score FROM assignments WHERE {r}_ord IS NOT NULL" for r in R.ROLES)})"""
)
