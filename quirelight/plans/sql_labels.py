"""DuckDB SQL of features, titles, phrases and labels, as chains of common tables."""

from quirelight import contracts
from quirelight.sources import html

C = contracts.load("identity")


def listed(*names: str) -> str:
    return "[" + ", ".join(f"'{w}'" for n in names for w in C[n]) + "]"


def r4(x: str) -> str:
    return f"(sign({x}) * floor(abs({x}) * 10000 + 0.5) / 10000)"


def unescaped(x: str) -> str:
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{sign}')"
    return x


def _names(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _last(names) -> str:
    """The place of the last of some elements in the stack; 0 if none is open."""
    return f"coalesce(list_max(list_transform(range(1, len(stack) + 1), lambda i: CASE WHEN stack[i] IN {_names(names)} THEN i ELSE 0 END)), 0)"


def _without(names, within) -> str:
    """The stack that is left when the last of some elements ends."""
    inner = _last(within) if within else "0"
    return f"CASE WHEN {_last(names)} > {inner} THEN stack[1:{_last(names)} - 1] ELSE stack END"


_READ = "coalesce(html, '')"
for _pattern in html.UNREAD:
    _READ = f"regexp_replace({_READ}, '{_pattern}', ' ', 'g')"
_OWN_END = " ".join(f"WHEN starts AND tag = '{t}' THEN {_without(*e)}" for t, e in html.ENDS.items())
_CLOSING = f"list_max(list_transform(range(1, len(stack) + 1), lambda i: CASE WHEN stack[i] = tag THEN i ELSE 0 END))"
_CLOSED = f"CASE WHEN coalesce({_CLOSING}, 0) > CASE WHEN NOT is_block THEN {_last(html.BLOCKS)} WHEN tag IN {_names(html.OUTER)} THEN 0 ELSE {_last(html.CELLS)} END THEN stack[1:{_CLOSING} - 1] ELSE stack END"
#: One row a tag or text, in order: the stack after it, then what the line and the span are.
_STEP = f"""
  FROM (SELECT *, {_last(html.SIDE)} > 0 AS side, {_last(html.SIDE)} = 0 AND {_last(html.CELLS)} > 0 AS in_cell, CASE WHEN {_last(html.SIZES)} > 0 THEN stack[{_last(html.SIZES)}] END AS sized,
      coalesce(stack[nullif({_last(html.BLOCKS)}, 0)], '') AS block_tag, {_last(html.BOLD)} > 0 AS heavy,
      CASE WHEN tag = 'li' AND starts THEN '{html.MARKER}' WHEN tag <> '' THEN '' WHEN ends OR marked THEN ltrim(plain, ' ') ELSE plain END AS said
    FROM (SELECT * REPLACE (
          CASE WHEN tag <> '' AND NOT closes AND NOT is_void THEN list_append(stack, tag) ELSE stack END AS stack,
          CASE WHEN starts AND tag IN ('table', 'tr') THEN used_main + {html.STEP} ELSE row0 END AS row0,
          CASE WHEN starts AND tag IN ('table', 'tr') THEN -1 WHEN starts AND tag IN ('td', 'th') THEN cell + 1 ELSE cell END AS cell,
          opened OR (starts AND tag IN ('td', 'th')) AS opened, spaced OR tag IN {_names(html.SPACED)} AS spaced,
          ends OR breaks OR (NOT closes AND tag = 'br') AS ends, marked AND NOT breaks AND NOT (NOT closes AND tag = 'br') AS marked, block + CAST(breaks AS INTEGER) AS block)
      FROM (SELECT * REPLACE (CASE {_OWN_END} ELSE stack END AS stack), is_block AND (closes OR NOT marked OR tag = 'li') AS breaks
        FROM (SELECT * REPLACE (CASE WHEN closes THEN {_CLOSED} WHEN starts THEN {_without(["p"], html.CELLS)} ELSE stack END AS stack)
          FROM (SELECT w.* EXCLUDE (k, said, sized, heavy, block_tag, side), t.k, t.tag, t.closes, t.plain, t.tag IN {_names(html.BLOCKS)} AS is_block, t.tag IN {_names(html.VOID)} AS is_void, NOT t.closes AND t.tag IN {_names(html.BLOCKS)} AS starts
            FROM tag_walk w JOIN page_tokens t ON t.document_id = w.document_id AND t.k = w.k + 1)))))"""
_ABOVE = "CASE WHEN in_cell AND NOT was_side THEN line WHEN side THEN used_side ELSE used_main END"
_NEW_LINE = f"CASE WHEN in_cell AND opened THEN row0 ELSE {_ABOVE} + {html.STEP} + CASE WHEN spaced AND {_ABOVE} >= 0 THEN {html.SPACE} ELSE 0 END END"
SPANS = rf"""
read_pages AS (SELECT CAST(page_id AS VARCHAR) AS document_id, {_READ} AS read FROM pages),
raw_tokens AS (
  SELECT document_id, unnest(range(1, len(tags) + 1)) AS k, lower(unnest(tags)) AS raw_tag, unnest(texts) AS raw_text
  FROM (SELECT document_id, regexp_extract_all(read, '{html.TOKEN}', 1) AS tags, regexp_extract_all(read, '{html.TOKEN}', 2) AS texts FROM read_pages)),
page_tokens AS (SELECT document_id, k, ltrim(coalesce(raw_tag, ''), '/') AS tag, coalesce(raw_tag, '') LIKE '/%' AS closes, regexp_replace(coalesce(raw_text, ''), '{html.BLANKS}', ' ', 'g') AS plain FROM raw_tokens),
tag_walk AS (
  SELECT document_id, CAST([] AS VARCHAR[]) AS stack, 0 AS block, 0 AS line, -1 AS cell, 0 AS row0, true AS ends, false AS spaced, false AS marked, false AS opened, false AS was_side, {-html.STEP} AS used_main, {-html.STEP} AS used_side,
    CAST(0 AS BIGINT) AS k, '' AS said, CAST(NULL AS VARCHAR) AS sized, false AS heavy, '' AS block_tag, false AS side FROM read_pages
  UNION ALL
  SELECT document_id, stack, block, CASE WHEN said <> '' AND ends THEN {_NEW_LINE} ELSE line END, cell, row0, ends AND said = '', spaced AND said = '', CASE WHEN said = '' THEN marked ELSE tag <> '' END, opened AND said = '',
    CASE WHEN said = '' THEN was_side ELSE side END, CASE WHEN said <> '' AND ends AND NOT side THEN greatest(used_main, {_NEW_LINE}) ELSE used_main END,
    CASE WHEN said <> '' AND ends AND side THEN greatest(used_side, {_NEW_LINE}) ELSE used_side END, k, said, sized, heavy, CASE WHEN said <> '' AND in_cell THEN 'c' || cell || ' ' || block_tag ELSE 'm ' || block_tag END, side {_STEP}),
said_spans AS (
  SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY k) - 1 AS INTEGER) AS ord, {unescaped("said")} AS text, line, block, split_part(block_tag, ' ', 2) AS tag, side, heavy AS bold,
    CASE WHEN side THEN -1 WHEN block_tag LIKE 'c%' THEN CAST(substr(split_part(block_tag, ' ', 1), 2) AS INTEGER) ELSE 0 END AS col,
    CAST(CASE sized {" ".join(f"WHEN '{t}' THEN {v}" for t, v in html.SIZES.items())} ELSE {html.SIZE} END AS DOUBLE) AS font_size FROM tag_walk WHERE said <> ''),
line_starts AS (SELECT *, CAST(coalesce(line <> lag(line) OVER w OR col <> lag(col) OVER w, true) AS INTEGER) AS new FROM said_spans WINDOW w AS (PARTITION BY document_id ORDER BY ord)),
stretches AS (SELECT *, sum(new) OVER (PARTITION BY document_id ORDER BY ord) AS stretch FROM line_starts),
along AS (
  SELECT *, least(CASE WHEN side THEN {html.SIDE_EDGE} ELSE {html.MAIN_EDGE} + {html.CELL} * least(col, {html.CELLS_APART}) END::DOUBLE
      + coalesce(sum(length(text) * font_size * 0.5) OVER (PARTITION BY document_id, stretch ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), {html.RIGHT})::DOUBLE AS x FROM stretches),
spans AS (
  SELECT document_id, CAST(1 + line // {html.PAGE_STEPS} AS INTEGER) AS page, ord, text, x, ({html.TOP} + {html.QUARTER} * (line % {html.PAGE_STEPS}))::DOUBLE AS y, least(length(text) * font_size * 0.5, {html.RIGHT} - x)::DOUBLE AS width,
    font_size AS height, font_size, bold, block, tag, 612.0::DOUBLE AS page_width, 792.0::DOUBLE AS page_height FROM along)"""
LINES = r"""
span_order AS (SELECT *, row_number() OVER (PARTITION BY document_id, page ORDER BY round_even(y, 2), x, ord) AS k FROM spans),
tolerances AS (SELECT document_id, page, greatest(0.6 * coalesce(median(CASE WHEN height > 0 THEN height END), 12), 0.5) AS tol FROM spans GROUP BY document_id, page),
baselines AS (
  SELECT document_id, page, k, ord, y AS anchor, 1 AS vrow FROM span_order WHERE k = 1
  UNION ALL
  SELECT s.document_id, s.page, s.k, s.ord, CASE WHEN abs(r.anchor - s.y) <= tol THEN r.anchor ELSE s.y END, r.vrow + CASE WHEN abs(r.anchor - s.y) <= tol THEN 0 ELSE 1 END
  FROM baselines r JOIN span_order s ON s.document_id = r.document_id AND s.page = r.page AND s.k = r.k + 1 JOIN tolerances t ON t.document_id = s.document_id AND t.page = s.page),
gutters AS (
  SELECT s.*, r.vrow, coalesce(s.x - lag(s.x + s.width) OVER w > greatest(2.5 * lag(s.font_size) OVER w, 18), false) AS cut
  FROM span_order s JOIN baselines r ON r.document_id = s.document_id AND r.page = s.page AND r.ord = s.ord WINDOW w AS (PARTITION BY s.document_id, s.page, r.vrow ORDER BY s.x, s.ord)),
line_parts AS (SELECT *, sum(CAST(cut AS INTEGER)) OVER (PARTITION BY document_id, page, vrow ORDER BY x, ord) AS piece FROM gutters),
made_lines AS (
  SELECT * FROM (
    SELECT document_id, page, vrow, piece, min(y) AS y, min(x) AS x0, max(x + width) AS x1, max(y + height) AS bottom, trim(regexp_replace(string_agg(text, '' ORDER BY x, ord), '\s+', ' ', 'g')) AS text,
      max(font_size) AS font_size, bool_or(bold) AS bold, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY x, ord) AS ids FROM line_parts GROUP BY document_id, page, vrow, piece) WHERE text <> ''),
left_edges AS (SELECT DISTINCT document_id, page, round_even(x0, 1) AS e FROM made_lines),
edge_steps AS (SELECT *, CAST(coalesce(e - lag(e) OVER w > 40, true) AS INTEGER) AS new FROM left_edges WINDOW w AS (PARTITION BY document_id, page ORDER BY e)),
edge_runs_of AS (SELECT *, sum(new) OVER (PARTITION BY document_id, page ORDER BY e) AS run FROM edge_steps),
edge_bands AS (SELECT document_id, page, run, min(e) AS lo, max(e) AS hi FROM edge_runs_of GROUP BY document_id, page, run),
full_bands AS (
  SELECT b.document_id, b.page, lo FROM edge_bands b JOIN made_lines l ON l.document_id = b.document_id AND l.page = b.page AND l.x0 BETWEEN lo - 0.05 AND hi + 0.05
  GROUP BY b.document_id, b.page, run, lo HAVING count(*) >= 3),
band_starts AS (SELECT document_id, page, list(lo ORDER BY lo) AS starts FROM full_bands GROUP BY document_id, page HAVING count(*) >= 2),
banded AS (
  SELECT l.*, CAST(CASE WHEN starts[1] <= x0 + 0.05 THEN len(list_filter(starts, lambda s: s <= x0 + 0.05)) - 1
    WHEN starts IS NOT NULL THEN list_position(list_transform(starts, lambda s: abs(s - x0)), list_min(list_transform(starts, lambda s: abs(s - x0)))) - 1 END AS INTEGER) AS band
  FROM made_lines l LEFT JOIN band_starts b ON b.document_id = l.document_id AND b.page = l.page),
lines AS (SELECT *, CAST(row_number() OVER (PARTITION BY document_id, page ORDER BY coalesce(band, 0), y, x0, vrow, piece) AS INTEGER) AS line FROM banded)"""
UNITS = (
    LINES
    + """,
line_steps AS (SELECT *, y - lag(y) OVER w AS gap, lag(font_size) OVER w AS last_size, lag(bold) OVER w AS last_bold, lag(band) OVER w AS last_band FROM lines WINDOW w AS (PARTITION BY document_id, page ORDER BY line)),
line_medians AS (SELECT document_id, page, coalesce(median(CASE WHEN gap > 0 THEN gap END), 12) AS middle FROM line_steps GROUP BY document_id, page),
line_pairs AS (
  SELECT l.*, middle, abs(font_size - last_size) < 0.6 AND bold = last_bold AND band IS NOT DISTINCT FROM last_band AND gap <= greatest(middle * 1.6, last_size * 1.4) AS alike, len(string_split(text, ' ')) AS n_words
  FROM line_steps l JOIN line_medians m ON m.document_id = l.document_id AND m.page = l.page),
unit_runs AS (
  SELECT document_id, page, line, 1 AS run, 1 AS unit FROM line_pairs WHERE line = 1
  UNION ALL
  SELECT p.document_id, p.page, p.line, CASE WHEN p.alike AND (u.run < 3 OR p.n_words <= 12) THEN u.run + 1 ELSE 1 END, u.unit + CASE WHEN p.alike AND (u.run < 3 OR p.n_words <= 12) THEN 0 ELSE 1 END
  FROM unit_runs u JOIN line_pairs p ON p.document_id = u.document_id AND p.page = u.page AND p.line = u.line + 1),
unit_groups AS (
  SELECT p.document_id, p.page, unit, string_agg(text, ' ' ORDER BY p.line) AS text, min(x0) AS x, min(y) AS y, max(x1) AS x1, max(bottom) AS bottom, max(font_size) AS font_size, bool_or(bold) AS bold, count(*) AS n,
    string_agg(ids, ',' ORDER BY p.line) AS span_ids, any_value(middle) AS middle
  FROM line_pairs p JOIN unit_runs u ON u.document_id = p.document_id AND u.page = p.page AND u.line = p.line GROUP BY p.document_id, p.page, unit),
units AS (
  SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY page, unit) AS INTEGER) AS ord, page, text, round(x, 2) AS x, round(y, 2) AS y, round(x1 - x, 2) AS width, round(bottom - y, 2) AS height,
    round(font_size, 2) AS font_size, bold, CAST(n AS INTEGER) AS line_count, span_ids, 612.0::DOUBLE AS page_width, 792.0::DOUBLE AS page_height, round(middle, 2) AS median_gap FROM unit_groups)"""
)
HISTOGRAM = """
histogram AS (
  SELECT document_id, page, round_even(font_size * 2, 0) / 2 AS size, sum(length(text)) / sum(sum(length(text))) OVER (PARTITION BY document_id, page) AS share
  FROM spans GROUP BY document_id, page, round_even(font_size * 2, 0) / 2)"""
TYPOGRAPHY = """
sizes AS (
  SELECT document_id, round_even(font_size * 2, 0) / 2 AS size, sum(greatest(length(text), 1)) AS mass,
    sum(greatest(length(text), 1)) / sum(sum(greatest(length(text), 1))) OVER (PARTITION BY document_id) AS share
  FROM units GROUP BY document_id, round_even(font_size * 2, 0) / 2),
modal AS (SELECT document_id, size AS baseline FROM sizes QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY mass DESC, size) = 1),
contrasts AS (SELECT document_id, least(count_if(share >= 0.05), 4) / 4 AS contrast FROM sizes GROUP BY document_id),
typography AS (SELECT document_id, baseline, contrast, contrast <= 0.25 AS flat FROM modal JOIN contrasts USING (document_id))"""
LEVELS = """
headed AS (SELECT s.*, baseline, size > baseline AND (share >= 0.03 OR mass >= 14) AS heading FROM sizes s JOIN typography USING (document_id)),
levels AS (
  SELECT document_id, size, CASE WHEN heading AND rank <= 4 THEN 'h' || rank WHEN size > baseline THEN 'outlier' ELSE 'body' END AS level
  FROM (SELECT *, CAST(sum(CAST(heading AS INTEGER)) OVER (PARTITION BY document_id ORDER BY size DESC) AS INTEGER) AS rank FROM headed))"""
#: Word borders are spelled out, as this engine's \\b knows ASCII letters only.
_BEFORE, _AFTER, _SIGN = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])", r"[\p{L}\p{N}_]"
IDENTIFIER = rf"(?i){_BEFORE}(?:[A-Z]{{2,}}[-/][A-Z0-9](?:[A-Z0-9-]+[A-Z0-9]{_AFTER}|[A-Z0-9-]+-{_SIGN})|(?:No|Case|Docket|Report|Publication)\.?\s*[:#]?\s*[A-Z0-9](?:[A-Z0-9.-]+[A-Z0-9]{_AFTER}|[A-Z0-9.-]+[.-]{_SIGN}))"
MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
DATE = rf"(?i)\b[0-9]{{1,2}}[/-][0-9]{{1,2}}[/-][0-9]{{2,4}}\b|\b[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\b|\b{MONTH}\.?\s+[0-9]{{1,2}},?\s+[0-9]{{4}}\b|\b[0-9]{{1,2}}\s+{MONTH}\.?\s+[0-9]{{4}}\b"
NOISE = (r"^[^\p{L}\p{N}_]*$", r"(?i)^(?:page\s*)?[0-9]{1,4}(?:\s*of\s*[0-9]{1,4})?$", r"(?i)^https?://|^www\.", r"^\S+@\S+\.\S+$", r"^[0-9\s().+-]{7,}$", r"(?i)intentionally\s+(?:left\s+)?blank")


def ratio(top: str, bottom: str) -> str:
    size = lambda p: f"length(regexp_replace(text, '{p}', '', 'g'))"
    return f"CASE WHEN {size(bottom)} > 0 THEN floor({size(top)} / {size(bottom)} * 10000 + 0.5) / 10000 ELSE 0 END"


FEATURE = "document_id, page, ord, font_rank, top_ratio, zone, center_score, block_area, left_indent, bold_flag, uppercase_ratio, digit_ratio, word_count, identifier, date, noise, whitespace_isolation, isolation_imputed, first_occurrence"
FEATURES = rf"""
gaps AS (
  SELECT *, y - lag(y) OVER w AS before, lead(y) OVER w - y AS after, count(*) OVER (PARTITION BY document_id, page) AS on_page,
    row_number() OVER (PARTITION BY document_id, lower(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '[0-9]', '#', 'g')) ORDER BY ord) AS seen
  FROM units WINDOW w AS (PARTITION BY document_id, page ORDER BY y, x, ord)),
features AS (
  SELECT g.*, t.flat, {r4("least(font_size / baseline, 2.5) / 2.5")} AS font_rank, {r4("greatest(0, least(1, y / page_height))")} AS top_ratio,
    CASE WHEN {r4("greatest(0, least(1, y / page_height))")} < 0.10 THEN 'header' WHEN {r4("greatest(0, least(1, y / page_height))")} > 0.90 THEN 'footer' ELSE 'body' END AS zone,
    {r4("greatest(0, 1 - abs(x + width / 2 - page_width / 2) / (0.25 * page_width))")} AS center_score,
    {r4("least(width * height / (page_width * page_height), 1)")} AS block_area, {r4("greatest(0, least(1, x / page_width))")} AS left_indent,
    CAST(CAST(bold AS INTEGER) AS DOUBLE) AS bold_flag, {ratio(r"[^\p{Lu}]", r"[^\p{L}]")} AS uppercase_ratio, {ratio("[^0-9]", r"\s")} AS digit_ratio,
    CAST(len(string_split(text, ' ')) AS INTEGER) AS word_count, regexp_matches(text, '{IDENTIFIER}') AS identifier, regexp_matches(text, '{DATE}') AS date,
    {" OR ".join(f"regexp_matches(text, '{p}')" for p in NOISE)} AS noise,
    CASE WHEN on_page >= 3 AND median_gap > 0 THEN {r4("least((coalesce(before / median_gap, 2) + coalesce(after / median_gap, 2)) / 4, 1)")} ELSE 0.5 END AS whitespace_isolation,
    NOT (on_page >= 3 AND median_gap > 0) AS isolation_imputed, CAST(CAST(seen = 1 AS INTEGER) AS DOUBLE) AS first_occurrence
  FROM gaps g JOIN typography t ON t.document_id = g.document_id)"""
LAYOUT = ("font_rank", "center_score", "bold_flag", "uppercase_ratio")
_WEIGHTED = " + ".join(f"coalesce({r4(f'(CASE WHEN flat THEN {w * 0.4} ELSE {w} END) * {n}' if n in LAYOUT else f'{w} * {n}')}, 0)" for n, w in C["title_weights"].items())
SCORES = f"""
judged AS (
  SELECT *, 1 - top_ratio AS top_ratio_inverted, CASE WHEN length(text) < 8 THEN ['too_short'] ELSE list_filter([
    CASE WHEN word_count < 2 THEN 'too_few_words' END, CASE WHEN word_count > 28 THEN 'too_many_words' END, CASE WHEN noise THEN 'noise_pattern' END,
    CASE WHEN zone = 'footer' THEN 'footer_zone' END, CASE WHEN digit_ratio > 0.55 THEN 'digit_heavy' END], lambda x: x IS NOT NULL) END AS reasons FROM features),
weighed AS (
  SELECT *, {_WEIGHTED} + CASE WHEN page > 1 THEN -1.2 ELSE 0 END + CASE WHEN identifier THEN -1.6 ELSE 0 END + CASE WHEN date AND word_count <= 6 THEN -0.6 ELSE 0 END
    + CASE WHEN digit_ratio > 0.30 THEN -0.8 ELSE 0 END + CASE WHEN uppercase_ratio > 0.9 AND word_count > 8 THEN -0.4 ELSE 0 END AS raw_score FROM judged),
scores AS (SELECT *, CASE WHEN len(reasons) = 0 THEN {r4("raw_score")} END AS score FROM weighed)"""
TITLES = f"""
ranked AS (
  SELECT *, row_number() OVER w AS rank, lead(score) OVER w AS next FROM scores WHERE score IS NOT NULL WINDOW w AS (PARTITION BY document_id ORDER BY score DESC, page, top_ratio, left_indent, ord)),
rankings AS (SELECT document_id, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY rank) AS ranking FROM ranked WHERE rank <= 5 GROUP BY document_id),
margins AS (SELECT document_id, ord, text AS candidate, score, {r4("coalesce(score - next, score)")} AS margin FROM ranked WHERE rank = 1),
titles AS (
  SELECT document_id, ord, CASE WHEN margin >= 0.1 THEN candidate END AS title, candidate, score, margin, CASE WHEN margin >= 99 THEN 'auto' WHEN margin >= 0.1 THEN 'review' ELSE 'escalate' END AS confidence, ranking
  FROM margins JOIN rankings USING (document_id))"""
TITLE_RECORDS = """
records AS (
  SELECT s.document_id, 'TITLE' AS role, t.title, t.candidate, t.ord, (SELECT u.span_ids FROM units u WHERE u.document_id = s.document_id AND u.ord = t.ord) AS span_ids, t.score, t.margin, coalesce(t.confidence, 'escalate') AS confidence,
    CASE WHEN t.document_id IS NULL THEN 'no eligible candidate' END AS reason, s.units, s.excluded, s.flat
  FROM (SELECT document_id, count(*) AS units, count(*) FILTER (len(reasons) > 0) AS excluded, bool_or(flat) AS flat FROM scores GROUP BY document_id) s LEFT JOIN titles t ON t.document_id = s.document_id)"""
_DAMPED = {n: f"CASE WHEN flat THEN {w * 0.4} ELSE {w} END" if n in LAYOUT else str(w) for n, w in C["title_weights"].items()}
_FEATURES = [f"SELECT document_id, '{n}' AS feature, {n}::DOUBLE AS value, CASE WHEN {n} IS NULL THEN {w}::DOUBLE ELSE {r4(f'({_DAMPED[n]})::DOUBLE')} END AS weight, coalesce({r4(f'({_DAMPED[n]}) * {n}')}, 0) AS contribution FROM won" for n, w in C["title_weights"].items()]
_PENALTIES = [
    f"SELECT document_id, '{n}', 1.0::DOUBLE, {w}::DOUBLE, {w}::DOUBLE FROM won WHERE {when}"
    for n, w, when in (("not_first_page", -1.2, "page > 1"), ("identifier", -1.6, "identifier"), ("date", -0.6, "date AND word_count <= 6"), ("digit_heavy", -0.8, "digit_ratio > 0.30"), ("all_caps_long", -0.4, "uppercase_ratio > 0.9 AND word_count > 8"))
]
TITLE_CONTRIBUTIONS = f"""
won AS (SELECT * FROM ranked WHERE rank = 1),
contributions AS ({" UNION ALL ".join(_FEATURES + _PENALTIES)})"""
#: As in sources/html.py, without \\d.
JUNK = (r"(?i)^(untitled|no title|document\s*[0-9]*|slide\s*[0-9]+|print job|chapter\s*[0-9]+)", r"(?i)^microsoft\s+(word|powerpoint|excel)\b", r"\.[A-Za-z0-9]{2,6}\s*$", r"(?i)text_all|final[_ ]?draft|^copy of", r"(?i)^[a-z0-9_\-]{1,20}$")
def usable(x: str) -> str:
    return f"(length({x}) >= 12 AND len(string_split({x}, ' ')) >= 2 AND NOT ({' OR '.join(f"regexp_matches({x}, '{p}')" for p in JUNK)}))"


HARVEST = rf"""
raw_titles AS (SELECT CAST(page_id AS VARCHAR) AS document_id, trim(regexp_replace({unescaped("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, '\s+', ' ', 'g')) AS title FROM pages),
harvest AS (SELECT document_id, title FROM raw_titles WHERE {usable("title")})"""
OUTLINE = r"""
heading_spans AS (SELECT document_id, block, tag, min(ord) AS ord, min(page) AS page, trim(regexp_replace(string_agg(text, '' ORDER BY ord), '\s+', ' ', 'g')) AS text FROM spans WHERE regexp_matches(tag, '^h[1-6]$') GROUP BY document_id, block, tag),
headings AS (SELECT document_id, ord, page, CAST(substr(tag, 2) AS INTEGER) AS level, text FROM heading_spans WHERE text <> ''),
tree AS (
  SELECT h.*, (SELECT max(p.ord) FROM headings p WHERE p.document_id = h.document_id AND p.ord < h.ord AND p.level < h.level
    AND NOT EXISTS (SELECT 1 FROM headings q WHERE q.document_id = h.document_id AND q.ord > p.ord AND q.ord < h.ord AND q.level < p.level)) AS parent FROM headings h),
paths AS (
  SELECT *, 1 AS depth, [text] AS path FROM tree WHERE parent IS NULL
  UNION ALL SELECT t.*, p.depth + 1, list_append(p.path, t.text) FROM tree t JOIN paths p ON p.document_id = t.document_id AND p.ord = t.parent)"""


def evaluation_tokens(x: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9]+'), lambda w: length(w) > 1 AND NOT list_contains({listed('evaluation_stopwords')}, w)))"


TITLE_F1 = f"""
compared AS (
  SELECT t.title AS emitted, t.confidence, {evaluation_tokens("t.candidate")} AS a, {evaluation_tokens("h.title")} AS b FROM titles t JOIN harvest h ON h.document_id = t.document_id),
title_f1 AS (SELECT emitted, confidence, CASE WHEN len(list_intersect(a, b)) > 0 THEN 2 * len(list_intersect(a, b)) / (len(a) + len(b)) ELSE 0 END AS f1 FROM compared)"""
_share = lambda x: f"floor(avg(CAST({x} AS INTEGER)) * 10000 + 0.5) / 10000"
TITLE_METRICS = f"""
SELECT count(*) AS documents, {_share("emitted IS NOT NULL")} AS coverage, {_share("(f1 >= 0.7 AND emitted IS NOT NULL)")} AS accuracy, {_share("(f1 >= 0.5 AND emitted IS NOT NULL)")} AS lenient,
  coalesce(floor(count_if(f1 >= 0.7 AND emitted IS NOT NULL) / nullif(count_if(emitted IS NOT NULL), 0) * 10000 + 0.5) / 10000, 0) AS precision_emit, {_share("confidence = 'escalate'")} AS escalation_rate,
  {_share("(f1 >= 0.7)")} AS candidate_accuracy FROM title_f1"""
LEXICAL = r"list_transform(regexp_extract_all({0}, '[A-Za-z][A-Za-z''’\-]*|[0-9]+[A-Za-z]*'), lambda w: lower(w))"
IR = "list_filter(" + LEXICAL + f", lambda w: length(w) >= 2 AND NOT regexp_matches(w, '^[0-9]+$') AND NOT list_contains({listed('connectors', 'hard_stopwords')}, w))"
TOKENS = f"""
term_counts AS (SELECT document_id, term, count(*) AS tf FROM (SELECT document_id, unnest({IR.format("text")}) AS term FROM units) GROUP BY document_id, term),
terms AS (SELECT *, CAST(sum(tf) OVER (PARTITION BY document_id) AS BIGINT) AS length FROM term_counts)"""
IDF = f"""
corpus AS (SELECT item_id, {IR.format("coalesce(text, '')")} AS words FROM benchmark WHERE item_id IS NOT NULL),
idf AS (
  SELECT term, df, floor(ln((n - df + 0.5) / (df + 0.5) + 1) * 1e6 + 0.5) / 1e6 AS idf
  FROM (SELECT term, count(DISTINCT item_id) AS df FROM (SELECT item_id, unnest(words) AS term FROM corpus) GROUP BY term), (SELECT count(DISTINCT item_id) AS n FROM corpus)),
idf_summary AS (
  SELECT count(*) AS documents, floor(avg(n) * 100 + 0.5) / 100 AS avgdl, (SELECT max(idf) FROM idf) AS most
  FROM (SELECT item_id, greatest(sum(len(words)), 1) AS n FROM corpus GROUP BY item_id))"""
BM25 = """
bm25 AS (
  SELECT document_id, t.term AS word, coalesce(i.idf, most, 1.0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * (length / coalesce(avgdl, length)))) AS score
  FROM terms t LEFT JOIN idf i ON i.term = t.term, idf_summary)"""
_SPLIT = r"[.,;:!?()\[\]{}\"“”/\\|]+|\s+[-–—]\s+"
_EDGE = r"[\"''“”‘’()\[\]{}.,;:!?]+"
PHRASES = rf"""
chunks AS (SELECT document_id, ord, unnest(parts) AS c, unnest(range(len(parts))) AS chunk FROM (SELECT document_id, ord, regexp_split_to_array(text, '{_SPLIT}') AS parts FROM units)),
split_words AS (SELECT document_id, ord, chunk, unnest(ws) AS raw, unnest(range(len(ws))) AS i FROM (SELECT document_id, ord, chunk, regexp_split_to_array(trim(c), '\s+') AS ws FROM chunks)),
bare AS (SELECT *, regexp_replace(regexp_replace(raw, '^{_EDGE}', ''), '{_EDGE}$', '') AS word FROM split_words),
marked AS (SELECT *, list_contains({listed("hard_stopwords")}, lower(word)) AS hard FROM bare WHERE word <> ''),
islands AS (SELECT * FROM (SELECT *, sum(CAST(hard AS INTEGER)) OVER (PARTITION BY document_id, ord, chunk ORDER BY i) AS island FROM marked) WHERE NOT hard),
parted AS (SELECT *, (row_number() OVER (PARTITION BY document_id, ord, chunk, island ORDER BY i) - 1) // 12 AS part, list_contains({listed("connectors")}, lower(word)) AS edge FROM islands),
bounded AS (SELECT *, min(CASE WHEN NOT edge THEN i END) OVER w AS lo, max(CASE WHEN NOT edge THEN i END) OVER w AS hi FROM parted WINDOW w AS (PARTITION BY document_id, ord, chunk, island, part)),
phrases AS (SELECT document_id, ord, chunk, island, part, list(word ORDER BY i) AS words FROM bounded WHERE i BETWEEN lo AND hi GROUP BY document_id, ord, chunk, island, part)"""
RAKE = """
rake AS (
  SELECT document_id, word, count(*) AS freq, (sum(n - 1) + count(*)) / count(*) AS score
  FROM (SELECT document_id, unnest(own) AS word, len(own) AS n FROM (SELECT document_id, list_filter(list_transform(words, lambda w: lower(w)), lambda w: length(w) >= 2) AS own FROM phrases)) GROUP BY document_id, word)"""
EDGES = rf"""
contents AS (SELECT document_id, ord, list_filter({LEXICAL.format("text")}, lambda w: length(w) > 2 AND NOT regexp_matches(w, '^[0-9]+$') AND NOT list_contains({listed("connectors", "hard_stopwords")}, w)) AS ws FROM units),
placed AS (SELECT document_id, ord, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM contents),
near AS (SELECT p.document_id, p.w AS a, q.w AS b FROM placed p JOIN placed q ON q.document_id = p.document_id AND q.ord = p.ord AND q.i BETWEEN p.i + 1 AND p.i + 2 WHERE p.w <> q.w),
edges AS (SELECT DISTINCT document_id, a, b FROM (SELECT * FROM near UNION ALL SELECT document_id, b, a FROM near UNION ALL SELECT document_id, w, w FROM placed))"""
TEXTRANK = """
node_counts AS (SELECT document_id, count(DISTINCT a) AS n FROM edges GROUP BY document_id),
degrees AS (SELECT document_id, a AS word, greatest(1, count_if(a <> b)) AS degree FROM edges GROUP BY document_id, a),
ranking_links AS (SELECT e.document_id, e.a, e.b, n, degree, e.a <> e.b AS real FROM edges e JOIN degrees d ON d.document_id = e.document_id AND d.word = e.b JOIN node_counts c ON c.document_id = e.document_id),
word_ranks AS (
  SELECT 0 AS it, d.document_id, d.word, 1e0 / n AS score FROM degrees d JOIN node_counts c ON c.document_id = d.document_id
  UNION ALL
  SELECT r.it + 1, l.document_id, l.a, 15e-2 / n + 85e-2 * sum(CASE WHEN real THEN r.score / degree ELSE 0 END) FROM word_ranks r JOIN ranking_links l ON l.document_id = r.document_id AND l.b = r.word WHERE r.it < 40 GROUP BY r.it, l.document_id, l.a, n),
textrank AS (SELECT document_id, word, score / max(score) OVER (PARTITION BY document_id) AS score FROM word_ranks WHERE it = 40)"""


def _count(sign: str) -> str:
    return f"(length(t) - length(replace(t, '{sign}', '')))"


_REPEATED = "list_contains(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5) = repeat(substr(t, i, 1), 5)), true)"
_OVER = "(0.5 + 0.5 * least(({0} - {1}) / {1}, 2.0))".format

def presentability(source: str = "units", column: str = "text", key: str = "ord") -> str:
    """How presentable a column of a table with a key in each document is."""
    return rf"""
shaped AS (
  SELECT document_id, {key}, trim({column}) AS t, list_filter(regexp_split_to_array(trim({column}), '\s+'), lambda x: x <> '') AS w, {LEXICAL.format(f"trim({column})")} AS toks FROM {source}),
counted AS (
  SELECT *, len(w) AS n, length(t) AS chars, regexp_replace(regexp_replace(lower(w[1]), '^[.,;:]+', ''), '[.,;:]+$', '') AS first_word,
    regexp_replace(regexp_replace(lower(w[-1]), '^[.,;:]+', ''), '[.,;:]+$', '') AS last_word,
    length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS uppers, length(regexp_replace(t, '\s', '', 'g')) AS solid, length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits,
    CASE WHEN len(toks) > 0 THEN len(list_filter(toks, lambda x: list_contains({listed("connectors", "hard_stopwords")}, x))) / len(toks) ELSE 1 END AS stop_ratio,
    list_filter(w, lambda x: regexp_matches(x, '^\p{{L}}') AND NOT list_contains({listed("connectors", "hard_stopwords")}, lower(x))) AS content FROM shaped),
summed AS (
  SELECT document_id, {key}, t, 0.55
    + CASE WHEN n > 18 OR chars > 95 THEN least(CASE WHEN n > 18 THEN -0.55 * {_OVER("n", "18")} END, CASE WHEN chars > 95 THEN -0.40 * {_OVER("chars", "95")} END)
      WHEN n BETWEEN 3 AND 12 THEN 0.30 WHEN n < 2 THEN -0.45 WHEN n < 3 THEN -0.18 ELSE 0 END
    + CASE WHEN list_contains({listed("connectors")}, last_word) THEN -0.35 ELSE 0 END
    + CASE WHEN list_contains({listed("connectors")}, first_word) AND first_word NOT IN ('a', 'an', 'the') THEN -0.30 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[.!?]\s+[A-Za-z]') THEN -0.30 ELSE 0 END + CASE WHEN regexp_matches(t, '[,;:\-–—/]\s*$') THEN -0.15 ELSE 0 END
    + CASE WHEN regexp_matches(t, '\s{{3,}}') OR {_REPEATED} THEN -0.20 ELSE 0 END
    + CASE WHEN {_count("(")} <> {_count(")")} OR {_count("[")} <> {_count("]")} OR {_count("{")} <> {_count("}")} THEN -0.20 ELSE 0 END
    + CASE WHEN stop_ratio > 0.55 THEN -0.35 ELSE 0 END + CASE WHEN solid > 0 AND digits / solid > 0.30 THEN -0.30 ELSE 0 END
    + CASE WHEN list_has_any(toks, {listed("furniture")}) THEN -0.25 ELSE 0 END
    + CASE WHEN letters > 0 AND uppers / letters > 0.85 THEN CASE WHEN n <= 12 THEN 0.10 ELSE -0.15 END
      WHEN letters > 0 AND len(content) >= 2 AND len(list_filter(content, lambda x: regexp_matches(x, '^\p{{Lu}}'))) / len(content) >= 0.75 THEN 0.12 ELSE 0 END
    + CASE WHEN chars <= 60 AND n BETWEEN 3 AND 12 THEN 0.08 ELSE 0 END AS total FROM counted),
presentability AS (SELECT document_id, {key}, CASE WHEN t = '' THEN 0 ELSE {r4("greatest(0, least(1, total))")} END AS presentability FROM summed)"""


PRESENTABILITY = presentability()
PHRASE_EDGES = """
below AS (SELECT *, lead(y) OVER (PARTITION BY document_id, page ORDER BY y, x, ord) - (y + height) AS down, row_number() OVER (PARTITION BY document_id ORDER BY page, y, x, ord) AS place FROM units),
down_medians AS (SELECT document_id, coalesce(median(CASE WHEN down > 0 THEN down END), 12) AS gap FROM below GROUP BY document_id),
phrase_edges AS (
  SELECT a.document_id, a.page, a.ord AS a, b.ord AS b FROM below a JOIN below b ON b.document_id = a.document_id AND b.page = a.page AND b.place BETWEEN a.place + 1 AND a.place + 3
  JOIN down_medians g ON g.document_id = a.document_id
  WHERE b.y - (a.y + a.height) BETWEEN -1 AND 2.2 * greatest(gap, 1) AND abs(a.font_size - b.font_size) <= 0.6 AND a.bold = b.bold
    AND (abs(a.x - b.x) <= 4 OR abs(a.x + a.width / 2 - b.x - b.width / 2) <= 12))"""
CHAINS = """
linked AS (
  SELECT document_id, a, b, CAST(NULL AS INTEGER) AS c FROM phrase_edges
  UNION ALL SELECT e.document_id, e.a, e.b, f.b FROM phrase_edges e JOIN phrase_edges f ON f.document_id = e.document_id AND f.a = e.b),
chains AS (
  SELECT * FROM (
    SELECT l.document_id, l.a, l.b, concat_ws(' - ', x.text, y.text, z.text) AS text FROM linked l JOIN units x ON x.document_id = l.document_id AND x.ord = l.a
    JOIN units y ON y.document_id = l.document_id AND y.ord = l.b LEFT JOIN units z ON z.document_id = l.document_id AND z.ord = l.c)
  WHERE len(string_split(text, ' ')) <= 16)"""


def cleaned(x: str) -> str:
    return rf"regexp_replace(regexp_replace(trim(regexp_replace({x}, '\s+', ' ', 'g')), '^[ \t\-–—·|]+', ''), '[ \t\-–—·|]+$', '')"


CANDIDATES = f"""
leveled AS (SELECT u.*, level FROM units u JOIN levels l ON l.document_id = u.document_id AND l.size = round_even(u.font_size * 2, 0) / 2),
gated AS (SELECT document_id, ord FROM leveled WHERE level LIKE 'h%' OR len(string_split(text, ' ')) <= 16),
gated_phrases AS (
  SELECT p.document_id, p.ord, words, count(*) OVER (PARTITION BY p.document_id, p.ord) AS parts, row_number() OVER (PARTITION BY p.document_id, p.ord ORDER BY chunk, island, part) AS k
  FROM phrases p JOIN gated g ON g.document_id = p.document_id AND g.ord = p.ord),
generated AS (
  SELECT document_id, 0 AS g, ord, 0 AS k, {cleaned("text")} AS text, 'unit' AS source FROM units
  UNION ALL SELECT document_id, 1, ord, k, {cleaned("array_to_string(words, ' ')")}, 'subphrase' FROM gated_phrases WHERE parts >= 2 AND len(words) >= 2
  UNION ALL SELECT document_id, 2, a, b, {cleaned("text")}, 'composed' FROM chains),
keyed AS (SELECT *, array_to_string({LEXICAL.format("text")}, ' ') AS key FROM generated WHERE length(text) >= 6),
first_keys AS (
  SELECT document_id, key, min({{'g': g, 'ord': ord, 'k': k, 'text': text}}) AS f, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM keyed WHERE key <> '' GROUP BY document_id, key),
candidates AS (
  SELECT c.document_id, c.key, c.f.text AS text, c.sources, u.ord, u.page, u.y, u.x, u.page_height, u.bold, u.level
  FROM first_keys c JOIN leveled u ON u.document_id = c.document_id AND u.ord = c.f.ord)"""


def _mean(name: str, condition: str) -> str:
    return f"coalesce({r4(f'(coalesce(sum(CASE WHEN {condition} THEN coalesce({name}, 0) END), 0) / sqrt(nullif(count_if({condition}), 0)))')}, 0) AS {name}"


_PLAIN = "NOT regexp_matches(w, '^[0-9]+$')"
_HARD, _STOP = f"list_contains({listed('hard_stopwords')}, w)", f"list_contains({listed('connectors', 'hard_stopwords')}, w)"
_SCALED = ", ".join(f"CASE WHEN max({c}) OVER d - min({c}) OVER d < 1e-9 THEN 0.5 ELSE ({c} - min({c}) OVER d) / (max({c}) OVER d - min({c}) OVER d) END AS {c}" for c in ("rake", "bm25", "textrank"))
_LEVEL = "CASE level " + " ".join(f"WHEN '{n}' THEN {v}::DOUBLE" for n, v in C["level_scores"].items()) + " ELSE 0.2::DOUBLE END"
SOURCES = tuple(C["fusion_weights"])


def fused_total(enabled=SOURCES) -> str:
    """The score of candidates with some of the sources."""
    parts = [r4(f"({n} * {C['fusion_weights'][n]}::DOUBLE)") for n in SOURCES if n in enabled]
    parts += [f"CASE WHEN {n} THEN {v}::DOUBLE ELSE 0 END" for n, v in C["fusion_penalties"].items()]
    return r4("(0e0 + " + " + ".join(parts) + ")")


FUSED = f"""
candidate_words AS (SELECT document_id, key, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT document_id, key, string_split(key, ' ') AS ws FROM candidates)),
known_words AS (
  SELECT c.document_id, c.key, c.i, c.w, r.score AS rake, b.score AS bm25, t.score AS textrank FROM candidate_words c LEFT JOIN rake r ON r.document_id = c.document_id AND r.word = c.w
  LEFT JOIN bm25 b ON b.document_id = c.document_id AND b.word = c.w LEFT JOIN textrank t ON t.document_id = c.document_id AND t.word = c.w),
phrase_means AS (
  SELECT document_id, key, {_mean("rake", f"length(w) >= 2 AND NOT {_HARD}")}, {_mean("bm25", f"length(w) >= 2 AND {_PLAIN} AND NOT {_STOP}")}, {_mean("textrank", f"length(w) > 2 AND {_PLAIN} AND NOT {_STOP}")}
  FROM known_words GROUP BY document_id, key),
first_pages_of AS (SELECT document_id, arg_min(page, ord) AS first_page FROM units GROUP BY document_id),
sourced AS (
  SELECT c.*, {r4(f"(CASE WHEN bold AND level IN ('body', 'h3', 'h4') THEN least(0.72::DOUBLE, {_LEVEL} + 0.12::DOUBLE) ELSE {_LEVEL} END)")} AS typography, {r4("(1 - greatest(0, least(1, y / page_height)))")} AS position,
    CAST(list_contains(string_split(sources, ','), 'composed') AS INTEGER)::DOUBLE AS graph_bonus, p.presentability, m.rake, m.bm25, m.textrank, list_has_any({LEXICAL.format("c.text")}, {listed("furniture")}) AS furniture,
    level = 'outlier' AS noise, page > first_page AS not_first_page
  FROM candidates c JOIN presentability p ON p.document_id = c.document_id AND p.key = c.key JOIN phrase_means m ON m.document_id = c.document_id AND m.key = c.key JOIN first_pages_of f ON f.document_id = c.document_id),
scaled AS (SELECT * EXCLUDE (rake, bm25, textrank), {_SCALED} FROM sourced WINDOW d AS (PARTITION BY document_id)),
fused AS (SELECT *, {fused_total()} AS score FROM scaled)"""


def election(source: str, name: str) -> str:
    """The greedy choice of three labels of each document of a table of scored candidates, as a table `name`."""
    tokens = f"list_distinct(list_filter(string_split(key, ' '), lambda w: NOT {_STOP}))"
    same = "len(list_filter(e.tokens, lambda t: len(list_intersect(t, l.own)) / nullif(least(len(t), len(l.own)), 0) >= 0.7)) > 0"
    kept = lambda old, new: f"CASE WHEN {same} THEN e.{old} ELSE list_append(e.{old}, l.{new}) END AS {old}"
    return f"""
{name}_order AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY score DESC, page, y, x, key) AS k, {tokens} AS own FROM {source}),
{name}_steps AS (
  SELECT document_id, k, [text] AS texts, [score] AS scores, [presentability] AS shapes, [own] AS tokens, 0 AS gone FROM {name}_order WHERE k = 1
  UNION ALL
  SELECT l.document_id, l.k, {kept("texts", "text")}, {kept("scores", "score")}, {kept("shapes", "presentability")}, {kept("tokens", "own")}, e.gone + CASE WHEN {same} THEN 1 ELSE 0 END
  FROM {name}_steps e JOIN {name}_order l ON l.document_id = e.document_id AND l.k = e.k + 1 WHERE len(e.texts) < 3),
{name}_last AS (SELECT * FROM {name}_steps QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY k DESC) = 1),
{name} AS (SELECT document_id, CAST(unnest(range(1, len(texts) + 1)) AS INTEGER) AS rank, unnest(texts) AS text, unnest(scores) AS score, unnest(shapes) AS presentability FROM {name}_last)"""


LABELS = election("fused", "labels")
_MARGIN = r4("coalesce(scores[1] - scores[2], scores[1])")
LABEL_STATES = f"""
SELECT document_id, n AS candidates, {_MARGIN} AS margin, CASE WHEN {_MARGIN} >= 99 THEN 'auto' WHEN {_MARGIN} >= 0.1 THEN 'review' ELSE 'escalate' END AS confidence, CAST(least(gone, 10) AS BIGINT) AS suppressed
FROM labels_last JOIN (SELECT document_id, count(*) AS n FROM fused GROUP BY document_id) USING (document_id)"""


def _f1(a: str, b: str) -> str:
    x, y = evaluation_tokens(a), evaluation_tokens(b)
    return f"CASE WHEN len(list_intersect({x}, {y})) > 0 THEN 2 * len(list_intersect({x}, {y})) / (len({x}) + len({y})) ELSE 0 END"


LABEL_METRICS = f"""
SELECT count(*) AS documents, {_share("(first >= 0.7)")} AS top1, {_share("(best >= 0.7)")} AS top3, floor(avg(first) * 10000 + 0.5) / 10000 AS mean_f1, {_share("(words BETWEEN 2 AND 12)")} AS binder_shaped,
  floor(avg(shape) * 10000 + 0.5) / 10000 AS presentability, floor(avg(words) * 10 + 0.5) / 10 AS mean_words, floor(avg(n) * 10 + 0.5) / 10 AS mean_candidates
FROM (
  SELECT l.document_id, max(CASE WHEN rank = 1 THEN f1 END) AS first, max(f1) AS best, max(CASE WHEN rank = 1 THEN len(string_split(text, ' ')) END) AS words, max(CASE WHEN rank = 1 THEN presentability END) AS shape
  FROM (SELECT l.*, {_f1("l.text", "h.title")} AS f1 FROM labels l JOIN harvest h ON h.document_id = l.document_id) l GROUP BY l.document_id)
JOIN (SELECT document_id, count(*) AS n FROM fused GROUP BY document_id) USING (document_id)"""
_MASKS = " UNION ALL ".join(f"SELECT s.* REPLACE ('{m or 'none'}|' || s.document_id AS document_id), {fused_total([x for x in SOURCES if x != m])} AS score FROM scaled s JOIN harvest h ON h.document_id = s.document_id" for m in (None, *SOURCES))
ABLATED = f"""
masked AS ({_MASKS}),""" + election("masked", "ablated")
ABLATION = f"""
, matched AS (SELECT split_part(a.document_id, '|', 1) AS disabled, h.document_id, rank, {_f1("a.text", "h.title")} >= 0.7 AS fits FROM ablated a JOIN harvest h ON h.document_id = substr(a.document_id, instr(a.document_id, '|') + 1)),
by_document AS (SELECT disabled, document_id, max(CAST(fits AND rank = 1 AS INTEGER)) AS one, max(CAST(fits AS INTEGER)) AS three FROM matched GROUP BY disabled, document_id),
shares AS (SELECT disabled, count(*) AS documents, floor(avg(one) * 10000 + 0.5) / 10000 AS top1, floor(avg(three) * 10000 + 0.5) / 10000 AS top3 FROM by_document GROUP BY disabled),
deltas AS (SELECT s.*, {r4("(s.top1 - f.top1)")} AS delta_top1, {r4("(s.top3 - f.top3)")} AS delta_top3 FROM shares s, (SELECT * FROM shares WHERE disabled = 'none') f)
SELECT *, CASE WHEN delta_top1 <= -0.02 THEN 'load-bearing' WHEN delta_top1 >= 0.02 THEN 'HARMFUL - drop or re-weight' ELSE 'no measurable effect' END AS verdict FROM deltas"""


def chain(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


def _segment_titles() -> str:
    from quirelight.plans import sql_segments as G

    pages = """
web_pages AS (
  SELECT document_id, page, string_agg(text, chr(10) ORDER BY ord) AS raw_text, 612.0::DOUBLE AS width, 792.0::DOUBLE AS height, 0 AS rotation, 0 AS image_count, ['Web'] AS font_families FROM units GROUP BY document_id, page)"""
    heads = """
segment_heads AS (
  SELECT g.document_id, segment_index, start_page, unnest(range(start_page, least(end_page, start_page + 1 + CAST(is_slip_sheet AS INTEGER)) + 1)) AS page FROM segments g JOIN census c ON c.document_id = g.document_id AND c.page = g.start_page),
head_units AS (
  SELECT u.* REPLACE (u.document_id || '#' || segment_index AS document_id), start_page AS segment_start FROM units u JOIN segment_heads h ON h.document_id = u.document_id AND h.page = u.page)"""
    own = lambda x: x.replace("FROM units", "FROM head_units").replace("CASE WHEN page > 1 THEN", "CASE WHEN page > segment_start THEN").replace(" scores AS", " title_scores_of AS").replace("\nscores AS", "\ntitle_scores_of AS").replace("FROM scores", "FROM title_scores_of")
    series = (G.measured("web_pages"), G.TOKENS, G.SERIES, G.CENSUS, G.SEAMS, G.SCORES, G.decisions("aggressive"), G.SEGMENTS)
    return chain(SPANS, UNITS, pages, *series, heads, own(TYPOGRAPHY), own(FEATURES), own(SCORES), own(TITLES)) + "SELECT document_id, title, candidate, ord, score, margin, confidence FROM titles"


SEGMENT_TITLES = _segment_titles()
