"""DuckDB SQL of the census and of segmentation, as chains of common tables."""

from quirelight import contracts

C = contracts.load("segmentation")
STOP = ", ".join(f"'{w}'" for w in contracts.load("identity")["token_stopwords"])
#: Columns of a page that a seam compares, and when each signal fires; written out apart from the operator.
SIDES = "modality size_class orientation width height label_num label_total font_families header_sig footer_sig rotation is_blank is_slip_sheet ends_mid_sentence starts_lowercase stamp_prefix stamp_number in_series tokens".split()
CONDITIONS = {
    "slip_sheet_ahead": "b_is_slip_sheet",
    "bates_prefix_change": "a_in_series AND b_in_series AND a_stamp_prefix <> b_stamp_prefix",
    "bates_number_gap": "a_in_series AND b_in_series AND a_stamp_prefix = b_stamp_prefix AND b_stamp_number <> a_stamp_number + 1",
    "modality_flip": "a_modality <> b_modality",
    "page_size_change": "a_orientation <> b_orientation OR a_size_class <> b_size_class OR (a_size_class = 'other' AND (abs(a_width - b_width) > 0.05 * greatest(a_width, b_width) OR abs(a_height - b_height) > 0.05 * greatest(a_height, b_height)))",
    "page_label_restart": "b_label_num <= a_label_num OR (a_label_num IS NOT NULL AND b_label_num IS NOT NULL AND a_label_total <> b_label_total)",
    "font_family_change": "font_overlap < 0.5",
    "running_header_change": "a_header_sig <> '' AND b_header_sig <> '' AND p_header = a_header_sig AND b_header_sig <> a_header_sig",
    "vocabulary_change": "vocab_median > 0 AND vocab_overlap <= 0.45 * vocab_median",
    "rotation_change": "a_rotation <> b_rotation",
    "blank_page": "a_is_blank",
    "slip_sheet_behind": "a_is_slip_sheet AND NOT b_is_slip_sheet",
    "running_header_match": "a_header_sig <> '' AND b_header_sig = a_header_sig",
    "running_header_alternates": "b_header_sig <> '' AND b_header_sig = p_header AND (a_header_sig = '' OR a_header_sig <> b_header_sig)",
    "running_footer_match": "a_footer_sig <> '' AND b_footer_sig = a_footer_sig AND a_footer_sig <> a_header_sig",
    "page_label_continues": "b_label_num - a_label_num = 1 AND a_label_total = b_label_total",
    "bates_consecutive": "a_in_series AND b_in_series AND a_stamp_prefix = b_stamp_prefix AND b_stamp_number = a_stamp_number + 1",
    "sentence_continuation": "a_ends_mid_sentence AND b_starts_lowercase",
}
r3 = "floor(abs({0}) * 1000 + 0.5) / 1000".format
#: As in functions/text.py.
SIZES = [("Letter", 612.0, 792.0), ("Legal", 612.0, 1008.0), ("A4", 595.0, 842.0), ("A3", 842.0, 1191.0), ("Ledger", 792.0, 1224.0), ("Executive", 522.0, 756.0)]
SIZE_CLASS = "CASE " + " ".join(f"WHEN abs(least(width, height) - {w}) <= {w} * 0.05 AND abs(greatest(width, height) - {h}) <= {h} * 0.05 THEN '{n}'" for n, w, h in SIZES) + " ELSE 'other' END"

DOC_PAGES = """
doc_pages AS (
  SELECT source AS document_id, CAST(row_number() OVER (PARTITION BY source ORDER BY lang, doc_id) AS INTEGER) AS page,
         CAST(row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS INTEGER) AS k, CAST(count(*) OVER (PARTITION BY source, lang) AS INTEGER) AS n,
         doc_id, lang, coalesce(text, '') AS text, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) AS s
  FROM documents WHERE source IS NOT NULL)"""
STAMPED = """
stamped AS (
  SELECT document_id, page, lang, k, s,
         CASE WHEN doc_id % 29 = 0 THEN '' ELSE concat_ws(chr(10),
           CASE WHEN s % 4 = 0 THEN 'SRC' || s || ' RECORD ' || k END,
           CASE WHEN s % 2 = 0 THEN 'Page ' || k || ' of ' || n END,
           text,
           CASE WHEN s % 3 <> 2 THEN 'PRD' || translate(CAST(s AS VARCHAR), '0123456789', 'ABCDEFGHIJ') || CASE WHEN s % 3 = 1 THEN upper(lang) ELSE '' END
             || lpad(CAST(100 + page + CASE WHEN doc_id % 53 = 0 THEN 500 ELSE 0 END AS VARCHAR), 6, '0') END) END AS raw_text,
         CAST(CASE WHEN lang = 'de' THEN CASE WHEN doc_id % 37 = 0 THEN 842 ELSE 595 END ELSE CASE WHEN doc_id % 37 = 0 THEN 792 ELSE 612 END END AS DOUBLE) AS width,
         CAST(CASE WHEN lang = 'de' THEN CASE WHEN doc_id % 37 = 0 THEN 595 ELSE 842 END ELSE CASE WHEN doc_id % 37 = 0 THEN 612 ELSE 792 END END AS DOUBLE) AS height,
         CASE WHEN doc_id % 41 = 0 THEN 90 ELSE 0 END AS rotation, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS image_count,
         CASE lang WHEN 'en' THEN ['TimesNewRoman'] WHEN 'fr' THEN ['Arial'] WHEN 'de' THEN ['CourierNew'] ELSE ['Arial', 'Georgia'] END AS font_families
  FROM doc_pages)"""


def measured(source: str) -> str:
    """The census columns of a table of raw pages."""
    return rf"""
normed AS (SELECT *, trim(regexp_replace(raw_text, '\s+', ' ', 'g')) AS norm,
  list_filter(list_transform(string_split(raw_text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines FROM {source}),
measured AS (
  SELECT *, CAST(length(norm) AS INTEGER) AS char_count, CAST(CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS INTEGER) AS word_count, CAST(len(lines) AS INTEGER) AS line_count,
    CASE WHEN norm <> '' THEN 'native' ELSE 'scanned' END AS modality, {SIZE_CLASS} AS size_class,
    CASE WHEN (CASE WHEN rotation IN (90, 270) THEN height ELSE width END) > (CASE WHEN rotation IN (90, 270) THEN width ELSE height END) THEN 'landscape' ELSE 'portrait' END AS orientation,
    nullif(regexp_extract_all(raw_text, '\b([A-Z]{{3,8}})[-_]?([0-9]{{4,10}})\b', 1)[-1], '') AS stamp_prefix,
    nullif(regexp_extract_all(raw_text, '\b([A-Z]{{3,8}})[-_]?([0-9]{{4,10}})\b', 2)[-1], '') AS stamp_digits,
    TRY_CAST(nullif(regexp_extract(norm, '(?i)\bPage\s+([0-9]{{1,4}})\s*(?:of|/)\s*([0-9]{{1,4}})\b', 1), '') AS INTEGER) AS label_num,
    TRY_CAST(nullif(regexp_extract(norm, '(?i)\bPage\s+([0-9]{{1,4}})\s*(?:of|/)\s*([0-9]{{1,4}})\b', 2), '') AS INTEGER) AS label_total,
    coalesce(left(lower(regexp_replace(lines[1], '[0-9]', '#', 'g')), 48), '') AS header_sig,
    coalesce(left(lower(regexp_replace(lines[-1], '[0-9]', '#', 'g')), 48), '') AS footer_sig,
    norm <> '' AND instr('.!?:;”’")]}}', right(norm, 1)) = 0 AS ends_mid_sentence,
    regexp_matches(regexp_extract(norm, '(\p{{L}})', 1), '\p{{Ll}}') AS starts_lowercase,
    left(norm, 160) AS text_head, substr(sha1(norm), 1, 12) AS text_sha,
    regexp_matches(norm, '(?i)intentionally\s+(left\s+)?blank|this\s+page\s+is\s+blank') AS is_spacer,
    length(norm) <= 3 AND image_count = 0 AS is_blank
  FROM normed),
slips AS (
  SELECT *, CAST(stamp_digits AS BIGINT) AS stamp_number,
    NOT is_blank AND NOT is_spacer AND norm <> '' AND word_count <= 15 AND char_count <= 120 AND image_count <= 1 AS is_slip_sheet FROM measured)"""


TOKENS = rf"""
tokens AS (
  SELECT document_id, page, list_sort(list(word)) AS tokens FROM (
    SELECT document_id, page, word, row_number() OVER (PARTITION BY document_id, page ORDER BY count(*) DESC, word) AS rank
    FROM (SELECT document_id, page, lower(unnest(regexp_extract_all(norm, '[A-Za-z][A-Za-z''-]{{3,}}'))) AS word FROM slips)
    WHERE word NOT IN ({STOP}) GROUP BY document_id, page, word) WHERE rank <= 60 GROUP BY document_id, page)"""
SERIES = """
series AS (
  SELECT document_id, stamp_prefix AS prefix, count(*) AS page_count, CAST(max(length(stamp_digits)) AS INTEGER) AS digits, min(stamp_number) AS first, max(stamp_number) AS last, list_sort(list(page)) AS pages
  FROM (SELECT *, stamp_number > lag(stamp_number) OVER (PARTITION BY document_id, stamp_prefix ORDER BY page) AS rises FROM slips WHERE stamp_prefix IS NOT NULL)
  GROUP BY document_id, stamp_prefix
  HAVING count(*) >= 3 AND count(DISTINCT length(stamp_digits)) = 1 AND avg(CAST(rises AS INTEGER)) >= 0.8)"""
CENSUS = """
census AS (
  SELECT p.*, s.prefix IS NOT NULL AS in_series, coalesce(t.tokens, []) AS tokens
  FROM slips p LEFT JOIN series s ON s.document_id = p.document_id AND s.prefix = p.stamp_prefix LEFT JOIN tokens t ON t.document_id = p.document_id AND t.page = p.page)"""
A, B = (", ".join(f"{side}.{c} AS {side}_{c}" for c in SIDES) for side in "ab")
SEAMS = f"""
pairs AS (
  SELECT a.document_id, b.page AS before_page, {A}, {B}, p.header_sig AS p_header
  FROM census a JOIN census b ON b.document_id = a.document_id AND b.page = a.page + 1 LEFT JOIN census p ON p.document_id = a.document_id AND p.page = a.page - 1),
overlapping AS (
  SELECT *, CASE WHEN len(a_font_families) > 0 AND len(b_font_families) > 0 THEN len(list_intersect(a_font_families, b_font_families)) / least(len(a_font_families), len(b_font_families)) END AS font_overlap,
    CASE WHEN least(len(a_tokens), len(b_tokens)) >= {C["min_vocabulary_tokens"]} THEN len(list_intersect(a_tokens, b_tokens)) / least(len(a_tokens), len(b_tokens)) END AS vocab_overlap FROM pairs),
medians AS (SELECT document_id AS m_document, CASE WHEN count(vocab_overlap) >= {C["min_vocabulary_pairs"]} THEN median(vocab_overlap) END AS vocab_median FROM overlapping GROUP BY document_id),
seams AS (
  SELECT *, list_filter([{", ".join(f"CASE WHEN {c} THEN {{'name': '{n}', 'weight': CAST({C['weights'][n]} AS DOUBLE)}} END" for n, c in CONDITIONS.items())}], lambda x: x IS NOT NULL) AS signals
  FROM overlapping JOIN medians ON m_document = document_id)"""
ACTING = "list_filter(signals, lambda s: s.name NOT IN ('vocabulary_change', 'running_header_change'))"
TOTAL = "coalesce(list_sum(list_transform({0}, lambda s: s.weight)), 0)".format
SCORES = f"""
summed AS (SELECT *, greatest(0, {TOTAL(ACTING)}) AS net, {TOTAL("list_filter(signals, lambda s: s.weight > 0)")} AS change FROM seams),
scores AS (SELECT *, {r3("net")} AS score, {r3("change")} AS change_score, len(list_filter({ACTING}, lambda s: s.weight >= {C["strong_min"]})) > 0 AS strong FROM summed)"""


def decisions(policy: str) -> str:
    return f"""
cutting AS (SELECT *, score >= {C["policies"][policy]} AND strong AS is_cut FROM scores),
decisions AS (
  SELECT *, NOT is_cut AND change_score >= {C["candidate_floor"]} AS is_candidate,
    CASE WHEN NOT is_cut AND change_score >= {C["candidate_floor"]} AND {r3("change_score - score")} > 0 THEN {r3("change_score - score")} END AS suppressed FROM cutting)"""


SEGMENTS = """
totals AS (SELECT document_id, max(page) AS total FROM census GROUP BY document_id),
starts AS (
  SELECT document_id, 1 AS start_page, 'document_start' AS opened_by, CAST(NULL AS DOUBLE) AS score FROM totals
  UNION ALL SELECT document_id, before_page, array_to_string(list_transform(signals, lambda s: s.name), ','), score FROM decisions WHERE is_cut),
segments AS (
  SELECT document_id, start_page, opened_by, score, CAST(row_number() OVER w AS INTEGER) AS segment_index, coalesce(lead(start_page) OVER w - 1, total) AS end_page,
    coalesce(lead(start_page) OVER w - 1, total) - start_page + 1 AS page_count
  FROM starts JOIN totals USING (document_id) WINDOW w AS (PARTITION BY document_id ORDER BY start_page))"""
#: A fold over each document's segments: the stack of merged ones, whether the last goes on, and how many merges there were.
REJOINED = """
sides AS (
  SELECT g.*, lead(g.start_page) OVER (PARTITION BY g.document_id ORDER BY g.segment_index) IS NULL AS is_last, p.font_families AS pf, n.font_families AS nf, p.header_sig AS ph, n.header_sig AS nh,
    p.size_class = n.size_class AND p.orientation = n.orientation AND p.modality = n.modality AS alike
  FROM segments g LEFT JOIN census p ON p.document_id = g.document_id AND p.page = g.start_page - 1 LEFT JOIN census n ON n.document_id = g.document_id AND n.page = g.end_page + 1),
inserts AS (
  SELECT *, coalesce(page_count <= 2 AND segment_index > 1 AND NOT is_last AND ((ph <> '' AND ph = nh) OR (alike AND coalesce(len(list_intersect(pf, nf)) / nullif(least(len(pf), len(nf)), 0), 1) >= 0.5)), false) AS is_insert FROM sides),
folding AS (
  SELECT document_id, segment_index AS k, [{'s': start_page, 'e': end_page, 'o': opened_by, 'v': score, 'i': ''}] AS stack, false AS goes_on, 0 AS merges FROM inserts WHERE segment_index = 1
  UNION ALL
  SELECT g.document_id, g.segment_index,
    CASE WHEN f.goes_on OR (g.is_insert AND f.merges < 50)
      THEN list_append(f.stack[:len(f.stack) - 1], {'s': f.stack[-1].s, 'e': g.end_page, 'o': f.stack[-1].o, 'v': f.stack[-1].v,
        'i': CASE WHEN f.goes_on THEN f.stack[-1].i ELSE concat_ws(',', nullif(f.stack[-1].i, ''), g.start_page || '-' || g.end_page) END})
      ELSE list_append(f.stack, {'s': g.start_page, 'e': g.end_page, 'o': g.opened_by, 'v': g.score, 'i': ''}) END,
    NOT f.goes_on AND g.is_insert AND f.merges < 50, f.merges + CASE WHEN NOT f.goes_on AND g.is_insert AND f.merges < 50 THEN 1 ELSE 0 END
  FROM folding f JOIN inserts g ON g.document_id = f.document_id AND g.segment_index = f.k + 1),
stacks AS (SELECT * FROM folding QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY k DESC) = 1),
rejoined AS (
  SELECT document_id, CAST(i AS INTEGER) AS segment_index, x.s AS start_page, x.e AS end_page, x.e - x.s + 1 AS page_count, x.o AS opened_by, x.v AS score, x.i AS inserts
  FROM (SELECT document_id, unnest(stack) AS x, unnest(range(1, len(stack) + 1)) AS i FROM stacks))"""
REFINED = f"""
page_parts AS (
  SELECT document_id, page, left(raw_text, 40) AS part, 16.0::DOUBLE AS size FROM stamped
  UNION ALL SELECT document_id, page, substr(raw_text, 41), CASE lang WHEN 'en' THEN 10.0::DOUBLE WHEN 'fr' THEN 11.5::DOUBLE WHEN 'de' THEN 9.0::DOUBLE ELSE 13.0::DOUBLE END FROM stamped),
page_sizes AS (SELECT document_id, page, size, sum(length(part)) / sum(sum(length(part))) OVER (PARTITION BY document_id, page) AS share FROM page_parts WHERE part <> '' GROUP BY document_id, page, size),
sized_pairs AS (
  SELECT s.document_id, s.before_page, z.size, sum(CASE WHEN z.page = s.before_page THEN share ELSE 0 END) AS after, sum(CASE WHEN z.page < s.before_page THEN share ELSE 0 END) AS before
  FROM scores s JOIN page_sizes z ON z.document_id = s.document_id AND z.page BETWEEN s.before_page - 1 AND s.before_page WHERE s.score >= 0.7 AND s.score < 1.5 GROUP BY s.document_id, s.before_page, z.size),
distances AS (SELECT document_id, before_page, sum(abs(after - before)) AS l1 FROM sized_pairs GROUP BY document_id, before_page HAVING sum(after) > 0 AND sum(before) > 0),
resigned AS (
  SELECT s.* EXCLUDE (signals, net, change, score, change_score, strong), d.l1 IS NOT NULL AS refined, CASE WHEN d.l1 > 0.6 THEN list_append(signals, {{'name': 'font_size_change', 'weight': 0.6::DOUBLE}}) ELSE signals END AS signals
  FROM scores s LEFT JOIN distances d ON d.document_id = s.document_id AND d.before_page = s.before_page),
resummed AS (SELECT *, greatest(0, {TOTAL(ACTING)}) AS net, {TOTAL("list_filter(signals, lambda s: s.weight > 0)")} AS change FROM resigned),
refined AS (SELECT *, {r3("net")} AS score, {r3("change")} AS change_score, len(list_filter({ACTING}, lambda s: s.weight >= 1.0)) > 0 AS strong FROM resummed)"""
SINGLES = DOC_PAGES.replace("FROM documents WHERE source IS NOT NULL", "FROM documents d WHERE source IS NOT NULL AND lang = (SELECT min(lang) FROM documents e WHERE e.source = d.source)")
CONVERSATIONS = """
conversation_pages AS (
  SELECT CAST(conv_id AS VARCHAR) AS document_id, CAST(turn + 1 AS INTEGER) AS page, coalesce(text, '') AS raw_text, 612.0::DOUBLE AS width, 792.0::DOUBLE AS height, 0 AS rotation, 0 AS image_count, [role] AS font_families FROM conversations)"""
TRUTH = """
truth AS (
  SELECT document_id, page AS before_page, k = 1 AS is_seam,
    CASE WHEN s % 2 = 0 THEN 'easy' WHEN s % 3 = 2 THEN 'hard' ELSE 'medium' END AS difficulty,
    CASE WHEN s % 4 = 0 THEN 'binder' WHEN s % 3 = 2 THEN 'mixed' ELSE 'stamped' END AS scenario
  FROM stamped WHERE page > 1)"""


def evaluation(groups: str, select: str, floor: str = "") -> str:
    r4 = "coalesce(floor({0} / nullif({1}, 0) * 10000 + 0.5) / 10000, 0)".format
    return f"""
counts AS (
  SELECT {select} CAST(count_if(is_cut AND is_seam) AS BIGINT) AS tp, CAST(count_if(is_cut AND NOT is_seam) AS BIGINT) AS fp, CAST(count_if(NOT is_cut AND is_seam) AS BIGINT) AS fn, count_if(is_candidate AND is_seam) AS assisted
  FROM decisions JOIN truth USING (document_id, before_page) {floor} {groups})
SELECT {select} tp, fp, fn, {r4("tp", "(tp + fp)")} AS precision, {r4("tp", "(tp + fn)")} AS recall, {r4("2 * tp", "(2 * tp + fp + fn)")} AS f1, {r4("(tp + assisted)", "(tp + fn)")} AS assisted_recall FROM counts"""


def chain(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


PAGES = (DOC_PAGES, STAMPED, measured("stamped"))
UP_TO_SERIES = (*PAGES, SERIES)
UP_TO_CENSUS = (*PAGES, TOKENS, SERIES, CENSUS)
UP_TO_SCORES = (*UP_TO_CENSUS, SEAMS, SCORES)


def up_to_decisions(policy: str = "balanced") -> tuple[str, ...]:
    return (*UP_TO_SCORES, decisions(policy))
