"""DuckDB SQL of compounds of four scenarios: their plan, parts, pages, seams and evaluation."""

from quirelight.plans import sql_segments as Q
from quirelight.sources import scenarios as G

SEED, LONG = 20240607, 6


def number(tag: str, key: str = "number") -> str:
    return f"CAST('0x' || left(md5('{SEED}:{tag}:' || {key}), 8) AS BIGINT)"


SOURCES = """
source_pages AS (
  SELECT CAST(conv_id AS VARCHAR) AS source_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS page, CASE WHEN conv_id % 9 = 4 THEN '' ELSE text END AS raw_text,
    CASE conv_id % 3 WHEN 0 THEN 612.0::DOUBLE ELSE 595.0::DOUBLE END AS width, CASE conv_id % 3 WHEN 0 THEN 792.0::DOUBLE ELSE 842.0::DOUBLE END AS height, CAST(conv_id % 9 = 4 AS INTEGER) AS image_count,
    CASE WHEN conv_id % 9 = 4 THEN [] WHEN conv_id % 3 = 0 THEN ['TimesNewRoman'] WHEN conv_id % 3 = 1 THEN ['Arial'] ELSE ['Arial', 'CourierNew'] END AS font_families
  FROM (SELECT conv_id, turn, min(coalesce(text, '')) AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn)),
profiles AS (
  SELECT source_id, CAST(count(*) AS INTEGER) AS pages, bool_or(page = 1 AND trim(regexp_replace(raw_text, '\\s+', ' ', 'g')) <> '') AS native,
    replace(array_to_string(any_value(font_families), '|'), 'TimesNewRoman', 'TimesNewRoman-Bold') AS families, CAST(round_even(any_value(width) / 10, 0) AS BIGINT) AS wide, CAST(round_even(any_value(height) / 10, 0) AS BIGINT) AS high
  FROM source_pages GROUP BY source_id)"""
PLACES = f"""
producers AS (
  SELECT *, 'producer' || row_number() OVER (ORDER BY n DESC, families, wide, high) AS producer
  FROM (SELECT families, wide, high, count(*) AS n FROM profiles WHERE native AND families <> '' GROUP BY ALL HAVING count(*) >= {G.LEAST_OF_PRODUCER} ORDER BY n DESC, families, wide, high LIMIT {G.PRODUCERS})),
in_pools AS (
  SELECT source_id, pages, 'any' AS pool FROM profiles
  UNION ALL SELECT source_id, pages, CASE WHEN native THEN 'native' ELSE 'scanned' END FROM profiles
  UNION ALL SELECT source_id, pages, 'long' FROM profiles WHERE pages >= {LONG}
  UNION ALL SELECT source_id, pages, producer FROM profiles JOIN producers USING (families, wide, high) WHERE native),
places AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY md5('{SEED}:' || source_id), source_id) - 1 AS place, count(*) OVER (PARTITION BY pool) AS size FROM in_pools),
sizes AS (SELECT pool, any_value(size) AS size FROM places GROUP BY pool)"""
_ENTRIES = ", ".join(f"'{s}'" for s, n in G.PLAN.items() for _ in range(n))
PLANNED = f"""
entries AS (
  SELECT round, entry, ([{_ENTRIES}])[entry + 1] AS scenario
  FROM range(CAST((SELECT ceil(count(*) / {G.DOCUMENTS_A_ROUND}) FROM profiles) AS BIGINT)) r(round), range({sum(G.PLAN.values())}) e(entry)),
planned AS (SELECT round * {sum(G.PLAN.values())} + row_number() OVER (PARTITION BY round ORDER BY md5('{SEED}:plan:' || round || ':' || entry), entry) - 1 AS number, scenario FROM entries),
usable AS (
  SELECT number, 3 + {number("want")} % 2 AS want, (SELECT count(*) FROM sizes WHERE starts_with(pool, 'producer') AND size >= 3 + {number("want")} % 2) AS kinds
  FROM planned WHERE scenario = 'bates_production'),
wanted AS (
  SELECT number, i AS slot, 'exhibit' AS kind, 'any' AS pool, number * 5 + i AS nth, NULL::INTEGER AS rotation
  FROM planned, range(5) s(i) WHERE scenario = 'exhibit_binder' AND i < 3 + {number("binder")} % 3
  UNION ALL SELECT number, i, CASE WHEN kinds > 0 THEN 'production_same_producer' ELSE 'production' END, CASE WHEN kinds > 0 THEN 'producer' || (1 + {number("producer")} % kinds) ELSE 'any' END, number * 4 + i, NULL
  FROM usable, range(4) s(i) WHERE i < want
  UNION ALL SELECT number, row_number() OVER (PARTITION BY number ORDER BY md5('{SEED}:mixed:' || number || ':' || k)) - 1, kind, pool, nth, rotation
  FROM (SELECT number, k, CASE k WHEN 1 THEN 'landscape_plate' WHEN 3 THEN 'scanned_exhibit' ELSE 'native_filing' END AS kind,
      CASE WHEN k = 3 THEN 'scanned' WHEN EXISTS (FROM sizes WHERE pool = 'native') THEN 'native' ELSE 'any' END AS pool, CASE WHEN k = 3 THEN number ELSE number * 3 + k END AS nth, CASE WHEN k = 1 THEN 90 END AS rotation
    FROM planned, range(4) s(k) WHERE scenario = 'mixed_intake' AND (k < 3 OR EXISTS (FROM sizes WHERE pool = 'scanned')))
  UNION ALL SELECT number, 0, 'single', CASE WHEN EXISTS (FROM sizes WHERE pool = 'long') THEN 'long' ELSE 'any' END, number, NULL FROM planned WHERE scenario = 'single_document')"""
_MOST = " ".join(f"WHEN '{s}' THEN {n}" for s, n in G.MOST_PAGES.items())
_PREFIXES = ", ".join(f"'{p}'" for p in G.PREFIXES)
TAKEN = f"""
taken AS (
  SELECT w.number, scenario, CAST(slot AS INTEGER) AS slot, kind, source_id, CAST(least(pages, CASE scenario {_MOST} END) AS INTEGER) AS pages, rotation
  FROM wanted w JOIN planned p ON p.number = w.number JOIN sizes z ON z.pool = w.pool JOIN places d ON d.pool = w.pool AND d.place = w.nth % z.size),
parts AS (
  SELECT printf('compound_%06d_%s', number, scenario) AS document_id, scenario, slot, kind, source_id, pages, end_page - pages + 1 AS start_page, end_page, rotation,
    CASE WHEN scenario = 'bates_production' THEN ([{_PREFIXES}])[1 + {number("prefix")} % {len(G.PREFIXES)}] END AS stamp_prefix,
    CASE WHEN scenario = 'bates_production' THEN 1 + {number("first")} % 400 END AS stamp_first
  FROM (SELECT *, CAST(sum(pages + CASE WHEN scenario <> 'exhibit_binder' THEN 0 WHEN slot = 0 THEN 2 ELSE 1 END) OVER (PARTITION BY number ORDER BY slot) AS INTEGER) AS end_page FROM taken))"""
PARTS = (SOURCES, PLACES, PLANNED, TAKEN)
_COVER = " || chr(10) || ".join(f"'{line}'" for line in G.COVER.split("\n"))
_SHEET = "612.0::DOUBLE, 792.0::DOUBLE, 0, 0, ['Helvetica']"
PAGES = f"""
compound_pages AS (
  SELECT document_id, start_page + page - 1 AS page, CASE WHEN stamp_prefix IS NULL THEN raw_text ELSE concat_ws(chr(10), nullif(raw_text, ''), stamp_prefix || printf('%06d', stamp_first + start_page + page - 2)) END AS raw_text,
    width, height, coalesce(rotation, 0) AS rotation, image_count, font_families
  FROM parts t JOIN source_pages s ON s.source_id = t.source_id AND s.page <= t.pages
  UNION ALL SELECT document_id, start_page - 1, 'EXHIBIT ' || chr(65 + slot), {_SHEET} FROM parts WHERE scenario = 'exhibit_binder'
  UNION ALL SELECT document_id, 1, {_COVER}, {_SHEET} FROM parts WHERE scenario = 'exhibit_binder' AND slot = 0)"""
SEAMS = """
known_seams AS (
  SELECT document_id, start_page - 1 AS before_page, 'easy' AS difficulty, scenario, 'slip_sheet_announces_boundary' AS reason FROM parts WHERE scenario = 'exhibit_binder'
  UNION ALL SELECT document_id, start_page, 'hard', scenario, 'continuous_bates_run' || substr(kind, 11) FROM parts WHERE scenario = 'bates_production' AND slot > 0
  UNION ALL SELECT document_id, start_page, 'medium', scenario, 'producer_change_' || kind FROM parts WHERE scenario = 'mixed_intake' AND slot > 0)"""
DECIDED = (Q.measured("compound_pages"), Q.TOKENS, Q.SERIES, Q.CENSUS, Q.SEAMS, Q.SCORES, Q.decisions("balanced"))
OUTCOMES = """
outcomes AS (
  SELECT document_id, before_page, bool_or(what = 'cut') AS is_cut, bool_or(what = 'candidate') AS is_candidate, bool_or(what = 'seam') AS is_seam
  FROM (SELECT document_id, start_page AS before_page, 'cut' AS what FROM rejoined WHERE segment_index > 1 UNION ALL SELECT document_id, before_page, 'candidate' FROM decisions WHERE is_candidate UNION ALL SELECT document_id, before_page, 'seam' FROM known_seams)
  GROUP BY document_id, before_page)"""
BY_DOCUMENT = """
by_document AS (
  SELECT p.document_id, scenario, CAST(count(*) FILTER (is_seam) AS BIGINT) AS true_seams, CAST(count(*) FILTER (is_cut AND is_seam) AS BIGINT) AS tp, CAST(count(*) FILTER (is_cut AND NOT is_seam) AS BIGINT) AS fp, CAST(count(*) FILTER (NOT is_cut AND is_seam) AS BIGINT) AS fn,
    coalesce(string_agg(before_page, ',' ORDER BY before_page) FILTER (NOT is_cut AND is_seam AND is_candidate), '') AS recovered,
    coalesce(string_agg(before_page, ',' ORDER BY before_page) FILTER (NOT is_cut AND is_seam AND NOT is_candidate), '') AS missed
  FROM (SELECT DISTINCT document_id, scenario FROM parts) p LEFT JOIN outcomes o ON o.document_id = p.document_id GROUP BY p.document_id, scenario)"""
_SHARE = "floor({0} / count(*) * 10000 + 0.5) / 10000".format
BY_DIFFICULTY = f"""SELECT difficulty, count(*) AS total, CAST(count_if(is_cut) AS BIGINT) AS found, CAST(count_if(NOT is_cut AND is_candidate) AS BIGINT) AS candidate,
  {_SHARE("count_if(is_cut)")} AS recall, {_SHARE("count_if(is_cut OR is_candidate)")} AS assisted_recall
FROM known_seams JOIN outcomes USING (document_id, before_page) GROUP BY difficulty"""
BY_SCENARIO = """SELECT scenario, count(*) AS documents, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
  CASE WHEN sum(tp + fn) > 0 THEN floor(sum(tp) / sum(tp + fn) * 10000 + 0.5) / 10000 END AS recall FROM by_document GROUP BY scenario"""
