"""The registered queries as SQL that DuckDB runs on the same tables.

Normalization is spelled for the characters that the tables hold: spaces and newlines are their only white
space, and of their letters only ß folds to something else than its lower case.
"""

from __future__ import annotations

from ..operators.cleaning import HEADER_INVARIANTS, INVARIANTS
from ..schema import ADDRESS_STOPLIST, LEGAL_STOPLIST, OUTPUT_COLUMNS, PROVENANCE, STRUCTURAL_NOISE, BlockingConfig
from .entities import CONFIG

CAPS = (1, 2, 3, 5, 10)
BLOCK = CONFIG.max_block_size


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _norm(x: str) -> str:
    return f"replace(lower(trim(regexp_replace({x}, ' +', ' ', 'g'))), 'ß', 'ss')"


ENTITIES = f"""
ent AS (
  SELECT doc_id, 'S' || (1 + doc_id % 3) || '-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS entity_id,
         substr(flat, 1, 40) AS business_name, n_chars || ' ' || substr(flat, 41, 60) AS business_address,
         CASE WHEN doc_id % 23 = 0 THEN '' WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS country
  FROM (SELECT *, replace(coalesce(text, ''), chr(10), ' ') AS flat FROM documents)),
cl AS (
  SELECT *, {_norm("business_name")} AS name, {_norm("business_address")} AS address, {_norm("country")} AS ctry,
         substr(entity_id, 1, 2) AS source FROM ent)"""

TOKENS = f"""
tok AS (
  SELECT source, entity_id, ctry, name,
         list_filter(regexp_extract_all(name, '[\\pL\\pN\\pM_]+'), lambda t: length(t) >= 2 AND NOT list_contains({_list(LEGAL_STOPLIST)}, t)) AS name_tokens,
         list_filter(regexp_extract_all(address, '[\\pL\\pN\\pM_]+'), lambda t: length(t) >= 2 AND NOT regexp_full_match(t, '[0-9]+')) AS plain,
         regexp_extract_all(address, '[0-9]+') AS numbers,
         regexp_replace(name, '[^\\pL\\pN\\pM]', '', 'g') AS compact FROM cl),
tk AS (
  SELECT *, list_filter(plain, lambda t: NOT list_contains({_list(ADDRESS_STOPLIST)}, t)) AS addr_tokens,
         CASE WHEN len(list_filter(plain, lambda t: NOT list_contains({_list(STRUCTURAL_NOISE)}, t))) > 0
              THEN list_filter(plain, lambda t: NOT list_contains({_list(STRUCTURAL_NOISE)}, t)) ELSE plain END AS telling,
         CASE WHEN length(compact) < 3 THEN CAST([] AS VARCHAR[]) WHEN length(compact) < 4 THEN [compact]
              ELSE list_transform(range(1, length(compact) - 2), lambda i: substr(compact, i, 4)) END AS ngrams FROM tok),
kl AS (
  SELECT *, flatten(list_transform(numbers, lambda n: list_transform(telling[1:10], lambda t: n || ':' || t))) AS num_loc FROM tk),
kf AS (
  SELECT source, entity_id, ctry, name, 'name' AS family, name_tokens AS ks FROM kl UNION ALL
  SELECT source, entity_id, ctry, name, 'addr', addr_tokens FROM kl UNION ALL
  SELECT source, entity_id, ctry, name, 'num_loc', num_loc FROM kl UNION ALL
  SELECT source, entity_id, ctry, name, 'ngram', ngrams FROM kl),
k0 AS (
  SELECT source, entity_id, ctry, family, unnest(ks) AS key, generate_subscripts(ks, 1) AS place FROM kf),
k1 AS (
  SELECT source, entity_id, ctry, family, key, min(place) AS place FROM k0 GROUP BY ALL),
k AS (
  SELECT source, entity_id, ctry AS country, family, key, row_number() OVER (PARTITION BY entity_id, family ORDER BY place) AS pos FROM k1)"""

POSTINGS = f"""
s1 AS (SELECT entity_id AS s1_id, ctry AS country, name FROM cl WHERE source = 'S1'),
ca AS (SELECT source, entity_id AS cand_id, ctry AS country, name FROM cl WHERE source <> 'S1'),
asked AS (SELECT entity_id AS s1_id, country, family, pos, key FROM k WHERE source = 'S1'),
posted AS (SELECT source, country, family, key, entity_id AS cand_id FROM k WHERE source <> 'S1' AND (family <> 'ngram' OR country <> '')),
tot AS (SELECT source, count(*) AS total FROM ca GROUP BY source),
freq AS (
  SELECT source, country, family, key, count(*) AS n,
         count(*) > any_value(CASE family WHEN 'name' THEN least({CONFIG.max_name_df_absolute}, greatest(5, floor(total * {CONFIG.max_name_df_relative}::DOUBLE)))
                                          ELSE least({CONFIG.max_addr_df_absolute}, greatest(5, floor(total * {CONFIG.max_addr_df_relative}::DOUBLE))) END) AS filtered
  FROM posted JOIN tot USING (source) GROUP BY source, country, family, key)"""


def _blocks(most: int) -> str:
    return f"""
met AS (SELECT a.*, f.source, f.n, f.filtered FROM asked a JOIN freq f USING (country, family, key) WHERE country <> ''),
usable AS (SELECT * FROM met WHERE NOT filtered),
big AS (SELECT * FROM usable WHERE n > {most}),
partner AS (
  SELECT b.*, u.pos AS pos2, u.key AS key2 FROM big b JOIN usable u USING (s1_id, source, family)
  WHERE CASE WHEN family = 'ngram' THEN abs(b.pos - u.pos) >= {CONFIG.ngram_size} ELSE b.pos <> u.pos END),
wanted AS (SELECT DISTINCT source, country, family, key, key2 FROM partner),
common AS (
  SELECT w.*, p.cand_id FROM wanted w JOIN posted p USING (source, country, family, key)
  JOIN posted q ON q.source = w.source AND q.country = w.country AND q.family = w.family AND q.key = w.key2 AND q.cand_id = p.cand_id),
sizes AS (SELECT source, country, family, key, key2, count(*) AS n2 FROM common GROUP BY ALL HAVING count(*) <= {most}),
refined AS (
  SELECT * FROM partner JOIN sizes USING (source, country, family, key, key2)
  QUALIFY row_number() OVER (PARTITION BY s1_id, source, family, pos ORDER BY pos2) = 1),
whole AS (SELECT * FROM big ANTI JOIN refined USING (s1_id, source, family, pos)),
block_pairs AS (
  SELECT DISTINCT s1_id, source, family, cand_id FROM
    (SELECT s1_id, source, country, family, key FROM usable WHERE n <= {most} UNION ALL SELECT s1_id, source, country, family, key FROM whole)
    JOIN posted USING (source, country, family, key)
  UNION
  SELECT DISTINCT s1_id, source, family, cand_id FROM refined JOIN common USING (source, country, family, key, key2))"""


EXACT = """
exact AS (SELECT s1_id, source, cand_id FROM s1 JOIN ca USING (country, name) WHERE country <> '' AND name <> '')"""

MISSING = """
missing AS (
  SELECT s1_id, source, cand_id FROM s1 JOIN ca USING (name) WHERE s1.country <> '' AND ca.country = '' AND name <> ''
  UNION
  SELECT s1_id, p.source, cand_id FROM asked a JOIN freq f ON f.family = a.family AND f.key = a.key AND f.country = '' AND NOT f.filtered
  JOIN posted p ON p.source = f.source AND p.family = f.family AND p.key = f.key AND p.country = ''
  WHERE a.country <> '' AND a.family IN ('name', 'num_loc'))"""

GLOBAL = """
fallback AS (
  SELECT s1_id, source, cand_id FROM s1 JOIN ca USING (name) WHERE s1.country = '' AND name <> ''
  UNION
  SELECT s1_id, p.source, cand_id FROM asked a JOIN posted p USING (family, key) WHERE a.country = '' AND family IN ('name', 'num_loc'))"""


def _cross(most: int) -> str:
    return f"""
crossed AS (
  SELECT s1_id, source, cand_id FROM s1 JOIN ca USING (name) WHERE s1.country <> '' AND ca.country <> '' AND ca.country <> s1.country AND name <> ''
  UNION
  SELECT s1_id, p.source, cand_id FROM asked a JOIN posted p USING (family, key)
  WHERE family = 'name' AND a.country <> '' AND p.country <> '' AND p.country <> a.country
  GROUP BY s1_id, p.source, cand_id HAVING count(DISTINCT key) >= {CONFIG.cross_country_min_rare_tokens}
  UNION
  SELECT s1_id, source, cand_id FROM (
    SELECT s1_id, p.source, cand_id, count(*) OVER (PARTITION BY s1_id, p.source, key) AS n FROM asked a JOIN posted p USING (family, key)
    WHERE family = 'num_loc' AND a.country <> '' AND p.country <> '' AND p.country <> a.country) WHERE n <= {most})"""


BLOCKS, CROSS = _blocks(BLOCK), _cross(BLOCK)

_BIT = "CASE family " + " ".join(f"WHEN '{f}' THEN {PROVENANCE[p]}" for f, p in (("name", "rare_name_token"), ("addr", "address_token"), ("num_loc", "address_number_location"), ("ngram", "compact_char_ngram"))) + " END"
PAIRS = f"""
pairs AS (
  SELECT s1_id, source, cand_id, CAST(bit_or(bit) AS BIGINT) AS provenance FROM (
    SELECT s1_id, source, cand_id, {PROVENANCE["exact_name"]} AS bit FROM exact UNION ALL
    SELECT s1_id, source, cand_id, {_BIT} FROM block_pairs UNION ALL
    SELECT s1_id, source, cand_id, {PROVENANCE["missing_country_fallback"]} FROM missing UNION ALL
    SELECT s1_id, source, cand_id, {PROVENANCE["missing_country_fallback"]} FROM fallback UNION ALL
    SELECT s1_id, source, cand_id, {PROVENANCE["cross_country_high_specificity"]} FROM crossed)
  GROUP BY s1_id, source, cand_id)"""

_has = lambda p: f"CAST((provenance & {PROVENANCE[p]}) > 0 AS BIGINT)"
TIER = [
    ("exact", _has("exact_name")), ("bits", "CAST(bit_count(provenance) AS BIGINT)"), ("rare", _has("rare_name_token")), ("num_loc", _has("address_number_location")),
    ("addr", _has("address_token")), ("ngram", _has("compact_char_ngram")), ("missing", _has("missing_country_fallback")), ("cross", _has("cross_country_high_specificity")),
]
RANKED = f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY {", ".join(f"{e} DESC" for _, e in TIER)}, cand_id) AS rank_no FROM pairs)"""

TRUTH = """
gt AS (SELECT s1.s1_id, ca.cand_id, ca.source FROM s1 JOIN ca USING (name) WHERE name <> '')"""

RESULTS = """
ids AS (
  SELECT s1_id, CAST(substr(s1_id, 4, 8) AS INT) AS no, list_sort(list_filter(list(cand_id), lambda x: x IS NOT NULL)) AS m
  FROM s1 LEFT JOIN gt USING (s1_id) GROUP BY s1_id),
results AS (
  SELECT s1_id, CASE WHEN no % 10 = 0 THEN list_concat(m, m) WHEN no % 10 = 3 THEN list_concat(m, ['S1-00000001', '']) WHEN no % 10 = 6 THEN list_concat(m, ['S2-unknown']) ELSE m END AS l
  FROM ids WHERE no % 11 <> 5)"""

_ALL = [ENTITIES, TOKENS, POSTINGS, BLOCKS, EXACT, MISSING, GLOBAL, CROSS, PAIRS]
_BY_DEFAULT = BlockingConfig().max_block_size


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_COLUMNS = [("business_name", "business_name"), ("business_address", "business_address"), ("country", "country"), ("business_name_normalized", "name"), ("business_address_normalized", "address"), ("country_normalized", "ctry")]
_TALL = "tall AS (" + " UNION ALL ".join(f"SELECT entity_id, '{c}' AS col, {x} AS val FROM cl" for c, x in _COLUMNS) + ")"
_RAW = "raw3 AS (" + " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS val FROM ent" for c in ("business_name", "business_address", "country")) + ")"


def _keys(expression: str) -> str:
    return _with([ENTITIES, TOKENS], f"SELECT entity_id, coalesce(array_to_string({expression}, ','), '') AS found FROM kl")


def _pass(family: str) -> str:
    return _with([ENTITIES, TOKENS, POSTINGS, BLOCKS], f"SELECT s1_id, cand_id FROM block_pairs WHERE family = '{family}'")


def _df(family: str) -> str:
    return _with([ENTITIES, TOKENS, POSTINGS], f"SELECT source, country, key, n, filtered FROM freq WHERE family = '{family}'")


def _at(p: float) -> str:
    return f"coalesce(min(CASE WHEN below > CAST(floor(total * {p}::DOUBLE) AS BIGINT) THEN v END), 0)"


# The files hold names of several scripts; these are spelled as their bytes are, and folded by hand.
DECORATED = """
dec AS (
  SELECT doc_id, entity_id, business_address, country, substr(entity_id, 1, 2) AS source,
         CASE doc_id % 6 WHEN 0 THEN 'ООО “' || business_name || '”' WHEN 1 THEN business_name || ' cafe' || chr(769) WHEN 2 THEN chr(160) || 'Straße – ' || business_name
                         WHEN 3 THEN 'राम' || chr(8195) || business_name WHEN 4 THEN '株式会社' || business_name ELSE business_name END AS business_name,
         1 + row_number() OVER (PARTITION BY substr(entity_id, 1, 2) ORDER BY doc_id) AS line FROM ent),
dcl AS (
  SELECT *, replace(lower(nfc_normalize(trim(regexp_replace(translate(business_name, '“”–' || chr(160) || chr(8195), '""-  '), ' +', ' ', 'g')))), 'ß', 'ss') AS name,
         NORM_ADDRESS AS address, NORM_COUNTRY AS ctry, trim(business_name) = '' AS no_name, trim(business_address) = '' AS no_address, trim(country) = '' AS no_country FROM dec)""".replace("NORM_ADDRESS", _norm("business_address")).replace("NORM_COUNTRY", _norm("country"))
_FLAG = lambda c: f"CASE WHEN {c} THEN 'True' ELSE 'False' END"
_CELLS = "entity_id, business_name, business_address, country, name, address, ctry"
_LINE = "concat_ws(chr(9), " + _CELLS + ", " + ", ".join(map(_FLAG, ("no_name", "no_address", "no_country"))) + ")"
_HELD = f"CAST('0x' || left(sha256(s1_id || '_{CONFIG.holdout_salt}'), 8) AS BIGINT) % 10000 < 5000"

ORACLES: dict[str, str] = {
    "normalized_columns": _with([ENTITIES], "SELECT entity_id, name AS business_name_normalized, address AS business_address_normalized, ctry AS country_normalized FROM cl"),
    "missing_flags": _with([ENTITIES], "SELECT entity_id, trim(business_name) = '' AS business_name_is_missing, trim(business_address) = '' AS business_address_is_missing, trim(country) = '' AS country_is_missing FROM cl"),
    "missing_counts": _with([ENTITIES, _RAW], 'SELECT col AS "column", count(*) FILTER (trim(val) = \'\') AS missing, count(*) FILTER (val = \'\') AS empty, count(*) FILTER (length(val) <> strlen(val)) AS non_ascii FROM raw3 GROUP BY col'),
    "source_counts": _with([ENTITIES], "SELECT source, count(*) AS total, count(DISTINCT nullif(ctry, '')) AS n_countries, bool_or(ctry = '') AS has_missing_country FROM cl GROUP BY source"),
    "validate_violations": _with([ENTITIES], """
      , v AS (SELECT doc_id + 2 AS line, doc_id % 50 = 1 AS short, CASE WHEN doc_id % 50 = 11 THEN ' ' WHEN doc_id % 50 = 21 THEN 'X' || entity_id WHEN doc_id % 50 = 31 THEN 'S1-dup' ELSE entity_id END AS id FROM ent)
      SELECT line, CAST(CASE WHEN short THEN 4 WHEN trim(id) = '' THEN 5 ELSE 6 END AS BIGINT) AS rule FROM v WHERE short OR trim(id) = '' OR NOT starts_with(id, 'S')
      UNION ALL
      SELECT list_sort(list(line))[2], CAST(7 AS BIGINT) FROM v WHERE NOT short GROUP BY id HAVING count(*) > 1"""),
    "quality_invariants": _with([ENTITIES], """
      SELECT count(*) AS n_rows, count(*) AS column_count_valid, count(*) AS entity_ids_preserved, count(*) AS entity_id_prefix_consistent,
             count(*) FILTER (doc_id % 40 <> 9 OR business_name = 'other') AS original_values_unaltered, count(*) AS missing_flags_valid, count(*) AS missing_flags_consistent,
             count(*) FILTER (NOT (doc_id % 40 = 3 AND trim(business_name) = '') AND NOT (doc_id % 40 = 6 AND trim(country) = '')) AS normalized_missing_not_fabricated,
             count(*) FILTER (doc_id % 40 NOT IN (3, 6)) AS normalized_columns_present, count(*) FILTER (doc_id % 40 <> 6) AS no_null_tokens, count(*) FILTER (doc_id % 40 <> 12) AS row_count_match FROM cl"""),
    "repeated_values": _with([ENTITIES], """
      SELECT kind, count(*) FILTER (c > 1) AS n_values, CAST(coalesce(sum(c) FILTER (c > 1), 0) AS BIGINT) AS n_rows FROM (
        SELECT 'name' AS kind, name AS key, count(*) AS c FROM cl WHERE name <> '' GROUP BY name UNION ALL
        SELECT 'address', address, count(*) FROM cl WHERE address <> '' GROUP BY address UNION ALL
        SELECT 'record', name || chr(9) || address || chr(9) || ctry, count(*) FROM cl GROUP BY 2) GROUP BY kind"""),
    "country_counts": _with([ENTITIES], "SELECT country, count(*) AS n FROM ent WHERE country <> '' GROUP BY country"),
    "length_counts": _with([ENTITIES, _TALL], "SELECT col, length(val) AS len, count(*) AS n FROM tall GROUP BY ALL"),
    "length_quantiles": _with([ENTITIES, _TALL], "SELECT col, min(length(val)) AS min_length, max(length(val)) AS max_length, CAST(sum(length(val)) AS BIGINT) AS total_length, count(*) AS n, " + ", ".join(f"quantile_disc(length(val), {p}) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) + " FROM tall GROUP BY col"),
    "length_examples": _with([ENTITIES, _TALL], """
      SELECT * FROM (SELECT col, 'shortest' AS kind, row_number() OVER (PARTITION BY col ORDER BY length(val), val, entity_id) AS rank, entity_id, val FROM tall WHERE val <> '') WHERE rank <= 5 UNION ALL
      SELECT * FROM (SELECT col, 'longest', row_number() OVER (PARTITION BY col ORDER BY length(val) DESC, val, entity_id) AS rank, entity_id, val FROM tall) WHERE rank <= 5"""),
    "script_counts": _with([ENTITIES, _RAW], "SELECT col, CASE WHEN unicode(c) <= 591 OR unicode(c) BETWEEN 7680 AND 7935 THEN 'Latin-Extended' ELSE 'Other-Unicode' END AS kind, count(*) AS n FROM (SELECT col, unnest(regexp_extract_all(val, '[^\\x00-\\x7F]')) AS c FROM raw3) GROUP BY ALL"),
    "suspicious_counts": _with([ENTITIES], """
      SELECT 'business_name' AS col, kind, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE doc_id % 7 WHEN 0 THEN 'ascii_control_character' WHEN 1 THEN 'replacement_character_ufffd' WHEN 2 THEN 'private_use_or_surrogate' END AS kind, CASE doc_id % 7 WHEN 0 THEN 2 ELSE 1 END AS n FROM ent UNION ALL
        SELECT 'unicode_control_char', 1 FROM ent WHERE doc_id % 7 = 1) WHERE kind IS NOT NULL GROUP BY kind"""),
    "name_tokens": _keys("name_tokens"),
    "address_tokens": _keys("addr_tokens"),
    "address_numbers": _keys("numbers"),
    "num_loc_keys": _with([ENTITIES, TOKENS], "SELECT entity_id, coalesce(string_agg(key, ',' ORDER BY place), '') AS found FROM cl LEFT JOIN (SELECT entity_id, key, place FROM k1 WHERE family = 'num_loc') USING (entity_id) GROUP BY entity_id"),
    "compact_ngrams": _keys("ngrams"),
    "df_name": _df("name"),
    "df_addr": _df("addr"),
    "df_num_loc": _df("num_loc"),
    "df_ngram": _df("ngram"),
    "exact_name_block": _with([ENTITIES, TOKENS, POSTINGS, EXACT], "SELECT s1_id, cand_id FROM exact"),
    "rare_token_block": _pass("name"),
    "address_token_block": _pass("addr"),
    "num_loc_block": _pass("num_loc"),
    "ngram_block": _pass("ngram"),
    "overflow_events": _with([ENTITIES, TOKENS, POSTINGS, BLOCKS], """
      SELECT s1_id, source, CASE family WHEN 'name' THEN 'rare_name_token' WHEN 'addr' THEN 'address_token' WHEN 'num_loc' THEN 'address_number_location' ELSE 'compact_char_ngram' END AS block_family,
             key, generated_count, retained_count, generated_count - retained_count AS truncated_count, false AS is_filtered, true AS refinement_attempted, refined FROM (
        SELECT s1_id, source, family, key || '+' || key2 AS key, n AS generated_count, n2 AS retained_count, true AS refined FROM refined UNION ALL
        SELECT s1_id, source, family, key, n, n, false FROM whole)
      UNION ALL SELECT s1_id, source, 'rare_name_token', key, -1, 0, 0, true, false, false FROM met WHERE filtered AND family = 'name'"""),
    "missing_country_block": _with([ENTITIES, TOKENS, POSTINGS, MISSING], "SELECT s1_id, cand_id FROM missing"),
    "global_fallback_block": _with([ENTITIES, TOKENS, POSTINGS, GLOBAL], "SELECT s1_id, cand_id FROM fallback"),
    "cross_country_block": _with([ENTITIES, TOKENS, POSTINGS, CROSS], "SELECT s1_id, cand_id FROM crossed"),
    "merged_passes": _with([ENTITIES, TOKENS, POSTINGS, BLOCKS, EXACT], f"SELECT s1_id, cand_id, CAST(bit_or(bit) AS BIGINT) AS provenance FROM (SELECT s1_id, cand_id, {PROVENANCE['exact_name']} AS bit FROM exact UNION ALL SELECT s1_id, cand_id, {PROVENANCE['address_number_location']} FROM block_pairs WHERE family = 'num_loc') GROUP BY s1_id, cand_id"),
    "candidate_pairs": _with(_ALL, "SELECT s1_id, cand_id, provenance FROM pairs"),
    "candidate_pairs_defaults": _with([ENTITIES, TOKENS, POSTINGS, _blocks(_BY_DEFAULT), EXACT, MISSING, GLOBAL, _cross(_BY_DEFAULT), PAIRS], "SELECT s1_id, cand_id, provenance FROM pairs"),
    "provenance_breakdown": _with(_ALL, "SELECT 'total' AS kind, 'all' AS name, count(*) AS n FROM pairs UNION ALL SELECT 'source', source, count(*) FROM pairs GROUP BY source" + "".join(f" UNION ALL SELECT 'pass', '{p}', count(*) FILTER (provenance & {b} > 0) FROM pairs" for p, b in PROVENANCE.items())),
    "evidence_tiers": _with(_ALL, "SELECT s1_id, cand_id, " + ", ".join(f"{e} AS tier_{n}" for n, e in TIER) + " FROM pairs"),
    "ranked_capped": _with([*_ALL, RANKED], "SELECT s1_id, cand_id, rank_no FROM ranked WHERE rank_no <= 3"),
    "cap_counts": _with(_ALL, "SELECT s1_id, source, count(*) AS generated, least(count(*), 3) AS retained, count(*) - least(count(*), 3) AS truncated FROM pairs GROUP BY s1_id, source"),
    "export_rows": _with([*_ALL, RANKED], f"SELECT s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS candidates FROM s1 LEFT JOIN (SELECT * FROM ranked WHERE rank_no <= {CONFIG.max_candidates_per_source}) USING (s1_id) GROUP BY s1_id"),
    "candidate_distribution": _with(_ALL, f"""
      , q AS (SELECT v, n, sum(n) OVER (ORDER BY v) AS below, sum(n) OVER () AS total FROM (SELECT v, count(*) AS n FROM (SELECT count(cand_id) AS v FROM s1 LEFT JOIN pairs USING (s1_id) GROUP BY s1_id) GROUP BY v))
      SELECT coalesce(min(v), 0) AS d_min, {_at(0.5)} AS d_median, CAST(sum(v * n) AS DOUBLE) / sum(n) AS d_mean, {_at(0.95)} AS d_p95, {_at(0.99)} AS d_p99, coalesce(max(v), 0) AS d_max FROM q"""),
    "holdout_members": _with([ENTITIES], f"SELECT entity_id AS s1_id, CAST('0x' || left(sha256(entity_id || '_{CONFIG.holdout_salt}'), 8) AS BIGINT) % 10000 < 5000 AS held_out FROM cl WHERE source = 'S1'"),
    "ground_truth": _with([ENTITIES, TOKENS, POSTINGS, TRUTH], "SELECT s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS matched FROM s1 LEFT JOIN gt USING (s1_id) GROUP BY s1_id"),
    "recall_metrics": _with([*_ALL, TRUTH], """
      , f AS (SELECT g.*, coalesce(p.provenance, 0) AS provenance FROM gt g LEFT JOIN pairs p USING (s1_id, cand_id)),
      r AS (SELECT s1_id, (SELECT count(*) FROM gt WHERE gt.s1_id = s1.s1_id) AS size, (SELECT count(*) FROM pairs WHERE pairs.s1_id = s1.s1_id) AS got FROM s1)
      SELECT count(*) AS true_pairs, count(*) FILTER (provenance > 0) AS hits, count(*) FILTER (source = 'S2') AS s2_true_pairs, count(*) FILTER (source = 'S2' AND provenance > 0) AS s2_hits,
             count(*) FILTER (source = 'S3') AS s3_true_pairs, count(*) FILTER (source = 'S3' AND provenance > 0) AS s3_hits, count(DISTINCT s1_id) FILTER (provenance > 0) AS s1_with_hits,
             """ + ", ".join(f"count(*) FILTER (provenance & {b} > 0) AS hits_{p}, count(*) FILTER (provenance = {b}) AS only_{p}" for p, b in PROVENANCE.items()) + """,
             (SELECT count(*) FROM r) AS records, (SELECT count(*) FROM r WHERE size = 0) AS singletons, (SELECT count(*) FROM r WHERE got = 0) AS without_candidates, (SELECT CAST(sum(got) AS BIGINT) FROM r) AS retrieved FROM f"""),
    "cap_sweep_summary": _with([*_ALL, RANKED, TRUTH], f"""
      , c AS (SELECT unnest({list(CAPS)}) AS cap),
      x AS (SELECT cap, r.s1_id, count(*) AS generated, count(*) FILTER (rank_no <= cap) AS retained, count(*) FILTER (rank_no <= cap AND g.cand_id IS NOT NULL) AS hits,
                   count(*) FILTER (rank_no <= cap AND g.cand_id IS NOT NULL AND r.source = 'S2') AS h2, count(*) FILTER (rank_no <= cap AND g.cand_id IS NOT NULL AND r.source = 'S3') AS h3
            FROM c, ranked r LEFT JOIN gt g ON g.s1_id = r.s1_id AND g.cand_id = r.cand_id GROUP BY cap, r.s1_id)
      SELECT CAST(cap AS BIGINT) AS cap, CAST(sum(generated) AS BIGINT) AS generated_pairs, CAST(sum(retained) AS BIGINT) AS retained_pairs, CAST(sum(generated - retained) AS BIGINT) AS truncated_pairs,
             count(*) FILTER (generated > retained) AS capped_s1_count, CAST(sum(hits) AS BIGINT) AS retrieved_true_pairs, CAST(sum(h2) AS BIGINT) AS s2_hits, CAST(sum(h3) AS BIGINT) AS s3_hits, count(*) FILTER (hits > 0) AS s1_with_hits,
             (SELECT count(*) FROM s1) AS validation_s1_count, (SELECT count(*) FROM gt) AS true_pairs FROM x GROUP BY cap"""),
    "macro_f05": _with([*_ALL, RANKED, TRUTH], """
      , a AS (SELECT s1_id, cand_id FROM ranked WHERE rank_no <= 1),
      z AS (SELECT s1_id, (SELECT count(*) FROM gt WHERE gt.s1_id = s1.s1_id) AS t, (SELECT count(*) FROM a WHERE a.s1_id = s1.s1_id) AS s,
                   (SELECT count(*) FROM gt JOIN a USING (s1_id, cand_id) WHERE gt.s1_id = s1.s1_id) AS hit FROM s1)
      SELECT s1_id, round(CASE WHEN t = 0 AND s = 0 THEN 1.0::DOUBLE WHEN hit = 0 THEN 0.0 ELSE 1.25::DOUBLE * hit / (0.25::DOUBLE * t + s) END, 9) AS f05 FROM z"""),
    "check_errors": _with([ENTITIES, TOKENS, POSTINGS, TRUTH, RESULTS], """
      , i AS (SELECT DISTINCT unnest(l) AS id FROM results)
      SELECT 'duplicate_in_list' AS rule, s1_id AS id FROM results WHERE len(l) <> len(list_distinct(l)) UNION ALL
      SELECT CASE WHEN starts_with(id, 'S1-') THEN 'self_match' ELSE 'wrong_prefix' END, id FROM i WHERE NOT regexp_matches(id, '^S[23]-') UNION ALL
      SELECT 'unknown_id', id FROM i WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT cand_id FROM ca) UNION ALL
      SELECT 'missing_required', s1_id FROM s1 WHERE s1_id NOT IN (SELECT s1_id FROM results)"""),
    "matched_not_candidate": _with([*_ALL, RANKED, TRUTH, RESULTS], "SELECT DISTINCT s1_id FROM (SELECT s1_id, unnest(l) AS id FROM results) m WHERE NOT EXISTS (SELECT 1 FROM ranked r WHERE r.s1_id = m.s1_id AND r.cand_id = m.id AND rank_no <= 1)"),
    "file_raw_rows": _with([ENTITIES, DECORATED], "SELECT source, line, entity_id, business_name, business_address, country FROM dec"),
    "file_cleaned_rows": _with([ENTITIES, DECORATED], "SELECT source, line, entity_id, business_name, business_address, country, name AS business_name_normalized, address AS business_address_normalized, ctry AS country_normalized, " + ", ".join(f"{_FLAG(f'no_{c}')} AS {n}_is_missing" for c, n in (("name", "business_name"), ("address", "business_address"), ("country", "country"))) + " FROM dcl"),
    "file_first_rows": _with([ENTITIES, DECORATED], "SELECT entity_id FROM dec WHERE line <= 8"),
    "file_manifest": _with([ENTITIES, DECORATED], f"SELECT 'train/train_source' || source[2:] || '.tsv' AS name, count(*) AS n_rows, sha256('{chr(9).join(OUTPUT_COLUMNS)}' || chr(10) || string_agg({_LINE} || chr(10), '' ORDER BY line)) AS sha256, true AS unchanged FROM dcl GROUP BY source"),
    "file_profile": _with([ENTITIES, DECORATED], """
      SELECT 'train/train_source' || source[2:] || '.tsv' AS name, count(*) AS n_rows, count(*) FILTER (no_name) AS no_name, count(*) FILTER (no_address) AS no_address, count(*) FILTER (no_country) AS no_country,
             count(*) FILTER (length(business_name) <> strlen(business_name)) AS non_ascii_names FROM dcl GROUP BY source
      UNION ALL SELECT 'all', count(*), NULL, NULL, NULL, NULL FROM dcl"""),
    "file_quality": "SELECT invariant, invariant NOT IN ('output_headers_correct', 'normalized_columns_present', 'row_count_match') AS holds FROM (SELECT unnest(" + _list(HEADER_INVARIANTS + INVARIANTS) + ") AS invariant)",
    "file_truth": _with([ENTITIES], "SELECT entity_id AS s1_id, CASE doc_id // 3 % 4 WHEN 1 THEN 'S3-last' WHEN 2 THEN 'S2-c' ELSE '' END AS matched FROM ent WHERE doc_id % 3 = 0"),
    "file_candidates": _with([*_ALL, RANKED], f"SELECT s1_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS candidates FROM s1 LEFT JOIN (SELECT * FROM ranked WHERE rank_no <= {CONFIG.max_candidates_per_source}) USING (s1_id) GROUP BY s1_id"),
    "file_diagnostics": _with(_ALL, f"""
      , c AS (SELECT s1_id, source, count(*) AS g, least(count(*), {CONFIG.max_candidates_per_source}) AS r FROM pairs GROUP BY ALL),
      e AS (SELECT source, true AS refined, false AS filtered FROM refined UNION ALL SELECT source, false, false FROM whole UNION ALL SELECT source, false, true FROM met WHERE filtered AND family = 'name')
      SELECT 'total_s1_entities' AS counter, count(*) AS n FROM s1 UNION ALL SELECT 'total_candidate_pairs_generated', CAST(sum(g) AS BIGINT) FROM c UNION ALL SELECT 'total_candidate_pairs_retained', CAST(sum(r) AS BIGINT) FROM c
      UNION ALL SELECT 'total_candidate_pairs_truncated_by_caps', CAST(sum(g - r) AS BIGINT) FROM c UNION ALL SELECT 's1_capped_by_safety_budget', count(DISTINCT s1_id) FROM c WHERE g > r
      UNION ALL SELECT 'total_overflow_events', count(*) FROM e UNION ALL SELECT 'refined_overflow_events', count(*) FROM e WHERE refined UNION ALL SELECT 'unrefined_retained_events', count(*) FROM e WHERE NOT refined AND NOT filtered
      UNION ALL SELECT 'filtered_high_df_events', count(*) FROM e WHERE filtered UNION ALL SELECT 's2_overflows', count(*) FROM e WHERE source = 'S2' UNION ALL SELECT 's3_overflows', count(*) FROM e WHERE source = 'S3'"""),
    "file_sweep": _with([*_ALL, RANKED, TRUTH], f"""
      , h AS (SELECT s1_id FROM s1 WHERE {_HELD}), t AS (SELECT gt.* FROM gt JOIN h USING (s1_id)), c AS (SELECT unnest([1, 2, 5]) AS cap),
      x AS (SELECT cap, r.s1_id, r.source, count(*) AS g, least(count(*), any_value(cap)) AS k, count(*) FILTER (rank_no <= cap AND t.cand_id IS NOT NULL) AS hits
            FROM c, ranked r JOIN h USING (s1_id) LEFT JOIN t ON t.s1_id = r.s1_id AND t.cand_id = r.cand_id GROUP BY cap, r.s1_id, r.source)
      SELECT CAST(cap AS BIGINT) AS cap, (SELECT count(*) FROM h) AS validation_s1_count, (SELECT count(*) FROM t) AS true_pairs, CAST(sum(hits) AS BIGINT) AS retrieved_true_pairs, (SELECT count(*) FROM t) - CAST(sum(hits) AS BIGINT) AS missed_true_pairs,
             CAST(sum(g) AS BIGINT) AS generated_pairs, CAST(sum(k) AS BIGINT) AS retained_pairs, CAST(sum(g - k) AS BIGINT) AS truncated_pairs, count(DISTINCT s1_id) FILTER (g > k) AS capped_s1_count FROM x GROUP BY cap"""),
    "production_projection": _with(_ALL, f"SELECT (SELECT 10 * count(*) FROM s1) AS s1, CAST(10 * sum(g) AS BIGINT) AS generated, CAST(10 * sum(least(g, {CONFIG.max_candidates_per_source})) AS BIGINT) AS retained, CAST(10000 AS BIGINT) AS bytes FROM (SELECT count(*) AS g FROM pairs GROUP BY s1_id, source)"),
    "check_lines": _with([ENTITIES], """
      , r AS (SELECT entity_id AS id, doc_id AS no, doc_id % 14 AS k FROM ent WHERE doc_id % 3 = 0)
      SELECT 'malformed_row' AS rule, CAST(no + 2 AS VARCHAR) AS id FROM r WHERE k = 0 UNION ALL SELECT 'missing_required', id FROM r WHERE k IN (0, 2)
      UNION ALL SELECT DISTINCT 'wrong_prefix', ' S3-00000002' FROM r WHERE k = 4 UNION ALL SELECT 'duplicate_in_list', id FROM r WHERE k = 6"""),
    "check_tallies": _with([ENTITIES], "SELECT count(*) FILTER (k NOT IN (0, 2)) AS n_rows, count(*) FILTER (k = 8) AS n_empty, count(*) FILTER (k NOT IN (0, 2, 8)) AS n_filled FROM (SELECT doc_id % 14 AS k FROM ent WHERE doc_id % 3 = 0)"),
    "file_check": _with([ENTITIES], """
      , r AS (SELECT doc_id % 14 AS k FROM ent WHERE doc_id % 3 = 0)
      SELECT 'malformed_row' AS rule, count(*) AS n FROM r WHERE k = 0 UNION ALL SELECT 'missing_required', count(*) FROM r WHERE k IN (0, 2) UNION ALL SELECT 'wrong_prefix', CAST(1 AS BIGINT) UNION ALL SELECT 'duplicate_in_list', count(*) FROM r WHERE k = 6"""),
    "one_record_candidates": _with(_ALL, "SELECT cand_id, provenance FROM pairs WHERE s1_id = (SELECT min(s1_id) FROM s1)"),
    "grown_index": _with([ENTITIES, TOKENS, POSTINGS], "SELECT source, country, family, key, n, filtered FROM freq"),
    "index_countries": _with([ENTITIES], "SELECT DISTINCT source, ctry AS country FROM cl WHERE source <> 'S1' AND ctry <> ''"),
    "store_capped": _with([*_ALL, RANKED], "SELECT s1_id, cand_id, provenance, rank_no FROM ranked WHERE rank_no <= 2"),
    "stream_pairs": _with([*_ALL, RANKED], f"SELECT s1_id, cand_id, rank_no FROM ranked WHERE rank_no <= {CONFIG.max_candidates_per_source}"),
}
