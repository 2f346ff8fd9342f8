"""DuckDB SQL twins of the registered queries (the correctness gate).

Each SQL re-derives its answer from the driver's tables with plain SQL: the
fixture derivation, the name rules as RE2 regular expressions (the fixture
names are ASCII, so RE2's ASCII classes agree with the Unicode rules), the
lookups as GROUP BY with arg_max/arg_min, the roll-ups as GROUP BY. Column
names equal the Spark query's.
"""

from __future__ import annotations

from ledgermatch import codes
from ledgermatch.plans import fixtures as fx


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _map_values(mapping: dict[str, str]) -> str:
    rows = ", ".join("('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in mapping.items())
    return f"(VALUES {rows})"


# ------------------------------------------------------------------ name rules in RE2

def CLEAN(x: str) -> str:
    s = f"coalesce({x}, '')"
    s = f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\s*\\d{{2}}\\.\\d{{3}}\\.\\d{{3}}/\\d{{4}}-\\d{{2}}\\s*', ' ', 'g')"
    s = f"regexp_replace({s}, '\\s*[-–]\\s*\\d{{5,}}$', '')"
    s = f"regexp_replace({s}, '\\S+@\\S+\\.\\S+', '', 'g')"
    s = f"regexp_replace({s}, 'https?://\\S+', '', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def _suffix_alt(suffixes=None) -> str:
    suffixes = codes.LEGAL_SUFFIXES_CONFIG if suffixes is None else suffixes
    return "|".join(s.replace(".", "\\.") for s in suffixes)


def NORM(x: str) -> str:
    s = f"lower(strip_accents(coalesce({x}, '')))"
    s = f"regexp_replace({s}, '\\b\\d{{2}}\\.\\d{{3}}\\.\\d{{3}}/\\d{{4}}-\\d{{2}}\\b', '', 'g')"
    s = f"regexp_replace({s}, '\\b\\d{{3}}-\\d{{2}}-\\d{{4}}\\b', '', 'g')"
    s = f"regexp_replace({s}, '\\bein[:\\s]*\\d+-\\d+\\b', '', 'g')"
    s = f"regexp_replace({s}, '[^\\w\\s]', ' ', 'g')"
    s = f"regexp_replace({s}, '\\b({_suffix_alt()})\\b', '', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def _cand(x: str, pattern: str) -> str:
    hit = f"regexp_replace(trim(regexp_extract({x}, '{pattern}', 1)), '[.,;:]+$', '')"
    return f"CASE WHEN length({hit}) > 3 THEN {hit} END"


P1 = "(?i)(?:on behalf of|for the benefit of|representing)\\s+(.+?)(?:\\s*(?:for|to|regarding|in respect|$))"
P2 = "(?i)(?:retired for|retired by)\\s+(.+?)(?:\\s*(?:for|to|$))"


def BEHALF(x: str) -> str:
    return f"coalesce({_cand(x, P1)}, {_cand(x, P2)})"


def MT(x: str) -> str:
    return f"round_even(coalesce({x}, 0) / 1000000.0, 1)::DOUBLE"


# ------------------------------------------------------------------ fixtures

LEDGER_ROWS = f"""
ledger_rows AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) - 1 AS seq,
         {_list(fx.FIXTURE_REGISTRIES)}[l_suppkey % 4 + 1] AS registry_key,
         l_orderkey, l_linenumber AS ln, l_shipdate, c_custkey, s_nationkey, o_orderdate,
         replace(c_name, 'Customer', 'Client') AS n,
         CASE WHEN l_orderkey % 53 <> 0 THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS serial,
         CASE l_linenumber
           WHEN 1 THEN replace(c_name, 'Customer', 'Client')
           WHEN 2 THEN upper(replace(c_name, 'Customer', 'Client')) || ' Inc.'
           WHEN 3 THEN '  ' || replace(c_name, 'Customer', 'Client') || ' Holdings,  Ltd '
           WHEN 4 THEN replace(c_name, 'Customer', 'Client') || ' - 1234567'
           WHEN 6 THEN replace(c_name, 'Customer', 'Client') || ' 12.345.678/0001-90 x@y.com'
         END AS primary_name,
         CASE l_linenumber
           WHEN 5 THEN 'Retired on behalf of ' || replace(c_name, 'Customer', 'Client') || '; for ' || p_name
           WHEN 7 THEN 'Retired by XYZ for ' || p_name
         END AS details,
         CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_quantity * 1000 END AS quantity,
         l_quantity * 1000 AS quantity_value,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE year(l_shipdate) END AS retirement_year,
         p_name AS projectname,
         CASE WHEN p_partkey % 25 <> 0 THEN p_type || ' ' || {_list(fx.FIXTURE_KEYWORDS)}[p_partkey % 12 + 1] END AS projecttype,
         CAST(p_partkey AS VARCHAR) AS project_id,
         {_list(fx.FIXTURE_COUNTRIES)}[s_nationkey + 1] AS country,
         {_list(fx.FIXTURE_ISO3)}[s_nationkey + 1] AS iso3,
         CAST(year(o_orderdate) AS VARCHAR) AS vintage
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
)"""

PARSED_ALL = f"""
texts AS (
  SELECT *,
         primary_name AS p_text,
         CASE registry_key WHEN 'acr' THEN CASE WHEN ln = 5 THEN n || ' Account' END
              ELSE details END AS f_text,
         registry_key <> 'acr' AS f_is_text,
         CASE registry_key WHEN 'verra' THEN 'Retirement Beneficiary' WHEN 'gold' THEN '* Using Entity'
              WHEN 'acr' THEN 'Retired on Behalf of' ELSE 'Account Holder' END AS p_field,
         CASE registry_key WHEN 'verra' THEN 'Retirement Details' WHEN 'gold' THEN 'Note'
              WHEN 'acr' THEN 'Account Holder' ELSE 'Retirement Reason Details' END AS f_field,
         CASE registry_key WHEN 'verra' THEN 'Verra' WHEN 'gold' THEN 'Gold' WHEN 'acr' THEN 'ACR' ELSE 'CAR' END AS registry
  FROM ledger_rows
),
texts2 AS (
  SELECT *, {CLEAN('p_text')} AS p_clean,
         CASE WHEN f_is_text THEN {BEHALF('f_text')} ELSE f_text END AS found
  FROM texts
),
texts3 AS (SELECT *, {CLEAN('found')} AS f_clean FROM texts2),
parsed_all AS (
  SELECT *,
         CASE WHEN p_clean <> '' THEN p_clean
              WHEN f_is_text AND found IS NOT NULL THEN f_clean
              WHEN NOT f_is_text AND f_clean <> '' THEN f_clean END AS raw_beneficiary,
         CASE WHEN p_clean <> '' THEN p_field
              WHEN f_is_text AND found IS NOT NULL THEN f_field
              WHEN NOT f_is_text AND f_clean <> '' THEN f_field END AS source_field
  FROM texts3
)"""
# Every registry's effective primary text is the derived primary name: gold's
# "* Using Entity" is '' on line 3 and falls through to "Using Entity" (the same
# name); it is null on lines 5 and 7, which do not fall through.

BASE_RAW = f"""
base_raw AS (
  SELECT seq, registry_key, ln, l_orderkey, c_custkey, n,
         CASE ln WHEN 1 THEN n WHEN 2 THEN upper(n) || ' Inc.' WHEN 3 THEN n || ' Holdings, Ltd'
                 WHEN 4 THEN n WHEN 5 THEN n WHEN 6 THEN n || ' S.A.' END AS company,
         CASE WHEN c_custkey % 3 = 0 THEN
                CASE WHEN ln = 4 THEN 'E' || ((c_custkey + 1) % 50) ELSE 'E' || (c_custkey % 50) END
              WHEN c_custkey % 7 = 0 THEN NULL ELSE '' END AS factset_entity_id,
         CASE registry_key WHEN 'verra' THEN CASE WHEN l_orderkey % 2 = 0 THEN 'Verra' ELSE 'verra' END
                           WHEN 'gold' THEN CASE WHEN l_orderkey % 2 = 0 THEN 'Gold' ELSE 'gold' END
                           WHEN 'acr' THEN 'Acr' ELSE 'Car' END AS registry_label,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE year(l_shipdate) END AS retirement_year,
         serial AS serialnumber, quantity_value AS quantity, country, projectname, projecttype, vintage,
         CASE WHEN s_nationkey % 3 = 0 THEN '' ELSE iso3 END AS isocode
  FROM ledger_rows WHERE year(l_shipdate) <= 2000
),
base_raw2 AS (
  SELECT *, CASE WHEN coalesce(factset_entity_id <> '', false) AND NOT (ln = 1 AND l_orderkey % 5 = 0)
                 THEN 'Firm ' || substr(factset_entity_id, 2) END AS official_name
  FROM base_raw
)"""

BASE = """
base AS (
  SELECT seq, company AS raw_beneficiary, official_name AS matched_name,
         factset_entity_id,
         CASE registry_label WHEN 'Acr' THEN 'ACR' WHEN 'Car' THEN 'CAR' WHEN 'gold' THEN 'Gold'
                             WHEN 'verra' THEN 'Verra' ELSE registry_label END AS registry,
         retirement_year, serialnumber, quantity, country, projectname, projecttype, vintage, isocode,
         CASE WHEN coalesce(factset_entity_id <> '', false) THEN 'high' ELSE 'none' END AS match_confidence,
         CASE WHEN coalesce(factset_entity_id <> '', false) THEN 'original' ELSE 'unmatched' END AS match_method
  FROM base_raw2
)"""

KNOWN_MATCHES = f"""
km_rows AS (SELECT * FROM base_raw2 WHERE factset_entity_id <> ''),
km_official AS (
  SELECT factset_entity_id, arg_min(official_name, seq) AS official_name
  FROM km_rows WHERE official_name IS NOT NULL GROUP BY factset_entity_id
),
km_names AS (
  SELECT factset_entity_id, company, min(seq) AS first_seq
  FROM km_rows WHERE company IS NOT NULL AND trim(company) <> '' GROUP BY factset_entity_id, company
),
km_forms AS (SELECT *, {NORM('company')} AS company_normalized FROM km_names),
known_matches AS (
  SELECT arg_min(trim(company), first_seq) AS company_raw, f.company_normalized, o.official_name,
         f.factset_entity_id, 0 AS batch, f.factset_entity_id AS ord_firm, min(first_seq) AS ord_seq
  FROM km_forms f LEFT JOIN km_official o USING (factset_entity_id)
  GROUP BY f.company_normalized, f.factset_entity_id, o.official_name
)"""

LOOKUPS = """
exact_lookup AS (
  SELECT trim(lower(company_raw)) AS ekey,
         arg_max({'name': official_name, 'id': factset_entity_id}, {'b': batch, 'f': ord_firm, 's': ord_seq}) AS e
  FROM known_matches WHERE company_raw IS NOT NULL AND company_raw <> '' GROUP BY 1
),
norm_lookup AS (
  SELECT company_normalized AS nkey,
         arg_max({'name': official_name, 'id': factset_entity_id}, {'b': batch, 'f': ord_firm, 's': ord_seq}) AS nv
  FROM known_matches WHERE company_normalized IS NOT NULL AND company_normalized <> '' GROUP BY 1
)"""

NEW_ROWS = """
base_serials AS (SELECT DISTINCT serialnumber AS s FROM base_raw WHERE serialnumber IS NOT NULL),
new_rows AS (
  SELECT l.* FROM ledger_rows l
  WHERE l.serial IS NULL OR NOT EXISTS (SELECT 1 FROM base_serials b WHERE b.s = l.serial)
)"""

PARSED_NEW = """
parsed AS (SELECT p.* FROM parsed_all p JOIN new_rows n USING (seq) WHERE p.raw_beneficiary IS NOT NULL)"""

MATCHING = f"""
names AS (SELECT raw_beneficiary AS raw_name, min(seq) AS first_seq FROM parsed GROUP BY 1),
m1 AS (
  SELECT n.raw_name, n.first_seq, e.e, e.ekey IS NOT NULL AS e_hit
  FROM names n LEFT JOIN exact_lookup e ON trim(lower(n.raw_name)) = e.ekey
),
m2 AS (
  SELECT m1.*, CASE WHEN NOT e_hit AND raw_name <> '' THEN {NORM('raw_name')} END AS nkey FROM m1
),
m3 AS (
  SELECT m2.*, nl.nv, nl.nkey IS NOT NULL AS n_hit FROM m2 LEFT JOIN norm_lookup nl ON m2.nkey = nl.nkey
),
results AS (
  SELECT raw_name, first_seq,
         CASE WHEN raw_name <> '' AND e_hit THEN e.name
              WHEN raw_name <> '' AND NOT e_hit AND nkey <> '' AND n_hit THEN nv.name END AS matched_name,
         CASE WHEN raw_name <> '' AND e_hit THEN e.id
              WHEN raw_name <> '' AND NOT e_hit AND nkey <> '' AND n_hit THEN nv.id END AS factset_entity_id,
         CASE WHEN raw_name <> '' AND (e_hit OR (nkey <> '' AND n_hit)) THEN 'high' ELSE 'none' END AS confidence,
         CASE WHEN raw_name <> '' AND e_hit THEN 'cache_exact'
              WHEN raw_name <> '' AND NOT e_hit AND nkey <> '' AND n_hit THEN 'cache_normalized'
              ELSE 'unmatched' END AS match_method,
         '' AS reasoning
  FROM m3
),
hits AS (SELECT * FROM results WHERE factset_entity_id IS NOT NULL AND factset_entity_id <> ''),
new_matched AS (
  SELECT p.*,
         CASE WHEN h.raw_name IS NOT NULL THEN h.factset_entity_id ELSE '' END AS factset_entity_id,
         CASE WHEN h.raw_name IS NOT NULL THEN h.matched_name ELSE '' END AS matched_name,
         CASE WHEN h.raw_name IS NOT NULL THEN h.confidence ELSE 'none' END AS match_confidence,
         CASE WHEN h.raw_name IS NOT NULL THEN h.match_method ELSE 'unmatched' END AS match_method
  FROM parsed p LEFT JOIN hits h ON p.raw_beneficiary = h.raw_name
)"""

COMBINED = """
combined AS (
  SELECT 0 AS src, seq, raw_beneficiary, matched_name, factset_entity_id,
         '' AS hq_country, registry, retirement_year, country, coalesce(quantity, 0.0) AS quantity,
         match_confidence, match_method, projectname, projecttype, vintage, isocode
  FROM base
  UNION ALL
  SELECT 1 AS src, seq, raw_beneficiary, matched_name, factset_entity_id,
         '' AS hq_country, registry, retirement_year, country, quantity,
         match_confidence, match_method, projectname, projecttype, vintage, '' AS isocode
  FROM new_matched
)"""

FIRMS = f"""
coverage AS (
  SELECT CASE WHEN c_custkey < 50 THEN 'E' || c_custkey WHEN c_custkey < 55 THEN 'E' || (c_custkey - 50)
              ELSE 'X' || c_custkey END AS factset_entity_id,
         upper(replace(c_name, 'Customer', 'Client')) AS entity_name,
         replace(c_name, 'Customer', 'Client') || ' Corp' AS entity_proper_name,
         CASE WHEN c_custkey % 5 = 0 AND c_custkey >= 5 THEN 'PRI' ELSE 'PUB' END AS entity_type,
         {_list(fx.FIXTURE_ISO2)}[(CASE WHEN c_custkey BETWEEN 50 AND 54 THEN (c_nationkey + 1) % 25
                                         ELSE c_nationkey END) + 1] AS iso_country,
         CAST(c_custkey % 7 AS VARCHAR) AS sector_code, CAST(c_custkey % 11 AS VARCHAR) AS industry_code,
         CAST(c_custkey % 13 AS VARCHAR) AS primary_sic_code, c_custkey AS seq
  FROM customer
),
identifiers AS (
  SELECT fid AS factset_entity_id, t AS entity_id_type, v AS entity_id_value, s AS seq FROM (
    SELECT CASE WHEN c_custkey < 50 THEN 'E' || c_custkey WHEN c_custkey < 55 THEN 'E' || (c_custkey - 50)
                ELSE 'X' || c_custkey END AS fid, c_custkey FROM customer) c,
    LATERAL (SELECT * FROM (VALUES
        ('ISIN', 'ISIN' || c_custkey, c_custkey * 10 + 0, c_custkey % 2 = 0),
        ('LEI', 'LEI' || c_custkey, c_custkey * 10 + 1, c_custkey % 3 = 0),
        ('OTHER', 'OTH' || c_custkey, c_custkey * 10 + 2, true),
        ('ISIN', 'ISIN2-' || c_custkey, c_custkey * 10 + 3, c_custkey % 4 = 0)) AS x(t, v, s, keep)
      WHERE keep)
),
firms_pub AS (
  SELECT factset_entity_id, entity_name, entity_proper_name, iso_country, sector_code, industry_code,
         primary_sic_code, seq, {NORM('entity_proper_name')} AS entity_name_normalized
  FROM coverage WHERE entity_type = 'PUB'
),
id_pivot AS (
  SELECT factset_entity_id,
         arg_min(entity_id_value, seq) FILTER (WHERE entity_id_type = 'ISIN') AS isin,
         arg_min(entity_id_value, seq) FILTER (WHERE entity_id_type = 'LEI') AS lei
  FROM identifiers
  WHERE entity_id_type IN ('ISIN', 'LEI') AND entity_id_value IS NOT NULL
    AND factset_entity_id IN (SELECT factset_entity_id FROM firms_pub)
  GROUP BY factset_entity_id
),
firms AS (SELECT f.*, p.isin, p.lei FROM firms_pub f LEFT JOIN id_pivot p USING (factset_entity_id))"""

OUTPUT = """
hq_last AS (SELECT factset_entity_id AS fid, arg_max(iso_country, seq) AS hq FROM firms GROUP BY 1),
output AS (
  SELECT c.src, c.seq,
         coalesce(c.raw_beneficiary, '') AS raw_beneficiary, coalesce(c.matched_name, '') AS matched_name,
         coalesce(c.factset_entity_id, '') AS factset_entity_id, coalesce(h.hq, '') AS hq_country,
         coalesce(c.registry, '') AS registry, c.retirement_year, coalesce(c.country, '') AS country,
         c.quantity, coalesce(c.match_confidence, '') AS match_confidence,
         coalesce(c.match_method, '') AS match_method, coalesce(c.projectname, '') AS projectname,
         coalesce(c.projecttype, '') AS projecttype, coalesce(c.vintage, '') AS vintage,
         coalesce(c.isocode, '') AS isocode
  FROM combined c LEFT JOIN hq_last h ON c.factset_entity_id = h.fid
)"""


def _category_sql(col: str) -> str:
    parts = []
    for cat, needles in codes.PROJECT_CATEGORY_RULES:
        cond = " OR ".join(f"contains(lower({col}), '{n}')" for n in needles)
        parts.append(f"WHEN {cond} THEN '{cat.replace(chr(39), chr(39) * 2)}'")
    return f"CASE WHEN {col} IS NULL THEN 'Other' " + " ".join(parts) + " ELSE 'Other' END"


def _country_clean_sql(col: str) -> str:
    whens = " ".join("WHEN {} = '{}' THEN '{}'".format(col, k.replace("'", "''"), v.replace("'", "''"))
                     for k, v in codes.COUNTRY_RENAMES.items())
    return f"CASE {whens} ELSE {col} END"


REPORT = f"""
iso2_name AS (SELECT * FROM {_map_values(codes.ISO2_TO_NAME)} AS t(code, name)),
report AS (
  SELECT o.*, {_category_sql('o.projecttype')} AS project_category,
         {_country_clean_sql('o.country')} AS country_clean, m.name AS hq_country_name
  FROM output o LEFT JOIN iso2_name m ON o.hq_country = m.code
  WHERE o.factset_entity_id <> ''
)"""


def WITH(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CORE = [LEDGER_ROWS, PARSED_ALL, BASE_RAW, BASE, KNOWN_MATCHES, LOOKUPS, NEW_ROWS, PARSED_NEW, MATCHING,
        COMBINED, FIRMS, OUTPUT]
ALL = CORE + [REPORT]

STATS = lambda src: f"""
  count(*) AS total,
  count(*) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS matched,
  {MT('sum(quantity)')} AS total_mtco2,
  {MT("sum(quantity) FILTER (WHERE factset_entity_id NOT IN ('', 'None'))")} AS matched_mtco2"""

ISO3_OF_NAME = f"(SELECT * FROM {_map_values(codes.COUNTRY_TO_ISO3)} AS t(name, iso3))"
ISO3_OF_ISO2 = f"(SELECT * FROM {_map_values(codes.ISO2_TO_ISO3)} AS t(iso2, iso3))"
REPORT_ORDER = "src, seq"


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    w = WITH(*ALL)
    resolver_cte = """,
      un AS (SELECT raw_name, first_seq FROM results WHERE factset_entity_id IS NULL OR factset_entity_id = ''),
      p AS (SELECT *, row_number() OVER (ORDER BY raw_name) - 1 AS place FROM un),
      firsts AS (SELECT place // 20 AS batch, arg_min(raw_name, place) AS first_name FROM p GROUP BY 1),
      digits AS (SELECT p.*, f.first_name LIKE '%9' AS failed,
                        coalesce(list_sum(list_transform(regexp_extract_all(raw_name, '[0-9]'), lambda x: x::INT)), 0) AS d
                 FROM p JOIN firsts f ON p.place // 20 = f.batch),
      resolved AS (
        SELECT raw_name, first_seq,
               CASE WHEN NOT failed AND d % 2 = 0 THEN 'Firm ' || (d % 50) END AS matched_name,
               CASE WHEN NOT failed AND d % 2 = 0 THEN 'E' || (d % 50) END AS factset_entity_id,
               CASE WHEN failed OR d % 2 = 1 THEN 'none' WHEN d % 7 = 0 THEN 'low' ELSE 'medium' END AS confidence,
               CASE WHEN failed THEN 'llm_error' ELSE 'llm' END AS match_method
        FROM digits)"""
    accepted_cte = f""",
      accepted AS (
        SELECT raw_name AS company_raw, {NORM('raw_name')} AS company_normalized,
               coalesce(matched_name, '') AS official_name, factset_entity_id, 1 AS batch, '' AS ord_firm,
               first_seq AS ord_seq
        FROM resolved
        WHERE factset_entity_id IS NOT NULL AND factset_entity_id <> '' AND match_method = 'llm'
          AND CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END >= 2),
      both_rows AS (
        SELECT company_raw, company_normalized, official_name, factset_entity_id, batch, ord_firm, ord_seq
        FROM known_matches UNION ALL SELECT * FROM accepted),
      next_cache AS (
        SELECT arg_min({{'company_raw': company_raw, 'official_name': official_name, 'batch': batch,
                         'ord_firm': ord_firm, 'ord_seq': ord_seq}},
                       {{'b': batch, 'f': ord_firm, 's': ord_seq}}) AS r, company_normalized, factset_entity_id
        FROM both_rows GROUP BY company_normalized, factset_entity_id)"""
    # The run with the resolver: names the cache misses take the resolver's firm where it names one.
    full_output = """,
      resolver_hits AS (SELECT * FROM resolved WHERE factset_entity_id <> ''),
      full_rows AS (
        SELECT c.src, c.raw_beneficiary, coalesce(r.factset_entity_id, c.factset_entity_id) AS factset_entity_id,
               coalesce(r.match_method, c.match_method) AS match_method, c.registry, c.retirement_year, c.quantity, c.country, c.isocode
        FROM combined c LEFT JOIN resolver_hits r ON c.src = 1 AND c.raw_beneficiary = r.raw_name),
      full_output AS (
        SELECT src, coalesce(raw_beneficiary, '') AS raw_beneficiary, coalesce(factset_entity_id, '') AS factset_entity_id,
               coalesce(registry, '') AS registry, coalesce(match_method, '') AS match_method, retirement_year, quantity,
               coalesce(country, '') AS country, coalesce(isocode, '') AS isocode FROM full_rows)"""
    q["summary_by_registry"] = w + f" SELECT registry, {STATS('output')} FROM output GROUP BY registry"
    q["summary_kpis"] = w + f"""
      SELECT count(*) AS total_retirements,
             count(*) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS matched_retirements,
             count(DISTINCT factset_entity_id) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS unique_firms,
             {MT('sum(quantity)')} AS total_mtco2,
             {MT("sum(quantity) FILTER (WHERE factset_entity_id NOT IN ('', 'None'))")} AS matched_mtco2
      FROM output"""
    q["summary_by_year"] = w + f""" SELECT retirement_year, {STATS('output')} FROM output
      WHERE retirement_year IS NOT NULL GROUP BY retirement_year"""
    q["summary_by_method"] = w + " SELECT match_method, count(*) AS rows FROM output GROUP BY match_method"
    roll_cols = f"""count(*) AS total,
             count(*) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS matched,
             count(DISTINCT factset_entity_id) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS unique_firms,
             {MT('sum(quantity)')} AS total_mtco2,
             {MT("sum(quantity) FILTER (WHERE factset_entity_id NOT IN ('', 'None'))")} AS matched_mtco2"""
    q["summary_rollup"] = w + f"""
      SELECT 'registry' AS dim, registry AS key, {roll_cols} FROM output GROUP BY registry
      UNION ALL SELECT 'year', CAST(retirement_year AS VARCHAR), {roll_cols} FROM output
        WHERE retirement_year IS NOT NULL GROUP BY retirement_year
      UNION ALL SELECT 'method', match_method, {roll_cols} FROM output GROUP BY match_method
      UNION ALL SELECT 'all', '', {roll_cols} FROM output"""
    q["summary_json"] = w + f"""
      SELECT 'all' AS dim, '' AS key, count(*) AS total,
             count(*) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS matched,
             {MT('sum(quantity)')} AS total_mtco2,
             {MT("sum(quantity) FILTER (WHERE factset_entity_id NOT IN ('', 'None'))")} AS matched_mtco2,
             count(DISTINCT factset_entity_id) FILTER (WHERE factset_entity_id NOT IN ('', 'None')) AS unique_firms
      FROM output
      UNION ALL SELECT 'registry', registry, {STATS('output')}, NULL FROM output GROUP BY registry
      UNION ALL SELECT 'year', CAST(retirement_year AS VARCHAR), {STATS('output')}, NULL FROM output
        WHERE retirement_year IS NOT NULL GROUP BY retirement_year
      UNION ALL SELECT 'method', match_method, count(*), NULL, NULL, NULL, NULL FROM output GROUP BY match_method"""
    q["rollup_maintained"] = q["summary_rollup"]
    q["registry_share"] = w + f"""
      SELECT upper(registry) AS registry_key, sum(total_mtco2) AS total_mtco2, sum(matched_mtco2) AS matched_mtco2
      FROM (SELECT registry, {STATS('output')} FROM output GROUP BY registry) GROUP BY 1"""
    q["matched_table"] = w + f" SELECT src, seq, {', '.join(codes.OUTPUT_COLUMNS)} FROM output"
    q["matched_table_types"] = w + """ SELECT CASE seq % 3 WHEN 0 THEN '' WHEN 1 THEN '2021' ELSE registry END AS registry,
      count(*) AS rows, sum(quantity) AS quantity FROM output GROUP BY 1"""
    q["pipeline_first_run"] = WITH(LEDGER_ROWS, PARSED_ALL) + """
      SELECT 1 AS src, seq, raw_beneficiary, '' AS matched_name, '' AS factset_entity_id,
             '' AS hq_country, registry, retirement_year, coalesce(country, '') AS country, quantity, 'none' AS match_confidence,
             'unmatched' AS match_method, projectname, coalesce(projecttype, '') AS projecttype, coalesce(vintage, '') AS vintage,
             '' AS isocode FROM parsed_all WHERE raw_beneficiary IS NOT NULL"""
    q["enrich_hq"] = w + " SELECT src, seq, factset_entity_id, hq_country FROM output"
    q["matched_only_export"] = w + f" SELECT {', '.join(codes.OUTPUT_COLUMNS)} FROM output WHERE factset_entity_id <> ''"
    cols14 = ", ".join(codes.OUTPUT_COLUMNS)
    q["combine"] = w + f" SELECT src, seq, {cols14} FROM combined"
    san = ", ".join(
        c if c in ("retirement_year", "quantity") else
        f"CASE WHEN {c} IS NULL OR {c} IN ('nan', 'None') THEN '' ELSE {c} END AS {c}"
        for c in codes.OUTPUT_COLUMNS)
    q["sanitize"] = w + f" SELECT src, seq, {san} FROM combined"
    q["review_queue"] = w + """ SELECT match_confidence,
      CASE match_confidence WHEN 'high' THEN 'accept' WHEN 'medium' THEN 'accept_flagged'
           WHEN 'low' THEN 'review' ELSE 'none' END AS review_flag, count(*) AS rows
      FROM output GROUP BY 1, 2"""
    q["load_base"] = w + """ SELECT seq, raw_beneficiary, matched_name, factset_entity_id,
      registry, retirement_year, match_confidence, match_method, serialnumber, quantity FROM base"""
    q["known_matches"] = w + """ SELECT company_raw, company_normalized, official_name, factset_entity_id, batch,
      ord_firm, ord_seq FROM known_matches"""
    q["cache_lookups"] = w + """
      SELECT 'exact' AS kind, ekey AS key, e.name AS official_name, e.id AS factset_entity_id FROM exact_lookup
      UNION ALL SELECT 'normalized', nkey, nv.name, nv.id FROM norm_lookup"""
    q["cache_match"] = w + """ SELECT raw_name, matched_name, factset_entity_id, confidence, match_method,
      reasoning FROM results"""
    q["unmatched_names"] = w + """,
      ctx AS (SELECT raw_beneficiary AS raw_name, min(seq) AS first_seq, arg_min(registry, seq) AS registry,
                     arg_min(country, seq) AS country FROM parsed GROUP BY 1)
      SELECT c.raw_name, c.first_seq, c.registry, c.country
      FROM ctx c JOIN results r USING (raw_name)
      WHERE r.factset_entity_id IS NULL OR r.factset_entity_id = ''"""
    q["apply_matches"] = w + """ SELECT seq, registry, raw_beneficiary, factset_entity_id,
      matched_name, match_confidence, match_method FROM new_matched"""
    q["new_rows_anti"] = w + " SELECT seq, registry_key, serial FROM new_rows"
    q["stream_new_rows"] = q["new_rows_anti"]
    q["new_rows_bucketed"] = q["new_rows_anti"]
    q["snapshot_diff"] = w + """ SELECT seq, registry_key, serial FROM ledger_rows l
      WHERE serial IS NULL OR serial NOT IN (
        SELECT serial FROM ledger_rows p WHERE p.retirement_year <= 2000 AND p.serial IS NOT NULL
          AND p.registry_key = l.registry_key)"""
    q["extract_beneficiary"] = w + """ SELECT seq, registry_key, registry, raw_beneficiary,
      source_field FROM parsed_all WHERE raw_beneficiary IS NOT NULL"""
    q["parse_rate"] = w + """ SELECT registry_key, count(raw_beneficiary) AS parsed_rows, count(*) AS total_rows,
      round(count(raw_beneficiary) * 100.0 / count(*), 1) AS parse_pct FROM parsed_all GROUP BY 1"""
    q["harmonize"] = w + """ SELECT seq, registry_key, quantity, country, retirement_year,
      projectname, projecttype, project_id, vintage FROM ledger_rows"""
    q["project_category"] = w + f""" SELECT projecttype, count(*) AS rows, {_category_sql('projecttype')}
      AS project_category FROM ledger_rows GROUP BY projecttype"""
    messy = """, messy AS (
        SELECT *, 'The "' || projectname || '", first line,' || chr(10) || '"second" line' AS messy_name,
               registry_key <> 'verra' OR seq % 7 <> 0 AS has_date FROM ledger_rows)
      SELECT registry_key, count(*) AS rows, count(serial) AS serials, sum(quantity) AS quantity,
             count(retirement_year) FILTER (WHERE has_date) AS dated, CAST(sum(length(messy_name)) AS BIGINT) AS name_chars FROM messy"""
    q["load_registry"] = w + messy + " WHERE registry_key <> 'car' GROUP BY registry_key"
    q["load_snapshot"] = w + messy + " WHERE registry_key IN ('verra', 'gold') AND has_date GROUP BY registry_key"
    q["ingest_log"] = w + """ SELECT '2026-02' AS version, '2026-02-03' AS date, registry_key, count(*) AS rows FROM ledger_rows
      GROUP BY registry_key UNION ALL SELECT '2026-02', '2026-02-03', 'total', count(*) FROM ledger_rows"""
    q["public_firms"] = w + """ SELECT factset_entity_id, entity_name, entity_proper_name, iso_country,
      sector_code, industry_code, primary_sic_code, entity_name_normalized, isin, lei FROM firms"""
    q["id_pivot"] = w + " SELECT factset_entity_id, isin, lei FROM firms"
    q["universe_coverage"] = w + """
      SELECT 'total_entities' AS metric, count(*)::BIGINT AS value FROM coverage
      UNION ALL SELECT 'public_entities', count(*) FILTER (WHERE entity_type = 'PUB') FROM coverage
      UNION ALL SELECT 'public_firms', count(*) FROM firms
      UNION ALL SELECT 'with_isin', count(isin) FROM firms
      UNION ALL SELECT 'with_lei', count(lei) FROM firms
      UNION ALL SELECT 'matched_rows', count(*) FROM base_raw2 WHERE factset_entity_id <> ''
      UNION ALL SELECT 'matched_firms', count(DISTINCT factset_entity_id) FROM base_raw2 WHERE factset_entity_id <> ''
      UNION ALL SELECT 'cache_rows', count(*) FROM known_matches"""
    q["stage_metrics"] = w + resolver_cte + full_output + """
      SELECT 'base_rows' AS stage, count(*)::BIGINT AS value FROM base
      UNION ALL SELECT 'base_matched', count(*) FILTER (WHERE factset_entity_id <> '') FROM base
      UNION ALL SELECT 'new_rows_' || registry_key, count(*) FROM new_rows GROUP BY registry_key
      UNION ALL SELECT 'parsed_rows', count(*) FROM parsed
      UNION ALL SELECT 'unique_names', count(*) FROM results
      UNION ALL SELECT 'cache_hits', count(*) FILTER (WHERE factset_entity_id <> '') FROM results
      UNION ALL SELECT 'cache_misses', count(*) FILTER (WHERE factset_entity_id IS NULL OR factset_entity_id = '') FROM results
      UNION ALL SELECT 'resolver_names', count(*) FROM resolved
      UNION ALL SELECT 'resolver_hits', count(*) FILTER (WHERE factset_entity_id <> '') FROM resolved
      UNION ALL SELECT 'new_matched', count(*) FILTER (WHERE src = 1 AND factset_entity_id <> '') FROM full_output
      UNION ALL SELECT 'combined_rows', count(*) FROM full_output"""
    proj_row = f"""
      SELECT iso3, CAST(trunc(tonnes) AS BIGINT) AS tonnes, round(log10(tonnes + 1), 6) AS log_tonnes FROM (
        SELECT coalesce(CASE WHEN o.isocode <> '' THEN o.isocode END, m.iso3) AS iso3, sum(o.quantity) AS tonnes
        FROM output o LEFT JOIN {ISO3_OF_NAME} m ON o.country = m.name
        WHERE o.factset_entity_id NOT IN ('', 'None') AND coalesce(CASE WHEN o.isocode <> '' THEN o.isocode END, m.iso3) IS NOT NULL
        GROUP BY 1) WHERE tonnes > 0"""
    q["map_project"] = w + proj_row
    q["map_project_column"] = w + """
      SELECT iso3, CAST(trunc(tonnes) AS BIGINT) AS tonnes, round(log10(tonnes + 1), 6) AS log_tonnes FROM (
        SELECT isocode AS iso3, sum(quantity) AS tonnes FROM output
        WHERE factset_entity_id NOT IN ('', 'None') AND isocode IS NOT NULL GROUP BY 1) WHERE tonnes > 0"""
    hq_col = f"""
      SELECT m.iso3, CAST(trunc(t.tonnes) AS BIGINT) AS tonnes, round(log10(t.tonnes + 1), 6) AS log_tonnes FROM (
        SELECT f.iso_country, sum(o.quantity) AS tonnes
        FROM output o LEFT JOIN firms f ON o.factset_entity_id = f.factset_entity_id
        WHERE o.factset_entity_id NOT IN ('', 'None') AND f.iso_country IS NOT NULL GROUP BY 1) t
      JOIN {ISO3_OF_ISO2} m ON t.iso_country = m.iso2 WHERE t.tonnes > 0"""
    q["map_hq"] = w + hq_col
    hq_row = f"""
      SELECT 'hq_countries' AS kind, m.iso3, CAST(trunc(t.tonnes) AS BIGINT) AS tonnes FROM (
        SELECT h.hq AS iso_country, sum(o.quantity) AS tonnes
        FROM output o LEFT JOIN hq_last h ON o.factset_entity_id = h.fid
        WHERE o.factset_entity_id NOT IN ('', 'None') AND h.hq IS NOT NULL GROUP BY 1) t
      JOIN {ISO3_OF_ISO2} m ON t.iso_country = m.iso2 WHERE t.tonnes > 0"""
    q["map_json"] = w + f"""
      SELECT 'project_countries' AS kind, iso3, tonnes FROM ({proj_row}) UNION ALL {hq_row}"""
    matched = "factset_entity_id NOT IN ('', 'None')"
    stats_rows = f"""SELECT 'all|' AS key, count(*)::DOUBLE AS value FROM full_output
        UNION ALL SELECT 'registry|' || registry, count(*) FROM full_output GROUP BY registry
        UNION ALL SELECT 'year|' || retirement_year, count(*) FROM full_output WHERE retirement_year IS NOT NULL GROUP BY retirement_year
        UNION ALL SELECT 'method|' || match_method, count(*) FROM full_output GROUP BY match_method"""
    q["pipeline_e2e"] = w + resolver_cte + accepted_cte + full_output + f"""
      SELECT 'table' AS output, registry || '|' || match_method AS key, count(*)::DOUBLE AS value FROM full_output GROUP BY ALL
      UNION ALL SELECT 'csv', registry || '|' || match_method, count(*) FROM full_output WHERE factset_entity_id <> '' GROUP BY ALL
      UNION ALL SELECT 'summary_stats', key, value FROM ({stats_rows})
      UNION ALL SELECT 'docs/summary_stats', key, value FROM ({stats_rows})
      UNION ALL SELECT 'map_data', 'project_countries|' || iso3, trunc(tonnes) FROM (
        SELECT coalesce(CASE WHEN o.isocode <> '' THEN o.isocode END, m.iso3) AS iso3, sum(o.quantity) AS tonnes
        FROM full_output o LEFT JOIN {ISO3_OF_NAME} m ON o.country = m.name WHERE {matched} GROUP BY 1) WHERE iso3 IS NOT NULL AND tonnes > 0
      UNION ALL SELECT 'map_data', 'hq_countries|' || m.iso3, trunc(t.tonnes) FROM (
        SELECT h.hq AS iso_country, sum(o.quantity) AS tonnes FROM full_output o JOIN hq_last h ON o.factset_entity_id = h.fid
        WHERE {matched} AND h.hq IS NOT NULL GROUP BY 1) t JOIN {ISO3_OF_ISO2} m ON t.iso_country = m.iso2 WHERE t.tonnes > 0
      UNION ALL SELECT 'known_matches', r.batch::VARCHAR, count(*) FROM next_cache GROUP BY ALL"""
    q["report_load"] = w + """ SELECT src, seq, matched_name, factset_entity_id, registry,
      retirement_year, country_clean AS country, quantity, project_category, hq_country, hq_country_name FROM report"""
    q["report_metrics"] = w + """ SELECT coalesce(sum(quantity), 0.0) AS total_quantity, count(*) AS transactions,
      count(DISTINCT factset_entity_id) AS unique_firms, count(DISTINCT country_clean) AS countries,
      CASE WHEN coalesce(sum(quantity), 0) >= 1e6 THEN printf('%.1f', round_even(sum(quantity) / 1e6, 1)) || 'M'
           WHEN coalesce(sum(quantity), 0) >= 1e3 THEN printf('%.0f', round_even(sum(quantity) / 1e3, 0)) || 'K'
           ELSE printf('%,.0f', round_even(coalesce(sum(quantity), 0), 0)) END AS quantity_label
      FROM report"""
    places = {"all": "true", "years": "coalesce(retirement_year BETWEEN 1996 AND 1999, false)",
              "places": """coalesce(hq_country_name IN ('United States', 'Brazil', 'Germany', 'Cyprus', 'DR Congo'), false)
                AND coalesce(country_clean IN ('Brazil', 'India', 'Kenya', 'Peru', 'Laos'), false)""",
              "kinds": """coalesce(retirement_year BETWEEN 1993 AND 1998, false)
                AND coalesce(project_category IN ('Renewable Energy', 'Other', 'Transport'), false)"""}
    q["report_metrics_cube"] = w + " UNION ALL ".join(f""" SELECT '{name}' AS choice, coalesce(sum(quantity), 0.0) AS total_quantity,
      count(*) AS transactions, count(DISTINCT factset_entity_id) AS unique_firms, count(DISTINCT country_clean) AS countries
      FROM report WHERE {test}""" for name, test in places.items())
    searches = ["firm (1|2)[0-9]$", "firm 3", "FIRM", "irm 1[05]", "^firm 4", "7$", "firm 1.?$", "(firm|company) 2", "m 4+$", "none of them"]
    q["firm_search"] = w + " UNION ALL ".join(f""" SELECT '{p}' AS pattern, count(*) AS rows, coalesce(sum(quantity), 0.0) AS quantity
      FROM report WHERE coalesce(regexp_matches(matched_name, '(?i){p}'), false)""" for p in searches)
    q["firm_layout"] = w + " SELECT factset_entity_id, entity_proper_name, iso_country, isin, lei FROM firms"
    q["category_share"] = w + """ SELECT category, tonnes, tonnes / sum(tonnes) OVER () * 100 AS pct,
      CASE WHEN tonnes / sum(tonnes) OVER () * 100 >= 1 THEN printf('%.1f%%', tonnes / sum(tonnes) OVER () * 100)
           ELSE '' END AS label
      FROM (SELECT project_category AS category, sum(quantity) AS tonnes FROM report
            WHERE project_category IS NOT NULL GROUP BY 1)"""
    q["yearly_quantity"] = w + """ SELECT retirement_year, sum(quantity) / 1e6 AS mtco2 FROM report
      WHERE retirement_year IS NOT NULL GROUP BY 1"""
    q["top_countries"] = w + """ SELECT country_clean AS country, sum(quantity) AS tonnes FROM report
      WHERE country_clean IS NOT NULL GROUP BY 1 ORDER BY tonnes DESC, country LIMIT 20"""
    q["top_firms"] = w + """ SELECT matched_name AS firm, sum(quantity) AS tonnes FROM report
      WHERE matched_name IS NOT NULL GROUP BY 1 ORDER BY tonnes DESC, firm LIMIT 20"""
    facet_choice = """coalesce(retirement_year BETWEEN 1996 AND 1999, false)
        AND coalesce(hq_country_name IN ('United States', 'Brazil', 'Germany', 'Cyprus', 'DR Congo'), false)
        AND country_clean IN ('Brazil', 'India', 'Kenya', 'South Korea', 'Peru', 'Laos', 'Ghana', 'Mexico', 'Vietnam')
        AND coalesce(project_category IN ('Renewable Energy', 'Carbon Capture', 'Other', 'Transport'), false)
        AND coalesce(regexp_matches(matched_name, '(?i)firm (1|2)[0-9]$'), false)"""
    q["faceted_filter"] = w + f""" SELECT src, seq, matched_name, retirement_year,
      project_category, hq_country_name, quantity FROM report WHERE {facet_choice}"""
    q["facets"] = w + """
      SELECT 'min_year' AS facet, CAST(min(retirement_year) AS VARCHAR) AS value FROM report
      UNION ALL SELECT 'max_year', CAST(max(retirement_year) AS VARCHAR) FROM report
      UNION ALL SELECT DISTINCT 'hq_countries', hq_country_name FROM report WHERE hq_country_name IS NOT NULL
      UNION ALL SELECT DISTINCT 'countries', country_clean FROM report WHERE country_clean IS NOT NULL
      UNION ALL SELECT DISTINCT 'categories', project_category FROM report WHERE project_category IS NOT NULL"""
    export = """matched_name, coalesce(hq_country_name, '') AS hq_country_name, registry, retirement_year,
      country_clean AS country, quantity, projectname, projecttype, vintage"""
    q["report_export_full"] = w + f" SELECT {export} FROM report"
    q["report_export_filtered"] = w + f" SELECT {export} FROM report WHERE {facet_choice}"
    q["report_table"] = w + f""" SELECT matched_name, hq_country_name, registry, retirement_year, country_clean AS country, quantity,
      projectname, projecttype, vintage FROM report ORDER BY {REPORT_ORDER} LIMIT 500"""
    q["report_load_csv"] = w + """ SELECT matched_name, factset_entity_id, registry, retirement_year, country_clean AS country,
      quantity, project_category, hq_country, hq_country_name FROM report WHERE retirement_year BETWEEN 1995 AND 1999"""
    q["report_dates"] = w + " UNION ALL ".join(f""" SELECT '{c}' AS column, retirement_year, count(*) AS rows,
      sum(quantity) AS quantity FROM report GROUP BY retirement_year""" for c in codes.REPORT_DATE_COLUMNS)
    q["tonnes_label"] = """
      WITH t AS (SELECT o_orderkey, scale, floor(o_totalprice * scale) AS tonnes FROM orders,
                   (SELECT unnest([0.0001, 0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0, 100000.0])::DOUBLE AS scale))
      SELECT o_orderkey, scale, CASE WHEN tonnes >= 1e6 THEN printf('%.1fM', round_even(tonnes / 1e6, 1))
             WHEN tonnes >= 1e3 THEN printf('%.0fK', round_even(tonnes / 1e3, 0))
             ELSE printf('%.0f', tonnes) END AS label FROM t"""
    q["fingerprint"] = "SELECT doc_id, sha256(text) AS sha256 FROM documents"
    q["fold_accents"] = "SELECT doc_id, strip_accents(text) AS folded FROM documents"
    q["clean_name"] = WITH(LEDGER_ROWS) + f""",
      t AS (
        SELECT primary_name AS text FROM ledger_rows WHERE registry_key IN ('verra', 'acr', 'car')
        UNION SELECT CASE WHEN ln = 3 THEN '' ELSE primary_name END FROM ledger_rows WHERE registry_key = 'gold'
        UNION SELECT CASE WHEN ln = 3 THEN primary_name WHEN ln = 5 THEN 'Fallback Holdings' END
              FROM ledger_rows WHERE registry_key = 'gold'
        UNION SELECT CASE WHEN ln = 5 THEN n || ' Account' END FROM ledger_rows WHERE registry_key = 'acr')
      SELECT text, {CLEAN('text')} AS cleaned FROM t WHERE text IS NOT NULL"""
    q["extract_on_behalf"] = WITH(LEDGER_ROWS) + f""",
      t AS (SELECT DISTINCT details AS text FROM ledger_rows
            WHERE registry_key IN ('verra', 'gold', 'car') AND details IS NOT NULL)
      SELECT text, {BEHALF('text')} AS extracted FROM t"""
    q["normalize_name"] = w + f" SELECT raw_name, {NORM('raw_name')} AS normalized FROM names"
    reply_item = """'{"index": ' || l_linenumber || ', "parent_name": "Firm ' || (l_partkey % 50) ||
        '", "factset_entity_id": ' || CASE WHEN l_linenumber % 3 = 0 THEN 'null' ELSE '"E' || (l_partkey % 50) || '"' END ||
        ', "confidence": "' || CASE l_linenumber WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'none' ELSE 'low' END ||
        '", "reasoning": "' || CASE l_linenumber WHEN 4 THEN 'see [note]' WHEN 6 THEN 'stray ] bracket' ELSE 'ok' END || '"}'"""
    replies = f"""
      replies AS (
        SELECT l_orderkey, 'Matches for order ' || l_orderkey || ': [' ||
               string_agg({reply_item}, ', ' ORDER BY l_linenumber, l_partkey, l_suppkey) || '] [end]' AS reply
        FROM lineitem GROUP BY l_orderkey),
      extracted AS (
        SELECT l_orderkey, reply,
               CASE WHEN strpos(reply, 'stray ] bracket') > 0
                    THEN substr(reply, strpos(reply, '['), strpos(reply, 'stray ]') + 6 - strpos(reply, '[') + 1)
                    ELSE substr(reply, strpos(reply, '['), strpos(reply, '] [end]') - strpos(reply, '[') + 1) END AS extracted
        FROM replies)"""
    q["json_array_extract"] = "WITH " + replies + " SELECT l_orderkey, extracted FROM extracted"
    q["json_results_decode"] = "WITH " + replies + """,
      decoded AS (
        SELECT l_orderkey, json_valid(extracted) AS parsed,
               CASE WHEN json_valid(extracted) THEN CAST(json(extracted) AS JSON[]) END AS items FROM extracted)
      SELECT l_orderkey, parsed, CAST(coalesce(CAST(json_extract(item, '$.index') AS INTEGER), pos) AS INTEGER) AS item_index,
             json_extract_string(item, '$.parent_name') AS parent_name,
             json_extract_string(item, '$.factset_entity_id') AS factset_entity_id,
             json_extract_string(item, '$.confidence') AS confidence,
             json_extract_string(item, '$.reasoning') AS reasoning
      FROM decoded, unnest(items) WITH ORDINALITY AS u(item, pos)
      UNION ALL
      SELECT l_orderkey, parsed, NULL, NULL, NULL, NULL, NULL FROM decoded WHERE items IS NULL"""
    q["resolver_request"] = w + """,
      ctx AS (SELECT raw_beneficiary AS raw_name, arg_min(registry, seq) AS registry,
                     arg_min(country, seq) AS country FROM parsed GROUP BY 1),
      un AS (SELECT c.* FROM ctx c JOIN results r USING (raw_name)
             WHERE r.factset_entity_id IS NULL OR r.factset_entity_id = ''),
      p AS (SELECT *, row_number() OVER (ORDER BY raw_name) - 1 AS place FROM un)
      SELECT raw_name, place // 20 AS batch, CAST(place % 20 + 1 AS INTEGER) AS line,
             (place % 20 + 1) || '. "' || raw_name || '"' ||
             CASE WHEN coalesce(registry <> '', false) THEN ' (registry: ' || registry || ')' ELSE '' END ||
             CASE WHEN coalesce(country <> '', false) THEN ' (country: ' || country || ')' ELSE '' END AS request_line
      FROM p"""
    q["resolve_batch"] = w + resolver_cte + """
      SELECT raw_name, matched_name, factset_entity_id, confidence, match_method FROM resolved"""
    q["cache_update"] = w + resolver_cte + accepted_cte + """
      SELECT r.company_raw AS company_raw, company_normalized, r.official_name AS official_name,
             factset_entity_id, r.batch AS batch, r.ord_firm AS ord_firm, r.ord_seq AS ord_seq
      FROM next_cache"""
    q["cache_versions"] = q["cache_update"].replace("FROM next_cache", ", 'v000003' AS version FROM next_cache")
    q["fuzzy_match"] = w + f""",
      near_keys AS (
        SELECT company_normalized AS key, max({{'b': batch, 'f': ord_firm, 's': ord_seq}}) AS pos,
               arg_max({{'n': official_name, 'i': factset_entity_id}}, {{'b': batch, 'f': ord_firm, 's': ord_seq}}) AS v
        FROM known_matches WHERE company_normalized <> '' GROUP BY 1),
      missed AS (SELECT raw_name, {NORM('raw_name')} AS nkey FROM results WHERE match_method = 'unmatched'),
      close AS (
        SELECT nkey, key, pos, v, levenshtein(nkey, key) AS distance
        FROM (SELECT DISTINCT nkey FROM missed WHERE length(nkey) BETWEEN 5 AND 80) JOIN near_keys ON abs(length(nkey) - length(key)) <= 1
        WHERE length(key) BETWEEN 5 AND 80 AND v.i <> '' AND levenshtein(nkey, key) <= 1),
      best AS (SELECT nkey, arg_min({{'v': v, 'd': distance}}, {{'d': distance, 'p': pos, 'k': key}}) AS b FROM close GROUP BY 1)
      SELECT raw_name, b.v.n AS matched_name, b.v.i AS factset_entity_id, 'medium' AS confidence, 'cache_near' AS match_method, b.d::INTEGER AS distance
      FROM missed JOIN best USING (nkey)"""
    # Each update adds every name with one firm, so the second one's row is the last of every exact key that it
    # adds: of the names with one normal form the first seen stays, and gives that form's entry.
    q["cache_update_twice"] = w + f""",
      forms AS (SELECT raw_name, first_seq, {NORM('raw_name')} AS nkey FROM names),
      added AS (SELECT DISTINCT firm, nkey, arg_min(raw_name, first_seq) OVER (PARTITION BY nkey) AS company_raw,
                       min(first_seq) OVER (PARTITION BY nkey) AS first_seq
                FROM forms, (VALUES ('E1', 1), ('E2', 2)) v(firm, batch)),
      grown AS (
        SELECT company_raw, company_normalized, official_name, factset_entity_id, batch, ord_firm, ord_seq FROM known_matches
        UNION ALL
        SELECT company_raw, nkey, 'Firm ' || firm, firm, CASE firm WHEN 'E1' THEN 1 ELSE 2 END, '', first_seq FROM added),
      cache3 AS (
        SELECT arg_min({{'company_raw': company_raw, 'official_name': official_name}}, {{'b': batch, 'f': ord_firm, 's': ord_seq}}) AS r,
               min({{'b': batch, 'f': ord_firm, 's': ord_seq}}) AS pos, company_normalized, factset_entity_id
        FROM grown GROUP BY company_normalized, factset_entity_id),
      ex AS (SELECT trim(lower(r.company_raw)) AS ekey, arg_max({{'n': r.official_name, 'i': factset_entity_id}}, pos) AS v
             FROM cache3 WHERE r.company_raw <> '' GROUP BY 1),
      nm AS (SELECT company_normalized AS nkey, arg_max({{'n': r.official_name, 'i': factset_entity_id}}, pos) AS v
             FROM cache3 WHERE company_normalized <> '' GROUP BY 1)
      SELECT raw_name, CASE WHEN raw_name = '' THEN NULL WHEN ex.ekey IS NOT NULL THEN ex.v.n ELSE nm.v.n END AS matched_name,
             CASE WHEN raw_name = '' THEN NULL WHEN ex.ekey IS NOT NULL THEN ex.v.i ELSE nm.v.i END AS factset_entity_id,
             CASE WHEN raw_name = '' THEN 'unmatched' WHEN ex.ekey IS NOT NULL THEN 'cache_exact'
                  WHEN nm.nkey IS NOT NULL THEN 'cache_normalized' ELSE 'unmatched' END AS match_method
      FROM forms LEFT JOIN ex ON trim(lower(raw_name)) = ex.ekey LEFT JOIN nm ON forms.nkey = nm.nkey AND forms.nkey <> ''"""
    context_line = "factset_entity_id || '|' || coalesce(entity_proper_name, '') || '|' || coalesce(iso_country, '') AS line"
    q["firm_context"] = w + f"""
      SELECT factset_entity_id, entity_proper_name, iso_country, {context_line} FROM (
        SELECT factset_entity_id, arg_min(entity_proper_name, seq) AS entity_proper_name, arg_min(iso_country, seq) AS iso_country
        FROM firms GROUP BY 1)"""
    q["firm_context_bounded"] = w + f""",
      f AS (SELECT factset_entity_id, entity_proper_name, iso_country, seq,
                   md5(factset_entity_id || '42') AS k FROM firms),
      pool AS (SELECT *, 0 AS part FROM f WHERE iso_country IN ('US', 'BR')
               UNION ALL (SELECT *, 1 FROM f WHERE NOT coalesce(iso_country IN ('US', 'BR'), false)
                          ORDER BY k, seq LIMIT 500)),
      dedup AS (SELECT factset_entity_id, arg_min(entity_proper_name, {{'p': part, 's': seq}}) AS entity_proper_name,
                       arg_min(iso_country, {{'p': part, 's': seq}}) AS iso_country, min(k) AS k
                FROM pool GROUP BY 1)
      SELECT factset_entity_id, entity_proper_name, iso_country, {context_line} FROM (SELECT * FROM dedup ORDER BY k LIMIT 2000)"""
    return q


_CACHE: dict[str, str] | None = None


def oracle_sql() -> dict[str, str]:
    global _CACHE
    if _CACHE is None:
        _CACHE = _sql()
    return dict(_CACHE)
