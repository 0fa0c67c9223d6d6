"""The registered queries in SQL, for a second engine over the same tables.

Written from the rules, not from the Spark plans: replication is the plain self-join,
keep-first rules are row numbers, and so on.
"""

from __future__ import annotations

import re

from levygrid import constants as C

# Common table expressions; a query pulls in the ones it names.
_CTES = {
    "geo": """
        SELECT CAST(n_nationkey AS BIGINT) AS ordinal,
               'US' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '00000000' AS geocode,
               n_name AS state, '' AS city
        FROM nation
        UNION ALL
        SELECT s_suppkey + 25,
               'US' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') || '1'
                    || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'),
               n_name, 'CITY ' || (s_suppkey // 3)
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "state_dim": """
        SELECT state, arg_max(geocode, ordinal) AS geocode
        FROM geo WHERE geocode LIKE '%00000000' AND state <> '' GROUP BY state""",
    "city_dim": """
        SELECT upper(city) AS city, geocode, min(ordinal) AS geo_idx
        FROM geo WHERE city <> '' AND state <> '' GROUP BY upper(city), geocode""",
    "loc": """
        SELECT n_name AS jurisdiction, geocode FROM nation JOIN state_dim ON state = n_name
        UNION ALL
        SELECT city, geocode FROM city_dim
        WHERE city NOT IN (SELECT n_name FROM nation JOIN state_dim ON state = n_name)""",
    "tax_cat_dim": """
        SELECT 'CAT ' || n_nationkey AS tax_cat_desc,
               lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS tax_cat
        FROM nation WHERE n_nationkey <> 7""",
    "tax_type_raw": """
        SELECT geocode, lpad(CAST(k AS VARCHAR), 2, '0') AS tax_cat, t.tax_type
        FROM geo, range(25) AS r(k),
             (VALUES (0, '01'), (1, '02'), (2, '03'), (3, '04'), (4, '47')) AS t(ti, tax_type)
        WHERE (ordinal + k + ti) % 3 = 0 AND (ordinal * 7 + k) % 10 <> 0""",
    "code_dim": """
        SELECT research_key, arg_max(lpad(item, greatest(3, length(item))::INTEGER, '0'), p_partkey)
                   AS item_code
        FROM (SELECT regexp_replace(__rid(p_partkey), '(\\.0)+$', '') AS research_key,
                     CAST(p_partkey % 1500 AS VARCHAR) AS item, p_partkey
              FROM part WHERE p_partkey % 10 <> 7)
        GROUP BY research_key""",
    "lines": """
        SELECT l.*, s_nationkey, n_name,
               CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 1 END AS odd,
               CAST(l_quantity AS INTEGER) % 26 AS q,
               CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS disc
        FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey""",
    "sheets": """
        SELECT CAST(CASE WHEN l_linenumber <= 4 THEN s_nationkey
                         WHEN l_linenumber IN (5, 6) THEN 1000 + l_suppkey // 3
                         ELSE 900000 END AS BIGINT) AS file_idx,
               CASE WHEN l_linenumber <= 4 THEN n_name
                    WHEN l_linenumber IN (5, 6) THEN 'City ' || (l_suppkey // 3)
                    ELSE 'Nowhere' END || ' Sales Tax Research' AS file_name,
               row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS ord,
               __rid(l_partkey) AS c1,
               'N' || (l_partkey % 10) AS c2,
               CASE WHEN l_partkey % 3 = 0 THEN '' ELSE ' part ' || l_partkey END AS c3,
               CASE l_orderkey % 5 WHEN 2 THEN 'tag level' WHEN 3 THEN ' Tag Level '
                    WHEN 4 THEN 'Section' ELSE 'Tag Level' END AS c10,
               (['Taxable', 'TAXABLE', 'taxable ', 'Not Taxable', 'Nontaxable', 'Exempt',
                 'Drill Down', 'Bogus', ''])[l_orderkey % 9 + 1] AS c11,
               CASE q WHEN 25 THEN '' WHEN 7 THEN '07' ELSE 'CAT ' || q END AS c12,
               (['100%', '0%', '8.75%', '1.0', 'invalid', disc])[l_partkey % 6 + 1] AS c13,
               (['Taxable', 'TAXABLE', 'taxable ', 'Not Taxable', 'Nontaxable', 'Exempt',
                 'To Research', 'Bogus', ''])[(l_orderkey + 3 * odd) % 9 + 1] AS c14,
               CASE WHEN l_orderkey % 4 = 3 THEN 'Mystery'
                    WHEN q = 25 THEN '' WHEN q = 7 THEN '07' ELSE 'CAT ' || q END AS c15,
               (['100%', '0%', '8.75%', '1.0', 'invalid', disc])[(l_partkey + odd) % 6 + 1] AS c16
        FROM lines""",
    "names": """
        SELECT file_idx, file_name, ord, trim(c1) AS current_id, trim(c10) AS admin,
               trim(c2) || trim(c3) AS description,
               trim(c11) AS business_use, trim(c12) AS business_desc, trim(c13) AS business_pct,
               trim(c14) AS personal_use, trim(c15) AS personal_desc, trim(c16) AS personal_pct
        FROM sheets""",
    "tagged": "SELECT * FROM names WHERE upper(admin) = 'TAG LEVEL' AND current_id <> ''",
    "parsed": """
        SELECT t.*,
               __status(business_use) AS business_taxable,
               __status(personal_use) AS personal_taxable,
               __pct(business_pct) AS business_percent,
               __pct(personal_pct) AS personal_percent,
               CASE WHEN business_desc = '' THEN '00' ELSE coalesce(b.tax_cat, business_desc) END
                   AS business_code,
               CASE WHEN personal_desc = '' THEN '00' ELSE coalesce(p.tax_cat, personal_desc) END
                   AS personal_code
        FROM tagged t
        LEFT JOIN tax_cat_dim b ON b.tax_cat_desc = business_desc
        LEFT JOIN tax_cat_dim p ON p.tax_cat_desc = personal_desc""",
    "judged": """
        SELECT *, business_taxable IS NOT NULL AND business_percent IS NOT NULL AS business_valid,
               personal_taxable IS NOT NULL AND personal_percent IS NOT NULL AS personal_valid,
               coalesce(business_taxable = personal_taxable AND business_code = personal_code
                        AND business_percent = personal_percent, false) AS equal_parts
        FROM parsed""",
    "tpl": """
        SELECT file_idx, file_name, ord, 0 AS side, current_id AS item, '0B' AS customer,
               business_taxable AS taxable, business_code AS tax_cat,
               __six(business_percent) AS percent_taxable
        FROM judged WHERE business_valid AND NOT (personal_valid AND equal_parts)
        UNION ALL
        SELECT file_idx, file_name, ord, 1, current_id, '99',
               personal_taxable, personal_code, __six(personal_percent)
        FROM judged WHERE personal_valid""",
    "located": """
        SELECT tpl.*, geocode FROM tpl
        JOIN loc ON jurisdiction = trim(replace(upper(file_name), 'SALES TAX RESEARCH', ''))""",
    "typed": """
        SELECT l.*, t.tax_type FROM located l
        JOIN tax_type_raw t ON upper(t.geocode) = upper(l.geocode) AND upper(t.tax_cat) = upper(l.tax_cat)""",
    "untyped": """
        SELECT * FROM located l WHERE NOT EXISTS (
            SELECT 1 FROM tax_type_raw t
            WHERE upper(t.geocode) = upper(l.geocode) AND upper(t.tax_cat) = upper(l.tax_cat))""",
    "rec": """
        SELECT geocode, '' AS tax_auth_id, '7777' AS "group", item, customer, '99' AS provider,
               '01' AS "transaction", taxable, tax_type, tax_cat, '1999-01-01' AS effective,
               '01' AS per_taxable_type, percent_taxable
        FROM typed""",
    "placed_rec": """
        SELECT t.geocode, '' AS tax_auth_id, '7777' AS "group", item_code AS item, customer, '99' AS provider,
               '01' AS "transaction", taxable, tax_type, tax_cat, '1999-01-01' AS effective,
               '01' AS per_taxable_type, percent_taxable, file_idx, d.geo_idx, ord, side
        FROM typed t JOIN code_dim ON research_key = __norm(t.item)
        LEFT JOIN city_dim d ON d.geocode = t.geocode""",
    "city_rec": "SELECT * FROM rec WHERE geocode NOT LIKE '%00000000'",
    "copied": """
        SELECT c.geocode, s.* EXCLUDE (geocode)
        FROM city_rec c JOIN rec s
          ON s.geocode = substr(c.geocode, 1, 4) || '00000000' AND s."group" = c."group"
         AND s.item = c.item AND s.customer = c.customer AND s.provider = c.provider
         AND NOT (s.tax_type = c.tax_type AND s.tax_cat = c.tax_cat)""",
    "lone": """
        SELECT * FROM city_rec c WHERE NOT EXISTS (
            SELECT 1 FROM rec s
            WHERE s.geocode = substr(c.geocode, 1, 4) || '00000000' AND s."group" = c."group"
              AND s.item = c.item AND s.customer = c.customer AND s.provider = c.provider
              AND NOT (s.tax_type = c.tax_type AND s.tax_cat = c.tax_cat))""",
    "full_rec": "SELECT * FROM rec UNION ALL SELECT * FROM copied",
    "coded_rec": """
        SELECT r.* REPLACE (item_code AS item) FROM full_rec r
        JOIN code_dim ON research_key = __norm(r.item)""",
    "good": """
        SELECT * FROM names WHERE trim(replace(upper(file_name), 'SALES TAX RESEARCH', ''))
            IN (SELECT jurisdiction FROM loc)""",
    "texts": """
        SELECT file_idx, current_id AS item, arg_max(description, ord) AS own_text
        FROM names WHERE current_id <> '' GROUP BY file_idx, current_id""",
    "cand": """
        SELECT file_idx, ord, current_id AS item FROM good
        WHERE admin = 'Tag Level' AND current_id <> ''
          AND upper(business_use) NOT IN ('DRILL DOWN', 'TO RESEARCH')
          AND upper(personal_use) NOT IN ('DRILL DOWN', 'TO RESEARCH')""",
    "steps": """
        SELECT file_idx, item, lvl,
               array_to_string(string_split(item, '.')[1:lvl], '.') || repeat('.0', 8 - lvl) AS step
        FROM (SELECT DISTINCT file_idx, item FROM cand), range(1, 8) AS r(lvl)
        WHERE string_split(item, '.')[lvl + 1] <> '0'
        UNION ALL
        SELECT DISTINCT file_idx, item, 8, item FROM cand""",
    "described": """
        SELECT s.file_idx, s.item,
               trim(string_agg(CASE WHEN coalesce(own_text, '') = '' THEN ' ' ELSE own_text END,
                               ' | ' ORDER BY lvl)) AS description
        FROM steps s LEFT JOIN texts t ON t.file_idx = s.file_idx AND t.item = s.step
        GROUP BY s.file_idx, s.item""",
    "item_rows": """
        SELECT c.file_idx, c.ord, '7777' AS "group", c.item, description
        FROM cand c JOIN described d ON d.file_idx = c.file_idx AND d.item = c.item
        WHERE description <> ''""",
    "coded_items": """
        SELECT file_idx, ord, "group", item_code AS item, description
        FROM item_rows JOIN code_dim ON research_key = __norm(item)""",
    "kept_items": """
        SELECT "group", item, description FROM coded_items
        QUALIFY row_number() OVER (PARTITION BY item ORDER BY file_idx, ord) = 1""",
    "no_code": """
        SELECT DISTINCT item AS research_id FROM
            (SELECT item FROM rec UNION ALL SELECT item FROM item_rows)
        WHERE __norm(item) NOT IN (SELECT research_key FROM code_dim)""",
    "bad_files": """
        SELECT DISTINCT file_idx, file_name FROM names
        WHERE trim(replace(upper(file_name), 'SALES TAX RESEARCH', ''))
            NOT IN (SELECT jurisdiction FROM loc)""",
    "strange": """
        SELECT file_idx, file_name, geocode, status_text FROM
            (SELECT file_idx, file_name, business_use AS status_text FROM tagged
             UNION ALL SELECT file_idx, file_name, personal_use FROM tagged)
        JOIN loc ON jurisdiction = trim(replace(upper(file_name), 'SALES TAX RESEARCH', ''))
        WHERE status_text <> '' AND upper(status_text) NOT IN
            ('TAXABLE', 'NOT TAXABLE', 'NONTAXABLE', 'EXEMPT', 'DRILL DOWN', 'TO RESEARCH')""",
    "type_gaps": """
        SELECT file_idx, file_name, geocode, tax_cat, count(*) AS n,
               array_to_string(list(item ORDER BY ord, side)[1:5], ', ') AS sample
        FROM untyped GROUP BY file_idx, file_name, geocode, tax_cat""",
    "city_gaps": """
        SELECT geocode, substr(geocode, 1, 4) || '00000000' AS parent, count(*) AS n,
               count(DISTINCT item) AS items,
               array_to_string(list_sort(list_distinct(list("group"))), ''', ''') AS groups,
               array_to_string(list_sort(list_distinct(list(customer))), ''', ''') AS customers,
               array_to_string(list_sort(list_distinct(list(item)))[1:10], ', ') AS sample
        FROM lone GROUP BY geocode""",
    "error_rows": """
        SELECT 'FileProcessingError' AS error_type, file_name,
               'Could not determine geocode(s) for filename: ' || file_name AS error_message
        FROM bad_files
        UNION ALL
        SELECT 'UnknownTaxableValueError', file_name,
               'Unknown taxable value ''' || status_text || ''' (normalized: ''' || upper(status_text)
               || '''). Known values: [''NOT TAXABLE'', ''NONTAXABLE'', ''EXEMPT'', ''TAXABLE''].'
               || ' Uncertain values (skipped): [''DRILL DOWN'', ''TO RESEARCH'']'
        FROM strange
        UNION ALL
        SELECT 'MissingTaxTypeError', file_name,
               'No tax types found for geocode=''' || geocode || ''', tax_cat=''' || tax_cat
               || ''' - excluded ' || n || ' records from output. Affected items: ' || sample
               || CASE WHEN n > 5 THEN ' ... and ' || (n - 5) || ' more' ELSE '' END
        FROM type_gaps
        UNION ALL
        SELECT 'CityTreatmentReplicationError', NULL,
               'City geocode ''' || geocode || ''' has ' || n || ' records but no matching '
               || 'state-level tax treatments found for parent geocode ''' || parent
               || '''. Affected records: groups=[''' || groups || '''], items=[' || sample
               || CASE WHEN items > 10 THEN ' ... and ' || (items - 10) || ' more' ELSE '' END
               || '], customers=[''' || customers || ''']'
        FROM city_gaps
        UNION ALL
        SELECT 'ExcludedUnmappedResearchIds', NULL, count(*) || ' research_ids could not be '
               || 'mapped to product codes and were excluded from output files'
        FROM no_code HAVING count(*) > 0""",
    "header_cells": """
        SELECT file_idx, pos, CASE
            WHEN pos = 1 AND file_idx % 3 = 0 THEN ' Current ID '
            WHEN pos = 9 AND file_idx % 4 = 1 THEN 'Admin'
            WHEN pos = 14 AND file_idx % 5 = 2 THEN ''
            ELSE (['', 'Current ID', 'L1', 'L2', 'L3', 'L4', 'L5', 'L6', 'L7', 'L8', 'Admin',
                   'Business Use', 'Business tax_cat', 'Business percent_taxable', 'Personal Use',
                   'Personal tax_cat', 'Personal percent_taxable'])[pos + 1] END AS text
        FROM (SELECT DISTINCT file_idx FROM sheets), range(17) AS r(pos)""",
    "wanted": """
        SELECT * FROM (VALUES ('admin', 'Admin'), ('current_id', 'Current ID'),
            ('business_use', 'Business Use'), ('personal_use', 'Personal Use'),
            ('personal_tax_cat', 'Personal tax_cat'),
            ('personal_percent_tax', 'Personal percent_taxable'),
            ('business_tax_cat', 'Business tax_cat'),
            ('business_percent_tax', 'Business percent_taxable')) AS v(logical_name, header)""",
    "row_numbers": """
        SELECT *, 4 + row_number() OVER (PARTITION BY file_idx ORDER BY ord) AS row_idx
        FROM sheets""",
}

# Expressions used in many places, written as one-argument calls.
_MACROS = {
    "__rid": "('1.' || ({0}) % 10 || '.' || (({0}) // 10) % 10 || '.' || (({0}) // 100) % 10"
             " || '.' || ({0}) // 1000 || '.0.0.0')",
    "__status": "(CASE upper({0}) WHEN 'TAXABLE' THEN 1 WHEN 'NOT TAXABLE' THEN 0"
                " WHEN 'NONTAXABLE' THEN 0 WHEN 'EXEMPT' THEN 0 END)",
    "__pct": "(CASE WHEN contains({0}, '%') THEN CAST(TRY_CAST(replace({0}, '%', '')"
             " AS DECIMAL(34,18)) * CAST('0.01' AS DECIMAL(2,2)) AS DECIMAL(37,20))"
             " ELSE TRY_CAST({0} AS DECIMAL(37,20)) END)",
    "__six": "CAST(CAST({0} AS DECIMAL(37,6)) AS VARCHAR)",
    "__norm": "(CASE WHEN regexp_matches({0}, '^0(\\.0)*$') THEN {0}"
              " ELSE regexp_replace({0}, '(\\.0)+$', '') END)",
}


def _inline(sql: str) -> str:
    """Replace the short calls by their expressions."""
    for name, body in _MACROS.items():
        sql = re.sub(
            re.escape(name) + r"\(([\w.]+)\)", lambda m: body.format(m.group(1)), sql
        )
    return sql


def _with(final: str) -> str:
    """Put the common table expressions a query needs in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name, body in _CTES.items():
            if name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", sql):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(final)
    # What a query names more than once is computed once, whatever the engine would choose.
    parts = ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n]})" for n in needed)
    return _inline(f"WITH {parts}\n{final}" if parts else final)


_MATRIX = (
    'geocode, tax_auth_id, "group", item, customer, provider, "transaction", taxable,'
    " tax_type, tax_cat, effective, per_taxable_type, percent_taxable"
)


def _quoted(*columns: str) -> str:
    return " || ',' || ".join(f"'\"' || replace({c}, '\"', '\"\"') || '\"'" for c in columns)


def _state_names() -> str:
    """Places and names of the states, and of one that is none, as SQL rows."""
    return ", ".join(f"({i}, '{name}')" for i, name in enumerate([*C.US_STATES, "NOWHERE"]))


def oracle_sql() -> dict[str, str]:
    finals = {
        # Sources and headers
        "file_listing": "SELECT DISTINCT file_name AS file_idx, file_name FROM sheets",
        "sheet_scan": """SELECT file_name AS file_idx, row_idx, c1 AS current_id, c3 AS level_text,
            c10 AS admin, c11 AS business_use, c16 AS personal_percent FROM row_numbers""",
        "sheet_scan_line_breaks": """SELECT file_name AS file_idx, row_idx, c1 AS current_id,
            CASE WHEN row_idx % 3 = 0 THEN c3 || chr(10) || '"' || c1 || '",' ELSE c3 END AS level_text,
            c16 AS personal_percent FROM row_numbers""",
        "sheet_account": """SELECT file_name, 'read' AS state, true AS all_bytes, count(*) + 4 AS n_rows
            FROM row_numbers GROUP BY file_name""",
        "sheet_row_range": """SELECT file_idx, row_idx, c1 AS current_id FROM row_numbers
            WHERE row_idx BETWEEN 10 AND 40""",
        "header_row": "SELECT file_idx, pos, trim(text) AS header FROM header_cells",
        "first_header": """SELECT logical_name, CAST(list_position(['', 'Current ID', 'L1', 'L2',
                'L3', 'L4', 'L5', 'L6', 'L7', 'L8', 'Admin', 'Business Use', 'Business tax_cat',
                'Business percent_taxable', 'Personal Use', 'Personal tax_cat',
                'Personal percent_taxable'], header) - 1 AS INTEGER) AS col_idx
            FROM wanted WHERE EXISTS (SELECT 1 FROM sheets)""",
        "missing_columns": """SELECT file_name,
                count(*) FILTER (WHERE file_idx % 5 = 2 OR personal_use = '') AS no_personal_use,
                count(*) FILTER (WHERE admin = '') AS no_admin, count(*) AS n
            FROM names GROUP BY file_name""",
        "mapping_scan": "SELECT research_key, item_code FROM code_dim",
        "header_mapping": """SELECT f.file_idx, logical_name, CAST(max(pos) AS INTEGER) AS col_idx
            FROM (SELECT DISTINCT file_idx FROM sheets) f CROSS JOIN wanted
            LEFT JOIN header_cells h ON h.file_idx = f.file_idx AND trim(h.text) = header
            GROUP BY f.file_idx, logical_name""",
        "header_mapping_first": """SELECT f.file_idx, logical_name,
                CAST(min(pos) AS INTEGER) AS col_idx
            FROM (SELECT DISTINCT file_idx FROM sheets) f CROSS JOIN wanted
            LEFT JOIN header_cells h ON h.file_idx = f.file_idx AND trim(h.text) = header
            GROUP BY f.file_idx, logical_name""",
        # Dimensions
        "dim_state_geocode": "SELECT state, geocode FROM state_dim",
        "dim_state_names": f"""SELECT upper(name) AS jurisdiction,
                CASE WHEN place < {len(C.US_STATES)}
                    THEN 'US' || lpad(CAST(place + 1 AS VARCHAR), 2, '0') || '00000000' END AS geocode,
                count(*) AS n
            FROM supplier JOIN (VALUES {_state_names()}) AS names(place, name)
                ON s_suppkey % {len(C.US_STATES) + 1} = place GROUP BY place, name""",
        "dim_city_geocodes": "SELECT city, geocode, geo_idx FROM city_dim",
        "dim_tax_cat": "SELECT tax_cat_desc, tax_cat FROM tax_cat_dim",
        "dim_tax_types": """SELECT geocode, tax_cat,
                array_to_string(list_sort(list_distinct(list(tax_type))), ',') AS tax_types
            FROM tax_type_raw GROUP BY geocode, tax_cat""",
        "dim_product_code": "SELECT research_key, item_code FROM code_dim",
        # Filters
        "filter_admin_ci": """SELECT file_idx, current_id, admin FROM names
            WHERE upper(admin) = 'TAG LEVEL'""",
        "filter_admin_cs": """SELECT file_idx, current_id, admin FROM names
            WHERE admin = 'Tag Level'""",
        "city_records": f"SELECT {_MATRIX} FROM city_rec",
        # Scalar expressions
        "cell_access": """SELECT file_idx, trim(c1) AS current_id, trim(c3) AS level_text,
                trim(c10) AS admin, trim(c11) AS business_use, '' AS beyond_row,
                '' AS unknown_column FROM sheets""",
        "parse_taxable": """SELECT business_use, __status(business_use) AS business_taxable,
                personal_use, __status(personal_use) AS personal_taxable,
                upper(business_use) = 'BOGUS' AS business_unknown,
                upper(personal_use) = 'BOGUS' AS personal_unknown FROM names""",
        "taxable_status_legacy": "SELECT {} FROM names".format(", ".join(
            f"""{s}_use, CASE {s}_use
                WHEN 'Not Taxable' THEN 0 WHEN 'Nontaxable' THEN 0 WHEN 'Exempt' THEN 0
                WHEN 'Taxable' THEN 1 WHEN 'Drill Down' THEN -1 ELSE 1 END AS {s}_status"""
            for s in ("business", "personal"))),
        "parse_percent": "SELECT {} FROM names".format(", ".join(
            f"{s}_pct AS {s}_text, CAST(__pct({s}_pct) AS VARCHAR) AS {s}_value"
            for s in ("business", "personal"))),
        # Halves to even by integer arithmetic on ten-millionths.
        "format_percent": """SELECT l_orderkey, (u // 1000000) || '.'
                || lpad(CAST(u % 1000000 AS VARCHAR), 6, '0') AS percent_text
            FROM (SELECT l_orderkey, v // 10 + CASE WHEN v % 10 > 5 THEN 1
                      WHEN v % 10 = 5 THEN (v // 10) % 2 ELSE 0 END AS u
                  FROM (SELECT l_orderkey, l_orderkey * 5 AS v FROM lineitem))""",
        "tax_cat_code": """SELECT personal_desc AS personal_tax_cat,
                CASE WHEN personal_desc = '' THEN '00' ELSE coalesce(p.tax_cat, personal_desc) END
                    AS personal_code,
                business_desc AS business_tax_cat,
                CASE WHEN business_desc = '' THEN '00' ELSE coalesce(b.tax_cat, business_desc) END
                    AS business_code
            FROM names LEFT JOIN tax_cat_dim p ON p.tax_cat_desc = personal_desc
            LEFT JOIN tax_cat_dim b ON b.tax_cat_desc = business_desc""",
        "jurisdiction_name": """SELECT file_name, count(*) AS n,
                trim(replace(upper(file_name), 'SALES TAX RESEARCH', '')) AS jurisdiction,
                CAST(NULL AS VARCHAR) AS with_year,
                trim(replace(upper(file_name), 'SALES TAX RESEARCH', '')) AS padded,
                CAST(NULL AS VARCHAR) AS bare
            FROM sheets GROUP BY file_name""",
        "parent_geocode": """SELECT geocode, substr(geocode, 1, 4) || '00000000' AS parent,
                substr(geocode, 1, 2) || '0000000000' AS parent_of_short FROM geo""",
        "normalize_research_id": """SELECT p_partkey, __rid(p_partkey) AS research_id,
                regexp_replace(__rid(p_partkey), '(\\.0)+$', '') AS normalized,
                CASE p_partkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '0.0' ELSE '0.0.0' END AS zeros
            FROM part""",
        "pad_item_code": """SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR),
                greatest(3, length(CAST(p_partkey AS VARCHAR)))::INTEGER, '0') AS code FROM part""",
        "ancestor_ids": """SELECT p_partkey, CAST(row_number() OVER
                    (PARTITION BY p_partkey ORDER BY lvl) - 1 AS INTEGER) AS pos,
                array_to_string(string_split(rid, '.')[1:lvl], '.') || repeat('.0', 8 - lvl)
                    AS ancestor
            FROM (SELECT p_partkey, __rid(p_partkey) AS rid FROM part), range(1, 8) AS r(lvl)
            WHERE string_split(rid, '.')[lvl + 1] <> '0'""",
        "row_description": "SELECT file_idx, current_id, description FROM names",
        "hier_description": "SELECT file_idx, item, description FROM described",
        "treatment_dedup": """SELECT file_idx, current_id AS item, business_valid, personal_valid,
                business_valid AND personal_valid AND equal_parts AS identical FROM judged""",
        "row_to_records": """SELECT file_idx, item, customer, taxable, tax_cat, percent_taxable
            FROM tpl""",
        "matrix_csv_line": "SELECT {} AS line FROM rec".format(_quoted(
            "geocode", "tax_auth_id", '"group"', "item", "customer", "provider", '"transaction"',
            "CAST(taxable AS VARCHAR)", "tax_type", "tax_cat", "effective", "per_taxable_type",
            "percent_taxable")),
        "item_csv_line": "SELECT {} AS line FROM kept_items".format(
            _quoted('"group"', "item", "'\"' || description")),
        "output_folder_name": """SELECT event_id, 'output-' || strftime(
                (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y%m%d-%H%M')
                AS folder FROM events""",
        # Joins
        "resolve_geocodes": """SELECT DISTINCT file_idx, file_name, geocode FROM sheets
            LEFT JOIN loc ON jurisdiction = trim(replace(upper(file_name),
                'SALES TAX RESEARCH', ''))""",
        "resolve_state_geocode": """SELECT DISTINCT file_idx, file_name, geocode FROM sheets
            LEFT JOIN state_dim ON state = trim(replace(upper(file_name),
                'SALES TAX RESEARCH', ''))""",
        "multi_geocode": """SELECT file_idx, geocode, item, customer, taxable, tax_cat,
                percent_taxable FROM located""",
        "expand_tax_types": """SELECT file_idx, geocode, item, customer, tax_cat, tax_type
            FROM typed""",
        "missing_tax_types": """SELECT file_idx, geocode, item, customer, tax_cat
            FROM untyped""",
        "expand_tax_types_default": """SELECT file_idx, geocode, item, customer, tax_cat, tax_type
            FROM typed UNION ALL
            SELECT file_idx, geocode, item, customer, tax_cat, '01' FROM untyped""",
        "sheet_matrix": f"SELECT {_MATRIX} FROM rec",
        "replicate_state": f"SELECT {_MATRIX} FROM copied",
        "city_without_state": f"SELECT {_MATRIX} FROM lone".replace(
            _MATRIX, 'geocode, "group", item, customer, provider, tax_type, tax_cat')
            .replace("SELECT", "SELECT count(*) AS n,", 1)
            + ' GROUP BY geocode, "group", item, customer, provider, tax_type, tax_cat',
        "enhanced_records": f"SELECT {_MATRIX} FROM full_rec",
        "convert_records": f"SELECT {_MATRIX} FROM rec".replace(" item,", " item_code AS item,")
            + " JOIN code_dim ON research_key = __norm(item)",
        "convert_items": 'SELECT "group", item, description FROM coded_items',
        "unmapped_ids": "SELECT research_id FROM no_code",
        # Aggregates and reports
        "missing_tax_type_errors":
            "SELECT * FROM error_rows WHERE error_type = 'MissingTaxTypeError'",
        "city_error_summary":
            "SELECT * FROM error_rows WHERE error_type = 'CityTreatmentReplicationError'",
        "file_errors": "SELECT * FROM error_rows WHERE error_type = 'FileProcessingError'",
        "unknown_taxable_errors":
            "SELECT * FROM error_rows WHERE error_type = 'UnknownTaxableValueError'",
        "errors_report": "SELECT * FROM error_rows",
        "mapping_stats": """SELECT (SELECT count(*) FROM code_dim) AS total_mappings,
                (SELECT count(*) FROM no_code) AS unmapped_requests""",
        "rows_processed": """SELECT file_idx, file_name,
                CAST(count(*) FILTER (WHERE admin = 'Tag Level') AS BIGINT) AS rows_processed
            FROM names GROUP BY file_idx, file_name""",
        "batch_summary": """SELECT (SELECT count(DISTINCT file_idx) FROM good) AS files_successful,
                (SELECT count(*) FROM good WHERE admin = 'Tag Level') AS rows_processed,
                (SELECT count(*) FROM rec) AS records_generated,
                (SELECT count(*) FROM item_rows) AS product_items_generated""",
        "run_summary": """SELECT (SELECT count(DISTINCT file_idx) FROM names) AS files_processed,
                (SELECT count(*) FROM full_rec) AS records_generated,
                (SELECT count(*) FROM coded_rec) AS records_with_mapped_codes,
                (SELECT count(*) FROM full_rec) - (SELECT count(*) FROM coded_rec)
                    AS records_excluded,
                (SELECT count(*) FROM item_rows) AS product_items_generated,
                (SELECT count(*) FROM coded_items) AS product_items_with_mapped_codes,
                (SELECT count(*) FROM item_rows) - (SELECT count(*) FROM coded_items)
                    AS product_items_excluded,
                (SELECT count(*) FROM kept_items) AS unique_product_items,
                (SELECT count(*) FROM no_code) AS unmapped_research_ids,
                (SELECT count(*) FROM bad_files) + (SELECT count(*) FROM strange)
                    + (SELECT count(*) FROM type_gaps) AS errors""",
        "dedup_items": """SELECT item, CAST(min(file_idx) AS BIGINT) AS file_idx,
                arg_min(description, (file_idx, ord)) AS description
            FROM coded_items GROUP BY item""",
        # Whole pipelines and sinks
        "product_items": """SELECT file_idx, "group", item, description FROM item_rows""",
        "matrix_update": f"SELECT {_MATRIX} FROM coded_rec",
        "product_item_update": 'SELECT "group", item, description FROM kept_items',
        "write_matrix": f"SELECT {_MATRIX} FROM coded_rec",
        "write_items": 'SELECT "group", item, description FROM kept_items',
        "write_errors": f"""SELECT *, CASE WHEN error_type = '{C.ERR_UNMAPPED}'
                THEN '{C.UNMAPPED_IMPACT.replace("'", "''")}' END AS impact,
                CAST(NULL AS VARCHAR) AS research_id FROM error_rows
            UNION ALL
            SELECT '{C.ERR_UNMAPPED}', NULL, NULL, NULL, research_id FROM no_code""",
        "folder_matrix": f"SELECT {_MATRIX} FROM coded_rec",
        "matrix_order": f"""SELECT {_MATRIX}, row_number() OVER (
                ORDER BY file_idx, geo_idx, ord, side, tax_type) AS position FROM placed_rec
            UNION ALL
            SELECT {_MATRIX.replace(" item,", " item_code AS item,")}, NULL FROM copied
            JOIN code_dim ON research_key = __norm(item)""",
        "item_order": """SELECT "group", item, description, row_number() OVER (ORDER BY item) AS position
            FROM kept_items""",
        "error_document": f"""SELECT *, CASE WHEN error_type = '{C.ERR_UNMAPPED}'
                THEN '{C.UNMAPPED_IMPACT.replace("'", "''")}' END AS impact,
                CAST(NULL AS VARCHAR) AS research_id FROM error_rows
            UNION ALL
            SELECT NULL, NULL, NULL, NULL, research_id FROM no_code""",
    }
    return {name: _with(sql) for name, sql in finals.items()}
