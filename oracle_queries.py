"""The registered queries once more, as SQL for DuckDB over the same tables."""

from redress.plans.feed import feed_query

FEED = feed_query()
# Legal forms that a company's name may end in.
LEGAL_SUFFIXES = (
    r"\b(LLC|L\.?L\.?C\.?|INC\.?|INCORPORATED|CORP\.?|CORPORATION|CO\.?|COMPANY"
    r"|LTD\.?|LIMITED|N\.?A\.?|NATIONAL ASSOCIATION)\b"
)

# Each name may use those before it.
TABLES = {
    "feed": FEED,
    "products": """
        SELECT CAST(row_number() OVER (ORDER BY product_name NULLS FIRST,
                                       sub_product_name NULLS FIRST) AS INTEGER) AS product_id,
               product_name, sub_product_name
        FROM (SELECT DISTINCT product_name, sub_product_name FROM feed)""",
    "issues": """
        SELECT CAST(row_number() OVER (ORDER BY issue_name NULLS FIRST,
                                       sub_issue_name NULLS FIRST) AS INTEGER) AS issue_id,
               issue_name, sub_issue_name
        FROM (SELECT DISTINCT issue_name, sub_issue_name FROM feed)""",
    "companies": """
        SELECT CAST(row_number() OVER (ORDER BY company_name NULLS FIRST) AS INTEGER) AS company_id,
               company_name
        FROM (SELECT DISTINCT upper(trim(company_name)) AS company_name FROM feed)""",
}

_FACT = """
        SELECT CAST(f.complaint_id AS BIGINT) AS complaint_id, product_id, issue_id, company_id,
               CAST(date_received AS DATE) AS date_received,
               CAST(date_sent_to_company AS DATE) AS date_sent_to_company,
               state, zip_code, submitted_via, consumer_consent,
               COALESCE(timely_response = 'Yes', FALSE) AS timely_response,
               COALESCE(consumer_disputed = 'Yes', FALSE) AS consumer_disputed,
               tags, company_response, complaint_narrative
        FROM feed f
        LEFT JOIN products p ON f.product_name {eq} p.product_name
                            AND f.sub_product_name {eq} p.sub_product_name
        LEFT JOIN issues i ON f.issue_name {eq} i.issue_name
                          AND f.sub_issue_name {eq} i.sub_issue_name
        LEFT JOIN companies c ON upper(trim(f.company_name)) {eq} c.company_name"""

TABLES["fact"] = _FACT.format(eq="IS NOT DISTINCT FROM")
TABLES["fact_eq"] = _FACT.format(eq="=")
TABLES["cleaned"] = """
        SELECT *, regexp_replace(zip_code, '[^0-9]', '', 'g') AS zip_code_clean,
               trim(regexp_replace(state, '[^A-Z]', '', 'g')) AS state_clean,
               CASE WHEN regexp_full_match(regexp_replace(zip_code, '[^0-9]', '', 'g'), '[0-9]{5}')
                    THEN regexp_replace(zip_code, '[^0-9]', '', 'g') END AS zip_valid,
               product_id AS product_id_safe
        FROM fact"""
TABLES["complaints"] = """
        SELECT *, CAST(date_sent_to_company - date_received AS INTEGER) AS response_days,
               CASE WHEN date_sent_to_company - date_received = 0 THEN 'Same Day'
                    WHEN date_sent_to_company - date_received <= 3 THEN '1-3 Days'
                    WHEN date_sent_to_company - date_received <= 7 THEN '4-7 Days'
                    WHEN date_sent_to_company - date_received <= 14 THEN '8-14 Days'
                    WHEN date_sent_to_company - date_received <= 30 THEN '15-30 Days'
                    WHEN date_sent_to_company - date_received > 30 THEN 'Over 30 Days'
                    ELSE 'Unknown' END AS response_band,
               CAST(year(date_received) AS INTEGER) AS year_received
        FROM cleaned"""
TABLES["tagged"] = r"""
        SELECT *, unnest(CASE WHEN tags IS NULL THEN [NULL]
                              ELSE string_split_regex(tags, ',\s*') END) AS individual_tag
        FROM complaints"""
TABLES["combined"] = """
        SELECT c.*, product_name, sub_product_name, issue_name, sub_issue_name, company_name
        FROM complaints c LEFT JOIN products USING (product_id)
                          LEFT JOIN issues USING (issue_id)
                          LEFT JOIN companies USING (company_id)"""
TABLES["names"] = rf"""
        SELECT company_name, count(*) AS complaints,
               upper(trim(company_name, E' \t\n\r\f\v')) AS case_key,
               regexp_replace(trim(regexp_replace(upper(company_name), '[^A-Za-z0-9 ]', '', 'g')),
                              '\s+', ' ', 'g') AS punct_key,
               regexp_replace(trim(regexp_replace(
                   regexp_replace(upper(company_name), '{LEGAL_SUFFIXES}', '', 'g'),
                   '[^A-Z0-9 ]', '', 'g')), '\s+', ' ', 'g') AS suffix_key
        FROM feed
        WHERE company_name IS NOT NULL AND length(company_name) <= 300 AND company_name <> ''
        GROUP BY company_name"""
# Rows of the malformed file, by the last digit of the complaint id.
TABLES["broken"] = r"""
        SELECT *, CASE complaint_id % 40 WHEN 1 THEN 8 WHEN 11 THEN 9 WHEN 21 THEN 10
                       ELSE complaint_id % 10 END AS kind FROM fact"""
TABLES["misfit"] = """
        SELECT * REPLACE (CASE WHEN complaint_id % 50 = 11 THEN product_id + 1000000
                               ELSE product_id END AS product_id,
                          CASE WHEN complaint_id % 50 = 11 THEN issue_id + 1000000
                               ELSE issue_id END AS issue_id,
                          CASE WHEN complaint_id % 50 = 11 THEN company_id + 1000000
                               ELSE company_id END AS company_id)
        FROM fact_eq"""


def _with(sql: str) -> str:
    """Prefix ``sql`` with every table above; unused ones cost nothing."""
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in TABLES.items())
    return f"WITH {ctes}\n{sql}"


def _pct(part: str, whole: str, places: int = 2) -> str:
    """Half-up percentage on whole numbers."""
    scale = 10**places
    return (
        f"CAST((({200 * scale} * ({part}) + ({whole})) // (2 * ({whole}))) AS DOUBLE) / {scale}"
    )


_FACT_COLS = (
    "complaint_id, product_id, issue_id, company_id, date_received, date_sent_to_company, state, "
    "zip_code, submitted_via, consumer_consent, timely_response, consumer_disputed, tags, "
    "company_response, complaint_narrative"
)
_RAW = (
    "product_name, sub_product_name, issue_name, sub_issue_name, company_name, company_response, "
    "state, zip_code, submitted_via, consumer_consent, timely_response, consumer_disputed, tags, "
    "complaint_narrative"
)
_RAW_TEXT = f"SELECT CAST(complaint_id AS VARCHAR) AS complaint_id, date_received, date_sent_to_company, {_RAW} FROM feed"
_TIMELY = "CAST(sum(CASE WHEN timely_response THEN 1 ELSE 0 END) AS BIGINT)"
_DISPUTED = "CAST(sum(CASE WHEN consumer_disputed THEN 1 ELSE 0 END) AS BIGINT)"


def _variants(key: str) -> str:
    skip = "WHERE suffix_key <> ''" if key == "suffix_key" else ""
    return f"""
        SELECT name_key, variants, company_name, complaints FROM (
            SELECT {key} AS name_key, count(*) OVER (PARTITION BY {key}) AS variants,
                   company_name, complaints
            FROM names {skip})
        WHERE variants > 1"""


QUERIES = {
    # KPI pack
    "q1_top_companies": """
        SELECT company_name, count(complaint_id) AS total_complaints
        FROM complaints JOIN companies USING (company_id)
        GROUP BY company_name ORDER BY total_complaints DESC, company_name LIMIT 10""",
    "q2_high_volume_products": """
        SELECT product_name, count(complaint_id) AS complaint_count
        FROM complaints JOIN products USING (product_id)
        GROUP BY product_name HAVING count(complaint_id) > 500""",
    "q3_above_average_companies": """
        SELECT company_name, count(complaint_id) AS complaint_count
        FROM complaints JOIN companies USING (company_id)
        GROUP BY company_name
        HAVING count(complaint_id) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM complaints
                                                          GROUP BY company_id))""",
    "q4_volume_tiers": """
        SELECT company_name, count(complaint_id) AS total,
               CASE WHEN count(complaint_id) >= 10000 THEN 'Critical'
                    WHEN count(complaint_id) >= 1000 THEN 'High'
                    WHEN count(complaint_id) >= 100 THEN 'Medium' ELSE 'Low' END AS volume_tier
        FROM complaints JOIN companies USING (company_id)
        GROUP BY company_name ORDER BY total DESC, company_name LIMIT 20""",
    "q4_volume_tiers_low_floors": """
        SELECT company_name, count(complaint_id) AS total,
               CASE WHEN count(complaint_id) >= 360 THEN 'Critical'
                    WHEN count(complaint_id) >= 300 THEN 'High'
                    WHEN count(complaint_id) >= 80 THEN 'Medium' ELSE 'Low' END AS volume_tier
        FROM complaints JOIN companies USING (company_id)
        GROUP BY company_name ORDER BY total DESC, company_name LIMIT 300""",
    "q5_top_issues_per_product": """
        SELECT product_name, issue_name, issue_count, CAST(rnk AS INTEGER) AS rnk FROM (
            SELECT product_name, issue_name, count(complaint_id) AS issue_count,
                   rank() OVER (PARTITION BY product_name ORDER BY count(complaint_id) DESC) AS rnk
            FROM complaints JOIN products USING (product_id) JOIN issues USING (issue_id)
            GROUP BY product_name, issue_name)
        WHERE rnk <= 3""",
    "q6_timeliness_by_channel": f"""
        SELECT submitted_via, count(*) AS total_complaints, {_TIMELY} AS timely_count,
               {_pct(_TIMELY, "count(*)")} AS timely_pct
        FROM complaints GROUP BY submitted_via""",
    "q7_monthly_ytd": """
        SELECT month_start, monthly_count,
               CAST(sum(monthly_count) OVER (PARTITION BY year(month_start)
                                             ORDER BY month_start) AS BIGINT) AS ytd_running_total
        FROM (SELECT CAST(date_trunc('month', date_received) AS DATE) AS month_start,
                     count(*) AS monthly_count
              FROM complaints GROUP BY 1)""",
    "q7_monthly_ytd_nonnull": """
        SELECT month_start, monthly_count,
               CAST(sum(monthly_count) OVER (PARTITION BY substr(month_start, 1, 4)
                                             ORDER BY month_start) AS BIGINT) AS ytd_running_total
        FROM (SELECT substr(CAST(date_received AS VARCHAR), 1, 7) AS month_start,
                     count(*) AS monthly_count
              FROM complaints WHERE date_received IS NOT NULL GROUP BY 1)""",
    "q8_dispute_states": f"""
        SELECT state, count(complaint_id) AS total_complaints, {_DISPUTED} AS disputed,
               {_pct(_DISPUTED, "count(*)")} AS dispute_rate_pct
        FROM complaints GROUP BY state
        HAVING count(complaint_id) > 1000 AND 100 * {_DISPUTED} > 20 * count(*)""",
    "q9_leading_company": """
        SELECT product_name, company_name, complaints FROM (
            SELECT product_name, company_name, count(complaint_id) AS complaints,
                   rank() OVER (PARTITION BY product_name ORDER BY count(complaint_id) DESC) AS rnk
            FROM complaints JOIN products USING (product_id) JOIN companies USING (company_id)
            GROUP BY product_name, company_name)
        WHERE rnk = 1""",
    "q10_resolution_snapshot": f"""
        SELECT product_name, issue_name, count(complaint_id) AS total, {_TIMELY} AS timely,
               {_DISPUTED} AS disputed, {_pct(_TIMELY, "count(*)", 1)} AS timely_pct
        FROM complaints JOIN products USING (product_id) JOIN issues USING (issue_id)
        GROUP BY product_name, issue_name
        ORDER BY total DESC, product_name, issue_name LIMIT 25""",
    "q11_band_by_product": """
        SELECT product_name, response_band, count(complaint_id) AS complaint_count
        FROM complaints JOIN products USING (product_id)
        GROUP BY product_name, response_band""",
    # star build, cleaning, enrichment
    "star_products": "SELECT * FROM products",
    "star_issues": "SELECT * FROM issues",
    "star_companies": "SELECT * FROM companies",
    "star_complaints": "SELECT * FROM fact",
    "star_complaints_eqjoin": "SELECT * FROM fact_eq",
    "star_complaints_salted": "SELECT * FROM fact",
    "clean_zip_state": """
        SELECT complaint_id, zip_code, zip_code_clean, state, state_clean, zip_valid,
               product_id_safe FROM complaints""",
    "zip_status": """
        SELECT CASE WHEN zip_valid IS NOT NULL THEN 'Valid' ELSE 'Invalid/Null' END AS zip_status,
               count(*) AS count FROM complaints GROUP BY 1""",
    "changed_zips": """
        SELECT complaint_id, zip_code, zip_code_clean FROM complaints
        WHERE zip_code <> zip_code_clean""",
    "invalid_zips": """
        SELECT complaint_id, zip_code, zip_code_clean, zip_valid FROM complaints
        WHERE zip_valid IS NULL AND zip_code IS NOT NULL""",
    "state_pairs": "SELECT DISTINCT state, state_clean FROM complaints",
    "enrich_response": """
        SELECT complaint_id, date_received, date_sent_to_company, response_days, response_band,
               year_received FROM complaints""",
    "band_distribution": """
        SELECT response_band, count(*) AS count FROM complaints GROUP BY response_band""",
    "tags_exploded": "SELECT complaint_id, tags, individual_tag FROM tagged",
    "tag_counts": "SELECT individual_tag, count(*) AS count FROM tagged GROUP BY individual_tag",
    "gold_combined": "SELECT * FROM combined",
    "gold_combined_large": "SELECT * FROM combined",
    # relational operators
    "join_bucketed": """
        SELECT complaint_id, company_name FROM complaints JOIN companies USING (company_id)""",
    "running_total_rows": """
        SELECT complaint_id, year_received, date_received, response_days,
               CAST(sum(response_days) OVER (PARTITION BY year_received
                                             ORDER BY date_received NULLS FIRST) AS BIGINT)
                 AS days_so_far FROM complaints""",
    "join_one_dimension": """
        SELECT complaint_id, company_name FROM complaints JOIN companies USING (company_id)""",
    "join_one_dimension_salted": """
        SELECT complaint_id, company_name FROM complaints JOIN companies USING (company_id)""",
    "join_two_dimensions": """
        SELECT complaint_id, product_name, issue_name
        FROM complaints JOIN products USING (product_id) JOIN issues USING (issue_id)""",
    "join_two_dimensions_eqstar": """
        SELECT complaint_id, product_name, issue_name
        FROM fact_eq JOIN products USING (product_id) JOIN issues USING (issue_id)""",
    "row_count": "SELECT count(*) AS row_count FROM complaints",
    "count_by_column": """
        SELECT submitted_via, count(date_received) AS dated FROM complaints
        GROUP BY submitted_via""",
    "count_by_expression": """
        SELECT substr(zip_valid, 1, 2) AS zip_area, count(*) AS count
        FROM complaints GROUP BY 1 HAVING count(*) > 10""",
    "mean_group_count": """
        SELECT avg(n) AS mean_count FROM (SELECT count(*) AS n FROM complaints
                                          GROUP BY company_id)""",
    "max_group_count": """
        SELECT product_id, max(n) AS max_count FROM (
            SELECT product_id, company_id, count(*) AS n FROM complaints GROUP BY 1, 2)
        GROUP BY product_id""",
    "enforced_schema": f"""
        SELECT {_FACT_COLS} FROM (SELECT * REPLACE (TRY_CAST(zip_code AS INTEGER) AS product_id)
                                  FROM fact)""",
    "views_listed": """
        SELECT unnest(['products', 'issues', 'companies', 'complaints', 'complaint_tags'])
               AS view_name""",
    "tags_view": "SELECT individual_tag, count(*) AS n FROM tagged GROUP BY individual_tag",
    "sample_rows_hold": "SELECT CAST(15 AS BIGINT) AS sampled, CAST(15 AS BIGINT) AS found",
    "schema_report": """
        SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, kind[1] AS "column",
               kind[2] AS type FROM (SELECT unnest([
            ['complaint_id', 'bigint'], ['product_id', 'int'], ['issue_id', 'int'],
            ['company_id', 'int'], ['date_received', 'date'], ['date_sent_to_company', 'date'],
            ['state', 'string'], ['zip_code', 'string'], ['submitted_via', 'string'],
            ['consumer_consent', 'string'], ['timely_response', 'boolean'],
            ['consumer_disputed', 'boolean'], ['tags', 'string'], ['company_response', 'string'],
            ['complaint_narrative', 'string']]) AS kind)""",
    "storage_report_holds": """
        SELECT 'parquet' AS label, TRUE AS filled, TRUE AS smallest, TRUE AS at_least_once
        UNION ALL SELECT 'csv', TRUE, FALSE, TRUE""",
    "sql_over_views": """
        SELECT product_name, response_band, count(*) AS n
        FROM complaints JOIN products USING (product_id) GROUP BY 1, 2""",
    "fn_name_keys": """
        SELECT company_name, upper(trim(company_name)) AS clean_name, case_key, punct_key,
               suffix_key, CAST(length(company_name) AS INTEGER) AS name_length FROM names""",
    "fn_text": """
        SELECT complaint_id, regexp_replace(zip_code, '[^0-9]', '', 'g') AS zip_digits,
               trim(regexp_replace(complaint_narrative, '[^A-Z]', '', 'g')) AS capitals,
               TRY_CAST(zip_code AS INTEGER) AS zip_int,
               coalesce(trim(substr(state, 1, 1)) = '', TRUE) AS blank_start,
               NULLIF(trim(substr(state, 1, 1)), '') AS start_or_null,
               lower(CASE WHEN timely_response = 'Yes' THEN 'TRUE'
                          WHEN timely_response = 'No' THEN 'x' END) = 'true' AS is_true,
               coalesce(timely_response = 'Yes', FALSE) AS is_yes
        FROM feed""",
    "fn_dates": """
        SELECT complaint_id, d AS parsed, d AS parsed_us, CAST(year(d) AS INTEGER) AS year,
               strftime(d, '%Y-%m') AS month_key, strftime(d, '%Y') AS month_key_year,
               CAST(date_trunc('month', d) AS DATE) AS month_start,
               CAST(s - d AS INTEGER) AS days
        FROM (SELECT complaint_id, CAST(date_received AS DATE) AS d,
                     CAST(date_sent_to_company AS DATE) AS s FROM feed)""",
    # audits
    "dq_row_counts": """
        SELECT 'products' AS table_name, count(*) AS row_count FROM products
        UNION ALL SELECT 'issues', count(*) FROM issues
        UNION ALL SELECT 'companies', count(*) FROM companies
        UNION ALL SELECT 'complaints', count(*) FROM complaints""",
    "dq_future_dates": """
        SELECT complaint_id, date_received FROM complaints WHERE date_received > DATE '2001-06-30'""",
    "dq_future_dates_today": """
        SELECT count(*) AS future_dates FROM complaints
        WHERE complaint_id % 90 = 1 AND date_received + INTERVAL 100 YEAR > current_date""",
    "dq_future_dates_count": """
        SELECT count(*) AS future_dates FROM complaints
        WHERE date_received > DATE '2001-06-30'""",
    "dq_blank_names": """
        SELECT product_id, sub_product_name FROM products
        WHERE sub_product_name IS NULL OR trim(sub_product_name) = ''""",
    "dq_illogical_dates": """
        SELECT complaint_id, date_received, date_sent_to_company FROM complaints
        WHERE date_sent_to_company < date_received""",
    "dq_illogical_dates_count": """
        SELECT count(*) AS illogical_dates FROM complaints
        WHERE date_sent_to_company < date_received""",
    "dq_orphans": """
        SELECT f.complaint_id, f.product_id FROM misfit f
        LEFT JOIN products p ON f.product_id = p.product_id
        WHERE p.product_id IS NULL""",
    "dq_orphans_salted": """
        SELECT f.complaint_id, f.product_id FROM misfit f
        LEFT JOIN products p ON f.product_id = p.product_id
        WHERE p.product_id IS NULL""",
    "dq_orphans_count": """
        SELECT count(*) AS orphan_complaints FROM fact_eq f
        LEFT JOIN products p ON f.product_id = p.product_id WHERE p.product_id IS NULL""",
    "dq_fk": """
        SELECT 'product_id' AS fk, CAST(product_id AS BIGINT) AS value, count(*) AS rows
        FROM misfit WHERE product_id NOT IN (SELECT product_id FROM products) GROUP BY 1, 2
        UNION ALL
        SELECT 'issue_id', CAST(issue_id AS BIGINT), count(*)
        FROM misfit WHERE issue_id NOT IN (SELECT issue_id FROM issues) GROUP BY 1, 2
        UNION ALL
        SELECT 'company_id', CAST(company_id AS BIGINT), count(*)
        FROM misfit WHERE company_id NOT IN (SELECT company_id FROM companies) GROUP BY 1, 2""",
    "dq_pk": """
        SELECT complaint_id, count(*) AS rows FROM complaints GROUP BY complaint_id
        HAVING count(*) > 1 OR complaint_id IS NULL""",
    "dq_unique_companies": """
        SELECT company_name, count(*) AS rows FROM (
            SELECT company_name FROM companies
            UNION ALL SELECT company_name FROM companies WHERE company_id % 10 = 0
            UNION ALL SELECT NULL)
        GROUP BY company_name HAVING count(*) > 1 OR company_name IS NULL""",
    "dq_declared_lengths": """
        SELECT table_name, key, column_name AS "column", CAST(n AS INTEGER) AS max_length,
               CAST(actual AS INTEGER) AS actual_length FROM (
            SELECT 'products' AS table_name, CAST(product_id AS BIGINT) AS key,
                   'product_name' AS column_name, 100 AS n,
                   length(CASE WHEN product_id % 9 = 1 THEN repeat(coalesce(product_name, 'x'), 300)
                               ELSE product_name END) AS actual FROM products
            UNION ALL SELECT 'products', product_id, 'sub_product_name', 150,
                   length(sub_product_name) FROM products
            UNION ALL SELECT 'issues', issue_id, 'issue_name', 200, length(issue_name) FROM issues
            UNION ALL SELECT 'issues', issue_id, 'sub_issue_name', 250,
                   length(CASE WHEN issue_id % 9 = 1 THEN repeat(coalesce(sub_issue_name, 'x'), 300)
                               ELSE sub_issue_name END) FROM issues
            UNION ALL SELECT 'companies', company_id, 'company_name', 200,
                   length(CASE WHEN company_id % 9 = 1 THEN repeat(coalesce(company_name, 'x'), 300)
                               ELSE company_name END) FROM companies
            UNION ALL SELECT 'complaints', complaint_id, 'state', w,
                   length(CASE WHEN complaint_id % 9 = 1 THEN repeat(coalesce(state, 'x'), 300)
                               ELSE state END) FROM complaints, (VALUES (5), (50)) AS v(w)
            UNION ALL SELECT 'complaints', complaint_id, 'zip_code', w, length(zip_code)
                   FROM complaints, (VALUES (10), (20)) AS v(w)
            UNION ALL SELECT 'complaints', complaint_id, 'submitted_via', 30, length(submitted_via)
                   FROM complaints
            UNION ALL SELECT 'complaints', complaint_id, 'consumer_consent', 50,
                   length(consumer_consent) FROM complaints
            UNION ALL SELECT 'complaints', complaint_id, 'tags', 50, length(tags) FROM complaints
            UNION ALL SELECT 'complaints', complaint_id, 'company_response', 100,
                   length(company_response) FROM complaints)
        WHERE actual > n""",
    "dq_unparsed": """
        SELECT 'date_received' AS "column", '2024-13-45' AS text, count(*) AS rows FROM feed
        WHERE complaint_id % 70 = 1
        UNION ALL SELECT 'date_received', '13/1/2024', count(*) FROM feed
        WHERE complaint_id % 70 = 4
        UNION ALL SELECT 'complaint_id', complaint_id || 'x', count(*) FROM feed
        WHERE complaint_id % 70 = 5 GROUP BY 2
        UNION ALL SELECT 'consumer_disputed', consumer_disputed, count(*) FROM feed
        WHERE consumer_disputed NOT IN ('Yes', 'No') GROUP BY 2""",
    "dq_overlength": """
        SELECT complaint_id, column_name AS "column", CAST(max_length AS INTEGER) AS max_length,
               CAST(actual_length AS INTEGER) AS actual_length FROM (
            SELECT complaint_id, 'tags' AS column_name, 14 AS max_length,
                   length(tags) AS actual_length FROM complaints
            UNION ALL
            SELECT complaint_id, 'zip_code', 5, length(zip_code) FROM complaints
            UNION ALL
            SELECT complaint_id, 'state', 2, length(state) FROM complaints)
        WHERE actual_length > max_length""",
    "names_case": _variants("case_key"),
    "names_punct": _variants("punct_key"),
    "names_suffix": _variants("suffix_key"),
    "names_punct_first25": f"""
        SELECT name_key, variants, company_name, complaints FROM (
            SELECT *, dense_rank() OVER (ORDER BY name_key) AS pos
            FROM ({_variants("punct_key")}))
        WHERE pos <= 25""",
    "names_punct_rest": f"""
        SELECT greatest(count(DISTINCT name_key) - 25, 0) AS remaining
        FROM ({_variants("punct_key")})""",
    "names_summary": """
        SELECT (SELECT count(*) FROM feed) AS total_rows, (SELECT count(*) FROM names) AS raw_names,
               (SELECT count(*) FROM (SELECT case_key FROM names GROUP BY 1
                                      HAVING count(*) > 1)) AS case_groups,
               (SELECT count(*) FROM (SELECT punct_key FROM names GROUP BY 1
                                      HAVING count(*) > 1)) AS punct_groups,
               (SELECT count(*) FROM (SELECT suffix_key FROM names WHERE suffix_key <> ''
                                      GROUP BY 1 HAVING count(*) > 1)) AS suffix_groups,
               (SELECT count(DISTINCT case_key) FROM names) AS names_after_cleaning,
               (SELECT count(*) - count(DISTINCT case_key) FROM names) AS merged_names""",
    # sources and sinks
    "scan_raw": _RAW_TEXT,
    "scan_raw_large_files": _RAW_TEXT,
    "scan_raw_stray_quotes": r"""
        SELECT CAST(complaint_id AS VARCHAR) AS complaint_id, (complaint_id % 7) || '" pipe' AS a,
               CASE WHEN complaint_id % 3 = 0 THEN E'first\n\n"second" ' || complaint_id
                    ELSE 'x' || complaint_id END AS b FROM feed""",
    "scan_raw_blank_lines": r"""
        SELECT CAST(complaint_id AS VARCHAR) AS complaint_id, E'a\n\nb' AS a,
               CAST(complaint_id % 5 AS VARCHAR) AS b FROM feed""",
    "scan_raw_inferred": f"""
        SELECT CAST(complaint_id AS INTEGER) AS complaint_id,
               CAST(date_received AS DATE) AS date_received,
               CAST(date_sent_to_company AS DATE) AS date_sent_to_company, {_RAW} FROM feed""",
    "scan_table_inferred": f"""
        SELECT {_FACT_COLS} FROM (
            SELECT * REPLACE (CAST(complaint_id AS INTEGER) AS complaint_id) FROM fact)""",
    "scan_types_found": f"""
        SELECT {_FACT_COLS} FROM (
            SELECT * REPLACE (CAST(complaint_id AS INTEGER) AS complaint_id) FROM fact)""",
    "scan_table_fixed": "SELECT * FROM fact",
    "load_dimension": "SELECT * FROM companies",
    "load_fact": "SELECT * FROM fact",
    "load_planted": """
        SELECT CAST(complaint_id AS BIGINT) AS complaint_id,
               CAST(date_received AS DATE) AS received,
               COALESCE(timely_response = 'Yes', FALSE) AS flag
        FROM feed WHERE complaint_id % 7 IN (0, 5, 6)""",
    "load_rejected": """
        SELECT CASE complaint_id % 7 WHEN 1 THEN complaint_id || ','
                 WHEN 2 THEN concat_ws(',', complaint_id, date_received,
                   CASE WHEN timely_response = 'Yes' THEN 'true' ELSE 'false' END, 'more')
                 WHEN 3 THEN complaint_id || ',2024-02-30,true'
                 ELSE 'x' || complaint_id || ',2024-02-01,true' END AS record
        FROM feed WHERE complaint_id % 7 IN (1, 2, 3, 4)""",
    "load_counts": """
        SELECT count(*) FILTER (WHERE complaint_id % 7 IN (0, 5, 6)) AS loaded,
               count(*) FILTER (WHERE complaint_id % 7 IN (1, 2, 3, 4)) AS rejected FROM feed""",
    "layout_replaced_year": """
        SELECT complaint_id, CASE WHEN year_received = 1995 THEN 'ZZ' ELSE state END AS state,
               date_received, year_received FROM complaints""",
    "layout_pruned": """
        SELECT complaint_id, state, date_received FROM complaints
        WHERE year_received = 1996 AND state = 'HA' AND date_received >= DATE '1996-03-01'""",
    "verify_damaged": """
        SELECT format, (SELECT count(*) FROM complaints) AS expected,
               (SELECT count(*) FROM complaints) AS found, FALSE AS complete
        FROM (VALUES ('parquet'), ('csv')) AS formats(format)""",
    "parquet_roundtrip": "SELECT * FROM complaints",
    "csv_roundtrip": """
        SELECT * REPLACE (CAST(date_received AS VARCHAR) AS date_received,
                          CAST(date_sent_to_company AS VARCHAR) AS date_sent_to_company)
        FROM complaints""",
    "verify_written": """
        SELECT 'csv' AS format, count(*) AS expected, count(*) AS found, TRUE AS complete
        FROM complaints
        UNION ALL SELECT 'parquet', count(*), count(*), TRUE FROM complaints""",
    "repair_good": r"""
        SELECT * EXCLUDE (kind) REPLACE (CASE kind
            WHEN 3 THEN complaint_narrative || ' ' || state || ', more, "or" less, end'
            WHEN 7 THEN complaint_narrative || E'\nsecond line, "last"'
            WHEN 8 THEN 'He said no" to me"'
            ELSE complaint_narrative END AS complaint_narrative)
        FROM broken WHERE kind NOT IN (4, 5, 6, 9)""",
    "repair_rejected": """
        SELECT CASE kind WHEN 4 THEN 'fields' WHEN 5 THEN 'id' WHEN 6 THEN 'key'
                         WHEN 9 THEN 'date' ELSE 'id' END AS reason,
               CASE kind WHEN 4 THEN complaint_id || ',x'
                         WHEN 5 THEN 'broken ' || complaint_narrative
                         WHEN 6 THEN complaint_id || ',x9' || repeat(',', 13)
                         WHEN 9 THEN complaint_id || ',1,1,1,2024-13-45' || repeat(',', 10)
                         ELSE '' END AS record
        FROM broken WHERE kind IN (4, 5, 6, 9, 10)""",
    "repair_counts": """
        SELECT count(*) FILTER (WHERE kind NOT IN (4, 5, 6, 9)) AS loaded,
               count(*) FILTER (WHERE kind IN (4, 5, 6, 9, 10)) AS skipped FROM broken""",
    # layer flow
    "layers_combined": "SELECT * FROM combined",
    "layers_top_companies": """
        SELECT company_name, count(complaint_id) AS total_complaints
        FROM complaints JOIN companies USING (company_id)
        GROUP BY company_name ORDER BY total_complaints DESC, company_name LIMIT 10""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in QUERIES.items()}
