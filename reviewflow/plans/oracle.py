"""The same results as `queries`, as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

WORD_COUNTS = """
    SELECT word, CAST(count(*) AS BIGINT) AS ct
    FROM (
        SELECT unnest(string_split(lower(regexp_replace(line, '[^a-zA-Z ]', '', 'g')), ' ')) AS word
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) AS lines
    ) AS tokens
    WHERE length(word) > 0
    GROUP BY word"""

PRODUCT = "(o_orderkey % 1000)"
DATE_TEXT = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '-06:00'"

# All review fields but the date, as order_reviews tells them.
REVIEW_FIELDS = f"""
    'US' AS marketplace,
    CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS customer_id,
    'R' || o_orderkey AS review_id,
    'B' || {PRODUCT} AS product_id,
    CAST({PRODUCT} AS INTEGER) AS product_parent,
    'Product ' || {PRODUCT} AS product_title,
    o_orderstatus AS product_category,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS star_rating,
    CAST(o_orderkey % 5 AS INTEGER) AS helpful_votes,
    CAST(o_orderkey % 5 + o_orderkey % 3 AS INTEGER) AS total_votes,
    'N' AS vine,
    CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS verified_purchase,
    o_orderpriority AS review_headline,
    o_orderpriority || ' ' || o_orderstatus || ' ' || o_custkey AS review_body"""

TYPED_REVIEWS = f"""
    SELECT {REVIEW_FIELDS}, CAST(epoch(o_orderdate) AS BIGINT) + 21600 AS review_epoch
    FROM orders"""

TEXT_REVIEWS = f"""
    SELECT CAST(COLUMNS(*) AS VARCHAR)
    FROM (SELECT {REVIEW_FIELDS}, {DATE_TEXT} AS review_date FROM orders) AS reviews"""

REVIEW_LINES = f"""
    SELECT concat_ws(chr(9), marketplace, customer_id, review_id, product_id, product_parent,
                     product_title, product_category, star_rating, helpful_votes, total_votes, vine,
                     verified_purchase, review_headline, review_body, review_date) AS value
    FROM (SELECT {REVIEW_FIELDS}, {DATE_TEXT} AS review_date FROM orders) AS reviews"""

CUSTOMERS = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
           lower(replace(c_name, '#', '.')) AS username,
           c_mktsegment || ' ' || c_custkey AS name,
           CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           strftime(DATE '1930-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') AS birthdate,
           c_custkey
    FROM customer"""

LOOKUP_FIELDS = "customer_id, username, name, email, birthdate"

ENRICHED = f"""
    SELECT c.customer_id, 'R' || o_orderkey AS review_id, 'Product ' || {PRODUCT} AS product_title,
           c.username, c.name
    FROM orders JOIN ({CUSTOMERS}) AS c ON c.c_custkey = o_custkey
    WHERE o_orderkey % 10 <> 0"""

ORACLE = {
    "word_count": WORD_COUNTS,
    "word_count_sql": WORD_COUNTS,
    "top_words": f"{WORD_COUNTS} ORDER BY ct DESC, word LIMIT 20",
    "word_count_stream": WORD_COUNTS,
    "text_lines": r"""
        SELECT value
        FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) AS lines
        WHERE regexp_matches(value, '[^\x00-\x20]')""",
    "tsv_scan": TEXT_REVIEWS,
    "customer_scan": f"""
        SELECT customer_id, username, name, sex, email, birthdate FROM ({CUSTOMERS}) AS c""",
    "first_n": f"""
        SELECT customer_id, username, name, sex, email, birthdate FROM ({CUSTOMERS}) AS c
        ORDER BY c_custkey LIMIT 10""",
    "rows_to_table": f"""
        SELECT star_rating, rating_name, CAST(count(*) AS BIGINT) AS reviews
        FROM (SELECT {REVIEW_FIELDS} FROM orders) AS r
        JOIN (VALUES (1, 'One Star'), (2, 'Two Stars'), (3, 'Three Stars'), (4, 'Four Stars'),
                     (5, 'Five Stars')) AS names(rating, rating_name) ON rating = star_rating
        GROUP BY star_rating, rating_name""",
    "parse_tsv": TEXT_REVIEWS,
    "parse_json": TYPED_REVIEWS,
    "parse_event_json": """
        SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS absent
        FROM events""",
    "avg_rating": """
        SELECT round(avg(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)), 2) AS avg_star_rating
        FROM orders""",
    "point_lookup": f"SELECT {LOOKUP_FIELDS} FROM ({CUSTOMERS}) AS c WHERE c_custkey = 23",
    "batch_lookup": f"""
        SELECT {LOOKUP_FIELDS} FROM ({CUSTOMERS}) AS c
        WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 <> 0)""",
    "enrich_join": ENRICHED,
    "enrich_stream": ENRICHED,
    "latest_per_key": """
        SELECT user_id, event_id, event_type, props
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "put_rows": """
        SELECT customer_id, note, put_id
        FROM (
            SELECT c_custkey AS customer_id, c_mktsegment AS note, CAST(-1 AS BIGINT) AS put_id
            FROM customer
            UNION ALL
            SELECT o_custkey, o_orderstatus, o_orderkey FROM orders
        ) AS puts
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY put_id DESC) = 1""",
    "publish_keyed_csv": """
        SELECT CAST(conv_id AS VARCHAR) AS key,
               conv_id || ',' || replace(coalesce(role, ''), ',', '') || ','
                       || replace(coalesce(text, ''), ',', '') AS value
        FROM conversations""",
    "publish_users": f"""
        SELECT CAST(c_custkey + 1 AS VARCHAR) AS key,
               (c_custkey + 1) || ',' || replace(name, ',', '') || ',' || replace(email, ',', '')
                   AS value
        FROM ({CUSTOMERS}) AS c""",
    "publish_and_drain": f"SELECT 'reviews' AS topic, value FROM ({REVIEW_LINES}) AS lines",
    "ingest_parquet_stream": TYPED_REVIEWS,
    "ingest_restart": TYPED_REVIEWS,
    "rating_histogram": f"""
        SELECT CAST(id AS BIGINT) AS star_rating, CAST(count(review_id) AS BIGINT) AS reviews
        FROM range(1, 6) AS ratings(id) LEFT JOIN ({TYPED_REVIEWS}) AS reviews ON star_rating = id
        GROUP BY id""",
    "external_table": f"""
        SELECT product_category, CAST(count(*) AS BIGINT) AS reviews,
               CAST(count(*) AS BIGINT) AS stamped, CAST(sum(total_votes) AS BIGINT) AS votes
        FROM ({TYPED_REVIEWS}) AS reviews
        GROUP BY product_category""",
    "query_to_location": f"""
        SELECT product_id, CAST(count(*) AS BIGINT) AS reviews,
               round(avg(star_rating), 2) AS avg_star_rating
        FROM ({TYPED_REVIEWS}) AS reviews
        GROUP BY product_id""",
    "key_lookup": f"SELECT {LOOKUP_FIELDS} FROM ({CUSTOMERS}) AS c WHERE c_custkey = 23",
    "word_count_updates": WORD_COUNTS,
    "top_words_stream": f"{WORD_COUNTS} ORDER BY ct DESC, word LIMIT 20",
    "enriched_table": f"""
        SELECT customer_id, username, CAST(count(*) AS BIGINT) AS reviews, max(review_id) AS last_review
        FROM ({ENRICHED}) AS enriched
        GROUP BY customer_id, username""",
    "batch_progress": """
        SELECT (o_orderkey % 6) // 2 AS batch_id, CAST(count(*) AS BIGINT) AS input_rows
        FROM orders GROUP BY batch_id""",
    "good_records": f"SELECT * FROM ({TYPED_REVIEWS}) AS reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 7 <> 0",
    "malformed_records": f"""
        SELECT substr('{{"marketplace":"US","customer_id":' || customer_id || ',"review_id":"' || review_id || '"', 1, 40)
               AS value
        FROM ({TYPED_REVIEWS}) AS reviews WHERE CAST(substr(review_id, 2) AS BIGINT) % 7 = 0""",
    "table_stats": """
        SELECT 'reviews_loaded' AS table_name, CAST(count(*) AS BIGINT) AS row_count,
               true AS has_bytes
        FROM orders""",
}
