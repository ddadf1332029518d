"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from reviewflow.llm import lexical_search, line_dedup, quality_rules, source_mix, url_filter

ORACLE: dict[str, str] = {}


def _weights() -> str:
    """The weight of the terms of a URL `u`: one pattern with boundaries per term."""
    return " + ".join(
        f"CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') THEN {weight} ELSE 0 END"
        for term, weight in url_filter.VOCABULARY.items()
    )


def _rules(result: str) -> str:
    order = sorted(url_filter.RULES, key=lambda r: (-len(r.name), r.name))
    return " ".join(
        f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}') THEN '{getattr(r, result)}'"
        for r in order
    )


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op3_url_filters"] = f"""
    WITH cut AS (
        SELECT page_id, coalesce(url, '') AS url,
               CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    parts AS (
        SELECT page_id, {LOWER.format("url")} AS u, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
               regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
        FROM cut)
    SELECT page_id, host, path, CASE {_rules("name")} ELSE NULL END AS rule,
           CASE {_rules("verdict")} WHEN {_weights()} >= {url_filter.REJECT_AT} THEN 'block' ELSE 'allow' END AS verdict
    FROM parts"""

ORACLE["op6_line_dedup"] = f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr
        FROM documents),
    keyed AS (
        SELECT *, {LOWER.format("trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')")} AS key FROM lines),
    held AS (
        SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= {line_dedup.LEAST_LENGTH}
        GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS}),
    judged AS (
        SELECT doc_id, nr, line, largest IS NULL OR largest = doc_id AS keep FROM keyed LEFT JOIN held USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE keep), '')) AS kept_sha256
    FROM judged GROUP BY doc_id"""

MIX_LAST = "CAST(floor(rate / parts + 12 * sqrt(rate / parts) + 25) AS BIGINT)"
ORACLE["op8_mix_sources"] = f"""
    WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    shares AS (
        SELECT source, pow(n, {source_mix.TEMPERATURE}) / (SELECT sum(pow(n, {source_mix.TEMPERATURE})) FROM sizes)
               * (SELECT sum(n) FROM sizes) / n AS rate
        FROM sizes),
    rates AS (
        SELECT *, greatest(1, CAST(ceil(rate / {source_mix.LARGEST_PART}) AS BIGINT)) AS parts FROM shares),
    sums AS (
        SELECT source, 0 AS k, exp(-rate / parts) AS p, exp(-rate / parts) AS reached, rate, parts FROM rates
        UNION ALL
        SELECT source, k + 1, p * (rate / parts) / (k + 1), reached + p * (rate / parts) / (k + 1), rate, parts
        FROM sums WHERE k < {MIX_LAST}),
    tables AS (SELECT source, list(reached ORDER BY k) AS reached, any_value(parts) AS parts FROM sums GROUP BY source),
    drawn AS (
        SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda part: len(list_filter(reached, lambda s:
               s <= CAST('0x' || substr(md5(concat_ws('/', '{source_mix.SEED}', coalesce(CAST(doc_id AS VARCHAR), ''),
               CAST(part AS VARCHAR))), 1, {source_mix.HASH_DIGITS}) AS BIGINT) / {float(16**source_mix.HASH_DIGITS)!r})))) AS copies
        FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
    copied AS (
        SELECT doc_id, text, lang, source, n_chars, unnest(range(1, CAST(copies AS BIGINT) + 1)) AS copy FROM drawn)
    SELECT *, md5(concat_ws('/', '{source_mix.SEED}', 'order', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR))) AS shuffle_key
    FROM copied"""


def _starts(marks: tuple[str, ...]) -> str:
    return " OR ".join(f"prefix(bare, '{mark}')" for mark in marks)


def _ends(marks: tuple[str, ...]) -> str:
    return " OR ".join(f"suffix(bare, '{mark}')" for mark in marks)


WORD = r"[^\x20\x09-\x0D]+"
BLANK = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
ORACLE["op5_quality_rules"] = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    listed AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w FROM texts),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS nr FROM listed),
    windows AS (
        SELECT doc_id, nr, count(*) OVER (PARTITION BY doc_id, a, b, c) AS found
        FROM (SELECT doc_id, nr, word AS a, lead(word) OVER same AS b, lead(word, 2) OVER same AS c
              FROM words WINDOW same AS (PARTITION BY doc_id ORDER BY nr))
        WHERE c IS NOT NULL),
    repeated AS (
        SELECT doc_id, count(DISTINCT nr + i) AS n FROM windows, range(3) AS near(i) WHERE found > 1 GROUP BY doc_id),
    runs AS (
        SELECT doc_id, count(*) FILTER (WHERE word = before) AS n_runs,
               count(*) FILTER (WHERE regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_lettered
        FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY nr) AS before FROM words) GROUP BY doc_id),
    tops AS (
        SELECT doc_id, max(n) AS n_top FROM (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id, word) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, line, trim(line, {BLANK}) AS bare
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)),
    lined AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
               count(*) FILTER (WHERE {_starts(quality_rules.BULLETS)}) AS n_bullets,
               count(*) FILTER (WHERE {_ends(quality_rules.ELLIPSES)}) AS n_ellipses
        FROM lines WHERE bare <> '' GROUP BY doc_id),
    base AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
               n_lines, n_bullets, n_ellipses, n_runs, n_lettered, n_top
        FROM listed LEFT JOIN repeated USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN tops USING (doc_id)
        LEFT JOIN lined USING (doc_id)),
    judged AS (
        SELECT *, n_words < {quality_rules.LEAST_WORDS}
                  OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words AS base_failed
        FROM base)
    SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 14.0 * n_words
           AND n_symbols <= 0.1 * n_words AND n_dup_lines <= 0.3 * n_lines AND n_bullets <= 0.9 * n_lines
           AND n_ellipses <= 0.3 * n_lines AND n_lettered >= 0.7 * n_words AND n_runs <= 0.2 * n_words
           AND n_top <= 0.3 * n_words AS kept
    FROM judged"""

ORACLE["op2_ngram_jaccard"] = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
        FROM words),
    rows AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
    rare AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS nr
        FROM (SELECT *, count(*) OVER (PARTITION BY g) AS df FROM rows)),
    heads AS (SELECT doc_id, g, n FROM rare WHERE df > 1 AND nr <= n - (80 * n + 99) // 100 + 1),
    pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM heads a JOIN heads b ON a.g = b.g AND a.doc_id < b.doc_id
              AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
    links AS (
        SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
        WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
    edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reached AS (
        SELECT a AS doc_id, a AS other FROM edges UNION SELECT doc_id, b FROM reached JOIN edges ON other = a)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(r.least, s.doc_id) AS component_id
    FROM sets s LEFT JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) r ON r.doc_id = s.doc_id"""

TERMS = "regexp_extract_all(" + LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op11_lexical_search"] = f"""
    WITH held AS (
        SELECT row_number() OVER () AS nr, doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
    whole AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM held WHERE len(terms) > 0),
    posted AS (
        SELECT nr, doc_id, n, term, count(*) AS tf
        FROM (SELECT nr, doc_id, len(terms) AS n, unnest(terms) AS term FROM held) GROUP BY ALL),
    weighed AS (
        SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM posted, whole GROUP BY term),
    asked AS (
        SELECT item_id, text, term, count(*) AS times
        FROM (SELECT item_id, text, unnest({TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
    scored AS (
        SELECT item_id, text, doc_id, nr, CAST(sum(times * w *
               ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM asked JOIN weighed USING (term) JOIN posted USING (term), whole GROUP BY ALL),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INT) AS rank
        FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {lexical_search.BEST}"""
