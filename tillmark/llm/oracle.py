"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tillmark.llm.url_filter import DEFAULT_RULES, URL_PATTERN


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_RULES = ", ".join(f"({_text(r.label)}, {_text(r.verdict)}, {_text(r.pattern)})" for r in DEFAULT_RULES)

#: Control strings of the chat template, as DuckDB reads patterns.
_CONTROL = "(### ([A-Z][a-z0-9_]*|=[A-Za-z0-9_.~%-]*): |</turn>)"

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op5_url_filter": f"""
        WITH rules(label, rule_verdict, pattern) AS (VALUES {_RULES}),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), {_text(URL_PATTERN)}, 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), {_text(URL_PATTERN)}, 2) AS path
            FROM pages
        ),
        targets AS (SELECT DISTINCT host || path AS target FROM parts),
        matched AS (SELECT * FROM targets JOIN rules ON regexp_matches(target, pattern)),
        sites AS (
            SELECT target, label, rule_verdict,
                   row_number() OVER (PARTITION BY target
                                      ORDER BY length(label) DESC, rule_verdict DESC, label DESC) AS place
            FROM matched WHERE label IS NOT NULL
        ),
        patterns AS (SELECT target, bool_or(rule_verdict = 'block') AS blocked
                     FROM matched WHERE label IS NULL GROUP BY target)
        SELECT p.page_id, p.host, p.path, s.label AS rule,
               coalesce(s.rule_verdict, CASE WHEN x.blocked THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts p
        LEFT JOIN sites s ON s.target = p.host || p.path AND s.place = 1
        LEFT JOIN patterns x ON x.target = p.host || p.path
    """,
    "op11_lexical_search": rf"""
        WITH found AS (
            SELECT row_number() OVER () AS row_id, doc_id,
                   regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        lengths AS (SELECT row_id, doc_id, len(terms) AS n FROM found WHERE len(terms) > 0),
        whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM lengths),
        counts AS (
            SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM found) GROUP BY ALL
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, documents
        ),
        scores AS (
            SELECT item_id, row_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // total))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (row_id), whole
            GROUP BY item_id, row_id, doc_id
        )
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place
              FROM scores WHERE score > 0)
        WHERE place <= 10
    """,
    "op12_chat_format": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        written AS (
            SELECT *, '### ' || CASE WHEN regexp_full_match(role, '[a-z][a-z0-9_]*')
                                     THEN upper(role[1]) || role[2:] ELSE '=' || url_encode(role) END || ': '
                      || regexp_replace(text, '{_CONTROL}', '\\\1', 'g') || chr(10) || '</turn>' || chr(10) AS formatted
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, formatted))
                   AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, formatted)
                               FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(formatted))::BIGINT AS formatted_chars
        FROM written GROUP BY conv_id
    """,
    "op13_source_audit": rf"""
        WITH named AS (
            SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        groups AS (SELECT DISTINCT lang, source FROM named),
        occurrences AS (SELECT row_id, lang, source, unnest(terms) AS term FROM named),
        kept AS (SELECT lang, term, count(*) AS lang_count FROM occurrences
                 GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
        counts AS (SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY ALL),
        filled AS (SELECT lang, source, term, lang_count, coalesce(n, 0) AS n
                   FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
        sized AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total,
                         sum(n) OVER (PARTITION BY lang) AS lang_total,
                         2 * count(*) OVER (PARTITION BY lang, source) AS twice FROM filled),
        shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)::HUGEINT) // (total + twice) AS p,
                          1 + (1000000000 * (lang_count + 2)::HUGEINT) // (lang_total + twice) AS q FROM sized),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        answers AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT
            FROM shares WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM answers)
        WHERE part = 'pair' OR place <= 10
    """,
}
