"""The queries that SQL can express, in DuckDB's SQL."""

from deskline.llm.license_scan import MORE_NOTICES, NOTICES

_TEMPLATES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in {**NOTICES, **MORE_NOTICES}.items())


def _words(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"[w for w in regexp_split_to_array({folded}, '[^\\p{{L}}\\p{{N}}]+') if w <> '']"


def _ngrams(words: str) -> str:
    return f"[array_to_string({words}[i:i + 2], ' ') for i in range(1, len({words}) - 1)]"


SQL = {
    # Every template's n-grams in every window that overlaps the next one by half.
    "op4_license_scan": f"""
WITH templates AS (
    SELECT license, list_distinct({_ngrams('words')}) AS grams
    FROM (SELECT license, {_words('template')} AS words FROM (VALUES {_TEMPLATES}) AS v(license, template))
),
wanted AS (
    SELECT license, len(grams) AS ngrams, CAST(pow(2, ceil(log2(2 * len(grams))) - 1) AS BIGINT) AS half, unnest(grams) AS gram
    FROM templates
),
texts AS (SELECT doc_id, {_words('text')} AS words FROM documents),
found AS (
    SELECT doc_id, unnest({_ngrams('words')}) AS gram, unnest(range(0, greatest(len(words) - 2, 0))) AS pos
    FROM texts
    WHERE len(words) > 2
),
hits AS (
    SELECT doc_id, license, ngrams, half, gram, unnest([at_window, greatest(at_window - 1, 0)]) AS number
    FROM (SELECT *, CAST(floor(pos / half) AS BIGINT) AS at_window FROM found JOIN wanted USING (gram))
),
windows AS (
    SELECT doc_id, license, ngrams, number * half AS first_word, count(DISTINCT gram) AS inside
    FROM hits
    GROUP BY doc_id, license, ngrams, half, number
)
SELECT doc_id, license, max(inside / ngrams) AS containment, CAST(ngrams AS INT) AS ngrams,
       CAST(min(first_word) AS INT) AS first_word
FROM windows
WHERE 100 * inside >= 80 * ngrams
GROUP BY doc_id, license, ngrams
""",
    "op8_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256,
       md5(coalesce(text, '')) AS content_hash
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op12_fill_in_middle": """
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
drawn AS (
    SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS third, CAST('0x' || h[25:32] AS BIGINT) % 100 AS fourth
    FROM texts
),
formed AS (
    SELECT *, least(x, y) AS a, greatest(x, y) AS b,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR third >= 90 THEN 'plain'
                WHEN fourth < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (SELECT *, left(t, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM formed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
}
