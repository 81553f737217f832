"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from blotter.llm import url_rules

_CHAT = """
WITH t AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
    FROM conversations
), numbered AS (
    SELECT *, cast(floor(turn / 64.0) AS BIGINT) AS part,
        (row_number() OVER (PARTITION BY conv_id, floor(turn / 64.0) ORDER BY turn, role, text) - 1)
            // 64 AS slice
    FROM t
), views AS (
    SELECT t.*, p.participant, t.role = p.participant AS own
    FROM numbered t JOIN (SELECT DISTINCT conv_id, role AS participant FROM t) p
      ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), pieces AS (
    SELECT *,
        CASE WHEN own THEN '<|im_start|>assistant' || chr(10)
             ELSE '<|im_start|>user name='
                  || replace(translate(role, chr(13) || chr(10), '  '), '<|', '< |') || chr(10) END AS head,
        replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
    FROM views
), placed AS (
    SELECT *, sum(length(head) + length(body)) OVER (
        PARTITION BY conv_id, participant, part, slice ORDER BY turn NULLS FIRST, role, text
        ROWS UNBOUNDED PRECEDING) - length(body) AS start
    FROM pieces
)
SELECT conv_id, participant, part, slice, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
    string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
    coalesce(string_agg(cast(start AS VARCHAR) || '-' || cast(start + length(body) AS VARCHAR), ','
        ORDER BY turn NULLS FIRST, role, text) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, participant, part, slice
"""


def _urls() -> str:
    fits = []
    for rule in url_rules.RULES:
        quoted = rule.pattern.replace("'", "''")
        fits.append(
            f"SELECT '{rule.name}' AS name, '{rule.verdict}' AS verdict, {rule.scoped} AS scoped, "
            f"'{quoted}' AS pattern"
        )
    return f"""
WITH rules AS ({' UNION ALL '.join(fits)}), p AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), h AS (
    SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM p
), parts AS (
    SELECT page_id, url, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), judged AS (
    SELECT u.host, u.path, max(struct_pack(scoped := r.scoped, n := length(r.name), name := r.name, verdict := r.verdict)) AS best
    FROM (SELECT DISTINCT host, path FROM parts WHERE url LIKE '%://%') u
    JOIN rules r ON regexp_matches(u.host || u.path, r.pattern)
    GROUP BY u.host, u.path
)
SELECT page_id, parts.host, parts.path, CASE WHEN best.scoped THEN best.name END AS rule,
    coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN judged ON parts.host = judged.host AND parts.path = judged.path AND parts.url LIKE '%://%'
"""


def _mix(mix) -> str:
    levels = ("domain", "lang", "source")
    steps = []
    for depth, level in enumerate(levels):
        keys, above = ", ".join(levels[: depth + 1]), ", ".join(levels[:depth])
        cases = "".join(
            f" WHEN {level} = '{k}' THEN {v}" for k, v in mix.weights.get(level, {}).items()
        )
        weight = f"CASE{cases} ELSE 1 END" if cases else "1"
        budget = (
            f"JOIN b{depth - 1} USING ({above})" if depth
            else f"CROSS JOIN (SELECT cast(sum(leaf_tokens) * {mix.budget_pct} // 100 AS BIGINT) AS budget FROM leaves)"
        )
        part = f"PARTITION BY {above}" if depth else ""
        steps.append(f"""n{depth} AS (
    SELECT * FROM (SELECT {keys}, cast(sum(leaf_tokens * {mix.epochs}) AS BIGINT) AS cap, cast({weight} AS BIGINT) AS w
        FROM leaves GROUP BY {keys}) WHERE w > 0
), o{depth} AS (
    SELECT n.*, budget, sum(w) OVER (ordered ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_from,
        sum(cap) OVER (ordered ROWS UNBOUNDED PRECEDING) - cap AS before
    FROM n{depth} n {budget} WINDOW ordered AS ({part} ORDER BY cap / w, {level})
), f{depth} AS (SELECT *, cap * w_from + before * w <= budget * w AS filled FROM o{depth}
), b{depth} AS (
    SELECT {keys}, cast(CASE WHEN filled THEN cap ELSE (budget - taken) * w // open END AS BIGINT) AS budget
    FROM (SELECT *, sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({part}) AS taken,
        sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({part}) AS open FROM f{depth})
)""")
    return f"""
WITH d AS (
    SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
        CASE try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 3
            WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forum' ELSE 'other' END AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
    FROM documents
), leaves AS (
    SELECT domain, lang, source, cast(sum(n_tokens) AS BIGINT) AS leaf_tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0
), {', '.join(steps)}, shares AS (
    SELECT *, budget // leaf_tokens AS epochs, budget % leaf_tokens AS rest FROM leaves JOIN b2 USING (domain, lang, source)
), drawn AS (
    SELECT *, md5('{mix.seed}:' || epoch || ':' || doc_id) AS ord FROM (
        SELECT d.*, leaf_tokens, budget, epochs, rest, unnest(range(0, epochs + 1)) AS epoch
        FROM d JOIN shares USING (domain, lang, source))
), cum AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY ord ROWS UNBOUNDED PRECEDING) AS upto FROM drawn
)
SELECT doc_id, domain, lang AS leaf_lang, source AS leaf_source, cast(epoch AS BIGINT) AS epoch,
    cast(n_tokens AS BIGINT) AS n_tokens, leaf_tokens, budget
FROM cum WHERE epoch < epochs OR (rest > 0 AND upto <= rest)
"""


_LEAKS = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), sizes AS (
    SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS passage
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM b WHERE len(w) > 0)
), held AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS passage
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
    SELECT doc_id, i, n, item_id FROM held JOIN wanted USING (n, passage)
), words AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


_NEGATIVES = """
WITH e AS (
    SELECT vec_id, cast(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
        [floor(256 * cast(x AS DOUBLE)) for x in embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        cast(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    cast(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

_SEARCH = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), corpus AS (
    SELECT cast(count(*) AS BIGINT) AS n_all, cast(sum(len(w)) AS BIGINT) AS l_all FROM d WHERE len(w) > 0
), tf AS (
    SELECT doc_id, n, term, cast(count(*) AS BIGINT) AS tf
    FROM (SELECT doc_id, cast(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, cast(sum(
        cast(floor(1000 * ln((2 * n_all + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_all) // l_all)))) AS BIGINT) AS score
    FROM q JOIN df USING (term) JOIN tf USING (term), corpus GROUP BY item_id, doc_id
)
SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""


def build(mix) -> dict[str, str]:
    return {
        "op2_decontamination": _LEAKS, "op4_chat_formatting": _CHAT, "op7_url_filters": _urls(),
        "op8_mixing": _mix(mix), "op12_hard_negatives": _NEGATIVES, "op13_lexical_search": _SEARCH,
    }
