"""SQL that gives the rows of the corpus queries that SQL can express.

The others are trained, hashed, tokenised or placed by look-behind patterns;
``tests/llm`` compares them with plain Python.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
SQL["op10_decontamination"] = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
    b AS (SELECT row_number() OVER () AS q, item_id, {WORDS} AS w FROM benchmark),
    items AS (SELECT q, item_id, w, least(5, len(w)) AS n FROM b WHERE len(w) > 0),
    wanted AS (SELECT DISTINCT q, item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
    sizes AS (SELECT q, count(*) AS size FROM wanted GROUP BY q),
    found AS (SELECT r, doc_id, n, i - 1 AS place, array_to_string(w[i : i + n - 1], ' ') AS s
        FROM (SELECT d.*, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM wanted)))
    SELECT doc_id, item_id, count(DISTINCT s) / any_value(size) AS containment, min(place) AS first_word
    FROM found JOIN wanted USING (n, s) JOIN sizes USING (q) GROUP BY r, doc_id, q, item_id HAVING count(DISTINCT s) >= 0.8 * any_value(size)"""

TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SQL["op11_bitsliced_search"] = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS t FROM documents),
    docs AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
    total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_words FROM docs),
    tf AS (SELECT r, term, count(*)::BIGINT AS f FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
    weight AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf CROSS JOIN total GROUP BY term, n_docs),
    asked AS (SELECT q, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS q, item_id, {TERMS} AS t FROM benchmark)),
    scored AS (SELECT q, item_id, r, sum(w * ((1000000000 * f) // (1000 * f + 8 * (25 + (75 * n * n_docs) // n_words))))::BIGINT AS score
        FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN docs USING (r) CROSS JOIN total GROUP BY q, item_id, r),
    ranked AS (SELECT q, item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored JOIN docs USING (r) WHERE score > 0)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

SQL["op13_warc_zstd"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    named AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1) FOR i IN range(32)], '') AS payload_digest FROM p)
    SELECT page_id, octet_length(encode(html)) AS payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM named"""
