"""DuckDB twins of the operators' queries, where SQL can say them."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[p : p + m - 1], ' ') AS g FROM iw),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (SELECT r, m, p, array_to_string(w[p : p + m - 1], ' ') AS g FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT r, item_id, p, m FROM dw JOIN win USING (m, g)),
words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + m)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

#: Windows are cut from pieces of 1,399 bytes: DuckDB looks for a place in a long string from its start.
SUFFIX_DEDUP = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, 1000 * j AS base, substr(h, 2000 * j + 1, 2798) AS x FROM (SELECT r, h, unnest(range(0, len(h) // 2000 + 1)) AS j FROM d)),
w AS (SELECT r, base + o AS o, md5(substr(x, 2 * o + 1, 800)) AS g FROM (SELECT r, base, x, unnest(range(0, least(1000, len(x) // 2 - 399))) AS o FROM p)),
hit AS (SELECT r, o, lag(o) OVER (PARTITION BY r ORDER BY o) AS before FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING count(*) > 1)),
runs AS (SELECT r, o, count(*) FILTER (before IS NULL OR o > before + 400) OVER (PARTITION BY r ORDER BY o) AS k FROM hit),
spans AS (SELECT r, k, min(o) AS a, max(o) + 400 AS e FROM runs GROUP BY r, k),
edges AS (SELECT r, a, coalesce(lag(e) OVER (PARTITION BY r ORDER BY k), 0) AS p FROM spans UNION ALL SELECT r, len(h) // 2, coalesce((SELECT max(e) FROM spans s WHERE s.r = d.r), 0) FROM d),
kept AS (SELECT r, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS rest FROM edges JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, ((len(h) - len(rest)) // 2)::BIGINT AS n_removed, (SELECT count(*) FROM spans s WHERE s.r = d.r)::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM d JOIN kept USING (r)"""

ORACLES = {"op2_decontamination": DECONTAMINATION, "op8_suffix_dedup": SUFFIX_DEDUP}
