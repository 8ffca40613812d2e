"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tickframe.llm import html_text, jaccard_join, mixing, quality, secrets, sentencepiece_lattice, sharding, suffix_dedup, token_counts, vector_search
from tickframe.llm.common import table


def queries() -> dict:
    return {
        "op1_token_counts": lambda s, d: token_counts.count_tokens(table(s, d, "documents")),
        "op2_quality_rules": lambda s, d: quality.quality_report(table(s, d, "documents")),
        "op3_vector_search": lambda s, d: vector_search.nearest(table(s, d, "embeddings")),
        "op4_html_extraction": lambda s, d: html_text.extract(table(s, d, "pages")),
        "op5_secret_scans": lambda s, d: secrets.secret_report(table(s, d, "documents")),
        "op6_sharding": lambda s, d: sharding.shard(table(s, d, "documents")),
        "op7_sentencepiece": lambda s, d: sentencepiece_lattice.encode(table(s, d, "documents"), stored=False),
        "op8_source_mixing": lambda s, d: mixing.mix_report(table(s, d, "documents")),
        "op9_suffix_array_dedup": lambda s, d: suffix_dedup.dedup_report(table(s, d, "documents")),
        "op10_jaccard_join": lambda s, d: jaccard_join.link_report(table(s, d, "documents")),
    }


#: Words as all contracts take them.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = f"""WITH z AS (SELECT doc_id, source, md5(coalesce(text, '')) AS h, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
per AS (SELECT source, sum(size) AS source_size FROM z GROUP BY 1),
rk AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM per),
we AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, source_size * 2 AS cap, source_size * 2 / CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS ratio, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget FROM rk),
li AS (SELECT *, (budget - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS line FROM we WINDOW b AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
wl AS (SELECT arg_min(line, (ratio, rank)) AS water FROM li WHERE line <= ratio),
tg AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, budget, CASE WHEN water IS NULL OR ratio < water THEN CAST(cap AS DOUBLE) ELSE weight * water END AS target FROM li CROSS JOIN wl),
o AS (SELECT z.*, source_size, target, budget, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || h) AS ord FROM z JOIN tg ON z.source IS NOT DISTINCT FROM tg.source),
q AS (SELECT *, row_number() OVER () AS id, sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) AS ends FROM o),
e AS (SELECT q.*, epoch, (ends + epoch * source_size) / target AS vft FROM q CROSS JOIN (VALUES (0), (1)) v(epoch) WHERE size > 0 AND target > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY vft, source NULLS LAST, ord, doc_id NULLS LAST, epoch ROWS UNBOUNDED PRECEDING) AS run FROM e),
t AS (SELECT id, sum(size) AS taken FROM r WHERE run <= budget GROUP BY 1)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN t USING (id)"""

DEDUP = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, n - 50)) AS i FROM d WHERE n >= 50)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
k AS (SELECT w.doc_id, i FROM w JOIN m USING (s) WHERE w.doc_id > first),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM k),
x AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM g),
sp AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM x GROUP BY 1, 2),
ks AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS u FROM sp UNION ALL SELECT doc_id, max(b), NULL FROM sp GROUP BY 1),
kp AS (SELECT ks.doc_id, string_agg(substr(h, 2 * f + 1, 2 * (coalesce(u, n) - f)), '' ORDER BY f) AS left_over FROM ks JOIN d USING (doc_id) GROUP BY 1),
t AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM sp GROUP BY 1)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(left_over, h))) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kp USING (doc_id)"""

JACCARD = f"""WITH RECURSIVE lo AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
d AS (SELECT doc_id, {WORDS} AS w FROM lo),
sh AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x AS v, x AS u FROM e UNION SELECT r.v, e.y FROM r JOIN e ON e.x = r.u),
c AS (SELECT v, min(u) AS least FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON v = d.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op8_source_mixing": MIXING, "op9_suffix_array_dedup": DEDUP, "op10_jaccard_join": JACCARD}
