"""SQL (DuckDB) for the operators that SQL can express, written from their contracts.

None for: 3 and 4 (XXH64), 5 and 8 (tokenizers), 6 (crc32), 7 and 9 (trained
models), and the pipeline; those are tested against plain Python instead.
"""

from __future__ import annotations

from kinrank.llm.decontaminate import WINDOW
from kinrank.llm.lexical import TOP
from kinrank.llm.substring_dedup import WIDTH as WORDS
from kinrank.llm.suffix_dedup import WIDTH as BYTES

# Texts as lower-case hexadecimal digits: byte i is at digits 2i + 1 and 2i + 2.
STRINGS = f"""WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (
  SELECT doc_id, s, md5(substr(h, CAST(2 * s + 1 AS BIGINT), {2 * BYTES})) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {BYTES} + 1)) AS s FROM d WHERE length(h) >= {2 * BYTES}) x),
r AS (SELECT doc_id, s FROM (
  SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM w) x WHERE n > 1),
g AS (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {BYTES} THEN 1
             WHEN lag(s) OVER (PARTITION BY doc_id ORDER BY s) IS NULL THEN 1 ELSE 0 END AS f FROM r),
u AS (SELECT doc_id, min(s) AS a, max(s) + {BYTES} AS b FROM (
  SELECT doc_id, s, sum(f) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g) x GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM u),
k AS (
  SELECT u.doc_id, sum(u.b - u.a) AS n_removed, count(*) AS n_spans, max(u.b) AS z,
         string_agg(substr(d.h, CAST(2 * u.p + 1 AS BIGINT), CAST(2 * (u.a - u.p) AS BIGINT)), '' ORDER BY u.a) AS kept
  FROM e u JOIN d ON d.doc_id = u.doc_id GROUP BY u.doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN k.doc_id IS NULL THEN d.h ELSE k.kept || substr(d.h, CAST(2 * k.z + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""

PASSAGES = f"""WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + {WORDS - 1}], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WORDS} + 2)) AS s FROM d WHERE len(w) >= {WORDS}) x),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY k) AS n FROM p) x WHERE n > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + {WORDS})) AS i FROM r),
l AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
t AS (
  SELECT doc_id, w, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (
  SELECT t.doc_id, string_agg(t.x, ' ' ORDER BY t.i) AS kept FROM t
  LEFT JOIN c ON c.doc_id = t.doc_id AND c.i = t.i WHERE c.i IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(l.gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""


def _words(table: str, key: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (f"SELECT {key}, list_filter(regexp_split_to_array({lowered}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w "
            f"FROM {table}")


CONTAMINATION = f"""WITH d AS ({_words('documents', 'doc_id')}),
b AS ({_words('benchmark', 'item_id')}),
q AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))) AS s FROM b WHERE len(w) > 0) x),
n AS (SELECT DISTINCT n FROM q),
p AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT d.doc_id, d.w, n.n, unnest(range(1, len(d.w) - n.n + 2)) AS s FROM d, n WHERE len(d.w) >= n.n) x),
m AS (SELECT p.doc_id, p.s, p.n, q.item_id FROM p JOIN q ON q.n = p.n AND q.k = p.k),
h AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM m) x GROUP BY doc_id),
i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM m) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id"""


RANKING = f"""WITH d AS ({_words('documents', 'doc_id')}),
b AS ({_words('benchmark', 'item_id')}),
t AS (SELECT doc_id, x, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS x FROM d) y GROUP BY doc_id, x),
n AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
g AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
w AS (SELECT x, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM t, g GROUP BY x),
q AS (SELECT DISTINCT item_id, unnest(w) AS x FROM b),
s AS (
  SELECT q.item_id, t.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (100 - 50 + (50 * n.n * g.n_docs) // g.n_terms)))) AS BIGINT) AS score
  FROM q JOIN w ON w.x = q.x JOIN t ON t.x = q.x JOIN n ON n.doc_id = t.doc_id, g GROUP BY q.item_id, t.doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP}"""


def oracle_sql() -> dict[str, str]:
    return {"op12_ranked_lexical_search": RANKING, "op1_suffix_array_dedup": STRINGS, "op2_benchmark_decontamination": CONTAMINATION, "op10_substring_dedup": PASSAGES}
