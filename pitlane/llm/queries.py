"""The operators applied to the whole test tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitlane.llm import pii, quality
from pitlane.llm.bpe import encode_digests
from pitlane.llm.centroids import clustered
from pitlane.llm.common import read_table, stored
from pitlane.llm.conversations import report_of_damaged
from pitlane.llm.decontam import find_items
from pitlane.llm.html import extract
from pitlane.llm.mixing import KEY, SIZE, SOURCE, count_words, mix_counted
from pitlane.llm.neardup import near_duplicates
from pitlane.llm.secrets import scan_secrets
from pitlane.llm.substring import remove_repeats
from pitlane.llm.topk import top_k
from pitlane.llm.toxicity import score, train

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(read_table(spark, folder, "documents"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_digests(read_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op3_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"), width=2, percent=80)


OP3_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
      ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s FROM texts)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS other FROM both_ways
  UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other
), least AS (SELECT node, min(other) AS component FROM reach GROUP BY 1)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component, t.doc_id) AS component_id,
  coalesce(l.component, t.doc_id) = t.doc_id AS kept
FROM texts t LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.node = t.doc_id
"""


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


OP4_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op5_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return find_items(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return quality.classify(docs, quality.train(docs, read_table(spark, folder, "labels")))


def op7_substring(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents"), width=20, digest=True)


OP7_SQL = """
WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(ws[s + 1 : s + 20], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 19)) AS s FROM texts)
), firsts AS (SELECT w, min({'d': doc_id, 's': s}) AS f FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, s + unnest(range(1, 21)) AS i FROM windows JOIN firsts USING (w)
  WHERE doc_id > f.d OR (doc_id = f.d AND s > f.s)
), lists AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY 1)
SELECT t.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(coalesce(g, []), i)), ' ')) AS kept_sha256
FROM texts t LEFT JOIN lists USING (doc_id)
"""


def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract(read_table(spark, folder, "pages"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return pii.scan(docs, pii.train(docs))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return score(docs, train(docs, read_table(spark, folder, "labels")))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return report_of_damaged(read_table(spark, folder, "conversations"))


# The checksum bit by bit: each character is followed by eight shifts (-1).
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({0}, ''),
    lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END))"""
OP11_SQL = f"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC32_SQL.format("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS draw
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn WHERE draw <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending, left(role, 1) AS initial FROM damaged
), judged AS (
  SELECT *, ending = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed
), rows_ AS (
  SELECT *, blank OR again AS must, NOT blank AND NOT again AND ending NOT IN ('.', '!', '?') AS cut FROM judged
), inserts(p, q, c, x, made) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 3, 'I', 'user:' || chr(10)), (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (1, 1, 0, '', ''), (1, 2, 3, 'I', 'user:' || chr(10)), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (2, 2, 0, '', ''), (2, 3, 3, 'I', 'assistant:' || chr(10)), (3, 3, 0, '', ''), (3, 2, 3, 'I', 'user:' || chr(10))
), edits(q, initial, t, c, x, new_role) AS (
  SELECT q, NULL::VARCHAR, q, 4, 'D', NULL::VARCHAR FROM (VALUES (0), (1), (2), (3)) v(q)
  UNION ALL VALUES (0, 's', 1, 0, 'K', NULL::VARCHAR), (0, 'u', 2, 0, 'K', NULL), (1, 'u', 2, 0, 'K', NULL), (2, 'a', 3, 0, 'K', NULL), (3, 'u', 2, 0, 'K', NULL)
  UNION ALL VALUES (0, NULL::VARCHAR, 2, 3, 'R', 'user'), (1, NULL, 2, 3, 'R', 'user'), (2, NULL, 3, 3, 'R', 'assistant'), (3, NULL, 2, 3, 'R', 'user')
), paths AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'made': ''}} AS best FROM rows_ GROUP BY conv_id
  UNION ALL
  SELECT r.conv_id, r.n, e.t, min({{'cost': best.cost + i.c + e.c + CASE WHEN e.x <> 'D' AND r.cut THEN 3 ELSE 0 END, 'audit': best.audit || i.x || e.x,
    'made': best.made || i.made || CASE WHEN e.x = 'D' THEN '' ELSE coalesce(e.new_role, r.role) || ':' || r.text || chr(10) END}})
  FROM paths p JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1
    JOIN inserts i ON i.p = p.state JOIN edits e ON e.q = i.q AND (e.x = 'D' OR NOT r.must) AND (e.x <> 'K' OR e.initial = r.initial)
  GROUP BY r.conv_id, r.n, e.t
), ended AS (
  SELECT p.conv_id, min({{'cost': best.cost + i.c, 'audit': best.audit || i.x, 'made': best.made || i.made}}) AS best
  FROM paths p JOIN (SELECT conv_id, max(n) AS n FROM rows_ GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.n = p.n
    JOIN inserts i ON i.p = p.state AND i.q IN (0, 3) GROUP BY p.conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(best.made[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def op12_mix(spark: SparkSession, folder: str) -> DataFrame:
    # Texts are read once; the rest works on the counts.
    counted = count_words(read_table(spark, folder, "documents")).select("doc_id", "source", SOURCE, SIZE, KEY)
    return mix_counted(stored(counted, "counted")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


OP12_SQL = """
WITH counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5(concat_ws('|', '12', coalesce('v' || doc_id, 'n'), md5(coalesce(text, '')), coalesce('v' || source, 'n'))) AS k
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM counted GROUP BY source
), filled AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT - 3 * coalesce((sum(source_size) OVER before)::BIGINT, 0) AS left_,
    (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::BIGINT AS w_
  FROM sources WINDOW before AS (ORDER BY source_size / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT left_, w_ FROM filled WHERE 3 * source_size * w_ > left_ * w ORDER BY source_size / w, r LIMIT 1
), aims AS (
  SELECT source, source_size, coalesce(least(w * (SELECT left_ FROM level) / (SELECT w_ FROM level), 3 * source_size::DOUBLE), 0) AS target FROM sources
), drawn AS (
  SELECT doc_id, size, source_size, target, c.source, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5(k || '|' || row_number() OVER (PARTITION BY k)), 1, 13))::BIGINT / 4503599627370496 AS coin
  FROM counted c JOIN aims a ON c.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target, (floor(rate) + (coin < rate - floor(rate))::INT)::INT AS copies,
  ((floor(rate) + (coin < rate - floor(rate))::INT) * size)::BIGINT AS taken, source
FROM drawn
"""


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return clustered(read_table(spark, folder, "embeddings"))


def _op13_sql(k: int = 8, rounds: int = 10) -> str:
    """Each round: the nearest centroid of every vector, then the floor of every cluster's mean."""
    nearest = """near{i} AS MATERIALIZED (
  SELECT r, any_value(v) AS v, min({{'d': list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT, 'c': c}}) AS best
  FROM whole, centre{i} GROUP BY r
)"""
    moved = """centre{j} AS MATERIALIZED (
  SELECT c, coalesce(list(mean ORDER BY i) FILTER (i IS NOT NULL), any_value(m)) AS m FROM centre{i} LEFT JOIN (
    SELECT best.c AS c, i, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS mean
    FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS i FROM near{i}) GROUP BY best.c, i) USING (c) GROUP BY c
)"""
    steps = []
    for i in range(rounds + 1):
        steps.append(nearest.format(i=i))
        if i < rounds:
            steps.append(moved.format(i=i, j=i + 1))
    return f"""WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM (SELECT * FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = 64 AND len(embedding) = 64)
), centre0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v AS m FROM whole
  WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k}
), {", ".join(steps)}
SELECT vec_id, best.c::INT AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM near{rounds} JOIN whole USING (r) JOIN centre{rounds} ON centre{rounds}.c = best.c
"""


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_bpe": op2_bpe,
    "op3_neardup": op3_neardup,
    "op4_topk": op4_topk,
    "op5_decontam": op5_decontam,
    "op6_quality": op6_quality,
    "op7_substring": op7_substring,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_html": op10_html,
    "op11_conversations": op11_conversations,
    "op12_mix": op12_mix,
    "op13_centroids": op13_centroids,
}
ORACLES: dict[str, str] = {
    "op3_neardup": OP3_SQL,
    "op4_topk": OP4_SQL,
    "op7_substring": OP7_SQL,
    "op11_conversations": OP11_SQL,
    "op12_mix": OP12_SQL,
    "op13_centroids": _op13_sql(),
}
