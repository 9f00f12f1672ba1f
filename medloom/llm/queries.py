"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from medloom.llm import bytepairs, collide, counts, dialogs, packing, phrases, pieces, pii, quality, simhash, suffix, topk, toxicity
from medloom.llm.common import read

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")

QUERIES = {
    "op1_voronoi_topk": lambda spark, d: topk.top_k(read(spark, d, "embeddings"), F.col("id") % 100 == 0, k=10, scale=1024),
    "op2_toxicity_grammar": lambda spark, d: toxicity.toxic_scores(read(spark, d, "documents"), read(spark, d, "labels")),
    "op3_simhash_groups": lambda spark, d: simhash.near_duplicates(read(spark, d, "documents")),
    "op4_piece_codec": lambda spark, d: pieces.encode_decode(read(spark, d, "documents"), PIECES),
    "op5_suffix_dedup": lambda spark, d: suffix.remove_repeats(read(spark, d, "documents"), length=100),
    "op6_quality_scores": lambda spark, d: quality.scored(read(spark, d, "documents")),
    "op7_collision_search": lambda spark, d: collide.nearest(read(spark, d, "embeddings"), F.col("id") % 20 == 0, k=20),
    "op8_best_fit_packing": lambda spark, d: packing.pack(read(spark, d, "documents"), BYTES, capacity=2048),
    "op9_personal_data": lambda spark, d: pii.personal_data(read(spark, d, "documents")),
    "op10_token_counts": lambda spark, d: counts.token_counts(read(spark, d, "documents"), PIECES, limit=4096),
    "op11_phrase_collocations": lambda spark, d: phrases.collocations(read(spark, d, "documents")),
    "op12_rank_array_codec": lambda spark, d: bytepairs.encode_decode(read(spark, d, "documents"), BYTES),
    "op13_conversation_repair": lambda spark, d: dialogs.repair_damaged(read(spark, d, "conversations")),
}

ORACLES = {
    "op1_voronoi_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
    "op5_suffix_dedup": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ), w AS (
            SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM d)
        ), again AS (
            SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1
        ), part AS (
            SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (
                SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM again)
        ), span AS (
            SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM part GROUP BY doc_id, g
        ), gap AS (
            SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM span
            UNION ALL SELECT doc_id, max(z), NULL FROM span GROUP BY doc_id
        ), kept AS (
            SELECT g.doc_id, string_agg(substr(h, CAST(2 * f + 1 AS BIGINT), CAST(2 * (coalesce(t, n) - f) AS BIGINT)), '' ORDER BY f) AS k
            FROM gap AS g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id
        )
        SELECT d.doc_id, n AS n_bytes, CAST(coalesce(s.r, 0) AS BIGINT) AS n_removed, coalesce(s.c, 0) AS n_spans,
               sha256(unhex(coalesce(k, h))) AS kept_sha256
        FROM d LEFT JOIN (SELECT doc_id, sum(z - a) AS r, count(*) AS c FROM span GROUP BY doc_id) AS s ON s.doc_id = d.doc_id
        LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
    "op11_phrase_collocations": """
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p
        ), g AS (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM w))
        ), f AS (
            SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30
        ), c AS (
            SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1
        ), cut AS (
            SELECT c.lang, c.phrase, c.a, c.w, c.m, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
            FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
            JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
            JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
        ), held AS (
            SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS b
            FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c)) GROUP BY ALL
        ), words AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
        )
        SELECT cut.lang, row_number() OVER (PARTITION BY cut.lang ORDER BY score DESC, a DESC, cut.phrase) AS rank, cut.phrase, a,
               CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, words.n, CAST(score AS BIGINT) AS score
        FROM cut JOIN words ON words.lang = cut.lang LEFT JOIN held ON held.lang = cut.lang AND held.phrase = cut.phrase
        WHERE b IS NULL OR 100::HUGEINT * b < 80::HUGEINT * a
        QUALIFY rank <= 2000
    """,
    "op13_conversation_repair": """
        WITH RECURSIVE k AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
            FROM conversations
        ), faults AS (  -- crc32, bit by bit: each byte of the name is followed by seven zeros
            SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(name, ''),
                       lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                   lambda crc, b: xor(xor(crc, b) >> 1, 3988292384 * (xor(crc, b) & 1))), 4294967295) % 20 AS fault
            FROM k
        ), d AS (
            SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT *, unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM faults)
        ), o AS (
            SELECT *, md5(length(role) || ':' || role || text) AS digest, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ends, left(role, 1) AS c FROM d
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lead(c) OVER (PARTITION BY conv_id ORDER BY i) AS behind,
                   count(*) OVER (PARTITION BY conv_id) AS n
            FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS i FROM o)
        ), e AS (
            SELECT conv_id, i, n, turn, c, role, text, c || behind AS pair, ends = '' AS blank, ends <> '' AND again AS duplicate, ends = '' OR again AS gone,
                   CASE WHEN right(ends, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS t
            FROM r
        ), v(conv_id, i, v0, v1, v2, v3) AS (  -- costs from row i on, by state: nothing yet, after s, after u, after a
            SELECT conv_id, n + 1, 0::BIGINT, 4::BIGINT, 2::BIGINT, 0::BIGINT FROM e WHERE i = n
            UNION ALL
            SELECT conv_id, i, least(b0, 2 + b2, 4 + b3), least(b1, 2 + b2, 4 + b3), least(b2, 2 + b3), least(b3, 2 + b2) FROM (
                SELECT e.conv_id, e.i,
                       CASE WHEN gone THEN 3 + v0 ELSE least(CASE c WHEN 's' THEN t + v1 WHEN 'u' THEN t + v2 ELSE 2 + t + v2 END, 2 + t + v2, 3 + v0) END AS b0,
                       CASE WHEN gone THEN 3 + v1 ELSE least(CASE c WHEN 'u' THEN t + v2 ELSE 2 + t + v2 END, 3 + v1) END AS b1,
                       CASE WHEN gone THEN 3 + v2 ELSE least(CASE c WHEN 'a' THEN t + v3 ELSE 2 + t + v3 END, 3 + v2) END AS b2,
                       CASE WHEN gone THEN 3 + v3 ELSE least(CASE c WHEN 'u' THEN t + v2 ELSE 2 + t + v2 END, 3 + v3) END AS b3
                FROM v JOIN e ON e.conv_id IS NOT DISTINCT FROM v.conv_id AND e.i = v.i - 1)
        ), walk(conv_id, i, q, audit, said) AS (
            SELECT conv_id, 1::BIGINT, 0, '', CAST(NULL AS VARCHAR) FROM e WHERE i = 1
            UNION ALL
            SELECT conv_id, CASE WHEN x = 'I' THEN i ELSE i + 1 END,
                   CASE x WHEN 'D' THEN q WHEN 'K' THEN CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE q WHEN 2 THEN 3 ELSE 2 END END,
                   audit || x,
                   CASE WHEN x = 'D' THEN said ELSE concat_ws(chr(10), said,
                       CASE WHEN x = 'K' THEN role WHEN q = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END) END
            FROM (
                SELECT walk.*, e.c, e.role, e.text,
                       CASE WHEN e.i IS NULL THEN 'I'
                            WHEN 3 + CASE q WHEN 0 THEN z.v0 WHEN 1 THEN z.v1 WHEN 2 THEN z.v2 ELSE z.v3 END = CASE q WHEN 0 THEN y.v0 WHEN 1 THEN y.v1 WHEN 2 THEN y.v2 ELSE y.v3 END THEN 'D'
                            WHEN 2 + CASE q WHEN 2 THEN y.v3 ELSE y.v2 END = CASE q WHEN 0 THEN y.v0 WHEN 1 THEN y.v1 WHEN 2 THEN y.v2 ELSE y.v3 END THEN 'I'
                            WHEN c = 'u' AND q <> 2 OR c = 'a' AND q = 2 OR c = 's' AND q = 0 AND t + z.v1 = y.v0 THEN 'K' ELSE 'R' END AS x
                FROM walk JOIN v AS y ON y.conv_id IS NOT DISTINCT FROM walk.conv_id AND y.i = walk.i
                LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM walk.conv_id AND e.i = walk.i
                LEFT JOIN v AS z ON z.conv_id IS NOT DISTINCT FROM walk.conv_id AND z.i = walk.i + 1
                WHERE e.i IS NOT NULL OR q IN (1, 2))
        ), done AS (
            SELECT walk.conv_id, audit, said FROM walk
            WHERE q IN (0, 3) AND i = 1 + (SELECT max(n) FROM e WHERE e.conv_id IS NOT DISTINCT FROM walk.conv_id)
        ), sums AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                   count(*) FILTER (NOT gone AND t = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM e GROUP BY conv_id
        )
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v.v0, 0) AS cost, coalesce(audit, '') AS audit,
               sha256(coalesce(said, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS o
        LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM o.conv_id AND v.i = 1
        LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
