"""DuckDB SQL for the queries of this package that SQL can express."""

#: CRC-32 (reflected polynomial 0xEDB88320) of a text's UTF-8 bytes.
CRC32 = """
crc_table AS (SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
              FROM range(256) r(n)),
crcs AS (SELECT d.doc_id, d.text, xor(list_reduce([4294967295] || list_transform(range(1, 1 + strlen(d.text)),
                lambda i: ('0x' || substr(h.hex, 2 * i - 1, 2))::BIGINT),
                lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS crc
         FROM documents d, crc_table, LATERAL (SELECT hex(encode(d.text)) AS hex) h WHERE d.text IS NOT NULL)
"""

OP2 = f"""
WITH {CRC32},
sized AS (SELECT d.doc_id, coalesce(strlen(d.text), 0) + 16 AS size, coalesce(c.crc, 0) AS text_crc32
          FROM documents d LEFT JOIN crcs c USING (doc_id)),
placed AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS start, sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, least(39, (2 * start + size) * 40 // (2 * total))::INT AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS leader FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
         ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM d
"""

OP4 = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, low) AS (SELECT a, a FROM edge UNION SELECT e.b, r.low FROM reach r JOIN edge e ON e.a = r.doc_id WHERE r.low < e.b),
low AS (SELECT doc_id, min(low) AS low FROM reach GROUP BY ALL)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE
d AS (SELECT doc_id, source, coalesce('=' || source, '') AS src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
             ('0x' || substr(md5('7|' || doc_id), 1, 8))::BIGINT % 256 AS block FROM documents),
b AS (SELECT src, block, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
s AS (SELECT src, sum(tokens) AS total, sum(tokens) / sum(sum(tokens)) OVER () AS p FROM b GROUP BY ALL),
l AS (SELECT list(ln(p)) AS l FROM s WHERE p > 0),
search(k, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN met THEN lo ELSE mid END, CASE WHEN met THEN mid ELSE hi END
  FROM (SELECT k, lo, hi, (lo + hi) / 2 AS mid,
               list_max(list_transform(l, lambda x: exp(((lo + hi) / 2 - 1) * x))) / list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x))) <= 1.25 AS met
        FROM search, l WHERE k < 60)),
best AS (SELECT hi AS a, list_sum(list_transform(l, lambda x: exp(hi * x))) AS z FROM search, l WHERE k = 60),
m AS (SELECT src, total, CASE WHEN p > 0 THEN exp(a * ln(p)) / z ELSE 0 END AS weight, CASE WHEN p > 0 THEN exp((a - 1) * ln(p)) / z ELSE 0 END AS epochs FROM s, best),
o AS (SELECT b.src, block, tokens, weight, epochs, total, floor(epochs + 1e-9)::INT AS whole,
             sum(tokens) OVER (PARTITION BY b.src ORDER BY md5('7|' || b.src || '|' || floor(epochs + 1e-9)::INT || '|' || block), block) - tokens AS ahead
      FROM b JOIN m ON b.src = m.src)
SELECT doc_id, source, n_tokens, d.block, (whole + (ahead + tokens / 2 < (epochs - whole) * total)::INT)::BIGINT AS copies, round(weight, 6) AS weight
FROM d JOIN o ON d.src = o.src AND d.block = o.block
"""



def _op12(k: int = 40, rounds: int = 5) -> str:
    """Rounds unrolled. All values are whole and below 2**53, so products of doubles are exact."""
    parts = [
        """e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
               WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, v FROM e)",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1)::INT AS cluster, v AS c
                  FROM v QUALIFY cluster < {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (SELECT row, min_by({{'cluster': cluster, 'distance': d}}, (d, cluster)) AS best FROM (
                  SELECT row, cluster, list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c) AS d FROM v, c{r}) GROUP BY row)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} AS (SELECT cluster, list(mean ORDER BY i) AS c FROM (
                      SELECT best.cluster AS cluster, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
                      FROM (SELECT row, unnest(v)::HUGEINT AS x, generate_subscripts(v, 1) AS i FROM v) JOIN a{r} USING (row) GROUP BY ALL) GROUP BY cluster),
                    c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{r}.c::DOUBLE[], c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.cluster AS cluster, best.distance::BIGINT AS distance,
       sum(best.distance::BIGINT) OVER (PARTITION BY best.cluster)::BIGINT AS cluster_inertia, sum(best.distance::BIGINT) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN c{rounds} ON c{rounds}.cluster = best.cluster"""


OP13 = r"""
WITH pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
       FROM documents)),
total AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM pieces, range(1, 6) r(m))
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
inner_parts AS (SELECT DISTINCT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, a FROM c, range(2, 5) z(s), range(1, 5) y(i) WHERE s < m AND i + s - 1 <= m),
alone AS (SELECT * FROM c ANTI JOIN inner_parts p ON p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 100 * c.a),
cuts AS (SELECT x.lang, x.phrase, x.a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * x.a * n) // (l.f::HUGEINT * r.f) AS score
         FROM (SELECT *, unnest(range(1, m)) AS k FROM alone) x
         JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:k], ' ')
         JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[k + 1:], ' ')
         JOIN total t ON t.lang = x.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""


ORACLES = {
    "op2_byte_shards": OP2,
    "op4_jaccard_tiles": OP4,
    "op8_warc_salvage": OP8,
    "op10_temperature_mix": OP10,
    "op12_centroids": _op12(),
    "op13_collocations": OP13,
}
