"""DuckDB SQL of the archive, vector code and run queries."""

from __future__ import annotations

WORDS = "regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')"


def crc32(text: str) -> str:
    """The crc32 of a string of digits, bit by bit."""
    step = "CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END"
    byte = f"list_reduce([xor(c, b)] || range(8), lambda r, k: {step})"
    digits = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {digits}, lambda c, b: {byte}), 4294967295::BIGINT)"


def op11() -> str:
    letter = " + ".join(f"substr(bits, 5 * i + {j + 1}, 1)::BIGINT * {16 >> j}" for j in range(5))
    base32 = (f"array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {letter}, 1)), '')")
    return f"""WITH base AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    known AS (SELECT page_id, payload, unhex(sha1(payload))::BIT::VARCHAR AS bits,
              max(page_id) OVER (PARTITION BY payload) AS last FROM base)
    SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {base32} AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to FROM known"""


def op12(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    def nearest(r: int) -> str:
        """The nearest entry of codebook r to each part, by exact sums of doubles that hold integers."""
        far = "CAST(a.norm + c.norm - 2 * list_inner_product(a.v, c.v) AS BIGINT)"
        return (f"a{r} AS MATERIALIZED (SELECT vec_id, p, any_value(v) AS v, min({{'d': far, 'e': e}}) AS best FROM ("
                f"SELECT a.vec_id, a.p, a.v, c.e, {far} AS far FROM parts a JOIN c{r} c ON c.p = a.p) GROUP BY vec_id, p)")

    def entries_after(r: int) -> str:
        cells = (f"SELECT p, best.e AS e, i, sum(CAST(v[i] AS BIGINT)) AS s, count(*) AS n FROM (SELECT p, best, v, unnest(range(1, len(v) + 1)) "
                 f"AS i FROM a{r}) GROUP BY ALL")
        floor = "CAST((s - ((s % n) + n) % n) // n AS DOUBLE)"
        moved = f"SELECT p, e, list({floor} ORDER BY i) AS v FROM ({cells}) GROUP BY p, e"
        return (f"c{r + 1} AS MATERIALIZED (SELECT p, e, v, list_inner_product(v, v) AS norm FROM (SELECT c.p, c.e, coalesce(m.v, c.v) AS v "
                f"FROM c{r} c LEFT JOIN ({moved}) m ON m.p = c.p AND m.e = c.e))")

    chain = ",\n".join(x for r in range(rounds) for x in (nearest(r), entries_after(r)))
    return f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cut AS (SELECT vec_id, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS v
            FROM (SELECT vec_id, x, unnest(range({parts})) AS p FROM kept)),
    parts AS MATERIALIZED (SELECT *, list_inner_product(v, v) AS norm FROM cut),
    c0 AS MATERIALIZED (SELECT p, e, v, norm FROM (
      SELECT p, v, norm, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < {entries}),
    {chain},
    {nearest(rounds)},
    coded AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
              FROM a{rounds} GROUP BY vec_id),
    numbers AS (SELECT p, e, unnest(range(1, len(v) + 1)) AS i, v FROM c{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(CAST(v[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) FROM numbers) AS codebooks_sha256, label
    FROM coded JOIN kept USING (vec_id)"""


def op13(min_words: int = 24, min_periods: int = 3) -> str:
    return f"""WITH split AS (SELECT doc_id, {WORDS} AS ws, {crc32('CAST(doc_id AS VARCHAR)')} AS h FROM documents),
    sized AS (SELECT doc_id, ws, len(ws) AS n, h // 10 AS g, h FROM split),
    placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
    edits AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
    w AS MATERIALIZED (SELECT doc_id, n, i, ws[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS w
      FROM (SELECT *, unnest(range(n)) AS i FROM edits)),
    cells AS (SELECT x.doc_id, y.i - x.i AS lag, y.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i
      WHERE {min_periods} * (y.i - x.i) <= x.n),
    diagonals AS (SELECT doc_id, lag, min(i) - lag AS s, count(*) + lag AS len FROM (
      SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM cells) GROUP BY doc_id, lag, island),
    runs AS MATERIALIZED (SELECT doc_id, s, len, min(lag) AS q FROM diagonals WHERE len >= greatest({min_words}, {min_periods} * lag)
      GROUP BY doc_id, s, len),
    best AS (SELECT doc_id, s, len, q FROM runs r WHERE NOT EXISTS (SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (
      o.len * r.q > r.len * o.q OR (o.len * r.q = r.len * o.q AND (o.s < r.s OR (o.s = r.s AND o.q < r.q)))))),
    listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS text
      FROM runs GROUP BY doc_id),
    dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
    collapsed AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM w ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
    SELECT z.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period, 1000 * b.len // b.q AS exponent_milli,
           sha256(coalesce(l.text, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256, z.n AS n_words
    FROM sized z LEFT JOIN best b ON b.doc_id = z.doc_id LEFT JOIN listed l ON l.doc_id = z.doc_id
    LEFT JOIN collapsed c ON c.doc_id = z.doc_id"""


ORACLE = {"op11_warc": op11(), "op12_vector_codes": op12(), "op13_periodic_runs": op13()}
