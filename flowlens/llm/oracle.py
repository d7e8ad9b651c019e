"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from flowlens.llm import decontamination, hard_negatives, lexical_search, secret_scan, sharding

LOWERED = f"translate(coalesce(text, ''), '{decontamination.UPPER}', '{decontamination.LOWER}')"
WORDS = f"regexp_extract_all({LOWERED}, '{decontamination.WORD}')"


def op2_warc() -> str:
    return """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
    SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
      array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (((('0x' || substr(d, (1 + (i // 4) * 5)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
      CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM f"""


def op3_decontamination(n: int = decontamination.WINDOW) -> str:
    gram = "array_to_string(list_slice(ws, i + 1, i + n), ' ')"
    return f"""
    WITH docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
    items AS (SELECT item_id, ws, least(len(ws), {n}) AS n FROM (SELECT item_id, {WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
    win AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(0, len(ws) - n + 1), lambda i: {gram})) AS g FROM items),
    spots AS (SELECT doc_id, n, unnest(list_transform(range(0, len(ws) - n + 1), lambda i: {{'i': i, 'g': {gram}}})) AS w
           FROM docs, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n),
    hits AS (SELECT doc_id, spots.n, w.i AS i, item_id FROM spots JOIN win ON spots.n = win.n AND spots.w.g = win.g),
    pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
    own AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY 1)
    SELECT docs.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN pos USING (doc_id) LEFT JOIN own USING (doc_id)"""


def op4_sharding(shards: int = 16, seed: int = sharding.SEED) -> str:
    """Row numbers by a window, the network's rounds as nested selects, the walk by recursion."""
    step = "SELECT row, x // b AS l, x % b AS r, n, a, b, k FROM walk WHERE k = 0 OR x >= n"
    for k in range(sharding.ROUNDS):
        def value(c: str, k: int = k) -> str:
            return f"('0x' || substr(md5('{seed}:{k}:' || {c}::VARCHAR), 1, 12))::BIGINT"
        step = (f"SELECT row, l, (r + {value('l')}) % b AS r, n, a, b, k FROM ({step})" if k % 2 else
                f"SELECT row, (l + {value('r')}) % a AS l, r, n, a, b, k FROM ({step})")
    return f"""
    WITH RECURSIVE tab AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
                list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bs FROM documents),
    own AS (SELECT doc_id, size::BIGINT AS size, xor(list_reduce(list_concat([4294967295], bs),
              lambda c, v: xor(c >> 8, t[1 + (xor(c, v) & 255)])), 4294967295) AS text_crc32 FROM bytes, tab),
    numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1 AS row, count(*) OVER () AS n FROM own),
    walk AS (
      SELECT row, row AS x, n, a, (n + a - 1) // a AS b, 0 AS k FROM (SELECT row, n, floor(sqrt(n - 1))::BIGINT + 1 AS a FROM numbered)
      UNION ALL SELECT row, l * b + r AS x, n, a, b, k + 1 AS k FROM ({step})),
    placed AS (SELECT row, x FROM walk WHERE k > 0 AND x < n)
    SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (x % {shards})::INT AS shard, (x // {shards})::BIGINT AS slot,
           NULL::INT AS grown_shard FROM numbered JOIN placed USING (row)"""


def op9_secret_scan() -> str:
    def literal(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    parts = []
    for rank, (kind, pattern, group, least) in enumerate(secret_scan.BASE):
        p = literal(pattern)
        parts.append(f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(text, {p}) AS ms,
          regexp_extract_all(text, {p}, {group}) AS gs, regexp_split_to_array(text, {p}) AS ps, {least} AS least FROM d""")
    window = secret_scan.WINDOW
    run = literal(f"{secret_scan.CANDIDATE}{{{window},}}")
    parts.append(f"""SELECT doc_id, 'run' AS kind, 9 AS rank, regexp_extract_all(text, {run}) AS ms, regexp_extract_all(text, {run}) AS gs,
          regexp_split_to_array(text, {run}) AS ps, 0 AS least FROM d""")
    allowed = " OR ".join(f"regexp_matches(s, {literal(p)})" for p in secret_scan.ALLOWED)
    limits = {k: f"floor({window} * {secret_scan.UNIT} * (log2({window}::DOUBLE) - {t}))" for k, t in secret_scan.THRESHOLDS.items()}
    joined = "string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank, z)"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({' UNION ALL '.join(parts)}),
    one AS (SELECT doc_id, kind, rank, least, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[:len(ms)]) AS p, unnest(range(0, len(ms))) AS i
            FROM found WHERE len(ms) > 0),
    located AS (SELECT doc_id, kind, rank, least, m, g, (sum(length(p) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS z FROM one),
    spans AS (SELECT doc_id, kind, rank, z - length(m) AS a, z FROM located WHERE kind <> 'run' AND length(g) >= least),
    wins AS (SELECT doc_id, z - length(m) AS base, m, unnest(range(0, length(m) - {window - 1})) AS i FROM located WHERE kind = 'run'),
    chars AS (SELECT doc_id, base, m, i, unnest(string_split(substr(m, i::INT + 1, {window}), '')) AS c FROM wins),
    counts AS (SELECT doc_id, base, m, i, c, count(*) AS k FROM chars GROUP BY ALL),
    scored AS (SELECT doc_id, base, m, i, sum(round(k * log2(k::DOUBLE) * {secret_scan.UNIT})) AS s,
                      bool_and(regexp_matches(c, '[0-9a-fA-F]')) AS hex FROM counts GROUP BY ALL),
    high AS (SELECT *, i - {window} > coalesce(max(i) OVER (PARTITION BY doc_id, base ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -99999999) AS fresh
             FROM scored WHERE s <= CASE WHEN hex THEN {limits['hex']} ELSE {limits['token']} END),
    islands AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id, base ORDER BY i) AS island FROM high),
    merged AS (SELECT doc_id, base, m, min(i) AS i, max(i) + {window} AS j FROM islands GROUP BY doc_id, base, m, island),
    extra AS (SELECT doc_id, 'entropy' AS kind, {len(secret_scan.BASE)} AS rank, base + i AS a, base + j AS z
              FROM (SELECT *, substr(m, i::INT + 1, (j - i)::INT) AS s FROM merged) WHERE NOT ({allowed})),
    b AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex, {joined} AS base FROM spans GROUP BY 1),
    e AS (SELECT doc_id, {joined} AS spans FROM (SELECT * FROM spans UNION ALL SELECT * FROM extra) GROUP BY 1)
    SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)"""


def op11_lexical_search(k: int = lexical_search.TOP) -> str:
    words = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
    items AS (SELECT row_number() OVER () AS i, item_id, {words} AS ws FROM benchmark),
    size AS (SELECT count(*)::BIGINT AS N, sum(len(ws))::BIGINT AS L FROM docs WHERE len(ws) > 0),
    tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS t FROM docs) GROUP BY ALL),
    df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
    asked AS (SELECT i, t, count(*)::BIGINT AS q FROM (SELECT i, unnest(ws) AS t FROM items) GROUP BY ALL),
    weighed AS (SELECT i, t, q * floor(1000 * ln((2 * N + 2) / (2 * df + 1)))::BIGINT AS w FROM asked JOIN df USING (t), size),
    norm AS (SELECT r, doc_id, 100 - 75 + (75 * len(ws)::BIGINT * N) // L AS m FROM docs, size WHERE len(ws) > 0),
    scored AS (SELECT i, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
               FROM weighed JOIN tf USING (t) JOIN norm USING (r) GROUP BY i, r),
    ranked AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
               FROM scored JOIN norm USING (r) JOIN items USING (i) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""


def op13_hard_negatives() -> str:
    h = hard_negatives
    return f"""
    WITH own AS (SELECT row_number() OVER () AS r, vec_id,
        CASE WHEN vec_id % {h.RELABEL_STEP} = 0 THEN (label + 1) % {h.LABELS} ELSE label END AS label,
        list_transform(embedding, lambda x: floor({h.SCALE} * x::DOUBLE)) AS q FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS vec_id, a.label = b.label AS same,
        list_dot_product(a.q, b.q)::BIGINT AS score
      FROM own a JOIN own b ON a.vec_id IS DISTINCT FROM b.vec_id OR a.label <> b.label WHERE a.vec_id % {h.ANCHOR_STEP} = 0),
    positives AS (SELECT a, anchor_id, b, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) <= {h.POSITIVES})
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id NULLS LAST)::INT AS rank,
      s.vec_id AS negative_id, positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON p.a = s.a AND NOT s.same
      AND {h.LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {h.HIGH} * positive_score
    QUALIFY rank <= {h.NEGATIVES}"""


ORACLE = {f.__name__: f() for f in (op2_warc, op3_decontamination, op4_sharding, op9_secret_scan, op11_lexical_search, op13_hard_negatives)}
