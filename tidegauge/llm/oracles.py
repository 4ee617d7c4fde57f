"""SQL for those operators that SQL can express: the same rows from the same tables."""

from __future__ import annotations

B = r"[\x20\x09-\x0D]"


def norm(x: str) -> str:
    """Quote markers off every line, letters lowered, blanks joined and trimmed."""
    return f"trim(regexp_replace(lower(regexp_replace({x}, '(?m)^({B}*>)+{B}?', '', 'g')), '{B}+', ' ', 'g'))"


WARC = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1),
j AS (SELECT p.*, first, first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM p LEFT JOIN f USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM j"""

QUOTES = f"""WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
ln AS (SELECT rid, conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM m),
dp AS (SELECT *, length(regexp_replace(regexp_extract(line, '^({B}*>)+{B}?'), '[^>]+', '', 'g')) AS depth FROM ln),
bd AS (SELECT rid, conv_id, turn, trim(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT regexp_matches(line, '^{B}*>')), '')) AS body FROM dp GROUP BY ALL),
rn AS (SELECT *, pos - row_number() OVER (PARTITION BY rid, depth ORDER BY pos) AS run FROM dp),
ps AS (SELECT conv_id, turn, min(pos) AS pos, depth, string_agg(line, chr(10) ORDER BY pos) AS passage, list(line ORDER BY pos) AS lines FROM rn
  WHERE depth > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY rid, conv_id, turn, depth, run),
un AS (SELECT conv_id, turn, unnest(list_distinct(list_concat([body], string_split_regex(body, '\\n{B}*\\n'), string_split(body, chr(10))))) AS unit FROM bd
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
own AS (SELECT DISTINCT conv_id, turn, {norm('unit')} AS n FROM un),
wanted AS (SELECT conv_id, turn, pos, depth, {norm('passage')} AS n, true AS whole FROM ps
  UNION ALL SELECT conv_id, turn, pos, depth, {norm('line')}, false FROM (SELECT conv_id, turn, pos, depth, unnest(lines) AS line FROM ps)),
hit AS (SELECT w.conv_id, w.turn, w.pos, w.depth, coalesce(max(o.turn) FILTER (whole), max(o.turn) FILTER (NOT whole)) AS source
  FROM wanted w LEFT JOIN own o ON o.conv_id = w.conv_id AND o.n = w.n AND o.turn < w.turn AND (w.whole OR w.n <> '') AND o.n <> '' GROUP BY ALL),
near AS (SELECT conv_id, turn, count(*) AS n_quotes, count(source) AS n_linked, first(source ORDER BY depth, -source, pos) FILTER (source IS NOT NULL) AS quoted FROM hit GROUP BY ALL),
tn AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
tr AS (SELECT tn.*, coalesce(quoted, before) AS reply_to, n_quotes, n_linked FROM tn LEFT JOIN near USING (conv_id, turn)),
hd AS (SELECT conv_id, turn AS head, reply_to, lpad(CAST(turn AS VARCHAR), 10, '0') AS digits FROM tr WHERE before IS NULL OR reply_to <> before),
ab AS (SELECT h.conv_id, h.head, h.digits, max(u.head) AS above FROM hd h LEFT JOIN hd u ON u.conv_id = h.conv_id AND u.head <= h.reply_to GROUP BY ALL),
pt AS (SELECT conv_id, head, digits AS path FROM ab WHERE above IS NULL
  UNION ALL SELECT ab.conv_id, ab.head, pt.path || ab.digits FROM ab JOIN pt ON ab.conv_id = pt.conv_id AND ab.above = pt.head),
th AS (SELECT tr.conv_id, tr.turn, max(hd.head) AS head FROM tr JOIN hd ON hd.conv_id = tr.conv_id AND hd.head <= tr.turn GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, bd.body, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, reply_to, path AS thread
FROM m JOIN bd USING (rid) LEFT JOIN tr ON tr.conv_id = m.conv_id AND tr.turn = m.turn
LEFT JOIN th ON th.conv_id = m.conv_id AND th.turn = m.turn LEFT JOIN pt ON pt.conv_id = th.conv_id AND pt.head = th.head"""


def part_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means of every part position: all distances in every round."""
    steps = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, len(embedding) // 8 AS d,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""pt AS MATERIALIZED (SELECT rid, vec_id, p, q[CAST(p * d + 1 AS BIGINT):CAST(p * d + d AS BIGINT)] AS x
  FROM v, (SELECT unnest(range({parts})) AS p))""",
        f"""b0 AS MATERIALIZED (SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM pt) WHERE e < {entries})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT rid, p, min({{'d': dist, 'e': e}}) AS m FROM (SELECT rid, pt.p, e,
    CAST(list_sum(list_transform(range(1, len(pt.x) + 1), lambda i: (pt.x[i] - b.x[i]) * (pt.x[i] - b.x[i]))) AS BIGINT) AS dist
  FROM pt JOIN b{i} b ON b.p = pt.p) GROUP BY ALL)"""
        )
        if i < rounds:
            steps.append(
                f"""b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT p, e, list(c ORDER BY pos) AS x FROM (SELECT p, e, pos, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c FROM (
      SELECT pt.p, m.e AS e, unnest(x) AS c, unnest(range(len(x))) AS pos FROM pt JOIN a{i} a ON a.rid = pt.rid AND a.p = pt.p) GROUP BY ALL) GROUP BY ALL
  ) n ON n.p = b.p AND n.e = b.e)"""
            )
    body = ",\n".join(steps)
    return f"""WITH {body},
o AS (SELECT rid, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
h AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, pos)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS pos FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN o USING (rid), h"""


# The prefix trie, each prefix known by the digests of its turns; CRC-32 bit by bit.
TRIE = """WITH m AS MATERIALIZED (SELECT conv_id, turn, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos FROM m),
c AS MATERIALIZED (SELECT conv_id, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda s: [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM n)),
r AS (SELECT c.conv_id, n.pos, n.said, n.chars, 0 AS own FROM c JOIN n ON n.conv_id = c.conv_id - c.conv_id % 100 AND n.pos <= h
  UNION ALL SELECT c.conv_id, n.pos, n.said, n.chars, 1 FROM c JOIN n ON n.conv_id = c.conv_id AND n.pos > h),
t AS (SELECT conv_id, said, chars, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM r),
p AS MATERIALIZED (SELECT conv_id, depth, chars, sha256(string_agg(said, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM t
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
w AS MATERIALIZED (SELECT p.*, lag(key) OVER (PARTITION BY conv_id ORDER BY p.depth) AS parent, p.depth = l.depth AS ends FROM p JOIN l USING (conv_id)),
nd AS MATERIALIZED (SELECT key, min(parent) AS parent, min(depth) AS depth, min(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM w GROUP BY key),
kd AS MATERIALIZED (SELECT nd.*, coalesce(k.n, 0) AS n_children FROM nd LEFT JOIN (SELECT parent AS key, count(*) AS n FROM nd GROUP BY parent) k USING (key)),
pr AS (SELECT DISTINCT a.key AS top, b.key AS key FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sm AS (SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens FROM pr JOIN kd USING (key) GROUP BY top)
SELECT kd.conv_id, CAST(kd.depth AS INTEGER) AS depth, u.conv_id AS parent_conv_id, kd.n_convs, kd.n_children, n_leaves, saved_tokens, kd.ends_sha256
FROM kd JOIN sm ON sm.top = kd.key LEFT JOIN kd u ON u.key = kd.parent"""

LLM_ORACLES: dict[str, str] = {"op3_warc_chunks": WARC, "op5_quotation_links": QUOTES, "op11_part_codes": part_codes(), "op13_zfast_trie": TRIE}
