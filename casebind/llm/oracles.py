"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALPHANUMERIC = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                 r"'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')")


def _shingles(words: str) -> str:
    return f"""unnest(list_distinct(list_transform(range(0, greatest(len({words}) - 4, 1)),
 lambda i: array_to_string({words}[i + 1:i + 5], ' '))))"""


OP1 = f"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
p AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11),
 lambda i: {{'i': i, 's': array_to_string(w[i:i + 12], ' ')}}), recursive := true) FROM d),
m AS (SELECT s, min(doc_id) AS first_doc FROM p GROUP BY s),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM p JOIN m USING (s), range(0, 13) t(j) WHERE first_doc < doc_id),
a AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept
 FROM a ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
 sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

_CONTROL = ("<s>", "</s>", "<|", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_ESCAPED = "length({0}) + length({0}) - length(replace({0}, '\\', ''))" + "".join(
    f" + (length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in _CONTROL)

OP4 = f"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
 UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(15 + {_ESCAPED.format('role')} + {_ESCAPED.format('text')}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

OP5 = """
WITH l AS (SELECT doc_id, generate_subscripts(x, 1) AS pos, unnest(x) AS line
 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
f AS (SELECT line, min(doc_id * 10000000 + pos) AS place, length(line) AS n FROM l WHERE line <> '' GROUP BY line),
v AS (SELECT place, line, n, unnest(range(1, n + 1)) AS i FROM f WHERE n >= 10),
k AS (SELECT place, n, i, hash(left(line, i - 1) || substr(line, i + 1)) AS h FROM v),
gone AS (SELECT b.place FROM k a JOIN k b ON a.h = b.h AND a.i = b.i AND a.n = b.n AND a.place < b.place
 UNION SELECT greatest(k.place, f.place) FROM k JOIN f ON k.h = hash(f.line) AND f.n = k.n - 1 AND f.n >= 10),
stay AS (SELECT place FROM f ANTI JOIN gone USING (place)),
marked AS (SELECT doc_id, pos, line, s.place IS NOT NULL AS first FROM l
 LEFT JOIN stay s ON s.place = doc_id * 10000000 + pos)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (first OR line = ''), '') AS text,
 count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (first) AS n_kept FROM marked GROUP BY doc_id"""

OP7 = f"""
WITH d AS (SELECT doc_id, {_ALPHANUMERIC} AS w FROM documents),
b AS (SELECT item_id, {_ALPHANUMERIC} AS w FROM benchmark),
q AS (SELECT item_id, {_shingles('w')} AS g FROM b WHERE len(w) > 0),
s AS (SELECT doc_id, unnest(list_distinct(list_transform(range(0, len(w) - 4),
 lambda i: array_to_string(w[i + 1:i + 5], ' ')))) AS g FROM d),
n AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id)
SELECT doc_id, item_id, count(*) / any_value(n) AS containment FROM s JOIN q USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) / any_value(n) >= 0.8"""

OP8 = r"""
WITH z AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
 -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS key
 FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s),
r AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER o, 0))
 / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level, 2 * source_size / w AS ratio FROM w
 WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CAST(least(2 * source_size,
 w * max(CASE WHEN level <= ratio THEN level END) OVER ()) AS DOUBLE) AS target FROM r),
e AS (SELECT z.*, source_size, target,
 CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
 sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS stop
 FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + least(size, greatest(0,
 floor(target - epochs * source_size) - stop + size)) AS BIGINT) AS taken FROM e"""

OP8_BY_QUALITY = (
    OP8.replace("WITH z AS", """WITH q AS (SELECT doc_id, CAST(CASE WHEN avg(quality) > 0.5 THEN 3 ELSE 1 END AS DOUBLE) AS weight
 FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
z AS""").replace("4503599627370496.0) AS key\n FROM documents", """4503599627370496.0) / coalesce(weight, 1) AS key
 FROM documents LEFT JOIN q USING (doc_id)"""))

OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT text, min(doc_id) AS class_id, count(*) AS n_copies FROM d GROUP BY text),
w AS (SELECT class_id, {_SPACED} AS w FROM c),
s AS (SELECT class_id, {_shingles('w')} AS g FROM w WHERE len(w) > 0),
n AS (SELECT class_id, count(*) AS n FROM s GROUP BY class_id),
p AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS k FROM s a JOIN s b USING (g)
 WHERE a.class_id <> b.class_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.class_id = a JOIN n y ON y.class_id = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
g AS (SELECT a AS class_id, least(a, min(b)) AS group_id FROM r GROUP BY a),
m AS (SELECT a AS class_id, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, class_id, n_copies, coalesce(n_links, 0) AS n_links, coalesce(group_id, class_id) AS group_id
FROM d JOIN c USING (text) LEFT JOIN g USING (class_id) LEFT JOIN m USING (class_id)"""

_CRC_TABLE = """t AS MATERIALIZED (SELECT list(c ORDER BY i) AS c FROM (SELECT i, list_reduce(list_concat([i], range(8)),
 lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(
 hex(encode({text})), '..'), lambda b: CAST(('0x' || b) AS BIGINT))),
 lambda a, b: xor(a >> 8, c[1 + CAST(xor(a & 255, b) AS INT)])), 4294967295)"""


def _rendezvous(shards: int) -> str:
    return f"""(SELECT i FROM (SELECT i, 1.0 / -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':'
 || CAST(i AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS bid FROM range({shards}) r(i))
 ORDER BY bid DESC, i LIMIT 1)"""


OP11 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
 {_crc32("coalesce(text, '')")} AS text_crc32, {_rendezvous(8)} AS shard, {_rendezvous(9)} AS grown_shard
 FROM documents, t)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard, CAST(grown_shard AS INT) AS grown_shard,
 row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot FROM d"""


def _op12(rounds: int = 4) -> str:
    sql = """
WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] AS x FROM v, range(4) r(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x
 FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256))"""
    for k in range(rounds + 1):
        sql += f""",
a{k} AS MATERIALIZED (SELECT p.vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
 SELECT p.vec_id, part, entry, list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x)
 + list_inner_product(b.x, b.x) AS d FROM p JOIN b{k} b USING (part)) p GROUP BY p.vec_id, part),
m{k} AS (SELECT part, entry, list(y ORDER BY pos) AS x FROM (SELECT part, entry, pos, floor(sum(y) / count(*)) AS y
 FROM (SELECT part, entry, unnest(p.x) AS y, generate_subscripts(p.x, 1) AS pos FROM a{k} JOIN p USING (vec_id, part))
 GROUP BY ALL) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry))"""
    return sql + f""",
c AS (SELECT vec_id, string_agg(lower(lpad(hex(entry), 2, '0')), '' ORDER BY part) AS code,
 CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
s AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
 FROM (SELECT part, entry, unnest(x) AS y, generate_subscripts(x, 1) AS pos FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c JOIN v USING (vec_id), s"""


OP12 = _op12()

OP13 = f"""
WITH {_CRC_TABLE},
d AS MATERIALIZED (SELECT doc_id, {_ALPHANUMERIC} AS w FROM documents),
b AS (SELECT {_ALPHANUMERIC} AS w FROM benchmark),
f AS MATERIALIZED (SELECT doc_id, unnest(list_transform(range(1, len(w) - n + 1), lambda i: array_to_string(w[i:i + n], ' '))) AS f
 FROM d, range(3) r(n)),
g AS MATERIALIZED (SELECT unnest(list_transform(range(1, len(w) - n + 1), lambda i: array_to_string(w[i:i + n], ' '))) AS f
 FROM b, range(3) r(n)),
k AS MATERIALIZED (SELECT f, {_crc32('f')} % 10000 AS bucket FROM (SELECT f FROM f UNION SELECT f FROM g), t),
x AS (SELECT bucket, count(*) AS s FROM f JOIN k USING (f) GROUP BY bucket),
y AS (SELECT bucket, count(*) AS t FROM g JOIN k USING (f) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM f) AS s_all, (SELECT count(*) FROM g) AS t_all),
gain AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (s_all + 10000)
 / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
 FROM (SELECT range AS bucket FROM range(10000)) LEFT JOIN x USING (bucket) LEFT JOIN y USING (bucket), n),
w AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN k USING (f)
 JOIN gain USING (bucket) GROUP BY doc_id),
z AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
 coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)
 + 0.5) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w USING (doc_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
 count(*) OVER (PARTITION BY n_words >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM o"""

ORACLES = {
    "op1_substring_dedup": OP1, "op4_chat": OP4, "op5_line_dedup": OP5, "op7_decontamination": OP7,
    "op8_mixing": OP8_BY_QUALITY, "op8_mixing_by_quality": OP8_BY_QUALITY,
    "op10_ngram_join": OP10, "op11_sharding": OP11, "op12_vector_codes": OP12, "op13_resampling": OP13,
}
