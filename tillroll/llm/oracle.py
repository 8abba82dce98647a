"""DuckDB SQL that computes the operators' results another way."""

from __future__ import annotations

from tillroll.llm.mixing import MOST_EPOCHS, SEED
from tillroll.llm.quality_rules import DELTA, MAX_REPEAT_PERCENT, MIN_WORDS, RISK, RULES, joint_path
from tillroll.llm.warc import LEAST_REVISIT

WORD = r"[^\x20\x09-\x0D]+"


def quality_rules() -> str:
    value = {
        "n_bangs": "length(regexp_replace(t, '[^!?]', '', 'g'))",
        "n_upper": "length(regexp_replace(t, '[^A-Z]', '', 'g'))",
    }
    order = {r: i for i, r in enumerate(RULES)}
    grid = ",\n".join(
        [f"('apart', {order[r]}, '{r}', {j}, {c!r}::DOUBLE)" for r, (_, _, g) in RULES.items() for j, c in enumerate(g)]
        + [f"('joint', {order[r]}, '{r}', {j}, {c!r}::DOUBLE)" for j, step in enumerate(joint_path(RULES)) for r, c in step.items()]
    )

    def tail(share: str) -> str:
        return f"""(SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share})))
                   FROM (SELECT unnest(range(0, k + 1)) AS i))"""

    ratios = " UNION ALL ".join(
        f"SELECT doc_id, text_no, lang, base_failed, '{r}' AS rule, {a}::DOUBLE / greatest({b}, 1)::DOUBLE AS v FROM f"
        for r, (a, b, _) in RULES.items()
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS text_no, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
tri AS (SELECT text_no, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
        FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i)),
twice AS (SELECT text_no, i FROM (SELECT text_no, i, count(*) OVER (PARTITION BY text_no, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT text_no, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) AS o(j) GROUP BY text_no),
f AS (SELECT doc_id, w.text_no, lang, t, len(ws)::BIGINT AS n_words,
             length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             {value['n_bangs']} AS n_bangs, {value['n_upper']} AS n_upper,
             (len(ws) < {MIN_WORDS} OR 100 * coalesce(rep.n, 0) > {MAX_REPEAT_PERCENT} * len(ws)) AS base_failed
      FROM w LEFT JOIN rep USING (text_no)),
v AS ({ratios}),
grid(kind, rule_no, rule, step, cutoff) AS (VALUES {grid}),
strata AS (SELECT count(*) AS strata FROM (SELECT DISTINCT lang FROM f)),
labelled AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
-- one row for each distinct good text
good AS (SELECT lang, any_value(text_no) AS text_no FROM f JOIN labelled USING (doc_id) WHERE NOT base_failed GROUP BY lang, t HAVING min(q) = 1),
n AS (SELECT lang, count(*) AS n FROM good GROUP BY lang),
lost AS (SELECT v.lang, kind, CASE WHEN kind = 'apart' THEN grid.rule ELSE '' END AS path, step, count(DISTINCT v.text_no) FILTER (WHERE v.v > cutoff) AS k
         FROM v SEMI JOIN good USING (text_no) JOIN grid ON v.rule = grid.rule GROUP BY ALL),
tested AS (SELECT lost.lang, kind, path, step, CASE kind
             WHEN 'apart' THEN k <= {RISK / len(RULES)!r} * n AND {tail(repr(RISK / len(RULES)))} <= {DELTA / 2!r} / ({len(RULES)} * strata)
             ELSE k <= {RISK!r} * n AND {tail(repr(RISK))} <= {DELTA / 2!r} / strata END AS proven
           FROM lost JOIN n ON lost.lang IS NOT DISTINCT FROM n.lang, strata),
stop AS (SELECT lang, kind, path, coalesce(min(step) FILTER (WHERE NOT proven), 1000) AS s FROM tested GROUP BY ALL),
cut AS (SELECT lang, stop.kind, rule, rule_no, arg_max(cutoff, step) AS c FROM stop
        JOIN grid ON stop.kind = grid.kind AND (path = '' OR path = rule) AND step < s GROUP BY ALL),
hit AS (SELECT kind, v.lang, text_no, base_failed, string_agg(v.rule, ',' ORDER BY rule_no) AS failed_rules
        FROM v JOIN cut ON v.rule = cut.rule AND v.lang IS NOT DISTINCT FROM cut.lang WHERE v.v > c GROUP BY ALL),
-- of the two sets of cutoffs the one that rejects more documents, jointly proven ones if equal
rejects AS (SELECT lang, count(*) FILTER (WHERE kind = 'apart' AND NOT base_failed) > count(*) FILTER (WHERE kind = 'joint' AND NOT base_failed) AS apart
            FROM hit GROUP BY lang),
bad AS (SELECT text_no, failed_rules FROM hit JOIN rejects ON hit.lang IS NOT DISTINCT FROM rejects.lang
        WHERE kind = CASE WHEN apart THEN 'apart' ELSE 'joint' END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules
FROM f LEFT JOIN bad USING (text_no)
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates(k: int, percent: int) -> str:
    """Exact: prefix filter over shingles ordered by rarity, then whole sets."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                          WHEN len(ws) < {k} THEN [array_to_string(ws, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) END AS g
      FROM d),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
rare AS (SELECT x, count(*) AS c FROM e GROUP BY x),
p AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY c, x) AS r FROM e JOIN rare USING (x)),
pre AS (SELECT p.doc_id, x FROM p JOIN s USING (doc_id) WHERE 100 * r <= 100 * len(g) - {percent} * len(g) + 100),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b ON a.x = b.x AND a.doc_id < b.doc_id),
m AS (SELECT a, b, len(sa.g) AS na, len(sb.g) AS nb, len(list_intersect(sa.g, sb.g)) AS c
      FROM cand JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b),
l AS (SELECT a, b FROM m WHERE 100 * c >= {percent} * (na + nb - c)),
sym AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT reach.a, sym.b FROM reach JOIN sym ON sym.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


def decontamination(k: int, percent: int) -> str:
    """Exact containment of every pair that shares a shingle. An item of fewer than k
    words is one string of all its words; documents have strings of every length to k."""
    def words(table: str, ident: str) -> str:
        return rf"""SELECT row_number() OVER () AS n, {ident}, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS ws FROM {table}"""

    def cut(length: str) -> str:
        return f"list_transform(range(1, len(ws) - {length} + 2), lambda i: array_to_string(ws[i:i + {length} - 1], ' '))"

    return rf"""
WITH iw AS ({words('benchmark', 'item_id')}), dw AS ({words('documents', 'doc_id')}),
i AS (SELECT DISTINCT item_id, n, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {k} THEN [array_to_string(ws, ' ')] ELSE {cut(str(k))} END) AS g FROM iw),
lengths AS (SELECT DISTINCT least(len(ws), {k}) AS l FROM iw WHERE len(ws) > 0),
d AS (SELECT DISTINCT doc_id, n, unnest({cut('l')}) AS g FROM dw, lengths WHERE len(ws) >= l),
q AS (SELECT n, count(*) AS q FROM i GROUP BY n),
p AS (SELECT d.doc_id, i.item_id, d.n AS dn, i.n AS iq, count(*) AS c FROM d JOIN i USING (g) GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, q.q::BIGINT AS n_item_shingles, c::BIGINT AS n_shared, c / q.q AS containment
FROM p JOIN q ON q.n = p.iq WHERE 100 * c >= {percent} * q.q
"""


def mixing() -> str:
    return rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
d AS (SELECT doc_id, source, len(regexp_extract_all(t, '{WORD}'))::BIGINT AS size,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS signs,
             (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || t), 1, 13))::BIGINT::DOUBLE + 0.5) / {float(1 << 52)!r} AS u FROM t),
k AS (SELECT *, -ln(u) / greatest(0.1, 1.0::DOUBLE - signs::DOUBLE / greatest(size, 1)::DOUBLE) AS x FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
r AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::DOUBLE AS w, ({MOST_EPOCHS} * source_size)::DOUBLE AS cap FROM s),
f AS (SELECT *, row_number() OVER o AS rank,
             (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
      FROM r WINDOW o AS (ORDER BY cap / w, source IS NULL, encode(source))),
free AS (SELECT min(rank) AS first, min_by(level, rank) AS level FROM f WHERE cap / w > level),
g AS (SELECT source, source_size, CASE WHEN free.first IS NULL OR rank < free.first THEN cap ELSE least(cap, w * free.level) END AS target FROM f, free),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MOST_EPOCHS})::BIGINT ELSE 0 END AS epochs FROM g),
p AS (SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, target - epochs * source_size AS rest,
             sum(size) OVER (PARTITION BY k.source ORDER BY x) AS ends, sum(size) OVER (PARTITION BY k.source, x) AS own
      FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source),
c AS (SELECT *, (epochs + CASE WHEN 2 * ends - own <= 2 * rest AND rest > 0 THEN 1 ELSE 0 END)::BIGINT AS copies FROM p)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM c
"""


def warc() -> str:
    return f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest),
r AS (SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
             CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id > first THEN first END AS refers_to FROM p JOIN f USING (payload_digest))
SELECT *, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type FROM r
"""


def fill_in_middle() -> str:
    from tillroll.llm.fill_in_middle import FIM_PERCENT, MIDDLE, PREFIX, SEED, SPM_PERCENT, SUFFIX

    draw = "('0x' || substr(h, {}, 8))::BIGINT"
    sentinel = " OR ".join(f"contains(t, '{s}')" for s in (PREFIX, SUFFIX, MIDDLE))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ls FROM d),
c AS (SELECT *, len(ls)::BIGINT AS n, {draw.format(1)} % (len(ls) + 1) AS x, {draw.format(9)} % (len(ls) + 1) AS y,
             CASE WHEN t = '' OR {sentinel} OR {draw.format(17)} % 100 >= {FIM_PERCENT} THEN 'plain'
                  WHEN {draw.format(25)} % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (SELECT *, array_to_string(ls[1:least(x, y)], '') AS pre, array_to_string(ls[least(x, y) + 1:greatest(x, y)], '') AS mid,
             array_to_string(ls[greatest(x, y) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
              ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def centroids() -> str:
    from tillroll.llm.centroids import CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED

    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT rid, any_value(x.v) AS v, min(row(d, c)) AS best
      FROM (SELECT rid, k.v, c, list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM kept k CROSS JOIN c{i} m) x GROUP BY rid)""")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
      SELECT c, list(s ORDER BY j) AS v FROM (
        SELECT best[2] AS c, j, floor(sum(v[j]) / count(*))::BIGINT AS s FROM a{i}, (SELECT unnest(range(1, {DIMENSIONS} + 1)) AS j) GROUP BY ALL)
      GROUP BY c) n USING (c))""")
    chain = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIMENSIONS}
   AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
  SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {CLUSTERS})),
{chain},
f AS (SELECT vec_id, best[2] AS c, best[1] AS distance FROM kept JOIN a{ROUNDS} USING (rid))
SELECT vec_id, c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM f JOIN c{ROUNDS} USING (c)
"""


def suffix_dedup() -> str:
    from tillroll.llm.suffix_index import MATCH

    m, block = MATCH, 1000
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT rid, doc_id, x, length(x)::BIGINT // 2 AS n FROM d),
b AS (SELECT rid, doc_id, n, o, substr(x, 2 * o + 1, {2 * (block + m - 1)}) AS y
      FROM s, LATERAL (SELECT unnest(range(0, n - {m - 1}, {block})) AS o) WHERE doc_id IS NOT NULL),
w AS (SELECT rid, doc_id, o + i AS p, substr(y, 2 * i + 1, {2 * m}) AS g
      FROM b, LATERAL (SELECT unnest(range(0, least({block}, n - {m - 1} - o))) AS i)),
hit AS (SELECT rid, p FROM w JOIN (SELECT g, min(doc_id) AS least FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)) USING (g)
        WHERE least < doc_id),
run AS (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS k
        FROM (SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + {m} THEN 0 ELSE 1 END AS new FROM hit)),
span AS (SELECT rid, k, min(p) AS a, max(p) + {m} AS e FROM run GROUP BY rid, k),
-- the kept pieces lie between the spans
gone AS (SELECT rid, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS starts, list(e ORDER BY a) AS ends
         FROM span GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE array_to_string(list_transform(range(1, n_spans + 2), lambda i:
         substr(x, 2 * (CASE WHEN i = 1 THEN 0 ELSE ends[i - 1] END) + 1,
                2 * ((CASE WHEN i > n_spans THEN n ELSE starts[i] END) - (CASE WHEN i = 1 THEN 0 ELSE ends[i - 1] END)))), '') END)) AS kept_sha256
FROM s LEFT JOIN gone USING (rid)
"""
