"""DuckDB SQL of the queries that SQL can express, written without the operators' code (but for fixed values)."""

from tidemark.llm.pii import IBAN_COUNTRIES

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, i, concat_ws(chr(10), lines[i], lines[i + 1], lines[i + 2]) AS run
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM w),
c AS (SELECT doc_id, list(DISTINCT p) AS covered
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE k > 1) GROUP BY doc_id)
SELECT l.doc_id,
       CASE WHEN covered IS NULL THEN text
            ELSE coalesce(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(covered, i)), chr(10)), '') END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS n_lines,
       coalesce(len(covered), 0) AS n_removed
FROM l LEFT JOIN c ON l.doc_id = c.doc_id
"""

_FILL = """
{name}_r AS (SELECT *, {budget} - coalesce(sum(cap) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / w, {child} NULLS FIRST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
              sum(w) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / w, {child} NULLS FIRST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest FROM {name}_n),
{name}_f AS (SELECT *, cap * w_rest <= rest * w AS filled FROM {name}_r),
{name} AS (SELECT {keys}, CAST(CASE WHEN filled THEN cap ELSE
              (max(CASE WHEN NOT filled THEN rest END) OVER ({part}) * w)
              // max(CASE WHEN NOT filled THEN w_rest END) OVER ({part}) END AS HUGEINT) AS budget FROM {name}_f)"""

MIXING = (
    r"""
WITH d AS (SELECT doc_id, lang, source,
                  CASE WHEN source IS NULL THEN NULL
                       WHEN regexp_extract(source, '\d{1,9}$') = '' THEN 'none'
                       ELSE 'd' || CAST(CAST(regexp_extract(source, '\d{1,9}$') AS INTEGER) % 4 AS VARCHAR) END AS domain,
                  coalesce(len(regexp_extract_all(text, '[^ \t\n\v\f\r]+')), 0) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS supply, CAST(sum(tokens) * 2 AS HUGEINT) AS cap
         FROM d GROUP BY ALL),
a_n AS (SELECT domain, sum(cap) AS cap, CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS w,
               least(sum(sum(supply)) OVER () * 4 // 5, sum(sum(cap)) OVER ()) AS budget FROM leaf GROUP BY domain),"""
    + _FILL.format(name="a", budget="budget", part="", child="domain", keys="domain") + r""",
b_n AS (SELECT n.*, a.budget FROM (SELECT domain, lang, sum(cap) AS cap,
               CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w FROM leaf GROUP BY domain, lang) n
        JOIN a ON n.domain IS NOT DISTINCT FROM a.domain),"""
    + _FILL.format(name="b", budget="budget", part="PARTITION BY domain", child="lang", keys="domain, lang") + r""",
c_n AS (SELECT leaf.*, 1 AS w, b.budget FROM leaf JOIN b ON leaf.domain IS NOT DISTINCT FROM b.domain
        AND leaf.lang IS NOT DISTINCT FROM b.lang),"""
    + _FILL.format(name="c", budget="budget", part="PARTITION BY domain, lang", child="source", keys="domain, lang, source, supply") + r""",
p AS (SELECT *, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS epochs,
             CASE WHEN supply > 0 THEN budget % supply ELSE 0 END AS rest FROM c),
o AS (SELECT d.*, p.epochs, p.rest, sum(tokens) OVER (PARTITION BY d.domain, d.lang, d.source
             ORDER BY md5(concat('7:', p.epochs, ':', coalesce(CAST(doc_id AS VARCHAR), 'null'))) RANGE UNBOUNDED PRECEDING) AS up_to
      FROM d JOIN p ON d.domain IS NOT DISTINCT FROM p.domain AND d.lang IS NOT DISTINCT FROM p.lang
                   AND d.source IS NOT DISTINCT FROM p.source),
t AS (SELECT *, epochs + CASE WHEN epochs < 2 AND up_to <= rest THEN 1 ELSE 0 END AS times FROM o)
SELECT doc_id, domain, lang, source, CAST(unnest(range(CAST(times AS BIGINT))) AS INTEGER) AS epoch FROM t
""")

_IBAN = "|".join(rf"({'|'.join(c.split())})[0-9]{{2}}( ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_COUNTRIES.items())
_KINDS = [
    ("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0.9, "e-?mails?|mails?|mailto|contact|write"),
    ("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0.6, "ip|address|addresses|servers?|hosts?"),
    ("card", 2, r"[0-9]([ -]?[0-9])+", 0.8, "cards?|credit|visa|payments?"),
    ("phone", 3, r"\+[0-9][ ().0-9-]+[0-9]", 0.6, "phones?|telephones?|tel|call|mobile|fax"),
    ("iban", 4, rf"\b({_IBAN})\b", 0.8, "iban|banks?|accounts?|transfers?"),
]
_FOUND = " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS kind, {o} AS ord, {s} AS score, '{w}' AS words, regexp_extract_all(t, '{p}') AS ms, "
    f"string_split_regex(t, '{p}') AS ps FROM t WHERE regexp_matches(t, '{p}')" for k, o, p, s, w in _KINDS)

PII = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
u AS (SELECT doc_id, kind, ord, score, words, ms[k] AS m, ps[k] AS before, ps[k + 1] AS after,
             CAST(list_sum(list_transform(ps[1:k], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM f)),
n AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS account FROM u),
v AS (SELECT * FROM n WHERE CASE kind
   WHEN 'email' THEN true
   WHEN 'ip' THEN list_bool_and(list_transform(string_split(m, '.'),
        lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(nullif(ltrim(x, '0'), '') AS INTEGER), 0) <= 255))
   WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''),
        lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INTEGER)
                     ELSE CAST(x AS INTEGER) * 2 - CASE WHEN CAST(x AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
   WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
   ELSE list_reduce(list_concat([0], list_transform(string_split(substr(account, 5) || substr(account, 1, 4), ''),
        lambda x: CASE WHEN x BETWEEN '0' AND '9' THEN CAST(ascii(x) - 48 AS INTEGER) ELSE CAST(ascii(x) - 55 AS INTEGER) END)),
        lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1 END),
s AS (SELECT doc_id, kind, ord, start, kind || ':' || start || ':' || (start + length(m)) AS span,
             round(CASE WHEN kind = 'iban' AND NOT regexp_matches(m, '^[A-Z0-9]+$|^([A-Z0-9]{{4}} )+[A-Z0-9]{{1,4}}$') THEN 0.45 ELSE score END
                   + CASE WHEN regexp_matches(lower(concat(
                       CASE WHEN length(before) > 40 THEN regexp_replace(right(before, 41), '^[A-Za-z0-9_]+', '') ELSE before END, ' ',
                       CASE WHEN length(after) > 40 THEN regexp_replace(left(after, 41), '[A-Za-z0-9_]+$', '') ELSE after END)),
                       '(^|[^a-z0-9_])(' || words || ')($|[^a-z0-9_])') THEN 0.1 ELSE 0 END, 2) AS score
      FROM v),
h AS (SELECT * FROM s WHERE kind <> 'iban' OR score >= 0.5),
g AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
             count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
             count(*) FILTER (kind = 'iban') AS n_iban,
             string_agg(span, ',' ORDER BY start, ord) AS spans,
             coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (kind <> 'iban'), '') AS base,
             string_agg(CAST(CAST(score AS DOUBLE) AS VARCHAR), ',' ORDER BY start, ord) AS scores
      FROM h GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_iban, 0) AS n_iban, coalesce(scores, '') AS scores
FROM t LEFT JOIN g ON t.doc_id = g.doc_id
"""

TOP_K = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

WARC = """
WITH c AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html, chr(13) || chr(10) AS nl FROM pages),
k AS (SELECT *, md5(concat_ws(':', page_id, uri)) AS h, (SELECT greatest(1, CAST(ceil(count(*) / 1000.0) AS BIGINT)) FROM c) AS files FROM c),
r AS (SELECT page_id, uri, CAST('0x' || h[1:8] AS BIGINT) % files AS file,
             'WARC/1.0' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:uuid:'
             || concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) || '>' || nl || 'WARC-Date: 2024-01-01T00:00:00Z' || nl
             || 'WARC-Target-URI: ' || replace(replace(uri, chr(13), ''), chr(10), '') || nl || 'Content-Type: text/html' || nl
             || 'Content-Length: ' || strlen(html) || nl || nl || html AS record FROM k),
d AS (SELECT page_id, uri, file, CAST(strlen(record) + 4 AS BIGINT) AS length, sha256(record) AS digest FROM r),
p AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, digest
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
             CAST(sum(length) OVER (PARTITION BY file) AS BIGINT) AS fin FROM d),
t AS (SELECT *, page_id % 389 = 7 AS lost, page_id % 97 = 13 AS hurt, page_id % 499 = 3 AS again FROM p)
SELECT file, "offset", length, page_id, uri, CASE WHEN again THEN 'moved' WHEN lost THEN 'missing' ELSE 'changed' END AS fault,
       digest, CASE WHEN NOT lost THEN sha256(digest || 'x') END AS other_digest FROM t WHERE lost OR hurt
UNION ALL
SELECT file, fin + page_id, length, NULL, NULL, 'extra', NULL, digest FROM t WHERE again AND NOT lost AND NOT hurt
"""

REPLICAS = """
WITH c AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html, chr(13) || chr(10) AS nl FROM pages),
k AS (SELECT *, md5(concat_ws(':', page_id, uri)) AS h, (SELECT greatest(1, CAST(ceil(count(*) / 1000.0) AS BIGINT)) FROM c) AS files FROM c),
r AS (SELECT page_id, uri, CAST('0x' || h[1:8] AS BIGINT) % files AS file,
             'WARC/1.0' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:uuid:'
             || concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) || '>' || nl || 'WARC-Date: 2024-01-01T00:00:00Z' || nl
             || 'WARC-Target-URI: ' || replace(replace(uri, chr(13), ''), chr(10), '') || nl || 'Content-Type: text/html' || nl
             || 'Content-Length: ' || strlen(html) || nl || nl || html AS record FROM k),
one AS (SELECT file, 0 AS copy, page_id, uri, sha256(record) AS was, record FROM r),
two AS (SELECT file, copy, page_id, was, CASE WHEN copy = 0 AND page_id % 97 = 13
               THEN substring(record, 1, length(record) - 1) || CASE WHEN right(record, 1) = '#' THEN '@' ELSE '#' END ELSE record END AS record
        FROM (SELECT file, 0 AS copy, page_id, was, record FROM one WHERE coalesce(page_id % 389 <> 7, true)
              UNION ALL SELECT file, 1, page_id, was, record FROM one WHERE page_id % 499 = 3)),
a AS (SELECT file, CAST(sum(strlen(record) + 4) OVER w - strlen(record) - 4 AS BIGINT) AS "offset", CAST(strlen(record) + 4 AS BIGINT) AS length,
             page_id, uri, was AS digest FROM one WINDOW w AS (PARTITION BY file ORDER BY page_id NULLS FIRST, was ROWS UNBOUNDED PRECEDING)),
b AS (SELECT file, CAST(sum(strlen(record) + 4) OVER w - strlen(record) - 4 AS BIGINT) AS "offset", CAST(strlen(record) + 4 AS BIGINT) AS length,
             sha256(record) AS digest FROM two WINDOW w AS (PARTITION BY file ORDER BY copy, page_id NULLS FIRST, was ROWS UNBOUNDED PRECEDING)),
d AS (SELECT coalesce(a.file, b.file) AS file, coalesce(a."offset", b."offset") AS "offset", coalesce(a.length, b.length) AS length,
             page_id, uri, a.digest, b.digest AS other_digest
      FROM a FULL JOIN b ON a.file = b.file AND a."offset" = b."offset"
      WHERE a.digest IS DISTINCT FROM b.digest OR a.length IS DISTINCT FROM b.length),
m AS (SELECT file, digest FROM d WHERE digest IS NOT NULL INTERSECT SELECT file, other_digest FROM d WHERE other_digest IS NOT NULL),
f AS (SELECT d.*, EXISTS (SELECT 1 FROM m WHERE m.file = d.file AND m.digest = d.digest) AS went,
             EXISTS (SELECT 1 FROM m WHERE m.file = d.file AND m.digest = d.other_digest) AS came FROM d)
SELECT file, "offset", length, page_id, uri,
       CASE WHEN went THEN 'moved' WHEN digest IS NULL THEN 'extra' WHEN other_digest IS NULL OR came THEN 'missing' ELSE 'changed' END AS fault,
       digest, other_digest FROM f WHERE digest IS NOT NULL OR NOT came
"""

ORACLE = {"op7_warc": WARC, "op7_replicas": REPLICAS,
          "op7_stored": f'SELECT file, "offset", length, uri, fault, digest, other_digest FROM ({REPLICAS})', "op1_line_dedup": LINE_DEDUP, "op6_mixing": MIXING, "op8_pii": PII, "op9_topk": TOP_K}

# operators 11 to 13

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
r AS (SELECT vec_id, vec_id AS seen FROM embeddings UNION SELECT r.vec_id, p.b FROM r JOIN p ON p.a = r.seen),
c AS (SELECT vec_id, min(seen) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.vec_id = c.vec_id
"""

COLLOCATIONS = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
s AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(words) >= k),
f AS (SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k, count(*) AS f FROM s GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
x AS (SELECT lang, phrase, k, a, words, unnest(range(1, k)) AS cut FROM c),
y AS (SELECT x.lang, x.phrase, x.a, cut, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * x.a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score FROM x
      JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(words[1:cut], ' ')
      JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
b AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
d AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN c ON c.lang = b.lang AND c.k > len(string_split(b.phrase, ' '))
      AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * CAST(c.a AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)),
k AS (SELECT b.* FROM b ANTI JOIN d ON d.lang = b.lang AND d.phrase = b.phrase)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n, score FROM k JOIN n ON n.lang = k.lang)
WHERE rank <= 2000
"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\x00-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
e AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT x.lang, x.source, coalesce(v.v, 0) AS v, coalesce((SELECT sum(e.n) FROM e WHERE e.lang = x.lang AND e.source = x.source), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v ON v.lang = x.lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(e.n, 0) AS n, 1 + 1000000000 * (coalesce(e.n, 0) + 2) // (g.n + 2 * g.v) AS p,
             1 + 1000000000 * (k.n + 2) // (v.n + 2 * v.v) AS q
      FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN e ON e.lang = g.lang AND e.source = g.source AND e.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) WHERE part = 'pair' OR rank <= 10
"""

ORACLE |= {"op11_lattice": NEAR_VECTORS, "op12_collocations": COLLOCATIONS, "op13_divergence": DIVERGENCE}
