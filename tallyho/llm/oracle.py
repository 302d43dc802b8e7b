"""DuckDB SQL for the operators that SQL can express, each written from its contract."""

WORD = "[^\\x20\\x09-\\x0D]+"

ORACLE: dict[str, str] = {}

ORACLE["op3_minhash"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents
                UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.a = d.doc_id
"""

ORACLE["op4_mixing"] = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY 1),
l AS (SELECT *, [3.0::DOUBLE, 1, 2][n % 3 + 1] AS w, s * 2.0::DOUBLE AS top FROM s),
o AS (SELECT *, sum(s) OVER () * 1.5::DOUBLE AS total, sum(w) OVER () AS ws, row_number() OVER lv AS nth,
             coalesce(sum(top) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_top,
             coalesce(sum(w) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_w
      FROM l WINDOW lv AS (ORDER BY top / w, n)),
e AS (SELECT *, (total - full_top) / (ws - full_w) AS lev FROM o),
h AS (SELECT min_by(lev, nth) AS lev FROM e WHERE lev * w <= top),
t AS (SELECT source, s, least(top, coalesce((SELECT lev FROM h) * w, top))::DOUBLE AS target FROM e),
r AS (SELECT d.doc_id, d.size, t.s AS source_size, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0 END AS rate,
             ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS coin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""

ORACLE["op6_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
      FROM d),
g AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
p AS (SELECT r, count(DISTINCT i + k) AS n FROM c, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
      FROM w LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 5 * word_chars OR 100 * n_dup_lines > 40 * n_lines
                                OR word_chars < 2 * n_words OR word_chars > 30 * n_words) AS kept
FROM b
"""

_HEAD = r"""'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
  || regexp_replace(coalesce(url, ''), '[\r\n]', ' ', 'g') || chr(13) || chr(10) || 'WARC-Payload-Digest: sha256:' || sha256(t)
  || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(t))
  || chr(13) || chr(10) || chr(13) || chr(10)"""

# CRC-32 of the id's digits, bit by bit: the fixture damages records whose value is 5 modulo 97.
_CRC = """list_reduce([4294967295::BIGINT] || list_transform(string_split(page_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
  lambda a, x: list_reduce([xor(a, x)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))"""

ORACLE["op7_warc_fixity"] = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS t FROM pages),
r AS (SELECT page_id, floor(page_id / 4096)::BIGINT AS archive, octet_length(encode({_HEAD} || t)) + 4 AS bytes,
             xor({_CRC}, 4294967295::BIGINT) % 97 = 5 AS hit FROM p),
o AS (SELECT *, row_number() OVER w - 1 AS nth, sum(bytes) OVER w - bytes AS "from" FROM r WINDOW w AS (PARTITION BY archive ORDER BY page_id))
SELECT archive, nth, page_id, "from"::BIGINT AS "from", bytes::BIGINT AS bytes,
       CASE WHEN archive % 5 = 2 AND nth >= 4000 THEN 'missing' ELSE 'corrupt' END AS kind
FROM o WHERE hit OR (archive % 5 = 2 AND nth >= 4000)
"""

ORACLE["op8_chat"] = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, length(replace(replace(role, '\', '\b'), '<', '\l')) + length(replace(replace(text, '\', '\b'), '<', '\l')) + 20 AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLE["op9_embeddings"] = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

_LEVEL = """
{name}k AS (SELECT CASE WHEN rho <= 1 / 1001.0::DOUBLE THEN 1000 WHEN rho >= 1 / 2.0::DOUBLE THEN 1 ELSE 1 / rho - 1 END AS k
    FROM (SELECT coalesce(sum(CASE WHEN n > 0 THEN n * (good / n - prior) * (good / n - prior) / (prior * (1 - prior)) - 1 END)
                          / nullif(sum(CASE WHEN n > 0 THEN n - 1 END), 0), 0) AS rho FROM {name}0)),
{name} AS (SELECT {keys}, n, good, prior, k, (good + k * prior) / (n + k) AS mean FROM {name}0, {name}k)"""

ORACLE["op10_url_filter"] = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'allow'),
                                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS r(rh, rp, rv)),
hit AS (SELECT host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(rv, length(rh || rp)) AS ruled
        FROM (SELECT DISTINCT host, path FROM hp), rules
        WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1, 2),
j AS (SELECT page_id, hp.host, hp.path, rule, ruled FROM hp LEFT JOIN hit USING (host, path)),
h AS (SELECT host, count(ruled)::DOUBLE AS n, count(*) FILTER (ruled = 'allow')::DOUBLE AS good, string_split(host, '.') AS lab FROM j GROUP BY 1),
f AS (SELECT host, n, good, lab, len(lab) > 2 AND length(lab[-1]) = 2 AND lab[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') AS two FROM h),
x AS (SELECT host, n, good, array_to_string(lab[-(CASE WHEN two THEN 2 ELSE 1 END):], '.') AS suffix,
             array_to_string(lab[-(CASE WHEN two THEN 3 ELSE 2 END):], '.') AS domain FROM f),
suffix0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT (sum(good) + 1) / (sum(n) + 2) FROM x) AS prior FROM x GROUP BY 1),
{_LEVEL.format(name="suffix", keys="suffix")},
domain0 AS (SELECT suffix, domain, sum(x.n) AS n, sum(x.good) AS good, any_value(s.mean) AS prior FROM x JOIN suffix s USING (suffix) GROUP BY 1, 2),
{_LEVEL.format(name="domain", keys="suffix, domain")},
host0 AS (SELECT suffix, domain, host, x.n, x.good, d.mean AS prior FROM x JOIN domain d USING (suffix, domain)),
{_LEVEL.format(name="host", keys="suffix, domain, host")}
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN mean + 2 * sqrt(mean * (1 - mean) / (host.n + k + 1)) < 0.3 THEN 'block' ELSE 'allow' END) AS verdict
FROM j JOIN host ON host.host = j.host
"""


def _pii(nth: int, kind: str, pattern: str, valid: str) -> str:
    return rf"""
SELECT r, {nth} AS nth, '{kind}' AS kind, e - length(v) AS s, e
FROM (SELECT r, m[i] AS v, p[i] AS b, p[i + 1] AS a, sum(length(p[i]) + length(m[i])) OVER (PARTITION BY r ORDER BY i)::BIGINT AS e
      FROM (SELECT r, m, p, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS p FROM d) WHERE len(m) > 0))
WHERE {valid}"""


def _has(words: str) -> str:
    return f"regexp_matches(lower(right(b, 40) || ' ' || left(a, 40)), '(^|[^a-z])({words})([^a-z]|$)')"


_ONLY = "regexp_replace(v, '[^0-9]', '', 'g')"
_CALL = "phone|tel|call|mobile|fax|telefon|llame"
_CHARS = "list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1)) - 48)"
_LUHN = (f"list_sum(list_transform({_CHARS.format('reverse(' + _ONLY + ')')}, lambda x, i: CASE WHEN i % 2 = 1 THEN x "
         "WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END)) % 10 = 0")
_CODE = "replace(v, ' ', '')"
_TURNED = f"(substr({_CODE}, 5) || substr({_CODE}, 1, 4))"
_MOD = (f"list_reduce(list_transform({_CHARS.format(_TURNED)}, lambda x: (CASE WHEN x > 9 THEN x - 7 ELSE x END)::BIGINT), "
        "lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1")


def _alone(more: str) -> str:
    return f"NOT regexp_matches(right(b, 1), '[A-Za-z0-9{more}]') AND NOT regexp_matches(left(a, 1), '[A-Za-z0-9{more}]')"


_KINDS = " UNION ALL ".join([
    _pii(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    _pii(1, "ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
         "len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(right(ltrim(x, '0'), 3) AS INT), 0) > 255)) = 0"),
    _pii(2, "card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_ONLY}) BETWEEN 12 AND 19 AND {_LUHN}"),
    _pii(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_ONLY}) BETWEEN 9 AND 15"),
    _pii(4, "iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
         f"{_alone('')} AND length({_CODE}) BETWEEN 15 AND 34 AND {_MOD}"),
    _pii(5, "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         f"{_alone('-')} AND NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$') AND {_has('ssn|social|security|taxpayer')}"),
    _pii(6, "tel", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
         f"{_alone('+-')} AND NOT regexp_matches(b, '\\+[0-9]{{1,3}} ?$') AND {_has(_CALL)} AND NOT {_has('isbn|order|serial')}")])

ORACLE["op12_pii"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
k AS ({_KINDS}),
g AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) AS spans,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) FILTER (WHERE nth < 4) AS base,
             {", ".join(f"count(*) FILTER (WHERE nth = {i}) AS n_{n}" for i, n in enumerate(("email", "ip", "card", "phone")))}
      FROM k GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0)::BIGINT AS n_{n}" for n in ("email", "ip", "card", "phone"))},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)
"""


def _fed(*columns: str) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
                                   for c in columns) + ")"


def _levels(name: str, tree: str, depth: int) -> str:
    """Nodes, runs and steps of a tree's levels: ``name0(tree, i, h)`` given; steps list each node's run and slot."""
    out = []
    for k in range(depth):
        out.append(f"{name}r{k} AS (SELECT {tree}, i // 16 AS u, string_agg(h, '' ORDER BY i) AS run, count(*) AS c FROM {name}{k} GROUP BY 1, 2)")
        out.append(f"{name}m{k} AS (SELECT {tree}, max(i) AS m FROM {name}{k} GROUP BY 1)")
        out.append(f"{name}{k + 1} AS (SELECT r.{tree}, u AS i, CASE WHEN m = 0 THEN run ELSE sha256(run) END AS h "
                   f"FROM {name}r{k} r JOIN {name}m{k} m ON r.{tree} IS NOT DISTINCT FROM m.{tree})")
    return ",\n".join(out)


def _fold(name: str, tree: str, at: str, depth: int, source: str, before: str) -> str:
    """``doc``, its place, proof and folded digest carried up ``depth`` levels of a tree."""
    out = []
    for k in range(depth):
        n, into = before if k == 0 else f"{name}f{k - 1}", f"{name}f{k}"
        place = at if k == 0 else "place"
        out.append(f"""{into} AS (SELECT x.* EXCLUDE (proof, fold{', place' if k else ''}), {place} // 16 AS place,
  CASE WHEN m = 0 THEN proof ELSE proof || substr(run, 1, 64 * ({place} % 16)) || substr(run, 64 * ({place} % 16) + 65) END AS proof,
  CASE WHEN m = 0 THEN fold ELSE sha256(substr(run, 1, 64 * ({place} % 16)) || fold || substr(run, 64 * ({place} % 16) + 65)) END AS fold
  FROM {n} x JOIN {name}r{k} r ON x.{source} IS NOT DISTINCT FROM r.{tree} AND r.u = {place} // 16
  JOIN {name}m{k} m ON x.{source} IS NOT DISTINCT FROM m.{tree})""")
    return ",\n".join(out)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# five levels a tree: up to a million leaves a source and a million sources
ORACLE["op13_manifest"] = f"""
WITH crc AS (SELECT *, xor({_CRC.replace('page_id', 'doc_id')}, 4294967295::BIGINT) AS c FROM documents),
h AS (SELECT doc_id, source, {_fed("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
             CASE WHEN c % 5 = 0 THEN {_fed("doc_id", "source", "lang", "n_chars", _LOWER)} END AS other FROM crc),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
a0 AS (SELECT source, i, leaf AS h FROM l),
{_levels("a", "source", 5)},
b0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h, source FROM a5),
{_levels("b", "one", 5)},
s AS (SELECT l.doc_id, l.leaf, l.source AS src, l.i AS leaf_at, 0 AS one, b0.i AS top, b0.h AS subroot, '' AS proof, coalesce(other, leaf) AS fold
      FROM l JOIN b0 ON l.source IS NOT DISTINCT FROM b0.source),
{_fold("a", "source", "leaf_at", 5, "src", "s")},
t AS (SELECT * EXCLUDE (place) FROM af4),
{_fold("b", "one", "top", 5, "one", "t")}
SELECT doc_id, leaf, subroot, b5.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b5.h AS verified FROM bf4, b5
"""
