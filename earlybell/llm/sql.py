"""DuckDB statements of the queries that SQL can express."""

from earlybell.llm import licenses, quality, secrets

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), starts AS (
  SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts
), lengths AS (SELECT DISTINCT k FROM windows
), places AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lengths WHERE len(w) >= k
), grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM places
), hits AS (SELECT doc_id, k, i, item FROM grams JOIN windows USING (k, g)
), marks AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits
), n_marks AS (SELECT doc_id, count(*) AS n_hit FROM marks GROUP BY doc_id
), found AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN n_marks USING (doc_id) LEFT JOIN found USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0
), sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sets a JOIN sets b USING (s) WHERE a.doc_id < b.doc_id GROUP BY x, y
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM docs
  UNION
  SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = r
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_RULES = quality.Rules()
_SHARES = {
    "symbol_share": "1000 * n_symbols // greatest(word_chars, 1)",
    "line_share": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeat_share": "1000 * n_repeat_words // greatest(n_words, 1)",
    "capital_share": "1000 * n_capitals // greatest(word_chars, 1)",
    "word_length": "100 * word_chars // greatest(n_words, 1)",
}
_VALUES = " UNION ALL ".join(
    f"SELECT lang, source, '{name}' AS share, {slack} AS slack, {_SHARES[name]} AS v FROM judged WHERE NOT base_failed"
    for name, slack in _RULES.slack
)
_LEVELS = " UNION ALL ".join(
    f"SELECT {k} AS level, {lang} AS lang, {source} AS source, share, slack, bucket FROM buckets"
    for k, lang, source in ((2, "lang", "source"), (1, "lang", "NULL"), (0, "NULL", "NULL"))
)
_INSIDE = " AND ".join(f"coalesce({expr} <= f_{name}, true)" for name, expr in _SHARES.items())
_PICK = ", ".join(f"max(fence) FILTER (share = '{name}') AS f_{name}" for name in _SHARES)
_CHOSEN = ", ".join(
    f"CASE WHEN o.total >= {_RULES.min_rows} THEN o.f_{n} WHEN l.total >= {_RULES.min_rows} THEN l.f_{n} ELSE a.f_{n} END AS f_{n}"
    for n in _SHARES
)

QUALITY = rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), places AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8
), windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM places
), twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM twice
), repeats AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    CAST(len(l) AS BIGINT) AS n_lines, length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS n_capitals
  FROM split LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed FROM counted
), shared AS ({_VALUES}
), bits AS (SELECT *, greatest(length(bin(v)) - 7, 0) AS s FROM shared
), buckets AS (SELECT lang, source, share, slack, (v >> s) << s AS bucket FROM bits
), levels AS ({_LEVELS}
), sketch AS (
  SELECT level, lang, source, share, slack, bucket, count(*) AS n FROM levels GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, share ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, share) AS total FROM sketch
), quantiles AS (
  SELECT level, lang, source, share, slack, total, min(bucket) FILTER (100 * upto >= 50 * total) AS q50,
    min(bucket) FILTER (100 * upto >= 10 * total) AS q10 FROM ranked GROUP BY ALL
), fences AS (SELECT level, lang, source, share, total, q50 + {_RULES.factor} * greatest(q50 - q10, slack) AS fence FROM quantiles
), wide AS (SELECT level, lang, source, max(total) AS total, {_PICK} FROM fences GROUP BY level, lang, source
), chosen AS (
  SELECT o.lang, o.source, {_CHOSEN} FROM (FROM wide WHERE level = 2) o
  LEFT JOIN (FROM wide WHERE level = 1) l ON o.lang IS NOT DISTINCT FROM l.lang LEFT JOIN (FROM wide WHERE level = 0) a ON true
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_INSIDE} AS kept
FROM judged d LEFT JOIN chosen c ON d.lang IS NOT DISTINCT FROM c.lang AND d.source IS NOT DISTINCT FROM c.source
"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


_SECRET_PATTERNS = {
    "assign": secrets.ASSIGN,
    "access": secrets.ACCESS,
    "hex": secrets.HEX,
    "loose": secrets.LOOSE,
    "account": secrets.ACCOUNT,
    "endpoint": secrets.ENDPOINT,
    "break": secrets.PARAGRAPH,
}
_FOUND = " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, regexp_extract_all(body, '{_quoted(p.pattern.decode())}') AS m,"
    f" string_split_regex(body, '{_quoted(p.pattern.decode())}') AS g FROM docs"
    for kind, p in _SECRET_PATTERNS.items()
)
_ORDER = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(secrets.KINDS)) + " END"
_BASE = ", ".join(f"'{k}'" for k in secrets.BASE_KINDS)
_NEEDS = " OR ".join(
    f"(w.kind = '{k}' AND s.kind IN ({', '.join(repr(o) for o in others)}))" for k, others in secrets.COMPLEMENTS.items()
)
_VALUE = _quoted(r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""")

SECRETS = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents
), found AS ({_FOUND}
), numbered AS (SELECT doc_id, kind, m, g, unnest(range(1, len(m) + 1)) AS i FROM found WHERE len(m) > 0
), placed AS (
  SELECT doc_id, kind, m[i] AS t,
    CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM numbered
), spans AS (
  SELECT doc_id, kind, a, a + length(t) AS b FROM placed WHERE CASE kind
    WHEN 'assign' THEN length(regexp_replace(t, '{_VALUE}', '')) >= 6
    WHEN 'access' THEN length(t) >= 20
    WHEN 'loose' THEN length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) >= 3
      AND length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) >= 3 AND len(list_distinct(string_split(t, ''))) >= 8
    ELSE true END
), breaks AS (SELECT doc_id, b AS e FROM spans WHERE kind = 'break'
), base AS (SELECT * FROM spans WHERE kind IN ({_BASE})
), free AS (
  SELECT *, false AS named, false AS inside FROM spans x WHERE kind NOT IN ('loose', 'break')
  UNION ALL
  SELECT *, EXISTS (FROM spans y WHERE y.kind = 'account' AND y.doc_id = x.doc_id AND y.a < x.b AND y.b > x.a),
    EXISTS (FROM spans y WHERE y.kind = 'endpoint' AND y.doc_id = x.doc_id AND y.a < x.b AND y.b > x.a)
  FROM spans x WHERE kind = 'loose' AND NOT EXISTS (FROM base y WHERE y.doc_id = x.doc_id AND y.a < x.b AND y.b > x.a)
), scoped AS (
  SELECT x.doc_id, x.kind, x.a, x.b, x.named, x.inside, coalesce(max(e) FILTER (e <= x.a), 0) AS low, min(e) FILTER (e > x.a) AS high
  FROM free x LEFT JOIN breaks USING (doc_id) WHERE x.kind NOT IN ({_BASE}) GROUP BY ALL
), supported AS (
  SELECT DISTINCT w.doc_id, w.kind, w.a, w.b FROM scoped w JOIN free s ON s.doc_id = w.doc_id AND ({_NEEDS})
  WHERE s.b >= greatest(w.a - {secrets.REACH}, w.low + 1) AND s.a <= least(w.b + {secrets.REACH}, coalesce(w.high - 1, w.b + {secrets.REACH}))
    AND NOT s.named AND NOT (w.named AND s.kind IN ('account', 'endpoint')) AND NOT (w.inside AND s.kind = 'endpoint')
), reported AS (SELECT * FROM base UNION ALL SELECT * FROM supported
), texts AS (
  SELECT doc_id, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, {_ORDER}, b) AS spans,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, {_ORDER}, b) FILTER (kind IN ({_BASE})) AS own,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex
  FROM reported GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (doc_id)
"""

_TEMPLATES = ", ".join(f"({i}, '{n}', '{_quoted(t)}')" for i, (n, t) in enumerate(licenses.TEMPLATES))

LICENSES = rf"""
WITH files AS (
  SELECT 'pages' AS origin, page_id AS row_id,
    'web/' || regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS path, 
    regexp_replace(regexp_replace(html, '{licenses.BLOCK_TAGS}', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS body
  FROM pages
  UNION ALL
  SELECT 'documents', doc_id, concat_ws('/', 'corpus', source, lang, CAST(doc_id AS VARCHAR)), text FROM documents
), named AS (
  SELECT origin, row_id, path, coalesce(body, '') AS body, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir,
    coalesce(string_split(path, '/')[-1], '-') AS name FROM files
), told AS (
  SELECT *, regexp_matches(name, '{licenses.LICENSE_NAME}') AS called, string_split(replace(body, chr(13), ''), chr(10)) AS lines FROM named
), parted AS (
  SELECT * EXCLUDE (lines), string_split_regex(array_to_string(list_transform(lines, lambda x, i: CASE
      WHEN regexp_matches(x, '{licenses.BLANK}') THEN ''
      WHEN regexp_matches(x, '{licenses.COMMENT}') <> (i > 1 AND regexp_matches(lines[i - 1], '{licenses.COMMENT}')) THEN chr(10) || x
      ELSE x END), chr(10)), '\n\n+') AS blocks
  FROM told WHERE called OR regexp_matches(body, '{licenses.CUE}')
), noticed AS (
  SELECT origin, row_id, path, dir, name, body, called, array_to_string(list_filter(blocks, lambda x: called OR regexp_matches(x, '{licenses.CUE}')), chr(10) || chr(10)) AS raw
  FROM parted UNION ALL
  SELECT origin, row_id, path, dir, name, body, called, NULL FROM told WHERE NOT (called OR regexp_matches(body, '{licenses.CUE}'))
), found AS (
  SELECT * EXCLUDE (raw), CASE WHEN length(trim(raw)) > 0 THEN raw END AS notice FROM noticed
), marked AS (
  SELECT origin, row_id, path, dir, notice, notice IS NOT NULL AND (called
    OR regexp_matches(name, '{licenses.INDEX_NAME}') OR len(regexp_extract_all(lower(array_to_string(
      list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{licenses.CUE}')), chr(10))), '{licenses.TERM}'))
    >= {licenses.SHARE} * len(regexp_extract_all(lower(body), '{licenses.TERM}'))) AS declares FROM found
), texts AS (SELECT notice, count(*) AS files FROM marked WHERE notice IS NOT NULL GROUP BY notice
), parts AS (
  SELECT notice, 0 AS stage, notice AS part FROM texts UNION
  SELECT notice, 0, array_to_string(list_filter(string_split(notice, chr(10)), lambda x: regexp_matches(x, '{licenses.CUE}')), chr(10)) FROM texts UNION
  SELECT notice, 1, unnest(list_filter(string_split(notice, chr(10) || chr(10)), lambda x: regexp_matches(x, '{licenses.CUE}'))) FROM texts
), templates AS (SELECT * FROM (VALUES {_TEMPLATES}) t(template, license, notice)
), of_notice AS (
  SELECT notice, term, count(*) AS tf FROM (SELECT notice, unnest(regexp_extract_all(lower(notice), '{licenses.TERM}')) AS term FROM texts) GROUP BY ALL
), of_template AS (
  SELECT template, term, count(*) AS tf FROM (SELECT template, unnest(regexp_extract_all(lower(notice), '{licenses.TERM}')) AS term FROM templates) GROUP BY ALL
), frequency AS (
  SELECT term, sum(n) AS df FROM (SELECT term, files AS n FROM of_notice JOIN texts USING (notice) UNION ALL SELECT term, 1 FROM of_template) GROUP BY term
), idf AS (
  SELECT term, ln((1 + (SELECT coalesce(sum(files), 0) + {len(licenses.TEMPLATES)} FROM texts)) / (1 + df)) + 1 AS idf FROM frequency
), of_part AS (
  SELECT part, term, count(*) AS tf
  FROM (SELECT part, unnest(regexp_extract_all(lower(part), '{licenses.TERM}')) AS term FROM (SELECT DISTINCT part FROM parts)) GROUP BY ALL
), w AS (SELECT part, term, tf * idf AS w FROM of_part JOIN idf USING (term)
), v AS (SELECT template, term, tf * idf AS v FROM of_template JOIN idf USING (term)
), wn AS (SELECT part, sqrt(sum(w * w)) AS wn FROM w GROUP BY part
), vn AS (SELECT template, sqrt(sum(v * v)) AS vn FROM v GROUP BY template
), dots AS (SELECT part, template, sum(w * v) AS dot FROM w JOIN v USING (term) GROUP BY part, template
), scored AS (
  SELECT dots.part, license, round(dot / (wn * vn), 6) AS similarity FROM dots JOIN wn USING (part) JOIN vn USING (template) JOIN templates USING (template)
), near AS (
  SELECT notice, license, similarity FROM parts JOIN scored USING (part) WHERE similarity >= {licenses.SIMILAR}
  QUALIFY row_number() OVER (PARTITION BY notice ORDER BY stage, similarity DESC, license) = 1
), own AS (SELECT marked.*, license, similarity FROM marked LEFT JOIN near USING (notice)
), declared AS (SELECT dir AS spot, min(license) AS low, max(license) AS high FROM own WHERE declares AND license IS NOT NULL AND dir IS NOT NULL GROUP BY dir
), dirs AS (SELECT DISTINCT dir FROM marked WHERE dir IS NOT NULL
), steps AS (SELECT dir, string_split(dir, '/') AS s, unnest(range(1, len(string_split(dir, '/')) + 1)) AS n FROM dirs
), nearest AS (
  SELECT dir, spot, low, high FROM steps JOIN declared ON array_to_string(s[1:n], '/') = spot QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC) = 1
)
SELECT origin, row_id, path, CASE WHEN license IS NOT NULL THEN license WHEN low = high THEN low END AS license, similarity,
  CASE WHEN license IS NOT NULL THEN 'own' WHEN spot IS NULL THEN 'none' WHEN low <> high THEN 'conflict' ELSE 'inherited' END AS status,
  CASE WHEN license IS NULL THEN spot END AS declared_in
FROM own LEFT JOIN nearest USING (dir)
"""

MERKLE = """
WITH RECURSIVE
parts AS (
  SELECT doc_id, n_chars, coalesce('=' || lang, '-') AS tree,
    coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda r, i: xor(r >> 1, (r & 1) * 3988292384::BIGINT)))) % 7 = 0 AS drilled
  FROM documents
),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN drilled AND n_chars IS NOT NULL
      THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS changed
  FROM parts
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
),
nodes AS (
  SELECT 0 AS level, tree, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, tree, pos // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 2
),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
tops AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 2
),
low AS (
  SELECT doc_id, tree, leaf, pos AS leaf_pos, 0 AS level, pos, n, '' AS siblings, coalesce(changed, leaf) AS folded FROM placed
  UNION ALL
  SELECT l.doc_id, l.tree, l.leaf, l.leaf_pos, l.level + 1, l.pos // 2, (l.n + 1) // 2, l.siblings || coalesce(s.digest, ''),
    sha256(CASE WHEN s.digest IS NULL THEN l.folded WHEN l.pos % 2 = 0 THEN l.folded || s.digest ELSE s.digest || l.folded END)
  FROM low l LEFT JOIN nodes s ON s.level = l.level AND s.tree = l.tree AND s.pos = xor(l.pos, 1)
  WHERE l.n > 1
),
high AS (
  SELECT l.doc_id, l.tree, l.leaf, l.leaf_pos, r.subroot, 0 AS level, r.pos, r.n, l.siblings, l.folded
  FROM low l JOIN subroots r USING (tree) WHERE l.n = 1
  UNION ALL
  SELECT l.doc_id, l.tree, l.leaf, l.leaf_pos, l.subroot, l.level + 1, l.pos // 2, (l.n + 1) // 2, l.siblings || coalesce(s.digest, ''),
    sha256(CASE WHEN s.digest IS NULL THEN l.folded WHEN l.pos % 2 = 0 THEN l.folded || s.digest ELSE s.digest || l.folded END)
  FROM high l LEFT JOIN tops s ON s.level = l.level AND s.pos = xor(l.pos, 1)
  WHERE l.n > 1
)
SELECT h.doc_id, h.leaf, h.subroot, t.digest AS root, sha256(h.siblings) AS proof_sha256, h.folded AS folded_root,
  h.folded = t.digest AS verified
FROM high h CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
WHERE h.n = 1
"""

HARD_NEGATIVES = """
WITH taken AS MATERIALIZED (
  SELECT row_number() OVER () AS k, CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), own AS (
  SELECT * FROM taken WHERE len(q) = (SELECT len(q) FROM taken GROUP BY len(q) ORDER BY count(*) DESC, len(q) DESC LIMIT 1)
), scores AS MATERIALIZED (
  SELECT a.k AS anchor, a.id AS anchor_id, v.k, v.id, v.label = a.label AS same, CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM own a JOIN own v ON a.id % 100 = 0 AND v.k <> a.k
), positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.id) AS INTEGER) AS "rank",
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.id) <= 5
"""
