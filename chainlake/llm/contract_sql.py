"""DuckDB SQL that says what the queries of URL filters, Merkle manifest and prefix trie return."""

from __future__ import annotations

# CRC-32 of a string's bytes: its table from its polynomial, then byte by byte.
CRC32 = """
crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS bytes(n)))"""


def crc32(text: str) -> str:
    """Of an ASCII text; `t` is the table."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"


def judged_sql(pages: str, rules: list[tuple[str, str, str]]) -> str:
    """Of `rules` (verdict, host, path). Canonical links count where they are absolute and quoted, which tells nothing else apart in the given tables."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rest = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) END"
    host = lambda u: f"coalesce({lower.format(f"regexp_extract({rest.format(u)}, '^[^/?#]*')")}, '')"
    path = lambda u: f"coalesce(regexp_extract({rest.format(u)}, '^[^/?#]*([^?#]*)', 1), '')"
    plain = lambda u: f"CASE WHEN {host(u)} <> '' THEN {lower.format(f"split_part({u}, '://', 1)")} || '://' || {host(u)} || regexp_extract({rest.format(u)}, '^[^/?#]*([^#]*)', 1) END"
    asked = r"list_filter(string_split(regexp_extract({0}, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[a-z]+|gclid|fbclid|ref)(=|$)'))"
    moved = lambda u: (
        f"'https://' || regexp_replace({host(u)}, '^(?:www|m)\\.([^.]+\\.)', '\\1') || regexp_replace({path(u)}, '(?:/index)?(?:\\.html?|\\.php)?/*$', '')"
        f" || CASE WHEN len({asked.format(u)}) > 0 THEN '?' || array_to_string({asked.format(u)}, '&') ELSE '' END"
    )
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (VALUES {values}),
urls AS (SELECT page_id, url, {host('url')} AS host, {path('url')} AS path, {plain('url')} AS node, html FROM {pages}),
declared AS (
  SELECT node AS a, {plain('link')} AS b FROM (
    SELECT node, unnest(regexp_extract_all(html, '<link rel="canonical" href="(https?://[^"]*)"', 1)) AS link FROM urls)),
named AS (SELECT node FROM urls UNION SELECT b FROM declared),
edges AS (SELECT a, b FROM declared UNION SELECT node, {moved('node')} FROM named),
both_ways AS (SELECT a, b FROM edges WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM edges WHERE a IS NOT NULL AND b IS NOT NULL),
places AS (SELECT DISTINCT {host('a')} AS host, {path('a')} AS path FROM both_ways UNION SELECT host, path FROM urls),
fits AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path),
tainted(node) AS (
  SELECT DISTINCT a FROM both_ways JOIN fits ON fits.host = {host('a')} AND fits.path = {path('a')} WHERE fits.verdict = 'block'
  UNION SELECT b FROM tainted JOIN both_ways ON a = node)
SELECT page_id, url, u.host, u.path, f.rule,
  coalesce(f.verdict, CASE WHEN node IN (SELECT node FROM tainted) THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN f.rule IS NOT NULL THEN 'rule' WHEN node IN (SELECT node FROM tainted) THEN 'alias' ELSE 'default' END AS reason
FROM urls u LEFT JOIN fits f ON f.host = u.host AND f.path = u.path"""


def manifest_sql(documents: str) -> str:
    part = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(map(part, ("doc_id", "source", "lang", "n_chars")))
    climb = """
  SELECT tree, level + 1, pos // 8, max(n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {0} WHERE n > 1 GROUP BY tree, level, pos // 8"""
    path = """
  SELECT {1}, own.level, string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < own.pos) AS lefts, string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > own.pos) AS rights
  FROM {2} a JOIN {0} own ON own.tree = a.tree AND own.pos = a.pos // (8 ** own.level)::BIGINT AND own.n > 1
  JOIN {0} b ON b.tree = own.tree AND b.level = own.level AND b.pos // 8 = own.pos // 8 GROUP BY ALL"""
    return f"""
WITH RECURSIVE {CRC32},
hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256({head} || {part('text')}) AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN sha256({head} || {part(lowered)}) END AS changed
  FROM {documents}, crc_table),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes(tree, level, pos, n, digest) AS (SELECT tree, 0, pos, n, leaf FROM leaves UNION ALL {climb.format('nodes')}),
subroots AS MATERIALIZED (
  SELECT tree AS lang_tree, digest, 'top' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(tree, level, pos, n, digest) AS (SELECT tree, 0, pos, n, digest FROM subroots UNION ALL {climb.format('above')}),
low_path AS MATERIALIZED ({path.format('nodes', 'a.leaf, a.doc_id', 'leaves')}),
high_path AS MATERIALIZED ({path.format('above', 'a.lang_tree', 'subroots')}),
steps AS MATERIALIZED (
  SELECT l.doc_id, l.leaf, list({{'lefts': coalesce(lefts, ''), 'rights': coalesce(rights, '')}} ORDER BY part, level) FILTER (part IS NOT NULL) AS path
  FROM leaves l LEFT JOIN (
    SELECT leaf, doc_id, 0 AS part, level, lefts, rights FROM low_path
    UNION ALL SELECT leaf, doc_id, 1, h.level, h.lefts, h.rights FROM leaves JOIN high_path h ON h.lang_tree = leaves.tree) p
  ON p.leaf = l.leaf AND p.doc_id IS NOT DISTINCT FROM l.doc_id GROUP BY l.doc_id, l.leaf),
told AS (
  SELECT l.doc_id, l.leaf, s.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(path, lambda x: x.lefts || x.rights), ''), '')) AS proof_sha256,
    list_reduce(list_prepend({{'lefts': coalesce(l.changed, l.leaf), 'rights': ''}}, coalesce(path, [])), lambda own, x: {{'lefts': sha256(x.lefts || own.lefts || x.rights), 'rights': ''}}).lefts AS folded_root
  FROM leaves l JOIN steps p ON p.leaf = l.leaf AND p.doc_id IS NOT DISTINCT FROM l.doc_id JOIN subroots s ON s.lang_tree = l.tree)
SELECT *, folded_root = root AS verified FROM told"""


def trie_sql(conversations: str) -> str:
    code = "md5(strlen(role) || ':' || role || text)"
    return f"""
WITH RECURSIVE {CRC32},
own AS MATERIALIZED (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {code}) - 1 AS i, {code} AS code, length(text) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {conversations} WHERE conv_id IS NOT NULL)),
convs AS MATERIALIZED (SELECT c, {crc32('c::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT c FROM own), crc_table),
lists AS MATERIALIZED (
  SELECT convs.c, coalesce(list({{'code': code, 'chars': chars}} ORDER BY part, i) FILTER (code IS NOT NULL), []) AS turns FROM convs LEFT JOIN (
    SELECT v.c, 0 AS part, i, code, chars FROM convs v JOIN own o ON o.c = v.c - v.c % 100 AND o.i < v.h
    UNION ALL SELECT v.c, 1, i, code, chars FROM convs v JOIN own o ON o.c = v.c AND o.i >= v.h) t ON t.c = convs.c GROUP BY convs.c),
visits AS MATERIALIZED (
  SELECT c, d AS depth, list_transform(turns[1:d], lambda x: x.code) AS key, CASE WHEN d > 0 THEN turns[d].chars ELSE 0 END AS chars, d = len(turns) AS is_end
  FROM lists, unnest(range(len(turns) + 1)) AS depths(d)),
nodes AS MATERIALIZED (
  SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
  FROM visits GROUP BY key, depth),
family AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.key[1:n.depth] = n.key) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]),
below AS (
  SELECT v.key, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.chars)::BIGINT AS saved_tokens
  FROM family v JOIN family u ON u.depth >= v.depth AND u.key[1:v.depth] = v.key GROUP BY v.key)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM family JOIN below USING (key)"""
