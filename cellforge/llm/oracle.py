"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from cellforge.llm import chat, containment, repeats, reputation
from cellforge.llm.queries import URL_RULES

GAP = r"[\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op1_chat_formatting"] = rf"""
WITH said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))
    + length(role) + {len(chat.OPEN) + len(chat.AFTER_ROLE) + len(chat.CLOSE)} AS chars FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_RULES = sorted(URL_RULES, key=lambda r: (-len(r[1]), r[1]))


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"


def _strength(level: str) -> str:
    return (
        f"(SELECT coalesce(greatest(1 / greatest(coalesce("
        "(sum(n * (k / n - mean) * (k / n - mean)) - sum(mean * (1 - mean))) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0),"
        f" {1 / (reputation.MOST_STRENGTH + 1)!r}) - 1, {reputation.LEAST_STRENGTH}), {reputation.MOST_STRENGTH}) FROM {level} WHERE n > 0)"
    )


_SHRUNK = "n + least(c, known) AS w, (k + least(c, known) * mean) / (n + least(c, known)) AS rate"
_SECOND = ", ".join(f"'{s}'" for s in reputation.SECOND_LEVEL)
ORACLE["op8_url_reputation"] = f"""
WITH bad AS (SELECT doc_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad FROM labels GROUP BY doc_id),
parsed AS (
  SELECT page_id, bad,
    {LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages LEFT JOIN bad ON page_id = doc_id
), labels_of AS (
  SELECT host, count(bad) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k, string_split(host, '.') AS l FROM parsed GROUP BY host
), counts AS (
  SELECT host, n, k, l, CASE WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ({_SECOND}) THEN 2 ELSE 1 END AS s FROM labels_of
), hosts AS (
  SELECT host, n, k, array_to_string(l[-s:], '.') AS suffix, array_to_string(l[-least(s + 1, len(l)):], '.') AS domain FROM counts
), g AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS mean, coalesce(sum(n), 0) + 1.0 AS known FROM hosts),
s1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(mean) AS mean, any_value(known) AS known FROM hosts, g GROUP BY suffix),
s2 AS (SELECT suffix, {_SHRUNK} FROM s1, (SELECT {_strength("s1")} AS c)),
d1 AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k, any_value(mean) AS mean, any_value(known) AS known
  FROM hosts JOIN (SELECT suffix, rate AS mean, w AS known FROM s2) USING (suffix) GROUP BY suffix, domain),
d2 AS (SELECT suffix, domain, {_SHRUNK} FROM d1, (SELECT {_strength("d1")} AS c)),
h1 AS (SELECT host, n, k, mean, known FROM hosts JOIN (SELECT suffix, domain, rate AS mean, w AS known FROM d2) USING (suffix, domain)),
h2 AS (SELECT host, {_SHRUNK} FROM h1, (SELECT {_strength("h1")} AS c))
SELECT page_id, host, path,
  CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in _RULES)} END AS rule,
  CASE {" ".join(f"WHEN {_fits(r)} THEN '{v}'" for v, r in _RULES)}
    WHEN greatest(rate - {reputation.Z} * sqrt(rate * (1 - rate) / (w + 1)), 0) > {reputation.BAD_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  rate AS bad_rate
FROM parsed JOIN h2 USING (host)
"""


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({LOWER.format(text)}, '{GAP}'), lambda x: x <> '')"


def _shingles(width: str) -> str:
    return f"list_transform(range(1, CAST(len(w) - {width} + 2 AS BIGINT)), lambda i: array_to_string(w[i:i + {width} - 1], ' '))"


ORACLE["op9_benchmark_containment"] = f"""
WITH b AS (SELECT DISTINCT item_id, {_words("text")} AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, w, least(len(w), {containment.SHINGLE}) AS width, list_distinct({_shingles(f"least(len(w), {containment.SHINGLE})")}) AS s
  FROM b WHERE len(w) > 0),
q AS (SELECT item_id, w, width, len(s) AS q, unnest(s) AS shingle FROM i),
d AS (SELECT doc_id, text, {_words("text")} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, hash(text) AS t, width, unnest({_shingles("width")}) AS shingle
  FROM d, (SELECT DISTINCT width FROM i) WHERE len(w) >= width),
f AS (SELECT doc_id, t, item_id, q.w, any_value(q) AS q, count(*) AS n FROM ds JOIN q USING (width, shingle) GROUP BY doc_id, t, item_id, q.w)
SELECT DISTINCT doc_id, item_id, q AS n_shingles, n AS n_found, n / q AS containment
FROM f WHERE n >= greatest(CAST(ceil({containment.SHARE} * q - 1e-9) AS BIGINT), 1)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
#: CRC-32 of a number's decimal digits, a byte and a bit at a time (the polynomial is a fixed value).
_CRC = (
    "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),"
    " lambda c, x: list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, CAST(3988292384 AS BIGINT)) ELSE r >> 1 END, xor(c, x)),"
    " CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"
)


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> str:
    """From ``{name}0`` (s, pos, n, digest): the nodes above, and each node's siblings."""
    out = []
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT s, pos // 3 AS pos, any_value((n + 2) // 3) AS n, CASE WHEN any_value(n) > 1 THEN"
            f" sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest FROM {name}{k} GROUP BY s, pos // 3)"
        )
        out.append(
            f"{name}_sides{k} AS MATERIALIZED (SELECT a.s, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,"
            f" coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r"
            f" FROM {name}{k} a JOIN {name}{k} b ON a.s = b.s AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.s, a.pos)"
        )
    return ",\n".join(out)


def _fold(source: str, name: str, levels: int, pos: str, s: str) -> str:
    """Steps that extend ``proof`` and fold ``found`` with the siblings of each level."""
    out, last = [], source
    for k in range(levels):
        out.append(
            f"{name}_fold{k} AS MATERIALIZED (SELECT f.* EXCLUDE (proof, found), f.proof || coalesce(l, '') || coalesce(r, '') AS proof,"
            f" CASE WHEN l IS NULL THEN found ELSE sha256(l || found || r) END AS found"
            f" FROM {last} f LEFT JOIN {name}_sides{k} x ON x.s = f.{s} AND x.pos = f.{pos} // {3**k})"
        )
        last = f"{name}_fold{k}"
    return ",\n".join(out)


TREE_LEVELS, TOP_LEVELS = 12, 5  # enough for 3**12 rows of a source and 3**5 sources
ORACLE["op12_merkle_manifest"] = f"""
WITH read AS (SELECT *, CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS again FROM documents),
leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS s, {_leaf("text")} AS leaf, {_leaf("again")} AS seen FROM read),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY s) AS n FROM leaves),
t0 AS MATERIALIZED (SELECT s, pos, n, leaf AS digest FROM placed),
{_tree("t", TREE_LEVELS)},
u0 AS MATERIALIZED (SELECT '' AS s, row_number() OVER (ORDER BY encode(s)) - 1 AS pos, count(*) OVER () AS n, digest, s AS member FROM t{TREE_LEVELS}),
{_tree("u", TOP_LEVELS)},
begun AS MATERIALIZED (SELECT doc_id, leaf, p.s, p.pos, '' AS top, u0.pos AS place, u0.digest AS subroot, '' AS proof, seen AS found FROM placed p JOIN u0 ON u0.member = p.s),
{_fold("begun", "t", TREE_LEVELS, "pos", "s")},
{_fold(f"t_fold{TREE_LEVELS - 1}", "u", TOP_LEVELS, "place", "top")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, found AS folded_root, found = root AS verified
FROM u_fold{TOP_LEVELS - 1}, (SELECT digest AS root FROM u{TOP_LEVELS})
"""

#: Strings are compared by their first places; texts are two hex digits a byte.
ORACLE["op13_repeats"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
g AS MATERIALIZED (SELECT doc_id, p, sha256(substr(h, CAST(2 * p + 1 AS BIGINT), 2 * {repeats.LEAST})) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {repeats.LEAST} + 1)) AS p FROM d)),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM g),
r AS MATERIALIZED (SELECT doc_id, p FROM f WHERE k > 1),
b AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER w <= {repeats.LEAST} THEN 0 ELSE 1 END AS head FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
i AS (SELECT doc_id, p, sum(head) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM b),
runs AS MATERIALIZED (SELECT doc_id, run, min(p) AS a, max(p) + {repeats.LEAST} AS z FROM i GROUP BY doc_id, run),
gaps AS (SELECT doc_id, run, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM runs
  UNION ALL SELECT doc_id, 1e9, coalesce(z, 0), length(h) // 2 FROM d LEFT JOIN (SELECT doc_id, max(z) AS z FROM runs GROUP BY doc_id) USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(2 * (y - x) AS BIGINT)), '' ORDER BY x, y) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(z - a) AS n, count(*) AS runs FROM runs GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
