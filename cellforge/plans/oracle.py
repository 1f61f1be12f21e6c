"""Equivalent DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: the Java split, the reject chains, the
latest-version rule, the partitioner's float32 arithmetic and the CDFs are restated in
plain SQL over the driver's tables.
"""

from __future__ import annotations

from cellforge.plans import queries as q
from cellforge.sources import fixtures as fx

TS = fx.LOAD_TS


def split(line: str = "line") -> str:
    """Java ``split("\\t")``: trailing empty fields dropped, tabs-only line -> []."""
    return (
        f"CASE WHEN regexp_matches({line}, '^\\t+$') THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split(regexp_replace({line}, '\\t+$', ''), chr(9)) END"
    )


def _parsed(lines_sql: str) -> str:
    return f"l AS ({lines_sql}), s AS (SELECT {split()} AS f FROM l)"


def _wide(names, key_expr: str, skip: set[int], skip_dash: bool, family: str) -> str:
    parts = []
    for i, name in enumerate(names):
        if i in skip or (skip_dash and name == "-"):
            continue
        v = f"f[{i + 1}]"
        parts.append(
            f"SELECT {key_expr} AS row, '{family}' AS family, '{name}' AS qualifier, {TS} AS ts, {v} AS value "
            f"FROM k WHERE {v} IS NOT NULL AND {v} <> ''"
        )
    return "\nUNION ALL ".join(parts)


def _user_key_filter(indexes) -> str:
    return " AND ".join(f"f[{i + 1}] IS NOT NULL AND f[{i + 1}] <> ''" for i in indexes)


USER = fx.line_sql("user_lines")
FOLLOW = fx.line_sql("follow_lines")
ATSIGN = fx.line_sql("atsign_lines")
CELLS = fx.line_sql("cell_lines")
KEY_COUNTS = fx.line_sql("key_counts")
EVENTS = fx.EVENT_CELLS_SQL
EVENT_TABLE = f"{fx.EVENT_CELLS_SQL} UNION ALL {fx.PROP_CELLS_SQL}"


def _latest(cells_sql: str) -> str:
    return f"""SELECT row, family, qualifier, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY row, family, qualifier ORDER BY ts DESC, value DESC) AS rn
  FROM ({cells_sql})) WHERE rn = 1"""


def _scan_rows(where: str = "TRUE") -> str:
    return f"""SELECT row,
  CASE WHEN max(CASE WHEN family='ev' AND qualifier='click' THEN value END) = '' THEN '1'
       ELSE max(CASE WHEN family='ev' AND qualifier='click' THEN value END) END AS click,
  CASE WHEN max(CASE WHEN family='ev' AND qualifier='view' THEN value END) = '' THEN '1'
       ELSE max(CASE WHEN family='ev' AND qualifier='view' THEN value END) END AS view,
  CASE WHEN max(CASE WHEN family='props' AND qualifier='purchase' THEN value END) = '' THEN '1'
       ELSE max(CASE WHEN family='props' AND qualifier='purchase' THEN value END) END AS purchase
FROM ({_latest(EVENT_TABLE)})
WHERE ((family='ev' AND qualifier IN ('click','view')) OR (family='props' AND qualifier='purchase')) AND {where}
GROUP BY row"""


def _follow_reason() -> str:
    return """CASE WHEN f[2] IS NULL THEN 'BAD_RECORD' WHEN f[2] = '' THEN 'MISSING_A_ID'
            WHEN f[3] IS NULL THEN 'BAD_RECORD' WHEN f[3] = '' THEN 'MISSING_B_ID' END"""


def _mention_reason() -> str:
    return """CASE WHEN f[2] IS NULL THEN 'BAD_RECORD' WHEN f[2] = '' THEN 'MISSING_A_ID'
            WHEN f[3] IS NULL THEN 'BAD_RECORD' WHEN f[3] = '' THEN 'MISSING_B_ID'
            WHEN f[4] IS NULL THEN 'BAD_RECORD' WHEN f[4] NOT IN ('re','rt','me') THEN 'MISSING_RELATIONSHIP'
            WHEN f[5] IS NULL THEN 'BAD_RECORD' WHEN f[5] = '' THEN 'MISSING_TWEET_ID'
            WHEN f[6] IS NULL THEN 'BAD_RECORD' END"""


def _counts(reasons) -> str:
    rows = [f"SELECT '{r}' AS reason, count(*) FILTER (WHERE reason = '{r}') AS n FROM r" for r in reasons]
    rows.append("SELECT 'BAD_RECORD' AS reason, count(reason) AS n FROM r")
    return "\nUNION ALL ".join(rows)


def _theory(prefix: str) -> str:
    """Benford CDF of a 3-character prefix text; NULL off the grid."""
    return f"CASE WHEN regexp_matches({prefix}, '^[1-9][0-9]{{2}}$') THEN log10(CAST({prefix} AS DOUBLE) / 100.0) END"


def _encode_hex(col: str, kind: str) -> str:
    if kind == "int":
        return f"right(lpad(hex(CAST({col} AS BIGINT)), 16, '0'), 8)"
    if kind == "long":
        return f"lpad(hex(CAST({col} AS BIGINT)), 16, '0')"
    return f"hex({col})"


CODEC_ROWS = f"""SELECT key, name, size, size - 25 AS delta, key * 1000003 - 5000000 AS big, stamp
FROM ({fx.PART_ROWS_SQL})"""

USER_TABLE_CELLS = f"""WITH {_parsed(USER)}, k AS (SELECT f FROM s WHERE {_user_key_filter([fx.USER_KEY_INDEX])})
{_wide(fx.USER_NAMES, "f[2]", set(), True, fx.USER_FAMILY)}"""

ORACLE: dict[str, str] = {
    "tsv_fields": f"""WITH l AS ({FOLLOW})
SELECT line, CAST(len(f) AS INTEGER) AS n_fields, f[1] AS f0, f[2] AS f1, f[3] AS f2, f[4] AS f3
FROM (SELECT line, {split()} AS f FROM l)""",
    "typed_tsv_load": """SELECT c_name AS field_1, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS field_2
FROM customer UNION ALL SELECT NULL, NULL FROM customer WHERE c_custkey % 25 IN (0, 1)""",
    "bulk_cells": f"""WITH {_parsed(CELLS)}
SELECT f[1] AS row, f[2] AS family, f[3] AS qualifier, {TS} AS ts, f[4] AS value
FROM s WHERE len(f) = 4 AND f[1] <> ''""",
    "table_cells": USER_TABLE_CELLS,
    "composite_key_cells": f"""WITH {_parsed(USER)}, k AS (SELECT f FROM s WHERE {_user_key_filter(fx.USER_COMPOSITE_KEY)})
{_wide(fx.USER_NAMES, "f[2] || ':' || f[5]", set(), True, fx.USER_FAMILY)}""",
    "file_cells": f"""WITH {_parsed(USER)}, k AS (SELECT f FROM s WHERE {_user_key_filter([fx.USER_KEY_INDEX])})
{_wide(fx.USER_NAMES, "f[2]", {fx.USER_KEY_INDEX}, False, fx.USER_FAMILY)}""",
    "edge_cells": f"""WITH {_parsed(FOLLOW)}
SELECT f[2] AS row, 'edge' AS family, f[3] AS qualifier, {TS} AS ts, '' AS value
FROM s WHERE len(f) >= 3 AND f[2] <> ''""",
    "adjacency_cells": f"""WITH {_parsed(fx.ADJACENCY_SQL)}, k AS (SELECT f FROM s WHERE f[1] IS NOT NULL AND f[1] <> '')
SELECT f[1] AS row, 'adj' AS family, unnest(list_slice(f, 2, len(f))) AS qualifier, {TS} AS ts, '' AS value
FROM k""",
    "follow_cells": f"""WITH {_parsed(FOLLOW)}, a AS (SELECT f FROM s WHERE ({_follow_reason()}) IS NULL)
SELECT f[2] || ':' || f[3] AS row, 'follow' AS family, 'ab' AS qualifier, {TS} AS ts, '' AS value FROM a
UNION ALL
SELECT f[3] || ':' || f[2] AS row, 'follow' AS family, 'ba' AS qualifier, {TS} AS ts, '' AS value FROM a""",
    "follow_rejects": f"""WITH {_parsed(FOLLOW)}, r AS (SELECT {_follow_reason()} AS reason FROM s)
{_counts(["MISSING_A_ID", "MISSING_B_ID"])}""",
    "mention_cells": f"""WITH {_parsed(ATSIGN)}, a AS (SELECT f FROM s WHERE ({_mention_reason()}) IS NULL)
SELECT f[2] || ':' || f[3] AS row,
       CASE f[4] WHEN 're' THEN 'reply' WHEN 'rt' THEN 'retweet' WHEN 'me' THEN 'mention' END AS family,
       f[5] AS qualifier, {TS} AS ts,
       '{{"created_at":' || CAST(to_json(f[6]) AS VARCHAR)
         || CASE WHEN len(f) > 7 THEN ',"rel_tw_id":' || CAST(to_json(f[8]) AS VARCHAR) ELSE '' END || '}}' AS value
FROM a""",
    "mention_rejects": f"""WITH {_parsed(ATSIGN)}, r AS (SELECT {_mention_reason()} AS reason FROM s)
{_counts(["MISSING_A_ID", "MISSING_B_ID", "MISSING_RELATIONSHIP", "MISSING_TWEET_ID"])}""",
    "store_row_cells": f"""WITH p AS ({fx.PART_ROWS_SQL}),
t AS (SELECT *, CASE WHEN regexp_matches(stamp, '^[+-]?[0-9]+$') THEN TRY_CAST(stamp AS BIGINT) END AS st FROM p),
k AS (SELECT *, COALESCE(st, {TS}) AS cts FROM t WHERE key IS NOT NULL)
SELECT CAST(key AS VARCHAR) AS row, 'p' AS family, 'name' AS qualifier, cts AS ts, name AS value FROM k WHERE name IS NOT NULL
UNION ALL SELECT CAST(key AS VARCHAR), 'p', 'brand', cts, brand FROM k WHERE brand IS NOT NULL
UNION ALL SELECT CAST(key AS VARCHAR), 'p', 'size', cts, CAST(size AS VARCHAR) FROM k WHERE size IS NOT NULL
UNION ALL SELECT CAST(key AS VARCHAR), 'p', 'stamp', cts, stamp FROM k WHERE stamp IS NOT NULL""",
    "store_dynamic_cells": f"""WITH p AS ({fx.PART_ROWS_SQL})
SELECT CAST(key AS VARCHAR) AS row, 'attr' AS family, 'brand' AS qualifier, key * 1000 AS ts, brand AS value
FROM p WHERE key IS NOT NULL AND brand IS NOT NULL""",
    "store_bag_cells": f"""WITH p AS ({fx.PART_ROWS_SQL}), k AS (SELECT * FROM p WHERE key IS NOT NULL AND name IS NOT NULL AND brand IS NOT NULL)
SELECT CAST(key AS VARCHAR) AS row, 'bag' AS family, 'name' AS qualifier, {TS} AS ts, name AS value FROM k
UNION ALL SELECT CAST(key AS VARCHAR), 'bag', 'brand', {TS}, brand FROM k""",
    "encode_values": f"""WITH k AS (SELECT * FROM ({CODEC_ROWS}) WHERE key IS NOT NULL)
SELECT CAST(key AS VARCHAR) AS row, 'b' AS family, 'name' AS qualifier, {TS} AS ts, {_encode_hex("name", "str")} AS value_hex FROM k WHERE name IS NOT NULL
UNION ALL SELECT CAST(key AS VARCHAR), 'b', 'size', {TS}, {_encode_hex("size", "int")} FROM k WHERE size IS NOT NULL
UNION ALL SELECT CAST(key AS VARCHAR), 'b', 'delta', {TS}, {_encode_hex("delta", "int")} FROM k WHERE delta IS NOT NULL
UNION ALL SELECT CAST(key AS VARCHAR), 'b', 'big', {TS}, {_encode_hex("big", "long")} FROM k WHERE big IS NOT NULL""",
    "decode_values": f"""SELECT CAST(key AS VARCHAR) AS row, name, size, delta, big,
       CASE WHEN regexp_matches(trim(stamp), '^[+-]?[0-9]+$') THEN TRY_CAST(stamp AS BIGINT) END AS stamp_num
FROM ({CODEC_ROWS}) WHERE key IS NOT NULL""",
    "latest_cells": _latest(EVENTS),
    "scan_columns": _scan_rows(),
    "scan_family": f"SELECT row, family, qualifier, value FROM ({_latest(EVENT_TABLE)}) WHERE family = 'ev'",
    "scan_range": _scan_rows("row >= '12' AND row < '5'"),
    "scan_region_limit": f"""SELECT row, click, view, purchase, region FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY row) AS rn FROM (
    SELECT *, CAST((row >= '2') AS INTEGER) + CAST((row >= '5') AS INTEGER) + CAST((row >= '8') AS INTEGER) AS region
    FROM ({_scan_rows()})))
WHERE rn <= {q.REGION_LIMIT}""",
    "upsert_cells": _latest(EVENT_TABLE),
    "merged_delta_cells": _latest(EVENT_TABLE),
    "sorted_cells": f"SELECT row, family, qualifier, ts, max(value) AS value FROM ({EVENT_TABLE}) GROUP BY row, family, qualifier, ts",
    "scan_region_files": f"""SELECT key AS row, 'k' AS family, 'n' AS qualifier, {TS} AS ts, CAST(cnt AS VARCHAR) AS value
FROM ({KEY_COUNTS}) WHERE key >= '{q.REGION_SCAN[0]}' AND key < '{q.REGION_SCAN[1]}'""",
    "sampled_cdf": f"""WITH kc AS ({KEY_COUNTS}),
m AS (SELECT greatest(COALESCE(TRY_CAST(NULLIF(regexp_extract(substr(key, 1, 3), '^\\s*([+-]?\\d+)', 1), '') AS INTEGER), 0), 100) AS prefix,
             sum(COALESCE(TRY_CAST(cnt AS DOUBLE), 0.0)) AS n
      FROM kc GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS prefix FROM range(100, 1000)),
j AS (SELECT g.prefix, COALESCE(m.n, 0.0) AS n FROM g LEFT JOIN m ON g.prefix = m.prefix)
SELECT prefix, n,
       COALESCE(sum(n) OVER (ORDER BY prefix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) / sum(n) OVER () AS cdf
FROM j""",
    "benford_cdf": f"""WITH kc AS ({KEY_COUNTS}),
o AS (SELECT CAST(substr(key, 1, 3) AS INTEGER) AS prefix, count(*) AS keys FROM kc
      WHERE regexp_matches(substr(key, 1, 3), '^[1-9][0-9]{{2}}$') GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS prefix FROM range(100, 1000))
SELECT g.prefix, round(log10(g.prefix / 100.0), 7) AS cdf, COALESCE(o.keys, 0) AS keys
FROM g LEFT JOIN o ON g.prefix = o.prefix
UNION ALL SELECT NULL, NULL, n FROM (SELECT count(*) AS n FROM kc WHERE NOT regexp_matches(substr(key, 1, 3), '^[1-9][0-9]{{2}}$')) WHERE n > 0""",
    "assign_partition": f"""WITH kc AS ({KEY_COUNTS}), c AS (SELECT key, cnt, {_theory("substr(key, 1, 3)")} AS cdf FROM kc)
SELECT key, cnt,
  CASE WHEN strlen(key) < 4 THEN 0 WHEN cdf IS NULL THEN 0
       ELSE least(CAST(trunc(CAST(round(cdf, 7) AS FLOAT) * CAST({q.PARTITIONS} AS FLOAT)) AS INTEGER), {q.PARTITIONS - 1}) END AS partition
FROM c""",
    "partition_histogram": f"""WITH kc AS ({KEY_COUNTS}), c AS (SELECT {_theory("substr(key, 1, 3)")} AS cdf FROM kc)
SELECT CAST(trunc(round(cdf, 7) * {float(q.HISTOGRAM_BINS)}) AS INTEGER) AS bin, count(*) AS n FROM c GROUP BY 1""",
    "lookup_audit": f"""WITH keys AS ({fx.AUDIT_KEYS_SQL}), rows AS (SELECT DISTINCT row FROM ({USER_TABLE_CELLS}))
SELECT row_number() OVER (ORDER BY key) AS n, key, CASE WHEN r.row IS NULL THEN 1 ELSE 0 END AS missed
FROM keys LEFT JOIN rows r ON keys.key = r.row""",
    "row_json": f"""SELECT key, '{{' || concat_ws(',',
    '"name":' || CAST(to_json(name) AS VARCHAR),
    '"brand":' || CAST(to_json(brand) AS VARCHAR),
    '"size":' || CAST(size AS VARCHAR)) || '}}' AS json
FROM ({fx.PART_ROWS_SQL})""",
    "flat_ts_millis": f"""SELECT o_orderkey, flat, epoch_ms(try_strptime(NULLIF(flat, '0'), '%Y%m%d%H%M%S')) AS millis
FROM ({fx.FLAT_DATES_SQL})""",
}



def _ieee(v: str, bits: int, bias: int, digits: int) -> str:
    """Hex of a number's sign, exponent and fraction; scaling by powers of two is exact."""
    e = f"CAST(floor(log2(abs({v}))) AS INTEGER)"
    whole = f"CAST(CASE WHEN {v} < 0 THEN 1 ELSE 0 END AS HUGEINT) * pow2({digits * 4 - 1}) + CAST({e} + {bias} AS HUGEINT) * pow2({bits})"
    fraction = f"CAST((abs({v}) / power(2.0, {e}) - 1) * power(2.0, {bits}) AS HUGEINT)"
    whole = whole.replace(f"pow2({digits * 4 - 1})", str(1 << (digits * 4 - 1))).replace(f"pow2({bits})", str(1 << bits))
    return f"printf('%0{digits}X', CAST({whole} + {fraction} AS UBIGINT))"


ORACLE |= {
    "loaded_sorted_files": f"""SELECT count(*) AS cells, CAST(0 AS BIGINT) AS overlaps, CAST(0 AS BIGINT) AS breaks
FROM (SELECT DISTINCT row, family, qualifier, ts FROM ({ORACLE["follow_cells"]}))""",
    "collapsed_cells": f"""SELECT CAST(l_orderkey AS VARCHAR) AS row, 'l' AS family, l_returnflag AS qualifier, {TS} AS ts,
  max(CAST(l_linenumber AS VARCHAR)) AS value FROM lineitem GROUP BY 1, 2, 3""",
    "float_values": f"""WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS row, p_partkey % 7 = 0 AS odd, -p_retailprice AS d,
  CAST(CAST(-p_retailprice AS FLOAT) AS DOUBLE) AS f FROM part WHERE p_partkey % 11 > 0)
SELECT row, CASE WHEN odd THEN '7FF8000000000000' ELSE {_ieee("d", 52, 1023, 16)} END AS d_hex,
  CASE WHEN odd THEN '7FC00000' ELSE {_ieee("f", 23, 127, 8)} END AS f_hex, TRUE AS same FROM p""",
    "dynamic_columns": f"""SELECT CAST(p_partkey AS VARCHAR) AS row, p_brand AS family, 'q.' || p_size AS qualifier, {TS} AS ts, p_name AS value
FROM part WHERE p_size % 9 > 0 AND p_size % 7 > 0""",
    "sampled_partition": f"""WITH c AS ({ORACLE["sampled_cdf"]}), kc AS ({KEY_COUNTS})
SELECT key, cnt, CASE WHEN strlen(key) < 4 OR cdf IS NULL THEN 0
  ELSE least(CAST(trunc(CAST(round(cdf, 7) AS FLOAT) * CAST({q.PARTITIONS} AS FLOAT)) AS INTEGER), {q.PARTITIONS - 1}) END AS partition
FROM kc LEFT JOIN c ON substr(key, 1, 3) = CAST(prefix AS VARCHAR)""",
    "audit_key_file": f"""WITH listed AS (SELECT key, row_number() OVER (ORDER BY custkey, i) AS place FROM ({fx.AUDIT_KEY_LINES_SQL})),
rows AS (SELECT DISTINCT row FROM ({USER_TABLE_CELLS}))
SELECT row_number() OVER (ORDER BY key) AS n, key, CASE WHEN r.row IS NULL THEN 1 ELSE 0 END AS missed
FROM listed LEFT JOIN rows r ON listed.key = r.row WHERE place > {q.AUDIT_OFFSET} AND place <= {q.AUDIT_OFFSET + q.AUDIT_LIMIT}""",
    "audit_key_list": f"""WITH listed AS (SELECT key, row_number() OVER (ORDER BY custkey, i) AS place FROM ({fx.AUDIT_KEY_LINES_SQL})),
rows AS (SELECT DISTINCT row FROM ({USER_TABLE_CELLS}))
SELECT row_number() OVER (ORDER BY key, place) AS n, key, place,
  CASE WHEN place > {q.AUDIT_OFFSET} AND place <= {q.AUDIT_OFFSET + q.AUDIT_LIMIT} THEN 1 ELSE 0 END AS in_window,
  CASE WHEN r.row IS NULL THEN 1 ELSE 0 END AS missed FROM listed LEFT JOIN rows r ON listed.key = r.row""",
    "placed_partition_rows": "",
    "sampled_cdf_file": ORACLE["sampled_cdf"],
    "scan_bounds": f"""SELECT * FROM ({ORACLE["scan_columns"]}) WHERE row > '11' AND row >= '110' AND row < '7' AND row <= '65'""",
    "scan_empty_cells": """SELECT CAST(p_partkey AS VARCHAR) AS row, CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE p_brand END AS dotted,
  CASE WHEN p_partkey % 4 = 0 THEN '1' ELSE CAST(p_size AS VARCHAR) END AS named_row,
  CASE WHEN p_partkey % 4 = 0 THEN '1' ELSE CAST(p_size AS VARCHAR) END AS again FROM part""",
}
ORACLE["placed_partition_rows"] = f"""SELECT partition, count(*) AS n, CAST(0 AS BIGINT) AS misplaced
FROM (SELECT DISTINCT key, partition FROM ({ORACLE["sampled_partition"]})) GROUP BY partition"""

HOT_COUNTS = fx.line_sql("hot_key_counts")
_BATCH = f"row >= '{q.BATCH_ROWS[0]}' AND row < '{q.BATCH_ROWS[1]}'"
ORACLE |= {
    "touched_region_upsert": f"""WITH ev AS ({EVENT_TABLE})
SELECT row, family, qualifier, ts, value, CASE WHEN {_BATCH} THEN 1 ELSE 0 END AS file_version
FROM ({_latest(f"SELECT * FROM ev WHERE ts < {q.UPSERT_CUTOFF_MS} OR ({_BATCH})")})""",
    "indexed_audit": f"""WITH keys AS ({fx.INDEXED_KEYS_SQL}), rows AS (SELECT DISTINCT row FROM ({USER_TABLE_CELLS}))
SELECT row_number() OVER (ORDER BY key) AS n, key, CASE WHEN r.row IS NULL THEN 1 ELSE 0 END AS missed, TRUE AS skipped
FROM keys LEFT JOIN rows r ON keys.key = r.row""",
    "early_region_limit": f"SELECT *, TRUE AS bounded FROM ({ORACLE['scan_region_limit']})",
    "byte_key_range": f"""WITH l AS (SELECT unhex(printf('%02X', o_orderkey % 256)) || encode(CAST(o_orderkey AS VARCHAR)) AS key, o_custkey FROM orders)
SELECT hex(key) AS row_hex, 'o' AS family, 'cust' AS qualifier, {TS} AS ts, CAST(o_custkey AS VARCHAR) AS value
FROM l WHERE key >= '\\x80'::BLOB AND key < '\\xFF'::BLOB""",
    "merged_run_cells": _latest(EVENT_TABLE),
    "hot_region_files": f"""SELECT key AS row, 'k' AS family, 'n' AS qualifier, {TS} AS ts, CAST(cnt AS VARCHAR) AS value, TRUE AS balanced
FROM ({HOT_COUNTS}) WHERE key >= '{q.REGION_SCAN[0]}' AND key < '{q.REGION_SCAN[1]}'""",
    "placed_runs": f"""WITH c AS ({ORACLE["sampled_cdf"]}), kc AS ({HOT_COUNTS}),
p AS (SELECT key, CASE WHEN strlen(key) < 4 OR cdf IS NULL THEN 0
  ELSE least(CAST(trunc(CAST(round(cdf, 7) AS FLOAT) * CAST({q.RUN_PARTITIONS} AS FLOAT)) AS INTEGER), {q.RUN_PARTITIONS - 1}) END AS partition
  FROM kc LEFT JOIN c ON substr(key, 1, 3) = CAST(prefix AS VARCHAR))
SELECT partition, count(*) AS n, CAST(0 AS BIGINT) AS misplaced, TRUE AS balanced FROM p GROUP BY partition""",
    "family_pages": f"""WITH c AS (SELECT *, (row_number() OVER (PARTITION BY row ORDER BY qualifier) - 1) // {q.PAGE} AS page 
  FROM (SELECT row, qualifier, max(value) AS value FROM ({fx.LINE_ITEM_CELLS_SQL}) GROUP BY row, qualifier))
SELECT row, CAST(page AS INTEGER) AS page, count(*) AS n, max(qualifier) AS cursor,
  sha256(string_agg(qualifier || '=' || value, ',' ORDER BY qualifier)) AS bag_sha256 FROM c GROUP BY row, page""",
    "sorted_bag_files": f"SELECT row, count(*) AS n, TRUE AS in_order FROM ({ORACLE['store_bag_cells']}) GROUP BY row",
    "callable_caster": f"""SELECT CAST(key AS VARCHAR) AS row, name, size, reverse(name) AS raw_name, reverse(CAST(size AS VARCHAR)) AS raw_size
FROM ({fx.PART_ROWS_SQL}) WHERE key IS NOT NULL""",
    "sketched_cdf": f"SELECT prefix, n, cdf, TRUE AS within FROM ({ORACLE['sampled_cdf']})",
}
