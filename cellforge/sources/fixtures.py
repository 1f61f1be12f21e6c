"""Inputs derived from the driver's tables, in the layouts the loaders read.

Text-line inputs are defined once as SQL that Spark and DuckDB evaluate to identical
rows (integers and strings only); ``{name}`` marks a table.  Spark binds each name to
the table's DataFrame (``spark.sql(text, name=df)``), the oracle reads the plain name.
Every input covers its whole table; the modulo tests only inject empty or odd fields.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellforge.functions.scalars import flat_from_ntz, ntz_to_millis

LINE_SQL = {
    # edge / follow lines: _, a, b[, x]
    "follow_lines": """
select case when o_orderkey%17=0 then concat_ws(chr(9),'a_follows_b',cast(o_custkey as varchar(20)))
  else concat_ws(chr(9),'a_follows_b',
    case when o_orderkey%11=0 then '' else cast(o_custkey as varchar(20)) end,
    case when o_orderkey%13=0 then '' else cast(o_orderkey%1500 as varchar(20)) end,
    case when o_orderkey%5=0 then 'x' else '' end) end as line
from {orders}""",
    # mention lines: _, a, b, code, tweet_id, created_at, _, rel_tw_id
    "atsign_lines": """
select concat_ws(chr(9),'a_atsigns_b',
  case when event_id%19=0 then '' else cast(user_id as varchar(20)) end,
  case when event_id%23=0 then '' else cast((event_id*7)%100 as varchar(20)) end,
  case event_type when 'click' then 're' when 'view' then 'rt' when 'purchase' then 'me'
                  when 'signup' then 'me' else event_type end,
  case when event_id%29=0 then '' else cast(event_id as varchar(20)) end,
  cast(20240101000000+event_id%60 as varchar(20)),'s',
  case when event_id%3=0 then cast(event_id+1 as varchar(20)) else '' end) as line
from {events}""",
    # user table lines: -, custkey, name, segment, nationkey, flag
    "user_lines": """
select case when c_custkey%41=0 then 'twitter_user' else concat_ws(chr(9),'twitter_user',
  case when c_custkey%37=0 then '' else cast(c_custkey as varchar(20)) end, c_name,
  case when c_custkey%4=0 then '' else c_mktsegment end, cast(c_nationkey as varchar(20)),
  case when c_custkey%6=0 then '' else 'z' end) end as line
from {customer}""",
    # generic cell lines: row, family, qualifier, value[, extra]
    "cell_lines": """
select concat_ws(chr(9),cast(s_suppkey as varchar(20)),'base','name',s_name,
  case when s_suppkey%10=0 then 'extra' else '' end) as line from {supplier}
union all
select concat_ws(chr(9),cast(s_suppkey as varchar(20)),'base','nation',
  case when s_suppkey%9=0 then '' else cast(s_nationkey as varchar(20)) end) from {supplier}""",
    # the same with a third of the keys below one long prefix
    "hot_key_counts": """
select case when l_orderkey%3=0 then concat('555',cast(l_orderkey as varchar(20))) else cast(l_orderkey as varchar(20)) end as key,
  count(*) as cnt from {lineitem} group by l_orderkey""",
    # cell lines whose row keys hold an escaped byte
    "byte_key_lines": """
select concat_ws(chr(9),concat(chr(92),'x',substr('0123456789abcdef',cast(floor(o_orderkey%256/16) as int)+1,1),
  substr('0123456789abcdef',cast(o_orderkey%16 as int)+1,1),cast(o_orderkey as varchar(20))),'o','cust',cast(o_custkey as varchar(20))) as line
from {orders}""",
    # (numeric string, count) samples of the order keys
    "key_counts": """
select cast(l_orderkey as varchar(20)) as key, count(*) as cnt from {lineitem} group by l_orderkey""",
}

# Fixed parameters of the user-table loaders.
USER_NAMES = ["-", "custkey", "name", "segment", "nationkey", "flag"]
USER_KEY_INDEX = 1
USER_COMPOSITE_KEY = [1, 4]
USER_FAMILY = "base"
LOAD_TS = 1700000000000  # the "now" of every fixture load, so results are reproducible


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def line_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = LINE_SQL[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in _tables_of(sql)})


def line_sql(name: str) -> str:
    """The same input as plain SQL over the registered views (for the oracle)."""
    return re.sub(r"\{(\w+)\}", r"\1", LINE_SQL[name])


PARTS_A_LINE = 4


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, its key and part keys ascending, tab-joined.  An order's parts are dealt by
    part key to as many lines as it needs for PARTS_A_LINE each, so none is one long line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    sizes = li.groupBy("l_orderkey").agg(F.floor((F.count(F.lit(1)) + PARTS_A_LINE - 1) / PARTS_A_LINE).alias("lines"))
    dealt = li.join(sizes, "l_orderkey").withColumn("dealt", F.col("l_partkey") % F.col("lines"))
    return dealt.groupBy("l_orderkey", "dealt").agg(
        F.concat_ws(
            "\t",
            F.col("l_orderkey").cast("string"),
            F.array_join(F.transform(F.sort_array(F.collect_list("l_partkey")), lambda x: x.cast("string")), "\t"),
        ).alias("line")
    ).select("line")


ADJACENCY_SQL = f"""
select cast(l_orderkey as varchar) || chr(9) || string_agg(cast(l_partkey as varchar), chr(9) order by l_partkey) as line
from lineitem join (select l_orderkey, (count(*)+{PARTS_A_LINE - 1})//{PARTS_A_LINE} as lines from lineitem group by l_orderkey) using (l_orderkey)
group by l_orderkey, l_partkey % lines"""


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned cells from events: row=user, family ev, qualifier=type, value=event id."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("row"),
        F.lit("ev").alias("family"),
        F.col("event_type").alias("qualifier"),
        ntz_to_millis(F.col("ts")).alias("ts"),
        F.col("event_id").cast("string").alias("value"),
    )


def prop_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second family on the same rows: family props, value = the event's props text."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("row"),
        F.lit("props").alias("family"),
        F.col("event_type").alias("qualifier"),
        ntz_to_millis(F.col("ts")).alias("ts"),
        F.col("props").alias("value"),
    )


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both families (``ev`` and ``props``) from one scan of ``events``: each event
    becomes two cells through ``inline``, so the table is read once, not once per family."""
    ev = table(spark, sf_dir, "events")
    row = F.col("user_id").cast("string")
    ts = ntz_to_millis(F.col("ts"))

    def cell(family, value):
        return F.struct(row.alias("row"), F.lit(family).alias("family"), F.col("event_type").alias("qualifier"),
                        ts.alias("ts"), value.alias("value"))

    return ev.select(F.inline(F.array(cell("ev", F.col("event_id").cast("string")), cell("props", F.col("props")))))


PROP_CELLS_SQL = """
select cast(user_id as varchar) as row, 'props' as family, event_type as qualifier,
       epoch_us(ts)//1000 as ts, props as value
from events"""


EVENT_CELLS_SQL = """
select cast(user_id as varchar) as row, 'ev' as family, event_type as qualifier,
       epoch_us(ts)//1000 as ts, cast(event_id as varchar) as value
from events"""


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows: key (NULL for every 11th part), name, brand (NULL for every 7th),
    size, and a stamp (text; not an integer for every 13th part)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.when(k % 11 == 0, F.lit(None)).otherwise(k).alias("key"),
        F.col("p_name").alias("name"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_size").alias("size"),
        F.when(k % 13 == 0, F.lit("later")).otherwise((k * 1000).cast("string")).alias("stamp"),
    )


PART_ROWS_SQL = """
select case when p_partkey%11=0 then null else p_partkey end as key, p_name as name,
       case when p_partkey%7=0 then null else p_brand end as brand, p_size as size,
       case when p_partkey%13=0 then 'later' else cast(p_partkey*1000 as varchar) end as stamp
from part"""


def flat_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as 14-digit text; ``'0'`` for every 9th order, NULL for every 10th."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    flat = F.when(k % 10 == 0, F.lit(None)).when(k % 9 == 0, F.lit("0")).otherwise(flat_from_ntz("o_orderdate"))
    return o.select(k.alias("o_orderkey"), flat.alias("flat"))


FLAT_DATES_SQL = """
select o_orderkey, case when o_orderkey%10=0 then null when o_orderkey%9=0 then '0'
                        else strftime(o_orderdate, '%Y%m%d%H%M%S') end as flat
from orders"""


def audit_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listed keys per customer: its key and ``2*key+1`` (about half are rows)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(F.explode(F.array(k, k * 2 + 1)).alias("key")).select(F.col("key").cast("string"))


AUDIT_KEYS_SQL = """
select cast(c_custkey as varchar) as key from customer
union all
select cast(c_custkey*2+1 as varchar) as key from customer"""


def indexed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key between the rows of every customer, which is no row, and the customers' keys that
    begin with 7."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    return c.select(F.explode(F.array(F.concat(key, F.lit("x")), F.when(key.startswith("7"), key))).alias("key")).where("key is not null")


INDEXED_KEYS_SQL = """
select cast(c_custkey as varchar) || 'x' as key from customer
union all
select cast(c_custkey as varchar) from customer where cast(c_custkey as varchar) like '7%'"""


LINES_A_TASK = 500_000


def line_item_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of very different width: a row for each return flag, and one for each order.  A line
    becomes two cells, so lines are dealt out first: the cells of a task don't go by the file's splits."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // LINES_A_TASK))
    place = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    cell = lambda row, family: F.struct(row.alias("row"), F.lit(family).alias("family"))
    both = F.array(cell(F.concat(F.lit("flag-"), F.col("l_returnflag")), "li"), cell(F.col("l_orderkey").cast("string"), "li"))
    return li.repartition(parts, *li.columns).select(
        F.inline(both), place.alias("qualifier"), F.lit(LOAD_TS).cast("bigint").alias("ts"), F.col("l_partkey").cast("string").alias("value")
    )


LINE_ITEM_CELLS_SQL = """
select 'flag-' || l_returnflag as row, l_orderkey || '-' || l_linenumber as qualifier, cast(l_partkey as varchar) as value from lineitem
union all
select cast(l_orderkey as varchar), l_orderkey || '-' || l_linenumber, cast(l_partkey as varchar) from lineitem"""


def audit_key_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line`` and its order ``custkey, i``: the listed keys of each customer, with a blank
    line after one that ends in 7.  In this order, not in key order."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def lines(key):
        padded = F.concat(F.lit(" "), key.cast("string"), F.lit("\t"))
        return F.array(padded, F.when(key % 10 == 7, F.lit("  ")))

    listed = c.select(k.alias("custkey"), F.posexplode(F.concat(lines(k), lines(k * 2 + 1))).alias("i", "line"))
    return listed.where("line is not null")


AUDIT_KEY_LINES_SQL = """
select c_custkey as custkey, 0 as i, cast(c_custkey as varchar) as key from customer
union all
select c_custkey, 1, '' from customer where c_custkey%10=7
union all
select c_custkey, 2, cast(c_custkey*2+1 as varchar) from customer
union all
select c_custkey, 3, '' from customer where (c_custkey*2+1)%10=7"""


def typed_tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name<TAB>nationkey`` lines; the number is ``bad`` for every 5th customer, and every
    25th also has a blank line, the one after it a line of one tab."""
    c = table(spark, sf_dir, "customer")
    num = F.when(F.col("c_custkey") % 5 == 0, F.lit("bad")).otherwise(F.col("c_nationkey").cast("string"))
    blank = c.where("c_custkey % 25 = 0").select(F.lit("").alias("line"))
    tabs = c.where("c_custkey % 25 = 1").select(F.lit("\t").alias("line"))
    return c.select(F.concat_ws("\t", F.col("c_name"), num).alias("line")).unionByName(blank).unionByName(tabs)
