"""The three feeds derived from the driver tables.

One SQL text per feed; Spark and the oracle both run it. The values exercise the
cleansing rules: negative quantities, lower-case names, every payment method, and
unknown stores, customers, times and lateness.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators.lookup import fits_broadcast

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# A nation plays the store.
POS = """
select cast(l_orderkey as string) as transaction_id,
  case when l_orderkey % 97 = 0 then null else concat('S', cast(n_nationkey as string)) end as store_id,
  n_name as store_name,
  concat('City ', cast(n_nationkey as string)) as store_city,
  r_name as store_region,
  concat('C', cast(l_suppkey as string)) as cashier_id,
  case when l_orderkey % 50 = 0 then null else cast(o_custkey as string) end as customer_id,
  cast(o_orderdate as date) as transaction_date,
  case when l_orderkey % 31 = 0 then null
       else concat('0', cast(l_linenumber as string), ':30:00') end as transaction_time,
  concat('P', cast(l_partkey as string)) as product_sku,
  p_name as product_name,
  lower(p_type) as category,
  p_brand as subcategory,
  case when l_linenumber = 7 then -1 else cast(l_quantity as int) end as quantity,
  cast(p_retailprice as decimal(18,2)) as unit_price,
  cast(round(l_discount * 100) as int) as discount_pct,
  cast(l_extendedprice as decimal(18,2)) as total_amount,
  case when o_orderpriority = '1-URGENT' then 'Credit Card'
       when o_orderpriority = '2-HIGH' then 'DEBIT CARD'
       when o_orderpriority = '3-MEDIUM' then 'cash'
       else 'Mobile' end as payment_method,
  l_linenumber as loyalty_points
from {lineitem} l
  join {orders} o on l_orderkey = o_orderkey
  join {customer} c on o_custkey = c_custkey
  join {nation} n on c_nationkey = n_nationkey
  join {region} r on n_regionkey = r_regionkey
  join {part} p on l_partkey = p_partkey
"""

# First lines are bought in bulk, under a category no till knows, so that some
# sales have no order and some orders no sale.
ERP = """
select concat('PO', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as order_id,
  cast(cast(o_orderdate as date) as string) as order_date,
  concat('S', cast(c_nationkey as string)) as store_id,
  concat('City ', cast(c_nationkey as string)) as store_city,
  concat('V', cast(s_suppkey as string)) as supplier_id,
  s_name as supplier_name,
  concat('City ', cast(s_nationkey as string)) as supplier_city,
  concat('ERP-', cast(l_partkey as string)) as product_sku,
  case when l_linenumber = 1 then concat('bulk ', lower(p_type)) else lower(p_type) end as category,
  cast(l_quantity as bigint) as quantity_ordered,
  cast(case when l_returnflag = 'R' then 0 else l_quantity end as bigint) as quantity_received,
  p_retailprice as unit_cost,
  l_extendedprice as total_cost,
  lower(o_orderstatus) as order_status,
  cast(cast(o_orderdate + interval '30' day as date) as string) as expected_delivery,
  case when l_linestatus = 'O' then null
       else cast(cast(l_shipdate as date) as string) end as actual_delivery,
  concat('W', cast(l_suppkey % 5 as string)) as warehouse_id,
  cast(l_partkey % 45 as bigint) as lead_time_days,
  case when l_linestatus = 'O' then null
       else l_shipdate > o_orderdate + interval '30' day end as is_late
from {lineitem} l
  join {orders} o on l_orderkey = o_orderkey
  join {customer} c on o_custkey = c_custkey
  join {supplier} s on l_suppkey = s_suppkey
  join {part} p on l_partkey = p_partkey
"""

IOT = """
select cast(event_id as string) as event_id,
  event_type,
  concat('S', cast(user_id % 25 as string)) as store_id,
  concat('NATION_', cast(user_id % 25 as string)) as store_name,
  ts as events_ts,
  concat('D', cast(user_id as string)) as device_id,
  concat('{{"metadata":{{"firmware":"1.', cast(user_id % 5 as string),
    '","battery_pct":', cast(event_id % 101 as string),
    ',"signal_rssi":', cast(-(event_id % 90) as string),
    ',"store_floor":', cast(user_id % 3 as string),
    '}},"readings":',
    case when event_id % 20 = 0 then '[]'
         else concat('[{{"sensor":"value","value":', cast(cast(value as decimal(18,4)) as string),
                     ',"unit":"u"}},{{"sensor":"props","value":', cast(event_id % 7 as string),
                     ',"unit":"k"}}]') end,
    '}}') as raw_payload
from {events} e
"""


# Tables the feeds have one row per row of.
LARGE = ("lineitem", "events")

# Lines that one part of a feed joins, and how many parts a feed is cut into at most.
LINES_PER_PART, MOST_PARTS = 1 << 24, 8

_WORD = re.compile(r"\b[lcopsnr]_\w+")


def _spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table with fewer splits than cores.

    The driver writes each table as one small file, which a single task reads; a
    table of many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _spread(df) if name in LARGE else df


def _used(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    """A driver table with the columns that the text names."""
    df, named = table(spark, sf_dir, name), set(_WORD.findall(text))
    return df.select(*[c for c in df.columns if c in named])


def _small(df: DataFrame) -> DataFrame:
    """A hint for a table that is small by its measure, so that the larger side is not shuffled."""
    return F.broadcast(df) if fits_broadcast(df) else df


def _lines(spark: SparkSession, sf_dir: str, text: str, used: list[str], part: int = 0, parts: int = 1) -> DataFrame:
    """The joins of POS or ERP, over the columns their texts name.

    Customers meet the orders, of which there are fewer than lines, and names of nations and
    regions come last: what is shuffled by line has numbers and dates only, and the part's texts.
    """
    get = {name: _used(spark, sf_dir, text, name) for name in used}
    if parts > 1:
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            get[name] = get[name].where(F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(parts)) == part)
    orders = get["orders"].join(_small(get["customer"]), F.expr("o_custkey = c_custkey"))
    lines = get["lineitem"].join(orders, F.expr("l_orderkey = o_orderkey"))
    for name, on in (("supplier", "l_suppkey = s_suppkey"), ("part", "l_partkey = p_partkey")):
        lines = lines.join(_small(get[name]), F.expr(on)) if name in used else lines
    for name, on in (("nation", "c_nationkey = n_nationkey"), ("region", "n_regionkey = r_regionkey")):
        lines = lines.join(get[name], F.expr(on)) if name in used else lines
    return lines


def feed(spark: SparkSession, sf_dir: str, text: str, part: int = 0, parts: int = 1) -> DataFrame:
    """One of the feeds above, from the tables of ``sf_dir``; of one with lines, a part by order.

    The text's columns are taken as they are; its inner joins are made in the order that shuffles least.
    """
    used = [name for name in TABLES if f"{{{name}}}" in text]
    if "lineitem" not in used:
        return spark.sql(text, **{name: table(spark, sf_dir, name) for name in used})
    columns = text[: text.index("from {lineitem}")]
    return spark.sql(columns + "from {lines}", lines=_lines(spark, sf_dir, text, used, part, parts))


def feed_parts(spark: SparkSession, sf_dir: str, text: str) -> list[DataFrame]:
    """A feed with lines in parts, so that who stores them one by one holds what the joins of one have shuffled."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    parts = min(MOST_PARTS, max(1, -(-lines // LINES_PER_PART)))
    return [feed(spark, sf_dir, text, i, parts) for i in range(parts)]


def oracle_feed(text: str) -> str:
    """The same text over the oracle's views."""
    return text.format(**{name: name for name in TABLES})
