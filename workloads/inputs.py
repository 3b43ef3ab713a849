"""Pairs of datasets to compare, derived from the given tables.

Each is one SQL text that Spark and the checking engine both read. The targets
differ from the sources in planted ways: moved and missing keys, rows loaded
twice, changed values, blanks, and missing values of several kinds.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

# -- orders: keys unique in the source, some rows twice in the target ----------

ORDER_SOURCE = """
select case when o_totalprice > 499500 then null else o_orderkey end as k,
       case when o_orderpriority = '4-NOT SPECIFIED' and o_totalprice < 50000
            then null else o_orderstatus end as status,
       cast(o_totalprice as decimal(18,2)) as price
from {orders}
"""

ORDER_TARGET = """
select case when o_totalprice > 498500 then null
            when o_totalprice > 495000 then o_orderkey + 1000000000
            else o_orderkey end as k,
       case when o_orderpriority = '4-NOT SPECIFIED' and o_totalprice < 60000
            then null
            when o_orderpriority = '2-HIGH' then concat(o_orderstatus, ' ')
            when o_orderpriority = '3-MEDIUM' and o_totalprice < 20000 then 'X'
            else o_orderstatus end as status,
       cast(case when o_totalprice >= 100000 and o_totalprice < 105000
                 then o_totalprice + 1
                 when o_totalprice >= 105000 and o_totalprice < 115000
                 then o_totalprice + 0.25
                 else o_totalprice end as decimal(18,2)) as price
from {orders}
where o_totalprice >= 5000
union all
select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2))
from {orders}
where o_totalprice >= 200000 and o_totalprice < 204000
"""

# -- order lines: keys that repeat on both sides, with differing values ---------

LINE_SOURCE = """
select l_orderkey as ok, l_linenumber as ln, l_returnflag as flag,
       case when l_discount = 0.05 then null else l_linestatus end as state,
       cast(l_quantity as decimal(18,2)) as qty
from {lineitem}
"""

LINE_TARGET = """
select l_orderkey as ok, l_linenumber as ln,
       case when l_tax = 0.03 and l_returnflag = 'R' then 'A'
            else l_returnflag end as flag,
       case when l_discount >= 0.05 and l_discount < 0.07 then null
            else l_linestatus end as state,
       cast(case when l_tax = 0.05 then l_quantity + 1.5
                 else l_quantity end as decimal(18,2)) as qty
from {lineitem}
where not (l_returnflag = 'N' and l_tax = 0.08)
"""

# -- text columns with every kind of missing value ------------------------------

MARKED_TEXT = """
select o_orderkey as k,
       case when o_orderpriority = '1-URGENT' then 'Nonesuch'
            when o_orderpriority = '2-HIGH' then 'null'
            when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' then 'is NULL'
            when o_orderpriority = '3-MEDIUM' then ' NaN '
            when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F' then ''
            when o_orderpriority = '4-NOT SPECIFIED' then ' '
            when o_orderstatus = 'F' then 'Nullable'
            when o_orderstatus = 'O' then 'banana'
            else null end as note,
       case when o_orderstatus = 'P' then null else o_totalprice end as price,
       o_orderdate as placed
from {orders}
"""

# -- amounts as text, several per customer: words, empty values, seven fraction
# -- digits, and numbers too large for a decimal

MIXED_SOURCE = """
select o_custkey as k,
       case when o_orderpriority = '1-URGENT' then 'unknown'
            when o_orderpriority = '2-HIGH' and o_orderstatus = 'F' then ''
            when o_orderpriority = '2-HIGH'
            then concat(cast(cast(o_totalprice as decimal(18,2)) as string), '0000')
            when o_orderpriority = '3-MEDIUM'
            then concat(cast(cast(o_totalprice as decimal(18,2)) as string), '00001')
            when o_orderpriority = '4-NOT SPECIFIED'
            then concat('9', lpad(cast(o_orderkey as string), 33, '0'))
            else cast(cast(o_totalprice as decimal(18,2)) as string) end as amount
from {orders}
"""

MIXED_TARGET = """
select o_custkey as k,
       case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then '5'
            when o_orderpriority = '1-URGENT' then ' unknown'
            when o_orderpriority = '2-HIGH' and o_orderstatus = 'F' then ''
            when o_orderpriority = '2-HIGH'
            then cast(cast(o_totalprice as decimal(18,2)) as string)
            when o_orderpriority = '3-MEDIUM'
            then concat(cast(cast(o_totalprice as decimal(18,2))
                             + cast(0.5 as decimal(18,2)) as string),
                        case when o_orderstatus = 'F' then '00000' else '00002' end)
            when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F'
            then concat('9', lpad(cast(o_orderkey as string), 33, '0'))
            when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O'
            then concat('9', lpad(cast(o_orderkey as string), 33, '0'), '.25')
            when o_orderpriority = '4-NOT SPECIFIED'
            then concat('9', lpad(cast(o_orderkey + 1 as string), 33, '0'))
            when o_orderstatus = 'F'
            then cast(cast(o_totalprice + 0.5 as decimal(18,2)) as string)
            else cast(cast(o_totalprice + 0.75 as decimal(18,2)) as string) end as amount
from {orders}
"""

# -- lines of files, some of which do not fit a schema ---------------------------

ORDER_LINES = """
select concat(cast(o_orderkey as string), ',',
              case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then 'n/a'
                   when o_orderstatus = 'P' then ''
                   else cast(cast(o_totalprice as decimal(18,2)) as string) end, ',',
              case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F'
                   then '2024-13-45' else cast(cast(o_orderdate as date) as string) end,
              case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' then ''
                   else concat(',', o_orderpriority) end,
              case when o_orderpriority = '2-HIGH' and o_orderstatus = 'O' then ',more'
                   else '' end) as line,
       o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED')
       or o_orderpriority = '2-HIGH' and o_orderstatus = 'O' as broken
from {orders}
"""

EVENT_LINES = """
select concat('[[id]]:', cast(event_id as string),
              case when event_type = 'view' then '' else concat(',[[user]]:',
                case when event_type = 'error' and event_id % 2 = 0
                     then '[[nobody]]' else cast(user_id as string) end) end,
              ',[[type]]:[[', event_type, ']]',
              case when event_type = 'click' and event_id % 3 = 0 then '' else '!' end) as line,
       event_type = 'error' and event_id % 2 = 0
       or event_type = 'click' and event_id % 3 = 0 as broken,
       event_id, case when event_type = 'view' then null else user_id end as user_id, event_type
from {events}
"""

# -- contacts: the medallion pipeline ------------------------------------------

CONTACT_RAW = """
select cast(c_custkey as string) as Identifier,
       lower(c_name) as Surname,
       lower(c_mktsegment) as given_name,
       case when c_acctbal < 2000 then lower(substr(c_mktsegment, 1, 1))
            else null end as middle_initial,
       cast(null as string) as suffix,
       concat(cast(c_nationkey as string), '/', cast(c_custkey as string))
           as Primary_street_number,
       concat(c_mktsegment, ' street') as primary_street_name,
       concat('city ', cast(c_nationkey as string)) as city,
       cast(c_nationkey as string) as state,
       concat('5600', cast(c_nationkey as string)) as zipcode,
       concat(cast(c_nationkey + 1 as string), '/', cast(c_custkey as string))
           as Primary_street_number_prev,
       concat(c_mktsegment, ' lane') as primary_street_name_prev,
       concat('town ', cast(c_nationkey as string)) as city_prev,
       cast(c_nationkey + 1 as string) as state_prev,
       concat('A-', cast(c_nationkey as string)) as zipcode_prev,
       concat(lower(c_name), '@mail.example') as Email,
       concat('+', cast(c_nationkey as string), '-', cast(c_custkey as string))
           as Phone,
       concat('1990', lpad(cast(c_nationkey as string), 2, '0')) as birthmonth
from {customer}
"""

_STORED_CONTACT = """
select Identifier, Surname, given_name, middle_initial{suffix},
       Primary_street_number, primary_street_name,
       case when given_name = 'MACHINERY' and state = '5' then 'moved away'
            else city end as city,
       state, zipcode{previous}, Email, Phone, birthmonth{flag}
from {{{layer}}}
where not (given_name = 'FURNITURE' and state = '3')
union all
select * from {{{layer}}} where given_name = 'BUILDING' and state = '7'
"""

STORED_BRONZE = _STORED_CONTACT.format(
    layer="bronze",
    suffix=", suffix",
    previous=""", Primary_street_number_prev, primary_street_name_prev,
       city_prev, state_prev, zipcode_prev""",
    flag="",
)

STORED_SILVER = _STORED_CONTACT.format(
    layer="silver", suffix="", previous="", flag=", Current_ind"
)

MASKED_CHARACTERS = "cmex"

# -- a test plan with a row per event -------------------------------------------

PLAN_ROWS = """
select concat('landing/events_', cast(user_id as string), '.csv') as source,
       'csv' as source_type,
       'NA' as source_db_name,
       'NA' as source_transformation_query_path,
       concat('events_', cast(user_id as string)) as target,
       'table' as target_type,
       'warehouse' as target_db_name,
       'events.sql' as target_transformation_query_path,
       'event_id' as key_col_list,
       'value, props' as null_col_list,
       'event_id' as unique_col_list,
       case event_type when 'view' then 'count_validation'
                       when 'click' then 'duplicate'
                       when 'signup' then 'Null_value_check'
                       when 'purchase' then 'Uniquess_check'
                       else 'data_compare' end as validation_Type,
       case when value >= 10 then 'Y' else 'N' end as execution_ind
from {events}
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql(spark: SparkSession, folder: str, text: str, **frames: DataFrame) -> DataFrame:
    """A SQL text whose ``{names}`` stand for given tables or frames."""
    named = {name for _, name, _, _ in Formatter().parse(text) if name}
    tables = {name: table(spark, folder, name) for name in named - frames.keys()}
    return spark.sql(text, **tables, **frames)


def bare(text: str) -> str:
    """The same text with every name written out, for the checking engine."""
    return text.replace("{", "").replace("}", "")


def order_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders")
    return (
        sql(spark, folder, ORDER_SOURCE, orders=orders),
        sql(spark, folder, ORDER_TARGET, orders=orders),
    )


def line_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, folder, "lineitem")
    return (
        sql(spark, folder, LINE_SOURCE, lineitem=lines),
        sql(spark, folder, LINE_TARGET, lineitem=lines),
    )
