"""SQL for the checking engine, one text per query, over the same whole tables."""

from __future__ import annotations

from workloads import inputs
from workloads.inputs import bare

ORDER_SOURCE, ORDER_TARGET = bare(inputs.ORDER_SOURCE), bare(inputs.ORDER_TARGET)
LINE_SOURCE, LINE_TARGET = bare(inputs.LINE_SOURCE), bare(inputs.LINE_TARGET)
MARKED_TEXT, PLAN_ROWS = bare(inputs.MARKED_TEXT), bare(inputs.PLAN_ROWS)
CONTACT_RAW = bare(inputs.CONTACT_RAW)
MIXED_SOURCE, MIXED_TARGET = bare(inputs.MIXED_SOURCE), bare(inputs.MIXED_TARGET)
STORED_BRONZE, STORED_SILVER = bare(inputs.STORED_BRONZE), bare(inputs.STORED_SILVER)

ORDER_CTE = f"src as ({ORDER_SOURCE}), tgt as ({ORDER_TARGET})"
LINE_CTE = f"src as ({LINE_SOURCE}), tgt as ({LINE_TARGET})"
ORDER_COLUMNS = ("status", "price")
LINE_COLUMNS = ("flag", "state", "qty")
ORDER_NAMES = ("orders", "orders_copy")
LINE_NAMES = ("lineitem", "lineitem_copy")

NULL_TEXT = (
    "({c} is null or {c} = '' or {c} like '%None%' or {c} like '%NULL%' "
    "or {c} like '%Null%' or coalesce(isnan(try_cast({c} as double)), false))"
)
NULL_DOUBLE = "({c} is null or isnan({c}))"
NULL_OTHER = "({c} is null)"


# -- result rows -------------------------------------------------------------------


def text(value: str | None) -> str:
    return "cast(null as varchar)" if value is None else f"'{value}'"


def result(tc_id, name, source, target, n_source, n_target, failed, column) -> str:
    return f"""
select *, case when failed_records > 0 then 'fail' else 'pass' end as status from (
  select cast({tc_id} as integer) as tc_id, '{name}' as test_case_name,
         {text(source)} as source_name, {text(target)} as target_name,
         cast({n_source} as bigint) as source_records,
         cast({n_target} as bigint) as target_records,
         cast({failed} as bigint) as failed_records,
         '{column}' as "column")"""


N_SOURCE, N_TARGET = "(select count(*) from src)", "(select count(*) from tgt)"


def count_row(names, keys) -> str:
    failed = f"abs({N_SOURCE} - {N_TARGET})"
    return result(1, "Count_validation", *names, N_SOURCE, N_TARGET, failed, keys)


def duplicate_row(names, keys) -> str:
    failed = (
        f"(select count(*) from (select {keys} from tgt group by {keys} "
        f"having count(*) > 1))"
    )
    return result(2, "duplicate_validation", None, names[1], "null", N_TARGET, failed, keys)


def unique_row(target, column, table="tgt") -> str:
    failed = (
        f"(select count(*) from (select {column} from {table} group by {column} "
        f"having count(*) > 1))"
    )
    rows = f"(select count(*) from {table})"
    return result(3, "Uniquess_check", None, target, "null", rows, failed, column)


def null_row(target, column, rule, table="tgt") -> str:
    failed = f"(select count(*) from {table} where {rule.format(c=column)})"
    rows = f"(select count(*) from {table})"
    return result(4, "Null_value_check", None, target, "null", rows, failed, column)


def lonely(one, other, keys) -> str:
    equal = " and ".join(f"o.{k} = d.{k}" for k in keys.split(","))
    return (
        f"(select distinct {keys} from {one}) d "
        f"where not exists (select 1 from {other} o where {equal})"
    )


def only_in_target_row(names, keys) -> str:
    failed = f"(select count(*) from {lonely('tgt', 'src', keys)})"
    name = "records_present_only_in_target"
    return result(5, name, *names, N_SOURCE, N_TARGET, failed, keys)


def only_in_source_row(names, keys) -> str:
    failed = f"(select count(*) from {lonely('src', 'tgt', keys)})"
    name = "records_present_only_in_source"
    return result(6, name, *names, N_SOURCE, N_TARGET, failed, keys)


# -- the join of all pairs -------------------------------------------------------------


def joined(keys: str, columns) -> str:
    """CTE ``j``: every pair of rows, trimmed, with a mark for each present side
    and a number for each source row."""

    def side(name: str) -> str:
        values = ", ".join(
            f"trim(cast({c} as varchar)) as {c}" for c in columns
        )
        return (
            f"(select {keys}, {values}, 1 as here, row_number() over () as number "
            f"from {name})"
        )

    on = " and ".join(f"s.{k} = t.{k}" for k in keys.split(","))
    picked_keys = ", ".join(f"coalesce(s.{k}, t.{k}) as {k}" for k in keys.split(","))
    picked = ", ".join(f"s.{c} as s_{c}, t.{c} as t_{c}" for c in columns)
    return f"""j as (select {picked_keys}, s.here as s_here, t.here as t_here,
    s.number as s_number, {picked}
  from {side('src')} s full outer join {side('tgt')} t on {on})"""


def data_row(names, keys, columns) -> str:
    """Source rows without a partner, or unequal to one, added up over the columns."""
    failed = " + ".join(
        f"(select count(distinct s_number) from j where (s_{c} = t_{c}) is not true)"
        for c in columns
    )
    return result(7, "Datavalidation", *names, N_SOURCE, N_TARGET, failed, keys)


def summary(columns, equal="s_{c} = t_{c}") -> str:
    parts = []
    for c in columns:
        matches = f"(select count(*) from j where {equal.format(c=c)})"
        parts.append(f"""
select '{c}' as "column", {N_SOURCE} as total, {matches} as match_count""")
    return f"""select "column", cast(total as bigint) as total,
  cast(match_count as bigint) as match_count,
  cast(total - match_count as bigint) as mismatch_count,
  case when total <> 0
       then cast(total - match_count as double) * 100 / cast(total as double)
       end as mismatch_pct
from ({' union all '.join(parts)})"""


def pair_figures(column, equal="s_{c} = t_{c}") -> str:
    c, same = column, equal.format(c=column)
    return f"""select '{c}' as "column",
  cast(count(*) filter (where {same}) as bigint) as match_count,
  cast(count(*) filter (where ({same}) is not true) as bigint) as mismatch_count,
  count(*) as total
from j where (s_{c} is null) = (t_{c} is null)"""


def differences(keys, columns) -> str:
    """Differing cells when no key repeats on both sides with several values."""
    parts = [
        f"""select {keys}, '{c}' as "column", s_{c} as source_value,
  t_{c} as target_value, cast(count(*) as bigint) as pairs,
  case when max(t_here) is null then 'only_in_source'
       when max(s_here) is null then 'only_in_target' else 'pair' end as kind
from j where (s_{c} = t_{c}) is not true
group by {keys}, s_here, t_here, s_{c}, t_{c}"""
        for c in columns
    ]
    return " union all ".join(parts)


def factored_differences(keys, columns) -> str:
    """Differing cells; where both sides of a key have several values of a column,
    each side's values with the pairs in which they differ."""
    parts = []
    for c in columns:
        # Null is a value of its own here, hence the packed list.
        parts.append(f"""
select {keys}, '{c}' as "column", source_value, target_value,
       cast(sum(n) as bigint) as pairs, kind
from (
  select {keys}, n,
         case when g.t_here is null then 'only_in_source'
              when g.s_here is null then 'only_in_target'
              when ns > 1 and nt > 1 then side else 'pair' end as kind,
         case when ns > 1 and nt > 1 and side = 'value_in_target'
              then null else sv end as source_value,
         case when ns > 1 and nt > 1 and side = 'value_in_source'
              then null else tv end as target_value,
         ns, nt, side
  from (
    select {keys}, s_here, t_here, s_{c} as sv, t_{c} as tv, count(*) as n
    from j group by {keys}, s_here, t_here, s_{c}, t_{c}) g
  join (
    select {keys}, s_here, t_here,
           count(distinct [s_{c}]) as ns, count(distinct [t_{c}]) as nt
    from j group by {keys}, s_here, t_here) d using ({keys})
  cross join (select unnest(['value_in_source', 'value_in_target']) as side)
  where (sv = tv) is not true
    and ((ns > 1 and nt > 1) or side = 'value_in_source'))
group by {keys}, source_value, target_value, kind""")
    return " union all ".join(parts)


def suite(names, keys, columns, nulls, uniques) -> str:
    """All seven checks; ``nulls`` maps columns to the rule of their type."""
    return " union all ".join(
        [
            count_row(names, keys),
            duplicate_row(names, keys),
            *[unique_row(names[1], c) for c in uniques],
            *[null_row(names[1], c, rule) for c, rule in nulls.items()],
            only_in_target_row(names, keys),
            only_in_source_row(names, keys),
            data_row(names, keys, columns),
        ]
    )


# -- the medallion pipeline ----------------------------------------------------------

BRONZE_CTE = f"""raw as ({CONTACT_RAW}),
bronze as (
  select cast(Identifier as decimal(10,0)) as Identifier, upper(Surname) as Surname,
         upper(given_name) as given_name, upper(middle_initial) as middle_initial,
         suffix, Primary_street_number, primary_street_name, city, state, zipcode,
         Primary_street_number_prev, primary_street_name_prev, city_prev, state_prev,
         zipcode_prev, translate(Email, '{inputs.MASKED_CHARACTERS}', '****') as Email,
         translate(Phone, '+-', '') as Phone, rpad(birthmonth, 8, '0') as birthmonth
  from raw)"""

SILVER_CTE = f"""{BRONZE_CTE},
silver as (
  select Identifier, Surname, given_name, middle_initial, Primary_street_number,
         primary_street_name, city, state, zipcode, Email, Phone, birthmonth,
         'Y' as Current_ind from bronze
  union
  select Identifier, Surname, given_name, middle_initial, Primary_street_number_prev,
         primary_street_name_prev, city_prev, state_prev, zipcode_prev, Email, Phone,
         birthmonth, 'N' as Current_ind from bronze)"""

BRONZE_COMPARED = (
    "Surname",
    "given_name",
    "middle_initial",
    "suffix",
    "Primary_street_number",
    "primary_street_name",
    "city",
    "state",
    "zipcode",
    "Primary_street_number_prev",
    "primary_street_name_prev",
    "city_prev",
    "state_prev",
    "zipcode_prev",
    "Email",
    "Phone",
    "birthmonth",
)
SILVER_COMPARED = (
    "Surname",
    "given_name",
    "middle_initial",
    "Primary_street_number",
    "primary_street_name",
    "city",
    "state",
    "zipcode",
    "Email",
    "Phone",
    "birthmonth",
)


def all_oracles() -> dict[str, str]:
    order_j = f"with {ORDER_CTE}, {joined('k', ORDER_COLUMNS)}"
    line_j = f"with {LINE_CTE}, {joined('ok,ln', LINE_COLUMNS)}"
    documents_cte = """src as (select * from documents),
tgt as (select doc_id, text, upper(lang) as lang, source, n_chars from documents d
        where exists (select 1 from labels l where l.doc_id = d.doc_id))"""
    document_columns = ("text", "lang", "source", "n_chars")
    customer_rows = """select c_custkey as id, c_name as name, c_acctbal as balance
from customer"""
    both_rows = f"""{customer_rows} union all
select s_suppkey as id, s_name as name, s_acctbal as balance from supplier"""
    active = f"select * from ({PLAN_ROWS}) where execution_ind = 'Y'"
    plan_group = """source, source_type, source_db_name,
source_transformation_query_path, target, target_type, target_db_name,
target_transformation_query_path, key_col_list, null_col_list, unique_col_list"""
    order_nulls = {"k": NULL_OTHER, "status": NULL_TEXT, "price": NULL_OTHER}
    order_suite = suite(
        ORDER_NAMES, "k", ORDER_COLUMNS, order_nulls, ("k", "price")
    )
    views = ("order_source", "order_target")
    files = ("source.csv", "target.csv")
    marked_rules = {
        "k": NULL_OTHER,
        "note": NULL_TEXT,
        "price": NULL_DOUBLE,
        "placed": NULL_OTHER,
    }
    within = "abs(cast(s_{c} as decimal(18,2)) - cast(t_{c} as decimal(18,2))) <= "
    whole = "try_cast(split_part({}_{{c}}, '.', 1) as decimal(38,0))".format
    part = "try_cast('0.' || split_part({}_{{c}}, '.', 2) || '0' as decimal(19,18))".format

    return {
        "scan_csv": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
cast(cast(o_orderdate as date) as varchar) as o_orderdate, o_orderpriority
from orders""",
        "scan_csv_pipe": "select * from customer",
        "scan_csv_schema": "select * from part",
        "scan_json": "select doc_id, text, lang, source, n_chars from documents",
        "scan_json_multiline": "select * from customer",
        "scan_csv_rejects": f"select line, broken from ({bare(inputs.ORDER_LINES)})",
        "scan_json_rejects": f"""select case when not broken then event_id end as event_id,
case when not broken then user_id end as user_id,
case when not broken then event_type end as event_type,
case when broken then '{{{{' || replace(replace(replace(line, '[[', '"'), ']]', '"'), '!', '}}}}')
end as record from ({bare(inputs.EVENT_LINES)})""".replace("{{", "{").replace("}}", "}"),
        "scan_parquet": "select * from part",
        "sink_csv_append": both_rows,
        "sink_csv_overwrite": customer_rows,
        "union_all": both_rows,
        "plan_scan": PLAN_ROWS,
        "plan_active_cases": active,
        "plan_grouped_cases": f"""select {plan_group},
string_agg(distinct validation_Type, ',' order by validation_Type) as validation_Type
from ({active}) group by {plan_group}""",
        "plan_run": f"with {ORDER_CTE} "
        + " union all ".join(
            [
                count_row(views, "k"),
                duplicate_row(views, "k"),
                null_row(views[1], "status", NULL_TEXT),
                null_row(views[1], "price", NULL_OTHER),
                unique_row(views[1], "k"),
                only_in_source_row(views, "k"),
                result(
                    1,
                    "Count_validation",
                    "orders.parquet",
                    "lineitem.parquet",
                    "(select count(*) from orders)",
                    "(select count(*) from lineitem)",
                    "abs((select count(*) from orders)"
                    " - (select count(*) from lineitem))",
                    "o_orderkey",
                ),
            ]
        ),
        "plan_run_shared": f"with {ORDER_CTE} "
        + " union all ".join(
            [
                count_row(files, "k"),
                null_row(files[1], "status", NULL_TEXT),
                null_row(files[1], "price", NULL_OTHER),
                null_row(files[1], "k", NULL_OTHER),
                duplicate_row(files, "k"),
                unique_row(files[1], "k"),
                only_in_target_row(files, "k"),
            ]
        ),
        "count_validation": f"with {ORDER_CTE} {count_row(ORDER_NAMES, 'k')}",
        "duplicate_keys": """select l_orderkey, l_linenumber, count(*) as count
from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
        "duplicate_validation": f"with {ORDER_CTE} "
        + duplicate_row(ORDER_NAMES, "k"),
        "key_count_compare": f"""with {ORDER_CTE}
select coalesce(s.k, t.k) as k, source_count, target_count
from (select k, count(*) as source_count from src group by k) s
full outer join (select k, count(*) as target_count from tgt group by k) t
on s.k = t.k""",
        "only_in_target_keys": f"""with {ORDER_CTE}
select k, count(*) as target_count from tgt
where not exists (select 1 from src where src.k = tgt.k) group by k""",
        "only_in_source_keys": f"""with {LINE_CTE}
select ok, ln, count(*) as source_count from src
where not exists (select 1 from tgt where src.ok = tgt.ok and src.ln = tgt.ln)
group by ok, ln""",
        "only_in_target": f"with {ORDER_CTE} "
        + only_in_target_row(ORDER_NAMES, "k"),
        "only_in_source": f"with {LINE_CTE} "
        + only_in_source_row(LINE_NAMES, "ok,ln"),
        "uniqueness_check": " union all ".join(
            unique_row("documents", c, "documents")
            for c in ("doc_id", "text", "lang", "n_chars")
        ),
        "sink_rerun_once": f"with marked as ({MARKED_TEXT}), checked as ("
        + " union all ".join(
            null_row("orders", c, rule, "marked") for c, rule in marked_rules.items()
        )
        + """) select * from checked, (values ('first'), ('second')) as r(run_id)
where run_id = 'second' or "column" <> 'placed'""",
        "null_value_check": f"with marked as ({MARKED_TEXT}) "
        + " union all ".join(
            null_row("orders", c, rule, "marked") for c, rule in marked_rules.items()
        ),
        "data_compare": f"{order_j} {differences('k', ORDER_COLUMNS)}",
        "data_compare_repeated_keys": f"{line_j} "
        + factored_differences("ok,ln", LINE_COLUMNS),
        "data_compare_tree": f"{order_j} {differences('k', ORDER_COLUMNS)}",
        "data_compare_tree_repeated_keys": f"{line_j} "
        + factored_differences("ok,ln", LINE_COLUMNS),
        "data_validation": f"{order_j} "
        + data_row(ORDER_NAMES, "k", ORDER_COLUMNS),
        "data_validation_repeated_keys": f"{line_j} "
        + data_row(LINE_NAMES, "ok,ln", LINE_COLUMNS),
        "compare_columns": f"{order_j} {summary(ORDER_COLUMNS)}",
        "compare_columns_repeated_keys": f"{line_j} {summary(LINE_COLUMNS)}",
        "compare_columns_documents": f"with {documents_cte}, "
        f"{joined('doc_id', document_columns)} {summary(document_columns)}",
        "compare_one_column": f"{order_j} {pair_figures('status')}",
        "compare_one_column_repeated_keys": f"{line_j} {pair_figures('state')}",
        "compare_substring": f"""with src as (select o_orderkey, o_orderpriority
from orders), tgt as (select o_orderkey, lower(o_orderpriority) as o_orderpriority
from orders), {joined('o_orderkey', ['o_orderpriority'])}
{summary(['o_orderpriority'],
         'trim(substr(s_{c}, 1, 3)) = trim(substr(t_{c}, 1, 3))')}""",
        "compare_tolerance": f"{order_j} {summary(['price'], within + '0.5')}",
        "compare_tolerance_repeated_keys": f"{line_j} "
        + pair_figures("qty", within + "2"),
        "compare_tolerance_mixed": f"with src as ({MIXED_SOURCE}), "
        f"tgt as ({MIXED_TARGET}), {joined('k', ['amount'])} "
        + pair_figures(
            "amount",
            # Whole numbers and fractions apart: together they can exceed a decimal.
            f"(s_{{c}} = t_{{c}} or coalesce(case when abs({whole('s')} - {whole('t')}) <= 1 then "
            f"abs(cast({whole('s')} - {whole('t')} as decimal(20,18)) + {part('s')} - {part('t')}) <= 0.5 end, false))",
        ),
        "drill_down": f"""{order_j} select k, status,
cast(price as varchar) as price from tgt where k in (
select k from j where (s_status = t_status and s_price = t_price) is not true
and k is not null)""",
        "sample_failures": f"""{order_j} select * from (
{differences('k', ORDER_COLUMNS)})
order by k nulls first, "column", source_value nulls first, target_value nulls first,
pairs, kind limit 10""",
        "validation_summary": f"{order_j} {order_suite}",
        "published_summary": f"""{order_j} select tc_id as "TC_ID",
test_case_name as "test_Case_Name", source_name as "Source_name",
target_name as "target_name", source_records as "Number_of_source_Records",
target_records as "Number_of_target_Records",
failed_records as "Number_of_failed_Records", "column", status as "Status"
from ({order_suite})""",
        "bronze_validation": f"""with {BRONZE_CTE}, src as (select * from bronze),
tgt as ({STORED_BRONZE}), {joined('Identifier', BRONZE_COMPARED)} """
        + suite(
            ("bronze_expected", "bronze"),
            "Identifier",
            BRONZE_COMPARED,
            {
                "Identifier": NULL_OTHER,
                "middle_initial": NULL_TEXT,
                "suffix": NULL_TEXT,
            },
            ("Identifier", "Email"),
        ),
        "silver_validation": f"""with {SILVER_CTE}, src as (select * from silver),
tgt as ({STORED_SILVER}), {joined('Identifier,Current_ind', SILVER_COMPARED)} """
        + suite(
            ("silver_expected", "silver"),
            "Identifier,Current_ind",
            SILVER_COMPARED,
            {"Identifier": NULL_OTHER, "Current_ind": NULL_TEXT},
            ("Identifier",),
        ),
        "raw_to_bronze": f"""with {BRONZE_CTE} select * replace
(cast(Identifier as bigint) as Identifier) from bronze""",
        "bronze_to_silver": f"""with {SILVER_CTE} select * replace
(cast(Identifier as bigint) as Identifier) from silver""",
        "silver_increment": f"""with {SILVER_CTE} select * replace
(cast(Identifier as bigint) as Identifier) from silver""",
        "flatten_struct": """select event_id, cast(props->>'k' as integer) as props_k
from events""",
        "flatten_array": """select vec_id, cast(unnest(embedding) as double) as embedding,
label from embeddings""",
        "flatten_nested": """select doc_id, lang, line as line_text,
cast(length(line) as integer) as line_size
from (select doc_id, lang, unnest(string_split(text, chr(10))) as line from documents)""",
        "flatten_tables": """select doc_id, cast(unnest(range(len(lines))) as integer) as place,
unnest(lines) as line, cast(unnest(list_transform(lines, lambda x: len(string_split(x, ' ')))) as integer) as words
from (select doc_id, string_split(text, chr(10)) as lines from documents)""",
        "flatten_tables_rebuilt": "select doc_id, text, lang, source, n_chars from documents",
        "trim_columns": f"""with {ORDER_CTE}
select cast(k as varchar) as k, trim(status) as status, cast(price as varchar) as price
from tgt""",
        "sql_projection": """select s_suppkey, s_name, s_acctbal * 200 as balance,
coalesce(s_nationkey, 0) as nation from supplier""",
        "sql_having": """select l_orderkey, count(*) as line_count from lineitem
group by l_orderkey having count(*) > 1""",
        "sql_null_filter": f"""with {ORDER_CTE}
select k, cast(price as varchar) as price from src where status is null""",
        "stream_batch_checks": f"""select tc_id, test_case_name, "column",
target_records, failed_records from (
{result(1, 'Count_validation', None, 'events', 'null',
        '(select count(*) from events)', '0', 'event_id')} union all
{null_row('events', 'value', NULL_DOUBLE, 'events')} union all
{null_row('events', 'props', NULL_TEXT, 'events')} union all
{unique_row('events', 'event_id', 'events')} union all
{unique_row('events', 'user_id', 'events')})""",
        "stream_duplicate_keys": """with e as (
  select *, ts - lag(ts) over (partition by user_id, event_type order by ts) as gap from events
), placed as (
  select *, sum(case when gap <= interval 2 hour then 0 else 1 end) over (
    partition by user_id, event_type order by ts, event_id rows unbounded preceding) as stretch
  from e
)
select user_id, event_type, min(ts) as first, max(ts) as last, count(*) as rows
from placed group by user_id, event_type, stretch
having count(*) > 1
  and max(ts) + interval 2 hour <= (select max(ts) from events) - interval 1 hour""",
        "stream_only_in_source_keys": """with e as (
  select *, cast(date_trunc('day', ts) as timestamp) as window_start, event_id % 2 = 0 as even from events
), closed as (
  select least(max(ts) filter (where even), max(ts) filter (where not even)) - interval 1 hour as until from e
)
select window_start, user_id, count(*) filter (where even) as source_count
from e where window_start + interval 1 day <= (select until from closed)
group by window_start, user_id having count(*) filter (where not even) = 0""",
    }
