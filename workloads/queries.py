"""One callable per operator; each reads whole tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import substring_of
from tallyframe.operators import (
    CompareOptions,
    Comparison,
    compare_columns,
    compare_one_column,
    count_validation,
    data_compare,
    data_compare_tree,
    data_validation,
    drill_down,
    duplicate_keys,
    duplicate_validation,
    flatten,
    flatten_tables,
    key_counts,
    null_value_check,
    only_in_source,
    only_in_source_validation,
    only_in_target,
    only_in_target_validation,
    sample_failures,
    trim_columns,
    union_all,
    uniqueness_check,
)
from tallyframe.plans import (
    Environment,
    active_cases,
    bronze_to_silver,
    grouped_cases,
    raw_to_bronze,
    read_derived,
    read_plan,
    run_plan,
    update_derived,
    validate,
)
from tallyframe.results import Names, as_published
from tallyframe.schema import PLAN_SCHEMA, PUBLISHED_HEADINGS, RESULT_SCHEMA
from tallyframe.sources import (
    publish_run,
    read_csv,
    read_data,
    read_parquet,
    read_runs,
    register_view,
    schema_from_json,
    split_csv,
    split_json,
    write_csv,
    write_results,
)
from tallyframe.sources.scratch import fresh_path, stored
from tallyframe.streaming import (
    check_stream,
    publish_stream,
    stream_duplicate_keys,
    stream_only_in_source,
    stream_totals,
)
from workloads import inputs
from workloads.inputs import line_pair, order_pair, sql, table

ORDERS = Names("orders", "orders_copy")
LINES = Names("lineitem", "lineitem_copy")
LINE_KEY = "ok, ln"

_REGISTERED = {}


def registered(name: str):
    def keep(function):
        _REGISTERED[name] = function
        return function

    return keep


def all_queries():
    return dict(_REGISTERED)


# -- sources and sinks -----------------------------------------------------------


@registered("scan_csv")
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "scan-csv")
    write_csv(table(spark, folder, "orders"), path)
    return read_data(spark, "CSV", path).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
        "o_orderpriority",
    )


@registered("scan_csv_pipe")
def scan_csv_pipe(spark, folder):
    path = fresh_path(spark, "scan-pipe")
    write_csv(table(spark, folder, "customer"), path, delimiter="|")
    return read_data(spark, "csv", path, delimiter="|").select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


@registered("scan_csv_schema")
def scan_csv_schema(spark, folder):
    part = table(spark, folder, "part")
    path, schema_path = fresh_path(spark, "scan-typed"), fresh_path(spark, "schema")
    write_csv(part, path)
    spark.createDataFrame([(part.schema.json(),)], "value string").coalesce(
        1
    ).write.text(schema_path)
    return read_csv(
        spark, path, schema=schema_from_json(spark, f"{schema_path}/part-*")
    )


@registered("scan_json")
def scan_json(spark, folder):
    path = fresh_path(spark, "scan-json")
    table(spark, folder, "documents").write.json(path)
    return read_data(spark, "json", path).select(
        "doc_id", "text", "lang", "source", "n_chars"
    )


@registered("scan_json_multiline")
def scan_json_multiline(spark, folder):
    """Files that hold one array each; a file is read whole, so each is short."""
    path = fresh_path(spark, "scan-multiline")
    records = table(spark, folder, "customer").select(
        F.floor(F.col("c_custkey") / 500).alias("file"),
        F.to_json(F.struct("*"), {"pretty": "true"}).alias("record"),
    )
    arrays = records.groupBy("file").agg(
        F.concat(
            F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]")
        ).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_data(spark, "json", path, multiline=True).select(
        "c_custkey",
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        "c_acctbal",
        "c_mktsegment",
    )


@registered("scan_csv_rejects")
def scan_csv_rejects(spark, folder):
    """Orders as lines, some with cells too many, too few or of no type: the rows that fit
    the schema, written as lines again, and the others as they stand."""
    path = fresh_path(spark, "lines")
    sql(spark, folder, inputs.ORDER_LINES).select("line").write.text(path)
    read = split_csv(
        spark, path, "id long, price decimal(18,2), placed date, priority string", header=False
    )
    line = F.concat_ws(",", "id", F.coalesce(F.col("price").cast("string"), F.lit("")), "placed", "priority")
    return read.rows.select(line.alias("line"), F.lit(False).alias("broken")).unionByName(
        read.rejects.select(F.col("record").alias("line"), F.lit(True).alias("broken"))
    )


@registered("scan_json_rejects")
def scan_json_rejects(spark, folder):
    """Events as JSON lines, some cut off and some with words for numbers."""
    path = fresh_path(spark, "lines")
    lines = sql(spark, folder, inputs.EVENT_LINES)
    # Marks stand for quotes and the closing brace, which the two engines write alike so.
    text = F.translate(F.regexp_replace("line", r"\[\[|\]\]", '"'), "!", "}")
    lines.select(F.concat(F.lit("{"), text)).write.text(path)
    read = split_json(spark, path, "id long, user long, type string")
    kept = read.rows.selectExpr(
        "id as event_id", "user as user_id", "type as event_type", "cast(null as string) as record"
    )
    return kept.unionByName(read.rejects.select("record"), allowMissingColumns=True)


@registered("scan_parquet")
def scan_parquet(spark, folder):
    return read_parquet(spark, f"{folder}/part.parquet")


def _names_and_balances(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return customers, suppliers


def _typed_balances(df):
    return df.select(
        F.col("id").cast("bigint").alias("id"),
        "name",
        F.col("balance").cast("double").alias("balance"),
    )


@registered("sink_csv_append")
def sink_csv_append(spark, folder):
    customers, suppliers = _names_and_balances(spark, folder)
    path = fresh_path(spark, "sink-append")
    write_csv(customers, path, mode="append")
    write_csv(suppliers, path, mode="append")
    return _typed_balances(read_csv(spark, path))


@registered("sink_csv_overwrite")
def sink_csv_overwrite(spark, folder):
    customers, suppliers = _names_and_balances(spark, folder)
    path = fresh_path(spark, "sink-overwrite")
    write_csv(suppliers, path)
    write_csv(customers, path)
    return _typed_balances(read_csv(spark, path))


@registered("sink_rerun_once")
def sink_rerun_once(spark, folder):
    """Two runs of the null check, the first of which is published three times, and
    last with fewer rows; as CSV, under the schema of result tables."""
    path = fresh_path(spark, "runs")
    checked = null_value_check(
        sql(spark, folder, inputs.MARKED_TEXT), "k, note, price, placed", Names(target="orders")
    )
    again = (checked, checked, checked.filter("column <> 'placed'"))
    for run_id, results in (*(("first", rows) for rows in again), ("second", checked)):
        publish_run(results, path, run_id, format_name="csv")
    return read_runs(spark, path, RESULT_SCHEMA, format_name="csv")


@registered("union_all")
def union_of_all_rows(spark, folder):
    return union_all(list(_names_and_balances(spark, folder)))


# -- test plan ---------------------------------------------------------------------


@registered("plan_scan")
def plan_scan(spark, folder):
    path = fresh_path(spark, "plan")
    write_csv(sql(spark, folder, inputs.PLAN_ROWS), path)
    return read_plan(spark, "csv", path)


@registered("plan_active_cases")
def plan_active_cases(spark, folder):
    return active_cases(sql(spark, folder, inputs.PLAN_ROWS))


@registered("plan_grouped_cases")
def plan_grouped_cases(spark, folder):
    grouped = grouped_cases(active_cases(sql(spark, folder, inputs.PLAN_ROWS)))
    return grouped.withColumn(
        "validation_Type", F.array_join("validation_Type", ",")
    )


@registered("plan_run")
def plan_run(spark, folder):
    """A plan with two pairs; its checks read the given tables whole."""
    source, target = order_pair(spark, folder)
    register_view(source, "order_source")
    register_view(target, "order_target")
    by_view = ("order_source", "view", "NA", None, "order_target", "view", "NA", None)
    by_file = ("orders.parquet", "parquet", "NA", None) + (
        "lineitem.parquet",
        "parquet",
        "NA",
        None,
    )
    rows = [
        (*by_view, "k", "status, price", "k", name, "Y")
        for name in ("count_validation", "duplicate", "Null_value_check")
    ]
    rows += [(*by_view, "k", "status, price", "k", "data_compare", "N")]
    rows += [
        (*by_file, "o_orderkey", "NA", "NA", "count_validation", "Y"),
    ]
    rows += [
        (*by_view, "k", "status, price", "k", "records_present_only_in_source", "Y"),
        (*by_view, "k", "status, price", "k", "Uniquess_check", "Y"),
    ]
    plan = spark.createDataFrame(rows, PLAN_SCHEMA)
    return run_plan(plan, Environment(data_root=folder))


@registered("plan_run_shared")
def plan_run_shared(spark, folder):
    """Three cases on one pair of CSV files, which is read once for all of them."""
    root = fresh_path(spark, "shared")
    for name, rows in zip(("source", "target"), order_pair(spark, folder)):
        write_csv(rows, f"{root}/{name}.csv")
    pair = ("source.csv", "csv", "NA", None, "target.csv", "csv", "NA", None, "k")
    cases = [
        (*pair, "status, price", "k", "count_validation", "Y"),
        (*pair, "status, price", "k", "Null_value_check", "Y"),
        (*pair, "k", "NA", "Null_value_check", "Y"),
        (*pair, "NA", "k", "duplicate", "Y"),
        (*pair, "NA", "k", "Uniquess_check", "Y"),
        (*pair, "NA", "k", "records_present_only_in_target", "Y"),
    ]
    return run_plan(spark.createDataFrame(cases, PLAN_SCHEMA), Environment(data_root=root))


# -- checks on keys ----------------------------------------------------------------


@registered("count_validation")
def count_validation_orders(spark, folder):
    source, target = order_pair(spark, folder)
    return count_validation(source, target, "k", ORDERS)


@registered("duplicate_keys")
def duplicate_keys_lines(spark, folder):
    return duplicate_keys(
        table(spark, folder, "lineitem"), "l_orderkey, l_linenumber"
    )


@registered("duplicate_validation")
def duplicate_validation_orders(spark, folder):
    _, target = order_pair(spark, folder)
    return duplicate_validation(target, "k", ORDERS)


@registered("key_count_compare")
def key_count_compare(spark, folder):
    source, target = order_pair(spark, folder)
    return key_counts(source, target, "k")


@registered("only_in_target_keys")
def only_in_target_keys(spark, folder):
    source, target = order_pair(spark, folder)
    return only_in_target(source, target, "k")


@registered("only_in_source_keys")
def only_in_source_keys(spark, folder):
    source, target = line_pair(spark, folder)
    return only_in_source(source, target, LINE_KEY)


@registered("only_in_target")
def only_in_target_check(spark, folder):
    source, target = order_pair(spark, folder)
    return only_in_target_validation(source, target, "k", ORDERS)


@registered("only_in_source")
def only_in_source_check(spark, folder):
    source, target = line_pair(spark, folder)
    return only_in_source_validation(source, target, LINE_KEY, LINES)


# -- checks on columns -------------------------------------------------------------


@registered("uniqueness_check")
def uniqueness_check_documents(spark, folder):
    return uniqueness_check(
        table(spark, folder, "documents"),
        "doc_id, text, lang, n_chars",
        Names(target="documents"),
        whole_bytes=32,
    )


@registered("null_value_check")
def null_value_check_orders(spark, folder):
    marked = sql(spark, folder, inputs.MARKED_TEXT)
    return null_value_check(marked, "k, note, price, placed", Names(target="orders"))


# -- comparing columns ---------------------------------------------------------------


@registered("data_compare")
def data_compare_orders(spark, folder):
    source, target = order_pair(spark, folder)
    return data_compare(source, target, "k")


@registered("data_compare_repeated_keys")
def data_compare_repeated_keys(spark, folder):
    source, target = line_pair(spark, folder)
    return data_compare(source, target, LINE_KEY)


@registered("data_compare_tree")
def data_compare_tree_orders(spark, folder):
    return data_compare_tree(*order_pair(spark, folder), "k")


@registered("data_compare_tree_repeated_keys")
def data_compare_tree_repeated_keys(spark, folder):
    return data_compare_tree(*line_pair(spark, folder), LINE_KEY)


@registered("data_validation")
def data_validation_orders(spark, folder):
    source, target = order_pair(spark, folder)
    return data_validation(source, target, "k", names=ORDERS)


@registered("data_validation_repeated_keys")
def data_validation_repeated_keys(spark, folder):
    source, target = line_pair(spark, folder)
    return data_validation(source, target, LINE_KEY, names=LINES)


@registered("compare_columns")
def compare_columns_orders(spark, folder):
    source, target = order_pair(spark, folder)
    return compare_columns(source, target, "k")


@registered("compare_columns_repeated_keys")
def compare_columns_repeated_keys(spark, folder):
    source, target = line_pair(spark, folder)
    return compare_columns(source, target, LINE_KEY)


@registered("compare_columns_documents")
def compare_columns_documents(spark, folder):
    """Whole texts against the copy that carries a label, matched by document."""
    documents = table(spark, folder, "documents")
    labelled = documents.join(
        table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi"
    ).withColumn("lang", F.upper("lang"))
    return compare_columns(documents, labelled, "doc_id")


@registered("compare_one_column")
def compare_one_column_orders(spark, folder):
    source, target = order_pair(spark, folder)
    return compare_one_column(source, target, "k", "status")


@registered("compare_one_column_repeated_keys")
def compare_one_column_repeated_keys(spark, folder):
    source, target = line_pair(spark, folder)
    return compare_one_column(source, target, LINE_KEY, "state")


@registered("compare_substring")
def compare_substring(spark, folder):
    orders = table(spark, folder, "orders")
    source = orders.select("o_orderkey", "o_orderpriority")
    target = orders.select(
        "o_orderkey", F.lower("o_orderpriority").alias("o_orderpriority")
    )
    options = CompareOptions(normalizers={"o_orderpriority": substring_of(1, 3)})
    return compare_columns(source, target, "o_orderkey", options=options)


@registered("compare_tolerance")
def compare_tolerance(spark, folder):
    source, target = order_pair(spark, folder)
    options = CompareOptions(columns="price", tolerance={"price": "0.5"})
    return compare_columns(source, target, "k", options=options)


@registered("compare_tolerance_repeated_keys")
def compare_tolerance_repeated_keys(spark, folder):
    source, target = line_pair(spark, folder)
    options = CompareOptions(tolerance={"qty": 2})
    return compare_one_column(source, target, LINE_KEY, "qty", options=options)


@registered("compare_tolerance_mixed")
def compare_tolerance_mixed(spark, folder):
    source = sql(spark, folder, inputs.MIXED_SOURCE)
    target = sql(spark, folder, inputs.MIXED_TARGET)
    options = CompareOptions(tolerance={"amount": "0.5"})
    return compare_one_column(source, target, "k", "amount", options=options)


@registered("drill_down")
def drill_down_target(spark, folder):
    source, target = order_pair(spark, folder)
    failing = Comparison(source, target, "k").differing_keys()
    return drill_down(target, failing, "k").withColumn(
        "price", F.col("price").cast("string")
    )


@registered("sample_failures")
def sample_failures_orders(spark, folder):
    source, target = order_pair(spark, folder)
    return sample_failures(data_compare(source, target, "k"))


# -- whole runs ----------------------------------------------------------------------


@registered("validation_summary")
def validation_summary(spark, folder):
    source, target = order_pair(spark, folder)
    return validate(
        source,
        target,
        keys="k",
        null_columns="k, status, price",
        unique_columns="k, price",
        names=ORDERS,
    )


@registered("published_summary")
def published_summary(spark, folder):
    """The result rows of a pair, published as a file and read again."""
    path = fresh_path(spark, "published")
    write_results(as_published(validation_summary(spark, folder)), path)
    return read_csv(spark, path).select(
        *[
            F.col(heading).cast(field.dataType).alias(heading)
            for field, heading in zip(RESULT_SCHEMA.fields, PUBLISHED_HEADINGS)
        ]
    )


@registered("bronze_validation")
def bronze_validation(spark, folder):
    expected = contact_bronze(spark, folder)
    actual = sql(spark, folder, inputs.STORED_BRONZE, bronze=expected)
    return validate(
        expected,
        actual,
        keys="Identifier",
        null_columns="Identifier, middle_initial, suffix",
        unique_columns="Identifier, Email",
        names=Names("bronze_expected", "bronze"),
    )


@registered("silver_validation")
def silver_validation(spark, folder):
    expected = stored(bronze_to_silver(contact_bronze(spark, folder)))
    actual = sql(spark, folder, inputs.STORED_SILVER, silver=expected)
    return validate(
        expected,
        actual,
        keys="Identifier, Current_ind",
        null_columns="Identifier, Current_ind",
        unique_columns="Identifier",
        names=Names("silver_expected", "silver"),
    )


# -- transformations -----------------------------------------------------------------


def contact_bronze(spark, folder):
    raw = sql(spark, folder, inputs.CONTACT_RAW)
    return raw_to_bronze(raw, mask_email=inputs.MASKED_CHARACTERS)


def _plain_number(df):
    return df.withColumn("Identifier", F.col("Identifier").cast("bigint"))


@registered("raw_to_bronze")
def raw_to_bronze_contacts(spark, folder):
    return _plain_number(contact_bronze(spark, folder))


@registered("bronze_to_silver")
def bronze_to_silver_contacts(spark, folder):
    return _plain_number(bronze_to_silver(contact_bronze(spark, folder)))


@registered("silver_increment")
def silver_increment(spark, folder):
    """The silver table after a first build and two deliveries with new, changed and gone
    contacts, the last of which is the whole bronze table."""
    bronze = contact_bronze(spark, folder)
    moved = F.when(F.expr("Identifier % 7 = 0"), "elsewhere").otherwise(F.col("city"))
    path = fresh_path(spark, "silver")
    for delivered in (
        bronze.filter("Identifier % 5 <> 0"),
        bronze.filter("Identifier % 11 <> 0").withColumn("city", moved),
        bronze,
    ):
        update_derived(delivered, path, "Identifier", bronze_to_silver)
    return _plain_number(read_derived(spark, path))


@registered("flatten_struct")
def flatten_struct(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.from_json("props", "k int").alias("props")
    )
    return flatten(events)


@registered("flatten_array")
def flatten_array(spark, folder):
    vectors = flatten(table(spark, folder, "embeddings"))
    return vectors.withColumn("embedding", F.col("embedding").cast("double"))


@registered("flatten_nested")
def flatten_nested(spark, folder):
    """Every line of every text, out of an array of structs."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(line.alias("text"), F.length(line).alias("size")),
    )
    documents = table(spark, folder, "documents")
    return flatten(documents.select("doc_id", "lang", lines.alias("line")))


def _nested_documents(spark, folder):
    """Documents with two arrays beside one another, one of structs, and a map."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(line.alias("text"), F.split(line, " ").alias("words")),
    )
    marks = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    return table(spark, folder, "documents").select(
        "doc_id", lines.alias("lines"), marks.alias("marks"), F.struct("n_chars").alias("size")
    )


@registered("flatten_tables")
def flatten_tables_lines(spark, folder):
    """The lines of the documents, as the table of an array that has arrays inside and beside it."""
    tables = flatten_tables(_nested_documents(spark, folder), "doc_id")
    return tables["lines"].selectExpr(
        "cast(get_json_object(_parent, '$.doc_id') as bigint) as doc_id",
        "_place as place", "`value.text` as line", "`value.words` as words",
    )


@registered("flatten_tables_rebuilt")
def flatten_tables_rebuilt(spark, folder):
    """The documents again, out of five flat tables."""
    rebuilt = flatten_tables(_nested_documents(spark, folder), "doc_id").rebuilt()
    lines = F.transform("lines", lambda line: F.array_join(line["words"], " "))
    return rebuilt.select(
        "doc_id", F.array_join(lines, "\n").alias("text"), F.col("marks")["lang"].alias("lang"),
        F.col("marks")["source"].alias("source"), "size.n_chars",
    )


@registered("trim_columns")
def trim_columns_orders(spark, folder):
    _, target = order_pair(spark, folder)
    return trim_columns(target)


@registered("sql_projection")
def sql_projection(spark, folder):
    return spark.sql(
        """select s_suppkey, s_name, s_acctbal * 200 as balance,
                  nvl(s_nationkey, 0) as nation
           from {supplier}""",
        supplier=table(spark, folder, "supplier"),
    )


@registered("sql_having")
def sql_having(spark, folder):
    return spark.sql(
        """select l_orderkey, count(1) as line_count
           from {lineitem} group by l_orderkey having count(1) > 1""",
        lineitem=table(spark, folder, "lineitem"),
    )


@registered("sql_null_filter")
def sql_null_filter(spark, folder):
    source, _ = order_pair(spark, folder)
    return spark.sql(
        "select k, cast(price as string) as price from {pair} where status is null",
        pair=source,
    )


# -- streams -------------------------------------------------------------------------


@registered("stream_batch_checks")
def stream_batch_checks(spark, folder):
    """The events in eight files, two of them to a batch."""
    events = table(spark, folder, "events")
    landed = fresh_path(spark, "stream-source")
    events.repartition(8).write.parquet(landed)
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(landed)
    )
    results = fresh_path(spark, "stream-results")
    check_stream(
        stream,
        results,
        fresh_path(spark, "stream-checkpoint"),
        keys="event_id",
        null_columns="value, props",
        unique_columns="event_id, user_id",
        names=Names(target="events"),
    ).awaitTermination()
    return stream_totals(spark, results, source_records=events.count())


def _in_two_deliveries(spark, frames, found):
    """What a check finds on streams of these frames, first half of the month first.

    Each delivery lands in the folder of its stream and is processed by a run of its own,
    the second of which goes on with the state that the first one left.
    """
    folders = [fresh_path(spark, "stream-source") for _ in frames]
    results, checkpoint = fresh_path(spark, "stream-results"), fresh_path(spark, "stream-checkpoint")
    middle = F.lit("2024-01-16").cast("timestamp")
    for delivery in (F.col("ts") < middle, F.col("ts") >= middle):
        for frame, folder in zip(frames, folders):
            frame.filter(delivery).write.mode("append").parquet(folder)
        streams = [
            spark.readStream.schema(frame.schema).parquet(folder)
            for frame, folder in zip(frames, folders)
        ]
        publish_stream(found(*streams), results, checkpoint).awaitTermination()
    return spark.read.parquet(results)


@registered("stream_duplicate_keys")
def stream_duplicate_users(spark, folder):
    """Users with several events of a type, each within two hours of the one before."""
    return _in_two_deliveries(
        spark,
        [table(spark, folder, "events")],
        lambda events: stream_duplicate_keys(
            events, "user_id, event_type", "ts", within="2 hours", delay="1 hour"
        ),
    )


@registered("stream_only_in_source_keys")
def stream_only_in_source_users(spark, folder):
    """Users of a day with even events and without odd ones."""
    events = table(spark, folder, "events")
    return _in_two_deliveries(
        spark,
        [events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")],
        lambda source, target: stream_only_in_source(
            source, target, "user_id", "ts", window="1 day", delay="1 hour"
        ),
    )
