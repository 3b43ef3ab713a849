import json

import pytest
from pyspark.sql import types as T

from tallyframe.sources import (
    MissingConnector,
    read_csv,
    read_data,
    read_format,
    read_json,
    read_kafka_stream,
    register_view,
    schema_from_json,
    write_csv,
    write_results,
)
from tallyframe.sources.readers import jdbc_options, kafka_options
from tallyframe.sources.scratch import fresh_path, shared_folder
from tallyframe.sources.writers import jdbc_write_options, write_table
from tests.helpers import rows

CONNECTION = {
    "url": "jdbc:some:thing",
    "user": "u",
    "password": "p",
    "driver": "some.Driver",
}


def test_csv_is_text_with_nulls_for_empty_fields(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b"\xef\xbb\xbfid,name\n1, x \n2,\n")
    df = read_data(spark, "CSV", str(path))
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert rows(df) == [("1", " x "), ("2", None)]


@pytest.mark.parametrize("delimiter", ["|", ";", "\t"])
def test_csv_with_other_delimiters(spark, tmp_path, delimiter):
    path = tmp_path / "a.csv"
    path.write_text(f"id{delimiter}name\n1{delimiter}a,b\n")
    assert rows(read_data(spark, "csv", str(path), delimiter=delimiter)) == [("1", "a,b")]


def test_schema_from_json_file(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    (tmp_path / "schema.json").write_text(json.dumps(schema.jsonValue(), indent=2))
    (tmp_path / "a.csv").write_text("id,x\n1,2.5\n")
    read = schema_from_json(spark, str(tmp_path / "schema.json"))
    assert rows(read_csv(spark, str(tmp_path / "a.csv"), schema=read)) == [(1, 2.5)]


def test_json_lines_with_optional_fields(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"n":1,"d":1.5,"s":"x","b":true}\n{"n":2,"o":7}\n')
    df = read_data(spark, "json", str(path))
    assert dict(df.dtypes) == {
        "n": "bigint",
        "d": "double",
        "s": "string",
        "b": "boolean",
        "o": "bigint",
    }
    assert rows(df, "n", "o") == [(1, None), (2, 7)]


def test_multiline_json(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{\n  "fruit": "Plum",\n  "size": "Small"\n}')
    assert read_json(spark, str(path)).columns == ["_corrupt_record"]
    df = read_data(spark, "json", str(path), multiline=True)
    assert rows(df) == [("Plum", "Small")]


def test_parquet_format_and_view(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(f"{tmp_path}/p")
    df.write.orc(f"{tmp_path}/o")
    assert rows(read_data(spark, "Parquet", f"{tmp_path}/p")) == rows(df)
    assert rows(read_format(spark, "orc", f"{tmp_path}/o")) == rows(df)
    register_view(df.filter("id > 0"), "some_view")
    assert rows(read_data(spark, "view", "some_view")) == [(1,), (2,)]


def test_missing_connectors_say_so(spark, tmp_path):
    with pytest.raises(MissingConnector, match="avro"):
        read_data(spark, "avro", str(tmp_path))
    with pytest.raises(MissingConnector, match="kafka"):
        read_kafka_stream(spark, "host:1", "topic")


def test_unknown_types_and_connections(spark):
    with pytest.raises(ValueError, match="unknown type 'xml'"):
        read_data(spark, "xml", "x")
    with pytest.raises(ValueError, match="no connection named 'db'"):
        read_data(spark, "table", "x", database="db", query="select 1")


def test_kafka_options():
    assert kafka_options("a:1,b:2", "t") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "includeHeaders": "true",
    }


def test_jdbc_options():
    assert jdbc_options(CONNECTION, " select * from t ;\n") == CONNECTION | {
        "query": "select * from t"
    }
    bounds = {
        "partitionColumn": "id",
        "lowerBound": 0,
        "upperBound": 100,
        "numPartitions": 4,
    }
    assert jdbc_options(CONNECTION | bounds, "select * from t") == CONNECTION | {
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
        "dbtable": "(select * from t) q",
    }
    with pytest.raises(ValueError, match="needs all"):
        jdbc_options(CONNECTION | {"numPartitions": 4}, "select 1")
    with pytest.raises(ValueError, match="lacks"):
        jdbc_options({"url": "x"}, "select 1")


class Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def options(self, **options):
        self.told["options"] = options
        return self

    def load(self):
        return self.told

    def save(self):
        return None


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()


def test_table_reads_its_query_from_text():
    told = read_data(
        Holder(), "TABLE", "t", connections={"db": CONNECTION}, database="db",
        query="select 1;",
    )
    assert told == {"format": "jdbc", "options": CONNECTION | {"query": "select 1"}}
    with pytest.raises(ValueError, match="either"):
        read_data(Holder(), "table", "t", connections={"db": CONNECTION}, database="db")


def test_table_write():
    frame = Holder()
    write_table(frame, CONNECTION, "results")
    assert frame.write.told == {
        "format": "jdbc",
        "mode": "overwrite",
        "options": jdbc_write_options(CONNECTION, "results"),
    }
    assert jdbc_write_options(CONNECTION, "results")["dbtable"] == "results"
    with pytest.raises(ValueError, match="lacks"):
        jdbc_write_options({}, "results")


def test_query_from_a_file(spark, tmp_path):
    from tallyframe.sources import read_text

    (tmp_path / "q.sql").write_text("select *\nfrom contact_info\n")
    assert read_text(spark, str(tmp_path / "q.sql")) == "select *\nfrom contact_info\n"


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b")], "id int, name string")
    path = f"{tmp_path}/out"
    write_csv(df, path, mode="append")
    write_csv(df, path, mode="append")
    assert rows(read_csv(spark, path)) == [("1", "a,b"), ("1", "a,b")]
    write_csv(df, path)
    assert rows(read_csv(spark, path)) == [("1", "a,b")]
    write_results(df.repartition(3), f"{tmp_path}/results")
    assert len(list((tmp_path / "results").glob("part-*.csv"))) == 1


def test_shared_folder_is_the_session_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    first, second = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert first.startswith(folder) and first != second


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_text_of_several_files_is_refused(spark, tmp_path):
    from tallyframe.sources import read_text

    for name in ("a", "b"):
        (tmp_path / f"{name}.sql").write_text("select 1")
    assert read_text(spark, str(tmp_path / "a.sql")) == "select 1"
    with pytest.raises(ValueError, match="more than one file"):
        read_text(spark, str(tmp_path))
