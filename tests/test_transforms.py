import pytest
from pyspark.sql import functions as F

from tallyframe.functions import fill_right, mask_characters, whole_number
from tallyframe.operators import flatten, sample_failures, trim_columns, union_all, unpivot_history
from tallyframe.plans import bronze_to_silver, raw_to_bronze
from tallyframe.plans.medallion import CONTACT_COLUMNS, SILVER_COLUMNS
from tests.helpers import rows


def test_flatten_nested(spark):
    schema = (
        "id int, s struct<a:int,b:struct<c:string>>, "
        "l array<struct<x:int>>, m map<string,int>, e array<int>"
    )
    df = spark.createDataFrame(
        [
            (1, (10, ("p",)), [(1,), (2,)], {"k": 1}, [7, 8]),
            (2, None, [], None, None),
        ],
        schema,
    )
    flat = flatten(df)
    assert flat.columns == ["id", "m", "e", "s_a", "l_x", "s_b_c"]
    assert rows(flat, "id", "s_a", "s_b_c", "l_x", "e") == [
        (1, 10, "p", 1, 7),
        (1, 10, "p", 1, 8),
        (1, 10, "p", 2, 7),
        (1, 10, "p", 2, 8),
        (2, None, None, None, None),
    ]


def test_flatten_quotes_names_and_refuses_clashes(spark):
    df = spark.sql("select named_struct('a.b', 1) as `s.t`")
    assert flatten(df).columns == ["s.t_a.b"]
    with pytest.raises(ValueError, match="repeats columns"):
        flatten(spark.sql("select named_struct('a', 1) as s, 2 as s_a"))


def test_trim_columns(spark):
    df = spark.createDataFrame([(1, " a ", " b ")], "k int, a string, b string")
    assert rows(trim_columns(df)) == [("1", "a", "b")]
    assert rows(trim_columns(df, "A")) == [(1, "a", " b ")]


def test_union_all_keeps_repeats(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rows(union_all([df, df])) == [(1,), (1,)]
    with pytest.raises(ValueError, match="nothing"):
        union_all([])


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("Cafe", "12.6", "199801"), ("face", "x", "1998010203"), (None, None, None)],
        "a string, b string, c string",
    )
    got = df.select(
        mask_characters(F.col("a"), "Cae"), whole_number(F.col("b")), fill_right(F.col("c"), 8)
    )
    assert [tuple(r) for r in got.collect()] == [
        ("**f*", 13, "19980100"),
        ("f*c*", None, "19980102"),
        (None, None, None),
    ]


def contact(number, **changed):
    row = dict.fromkeys(CONTACT_COLUMNS, None) | {
        "Identifier": str(number),
        "Surname": "doe",
        "given_name": "Ann",
        "city": "Here",
        "zipcode": "12345",
        "city_prev": "There",
        "zipcode_prev": "A-1",
        "Email": "ann@mail.example",
        "Phone": "+12-34",
        "birthmonth": "199801",
    }
    return tuple((row | changed).values())


def contacts(spark, values):
    return spark.createDataFrame(values, ", ".join(f"{c} string" for c in CONTACT_COLUMNS))


def test_raw_to_bronze(spark):
    raw = contacts(spark, [contact(1), contact("x")])
    bronze = raw_to_bronze(raw, mask_email="an", numeric_zipcode=True)
    assert bronze.columns == list(CONTACT_COLUMNS)
    first, second = bronze.collect()
    assert first["Identifier"] == 1 and second["Identifier"] is None
    assert (first["Surname"], first["given_name"]) == ("DOE", "ANN")
    assert (first["Email"], first["Phone"]) == ("***@m*il.ex*mple", "1234")
    assert (first["birthmonth"], first["zipcode"]) == ("19980100", 12345)
    plain = raw_to_bronze(raw).first()
    assert (plain["Email"], plain["zipcode"]) == ("ann@mail.example", "12345")


def test_bronze_to_silver_is_distinct_and_read_once(spark, tmp_path):
    contacts(spark, [contact(1), contact(1), contact(2, city="Else")]).write.parquet(
        f"{tmp_path}/raw"
    )
    bronze = raw_to_bronze(spark.read.parquet(f"{tmp_path}/raw"), numeric_zipcode=True)
    silver = bronze_to_silver(bronze)
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert silver.columns == list(SILVER_COLUMNS)
    got = {
        (int(r["Identifier"]), r["city"], r["zipcode"], r["Current_ind"])
        for r in silver.collect()
    }
    assert got == {
        (1, "Here", "12345", "Y"),
        (1, "There", "A-1", "N"),
        (2, "Else", "12345", "Y"),
        (2, "There", "A-1", "N"),
    }
    assert silver.count() == 4


def test_unpivot_history_keeps_numbers_when_types_agree(spark):
    df = spark.createDataFrame([(1, 10, 20)], "id int, now int, then int")
    got = unpivot_history(df, ["id"], {"Y": {"v": "now"}, "N": {"v": "then"}}, "flag")
    assert rows(got) == [(1, 10, "Y"), (1, 20, "N")]


def test_names_with_blanks_are_trimmed_and_sampled(spark):
    frame = spark.createDataFrame([("  x ", 2), (" y", 1)], "` a ` string, b int")
    assert [tuple(r) for r in trim_columns(frame).orderBy("b").collect()] == [("y", "1"), ("x", "2")]
    assert sample_failures(frame, count=1).first()[0] == "  x "
