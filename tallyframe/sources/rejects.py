"""Reading text files under a schema: rows that fit it, and records that do not.

Spark's readers give null for a cell that does not fit its type, which a later check
would lay to the data. Here such records are set aside with their text and file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import ref
from tallyframe.results import COUNT, Names, result_row, spread
from tallyframe.sources.readers import Schema
from tallyframe.sources.scratch import stored


@dataclass(frozen=True)
class Split:
    """What was read: ``rows`` in the schema, and ``rejects`` as ``(file, record)``.

    ``records`` is the number of both, counted while they were read.
    """

    rows: DataFrame
    rejects: DataFrame
    records: int
    rejected: int

    def reconciled(self, names: Names = Names()) -> DataFrame:
        """A result row: the records of the files against the rows that fit the schema."""
        figures = self.rows.sparkSession.range(1).selectExpr(
            f"{self.records}L as records", f"{self.records - self.rejected}L as kept"
        )
        row = result_row(
            COUNT, names, "records - kept", "*", source_records="records", target_records="kept"
        )
        return spread(figures, [row])


def _schema_of(spark: SparkSession, schema: Schema) -> T.StructType:
    return spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema


def _free(name: str, taken: list[str]) -> str:
    names = {other.lower() for other in taken}
    while name.lower() in names:
        name += "_"
    return name


def _split(spark: SparkSession, format_name: str, path, schema: Schema, options: dict) -> Split:
    wanted = _schema_of(spark, schema)
    broken, file = _free("__record", wanted.names), _free("__file", wanted.names)
    # Readers fill every field with null where a record is broken, so all may be null here.
    fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in wanted.fields]
    parsed = (
        spark.read.format(format_name)
        .schema(T.StructType([*fields, T.StructField(broken, T.StringType())]))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=broken, **options)
        .load(path)
    )
    seen = Observation()
    # Stored whole, as a reader asked for some columns does not look at the others, and
    # would find other records broken for every set of columns.
    held = stored(
        parsed.select(*[ref(n) for n in wanted.names], ref(broken), F.col("_metadata.file_path").alias(file))
        .observe(seen, F.count(F.lit(1)).alias("records"), F.count(ref(broken)).alias("rejected"))
    )
    counts = seen.get
    return Split(
        held.filter(ref(broken).isNull()).select(*[ref(n) for n in wanted.names]),
        held.filter(ref(broken).isNotNull()).select(ref(file).alias("file"), ref(broken).alias("record")),
        counts["records"],
        counts["rejected"],
    )


def split_csv(spark: SparkSession, path, schema: Schema, *, delimiter: str = ",", **options) -> Split:
    """CSV with a header (or ``header=False``). A record is rejected whose cells are more or
    fewer than the schema's, or do not fit its types; an empty cell is a null that fits."""
    return _split(spark, "csv", path, schema, {"header": True, "delimiter": delimiter} | options)


def split_json(spark: SparkSession, path, schema: Schema, *, multiline: bool = False, **options) -> Split:
    """JSON, one record per line, or with ``multiline`` one value per file.

    A record is rejected that is no JSON or whose values do not fit the schema's types; a
    field that is absent is a null that fits. A multi-line file is rejected as a whole.
    """
    return _split(spark, "json", path, schema, {"multiLine": multiline} | options)
