"""Reading and writing tables: sharded text exports, tables, run logs."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stayflow.operators.stats import per_column

FORMATS = ("csv", "json")

# Warehouse type names and the Spark types they become.
WAREHOUSE_TYPES = {
    "INT64": T.LongType(), "FLOAT64": T.DoubleType(), "NUMERIC": T.DecimalType(38, 9), "BOOL": T.BooleanType(),
    "STRING": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "DATETIME": T.TimestampNTZType(),
}


def schema_of(columns: dict[str, str]) -> T.StructType:
    """A Spark schema from warehouse column types, so that no file is read to guess one."""
    return T.StructType([T.StructField(n, WAREHOUSE_TYPES[t]) for n, t in columns.items()])


def warehouse_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return "NUMERIC"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INT64"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT64"
    return next((n for n, t in WAREHOUSE_TYPES.items() if t == dtype), "STRING")


def schema_report(df: DataFrame, counts: bool = False) -> DataFrame:
    """(position, column, type) of a query result; ``counts`` adds the values present."""
    rows = [(i, f.name, warehouse_type(f.dataType)) for i, f in enumerate(df.schema.fields)]
    out = df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")
    if not counts:
        return out  # nothing is executed
    present = per_column(df, df.columns, {"n_values": F.count}).withColumnRenamed("feature", "column_name")
    return out.join(present, "column_name")


def export(df: DataFrame, path: str, fmt: str = "csv", gzip: bool = False) -> None:
    """One file per task. An unknown format falls back to CSV."""
    writer = df.write.mode("overwrite")
    if gzip:
        writer = writer.option("compression", "gzip")
    if fmt == "json":
        writer.json(path)
    else:
        writer.option("header", True).option("escape", '"').csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """All shards of an export under an explicit schema; gzip is known by its suffix."""
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.json(path)
    return reader.option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, truncate: bool, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite" if truncate else "append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_parts(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Write ``df`` partitioned by ``parts``; a rerun replaces the partitions it writes and no others.

    A month that is run again, or a run id, ends with one set of rows, in place of the two
    that appending would leave. Partitions that ``df`` has no rows for stay as they are.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def load_checked(spark: SparkSession, path: str, schema: T.StructType, target: str, fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """The rows of an export that fit the schema, and the lines that do not.

    The files are parsed once, without dropping or failing on a bad line, and written to
    ``target`` in two parts: rows of the schema, and quarantined (file, line). The sizes
    of both add up to the lines of the files, headers and blank lines apart.
    """
    held = T.StructType([*schema.fields, T.StructField("_line", T.StringType())])
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    if fmt == "json":
        # line by line: the file reader gives no row at all, or several, for a line that holds an array
        lines = spark.read.text(path).filter("trim(value) <> ''")
        row = F.when(F.ltrim("value").startswith("{"), F.from_json("value", held, how))
        rows = lines.select(row.alias("_row"), "value")
        broken = F.when(F.col("_row").isNull() | F.col("_row._line").isNotNull(), F.col("value"))
        rows = rows.select(*(F.col(f"_row.`{c}`").alias(c) for c in schema.names), broken.alias("_line"))
    else:
        rows = spark.read.schema(held).options(**how, header=True, escape='"', enforceSchema=False).csv(path)
    rows = rows.withColumns({"_file": F.input_file_name(), "_bad": F.col("_line").isNotNull()})
    rows.write.mode("overwrite").partitionBy("_bad").parquet(target)
    kept = spark.read.schema(T.StructType([*held.fields, T.StructField("_file", T.StringType()), T.StructField("_bad", T.BooleanType())])).parquet(target)
    return kept.filter("NOT _bad").select(*schema.names), kept.filter("_bad").select(F.col("_file").alias("file"), F.col("_line").alias("line"))


def quarantine_report(good: DataFrame, bad: DataFrame) -> DataFrame:
    """(part, rows) of a checked load."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "rows")
    return count(good, "good").unionByName(count(bad, "quarantined"))
