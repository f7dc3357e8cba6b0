"""Reading tables and request batches, and small reports about what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.running import exact_total
from tidemark.spec import CUSTOMER_FIELDS, request_schema


def _keeping_lines(reader, schema: T.StructType, corrupt: str | None):
    """The reader with ``schema`` and, if ``corrupt`` names one, a column for lines that do not fit it."""
    if corrupt is None:
        return reader.schema(schema)
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return reader.schema(wide).option("columnNameOfCorruptRecord", corrupt)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               infer: bool = False, corrupt: str | None = None) -> DataFrame:
    """Read parquet, or CSV with a header line.

    A CSV needs ``schema`` (one pass) or ``infer=True`` (an extra pass over the file). With a schema,
    the column ``corrupt`` holds the whole line where a cell does not fit its type or the number of
    cells differs, and null elsewhere.
    """
    if schema is None and not infer:
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt:
        reader = reader.option("columnPruning", False)  # every cell is checked, whichever columns are used
    return _keeping_lines(reader, schema, corrupt).csv(path)


def read_requests(spark: SparkSession, path: str, list_field: str = "customers",
                  row_schema: T.StructType | None = None, corrupt: str | None = None) -> DataFrame:
    """Read JSON lines ``{"batch_id": .., "customers": [{..}, ..]}`` as one row per batch; the column
    ``corrupt``, if named, holds the lines that are no such batch."""
    row = row_schema or request_schema(CUSTOMER_FIELDS, text=True)
    schema = T.StructType([
        T.StructField("batch_id", T.StringType()),
        T.StructField(list_field, T.ArrayType(row)),
    ])
    return _keeping_lines(spark.read, schema, corrupt).json(path)


def parse_requests(df: DataFrame, body: str, list_field: str = "customers",
                   row_schema: T.StructType | None = None) -> DataFrame:
    """Like ``read_requests`` for a table (or stream) whose column ``body`` holds the JSON."""
    row = row_schema or request_schema(CUSTOMER_FIELDS, text=True)
    schema = T.StructType([T.StructField(list_field, T.ArrayType(row))])
    parsed = F.from_json(F.col(body), schema)
    return df.withColumn(list_field, parsed[list_field]).drop(body)


def explode_batch(df: DataFrame, list_field: str = "customers", size: str | None = None) -> DataFrame:
    """One row per request of a batch, with its zero-based position. A batch that is empty or could not be
    read gives one row without position and fields, which validation then rejects. ``size`` names a column that
    tells each row how many its batch has (0 for none), as ``validate.reject_large`` takes it."""
    keep = [c for c in df.columns if c != list_field]
    if size:
        keep = [*keep, F.greatest(F.coalesce(F.size(list_field), F.lit(0)), F.lit(0)).alias(size)]
    out = df.select(*keep, F.posexplode_outer(list_field).alias("position", "request"))
    return out.select(*[c for c in out.columns if c != "request"], "request.*")


def load_report(raw: DataFrame, keep: "F.Column") -> DataFrame:
    """Rows and columns read, rows kept by the label filter, rows dropped: one pass."""
    return (raw.agg(F.count(F.lit(1)).alias("rows_read"),
                    F.count_if(keep).alias("rows_kept"))
            .withColumn("columns_read", F.lit(len(raw.columns)))
            .withColumn("rows_dropped", F.col("rows_read") - F.col("rows_kept")))


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")


def row_count(df: DataFrame) -> DataFrame:
    return exact_total(df, "rows")
