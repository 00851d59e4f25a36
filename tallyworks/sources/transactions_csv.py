"""Transaction CSV with a header; every column is read as text and typed by the cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.operators import chunks, clean
from tallyworks.schemas import TRANSACTIONS_CSV

CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "escape": '"'}
#: The whole line where it has more fields than the header; NULL for all other lines, short ones included.
SURPLUS = "surplus_line"
END = "\u0002"


def with_surplus(schema: T.StructType) -> T.StructType:
    """The schema to read with, so that lines Spark cannot fit into it are kept."""
    return T.StructType([*schema.fields, T.StructField(SURPLUS, T.StringType())])


def mark_surplus(rows: DataFrame, n_columns: int) -> DataFrame:
    """Leave in ``surplus_line`` only lines with more than ``n_columns`` fields; lines that lack some are valid.

    The first column is named in the condition, as Spark refuses a scan that uses nothing but such lines, as in a count.
    """
    wide = ", ".join(f"c{i} string" for i in range(n_columns + 1))
    # An end mark is the last field; with too many fields before it, it is not among the first ones.
    parsed = F.from_csv(F.concat(F.col(SURPLUS), F.lit(f",{END}")), wide, {"escape": '"'})
    fits = F.array_contains(F.array(*[parsed[f"c{i}"] for i in range(n_columns + 1)]), END)
    any_first = F.coalesce(F.length(rows.columns[0]) >= 0, F.lit(True))
    return rows.withColumn(SURPLUS, F.when(any_first & ~F.coalesce(fits, F.lit(False)), F.col(SURPLUS)))


def scan_transactions(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = TRANSACTIONS_CSV,
    ordinal: str | None = None,
    chunk_rows: int = chunks.CHUNK_ROWS,
    multi_line: bool = False,
) -> DataFrame:
    """Rows as text with the chunk each row came in, and ``surplus_line``.

    ``enforceSchema`` off makes a file whose header differs from the schema fail instead of shifting
    columns; ``schema=None`` takes the column names from the header, so that files may lack columns
    or have them in another order. Plain CSV is split by size, so one large file is read by many tasks;
    ``multi_line`` takes quoted line breaks and gives that up, a file then being one task.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in reader.csv(path).columns])
    reader = reader.schema(with_surplus(schema)).option("columnNameOfCorruptRecord", SURPLUS)
    return chunks.with_chunk(mark_surplus(reader.csv(path), len(schema)), ordinal, chunk_rows)


def read_transactions(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """The rows of lines that fit the header; the ingest job keeps and counts the others."""
    rows = scan_transactions(spark, path, **options)
    return rows.where(F.col(SURPLUS).isNull()).drop(SURPLUS)


def read_values(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """The same rows with every missing-value spelling as NULL."""
    return clean.map_missing_values(read_transactions(spark, path, **options))
