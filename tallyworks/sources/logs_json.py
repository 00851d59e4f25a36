"""JSON-lines logs, plain or gzipped (Spark decompresses by file extension).

A gzip file is one split. Where one is larger than a split of a plain file would be, its rows are spread over the
cluster after the scan; smaller ones are worked on in the task that decompresses them, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.schemas import LOG_RECORD

CORRUPT = "_corrupt_record"


#: Times a gzip file may be smaller than a split and still unpack to more than one; JSON logs shrink about so much.
PACKED = 8


def has_hot_file(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether one gzip file unpacks, by a rule of thumb, to more than a task should read."""
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) // PACKED
    for p in [path] if isinstance(path, str) else path:
        target = spark._jvm.org.apache.hadoop.fs.Path(p)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(target) or []:
            files = system.listFiles(found.getPath(), True)
            while files.hasNext():
                file = files.next()
                if file.getPath().getName().endswith(".gz") and file.getLen() > limit:
                    return True
    return False


def spread_hot_files(rows: DataFrame, path: str | list[str]) -> DataFrame:
    """Rows of ``path``, dealt over tasks of even size if a gzip file among them would be one task's alone."""
    return rows.hint("rebalance") if has_hot_file(rows.sparkSession, path) else rows


def read_logs(spark: SparkSession, path: str | list[str], schema: T.StructType = LOG_RECORD) -> DataFrame:
    """Strict scan: a line that is not a log record stops the job."""
    return spread_hot_files(spark.read.schema(schema).option("mode", "FAILFAST").json(path), path)


def _parsed(line: Column, schema: T.StructType) -> Column:
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(line, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _one_value(line: Column, schema: T.StructType) -> Column:
    """False if more text follows the JSON value, which the JSON parser alone would ignore.

    A line whose first closing brace is its last character cannot have any; only the other lines
    are parsed again, as an array that must then hold exactly one element.
    """
    text = F.btrim(line, F.lit(" \t\r\n"))
    as_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))
    return F.when(F.instr(text, "}") == F.length(text), True).otherwise(
        F.coalesce(F.size(as_array) == 1, F.lit(False))
    )


def parse_lines(lines: DataFrame, schema: T.StructType = LOG_RECORD, line_col: str = "value") -> DataFrame:
    """Add ``record`` and ``is_bad`` to a frame of text lines; blank lines are left out.

    The lines are read as text on purpose: with the JSON source, which fields a query uses would
    decide which lines count as corrupt.
    """
    line = F.col(line_col)
    parsed = lines.where(F.btrim(line, F.lit(" \t\r\n")) != "").withColumn("record", _parsed(line, schema))
    # One reference to the record, so a filter on it parses a line once: ``null`` parses to no record, the rest that does
    # not fit leaves its text behind.
    bad = F.coalesce(F.col(f"record.{CORRUPT}"), F.when(F.btrim(line, F.lit(" \t\r\n")) == "null", line)).isNotNull()
    return parsed.withColumn("is_bad", bad | ~_one_value(line, schema))


def split_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType = LOG_RECORD
) -> tuple[DataFrame, DataFrame]:
    """Tolerant scan: the records of the good lines, and the bad lines with their file."""
    lines = spread_hot_files(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")), path)
    parsed = parse_lines(lines, schema)
    good = parsed.where(~F.col("is_bad")).select(*[F.col(f"record.{n}").alias(n) for n in schema.names])
    return good, parsed.where("is_bad").select("file", "value")


def read_logs_tolerant(
    spark: SparkSession, path: str | list[str], schema: T.StructType = LOG_RECORD, seen: Observation | None = None
) -> DataFrame:
    """The records of the good lines. ``seen`` counts ``lines`` and ``bad`` ones in the same pass, whatever reads it."""
    if seen is None:
        return split_lines(spark, path, schema)[0]
    parsed = parse_lines(spread_hot_files(spark.read.text(path), path), schema)
    parsed = parsed.observe(seen, F.count("*").alias("lines"), F.count_if("is_bad").alias("bad"))
    return parsed.where(~F.col("is_bad")).select(*[F.col(f"record.{n}").alias(n) for n in schema.names])
