"""Explicit schemas: nothing is inferred in production paths."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, types, defaults and accepted statuses of the warehouse.
VALID_STATUSES = ("completed", "failed", "pending", "cancelled")
REQUIRED_COLUMNS = ("user_id", "amount", "transaction_date")
ID_COLUMNS = ("transaction_id", "user_id")
DATE_COLUMNS = ("transaction_date", "created_at")
CSV_COLUMNS = ("transaction_id", "user_id", "amount", "currency", "transaction_date", "status")
# Spellings the CSV reader treats as missing (the documented pandas defaults).
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)
EPOCH_WATERMARK = "1900-01-01"

KEY_PROPERTY, REQUIRED_PROPERTY, LEDGER_PROPERTY = "tallyworks.key", "tallyworks.required", "tallyworks.key_ledger"

TRANSACTIONS_CSV = T.StructType([T.StructField(name, T.StringType()) for name in CSV_COLUMNS])

LOG_RECORD = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("response_time", T.DoubleType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("user_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table: columns as (name, SQL type), defaults by column, and its layout."""

    name: str
    columns: tuple[tuple[str, str], ...]
    defaults: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    partitioned_by: tuple[str, ...] = ()

    def create_sql(self, database: str | None = None) -> str:
        """CREATE TABLE for a parquet table; partition columns go last, as Spark stores them."""
        ordered = [c for c in self.columns if c[0] not in self.partitioned_by]
        ordered += [c for c in self.columns if c[0] in self.partitioned_by]
        body = ", ".join(
            f"{name} {kind}" + (f" DEFAULT {self.defaults[name]}" if name in self.defaults else "")
            for name, kind in ordered
        )
        target = f"{database}.{self.name}" if database else self.name
        properties = ", ".join(
            f"'{name}' = '{','.join(columns)}'"
            for name, columns in ((KEY_PROPERTY, self.key), (REQUIRED_PROPERTY, self.required)) if columns
        )
        layout = f" PARTITIONED BY ({', '.join(self.partitioned_by)})" if self.partitioned_by else ""
        return f"CREATE TABLE IF NOT EXISTS {target} ({body}) USING parquet{layout}" + (
            f" TBLPROPERTIES ({properties})" if properties else ""
        )


_NOW = "cast(current_timestamp() AS timestamp_ntz)"

DIM_DATE = TableSpec(
    "dim_date",
    (
        ("date_id", "INT"), ("full_date", "DATE"), ("day", "INT"), ("month", "INT"), ("year", "INT"),
        ("quarter", "INT"), ("day_of_week", "INT"), ("day_name", "VARCHAR(10)"),
        ("month_name", "VARCHAR(10)"), ("is_weekend", "BOOLEAN"),
    ),
    required=("date_id", "full_date", "day", "month", "year", "quarter", "day_of_week",
              "day_name", "month_name", "is_weekend"),
    key=("date_id",),
)

DIM_USERS = TableSpec(
    "dim_users",
    (
        ("user_id", "BIGINT"), ("user_name", "VARCHAR(100)"), ("user_category", "VARCHAR(50)"),
        ("registration_date", "DATE"), ("country", "VARCHAR(50)"), ("created_at", "TIMESTAMP_NTZ"),
        ("updated_at", "TIMESTAMP_NTZ"), ("valid_from", "DATE"), ("valid_to", "DATE"),
        ("is_current", "BOOLEAN"),
    ),
    defaults={"created_at": _NOW, "updated_at": _NOW, "valid_to": "DATE'9999-12-31'", "is_current": "true"},
    required=("user_id", "valid_from"),
    key=("user_id", "valid_from"),
)

# One folder per day, so that a load touches few folders and a filter on date_id prunes.
FACT_TRANSACTIONS = TableSpec(
    "fact_transactions",
    (
        ("transaction_id", "BIGINT"), ("user_id", "BIGINT"), ("date_id", "INT"),
        ("amount", "DECIMAL(15,2)"), ("currency", "VARCHAR(3)"), ("status", "VARCHAR(20)"),
        ("transaction_type", "VARCHAR(50)"), ("created_at", "TIMESTAMP_NTZ"),
        ("processed_at", "TIMESTAMP_NTZ"),
    ),
    defaults={"currency": "'USD'", "created_at": _NOW, "processed_at": _NOW},
    required=("transaction_id", "user_id", "date_id", "amount", "status"),
    key=("transaction_id",),
    partitioned_by=("date_id",),
)

# One folder per run, so that a repeated run replaces its own rows and nothing else.
RAW_TRANSACTIONS = TableSpec(
    "raw_transactions",
    (
        ("transaction_id", "BIGINT"), ("user_id", "BIGINT"), ("amount", "DECIMAL(15,2)"),
        ("currency", "VARCHAR(3)"), ("transaction_date", "TIMESTAMP_NTZ"), ("status", "VARCHAR(20)"),
        ("created_at", "TIMESTAMP_NTZ"), ("processed_at", "TIMESTAMP_NTZ"), ("batch_id", "VARCHAR(50)"),
    ),
    partitioned_by=("batch_id",),
)

# End of fixed values.

STAR_SCHEMA = (DIM_DATE, DIM_USERS, FACT_TRANSACTIONS, RAW_TRANSACTIONS)
