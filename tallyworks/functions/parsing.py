"""Lenient and strict parsing of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.schemas import NA_VALUES

# Patterns and formats that decide which text is accepted.
NUMBER_PATTERN = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
ENDPOINT_PATTERN = r"(/[a-zA-Z0-9_\-./]+)"
LOG_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
USER_AGENT_LENGTH = 100
# All characters Python counts as white space; Spark's trim alone drops blanks only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# End of fixed values.


def na_to_null(c: Column) -> Column:
    """NULL for every spelling the CSV reader counts as missing."""
    return F.when(~c.isin(*NA_VALUES), c)


def parse_number(c: Column) -> Column:
    """Text to double; NULL for anything that is not a plain number.

    The pattern keeps out 'NaN', 'inf' and the type suffixes Spark's cast takes ('1d'). Digits too
    many for a double give infinity, which ``to_money`` refuses. Extracting the number, instead of
    testing for one, names the column once, so a computed column is not computed twice.
    """
    return F.regexp_extract(c, NUMBER_PATTERN, 1).try_cast("double")


def finite(c: Column) -> Column:
    """A double column with NaN and infinities as NULL: in Spark ``NaN > 0`` is true."""
    return F.when(~F.isnan(c) & ~c.isin(float("inf"), float("-inf")), c)


def parse_id(c: Column) -> Column:
    """Text to bigint, '12.0' included (an integer column with gaps is written that way)."""
    return c.try_cast("decimal(20,0)").try_cast("bigint")


def to_money(c: Column) -> Column:
    """Double to DECIMAL(15,2), rounding half up; NULL if it does not fit, so validation catches it."""
    return c.try_cast("decimal(15,2)")


def parse_timestamp(c: Column, formats: Sequence[str] = ()) -> Column:
    """Text to timestamp without zone; bad text becomes NULL.

    ISO forms are always tried first, then ``formats`` in the given order.
    """
    tries = [c.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def _or_raise(parsed: Column, source: Column, what: str) -> Column:
    message = F.concat(F.lit(f"{what}: "), source)
    return F.coalesce(parsed, F.when(source.isNotNull(), F.raise_error(message).cast("timestamp_ntz")))


def log_timestamp(c: Column, strict: bool = True) -> Column:
    """Log timestamp in its one fixed format; bad text stops the job unless ``strict`` is false."""
    parsed = F.try_to_timestamp(c, F.lit(LOG_TIMESTAMP_FORMAT)).cast("timestamp_ntz")
    return _or_raise(parsed, c, "log timestamp not in the expected format") if strict else parsed


def log_timestamp_infer(c: Column) -> Column:
    """Log timestamp in any ISO form; bad text stops the job."""
    return _or_raise(c.try_cast("timestamp_ntz"), c, "log timestamp cannot be parsed")


def normalize_status(c: Column) -> Column:
    """Lower case without surrounding white space of any kind."""
    return F.btrim(F.lower(c), F.lit(WHITESPACE))


def endpoint_path(c: Column) -> Column:
    """First path-like part of an endpoint; NULL, not '', where there is none."""
    return F.nullif(F.regexp_extract(c, ENDPOINT_PATTERN, 1), F.lit(""))


def short_user_agent(c: Column) -> Column:
    """The leading characters of a user agent that the cleaned logs keep."""
    return F.substring(c, 1, USER_AGENT_LENGTH)
