"""Scalar expressions with the text and null rules of the contracts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c) -> Column:
    """White space of any kind off both ends; trim alone would take spaces. Patterns, which cost far more, are left to text
    that ends in a line separator, before which they take white space too."""
    c = F.col(c) if isinstance(c, str) else c
    odd = F.endswith(c, F.lit("\u0085")) | F.endswith(c, F.lit("\u2028")) | F.endswith(c, F.lit("\u2029"))
    return F.when(odd, F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(F.btrim(c, F.lit(" \t\n\x0b\f\r")))


def clean(c) -> Column:
    return F.upper(strip(c))


def required(c: Column, message: str, key: Column | None = None) -> Column:
    """c, where a null ends the job with the message and the row's key. A query that does not read the column does not
    see this: holds, as a filter, is seen by all."""
    return F.coalesce(c, F.raise_error(_told(message, key)))


def _told(message: str, key: Column | None) -> Column:
    return F.lit(message) if key is None else F.concat(F.lit(f"{message}: "), F.coalesce(key.cast("string"), F.lit("null")))


def holds(condition: Column, message: str, key: Column | None = None) -> Column:
    """A filter condition that lets every row pass, and ends the job with the message and the row's key where the condition
    is not true. A filter is part of any query over the rows, whichever columns that reads or counts.

    The partition's number, which Spark takes for random, keeps the filter where it stands: a deterministic one is pushed
    below projections, so that what it looks at is made once more for it, and inferred for the other sides of joins."""
    return F.when(F.coalesce(condition, F.lit(False)), F.spark_partition_id() >= 0).otherwise(F.raise_error(_told(message, key)).cast("boolean"))


def real_null(c: Column) -> Column:
    """Null for text that stands for it in imported tables: nan in any case, or blank."""
    return F.when(~F.lower(strip(c)).isin("nan", ""), c)


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def batch_stamp(c: Column) -> Column:
    """Batch id of a moment, to the microsecond."""
    return F.date_format(c, "yyyyMMdd_HHmmss_SSSSSS")


def batch_of(name: Column) -> Column:
    """Batch id to the second in a file name, null without one."""
    return F.nullif(F.regexp_extract(name, r"(\d{8}_\d{6})", 1), F.lit(""))


def zero_pad(c: Column, width: int) -> Column:
    """Zeros on the left up to width; longer values stay whole, which lpad alone would cut."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def trailing_number(c: Column, pattern: str = r"(\d+)$") -> Column:
    """The number in the pattern's group, null where it does not match."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("bigint")


def initials(c: Column, empty: str = "X") -> Column:
    found = F.upper(F.array_join(F.transform(F.filter(F.split(c, r"\s+"), lambda w: w != ""), lambda w: F.substring(w, 1, 1)), ""))
    return F.when(found == "", F.lit(empty)).otherwise(found)


def business_key(*columns: str) -> Column:
    """MD5 of the cleaned values, joined by bars. A null ends the job: concat_ws would skip it, and different values
    could share a key."""
    return F.md5(F.concat_ws("|", *(required(clean(c), f"null in identity column {c}") for c in columns)))


def row_hash(columns: list[str]) -> Column:
    """MD5 of the values as text; concat_ws would skip nulls, which count as nan."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns)))


def full_sku(raw: Column) -> Column:
    """Eleven digits with a dash after the sixth, from a number that has lost its leading zeros."""
    digits = zero_pad(F.regexp_replace(strip(raw), r"\.0$", ""), 11)
    return F.concat(F.substring(digits, 1, 6), F.lit("-"), F.substring(digits, 7, 1000))


def sku_half(sku: Column, k: int) -> Column:
    return F.get(F.split(sku, "-"), k)


def valid_date(c: Column) -> Column:
    """yyyyMMdd text that is a date, else null."""
    return F.when(F.try_to_timestamp(c, F.lit("yyyyMMdd")).isNotNull(), c)


def is_customer_pseudonym(c: Column) -> Column:
    return F.coalesce(F.startswith(c, F.lit("Customer CUST-")), F.lit(False))


def is_product_pseudonym(c: Column) -> Column:
    return F.coalesce(F.contains(c, F.lit(" Product ")), F.lit(False))


def is_sku_pseudonym(c: Column) -> Column:
    return F.coalesce(F.startswith(c, F.lit("SKU-")), F.lit(False))
