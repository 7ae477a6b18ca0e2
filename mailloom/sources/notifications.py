"""Object-created notifications wrapped in queue records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
TEST_EVENT = "s3:TestEvent"
_RECORDS = "array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>"
BODY_TYPE = f"struct<Event:string,Records:{_RECORDS},s3:struct<bucket:struct<name:string>,object:struct<key:string>>>"
# ----------------------------------------------------------------------------


def decode_key(c: Column) -> Column:
    """`+` and `%xx` decoding; a percent sign that starts no escape stays."""
    return F.url_decode(F.regexp_replace(c, "%(?![0-9a-fA-F]{2})", "%25"))


def flatten_events(df: DataFrame, body_col: str = "body", record_col: str | None = None) -> DataFrame:
    """(bucket, key) of every object named in a queue record, other columns kept.

    Test events, text that is not JSON and records without an object are
    skipped; for records whose object lacks its bucket or key see `failed_events`. Where the body is NULL the JSON in `record_col`, if given, is the
    record itself.
    """
    return _objects(df, body_col, record_col).filter("bucket IS NOT NULL AND key IS NOT NULL").drop("named")


def failed_events(df: DataFrame, body_col: str = "body", record_col: str | None = None) -> DataFrame:
    """Records that name an object but not its bucket or key, with an `error`; for quarantine and retry."""
    objects = _objects(df, body_col, record_col).filter("named AND (bucket IS NULL OR key IS NULL)")
    return objects.withColumn("error", F.lit("record without bucket or key")).drop("named")


def _objects(df: DataFrame, body_col: str, record_col: str | None) -> DataFrame:
    carried = [c for c in df.columns if c not in (body_col, record_col)]
    body = F.from_json(F.col(body_col), BODY_TYPE)
    records = body["Records"]
    test = F.coalesce(body["Event"] == TEST_EVENT, F.lit(False))
    records = F.when(~test, records)
    if record_col is not None:
        single = F.from_json(F.col(record_col), BODY_TYPE)["s3"]
        records = F.when(F.col(body_col).isNull(), F.array(F.struct(single.alias("s3")))).otherwise(records)
    return (
        df.select(*carried, F.explode(records).alias("r"))
        .select(
            *carried,
            F.col("r.s3.bucket.name").alias("bucket"),
            decode_key(F.col("r.s3.object.key")).alias("key"),
            F.col("r.s3").isNotNull().alias("named"),
        )
    )
