"""Mail derived from the given tables, as input for the registered queries.

Every conversation turn becomes a message that quotes up to three earlier
turns the way a mail client forwards them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
QUOTED_TURNS = 3
RFC_FORMAT = "EEE, dd MMM yyyy HH:mm:ss"
LONG_FORMAT = "EEEE, MMMM d, yyyy h:mm a"
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mailbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per turn, and some pure forwards, with the envelope columns and `body`."""
    turns = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    sent = F.expr("TIMESTAMP_NTZ '2026-07-01 00:00:00' + make_dt_interval(0, int(conv_id), int(turn), 0)")
    marker = F.when(turn % 3 == 1, "Re: ").when(turn % 3 == 2, "FW: Re: ").otherwise("")
    zone = F.when(turn % 4 == 1, " -0700").otherwise(" +0000")
    told = turns.select(
        "conv_id",
        "turn",
        "text",
        sent.alias("sent"),
        F.concat(marker, F.lit("Topic "), conv % 40).alias("subject"),
        F.concat("role", conv, F.lit(" <"), "role", conv, F.lit("@example.com>")).alias("from_"),
    )
    banner = F.when(conv % 7 == 0, "CAUTION: EXTERNAL EMAIL\n\n").otherwise("")
    block = F.concat(
        F.lit("\n________________________________\nFrom: "),
        F.col("from_"),
        F.lit("\nSent: "),
        F.date_format("sent", LONG_FORMAT),
        F.lit("\nTo: Team <team@example.com>;\n Archive <archive@example.com>\nSubject: "),
        F.col("subject"),
        F.lit("\n\n"),
        banner,
        F.col("text"),
    )
    own = F.struct("text", "sent", "subject", "from_")
    # Each turn sends its block to the turns that quote it, so the grouping key
    # is a single turn and no conversation is gathered in one place.
    copies = told.withColumn("block", block).select(
        "conv_id",
        F.explode(F.sequence(F.lit(0), F.lit(QUOTED_TURNS))).alias("back"),
        "turn",
        own.alias("own"),
        "block",
    )
    pairs = copies.select(
        "conv_id",
        (turn + F.col("back")).alias("turn"),
        F.when(F.col("back") == 0, F.col("own")).alias("own"),
        F.when(F.col("back") > 0, F.struct("back", "block")).alias("quoted"),
    )
    gathered = (
        pairs.groupBy("conv_id", "turn")
        .agg(F.max("own").alias("own"), F.array_sort(F.collect_list("quoted")).alias("quoted"))
        .filter("own IS NOT NULL")
    )
    # Later turns of one conversation in five are also forwarded without a word of their own.
    forwarded = F.when((conv % 5 == 0) & (turn > 0), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    gathered = gathered.withColumn("pure", F.explode(forwarded))
    key = F.concat(
        F.lit("emails/"),
        F.when(conv % 11 == 0, "misc").otherwise(F.date_format("own.sent", "yyyy-MM-dd")),
        F.when(F.col("pure"), "/FWD").otherwise("/MSG"), conv, F.lit("-"), turn, F.lit("==.eml"),
    )
    text = F.when(F.col("pure"), "").otherwise(F.col("own.text"))
    sign = F.when(F.col("pure"), "<f").otherwise("<m")
    return gathered.select(
        "conv_id",
        "turn",
        key.alias("source_key"),
        F.col("own.sent").alias("modification_time"),
        F.when(turn % 4 != 3, F.concat(sign, conv, F.lit("."), turn, F.lit("@example.com>"))).alias("message_id"),
        F.col("own.from_").alias("from_"),
        F.lit("Team <team@example.com>").alias("to_"),
        F.when(conv % 6 == 0, "Lead <lead@example.com>").alias("cc"),
        F.col("own.subject").alias("subject"),
        F.when(turn != 5, F.concat(F.date_format("own.sent", RFC_FORMAT), zone)).alias("date_header"),
        F.concat(text, F.array_join(F.transform("quoted", lambda q: q["block"]), "")).alias("body"),
    )


def message_bytes(mails: DataFrame) -> DataFrame:
    """(source_key, modification_time, content): the mails as MIME source."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))

    head = F.concat_ws(
        "",
        *[
            line(name, F.col(c))
            for name, c in (
                ("Message-ID", "message_id"), ("From", "from_"), ("To", "to_"), ("Cc", "cc"),
                ("Subject", "subject"), ("Date", "date_header"),
            )
        ],
        F.lit("MIME-Version: 1.0\r\nContent-Type: text/plain; charset=utf-8\r\nContent-Transfer-Encoding: 8bit\r\n\r\n"),
    )
    return mails.select("source_key", "modification_time", F.concat(head, "body").cast("binary").alias("content"))
