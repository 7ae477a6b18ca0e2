"""First writer wins, within a batch and against everything accepted before."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailloom.functions.render import SCHEMA_VERSION
from mailloom.functions.text import identity

# The earliest file wins, then the lower key, then the earlier unit.
WRITER_ORDER = ("modification_time", "source_key", "unit_order")

REGISTRY_SCHEMA = (
    "identity string, created_at timestamp, schema_version int, source_key string, "
    "output_key string, subject string, date_header string, h bigint, batch_id bigint, bucket int"
)

# The registry is stored by so many buckets of the identity's hash.
BUCKETS = 16
# Bits of a filter row, as many as `bitmap_construct_agg` holds; bits per identity, and how many of them it sets.
SLOT_BITS, BITS_EACH, PLACES = 1 << 15, 16, 4


def with_identity(units: DataFrame) -> DataFrame:
    parts = (F.col(c) for c in ("message_id", "from_", "date_header", "subject", "body"))
    return units.withColumn("identity", identity(*parts))


def candidates(units: DataFrame, order_by: Sequence[str] = WRITER_ORDER) -> DataFrame:
    """Where the first unit of every identity stands, and the `copies` seen: narrow rows without text.

    An aggregate, not a window: each map task sends at most one row per
    identity through the shuffle, however many copies a hot identity has.
    """
    return (
        units.groupBy("identity")
        .agg(F.min(F.struct(*order_by)).alias("first"), F.count("*").alias("copies"))
        .select("identity", "first.*", "copies")
    )


def winners(units: DataFrame, firsts: DataFrame, order_by: Sequence[str] = WRITER_ORDER) -> DataFrame:
    """The units that `firsts` name, with its further columns; `order_by` tells the units of an identity apart."""
    place = ("identity", *order_by)
    named = firsts.withColumnsRenamed({c: f"__{c}" for c in place})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place])
    return units.join(named, same).drop(*[f"__{c}" for c in place])


def first_writers(units: DataFrame, order_by: Sequence[str] = WRITER_ORDER) -> DataFrame:
    """The first unit of every identity, with the number of `copies` seen."""
    return winners(units, candidates(units, order_by), order_by)


def flagged(firsts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Candidates with `is_new`: their identity is not among `known`."""
    if known is None:
        return firsts.withColumn("is_new", F.lit(True))
    met = known.select("identity").distinct().withColumn("__known", F.lit(True))
    return firsts.join(met, "identity", "left").withColumn("is_new", F.col("__known").isNull()).drop("__known")


def known_among(firsts: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows of the candidates' identities; only the identity column of the registry is compared.

    Candidates are the side that moves. The planner broadcasts them if their size allows.
    """
    return registry.join(firsts.select("identity"), "identity", "left_semi")


def claim(
    units: DataFrame, registry: DataFrame | None = None, order_by: Sequence[str] = WRITER_ORDER
) -> DataFrame:
    """First writers flagged `is_new` when the registry does not know them.

    Only (identity, order, copies) is aggregated, shuffled and compared with the
    registry; texts stay where they are until the winners are looked up.
    """
    firsts = candidates(units, order_by)
    known = None if registry is None else known_among(firsts, registry)
    return winners(units, flagged(firsts, known), order_by)


def accepted(claims: DataFrame) -> DataFrame:
    return claims.filter("is_new").drop("is_new")


# --- the stored registry: hash buckets, and a filter for each batch ----------


def with_hash(df: DataFrame) -> DataFrame:
    """Add the identity's hash `h` and its bucket."""
    h = F.xxhash64("identity")
    return df.withColumns({"h": h, "bucket": h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")})


def _slot(slots: Column) -> Column:
    return F.shiftrightunsigned("h", 4).bitwiseAND(slots - 1)


def _places() -> Column:
    g = F.xxhash64("h")
    return F.array(*[F.shiftrightunsigned(g, 15 * k).bitwiseAND(F.lit(SLOT_BITS - 1)) for k in range(PLACES)])


def slots_for(identities: int) -> int:
    """A power of two of filter rows, so that an identity has 16 bits or more."""
    return 1 << max(0, (identities * BITS_EACH - 1) // SLOT_BITS).bit_length()


def identity_filters(rows: DataFrame, slots: int) -> DataFrame:
    """Bloom filter of the rows' hashes `h`, in `slots` rows (slots, slot, bits): about 2 bytes an identity."""
    n = F.lit(slots).cast("bigint")
    return (
        rows.select(_slot(n).alias("slot"), F.explode(_places()).alias("place"))
        .groupBy("slot")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
        .select(n.alias("slots"), "slot", "bits")
    )


def maybe_known(firsts: DataFrame, filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Candidates (identity, h) that a filter does not rule out; `sizes` are the filters' different `slots`."""
    asked = firsts.select("identity", "h", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("slots"))
    asked = asked.withColumns({"slot": _slot(F.col("slots")), "places": _places()})
    tested = asked.join(filters, ["slots", "slot"]).select("identity", "h", "bits", "places")
    is_set = F.lit(True)
    for k in range(PLACES):
        place = F.col("places")[k]
        held = F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))
        number = F.conv(F.hex(held), 16, 10).cast("int")
        is_set = is_set & (F.floor(number / F.pow(F.lit(2), place % 8)).cast("int") % 2 == 1)
    return tested.where(is_set).select("identity", "h").distinct()


def registry_rows(claimed: DataFrame, batch_id: int = 0) -> DataFrame:
    """Registry records of accepted units."""
    return claimed.select(
        "identity",
        F.current_timestamp().alias("created_at"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "source_key",
        "output_key",
        "subject",
        "date_header",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def select_identities(
    registry: DataFrame,
    everything: bool = False,
    keys: Sequence[str] | DataFrame | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Identities chosen by exactly one of: everything, keys, source-key prefix."""
    if sum((everything, keys is not None, prefix is not None)) != 1:
        raise ValueError("choose one of everything, keys, prefix")
    if isinstance(keys, DataFrame):
        registry = registry.join(keys.select("identity"), "identity", "left_semi")
    elif keys is not None:
        registry = registry.filter(F.col("identity").isin(list(keys)))
    elif prefix is not None:
        registry = registry.filter(F.col("source_key").startswith(prefix))
    return registry.select("identity")


def without(rows: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    """Rows that no tombstone (name, upto) covers: same key, written in a batch up to that number."""
    gone = tombstones.groupBy("name").agg(F.max("upto").alias("upto"))
    return rows.join(gone, (rows[key] == gone["name"]) & (rows["batch_id"] <= gone["upto"]), "left_anti")


def forget_identities(registry: DataFrame, selected: DataFrame) -> DataFrame:
    """What is left of a registry (with `batch_id`) once the selected identities have tombstones."""
    latest = registry.groupBy("identity").agg(F.max("batch_id").alias("upto"))
    return without(registry, latest.join(selected, "identity", "left_semi").withColumnRenamed("identity", "name"), "identity")
