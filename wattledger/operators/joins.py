"""Joins of a large table with a smaller one."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.session import stored

# A group is cut into this many parts before adaptive execution looks at their size.
GROUP_PARTS = 8


def join_lookup(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "left", spread_by: Sequence[str] = ()
) -> DataFrame:
    """Facts with the columns of a lookup that has one row per key.

    There is no broadcast hint: lookups such as buildings or vendors grow with the
    business. Spark broadcasts one that is under its size threshold (by file statistics,
    and again by the real size at run time). Above it, both sides are shuffled directly
    under the join, which is the plan whose oversized partitions adaptive execution
    splits, so a key holding much of the facts is read by many tasks. A lookup that is itself an
    aggregate by the key would be joined as it was dealt for that: it is passed through
    dealt_anew; or columns of the facts in `spread_by` cut each key into GROUP_PARTS (see
    join_groups), and the lookup is there in each.
    """
    if not spread_by:
        return facts.join(lookup, key, how)
    cut = facts.withColumn("_part", _part(spread_by, GROUP_PARTS))
    return cut.join(lookup.withColumn("_part", _every(GROUP_PARTS)), [key, "_part"], how).drop("_part")


def _part(spread_by: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*spread_by), F.lit(parts)).cast("int")


def _every(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def one_per_key(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """A lookup with one row per key, so that joining it never doubles facts: a key with several
    values has the smallest (ambiguous_keys names it), rows without a key are left out."""
    return (
        lookup.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    )


def dealt_anew(lookup: DataFrame) -> DataFrame:
    """A lookup that is an aggregate by its key, dealt once more, so that a join can't take over
    how it was dealt: both sides are then shuffled directly under the join (see join_lookup) and
    a hot key is split, without a copy of the lookup for every part. Copies would be in a
    broadcast too, whose size Spark estimates without them."""
    return lookup.hint("rebalance")


def gathered(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys brought together, for rows that become many (bills cut into months) and
    are then summed by these and finer keys: they are shuffled as they are, and Spark sums them
    where they then are, in place of shuffling the many.

    A key that holds more than a task's share of the rows must not be one task. Where there is such
    a key, rows are dealt by a column that sums know nothing of: adaptive execution may then cut
    large parts, and each task's own sums are shuffled. The rows are read twice for it, stored."""
    rows = stored(rows, "gathered")
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"))
    most, held_by_all = held.agg(F.max("held"), F.sum("held")).first()
    if most is not None and most * shares > held_by_all:
        return rows.withColumn("_dealt", F.xxhash64(*keys)).hint("rebalance", "_dealt").drop("_dealt")
    return rows.repartition(*keys)


def ambiguous_keys(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that a lookup gives several values: how many, the one that is taken, the last."""
    return (
        lookup.where(F.col(key).isNotNull())
        .select(key, value)
        .distinct()
        .groupBy(key)
        .agg(
            F.count(value).alias("values"),
            F.min(value).alias("taken"),
            F.max(value).alias("last"),
        )
        .where("values > 1")
    )


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    parts: int = GROUP_PARTS,
) -> DataFrame:
    """The rows of the groups listed in `groups`, with that group's columns.

    `groups` is an aggregate over the same keys. Joined on the keys alone it would keep
    the aggregate's partitioning, and one group would be one task whatever its size. The
    part number makes both sides shuffle for the join itself: a group is cut into `parts`
    by a hash of `spread_by` (the same on every retry), and adaptive execution cuts a
    part further when it is still too big.
    """
    return (
        rows.withColumn("_part", _part(spread_by, parts))
        .join(groups.withColumn("_part", _every(parts)), [*keys, "_part"])
        .drop("_part")
    )
