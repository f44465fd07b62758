"""Dimension lookups with an unknown member.

No lookup forces a broadcast. The dimension side is cut to (natural key, surrogate
key); Spark broadcasts it when its size is under the session's threshold and
otherwise runs a shuffle join, where adaptive execution splits skewed keys of the
fact side. Rows without a foreign key can never match, so they are spread over
many join partitions instead of meeting in one.

A wide fact with many large dimensions would be shuffled once for each. There the keys
travel instead of the rows: see `membership`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratastar.functions.keys import surrogate_key, unknown_key
from stratastar.operators.setops import union_all

NULL_BUCKETS = 1024


@dataclass(frozen=True)
class Lookup:
    """`foreign_key` of the fact meets `natural_key` of the dimension and yields `key`."""

    dimension: str
    foreign_key: str
    natural_key: str
    key: str


@dataclass(frozen=True)
class Target:
    """Members for the value `side` of each row: (natural key, key), or the natural key alone if
    `hashed` says how a member's key follows from `side`. A miss yields `unknown`.

    With `hashed` the join only answers whether the member exists: its side is a quarter as
    wide, so more dimensions stay under the broadcast threshold.
    """

    members: DataFrame
    side: Column
    key: str
    unknown: Column
    hashed: Column | None = None


def spread_nulls(value: Column, spread_by: Sequence[str]) -> Column:
    """The value as text, or for NULL one of many texts that no key has."""
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_BUCKETS))
    return F.coalesce(value.cast("string"), F.concat(F.lit("\u0000"), bucket.cast("string")))


def planned_bytes(df: DataFrame) -> int:
    """Size of a table as the planner estimates it; for a stored table it follows from its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_bytes(spark: SparkSession) -> int:
    """The size up to which the planner broadcasts a table; negative if it never does."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _combination(sides: Sequence[Column], spread_by: Sequence[str]) -> Column:
    """64-bit name of the foreign keys of a row. Rows without any key are spread, as they can never match."""
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_BUCKETS))
    return F.when(F.coalesce(*sides).isNull(), bucket).otherwise(F.xxhash64(*sides))


def membership(df: DataFrame, targets: Sequence[Target]) -> DataFrame:
    """(__name, __missed) per name of a combination of foreign keys in `df`: its keys that members lack, as `i:key` of target i.

    Only keys move, once: each row's are unpivoted to (name, target, key), which meet the members of all targets
    in one anti join (a hot key's side is split by adaptive execution), and only keys without a member send
    anything back, one answer a name. With large members few rows have the same combination, so making them distinct first would be
    one more shuffle of about all keys. A miss is true of its key, whichever combination asked, so two of one name do no harm.
    """
    sides = [t.side.cast("string").alias(f"__f{i}") for i, t in enumerate(targets)]
    names = [f"__f{i}" for i in range(len(targets))]
    combinations = df.select(*sides).where(F.coalesce(*[t.side.cast("string") for t in targets]).isNotNull())
    marked = combinations.select(_combination([F.col(n) for n in names], names).alias("__name"), *names)
    asked = marked.select("__name", F.posexplode(F.array(*names)).alias("__i", "__f")).where("__f is not null")
    members = [t.members.select(F.lit(i).alias("__i"), F.col(t.members.columns[0]).cast("string").alias("__f")) for i, t in enumerate(targets)]
    missed = asked.join(union_all(members), ["__i", "__f"], "left_anti")
    return missed.groupBy("__name").agg(F.collect_set(F.concat(F.col("__i").cast("string"), F.lit(":"), "__f")).alias("__missed"))


def misses(df: DataFrame, targets: Sequence[Target], row: str) -> DataFrame:
    """(__row, __missed) per value of the unique column `row`: bit i says that members of target i lack its key.

    As `membership`, but a row is named by its own key, so no combinations are made distinct.
    """
    if len(targets) > 63:
        raise ValueError("at most 63 targets fit the answer of a row")
    sides = F.posexplode(F.array(*[t.side.cast("string") for t in targets])).alias("__i", "__f")
    asked = df.select(F.col(row).alias("__row"), sides).where("__f is not null")
    members = [t.members.select(F.lit(i).alias("__i"), F.col(t.members.columns[0]).cast("string").alias("__f")) for i, t in enumerate(targets)]
    missed = asked.join(union_all(members), ["__i", "__f"], "left_anti")
    return missed.groupBy("__row").agg(F.bit_or(F.expr("shiftleft(cast(1 as bigint), __i)")).alias("__missed"))


def find_keys(
    df: DataFrame,
    targets: Sequence[Target],
    spread_by: Sequence[str] | None = None,
    *,
    direct_up_to: int | None = None,
    row: str | None = None,
) -> DataFrame:
    """`df` plus the key of every target.

    Members must be unique (see `unique_failures`), so the row count never changes. Rows
    without a key are spread by a hash of `spread_by`, by default of the whole row.

    Members of at most `direct_up_to` bytes (by default what the session broadcasts) are met by
    one left join each, which the planner makes a broadcast. Of the larger ones, a single one is a
    shuffle join; for several `hashed` ones `membership` is worked out on the keys, and the wide
    row is shuffled once to meet its answers, however many they are. Then `df` is read twice, so
    it should be stored.

    `row` names a column that is never null and differs in every row. Then large hashed members, also a single
    one, are met through it (see `misses`): a `df` that is partitioned by it already, as latest versions
    are, is not shuffled again, and its two readers share the one shuffle that it ends in.
    """
    spread_by = spread_by or [f"`{c}`" for c in df.columns]
    if direct_up_to is None:
        direct_up_to = broadcast_bytes(df.sparkSession)
    large = [i for i, t in enumerate(targets) if t.hashed is not None and planned_bytes(t.members) > direct_up_to]
    large = large if len(large) > 1 or row else []
    joined = df
    for i, target in enumerate(targets):
        if i not in large:
            member, *key = target.members.columns
            members = target.members.select(F.col(member).cast("string").alias(f"__m{i}"), *[F.col(k).alias(f"__k{i}") for k in key])
            joined = joined.join(members, spread_nulls(target.side, spread_by) == F.col(f"__m{i}"), "left")
    asked = [targets[i] for i in large]
    if large and row:
        joined = joined.join(misses(df, asked, row), F.col(row) == F.col("__row"), "left")
    elif large:
        joined = joined.join(membership(df, asked), _combination([t.side.cast("string") for t in asked], spread_by) == F.col("__name"), "left")
    keys = []
    for i, target in enumerate(targets):
        if i in large and row:
            met = F.coalesce("__missed", F.lit(0)).bitwiseAND(F.lit(1 << large.index(i))) == 0
            found = F.when(target.side.isNotNull() & met, target.hashed)
        elif i in large:
            missed = F.array_contains("__missed", F.concat(F.lit(f"{large.index(i)}:"), target.side.cast("string")))
            found = F.when(target.side.isNotNull() & ~F.coalesce(missed, F.lit(False)), target.hashed)
        else:
            found = F.col(f"__k{i}") if target.hashed is None else F.when(F.col(f"__m{i}").isNotNull(), target.hashed)
        keys.append(F.coalesce(found, target.unknown).alias(target.key))
    return joined.select(*[f"`{c}`" for c in df.columns], *keys)


def target(dimension: DataFrame, spec: Lookup, hashed: bool = False) -> Target:
    """`hashed` for dimensions whose key is `surrogate_key` of the natural key."""
    side = F.col(spec.foreign_key)
    members = dimension.select(spec.natural_key, *([] if hashed else [spec.key]))
    return Target(members, side, spec.key, unknown_key(), surrogate_key(side) if hashed else None)


def status_target(dim_status: DataFrame, domain: str, status: str, key: str = "statut_key") -> Target:
    """The cleaned status inside its domain; a miss yields the domain's unknown key."""
    members = dim_status.where(F.col("domaine_statut") == domain).select("statut_value")
    side = F.upper(F.trim(F.col(status)))
    return Target(members, side, key, unknown_key(domain), surrogate_key(F.lit(domain), side))


def lookup(df: DataFrame, dimension: DataFrame, spec: Lookup, *, spread_by: Sequence[str] | None = None) -> DataFrame:
    return find_keys(df, [target(dimension, spec)], spread_by)


def status_lookup(
    df: DataFrame, dim_status: DataFrame, domain: str, status: str, *, spread_by: Sequence[str] | None = None
) -> DataFrame:
    return find_keys(df, [status_target(dim_status, domain, status)], spread_by)
