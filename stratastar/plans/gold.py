"""Gold star: dimensions, facts, dates and statuses."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratastar.functions.cleaning import full_name
from stratastar.functions.keys import UNKNOWN, date_key, surrogate_key, unknown_key
from stratastar.operators.lookup import find_keys, status_target, target
from stratastar.operators.setops import with_unknown
from stratastar.operators.versions import latest_version
from stratastar.plans.specs import DimensionSpec, FactSpec


def dimension(
    source: DataFrame,
    spec: DimensionSpec,
    dimensions: Mapping[str, DataFrame],
    *,
    latest: bool = True,
    deleted_policy: str = "after",
) -> DataFrame:
    """One row per natural key with its hash key and parent keys, plus the unknown member.

    `latest=False` skips the ranking for a source that holds one version per key already.
    """
    live = ~F.coalesce(F.col(spec.deleted), F.lit(False)) if spec.deleted else None
    if latest:
        rows = latest_version(
            source, [spec.natural_key], spec.version_order, deleted=spec.deleted, deleted_policy=deleted_policy
        )
    else:
        rows = source.where(F.col(spec.natural_key).isNotNull())
        rows = rows if live is None else rows.where(live)
    if spec.parents:
        parents = [target(dimensions[parent.dimension], parent, hashed=True) for parent in spec.parents]
        rows = find_keys(rows, parents, spread_by=[spec.natural_key])
    names = [full_name(first, last).alias(name) for name, first, last in ([spec.full_name] if spec.full_name else [])]
    rows = rows.select(surrogate_key(spec.natural_key).alias(spec.key), "*", *names)

    member: dict[str, Column | str | int | bool] = {spec.key: unknown_key(), spec.natural_key: UNKNOWN}
    for parent in spec.parents:
        member[parent.foreign_key] = UNKNOWN
        member[parent.key] = unknown_key()
    return with_unknown(rows, {**member, **spec.unknown})


def fact(
    source: DataFrame,
    spec: FactSpec,
    dimensions: Mapping[str, DataFrame],
    only: Collection[str] | None = None,
    *,
    direct_up_to: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Live rows with surrogate keys for every lookup and integer keys for every date.

    `direct_up_to` is the size of a dimension up to which it is joined on its own (see `find_keys`).

    `unique` says that `source` has one row per natural key and none without, as its latest versions
    do; they lie by that key already, so they are not shuffled again for large dimensions. The hash
    of the natural key and other derived columns are made after the lookups and not shuffled.

    `only` names the columns that the consumer reads: lookups of other keys are left out, as a
    left join to a table that is not known to be unique stays in the plan even if nobody reads it.
    """
    column, value = spec.live
    rows = source.where(F.coalesce(F.col(column), F.lit(not value)) == F.lit(value))
    days = [f.name for f in source.schema if isinstance(f.dataType, T.DateType)]
    keep = [c for c in source.columns if c not in days and c not in spec.drop and c != "is_deleted"]
    wanted = [lookup for lookup in spec.lookups if only is None or lookup.key in only]
    targets = [target(dimensions[lookup.dimension], lookup, hashed=True) for lookup in wanted]
    if spec.status and (only is None or "statut_key" in only):
        targets.append(status_target(dimensions["dim_statut"], *spec.status))
    row = spec.natural_key if unique else None
    rows = find_keys(rows, targets, spread_by=[spec.natural_key], direct_up_to=direct_up_to, row=row)
    return rows.select(
        surrogate_key(spec.natural_key).alias(spec.key),
        *keep,
        *[date_key(d).alias(f"{d}_key") for d in days],
        *[build().alias(name) for name, build in spec.extra.items()],
        *[t.key for t in targets],
    )


def read_by_dimension(spec: DimensionSpec) -> set[str]:
    """Columns of the source that `dimension` needs, whatever is read of its result."""
    names = {spec.natural_key, *([spec.deleted] if spec.deleted else []), *[p.foreign_key for p in spec.parents], *spec.unknown}
    return names | set(spec.full_name or ())


def read_by_fact(spec: FactSpec, only: Collection[str] | None = None) -> set[str]:
    """Columns of the source that `fact` needs for its keys, or for those in `only`."""
    names = {spec.natural_key, spec.live[0]}
    names |= {lookup.foreign_key for lookup in spec.lookups if only is None or lookup.key in only}
    if spec.status and (only is None or "statut_key" in only):
        names.add(spec.status[1])
    return names
