"""Latest version per key of an append-only change table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratastar.operators.lookup import broadcast_bytes, planned_bytes
from stratastar.session import materialise

_RANK = "__version_rank"
_TIED = "__version_tied"


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    *,
    tie_break: Sequence[str | Column] | None = None,
    nulls: str = "last",
    placeholders: Mapping[str, str] | None = None,
    keep_null_keys: bool = False,
    deleted: str | None = None,
    deleted_policy: str = "after",
) -> DataFrame:
    """One row per key: the first in descending `order_by`.

    * `tie_break` orders ascending among equal versions (pass sort columns for another
      order). By default all other columns do, so a recomputed task picks the same row.
    * `nulls="first"` lets a version without a readable time win.
    * `placeholders` groups NULL parts of a key under a text, as for optional scopes; a NULL in
      any other part drops the row unless `keep_null_keys`.
    * Rows flagged `deleted` are dropped before ranking (an older, live version comes
      back) or after it (a key whose newest version is deleted disappears).

    The rank filter reaches the plan as a window group limit, so every map task sends
    at most one row per key through the shuffle, however many versions a key has.
    """
    if nulls not in ("first", "last"):
        raise ValueError("nulls is 'first' or 'last'")
    if deleted_policy not in ("before", "after"):
        raise ValueError("deleted_policy is 'before' or 'after'")
    live = None if deleted is None else ~F.coalesce(F.col(deleted), F.lit(False))
    placeholders = placeholders or {}
    if not keep_null_keys:
        for key in keys:
            if key not in placeholders:
                df = df.where(F.col(key).isNotNull())
    if live is not None and deleted_policy == "before":
        df = df.where(live)

    groups = [F.coalesce(F.col(k), F.lit(placeholders[k])) if k in placeholders else F.col(k) for k in keys]
    columns = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ordering = [c.desc_nulls_last() if nulls == "last" else c.desc_nulls_first() for c in columns]
    if tie_break is None:
        named = {c for c in order_by if isinstance(c, str)} | set(keys)
        tie_break = [c for c in df.columns if c not in named]
    ordering += [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie_break]

    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*groups).orderBy(*ordering)))
    result = ranked.where(F.col(_RANK) == 1).drop(_RANK)
    return result.where(live) if live is not None and deleted_policy == "after" else result


def latest_columns(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str], store: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`columns` of `latest_version(df, keys, order_by)`, sorted and shuffled without the others.

    The others only decide between versions of a key that are first at equal times. Two rows per key
    tell whether there are such; their keys alone are decided over all columns, or all keys at once where those
    are more than the session broadcasts. `store` writes a table and reads it back.
    """
    over = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    times = F.struct(*order_by)
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    rows = df.select(*dict.fromkeys([*keys, *order_by, *columns]))
    rows = rows.withColumn(_RANK, F.row_number().over(over)).where(F.col(_RANK) <= 2)
    rows = rows.withColumn(_TIED, F.lead(times).over(over).eqNullSafe(times)).where(F.col(_RANK) == 1)
    newest = store(rows.select(*dict.fromkeys([*keys, *columns]), _TIED))
    # Stored, its size is known before the join is planned; otherwise all rows are shuffled to meet it.
    tied = materialise(newest.where(F.col(_TIED)).select(*keys), "tied")
    if tied.isEmpty():
        return newest.select(*columns)
    if planned_bytes(tied) > broadcast_bytes(df.sparkSession):
        return store(latest_version(df, keys, order_by).select(*columns))
    # A filter, unlike a join, goes below the projection of `df`: only rows of tied keys are projected.
    asked = F.col(keys[0]).isin(tied) if len(keys) == 1 else F.struct(*keys).isin(tied.select(F.struct(*keys)))
    decided = store(latest_version(df.where(asked), keys, order_by).select(*columns))
    return newest.where(~F.col(_TIED)).select(*columns).unionByName(decided)


def latest_of_extract(df: DataFrame, key: str, time: str = "updated_at", sequence: str | None = None) -> DataFrame:
    """Newest version per key of a raw extract.

    A version whose time cannot be read wins. Among equal times, or without a time
    column, the highest `sequence` wins. An extract without the key is returned as is.
    """
    if key not in df.columns:
        return df
    last = [F.col(sequence).desc_nulls_last()] if sequence else []
    if time not in df.columns:
        if not sequence:
            raise ValueError("without a time column the order needs a sequence")
        return latest_version(df, [key], [sequence])
    ranked = df.withColumn("__time", F.col(time).cast("string").try_cast("timestamp_ntz"))
    return latest_version(ranked, [key], ["__time"], nulls="first", tie_break=last or None).drop("__time")
