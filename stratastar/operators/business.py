"""Entity-level operators over version histories, stock and client pools."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratastar.functions.finance import RESALE_AFTER_DAYS
from stratastar.operators.setops import union_all
from stratastar.session import materialise

# Programme states that follow the stock.
SELLING, SOLD_OUT = "EN_COMMERCIALISATION", "COMMERCIALISE"
RANGE_ROWS = 1_000_000


def reconcile_stock(programmes: DataFrame, lots: DataFrame, *, available: str = "DISPONIBLE") -> DataFrame:
    """Available lots per programme, and the programme status that follows from them."""
    stock = lots.groupBy("programme_id").agg(F.count_if(F.col("statut_lot") == available).alias("__available"))
    left = F.coalesce("__available", F.lit(0))
    status = (
        F.when((left == 0) & (F.col("statut_programme") == SELLING), SOLD_OUT)
        .when((left > 0) & (F.col("statut_programme") == SOLD_OUT), SELLING)
        .otherwise(F.col("statut_programme"))
    )
    return (
        programmes.join(stock, "programme_id", "left")
        .withColumns({"nombre_lots_disponibles": left.cast("int"), "statut_programme": status})
        .drop("__available")
    )


def never_matched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key combination does not occur in `other`.

    Repeated keys of `other` are dropped in the map tasks before the shuffle.
    """
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def resale_candidates(sales: DataFrame, resales: DataFrame, as_of: Column) -> DataFrame:
    """Sales delivered more than two years before `as_of` and never put up for resale."""
    delivered = sales.where(
        (F.col("statut_vente") == "LIVREE") & (F.datediff(as_of, "date_livraison_reelle") > RESALE_AFTER_DAYS)
    )
    return never_matched(delivered, resales, ["vente_id"])


def tagged_pool(members: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct ids of several populations, tagged by population: tag, member_id."""
    return union_all(
        [
            df.where(F.col(column).isNotNull())
            .select(F.lit(tag).alias("tag"), F.col(column).cast("string").alias("member_id"))
            .distinct()
            for tag, (df, column) in members.items()
        ]
    )


def same_region(
    investors: DataFrame, lots: DataFrame, programmes: DataFrame, agencies: DataFrame, *, available: str = "DISPONIBLE"
) -> DataFrame:
    """Available lots counted in the region of every investor: investor, region, count, lowest lot id.

    An investor of a city without an agency has no region and no lots.
    Both sides reach a region through their city. Lots are counted per region before
    the join, so no pair of investor and lot is ever formed.
    """
    city_region = agencies.groupBy("ville").agg(F.max("region_id").alias("region_id"))
    programme_region = programmes.select("programme_id", "ville").join(city_region, "ville")
    per_programme = (
        lots.where(F.col("statut_lot") == available)
        .groupBy("programme_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("lot_id").alias("first_lot"))
    )
    per_region = (
        per_programme.join(programme_region, "programme_id")
        .groupBy("region_id")
        .agg(F.sum("n").alias("available_lots"), F.min("first_lot").alias("first_lot"))
    )
    return (
        investors.select("investisseur_id", "ville")
        .join(city_region, "ville", "left")
        .join(per_region, "region_id", "left")
        .select(
            "investisseur_id",
            "region_id",
            F.coalesce("available_lots", F.lit(0)).cast("long").alias("available_lots"),
            "first_lot",
        )
    )


def last_attributes(df: DataFrame, key: str, order_by: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Attributes of the newest version per key, as one aggregate with map-side combine."""
    newest = F.max_by(F.struct(*attributes), F.struct(*order_by))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(newest.alias("__last")).select(key, "__last.*")


def group_members(df: DataFrame, group: str, member: str) -> DataFrame:
    """Distinct members with their group's size, one row each: group, member, group_size.

    The size is counted apart and joined back, so a hot group is never in one task.
    """
    pairs = df.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(group, member).distinct()
    sizes = pairs.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    return pairs.join(sizes, group)


def member_pages(df: DataFrame, group: str, member: str, pages: int) -> DataFrame:
    """Sorted member lists in `pages` pages per group, by a hash of the member: group, page, members, group_size.

    The caller gives the number of pages; every group has the same, whatever its size
    (a page without members has no row), so a page has to fit into one row.
    """
    digest = F.conv(F.substring(F.md5(F.col(member).cast("string")), 1, 8), 16, 10).cast("long")
    paged = group_members(df, group, member).withColumn("page", digest % F.lit(pages))
    return paged.groupBy(group, "page", "group_size").agg(F.sort_array(F.collect_list(member)).alias("members"))


def in_ranges(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """`df` stored in ranges of about `rows` rows by `columns` (ascending, NULL first), numbered in order as __range.

    The number of ranges grows with the table. Sampled bounds cut wherever they fall, through one
    key or one instant as well, so no value makes a range large that differs in some column.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-df.count() // rows))
    order = [F.col(f"`{c}`").asc_nulls_first() for c in columns]
    return materialise(df.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")


def previous_version(
    df: DataFrame, key: str, order_by: Sequence[str], values: Mapping[str, str], *, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Adds columns (new name to source column) of the version just before, per key.

    Sorting a key's whole history in one task breaks down when one key holds a large share of
    the rows. So all rows are dealt by ranges of (key, order columns), stored once, and the window
    runs inside (range, key). A key that a bound cuts through hands the last row of one range to
    the first row of the next: at most one row per range, and it meets the rows where the window
    already put them. Every table goes this way, whatever its size and its keys.

    Versions alike in all order columns have no order; which comes first is left open. Rows
    without a key have no version before them.
    """
    sources = list(dict.fromkeys(values.values()))
    ranged = in_ranges(df, [key, *order_by], range_rows)
    # Only the keys at the two ends of a range can go on in another one.
    ends = ranged.groupBy("__range").agg(F.min(key).alias("__low"), F.max(key).alias("__high"))
    at_ends = ranged.join(ends, "__range").where((F.col(key) == F.col("__low")) | (F.col(key) == F.col("__high")))
    edges = at_ends.groupBy("__range", key).agg(F.max_by(F.struct(*sources), F.struct(*order_by)).alias("__last"))
    per_key = Window.partitionBy(key).orderBy("__range")
    handed = edges.select(F.col("__range").alias("__edge_range"), F.col(key).alias("__edge_key"), F.lag("__last").over(per_key).alias("__handed"))

    inside = Window.partitionBy("__range", key).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    rows = ranged.withColumns({"__before": F.lag(F.struct(*sources)).over(inside), "__first": F.row_number().over(inside) == 1})
    met = (F.col("__range") == F.col("__edge_range")) & (F.col(key) == F.col("__edge_key"))
    joined = rows.join(handed.where("__handed is not null"), met, "left")
    before = F.when(F.col(key).isNotNull(), F.coalesce("__before", F.when(F.col("__first"), F.col("__handed"))))
    return joined.select(
        *[f"`{c}`" for c in df.columns], *[before[source].alias(new) for new, source in values.items()]
    )


def status_transitions(
    history: DataFrame, key: str, status: str, order_by: Sequence[str], *, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Edges of the state graph: from, to, number of moves and mean days spent in `from`.

    Every version but a key's first is a move, also one after a version without a status or a
    time. The mean is over the moves whose two times are known, NULL if there are none.
    """
    clock = order_by[0]
    versions = history.where(F.col(key).isNotNull()).select(key, status, *order_by).withColumn("__is", F.lit(True))
    values = {"from_status": status, "from_time": clock, "__was": "__is"}
    moves = previous_version(versions, key, order_by, values, range_rows=range_rows).where("__was")
    seconds = F.unix_seconds(F.col(clock).cast("timestamp")) - F.unix_seconds(F.col("from_time").cast("timestamp"))
    return moves.groupBy("from_status", F.col(status).alias("to_status")).agg(
        F.count(F.lit(1)).alias("n_moves"),
        (F.sum(seconds).cast("double") / F.count(seconds) / 86400).alias("mean_days"),
    )
