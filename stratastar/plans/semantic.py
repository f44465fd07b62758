"""Measures over the star: relationships, filters, drill-across."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.operators.distinct import BITS, BLANK, BUCKET, distinct_counts, distinct_state
from stratastar.operators.setops import union_all


@dataclass(frozen=True)
class Relationship:
    """Many rows of `table` point at one row of `dimension`."""

    table: str
    foreign_key: str
    dimension: str
    key: str


@dataclass(frozen=True)
class Measure:
    """`kind` is sum, count, distinct, avg or ratio; `where` filters the rows it sees, by the columns `reads`."""

    name: str
    kind: str
    table: str | None = None
    column: str | None = None
    where: Callable[[], Column] | None = None
    numerator: str | None = None
    denominator: str | None = None
    reads: tuple[str, ...] = ()


@dataclass(frozen=True)
class Model:
    tables: Mapping[str, DataFrame]
    relationships: Sequence[Relationship]
    measures: Mapping[str, Measure]
    #: Member numbers (value, number) by (table, column): distinct measures of those columns are counted
    #: by bitmaps, which are summed up per foreign key before the dimensions as other measures are.
    numbers: Mapping[tuple[str, str], DataFrame] = field(default_factory=dict)
    #: Date key by table, for facts stored by year (see `store_by_year`): a filter on dates then opens only its years' files.
    by_year: Mapping[str, str] = field(default_factory=dict)
    by_table: Mapping[str, Mapping[str, Relationship]] = field(init=False)

    def __post_init__(self) -> None:
        index: dict[str, dict[str, Relationship]] = {}
        for edge in self.relationships:
            index.setdefault(edge.table, {})[edge.dimension] = edge
        object.__setattr__(self, "by_table", index)

    def edge(self, table: str, dimension: str) -> Relationship | None:
        return self.by_table.get(table, {}).get(dimension)


YEAR = "annee_partition"


def year_of_key(date_key: Column) -> Column:
    """Year of an integer date key."""
    return F.floor(date_key / 10000).cast("int")


def store_by_year(fact: DataFrame, date_key: str, path: str) -> DataFrame:
    """Store a fact in one folder per year of a date key; rows without a date have a folder of their own.

    Rows of a year are dealt to files of a limited size, so a year that holds a third of all rows is
    written by many tasks.
    """
    rows = fact.withColumn(YEAR, year_of_key(F.col(date_key)))
    rows.hint("rebalance", F.col(YEAR)).write.partitionBy(YEAR).parquet(path)
    return fact.sparkSession.read.schema(rows.schema).parquet(path)


def related(model: Model, table: str, dimension: str, columns: Sequence[str | Column], df: DataFrame | None = None) -> DataFrame:
    """`table` with columns of a related dimension, joined over the registered relationship."""
    edge = model.edge(table, dimension)
    if edge is None:
        raise KeyError(f"no relationship from {table} to {dimension}")
    members = model.tables[dimension].select(F.col(edge.key).alias("__pk"), *columns)
    facts = model.tables[table] if df is None else df
    return facts.join(members, F.col(edge.foreign_key) == F.col("__pk"), "left").drop("__pk")


def propagate(model: Model, table: str, filters: Mapping[str, DataFrame], df: DataFrame | None = None) -> DataFrame:
    """Keep the rows of `table` whose dimension row survives in every related filtered dimension."""
    rows = model.tables[table] if df is None else df
    for dimension, survivors in filters.items():
        if dimension == table:
            edge_key = _own_key(model, dimension)
            rows = rows.join(survivors.select(F.col(edge_key).alias("__pk")), F.col(edge_key) == F.col("__pk"), "left_semi")
            continue
        edge = model.edge(table, dimension)
        if edge is not None and model.by_year.get(table) == edge.foreign_key:
            # Years are few, so this side is broadcast, and the scan is pruned by it before it starts.
            years = survivors.select(year_of_key(F.col(edge.key)).alias("__year")).distinct()
            rows = rows.join(years, F.col(YEAR) == F.col("__year"), "left_semi")
        if edge is not None:
            keys = survivors.select(F.col(edge.key).alias("__pk"))
            rows = rows.join(keys, F.col(edge.foreign_key) == F.col("__pk"), "left_semi")
    return rows


def _own_key(model: Model, dimension: str) -> str:
    return next(e.key for e in model.relationships if e.dimension == dimension)


def _expand(model: Model, names: Sequence[str]) -> list[Measure]:
    """The base measures that the named ones need, once each."""
    base: dict[str, Measure] = {}
    for name in names:
        measure = model.measures[name]
        if measure.kind == "ratio":
            for part in _expand(model, [measure.numerator, measure.denominator]):
                base[part.name] = part
        else:
            base[name] = measure
    return list(base.values())


def needed(
    relationships: Sequence[Relationship], measures: Mapping[str, Measure], names: Sequence[str], dimensions: Sequence[str]
) -> dict[str, set[str]]:
    """Columns that the named measures read per table, grouped or filtered by the given dimensions.

    Build facts with only these (see `fact`), so that no lookup is done that nobody reads.
    """
    base = _expand(Model({}, relationships, measures), names)
    columns: dict[str, set[str]] = {}
    for m in base:
        own = columns.setdefault(m.table, set())
        own |= {*m.reads, *([m.column] if m.column else [])}
        own |= {edge.foreign_key for edge in relationships if edge.table == m.table and edge.dimension in dimensions}
    return columns


def _partials(measures: Sequence[Measure]) -> dict[str, Column]:
    """Aggregates that can be summed up again over coarser groups."""
    cells: dict[str, Column] = {}
    for i, m in enumerate(measures):
        value = F.lit(1) if m.column is None else F.col(m.column)
        if m.where is not None:
            value = F.when(m.where(), value)
        if m.kind in ("sum", "avg"):
            cells[f"__s{i}"] = F.sum(value)
        if m.kind in ("count", "avg"):
            cells[f"__n{i}"] = F.count(value)
    return cells


def _finals(measures: Sequence[Measure]) -> list[Column]:
    finals = []
    for i, m in enumerate(measures):
        if m.kind == "sum":
            value = F.sum(f"__s{i}")
        elif m.kind == "count":
            value = F.nullif(F.sum(f"__n{i}"), F.lit(0))
        else:
            value = F.try_divide(F.sum(f"__s{i}").cast("double"), F.sum(f"__n{i}").cast("double"))
        finals.append(value.alias(m.name))
    return finals


def _distinct(measure: Measure) -> Column:
    """Distinct values; the blank counts as one value."""
    value = F.col(measure.column)
    if measure.where is not None:
        shown = F.when(measure.where(), value)
        blank = F.max(F.when(measure.where() & value.isNull(), 1).otherwise(0))
    else:
        shown, blank = value, F.max(F.when(value.isNull(), 1).otherwise(0))
    return F.nullif(F.count_distinct(shown) + blank, F.lit(0)).alias(measure.name)


def _per_table(
    model: Model, table: str, measures: Sequence[Measure], by: Sequence[tuple[str, str]], filters: Mapping[str, DataFrame]
) -> DataFrame:
    """Measures of one table per group of the reachable grouping columns.

    Facts are first summed up per foreign key, so the joins to the dimensions meet one
    row per key combination and a hot key has shrunk before it is shuffled.
    """
    rows = propagate(model, table, filters)
    alias = {pair: f"__by{i}" for i, pair in enumerate(by)}
    own = [pair for pair in by if pair[0] == table]
    edges = {d: model.edge(table, d) for d, _ in by if d != table and model.edge(table, d)}
    reached = [pair for pair in by if pair in own or pair[0] in edges]
    rows = rows.withColumns({alias[pair]: F.col(pair[1]) for pair in own})

    def with_dimensions(df: DataFrame) -> DataFrame:
        for dimension in edges:
            columns = [F.col(c).alias(alias[d, c]) for d, c in by if d == dimension]
            df = related(model, table, dimension, columns, df)
        return df

    groups = [F.col(alias[pair]).alias(pair[1]) for pair in reached]
    distinct = [m for m in measures if m.kind == "distinct" and (table, m.column) not in model.numbers]
    numbered = [m for m in measures if m.kind == "distinct" and (table, m.column) in model.numbers]
    additive = [m for m in measures if m.kind != "distinct"]
    results = []
    keys = list(dict.fromkeys([*[alias[p] for p in own], *[e.foreign_key for e in edges.values()]]))
    if additive:
        summed = rows.groupBy(*keys).agg(*[cell.alias(name) for name, cell in _partials(additive).items()])
        results.append(with_dimensions(summed).groupBy(*groups).agg(*_finals(additive)))
    for m in numbered:
        state = distinct_state(rows, keys, F.col(m.column), model.numbers[table, m.column], m.where() if m.where else None)
        named = with_dimensions(state).select(*groups, BUCKET, BITS, BLANK)
        results.append(distinct_counts(named, [column for _, column in reached], m.name))
    if distinct:
        results.append(with_dimensions(rows).groupBy(*groups).agg(*[_distinct(m) for m in distinct]))
    return drill_across(results, [column for _, column in reached])


def drill_across(results: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """Line up per-table results on their common groups.

    Every input has at most one row per group, so stacking them and taking the one
    value per group replaces a chain of full outer joins, with NULL groups matching.
    """
    if len(results) == 1:
        return results[0]
    names = list(dict.fromkeys(c for r in results for c in r.columns if c not in groups))
    kinds = {f.name: f.dataType for r in results for f in r.schema}
    stacked = [
        r.select(*groups, *[(F.col(f"`{n}`") if n in r.columns else F.lit(None).cast(kinds[n])).alias(n) for n in names])
        for r in results
    ]
    return union_all(stacked).groupBy(*groups).agg(*[F.max(F.col(f"`{n}`")).alias(n) for n in names])


def measure_query(
    model: Model,
    measures: Sequence[str],
    by: Sequence[tuple[str, str]] = (),
    filters: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Measures grouped by (dimension, column) pairs, under filtered dimensions.

    A table without a path to a grouping dimension shows its value for the groups it
    can reach, or its total, on every row.
    """
    filters = filters or {}
    base = _expand(model, measures)
    groups = [column for _, column in by]
    if len(set(groups)) < len(groups):
        raise ValueError(f"grouping columns need different names: {groups}")
    full, partial = [], []
    for table in dict.fromkeys(m.table for m in base):
        own = [m for m in base if m.table == table]
        result = _per_table(model, table, own, by, filters)
        reach = [g for g in groups if g in result.columns]
        (full if len(reach) == len(groups) else partial).append((result, reach, own))
    if not full:
        raise ValueError("no measure reaches every grouping column")
    result = drill_across([r for r, _, _ in full], groups)
    for other, reach, own in partial:
        if reach:
            keyed = other.select(*[F.col(g).alias(f"__{g}") for g in reach], *[F.col(f"`{m.name}`") for m in own])
            match = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in reach]
            result = result.join(keyed, match, "left").drop(*[f"__{g}" for g in reach])
        else:
            totals = {m.name: other.select(F.col(f"`{m.name}`")).scalar() for m in own}
            result = result.withColumns(totals)
    ratios = {}
    for name in measures:
        m = model.measures[name]
        if m.kind == "ratio":
            ratios[name] = F.try_divide(
                _value(model, m.numerator).cast("double"), _value(model, m.denominator).cast("double")
            )
    return result.withColumns(ratios).select(*groups, *[F.col(f"`{n}`") for n in measures])


def _value(model: Model, name: str) -> Column:
    measure = model.measures[name]
    if measure.kind != "ratio":
        return F.col(f"`{name}`")
    return F.try_divide(_value(model, measure.numerator).cast("double"), _value(model, measure.denominator).cast("double"))
