"""Metrics by dimensions over entities joined along many-to-one relationships."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook.operators.joins import left_join_one
from silverbrook.plans.secured import secured_views

Predicate = Callable[[Column], Column]


class SemanticError(ValueError):
    """A name that is unknown or ambiguous, or a dimension a metric cannot reach."""


@dataclass(frozen=True)
class Entity:
    name: str
    mart: str
    key: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``source`` refer to one row of ``target``."""

    name: str
    source: str
    source_key: str
    target: str
    target_key: str


@dataclass(frozen=True)
class Field:
    """A dimension or a fact: a column of an entity."""

    entity: str
    column: str

    @property
    def output(self) -> str:
        return f"{self.entity}_{self.column}"


@dataclass(frozen=True)
class Metric:
    entity: str
    name: str
    function: str  # sum, count or count_distinct
    column: str


@dataclass(frozen=True)
class SemanticModel:
    entities: tuple[Entity, ...]
    relationships: tuple[Relationship, ...]
    facts: tuple[Field, ...]
    dimensions: tuple[Field, ...]
    metrics: tuple[Metric, ...]

    def entity(self, name: str) -> Entity:
        """An entity by its name or one of its synonyms."""
        wanted = name.strip().lower()
        for entity in self.entities:
            if wanted == entity.name or wanted in entity.synonyms:
                return entity
        raise SemanticError(f"unknown entity {name!r}")

    def _pick(self, name: str, members: Sequence[tuple[str, str, object]], kind: str):
        owner, _, short = name.rpartition(".")
        entity = self.entity(owner).name if owner else None
        found = [m for e, n, m in members if n == short and entity in (None, e)]
        if not found:
            raise SemanticError(f"unknown {kind} {name!r}")
        if len(found) > 1:
            raise SemanticError(f"ambiguous {kind} {name!r}; name its entity")
        return found[0]

    def resolve(self, name: str) -> Field:
        """A dimension or entity key by ``entity.column`` or, if unique, by column."""
        keys = [Field(e.name, e.key) for e in self.entities]
        fields = dict.fromkeys([*self.dimensions, *keys])
        return self._pick(name, [(f.entity, f.column, f) for f in fields], "dimension")

    def metric(self, name: str) -> Metric:
        return self._pick(name, [(m.entity, m.name, m) for m in self.metrics], "metric")

    def path(self, source: str, target: str) -> tuple[Relationship, ...]:
        """The shortest chain of relationships from the many side to the one side."""
        frontier: dict[str, tuple[Relationship, ...]] = {source: ()}
        reached = dict(frontier)
        while frontier and target not in reached:
            frontier = {
                r.target: (*hops, r)
                for entity, hops in frontier.items()
                for r in self.relationships
                if r.source == entity and r.target not in reached
            }
            reached.update(frontier)
        if target not in reached:
            raise SemanticError(f"{target} cannot be reached from {source} without repeating rows")
        return reached[target]

    def bind(self, marts: Mapping[str, DataFrame]) -> BoundModel:
        """The model over these marts."""
        return BoundModel(self, {e.name: marts[e.mart] for e in self.entities if e.mart in marts})

    def secured(
        self, marts: Mapping[str, DataFrame], entitlements: DataFrame, user_id: int | None
    ) -> BoundModel:
        """The model over one user's secured views."""
        views = secured_views(dict(marts), entitlements, user_id)
        return BoundModel(
            self, {e.name: views[f"sv_{e.mart}"] for e in self.entities if f"sv_{e.mart}" in views}
        )


@dataclass(frozen=True)
class BoundModel:
    model: SemanticModel
    tables: Mapping[str, DataFrame]


# How a partial result of each function is computed and combined.
_PARTIAL = {"sum": F.sum, "count": F.count}


Groups = Mapping[str, Sequence[Metric]]


def _folds(model: SemanticModel, groups: Groups, fields: Sequence[Field]) -> dict[str, str]:
    """Entities whose metrics another one's can take along: entity -> the next such one on its way.

    So it is when all fields lie behind the other one, as those of orders do for
    order items; distinct counts cannot be summed per key. Without fields no
    entity has to be joined.
    """
    folds: dict[str, str] = {}
    if not fields:
        return folds
    for entity, metrics in groups.items():
        ways = {}
        for other in groups:
            with suppress(SemanticError):
                ways[other] = model.path(entity, other)
        behind = [
            (len(way), other)
            for other, way in ways.items()
            if way and all(model.path(entity, f.entity)[: len(way)] == way for f in fields)
        ]
        if behind and not any(m.function == "count_distinct" for m in metrics):
            folds[entity] = min(behind)[1]
    return folds


def _rows_of(entity: str) -> str:
    return f"_rows_of_{entity}"


def _with_folded(
    bound: BoundModel, entity: str, groups: Groups, folds: Mapping[str, str], columns: Sequence[Column]
) -> DataFrame:
    """Columns and metric inputs of an entity's rows, with the sums of what is folded into it."""
    inputs = [F.col(m.column).alias(f"_{m.name}") for m in groups[entity]]
    folded = [e for e, other in folds.items() if other == entity]
    if len(groups) > 1:
        inputs.append(F.lit(1).alias(_rows_of(entity)))
    if folded:
        inputs.append(F.col(bound.model.entity(entity).key).alias("_key"))
    state = bound.tables[entity].select(*columns, *inputs)
    for other in folded:
        # One row per key on both sides; rows that refer to nothing keep their sums.
        state = state.join(_along(bound, other, groups, folds), "_key", "full_outer")
    return state.drop("_key")


def _along(bound: BoundModel, entity: str, groups: Groups, folds: Mapping[str, str]) -> DataFrame:
    """Metrics and number of rows of an entity, and of those folded into it, per key of the one it folds into."""
    way = bound.model.path(entity, folds[entity])
    state = _with_folded(bound, entity, groups, folds, [F.col(way[0].source_key).alias("_next")])
    own = {f"_{m.name}": _PARTIAL[m.function] for m in groups[entity]}
    sums = [c for c in state.columns if c != "_next"]
    state = state.groupBy("_next").agg(*[own.get(c, F.sum)(c).alias(c) for c in sums])
    for hop, following in zip(way, way[1:], strict=False):
        on_the_way = bound.tables[hop.target].select(
            F.col(hop.target_key).alias("_target_key"), F.col(following.source_key).alias("_after")
        )
        state = left_join_one(state, on_the_way, "_next", "_target_key", spread_by=["_next"])
        state = state.groupBy(F.col("_after").alias("_next")).agg(*[F.sum(c).alias(c) for c in sums])
    return state.withColumnRenamed("_next", "_key")


def _by_entity(
    bound: BoundModel,
    base: str,
    groups: Groups,
    folds: Mapping[str, str],
    dims: Sequence[Field],
    where: Sequence[tuple[Field, Predicate]],
) -> DataFrame:
    """Metrics of the entity ``base``, and of others folded into it, by dimensions reachable from it.

    Rows are aggregated to the keys and dimensions still needed before every
    join. A fact therefore reaches the shuffle already summed per key, and
    joins work on sums instead of on rows, which also takes the weight out of
    keys that many rows share. Entities that are folded in come as one row per
    key of ``base``; from there on all share its attributes and its joins.
    """
    model, folded = bound.model, [e for e in groups if e != base]
    metrics = [m for own in groups.values() for m in own]
    wanted = list(dict.fromkeys([*dims, *[f for f, _ in where]]))
    hops: list[Relationship] = []
    for fld in wanted:
        hops += [r for r in model.path(base, fld.entity) if r not in hops]

    def columns_of(entity: str) -> list[Column]:
        fields = [F.col(f.column).alias(f.output) for f in wanted if f.entity == entity]
        refs = [F.col(r.source_key).alias(f"_{r.name}") for r in hops if r.source == entity]
        return fields + refs

    def filtered(df: DataFrame, entity: str) -> DataFrame:
        for fld, predicate in where:
            if fld.entity == entity:
                df = df.filter(predicate(F.col(fld.output)))
        return df

    state = filtered(_with_folded(bound, base, groups, folds, columns_of(base)), base)
    distinct = [f"_{m.name}" for m in metrics if m.function == "count_distinct"]
    counted = {f"_{m.name}": _PARTIAL[m.function] for m in groups[base] if m.function in _PARTIAL}
    sums = [f"_{m.name}" for e in folded for m in groups[e]]
    sums += [_rows_of(e) for e in groups] if folded else []

    def collapse(df: DataFrame, first: bool, joined: int) -> DataFrame:
        """Partial aggregates by whatever later joins and the result still need."""
        fields = [f.output for f in wanted if f.output in df.columns]
        pending = [f"_{r.name}" for r in hops[joined:] if f"_{r.name}" in df.columns]
        partial = [(of if first else F.sum)(name).alias(name) for name, of in counted.items()]
        partial += [F.sum(name).alias(name) for name in sums]
        needed = [*fields, *pending, *distinct]
        return df.groupBy(*needed).agg(*partial) if partial else df.select(*needed).distinct()

    for position, hop in enumerate(hops):
        if position == 0:
            state = collapse(state, True, 0)
        target = bound.tables[hop.target].select(
            F.col(hop.target_key).alias("_target_key"), *columns_of(hop.target)
        )
        key = f"_{hop.name}"
        grain = [c for c in state.columns if c not in {*counted, *sums}]
        state = left_join_one(state, target, key, "_target_key", spread_by=grain)
        state = filtered(state.drop(key), hop.target)
        if position + 1 < len(hops):
            state = collapse(state, False, position + 1)

    final = []
    for m in metrics:
        source = F.col(f"_{m.name}")
        if m.function == "count_distinct":
            value = F.count_distinct(source)
        elif m.function == "sum":
            value = F.sum(source)
        elif hops or m.entity != base:
            value = F.coalesce(F.sum(source), F.lit(0)).cast("bigint")
        else:
            value = F.count(source)
        if folded and dims:
            # An entity without rows there says nothing about a combination.
            value = F.when(F.sum(_rows_of(m.entity)) > 0, value)
        final.append(value.alias(m.name))
    return state.groupBy(*[d.output for d in dims]).agg(*final)


def semantic_query(
    bound: BoundModel,
    metrics: Sequence[str],
    dims: Sequence[str] = (),
    where: Mapping[str, Predicate] | None = None,
    order_by: Sequence[tuple[str, str]] = (),
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions, with filters on dimensions, an order and a limit.

    Dimensions come out as ``entity_column``. Metrics of different entities
    are put together on equal dimensions, NULL included. Where one entity lies
    on the other's way to the dimensions, its attributes serve both and are read
    once; otherwise each is aggregated apart.
    ``order_by`` lists (output column, ``asc``/``desc``); dimensions break ties.
    """
    model = bound.model
    chosen = [model.metric(name) for name in metrics]
    fields = [model.resolve(name) for name in dims]
    filters = [(model.resolve(name), predicate) for name, predicate in (where or {}).items()]
    if not chosen:
        raise SemanticError("a query needs a metric")

    groups: dict[str, list[Metric]] = defaultdict(list)
    for metric in chosen:
        groups[metric.entity].append(metric)
    folds = _folds(model, groups, [*fields, *[f for f, _ in filters]])
    bases: dict[str, dict[str, list[Metric]]] = defaultdict(dict)
    for entity, own in groups.items():
        base = entity
        while base in folds:
            base = folds[base]
        bases[base][entity] = own
    parts = [_by_entity(bound, base, own, folds, fields, filters) for base, own in bases.items()]
    outputs = [f.output for f in fields]
    if len(parts) == 1:
        result = parts[0]
    else:
        # Each part has one row per combination, so a maximum picks its value.
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        result = stacked.groupBy(*outputs).agg(*[F.max(m.name).alias(m.name) for m in chosen])
    result = result.select(*outputs, *[m.name for m in chosen])

    if order_by or limit is not None:
        direction = {
            "asc": lambda c: F.col(c).asc_nulls_last(),
            "desc": lambda c: F.col(c).desc_nulls_last(),
        }
        ties = [c for c in outputs if c not in {name for name, _ in order_by}]
        result = result.orderBy(
            *[direction[way](name) for name, way in order_by],
            *[direction["asc"](c) for c in ties],
        )
    return result if limit is None else result.limit(limit)


# Entities, keys, synonyms, relationships, facts, dimensions, metrics.
SHOP_MODEL = SemanticModel(
    entities=(
        Entity("customers", "dim_customers", "customer_id", ("clients", "buyers")),
        Entity("orders", "fact_orders", "order_id"),
        Entity("order_items", "fact_order_items", "order_item_id", ("line items", "order lines")),
        Entity("products", "dim_products", "product_id", ("items", "menu items")),
        Entity("dates", "dim_date", "date_day", ("calendar", "time")),
        Entity("stores", "dim_stores", "store_id", ("locations", "branches")),
    ),
    relationships=(
        Relationship("orders_to_customers", "orders", "customer_id", "customers", "customer_id"),
        Relationship("order_items_to_orders", "order_items", "order_id", "orders", "order_id"),
        Relationship(
            "order_items_to_products", "order_items", "product_id", "products", "product_id"
        ),
        Relationship("orders_to_dates", "orders", "order_date", "dates", "date_day"),
        Relationship("orders_to_stores", "orders", "store_id", "stores", "store_id"),
    ),
    facts=(
        Field("orders", "amount"),
        Field("order_items", "quantity"),
        Field("order_items", "line_total"),
        Field("order_items", "unit_price"),
    ),
    dimensions=(
        Field("customers", "first_name"),
        Field("customers", "last_name"),
        Field("orders", "status"),
        Field("orders", "order_date"),
        Field("products", "name"),
        Field("products", "category"),
        Field("dates", "year"),
        Field("dates", "quarter"),
        Field("dates", "month_name"),
        Field("dates", "is_weekend"),
        Field("stores", "name"),
        Field("stores", "city"),
        Field("stores", "state"),
        Field("stores", "country"),
    ),
    metrics=(
        Metric("orders", "total_revenue", "sum", "amount"),
        Metric("orders", "order_count", "count", "order_id"),
        Metric("customers", "customer_count", "count_distinct", "customer_id"),
        Metric("order_items", "total_product_revenue", "sum", "line_total"),
        Metric("order_items", "total_units_sold", "sum", "quantity"),
    ),
)
