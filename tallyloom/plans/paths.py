"""Metrics by dimension names alone: join paths are searched in the relationship graph.

A dimension is a column name, or ``table.column``. It belongs to the metric's own table if that has it, else to the
nearest table that does. Paths follow relationships from their many side to their one side. Two nearest tables, or two
equally short paths to one, are refused with the choices named.

Relationships whose right side holds a key several times multiply rows. Beyond such an edge only the distinct pairs of join
key and wanted columns are joined, so a fact row counts once for each value of a dimension; facts are summed by key and
dimensions before that join where their metrics allow it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.metrics import RELATIONSHIPS, TABLE_METRICS, Tables

#: The columns that name one row of a table; tables that are not listed may hold any key several times.
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "dim_state": ("state_code",),
    "dim_county": ("county_name", "state_code"),
    "dim_msa": ("msa_name", "state_code"),
    "dim_zip": ("zip_code",),
    "dim_clinic": ("clinic_name", "state_code"),
    "dim_payers": ("payer_id",),
    "dim_parent_payer": ("parent_payer_id",),
    "dim_payors_aba": ("payor_id",),
    "dim_insured_party": ("insured_id",),
}

#: Metrics that are sums: those of parts add up to that of the whole.
ADDITIVE = frozenset(TABLE_METRICS) - {"avg_enrolled_lives_per_zip", "avg_bcab_per_zip", "zip_count_with_enrollment"}

Condition = Callable[[Column], Column]


class AmbiguousPath(ValueError):
    """A name that several tables or several paths could mean."""


@dataclass(frozen=True)
class Place:
    """Where a dimension lives: its column, and the relationships that lead to its table, in order."""

    name: str
    table: str
    column: str
    path: tuple[str, ...]

    @property
    def label(self) -> str:
        """The name of the output column."""
        return self.column


def multiplies(edge: str) -> bool:
    """Whether one left row can meet several right rows."""
    right = RELATIONSHIPS[edge]
    return not set(UNIQUE_KEYS.get(right.right, ("",))) <= {b for _, b in right.keys}


def shortest_paths(start: str) -> dict[str, list[tuple[str, ...]]]:
    """Every shortest path of relationships from ``start`` to each table that can be reached."""
    found: dict[str, list[tuple[str, ...]]] = {start: [()]}
    border = [start]
    while border:
        reached: dict[str, list[tuple[str, ...]]] = {}
        for table in border:
            for name, edge in RELATIONSHIPS.items():
                if edge.left == table and edge.right not in found:
                    reached.setdefault(edge.right, []).extend((*path, name) for path in found[table])
        found |= reached
        border = list(reached)
    return found


def locate(tables: Tables, fact: str, name: str) -> Place:
    """The place of a dimension as seen from ``fact``."""
    table, _, column = name.rpartition(".")
    paths = shortest_paths(fact)
    holders = [t for t in paths if t in tables and column in tables[t].columns and table in ("", t)]
    if not holders:
        raise ValueError(f"no relationship leads from {fact} to {name}")
    least = min(len(paths[t][0]) for t in holders)
    nearest = [t for t in holders if len(paths[t][0]) == least]
    if len(nearest) > 1:
        raise AmbiguousPath(f"{name} may be that of {', '.join(sorted(nearest))}; name the table")
    ways = paths[nearest[0]]
    if len(ways) > 1:
        raise AmbiguousPath(f"{name} is reached from {fact} by {' or '.join('/'.join(way) for way in sorted(ways))}")
    return Place(name, nearest[0], column, ways[0])


def _held(table: str, column: str) -> str:
    return f"{table}__{column}"


def _joined(rows: DataFrame, tables: Tables, edges: Sequence[str]) -> DataFrame:
    """``rows``, whose columns are named ``table__column``, with the tables along ``edges``, which may share beginnings."""
    for name in edges:
        edge = RELATIONSHIPS[name]
        right = tables[edge.right].select(*(F.col(c).alias(_held(edge.right, c)) for c in tables[edge.right].columns))
        same = (F.col(_held(edge.left, a)) == F.col(_held(edge.right, b)) for a, b in edge.keys)
        rows = rows.join(right, reduce(Column.__and__, same), "left")
    return rows


def _kept(rows: DataFrame, places: Sequence[Place], where: Mapping[str, Condition]) -> DataFrame:
    for place in places:
        if place.name in where:
            rows = rows.where(where[place.name](F.col(_held(place.table, place.column))))
    return rows


def _of_one_table(tables: Tables, fact: str, names: Sequence[str], by: Sequence[str], where: Mapping[str, Condition]) -> DataFrame:
    places = {name: locate(tables, fact, name) for name in [*by, *where]}
    labels = [places[name].label for name in by]
    if len(set(labels)) < len(labels):
        raise ValueError(f"two dimensions of one call share a column name: {labels}")
    direct, behind = [], {}
    for place in places.values():
        first = next((i for i, edge in enumerate(place.path) if multiplies(edge)), None)
        if first is None:
            direct.append(place)
        else:
            behind.setdefault(place.path[first], (place.path[:first], []))[1].append((place, place.path[first + 1 :]))

    edges = dict.fromkeys(e for place in direct for e in place.path) | dict.fromkeys(e for path, _ in behind.values() for e in path)
    ordered = sorted(edges, key=lambda e: len(shortest_paths(fact)[RELATIONSHIPS[e].right][0]))
    own = tables[fact]
    rows = _joined(own.select("*", *(F.col(c).alias(_held(fact, c)) for c in own.columns)), tables, ordered)
    rows = _kept(rows, direct, where)
    grouped = [F.col(_held(places[n].table, places[n].column)).alias(places[n].label) for n in by if places[n] in direct]
    values = [TABLE_METRICS[name].build().alias(name) for name in names]
    if not behind:
        return rows.groupBy(*grouped).agg(*values)

    keys = list(dict.fromkeys(_held(RELATIONSHIPS[e].left, a) for e in behind for a, _ in RELATIONSHIPS[e].keys))
    added = all(name in ADDITIVE for name in names)
    if added:
        rows = rows.groupBy(*grouped, *keys).agg(*values)
        values = [F.sum(name).alias(name) for name in names]
    else:  # the fact's own columns, which the metrics need, keep their names
        rows = rows.select("*", *(F.col(_held(places[n].table, places[n].column)).alias(f"by__{places[n].label}") for n in by if places[n] in direct))
    for edge_name, (_, beyond) in behind.items():
        edge = RELATIONSHIPS[edge_name]
        right = tables[edge.right].select(*(F.col(c).alias(_held(edge.right, c)) for c in tables[edge.right].columns))
        further = sorted({e: i for _, path in beyond for i, e in enumerate(path)}.items(), key=lambda item: item[1])
        right = _kept(_joined(right, tables, [e for e, _ in further]), [place for place, _ in beyond], where)
        wanted = [F.col(_held(p.table, p.column)).alias(f"{edge_name}__{p.label}") for p, _ in beyond if p.name in by]
        pairs = right.select(*(F.col(_held(edge.right, b)) for _, b in edge.keys), *wanted).distinct()
        pairs = pairs.withColumnsRenamed({_held(edge.right, b): f"{edge_name}__to_{b}" for _, b in edge.keys})
        same = (F.col(_held(edge.left, a)) == F.col(f"{edge_name}__to_{b}") for a, b in edge.keys)
        filtered = any(p.name in where for p, _ in beyond)
        rows = rows.join(pairs, reduce(Column.__and__, same), "inner" if filtered else "left")
    out = []
    for name in by:
        edge_name = next((e for e, (_, beyond) in behind.items() if any(p.name == name for p, _ in beyond)), None)
        label = places[name].label
        out.append(F.col(f"{edge_name}__{label}" if edge_name else label if added else f"by__{label}").alias(label))
    return rows.groupBy(*out).agg(*values)


def ask(
    tables: Tables, names: Sequence[str], by: Sequence[str] = (), where: Mapping[str, Condition] | None = None,
) -> DataFrame:
    """Metrics by dimensions, without a word about joins.

    ``where`` holds conditions on dimensions, which need not be among ``by``. Metrics of several tables are each aggregated on their own and
    then set side by side; a combination that one table lacks has NULL there. Dimensions of rows without a partner are NULL.
    """
    where = where or {}
    facts: dict[str, list[str]] = {}
    for name in names:
        facts.setdefault(TABLE_METRICS[name].table, []).append(name)
    parts = [_of_one_table(tables, fact, own, by, where) for fact, own in facts.items()]
    if len(parts) == 1:
        return parts[0]
    labels = [name.rpartition(".")[2] for name in by]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy(*labels).agg(*(F.max(name).alias(name) for name in names))
