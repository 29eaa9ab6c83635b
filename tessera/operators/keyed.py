"""Keyed choice, joins and upsert.

"First" and "last" have no meaning in a distributed read, so every operator
here takes an explicit order. The order must be total (add tie-breakers);
ties on the whole order pick an arbitrary row.

Scale: the default strategy is the least / greatest struct of a row, which
runs a partial aggregate before the shuffle, so a key holding a third of all
rows is reduced to one row per input partition before it is exchanged. The
``window`` strategy (``row_number``) is kept for comparison; it sends every row
of a key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tessera.operators.util import cols_of


class Order:
    """One sort term: column name, direction and null placement."""

    def __init__(self, col: str | Column, desc: bool = False, nulls_first: bool | None = None):
        self.col = F.col(col) if isinstance(col, str) else col
        self.name = col if isinstance(col, str) else None
        self.desc = desc
        # Spark / Postgres defaults: ASC -> nulls first (Spark), DESC -> nulls first (Postgres)
        self.nulls_first = (not desc) if nulls_first is None else nulls_first

    def sort_expr(self) -> Column:
        if self.desc:
            return self.col.desc_nulls_first() if self.nulls_first else self.col.desc_nulls_last()
        return self.col.asc_nulls_first() if self.nulls_first else self.col.asc_nulls_last()


def _norm(order) -> list[Order]:
    out = []
    for o in order:
        out.append(o if isinstance(o, Order) else Order(o))
    return out


def _rank_fields(order: list[Order]) -> tuple[list[Column], str]:
    """Fields of a struct whose natural ordering equals ``order``; returns (fields, 'min'|'max').

    Struct comparison in Spark puts null fields first; where the order wants them at the
    other end, a leading ``isnull`` field moves them. The value of term ``i`` is ``v{i}``.
    All terms must share one direction (descending takes the greatest).
    """
    dirs = {o.desc for o in order}
    if len(dirs) != 1:
        raise ValueError("mixed directions: use strategy='window'")
    desc = dirs.pop()
    fields = []
    for i, o in enumerate(order):
        if o.nulls_first == desc:  # nulls come first as the greatest, or last as the smallest
            fields.append(o.col.isNull().alias(f"n{i}"))
        fields.append(o.col.alias(f"v{i}"))
    return fields, ("max" if desc else "min")


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType, T.CalendarIntervalType))


def keep_one(df: DataFrame, keys, order: Sequence, strategy: str = "agg") -> DataFrame:
    """Keep the first row per key under ``order`` (W1-W3 core).

    Returns the columns of ``df`` in their original order.
    """
    keys = cols_of(keys)
    order = _norm(order)
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*[o.sort_expr() for o in order])
        return (df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
                  .select(*cols))
    fields, how = _rank_fields(order)
    # the order's own columns are read back from the rank, so that every value is sorted and sent once
    at = {c: f"v{i}" for i, o in reversed(list(enumerate(order))) if (c := o.name) in rest}
    others = {c: f"r{j}" for j, c in enumerate(rest) if c not in at}
    payload = [F.col(c).alias(f) for c, f in others.items()]
    if all(_orderable(df.schema[c].dataType) for c in others):
        row = F.struct(*fields, *payload)  # payload columns only decide between ties
        out = df.groupBy(*keys).agg((F.max if how == "max" else F.min)(row).alias("_row"))
    else:
        pick = F.max_by if how == "max" else F.min_by
        at, others = {}, {c: f"r{j}" for j, c in enumerate(rest)}
        row = F.struct(*[F.col(c).alias(f) for c, f in others.items()])
        out = df.groupBy(*keys).agg(pick(row, F.struct(*fields)).alias("_row"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_row.{f}").alias(c) for c, f in {**at, **others}.items()]) \
              .select(*cols)


def latest_per_key(df: DataFrame, keys, ts: str, tie_breakers: Sequence[str] = (),
                   strategy: str = "agg") -> DataFrame:
    """``DISTINCT ON (keys) ORDER BY keys, ts DESC`` (Postgres: nulls first
    under DESC), with descending tie-breakers to make the order total."""
    order = [Order(ts, desc=True, nulls_first=True)] + [Order(t, desc=True) for t in tie_breakers]
    return keep_one(df, keys, order, strategy)


def first_per_key(df: DataFrame, keys, order: Sequence, strategy: str = "agg") -> DataFrame:
    """Drop duplicates on ``keys`` keeping the first row in ``order`` (ascending)."""
    return keep_one(df, keys, [o if isinstance(o, Order) else Order(o) for o in order], strategy)


def last_per_key(df: DataFrame, keys, ingest_order: Sequence, strategy: str = "agg") -> DataFrame:
    """The last row per key in ingest order wins (row-by-row upsert result)."""
    order = [Order(o, desc=True, nulls_first=False) if isinstance(o, (str, Column)) else o
             for o in ingest_order]
    return keep_one(df, keys, order, strategy)


# --- joins --------------------------------------------------------------------

def left_lookup(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left equi-join; unmatched (including null-key) rows keep nulls. AQE broadcasts
    the right side if its measured size is under the threshold."""
    return left.join(right, on=on, how="left")


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Insert-or-update by key. Source rows replace target rows with
    the same key; other target rows are kept. ``source`` must be unique per key
    (dedupe it with W1-W3 first). Equivalent to a full outer join with
    coalesce, but needs only an anti-join and a union.

    Keys match by SQL equality: a null key never matches, so such a row is
    kept (target) or inserted (source). A plain equi-join also lets Spark
    reuse an existing hash partitioning on the key (a source deduped by key
    needs no second shuffle); a null-safe match would hash on
    ``coalesce(key), isnull(key)`` and re-shuffle both sides.

    Scale: the anti-join shuffles both sides by key (or broadcasts the source
    when AQE measures it small); AQE splits skewed anti-join partitions.
    """
    keys = cols_of(keys)
    src = source.select(*target.columns) if set(target.columns) <= set(source.columns) else source
    kept = target.join(src.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
            normalize=None) -> DataFrame:
    """Fact rows whose ``key`` has no match in ``dim`` (null keys count as orphans).

    ``normalize`` (e.g. ``F.upper``) is applied to both sides' keys first.
    """
    dim_key = dim_key or key
    fk = F.col(key) if normalize is None else normalize(F.col(key))
    dk = F.col(dim_key) if normalize is None else normalize(F.col(dim_key))
    d = dim.select(dk.alias("_dk"))
    f = fact.withColumn("_fk", fk)
    return f.join(d, f["_fk"] == d["_dk"], "left_anti").drop("_fk")