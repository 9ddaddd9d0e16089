"""One row per key, and lookups by a primary or a guarded secondary key.

Skew, in short:

* ``latest_per_key`` and ``first_seen`` are ``row_number() = 1``. Spark cuts every
  map task down to one row per key before the shuffle (``WindowGroupLimit``), so
  a hot key reaches its reducer as one row per map task.
* A lookup key may be null, or one value, on a large part of the base. Rows that
  cannot match take no part in the look-up, and hot values are salted; the looked-up
  row is repeated once per salt of a hot value and stays single for all others.
* A list that many base rows share by their secondary key is not copied to each of them on the
  way: ``shared_lists`` tells when the rows should rather move to the list (``join_shared``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_KEY = "__key"
_SALT = "__salt"
_HOT = "__hot"
_PARTS = "__parts"

# A lookup value with more base rows than this is split over several tasks.
HOT_ROWS = 1_000_000

# Lists that are copied to the rows that share them may add so many items to a row on average.
MOST_COPIED = 4
# A shared list is sent to one task for so many of its rows.
SHARED_ROWS = 100_000


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Rows without a key are left out.

    The columns that are neither key nor order break remaining ties (ascending,
    nulls last), so the choice never depends on the layout of the input.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return (
        df.where(_all_of([F.col(k).isNotNull() for k in keys]))
        .withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def first_seen(
    df: DataFrame, key: str | Sequence[str], position: Sequence[str]
) -> DataFrame:
    """The first row of each key by position. Rows without a key are all kept.

    ``position`` must tell every two rows apart. Rows without a key are grouped by
    their position, one row to a group, so they do not meet in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    keyless = ~_all_of([F.col(k).isNotNull() for k in keys])
    own = [F.when(keyless, F.col(p)) for p in position]
    window = Window.partitionBy(*keys, *own).orderBy(*[F.col(p) for p in position])
    return (
        df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    )


def hot_keys(df: DataFrame, key: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Values of ``key`` with more than ``hot_rows`` rows, and the parts to split each into.

    Counted with map-side combine. There are at most (rows / hot_rows) such values; whether
    they are few enough to broadcast is left to Spark, which knows their size.
    """
    return (
        df.where(key.isNotNull())
        .groupBy(key.alias(_HOT))
        .count()
        .where(F.col("count") > hot_rows)
        .select(_HOT, F.ceil(F.col("count") / hot_rows).cast("int").alias(_PARTS))
    )


def _salted_join(
    base: DataFrame,
    dim: DataFrame,
    match: Column,
    dim_key: str,
    row_id: Sequence[str],
    hot_rows: int,
) -> DataFrame:
    """Inner join of ``base`` to ``dim`` (one row per ``dim_key``) where ``match`` equals ``dim_key``."""
    keyed = base.withColumn(_KEY, match)
    hot = hot_keys(keyed, F.col(_KEY), hot_rows)
    spread = F.xxhash64(*row_id)
    parts = F.coalesce(F.col(_PARTS), F.lit(1)).cast("bigint")

    left = (
        keyed.join(hot, F.col(_KEY) == F.col(_HOT), "left")
        .withColumn(_SALT, F.pmod(spread, parts))
        .drop(_HOT, _PARTS)
    )
    right = (
        dim.where(F.col(dim_key).isNotNull())
        .withColumnRenamed(dim_key, _KEY)
        .join(hot, F.col(_KEY) == F.col(_HOT), "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        .drop(_HOT, _PARTS)
    )
    return left.join(right, [_KEY, _SALT]).drop(_KEY, _SALT)


def bridge_secondary(
    base: DataFrame,
    base_id: str,
    base_key: str,
    guard: Column,
    sides: Mapping[str, DataFrame],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Bring sides that are keyed by a secondary key to the primary key of the base.

    Each side has two columns: the secondary key (same name as ``base_key``) and one
    value, named as in ``sides``, at most one row per key. The result has one row per
    base row that has a match, with the id and one column per side.

    Only the id and the secondary key of the base take part, and only rows that can
    match; the wide base row is not shuffled on the secondary key at all.
    """
    blank = {name: F.lit(None).cast(side.schema[name].dataType) for name, side in sides.items()}
    stacked = reduce(
        DataFrame.unionByName,
        [
            side.select(
                base_key,
                *[F.col(n) if n == name else blank[n].alias(n) for n in sides],
            )
            for name, side in sides.items()
        ],
    )
    together = (
        stacked.where(F.col(base_key).isNotNull())
        .groupBy(base_key)
        .agg(*[F.any_value(n, F.lit(True)).alias(n) for n in sides])
        .withColumnRenamed(base_key, "__side_key")
    )
    able = base.where(guard & F.col(base_key).isNotNull()).select(base_id, base_key)
    found = _salted_join(
        able, together, F.col(base_key), "__side_key", [base_id], hot_rows
    )
    return found.select(base_id, *sides)


def shared_lists(
    base: DataFrame, base_key: str, guard: Column, items: DataFrame, most: int = MOST_COPIED
) -> DataFrame | None:
    """Where the lists of ``items`` (rows with ``base_key``) should not be copied to the base rows.

    None if the copies add ``most`` items or fewer to a row that has a list, on average: then
    ``bridge_secondary`` may bring the lists themselves. Else one row per list: the key and
    ``shared``, a reference (key, parts) for ``bridge_secondary`` to bring and ``join_shared``
    to resolve. Copies grow with base rows times items, references with the base rows alone.
    Only the key columns are read, and counted with map-side combine.
    """
    with_key = F.col(base_key).isNotNull()
    rows = base.where(guard & with_key).groupBy(base_key).agg(F.count(F.lit(1)).alias("__rows"))
    sizes = items.where(with_key).groupBy(base_key).agg(F.count(F.lit(1)).alias("__items"))
    both = rows.join(sizes, base_key)
    found = both.agg(
        F.sum("__rows").alias("rows"), F.sum(F.col("__rows").cast("double") * F.col("__items")).alias("copied")
    ).first()
    if not found["rows"] or found["copied"] <= most * found["rows"]:
        return None
    parts = F.ceil(F.col("__rows") / SHARED_ROWS).cast("bigint")
    return both.select(
        base_key, F.struct(F.col(base_key).alias("key"), parts.alias("parts")).alias("shared")
    )


def join_shared(base: DataFrame, base_id: str, lists: DataFrame, key: str, shared: DataFrame) -> DataFrame:
    """Replace the column ``shared`` of ``base`` by the list it refers to, null without one.

    ``lists`` is one row per ``key``, ``shared`` what ``shared_lists`` gave. The base moves to the lists,
    dealt over the parts of each; rows without a list are dealt by their id.
    """
    parts = shared.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shared.parts") - 1)).alias(_SALT))
    dealt = lists.join(parts, key).withColumnRenamed(key, _KEY)
    spread = F.xxhash64(base_id)
    keyed = base.withColumns(
        {_KEY: F.col("shared.key"), _SALT: F.coalesce(F.pmod(spread, F.col("shared.parts")), spread)}
    )
    return keyed.drop("shared").join(dealt, [_KEY, _SALT], "left").drop(_KEY, _SALT)


def lookup_guarded(
    base: DataFrame,
    dim: DataFrame,
    base_key: str,
    dim_key: str,
    guard: Column,
    row_id: str | Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join on a secondary key; rows that fail the guard stay, unmatched.

    ``dim`` holds one row per ``dim_key``; the key itself is not in the result. ``row_id``
    tells the base rows apart and is never null. The look-up itself moves only the id and the
    secondary key (``bridge_secondary``); the wide base row meets the result on its id.
    """
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    rest = [c for c in dim.columns if c != dim_key]
    id_, value = ("__row", "__found")
    row = F.col(ids[0]) if len(ids) == 1 else F.struct(*ids)
    side = dim.select(F.col(dim_key).alias("__key2"), F.struct(*rest).alias(value))
    narrow = base.select(row.alias(id_), F.col(base_key).alias("__key2"), guard.alias("__able"))
    found = bridge_secondary(narrow, id_, "__key2", F.col("__able"), {value: side}, hot_rows)
    joined = base.withColumn(id_, row).join(found, id_, "left")
    return joined.select(*base.columns, *(F.col(value)[c].alias(c) for c in rest))


def two_path(
    base: DataFrame,
    dim: DataFrame,
    primary: tuple[str, str],
    secondary: tuple[str, str],
    guard: Column,
    name: str,
    fields: Mapping[str, Column],
    order: Sequence[Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Resolve a side by its primary key, else by its guarded secondary key.

    ``primary`` and ``secondary`` are (base column, side column). The object comes
    whole from one path; fields of the two are never mixed.
    """
    base_id, dim_id = primary
    base_key, dim_key = secondary
    value = F.struct(*[c.alias(n) for n, c in fields.items()])
    direct, other = f"__{name}_direct", f"__{name}_other"
    by_id = latest_per_key(dim, dim_id, order).select(
        F.col(dim_id).alias(base_id), value.alias(direct)
    )
    by_key = latest_per_key(dim, dim_key, order).select(
        F.col(dim_key).alias("__dim_key"), value.alias(other)
    )
    narrow = base.select(base_id, F.col(base_key).alias("__dim_key"), guard.alias("__able"))
    found = bridge_secondary(
        narrow, base_id, "__dim_key", F.col("__able"), {other: by_key}, hot_rows
    )
    return (
        base.join(found, base_id, "left")
        .join(by_id, base_id, "left")
        .withColumn(name, F.coalesce(direct, other))
        .drop(direct, other)
    )
