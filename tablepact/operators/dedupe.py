"""Latest row per key.

The row is found by an aggregate: the maximum of the row itself with its order
columns put first. It combines *inside each map task before the shuffle*, so a
key holding a third of the table sends one row per task to its reducer, not a
third of the table. A row_number window filtered to 1 is cut down before the
shuffle as well, but has to sort by key and order columns; here the sort is by
key alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    CalendarIntervalType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    StructType,
    VariantType,
)

from ..functions.casts import ref
from ..functions.sizing import broadcast_limit

_ROW, _ROWS, _FILE, _PLACE = "__row", "__rows", "__file", "__place"
#: Reckoned for a path and a number; the paths of a file's rows are not shared in memory.
_LOCATOR_BYTES = 200


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [ref(k).isNull() for k in keys])


def _sortable(data_type: DataType) -> bool:
    if isinstance(data_type, StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, ArrayType):
        return _sortable(data_type.elementType)
    return not isinstance(data_type, (MapType, VariantType, CalendarIntervalType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    tie_breakers: Sequence[str] = (),
    null_keys: str = "collapse",
    count: str | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` values of every key.

    NULL order values count as least. Ties fall to ``tie_breakers``, then to the
    other columns from left to right, greatest first, so re-runs keep the same
    row. With no keys or no order the frame is returned as it is. Rows with a
    NULL in the key form one group (``collapse``) or are all kept (``keep``). With
    ``count``, a column of that name says how many rows each one stands for.
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys={null_keys!r}")
    if not keys or not order_by:
        return df.withColumn(count, F.lit(1).cast("bigint")) if count else df
    if null_keys == "keep":
        kept = latest_per_key(
            df.filter(~any_null(keys)), keys, order_by, tie_breakers=tie_breakers, count=count
        )
        around = df.filter(any_null(keys))
        return kept.unionByName(around.withColumn(count, F.lit(1).cast("bigint")) if count else around)

    types = {f.name: f.dataType for f in df.schema.fields}
    # Grouping turns -0.0 into 0.0; such keys are taken from the row instead.
    grouped = [k for k in keys if not isinstance(types[k], (FloatType, DoubleType))]
    carried = [c for c in df.columns if c not in grouped]
    rows = [F.count(F.lit(1)).alias(count)] if count else []
    if not carried:
        return df.groupBy(*[ref(k) for k in keys]).agg(*rows) if rows else df.distinct()
    ranking = [c for c in dict.fromkeys([*order_by, *tie_breakers]) if c not in keys]
    others = [c for c in carried if c not in ranking]
    compared = ranking + [c for c in others if _sortable(types[c])]
    if set(compared) == set(carried):
        latest = F.max(F.struct(*[ref(c) for c in compared]))
    else:
        order = F.struct(*[ref(c) for c in compared] or [F.lit(0)])
        latest = F.max_by(F.struct(*[ref(c) for c in carried]), order)
    found = df.groupBy(*[ref(k) for k in keys]).agg(latest.alias(_ROW), *rows)
    row = F.col(_ROW)
    kept = [ref(c) if c in grouped else row[c].alias(c) for c in df.columns]
    return found.select(*kept, *([ref(count)] if count else []))


def latest_in_files(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    scratch: str,
    *,
    tie_breakers: Sequence[str] = (),
    null_keys: str = "collapse",
    limit: int | None = None,
) -> DataFrame:
    """``latest_per_key`` of a parquet scan, without moving its rows.

    Each row has a locator: its file and its place there. Keys, order columns and
    locators are shuffled; the other columns only of rows that tie for the latest, whose
    whole content decides. The locators of the rows that lose are written to
    ``scratch``, a folder that is not there yet, and go to the scan as a broadcast, which
    then leaves these rows out where they lie. Beyond ``limit`` bytes of them (by default
    what Spark itself would broadcast; about 200 bytes are reckoned a row) the
    rows are moved after all, by ``latest_per_key``. The result is the same.

    ``df`` must be a scan of parquet files, which it may filter or project.
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys={null_keys!r}")
    if not keys or not order_by:
        return df
    limit = broadcast_limit(df) if limit is None else limit
    located = df.select(
        *[ref(c) for c in df.columns],
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.row_index").alias(_PLACE),
    )
    locator, judged = [_FILE, _PLACE], located
    if null_keys == "keep":
        judged = located.filter(~any_null(keys))
    ranking = [c for c in dict.fromkeys([*order_by, *tie_breakers]) if c not in keys]
    named = [*keys, *ranking]
    # two steps, so that neither a hot key nor a hot tie meets in one task uncombined
    alike = judged.groupBy(*map(ref, named)).agg(
        F.count(F.lit(1)).alias(_ROWS), F.max(F.struct(*locator)).alias(_ROW)
    )
    rank = F.struct(*[ref(c) for c in ranking], ref(_ROWS), ref(_ROW))
    tops = alike.groupBy(*map(ref, keys)).agg(F.max(rank).alias("__top"))
    top = F.col("__top")
    alone = tops.filter(top[_ROWS] == 1).select(*[top[_ROW][c].alias(c) for c in locator])
    tied = tops.filter(top[_ROWS] > 1).select(
        *[ref(k).alias(f"__{i}") for i, k in enumerate(keys)],
        *[top[c].alias(f"__{len(keys) + i}") for i, c in enumerate(ranking)],
    )
    same = reduce(and_, [ref(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(named)])
    ties = judged.join(tied, same, "left_semi")
    won = latest_per_key(ties, keys, order_by, tie_breakers=tie_breakers).select(*locator)
    places = judged.select(*locator)
    places.join(alone.unionByName(won), locator, "left_anti").write.parquet(scratch)
    losers = df.sparkSession.read.schema(places.schema).parquet(scratch)
    if losers.count() * _LOCATOR_BYTES > limit:
        return latest_per_key(df, keys, order_by, tie_breakers=tie_breakers, null_keys=null_keys)
    kept = located.join(F.broadcast(losers), locator, "left_anti")
    return kept.select(*[ref(c) for c in df.columns])
