"""Merging a batch into a business table: SCD1, SCD2, and their building blocks.

All joins are equi-joins on the business key. Rows whose key holds a NULL can
match nothing; they go around the join, since an outer or anti join would send
them all to one task. The right side of every existence test is reduced to
distinct keys first.

Whatever pairs rows makes batch keys unique first, so a repeated key cannot fan out:
the row greatest by ``order_by`` stays, or without an order one chosen by its
content. Pass ``unique=True`` if the batch is unique already.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ..functions.casts import ref
from ..functions.sizing import fits_broadcast
from .dedupe import any_null, latest_per_key

START = "effective_start_date"
END = "effective_end_date"
CURRENT = "is_current"
HISTORY = (START, END, CURRENT)

# Which batch opened a version: with the key, it tells versions of one day apart.
OPENED = "__opened"

# Fixed value: the end date of a row that is still in force.
OPEN_END = "9999-12-31"

MODES = ("strict", "as_read")
PLANS = ("auto", "shuffle", "lookup")


def history_schema(batch: StructType) -> StructType:
    """Schema of the history table a batch of this schema merges into."""
    added = [
        StructField(START, StringType()),
        StructField(END, StringType()),
        StructField(CURRENT, BooleanType()),
    ]
    return StructType([f for f in batch.fields if f.name not in HISTORY] + added)


# --------------------------------------------------------------- existence


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(~any_null(keys))


def _unkeyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(any_null(keys))


def _unique(
    batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], unique: bool
) -> DataFrame:
    """Keyed batch rows, one per key."""
    keyed = _keyed(batch, keys)
    return keyed if unique else latest_per_key(keyed, keys, list(order_by) or list(keys))


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _keyed(df, keys).select(*[ref(k) for k in keys]).distinct()


def matched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    return df.join(_distinct_keys(other, keys), list(keys), "left_semi").select(*df.columns)


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; NULL keys stay."""
    absent = _keyed(df, keys).join(_distinct_keys(other, keys), list(keys), "left_anti")
    return absent.select(*df.columns).unionByName(_unkeyed(df, keys))


def merge_updates(batch: DataFrame, business: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows that replace a business row."""
    return matched(batch, business, keys)


def merge_inserts(batch: DataFrame, business: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows new to the business table."""
    return unmatched(batch, business, keys)


def merge_untouched(batch: DataFrame, business: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business rows the batch does not mention."""
    return unmatched(business, batch, keys)


def merge_left_join(
    batch: DataFrame,
    business: DataFrame,
    keys: Sequence[str],
    prefix: str = "business_",
    *,
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Batch rows, one per key, beside the business row of the same key, if any."""
    batch = _unique(batch, keys, order_by, unique).unionByName(_unkeyed(batch, keys))
    renamed = _keyed(business, keys).select(*[ref(c).alias(prefix + c) for c in business.columns])
    on = reduce(and_, [batch[k] == renamed[prefix + k] for k in keys])
    joined = _keyed(batch, keys).join(renamed, on, "left")
    return joined.unionByName(_unkeyed(batch, keys), allowMissingColumns=True)


# -------------------------------------------------------------------- SCD1


def scd1_merge(
    batch: DataFrame,
    business: DataFrame,
    keys: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Batch rows replace business rows of the same key; the rest is kept."""
    incoming = _unique(batch, keys, order_by, unique)
    # The unique rows' keys serve the anti join too, so the batch is shuffled once.
    known = incoming.select(*[ref(k) for k in keys])
    kept = _keyed(business, keys).join(known, list(keys), "left_anti").select(*business.columns)
    around = _unkeyed(batch, keys).unionByName(_unkeyed(business, keys))
    return incoming.unionByName(kept).unionByName(around)


# -------------------------------------------------------------------- SCD2


def _differs(old: str, new: str, tracked: Sequence[str], mode: str) -> Column:
    """Some tracked column differs: NULL-safe, or by ``<>`` when as read."""
    pairs = [(F.col(old)[c], F.col(new)[c]) for c in tracked]
    if not pairs:
        return F.lit(False)
    if mode == "strict":
        return reduce(or_, [~o.eqNullSafe(n) for o, n in pairs])
    return F.coalesce(reduce(or_, [o != n for o, n in pairs]), F.lit(False))


def _check(mode: str, plan: str = "auto") -> None:
    if mode not in MODES:
        raise ValueError(f"mode={mode!r}")
    if plan not in PLANS:
        raise ValueError(f"plan={plan!r}")


def _text(load_date: str | date) -> str:
    return load_date if isinstance(load_date, str) else load_date.isoformat()


def _in_force() -> Column:
    return F.coalesce(ref(CURRENT), F.lit(False))


def current_rows(business: DataFrame) -> DataFrame:
    return business.filter(_in_force())


def closed_rows(business: DataFrame) -> DataFrame:
    return business.filter(~_in_force())


def open_versions(batch: DataFrame, load_date: str | date) -> DataFrame:
    """Batch rows as versions in force from the load date on."""
    return batch.withColumns(
        {
            START: F.lit(_text(load_date)),
            END: F.lit(OPEN_END),
            CURRENT: F.lit(True),
        }
    )


def _closed(df: DataFrame, load_date: str | date) -> DataFrame:
    return df.withColumns({END: F.lit(_text(load_date)), CURRENT: F.lit(False)})


def _packed(df: DataFrame, keys: Sequence[str], name: str, columns: Sequence[str]) -> DataFrame:
    """(key columns, one struct): join sides whose names cannot clash."""
    body = F.struct(*[ref(c) for c in columns]).alias(name)
    return df.select(*[ref(k).alias(f"__key{i}") for i, k in enumerate(keys)], body)


def _joined_keys(keys: Sequence[str]) -> list[str]:
    return [f"__key{i}" for i in range(len(keys))]


def _lookup(
    df: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str
) -> DataFrame:
    """Keyed ``df`` rows as struct ``old``, matching ``other`` columns as ``new``.

    Only the columns the comparison needs cross the join on the right, so Spark
    broadcasts that side whenever its size allows.
    """
    left = _packed(df, keys, "old", df.columns)
    right = _packed(other, keys, "new", [*keys, *columns])
    return left.join(right, _joined_keys(keys), how)


def scd2_changed(
    business: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    *,
    mode: str = "strict",
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Business rows whose key is in the batch with other tracked values.

    ``strict`` looks at current rows and compares NULL-safely; ``as_read`` looks
    at closed rows too and overlooks changes from or to NULL.
    """
    _check(mode)
    existing = current_rows(business) if mode == "strict" else business
    incoming = _unique(batch, keys, order_by, unique)
    pairs = _lookup(_keyed(existing, keys), incoming, keys, tracked, "inner")
    return pairs.filter(_differs("old", "new", tracked, mode)).select("old.*")


def scd2_close_history(
    business: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_date: str | date,
    *,
    mode: str = "strict",
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """The changed business rows, each once, ended at the load date."""
    changed = scd2_changed(
        business, batch, keys, tracked, mode=mode, order_by=order_by, unique=unique
    )
    return _closed(changed, load_date)


def scd2_new_versions(
    business: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_date: str | date,
    *,
    mode: str = "strict",
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Versions the batch opens, one per key: new and changed keys, or all as read."""
    _check(mode)
    incoming = _unique(batch, keys, order_by, unique)
    if mode == "as_read":
        return open_versions(incoming.unionByName(_unkeyed(batch, keys)), load_date)
    opened = _fresh(incoming, _keyed(current_rows(business), keys), keys, tracked)
    return open_versions(opened.unionByName(_unkeyed(batch, keys)), load_date)


def _fresh(
    incoming: DataFrame, current: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key is new, or known with other tracked values."""
    # Narrow the current rows to the incoming keys first: that is a broadcast
    # semi join for a small batch, and leaves little to join against.
    wanted = incoming.select(*[ref(k) for k in keys])
    known = current.join(wanted, list(keys), "left_semi")
    pairs = _lookup(incoming, known, keys, tracked, "left")
    differs = F.col("new").isNull() | _differs("old", "new", tracked, "strict")
    return pairs.filter(differs).select("old.*")


def scd2_carry_forward(business: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business rows, history included, whose key is not in the batch."""
    return unmatched(business, batch, keys)


def scd2_apply(
    batch: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_date: str | date,
    *,
    plan: str = "auto",
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Current rows plus a batch: what is in force now, and what was just closed.

    Unchanged rows come back untouched, changed ones closed beside their new
    version, and new keys as new versions.

    plan    ``shuffle`` is one full outer join, each table shuffled once.
            ``lookup`` joins the batch to the current rows from the right, which
            leaves the business table where it is while Spark can broadcast the
            batch, and finds new keys by a second scan of the key columns only.
            ``auto`` looks at the batch's estimated size.
    """
    _check("strict", plan)
    if plan == "auto":
        plan = "lookup" if fits_broadcast(batch) else "shuffle"
    columns = [c for c in current.columns if c not in HISTORY]
    ordered = [*columns, *HISTORY]
    batch = batch.select(*[ref(c) for c in columns])
    current = current.select(*[ref(c) for c in ordered])
    incoming, known = _unique(batch, keys, order_by, unique), _keyed(current, keys)
    opened = open_versions(incoming, load_date)
    if plan == "shuffle":
        applied = _versions(known, opened, keys, tracked, load_date, "full")
    else:
        wanted = incoming.select(*[ref(k) for k in keys])
        found = known.select(*[ref(k) for k in keys]).join(wanted, list(keys), "left_semi")
        inserts = opened.join(found, list(keys), "left_anti").select(*ordered)
        applied = _versions(known, opened, keys, tracked, load_date, "left").unionByName(inserts)
    around = _unkeyed(current, keys).unionByName(open_versions(_unkeyed(batch, keys), load_date))
    return applied.unionByName(around)


def _versions(
    current: DataFrame,
    opened: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_date: str | date,
    how: str,
) -> DataFrame:
    """Join both sides by key and turn each pair into the versions it leaves."""
    ordered = current.columns
    left = _packed(current, keys, "old", ordered)
    right = _packed(opened, keys, "new", ordered)
    pairs = left.join(right, _joined_keys(keys), how)
    old, new = F.col("old"), F.col("new")
    replaced = {END: F.lit(_text(load_date)), CURRENT: F.lit(False)}
    ended = F.struct(*[replaced.get(c, old[c]).alias(c) for c in ordered])
    versions = (
        F.when(new.isNull(), F.array(old))
        .when(old.isNull(), F.array(new))
        .when(_differs("old", "new", tracked, "strict"), F.array(ended, new))
        .otherwise(F.array(old))
    )
    return pairs.select(F.inline(versions))


def keys_of(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of a batch, none NULL, repeated as they are."""
    return _keyed(batch, keys).select(*[ref(k) for k in keys])


def keys_fit_broadcast(batch: DataFrame, keys: Sequence[str]) -> bool:
    """True if Spark would broadcast a batch's keys, so that they can go to the table's rows."""
    return fits_broadcast(batch.select(*[ref(k) for k in keys]))


def scd2_changes(
    batch: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_date: str | date,
    *,
    plan: str = "auto",
    order_by: Sequence[str] = (),
    unique: bool = False,
    narrowed: bool = False,
) -> DataFrame:
    """Only what a batch changes: versions it closes and versions it opens.

    Current rows are scanned once. ``lookup`` first narrows them to the batch's keys
    by a semi join, which leaves them where they are while Spark can broadcast the
    keys; ``shuffle`` joins both tables, each shuffled once. Columns of ``current``
    besides the history columns must be in the batch. Pass ``narrowed=True`` if ``current``
    holds rows of the batch's keys only.
    """
    _check("strict", plan)
    if plan == "auto":
        plan = "lookup" if keys_fit_broadcast(batch, keys) else "shuffle"
    columns = [c for c in current.columns if c not in HISTORY]
    ordered = [*columns, *HISTORY]
    batch = batch.select(*[ref(c) for c in columns])
    known = _keyed(current.select(*[ref(c) for c in ordered]), keys)
    incoming = _unique(batch, keys, order_by, unique)
    if plan == "lookup" and not narrowed:
        wanted = keys_of(batch, keys)
        known = known.join(wanted, list(keys), "left_semi").select(*ordered)
    left = _packed(open_versions(incoming, load_date).select(*ordered), keys, "new", ordered)
    pairs = left.join(_packed(known, keys, "old", ordered), _joined_keys(keys), "left")
    old, new = F.col("old"), F.col("new")
    replaced = {END: F.lit(_text(load_date)), CURRENT: F.lit(False)}
    ended = F.struct(*[replaced.get(c, old[c]).alias(c) for c in ordered])
    versions = F.when(old.isNull(), F.array(new)).when(
        _differs("old", "new", tracked, "strict"), F.array(ended, new)
    )
    changes = pairs.select(F.inline(versions))
    return changes.unionByName(open_versions(_unkeyed(batch, keys), load_date).select(*ordered))


def scd2_merge(
    batch: DataFrame,
    business: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_date: str | date,
    *,
    mode: str = "strict",
    plan: str = "auto",
    order_by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """The whole history table after a batch.

    ``strict``   closed rows stay as they are; see ``scd2_apply`` for the rest.
    ``as_read``  every batch row opens a version; of the rows that share its key
                 only those that differ survive, all closed at the load date,
                 closed ones included. Kept for parity; it rewrites history.
    """
    _check(mode, plan)
    if mode == "strict":
        applied = scd2_apply(
            batch,
            current_rows(business),
            keys,
            tracked,
            load_date,
            plan=plan,
            order_by=order_by,
            unique=unique,
        )
        return closed_rows(business).select(*applied.columns).unionByName(applied)

    columns = [c for c in business.columns if c not in HISTORY]
    batch = batch.select(*[ref(c) for c in columns])
    incoming = _unique(batch, keys, order_by, unique)
    # One pass over the business table settles carry-forward and closing both.
    pairs = _lookup(_keyed(business, keys), incoming, keys, tracked, "left")
    hit = F.col("new").isNotNull()
    survives = pairs.filter(~hit | _differs("old", "new", tracked, mode))
    settled = survives.select(
        *[F.col("old")[c].alias(c) for c in columns],
        F.col("old")[START].alias(START),
        F.when(hit, F.lit(_text(load_date))).otherwise(F.col("old")[END]).alias(END),
        F.when(hit, F.lit(False)).otherwise(F.col("old")[CURRENT]).alias(CURRENT),
    )
    opened = open_versions(incoming.unionByName(_unkeyed(batch, keys)), load_date)
    return settled.unionByName(_unkeyed(business, keys)).unionByName(opened)
