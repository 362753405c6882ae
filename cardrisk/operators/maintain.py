"""Partition-scoped table maintenance on date-partitioned layers.

Plain Parquet has no transaction log, so every change is a rewrite of the
date partitions it touches, never of the whole table:

1. compute the new content of the touched partitions as a DataFrame
   (joins against the change set, broadcast only when it is proven small;
   a larger key set is first tested as a Bloom filter, see ``bloom``);
2. write it once, as a new version of those partitions, and switch the layer's
   manifest to it (``sources.versions``).  The table is read while it is
   written, but never overwritten: a failure before the switch leaves it whole,
   and a touched partition that became empty leaves the table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BATCH_COL, DATE_COL, FROM_COL, KEY_COL, PUBLISHED_COLUMNS, TO_COL
from ..session import drop_path, has_path, scratch_path
from ..sinks.writers import write_layer
from ..sources import versions
from ..sources.readers import read_layer
from . import bloom
from .joins import dimension_fits, semi_join_keys
from .quality import assert_no_leaks


def stage(spark: SparkSession, df: DataFrame, name: str = "stage", fmt: str = "parquet") -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it back."""
    return _staged(spark, df, name, fmt)[0]


def _staged(spark: SparkSession, df: DataFrame, name: str, fmt: str) -> tuple[DataFrame, str]:
    path = scratch_path(spark, name)
    df.write.format(fmt).mode("overwrite").save(path)
    return read_layer(spark, path, fmt), path


def replace_partitions(df: DataFrame, path: str, partition_col: str = DATE_COL,
                       fmt: str = "parquet") -> str:
    """Replace only the partitions present in ``df``."""
    versions.replace(df.sparkSession, path, df, [partition_col], fmt)
    return path


def _partition(col: str, value) -> str:
    if value is None:
        return f"{col}=__HIVE_DEFAULT_PARTITION__"
    return f"{col}={value.isoformat() if isinstance(value, (_dt.date, _dt.datetime)) else value}"


def touched_values(df: DataFrame, partition_col: str = DATE_COL) -> list:
    """The distinct partition values of ``df``, on the driver.

    Bounded by the number of partitions (one value per date), never by the
    number of rows; collected *before* the table is rewritten, so the list
    does not change under the rewrite.
    """
    return sorted(r[0] for r in df.select(partition_col).distinct().collect())


def rewrite_partitions(spark: SparkSession, path: str, content: DataFrame, touched: list,
                       partition_col: str = DATE_COL, fmt: str = "parquet", keep: int = 2) -> dict:
    """Replace the partitions whose values are listed in ``touched`` by ``content``;
    those without rows in it leave the table.  ``keep``: versions kept (see ``versions``)."""
    if not touched:
        return {"rewritten": 0, "emptied": 0, "touched": []}
    done = versions.replace(spark, path, content, [partition_col], fmt,
                            gone=[_partition(partition_col, v) for v in touched], keep=keep)
    return {"rewritten": len(done["written"]), "emptied": len(done["left"]), "touched": list(touched)}


_HASH_BITS = 62


def _rank(df: DataFrame, lead: Sequence[str], rest: Sequence[str]) -> Column | None:
    """The order column (NULL first) and a hash of the ``rest`` as one DECIMAL(38,0),
    or None if the order does not fit 64 bits."""
    if len(lead) > 1 or "_rank" in df.columns or any(
            isinstance(f.dataType, (T.MapType, T.VariantType)) for f in df.schema.fields):
        return None
    digest = F.xxhash64(*rest) if rest else F.lit(0).cast("long")
    digest = digest.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)).cast("decimal(19,0)")
    if not lead:
        return digest.cast("decimal(38,0)")
    kind, col = df.schema[lead[0]].dataType, F.col(lead[0])
    if isinstance(kind, T.DateType):
        col = F.unix_date(col)
    elif isinstance(kind, T.TimestampType):
        col = F.unix_micros(col)
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        col = (col * F.lit(10 ** kind.scale).cast("decimal(19,0)")).cast("decimal(19,0)")
    elif not isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return None
    place = F.coalesce(col.cast("decimal(19,0)") + F.lit(str((1 << 63) + 1)).cast("decimal(19,0)"),
                       F.lit(0).cast("decimal(19,0)"))
    return (place * F.lit(1 << _HASH_BITS).cast("decimal(19,0)") + digest).cast("decimal(38,0)")


def latest_per_key(df: DataFrame, key: str = KEY_COL,
                   order_col: str | Sequence[str] | None = BATCH_COL) -> DataFrame:
    """One row per non-NULL key: the row with the greatest ``order_col`` (or
    columns, compared in turn; ties, or every row when it is None, are broken on the
    remaining columns, so the pick is deterministic).  Rows with a NULL key
    cannot be matched and are passed through unchanged.

    An order of at most one fixed-width column is packed with a hash of the remaining
    columns into one DECIMAL: a hash aggregate with a 16-byte buffer finds the
    winner of each key, combined before the shuffle, and a join fetches its row.  Only wholly
    equal rows share a winner's rank (the hash has 62 bits); they are one row.
    Other orders take ``max(struct(order, ...))``, a sort aggregate that sorts each
    task's rows and sends one per key.
    """
    lead = [order_col] if isinstance(order_col, str) else list(order_col or [])
    rest = [c for c in df.columns if c != key and c not in lead]
    rank = _rank(df, lead, rest)
    if rank is not None:
        rows = df.filter(F.col(key).isNotNull()).withColumn("_rank", rank)
        top = rows.groupBy(key).agg(F.max("_rank").alias("_rank"))
        best = rows.join(top, [key, "_rank"]).select(*df.columns).dropDuplicates()
        return best.unionByName(df.filter(F.col(key).isNull()))
    best = (df.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.max(F.struct(*lead, *rest)).alias("_latest"))
            .select(key, *[F.col(f"_latest.{c}").alias(c) for c in [*lead, *rest]]))
    return best.unionByName(df.filter(F.col(key).isNull()))


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: str = KEY_COL,
           order_col: str | Sequence[str] | None = None, partition_col: str = DATE_COL,
           fmt: str = "parquet", key_scope: str = "table", null_scope: str | None = None) -> dict:
    """R2: MERGE ``updates`` into the table at ``path`` by ``key``.

    The change set is first reduced to one row per key: the latest version
    by ``order_col``, or a deterministic pick when no order is given (a
    repeated record).  Matched keys are replaced, unmatched updates are
    inserted, NULL keys never match.  The partitions rewritten are those of
    the updates plus those where a replaced row used to live (a row whose
    date changed touches two partitions).

    ``key_scope='table'`` (exact) looks the keys up in the whole table (only
    the key and date columns are read).  ``key_scope='dates'`` is for tables
    whose records never change date: the lookup is restricted to the
    partitions of the change set, so a daily increment reads a few
    partitions instead of every key of the history.

    ``null_scope`` names a column that says where a row came from (its raw
    file): NULL-key rows of the touched partitions from the same origins as
    the updates are replaced, so a replayed change set does not add them twice.
    """
    if key_scope not in ("table", "dates"):
        raise ValueError("key_scope must be 'table' or 'dates'")
    base = read_layer(spark, path, fmt)
    cols = base.columns
    # one row per key, cast to the table's types (schema enforcement), staged
    # once so the dedupe is not recomputed by every later job
    updates = latest_per_key(updates, key, order_col)
    updates, scratch = _staged(spark, updates.select(
        *[F.col(c).cast(base.schema[c].dataType).alias(c) for c in cols]), "changes", fmt)
    new_keys = updates.select(key).filter(F.col(key).isNotNull())
    fits, n_keys, _ = dimension_fits(new_keys)
    # a key set too large to broadcast is a Bloom filter inside the scan; only rows that pass are shuffled
    seen = None if fits else bloom.key_filter(new_keys, key, n_keys)
    landing = updates.select(partition_col)
    if key_scope == "table":
        old = base.select(key, partition_col).filter(F.col(key).isNotNull())
        old = old if fits else bloom.may_hold(old, seen, key, n_keys)
        landing = landing.unionByName(semi_join_keys(old, new_keys, key, fits=fits).select(partition_col))
    touched = touched_values(landing, partition_col)
    scope = base.filter(F.col(partition_col).isin(touched))
    # NULL keys never match: they bypass the anti-join instead of all hashing
    # into one shuffle partition.
    kept = scope.filter(F.col(key).isNull())
    if null_scope:
        kept = semi_join_keys(kept, updates.select(null_scope).distinct(), null_scope, anti=True)
    keyed = scope.filter(F.col(key).isNotNull())
    if not fits:
        marked = bloom.marked(keyed, seen, key, n_keys)
        kept = kept.unionByName(marked.filter(~F.col(bloom.MARK)).select(*cols))
        keyed = marked.filter(F.col(bloom.MARK)).select(*cols)
    kept = kept.unionByName(semi_join_keys(keyed, new_keys, key, anti=True, fits=fits))
    stats = rewrite_partitions(spark, path, kept.unionByName(updates), touched, partition_col, fmt)
    drop_path(spark, scratch)
    return stats


def erase(spark: SparkSession, path: str, subjects: DataFrame, subject_col: str = "user_id",
          partition_col: str = DATE_COL, fmt: str = "parquet",
          locate_in: DataFrame | None = None, keep: int = 1) -> dict:
    """Delete every row of the listed subjects (e.g. users), rewriting
    only the partitions that hold one of their rows.  Older versions of those
    partitions are deleted too (``keep=1``).  ``plans.ledgers`` keeps the request, so
    that a rebuild from Bronze does not bring the rows back.

    ``locate_in`` is an optional smaller table with the same
    (subject, partition) pairs, e.g. Gold (one row per user-day) when
    erasing from Silver, used to find the partitions to rewrite without
    scanning the big table.
    """
    base = read_layer(spark, path, fmt)
    ids = subjects.select(subject_col)
    fits = dimension_fits(ids)[0]
    # (subject, date) pairs first: the partial aggregate collapses a hot
    # subject's rows map-side, so no task sees a third of the table.
    source = base if locate_in is None else locate_in
    pairs = source.select(subject_col, partition_col).distinct()
    touched = touched_values(semi_join_keys(pairs, ids, subject_col, fits=fits), partition_col)
    scope = base.filter(F.col(partition_col).isin(touched))
    # rows without a subject bypass the anti-join, as in ``upsert``
    kept = (semi_join_keys(scope.filter(F.col(subject_col).isNotNull()), ids, subject_col,
                           anti=True, fits=fits)
            .unionByName(scope.filter(F.col(subject_col).isNull())))
    return rewrite_partitions(spark, path, kept, touched, partition_col, fmt, keep)


def append_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                 partition_by: Sequence[str] = (BATCH_COL,)) -> str:
    """R4 (write side): append ``df`` as batch ``batch_id`` (append-only history)."""
    if has_path(df.sparkSession, f"{path.rstrip('/')}/_manifest"):     # rows were erased from it
        rows = df.withColumn(BATCH_COL, F.lit(int(batch_id)))
        if read_layer(df.sparkSession, path, fmt).filter(F.col(BATCH_COL) == int(batch_id)).limit(1).count():
            raise ValueError(f"batch {batch_id} is in {path} already")
        versions.replace(df.sparkSession, path, rows, list(partition_by), fmt, rebalance=False)
        return path
    return write_layer(df.withColumn(BATCH_COL, F.lit(int(batch_id))), path, fmt=fmt,
                       mode="append", partition_by=list(partition_by), rebalance=False)


def read_as_of(spark: SparkSession, path: str, batch_id: int, key: str | None = None,
               fmt: str = "parquet", erased: DataFrame | None = None,
               subject_col: str = "user_id") -> DataFrame:
    """The table as it was after batch ``batch_id``.

    ``_batch_id`` is a partition column, so later batches are pruned.  With
    ``key`` the latest version of each key (by batch) is returned; without,
    the batches are a plain append-only log.  Rows of the subjects in ``erased``
    (``plans.ledgers.erased``) are left out.
    """
    df = read_layer(spark, path, fmt).filter(F.col(BATCH_COL) <= F.lit(int(batch_id)))
    if erased is not None:
        from ..plans.ledgers import without_erased
        df = without_erased(df, erased, subject_col)
    if key:
        df = latest_per_key(df, key, BATCH_COL)
    return df


OPEN = 2147483647      # ``_to`` of a version that is still valid


def append_version(df: DataFrame, path: str, batch_id: int, key: str = KEY_COL,
                   order_col: str | Sequence[str] | None = None, partition_col: str = DATE_COL,
                   fmt: str = "parquet") -> dict:
    """R4 (write side, interval-coded): append ``df`` as batch ``batch_id`` of a keyed history.

    Every version carries the batches it is valid for, from ``_from`` up to before
    ``_to``.  The history is partitioned by ``_to`` and the date, so the open versions
    are a table of their own: appending reads the keys of that table only, through the
    Bloom filter if the batch is large, and rewrites the dates where a version is
    closed or added.  Closed versions move to ``_to=<batch>`` and are never
    written again.  One manifest switch makes the batch visible as a whole.

    Of several rows of a key the latest by ``order_col`` enters (see ``latest_per_key``).
    Rows with a NULL key are never closed.  Dates must not be NULL.  Batches come in rising
    order; another order raises ValueError.
    """
    spark, batch = df.sparkSession, int(batch_id)
    layout, live = [TO_COL, partition_col], F.col(TO_COL) == F.lit(OPEN)
    rows = latest_per_key(df, key, order_col).withColumns({FROM_COL: F.lit(batch), TO_COL: F.lit(OPEN)})
    if versions.manifest(spark, path) is None:
        done = versions.replace(spark, path, rows, layout, fmt)
        return {"rewritten": len(done["written"]), "emptied": 0}
    base = read_layer(spark, path, fmt)
    if (base.agg(F.max(FROM_COL)).first()[0] or 0) >= batch:
        raise ValueError(f"batch {batch} does not follow the batches of {path}")
    rows, scratch = _staged(spark, rows.select(
        *[F.col(c).cast(base.schema[c].dataType).alias(c) for c in base.columns]), "changes", fmt)
    new_keys = rows.select(key).filter(F.col(key).isNotNull())
    fits, n_keys, _ = dimension_fits(new_keys)
    seen = None if fits else bloom.key_filter(new_keys, key, n_keys)
    old = base.filter(live).select(key, partition_col).filter(F.col(key).isNotNull())
    old = semi_join_keys(old if fits else bloom.may_hold(old, seen, key, n_keys), new_keys, key, fits=fits)
    touched = touched_values(rows.select(partition_col).unionByName(old.select(partition_col)), partition_col)
    scope, left = base.filter(live & F.col(partition_col).isin(touched)), None
    if not fits:  # rows that surely match no key, NULL keys among them, are not shuffled
        marked = bloom.marked(scope, seen, key, n_keys)
        left = marked.filter(~F.col(bloom.MARK)).select(*base.columns)
        scope = marked.filter(F.col(bloom.MARK)).select(*base.columns)
    hits = new_keys.withColumn("_hit", F.lit(True))
    scope = scope.join(F.broadcast(hits) if fits else hits, key, "left")
    scope = scope.withColumn(TO_COL, F.when(F.col("_hit"), F.lit(batch)).otherwise(F.col(TO_COL)))
    content = scope.select(*base.columns).unionByName(rows)
    content = content if left is None else content.unionByName(left)
    done = versions.replace(spark, path, content, layout, fmt,
                            gone=[f"{TO_COL}={OPEN}/{_partition(partition_col, v)}" for v in touched])
    drop_path(spark, scratch)
    return {"rewritten": len(done["written"]), "emptied": len(done["left"])}


def read_version(spark: SparkSession, path: str, batch_id: int, fmt: str = "parquet",
                 erased: DataFrame | None = None, subject_col: str = "user_id") -> DataFrame:
    """An interval-coded history as it was after batch ``batch_id``, one row per key.

    A filter and no more: ``_to`` prunes partitions, ``_from`` is pushed into the
    scan.  ``_from`` is returned as ``_batch_id``; ``erased`` as in ``read_as_of``.
    """
    batch = F.lit(int(batch_id))
    df = read_layer(spark, path, fmt).filter((F.col(FROM_COL) <= batch) & (F.col(TO_COL) > batch))
    if erased is not None:
        from ..plans.ledgers import without_erased
        df = without_erased(df, erased, subject_col)
    return df.withColumnRenamed(FROM_COL, BATCH_COL).drop(TO_COL)


def published_view(df: DataFrame, layer: str, role: str = "analyst",
                   check: bool = True) -> DataFrame:
    """The allow-listed projection of ``layer`` for ``role``.

    With ``check`` the Q3 (schema) and Q4 (content) gates run first and a
    possible card number anywhere in the projection raises ``QualityError``.
    """
    try:
        allowed = PUBLISHED_COLUMNS[(role, layer)]
    except KeyError:
        raise PermissionError(f"role {role!r} may not read layer {layer!r}") from None
    out = df.select(*[c for c in allowed if c in df.columns])
    if check:
        assert_no_leaks(out, layer)
    return out


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str, dates: list,
                 threshold: int | None = None, fmt: str = "parquet") -> dict:
    """Recompute Gold only for ``dates`` from the Silver table (static
    partition pruning on the read) and rewrite those Gold partitions; a date
    with no Silver rows left is emptied in Gold too."""
    from .gold import RISK_THRESHOLD, risk_profile
    silver = read_layer(spark, silver_path, fmt).filter(F.col(DATE_COL).isin(list(dates)))
    gold = risk_profile(silver, RISK_THRESHOLD if threshold is None else threshold)
    return rewrite_partitions(spark, gold_path, gold, list(dates), DATE_COL, fmt)
