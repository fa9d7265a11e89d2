"""Change application as frame transforms: ``new table = f(old table, change feed)``.

Nothing is written here; ``tidemill.sources.tables`` stores a result as the next folder of a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.aggregates import maximum
from tidemill.operators.joins import new_rows, same
from tidemill.operators.ordered import changes_of_state, dense_keys
from tidemill.operators.sets import keep_first


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"several rows share one key {list(keys)}: {repeated.first()}")


def upsert(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], check: bool = True, null_keys: bool = True
) -> DataFrame:
    """Update rows whose key is in ``source``, insert the rest; null keys match each other.

    ``target=None`` is the first load. A key that ``source`` holds twice is an error, since
    which of its rows should win is unknown. Without ``null_keys`` a null key in ``source`` is an error, and a
    target in buckets of its keys (``catalog.save_bucketed``) is joined where it lies.
    """
    if check:
        require_unique(source, keys)
    if not null_keys:
        source = keyed(source, keys)
    if target is None:
        return source
    arriving = source.select(*keys).alias("new")
    untouched = target.alias("old").join(
        arriving, same("old", "new", [(k, k) for k in keys], null_safe=null_keys), "left_anti"
    )
    return untouched.unionByName(source)


def upsert_latest(target: DataFrame | None, source: DataFrame, keys: Sequence[str], *newest: Column) -> DataFrame:
    """Upsert a feed that may repeat keys; the row that comes first by ``newest`` wins."""
    return upsert(target, keep_first(source, keys, *newest), keys, check=False)


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, failing the job at a null in a key column."""
    missing = F.lit(False)
    for key in keys:
        missing |= F.col(key).isNull()
    message = F.lit(f"a key of {list(keys)} is null")
    return df.filter(F.when(missing, F.raise_error(message).cast("boolean")).otherwise(True))


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Append the rows whose key is new, one per key; a null key is an error, as in a primary key."""
    return target.unionByName(new_rows(keep_first(keyed(source, keys), keys, *order), target, keys))


def latest(log: DataFrame, keys: Sequence[str], *newest: Column) -> DataFrame:
    """The newest version of every key in a change log."""
    return keep_first(log, keys, *newest)


def newer_than_stored(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows newer than the newest stored one; everything on the first run.

    The mark, one value, is fetched first: as a constant it reaches the scan of the source,
    which then skips what is older.
    """
    mark = None if target is None else target.select(F.max(column).cast("string")).first()[0]
    if mark is None:
        return source
    return source.filter(F.col(column) > F.lit(mark).cast(source.schema[column].dataType))


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    return df.withColumns({
        name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()
    })


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove matching rows; rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def scd1(
    dimension: DataFrame | None,
    feed: DataFrame,
    natural_key: str,
    surrogate: str,
    now: Column,
    *order: Column,
) -> DataFrame:
    """Dimension that keeps the newest attributes only.

    Known members keep their key and ``create_date``; new ones get the next dense keys. A null
    natural key is one member, however often it is loaded.
    """
    feed = keep_first(feed, [natural_key], *(order or [F.col(natural_key)]))
    if dimension is None:
        return dense_keys(feed.withColumns({"create_date": now, "update_date": now}), natural_key, surrogate)
    old = dimension.select(natural_key, surrogate, "create_date", F.lit(True).alias("_known")).alias("old")
    arriving = feed.withColumn("update_date", now).alias("new")
    matched = same("old", "new", [(natural_key, natural_key)], null_safe=True)
    marked = arriving.join(old, matched, "left").select("new.*", surrogate, "create_date", "_known")
    known = marked.filter("_known").drop("_known")
    fresh = marked.filter("_known IS NULL").drop("_known", surrogate).withColumn("create_date", now)
    fresh = dense_keys(fresh, natural_key, surrogate, after=maximum(dimension, surrogate, F.lit(0)))
    untouched = dimension.alias("old").join(arriving.select(natural_key).alias("new"), matched, "left_anti")
    return untouched.unionByName(known).unionByName(fresh)


def scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    tracked: Sequence[str],
    section_rows: int | None = None,
) -> DataFrame:
    """Every version of every key, valid in ``[valid_from, valid_to)``.

    ``sequence`` orders the log (its first column dates the versions). Repeats without a
    change collapse into one version. A key with a very long history is not one task's work.
    """
    moment = sequence[0]
    log = log.select(*keys, *dict.fromkeys([*sequence, *tracked]))
    state = F.col(tracked[0]) if len(tracked) == 1 else F.struct(*tracked)
    versions = changes_of_state(log, keys, sequence, state, "valid_to", section_rows)
    return versions.select(
        *keys, *tracked, F.col(moment).alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_step(
    stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str]
) -> DataFrame:
    """Apply a batch of changes to a stored history, as if the whole log had been folded.

    Only keys of the batch are worked on. The result holds every observation, since a late row
    may make a version of one that repeated its predecessor; ``scd2_versions`` shows the versions.
    A row that was applied before changes nothing; two different rows of a key with one
    sequence value, and a null one, are errors.
    """
    arriving = batch.select(*keys, *tracked, F.col(sequence).alias("valid_from")).distinct()
    if stored is None:
        return _observed(arriving, keys, tracked)
    own = same("old", "new", [(k, k) for k in keys], null_safe=True)
    touched = arriving.select(*keys).distinct().alias("new")
    known = stored.select(*keys, *tracked, "valid_from").alias("old").join(touched, own, "left_semi")
    untouched = stored.alias("old").join(touched, own, "left_anti")
    return untouched.unionByName(_observed(known.unionByName(arriving).distinct(), keys, tracked))


def _observed(rows: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    versions = scd2(rows, keys, ["valid_from"], tracked).select(*keys, "valid_from", "valid_to", "is_current")
    place = same("old", "new", [(k, k) for k in [*keys, "valid_from"]], null_safe=True)
    return rows.alias("old").join(versions.alias("new"), place, "left").select(
        "old.*", "new.valid_to", "new.is_current"
    )


def scd2_versions(stored: DataFrame) -> DataFrame:
    """The versions of a history kept by ``scd2_step``."""
    return stored.filter(F.col("is_current").isNotNull())


def upsert_newer(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], *sequence: str) -> DataFrame:
    """Upsert a feed that repeats keys: the row with the largest ``sequence`` wins, stored or not.

    An older row that comes late never replaces a newer one, and a batch replayed changes
    nothing. Rows of a key that share the largest sequence but differ are an error. Only stored rows
    whose key is in the batch are worked on; the others pass as they are.
    """
    if target is None:
        return _newest(batch, keys, sequence)
    own = same("old", "new", [(k, k) for k in keys], null_safe=True)
    touched = batch.select(*keys).distinct().alias("new")
    known = target.alias("old").join(touched, own, "left_semi")
    untouched = target.alias("old").join(touched, own, "left_anti")
    return untouched.unionByName(_newest(known.unionByName(batch.select(*target.columns)), keys, sequence))


def _newest(rows: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The row with the largest sequence of every key; an open order fails the job."""
    place, row = F.struct(*sequence), F.struct(*rows.columns)
    at_place = rows.groupBy(*keys, place.alias("_place")).agg(F.min(row).alias("_least"), F.max(row).alias("_row"))
    blank = F.greatest(*[F.col(f"_place.{c}").isNull() for c in sequence], F.lit(False))
    newest = at_place.groupBy(*keys).agg(F.max_by(F.struct("_least", "_row"), "_place").alias("_of"), F.max(blank).alias("_blank"))
    message = F.lit(f"rows of one {list(keys)} have the same or no {list(sequence)}")
    open_order = F.col("_blank") | ~F.col("_of._least").eqNullSafe(F.col("_of._row"))
    checked = newest.filter(F.when(open_order, F.raise_error(message).cast("boolean")).otherwise(True))
    return checked.select("_of._row.*").select(*rows.columns)


def fold_batches(batches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Apply dimension batches in order, newest attributes winning; a batch holds a key once."""
    log = _log(batches, "_batch")
    return upsert_newer(None, log, keys, "_batch").drop("_batch")


def _log(batches: Sequence[DataFrame], number: str) -> DataFrame:
    log = None
    for i, df in enumerate(batches):
        df = df.withColumn(number, F.lit(i))
        log = df if log is None else log.unionByName(df)
    return log


def fold_history(batches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All versions over the batches; ``valid_from`` is the batch number."""
    log = _log(batches, "batch")
    tracked = [c for c in log.columns if c not in keys and c != "batch"]
    return scd2(log, keys, ["batch"], tracked)
