"""Ordered calculations that stay parallel inside one group.

A plain window sends a whole group to one task, so a year or a device that holds a third of all
rows becomes the slowest task of the job. ``Sections`` cuts the rows, sorted by group and order,
into sections of a bounded number of rows: a section holds many small groups or a stretch of a
large one. Windows run per section, and a group that goes on into the next section carries its
totals over. Only the first group of a section can have begun earlier and only its last one can
go on, so there is at most one carried row per section and direction.

Results do not depend on where the cuts fall; they only balance the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

from tidemill.session import stored

SECTION = "_section"
# One task sorts this many rows without trouble.
SECTION_ROWS = 250_000
# Spark samples a million rows at most to find ranges: this many get a hundred each.
RANGES = 10_000


class Sections:
    """The rows of a frame in sections of at most ``section_rows`` rows.

    ``order`` sorts the rows of a group; the place in the stored input comes last, so equal
    rows, nulls and any crowded value are cut like all others. The input is evaluated once. If it
    has more rows than fit in one section, it is range-partitioned and sorted once, and the rows of
    each sorted partition are cut by their number: the bound holds however uneven the sampled
    partitions are, and a section's number follows the order.
    """

    def __init__(self, df: DataFrame, by: Sequence[str], order: Sequence[Column], section_rows: int | None = None):
        self.by = list(by)
        most = section_rows or SECTION_ROWS
        counted = Observation()
        kept = stored(df.observe(counted, F.count(F.lit(1)).alias("rows")), "ordered")
        total = counted.get["rows"]
        self.cut = total > most
        self.rows = kept.withColumn(SECTION, F.lit(0).cast("long"))
        if self.cut:
            ranges = max(min(-(-total // most), RANGES), df.sparkSession.sparkContext.defaultParallelism)
            full = [*by, *order, "_place"]
            placed = kept.withColumn("_place", F.monotonically_increasing_id())
            cut = placed.repartitionByRange(ranges, *full).sortWithinPartitions(*full).drop("_place")
            # The id is the partition and, below it, the row in the sorted partition.
            number = F.monotonically_increasing_id()
            row = number.bitwiseAND(F.lit((1 << 33) - 1))
            section = number - row + F.floor(row / F.lit(most))
            self.rows = stored(cut.withColumn(SECTION, section.cast("long")), "sections")
        self.rows = self.rows.repartition(SECTION) if self.cut or not self.by else self.rows

    def inside(self, *order: Column) -> WindowSpec:
        """The rows of one group in one section."""
        return Window.partitionBy(SECTION, *self.by).orderBy(*order)

    def summary(self, rows: DataFrame, *totals: Column) -> DataFrame:
        """One row per group and section."""
        return rows.groupBy(SECTION, *self.by).agg(*totals)

    def across(self) -> WindowSpec:
        """A group's sections in order: no more rows than there are sections."""
        return Window.partitionBy(*self.by).orderBy(SECTION)

    def attach(self, rows: DataFrame, summary: DataFrame, spans: Column, carried: dict[str, Column]) -> DataFrame:
        """Add what a group carries over from (or to) other sections; null where it does not.

        ``carried`` and ``spans``, which tells whether there is another section on that side, are
        window expressions over the summary.
        """
        if not self.cut:
            return rows.withColumns({name: F.lit(None).cast(kind) for name, kind in self._kinds(summary, carried)})
        kept = summary.withColumns(carried).filter(spans).select(
            SECTION, *[F.col(c).alias(f"_of_{c}") for c in self.by], *carried, F.lit(True).alias("_spans")
        )
        joined = rows.join(kept, SECTION, "left")
        same = F.coalesce(F.col("_spans"), F.lit(False))
        for c in self.by:
            same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        return joined.withColumns({name: F.when(same, F.col(name)) for name in carried}).drop(
            "_spans", *[f"_of_{c}" for c in self.by]
        )

    def _kinds(self, summary: DataFrame, carried: dict[str, Column]):
        schema = summary.withColumns(carried).schema
        return [(name, schema[name].dataType) for name in carried]


def ranked(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    *,
    tie: str | None = None,
    descending: bool = False,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    section_rows: int | None = None,
) -> DataFrame:
    """Add SQL's ``row_number``, ``rank`` and ``dense_rank`` under the given names.

    Rows are ordered by ``order``; ``tie`` decides between equal rows and only matters for
    ``row_number``. Nulls sort first ascending and last descending, as in Spark.
    """
    key = F.col(order).desc() if descending else F.col(order).asc()
    full = [key, F.col(tie).asc()] if tie else [key]
    sections = Sections(df, by, full, section_rows)
    rows = sections.rows.withColumns({
        "_row": F.row_number().over(sections.inside(*full)),
        "_rank": F.rank().over(sections.inside(key)),
        "_dense": F.dense_rank().over(sections.inside(key)),
    })
    summary = sections.summary(
        rows, F.count("*").alias("_rows"), F.max("_rank").alias("_top"), F.max("_dense").alias("_values"),
        F.min_by(F.struct(order), "_row").alias("_first"), F.max_by(F.struct(order), "_row").alias("_last"),
    )
    across = sections.across()
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumns({
        "_before": F.sum("_rows").over(earlier),
        # The section begins with the value the one before ends with.
        "_goes_on": F.coalesce(F.lag("_last").over(across).eqNullSafe(F.col("_first")), F.lit(False)),
    })
    summary = summary.withColumn("_goes_on", F.col("_goes_on") & F.col("_before").isNotNull())
    # Where the section's last value begins: here, unless the section is all of a value that goes on.
    here = (F.col("_top") > 1) | ~F.col("_goes_on")
    summary = summary.withColumn("_begins", F.when(here, F.coalesce("_before", F.lit(0)) + F.col("_top")))
    rows = sections.attach(rows, summary, F.col("_before").isNotNull(), {
        "_row_base": F.col("_before"),
        "_run": F.when(F.col("_goes_on"), F.last("_begins", ignorenulls=True).over(earlier)),
        "_dense_base": F.sum(F.col("_values") - F.col("_goes_on").cast("int")).over(earlier) - F.col("_goes_on").cast("int"),
    })
    base = F.coalesce("_row_base", F.lit(0))
    result = {
        row_number: base + F.col("_row"),
        rank: F.when(F.col("_run").isNotNull() & (F.col("_rank") == 1), F.col("_run")).otherwise(base + F.col("_rank")),
        dense_rank: F.coalesce("_dense_base", F.lit(0)) + F.col("_dense"),
    }
    result = {name: value.cast("bigint") for name, value in result.items() if name}
    return rows.withColumns(result).select(*[c for c in df.columns if c not in result], *result)


def dense_keys(
    df: DataFrame, natural_key: str, name: str, after: Column | None = None,
    section_rows: int | None = None,
) -> DataFrame:
    """Surrogate keys 1..n in the order of the natural key, on top of ``after`` if given."""
    keyed = ranked(df, [], natural_key, row_number=name, section_rows=section_rows)
    if after is None:
        return keyed
    return keyed.withColumn(name, (F.coalesce(after, F.lit(0)) + F.col(name)).cast("bigint"))


def batch_numbers(
    df: DataFrame, order: str, size: int, name: str, section_rows: int | None = None
) -> DataFrame:
    """Number consecutive batches of ``size`` rows from 1."""
    placed = ranked(df, [], order, row_number="_position", section_rows=section_rows)
    return placed.withColumn(
        name, (F.floor((F.col("_position") - 1) / size) + 1).cast("bigint")
    ).drop("_position")


def changes_of_state(
    df: DataFrame, by: Sequence[str], order: Sequence[str], state: Column, until: str,
    section_rows: int | None = None,
) -> DataFrame:
    """The rows at which a group's state changes, with the moment of the next change.

    The first column of ``order`` is the moment. A null in ``order``, or two rows of a group
    that agree in it, leave the order open and fail the job.
    """
    order_by = [F.col(c).asc() for c in order]
    sections = Sections(df.withColumn("_state", state), by, order_by, section_rows)
    moment, place = order[0], F.struct(*order)
    window = sections.inside(*order_by)
    rows = sections.rows.withColumns({
        "_prior": F.lag("_state").over(window), "_prior_place": F.lag(place).over(window),
        "_opens": F.lag(F.lit(1)).over(window).isNull(), "_row": F.row_number().over(window),
    })
    summary = sections.summary(
        rows, F.min_by(F.struct("_state"), "_row").alias("_opening"), F.max_by(F.struct("_state"), "_row").alias("_closing"),
        F.max_by(place, "_row").alias("_last_place"), F.min_by(F.struct(moment), "_row").alias("_first"),
        F.min(F.when(~F.col("_opens") & ~F.col("_prior").eqNullSafe(F.col("_state")), F.struct(moment))).alias("_second"),
    )
    across = sections.across()
    later = across.rowsBetween(1, Window.unboundedFollowing)
    summary = summary.withColumn("_carried", F.lag("_closing").over(across))
    repeats = F.col("_carried").isNotNull() & F.col("_carried").eqNullSafe(F.col("_opening"))
    summary = summary.withColumn("_change", F.when(repeats, F.col("_second")).otherwise(F.col("_first")))
    rows = sections.attach(rows, summary, F.col("_carried").isNotNull(), {
        "_before": F.col("_carried"), "_before_place": F.lag("_last_place").over(across),
    })
    prior_place = F.coalesce("_prior_place", "_before_place")
    unordered = F.lit(False)
    for c in order:
        unordered |= F.col(c).isNull()
    broken = unordered | F.coalesce(prior_place == place, F.lit(False))
    failed = F.raise_error(F.lit(f"the order {list(order)} is null or leaves rows of one {list(by)} in any order"))
    first = F.col("_opens") & F.col("_before").isNull()
    prior = F.coalesce(F.when(~F.col("_opens"), F.struct(F.col("_prior").alias("_state"))), "_before")
    changed = rows.filter(F.when(broken, failed.cast("boolean")).otherwise(first | ~prior.eqNullSafe(F.struct("_state"))))
    changed = changed.withColumn("_next", F.lead(F.struct(moment)).over(window))
    changed = sections.attach(changed, summary, F.col("_upcoming").isNotNull(), {
        "_upcoming": F.first("_change", ignorenulls=True).over(later),
    })
    return changed.select(*df.columns, F.coalesce("_next", "_upcoming")[moment].alias(until))


def speed_trace(
    df: DataFrame, by: Sequence[str], order: Sequence[str], delta: Column, section_rows: int | None = None
) -> DataFrame:
    """Speed, odometer, step number and average speed after each pulse of a device.

    A pulse adds ``delta``; the speed never falls below 0. With S the running sum of the
    pulses, that speed is S less the lowest S so far (or less 0 while S stayed positive).
    """
    order_by = [F.col(c).asc() for c in order]
    sections = Sections(df.withColumn("_delta", F.coalesce(delta, F.lit(0))), by, order_by, section_rows)
    so_far = sections.inside(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    earlier = sections.across().rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    rows = sections.rows.withColumn("_sum", F.sum("_delta").over(so_far))
    rows = rows.withColumns({"_low": F.min("_sum").over(so_far), "_n": F.row_number().over(sections.inside(*order_by))})
    summary = sections.summary(
        rows, F.sum("_delta").alias("_total"), F.min("_sum").alias("_lowest"), F.count("*").alias("_rows")
    ).withColumn("_base", F.sum("_total").over(earlier))
    rows = sections.attach(rows, summary, F.col("_base").isNotNull(), {
        "_base": F.col("_base"),
        "_floor": F.min(F.coalesce("_base", zero) + F.col("_lowest")).over(earlier),
        "_steps": F.sum("_rows").over(earlier),
    })
    base = F.coalesce("_base", zero)
    rows = rows.withColumns({
        "speed": base + F.col("_sum") - F.least(zero, F.coalesce("_floor", zero), base + F.col("_low")),
        "step": (F.coalesce("_steps", zero) + F.col("_n")).cast("bigint"),
    }).withColumn("_driven", F.sum("speed").over(so_far))
    summary = sections.summary(rows, F.sum("speed").alias("_distance"))
    rows = sections.attach(rows, summary.withColumn("_earlier", F.sum("_distance").over(earlier)), F.col("_earlier").isNotNull(), {
        "_earlier": F.col("_earlier"),
    })
    odometer = F.coalesce("_earlier", zero) + F.col("_driven")
    return rows.select(
        *df.columns, "speed", odometer.alias("odometer"), "step", (odometer / F.col("step")).alias("average_speed"),
    )
