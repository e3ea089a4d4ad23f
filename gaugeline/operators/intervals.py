"""Interval series: expected grid, gap filling and completeness.

A series may be as large as a third of all readings, so no step gathers one
series in one task. Gap filling needs each reading's successor: the window runs
over (series, day), and the first reading of the next day comes from a
per-day minimum, joined in the order the window left. With at most one reading per series and instant, which
``resolve_duplicates`` guarantees, a day holds no more rows than it has
seconds. Completeness needs only sums, joined back to the rows.

What grows most is what is made here: steps. A long gap's chunks are dealt out to all
tasks before they are expanded, and the grid is cut into equal shares of steps, whatever
the lengths of its series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline import schema as S
from gaugeline.functions import fixed_values as fv
from gaugeline.functions import normalize as norm
from gaugeline.functions import times
from gaugeline.operators.keyed import join_per_key
from gaugeline.settings import Settings
from gaugeline.sources.scratch import written

TIME = "readingUtcLocalTime"
STEP = "intervalSize"

# Steps expanded per array, so that a gap of any length keeps arrays small.
_CHUNK = 10_000
# Steps of a grid that one task makes.
_SHARE = 1_000_000
# Low bits of a row id: the position inside its partition.
_POSITION_BITS = (1 << 33) - 1


def quality_flag(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "quality_flag",
        norm.quality_flag(
            F.col("qualityCodesSystemId"),
            F.col("qualityCodesCategorization"),
            F.col("qualityCodesIndex"),
        ),
    )


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _range(first: Column | int, last: Column, step: int = 1) -> Column:
    """first, first + step .. last; only ``first`` if ``last`` is below it."""
    first = first if isinstance(first, Column) else F.lit(first)
    first = first.cast("long")
    return F.sequence(first, F.greatest(first, last.cast("long")), F.lit(step).cast("long"))


def _expanded(chunks: DataFrame, last: Column, name: str) -> DataFrame:
    """Each chunk (of first step ``_chunk``) once per step up to ``last``."""
    end = F.least(F.col("_chunk") + (_CHUNK - 1), last)
    return chunks.withColumn(name, F.explode(_range(F.col("_chunk"), end))).drop("_chunk")


def _equal_shares(rows: DataFrame, weight: str) -> DataFrame:
    """``rows`` cut into pieces ``_first .. _last`` of their ``weight`` steps (from 0), dealt
    out so that all tasks have equally many steps: the steps of all rows stand in one row,
    by running sums inside each task and over the tasks, and are cut at equal distances."""
    fixed = written(
        rows.withColumns(
            {
                "_part": F.spark_partition_id(),
                "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
            }
        ),
        "weighted",
    )
    sums = fixed.groupBy("_part").agg(F.sum(weight).alias("_sum"))
    total = sums.agg(F.sum("_sum")).first()[0] or 0
    tasks = max(1, -(-total // _SHARE), min(_tasks(rows), -(-total // _CHUNK)))
    share = max(1, -(-total // tasks))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("long")
    # One row per task that wrote.
    offsets = sums.select(
        "_part", F.coalesce(F.sum("_sum").over(earlier(Window.orderBy("_part"))), nothing).alias("_offset")
    )
    inside = F.coalesce(F.sum(weight).over(earlier(Window.partitionBy("_part").orderBy("_at"))), nothing)
    placed = fixed.join(offsets, "_part").withColumn("_start", F.col("_offset") + inside)
    end = F.col("_start") + F.col(weight) - 1
    pieces = placed.withColumn(
        "_task", F.explode(_range(F.floor(F.col("_start") / share), F.floor(end / share)))
    )
    cut = pieces.withColumns(
        {
            "_first": F.greatest(F.col("_task") * share, F.col("_start")) - F.col("_start"),
            "_last": F.least((F.col("_task") + 1) * share - 1, end) - F.col("_start"),
        }
    )
    dealt = cut.repartitionById(tasks, F.col("_task").cast("int"))
    return dealt.drop("_part", "_at", "_offset", "_start", "_task")


def _minutes_after(start: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, start)


def _valid_step(step: Column) -> Column:
    """Interval length in minutes; null unless positive."""
    return F.when(step > 0, step)


def expected_grid(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    step: str = STEP,
) -> DataFrame:
    """Every expected time of each series: from its first to its last reading in
    steps of its interval."""
    bounds = df.groupBy(*series).agg(
        F.min(time).alias("_from"), F.max(time).alias("_to"), F.min(step).alias("_step")
    )
    stride = F.coalesce(_valid_step(F.col("_step")), F.lit(1))
    span = F.when(
        _valid_step(F.col("_step")).isNotNull(),
        times.minutes_between(F.col("_from"), F.col("_to")),
    ).otherwise(0)
    # The bounds are few rows; the grid is large.
    sized = bounds.select(
        *series,
        "_from",
        stride.alias("_stride"),
        (F.floor(span / stride) + 1).cast("long").alias("_count"),
    )
    pieces = _equal_shares(sized, "_count")
    chunks = pieces.withColumn("_chunk", F.explode(_range(F.col("_first"), F.col("_last"), _CHUNK)))
    return _expanded(chunks, F.col("_last"), "_n").select(
        *series,
        _minutes_after(F.col("_from"), F.col("_n") * F.col("_stride")).alias(time),
    )


def _slices(
    df: DataFrame, series: Sequence[str], time: str, *extra: Column
) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_slice``, their series and day, and per slice the first time in the
    series' next slice, ``_following``, where there is one, with the ``extra`` aggregates
    of the slice."""
    day = F.col(time).cast("date").alias("_start")
    sliced = df.withColumn("_slice", F.struct(*series, day))
    firsts = sliced.groupBy("_slice").agg(F.min(time).alias("_first"), *extra)
    # One row per series and day: the calendar bounds how many a series has.
    calendar = Window.partitionBy(*[F.col("_slice").getField(s) for s in series])
    following = firsts.withColumn(
        "_following", F.lead("_first").over(calendar.orderBy("_slice._start"))
    )
    return sliced, following.filter(F.col("_following").isNotNull()).drop("_first")


def _followed(
    sliced: DataFrame, following: DataFrame, time: str, order: Sequence[str], name: str
) -> DataFrame:
    # Window and join share the one shuffle and the one sort of the rows by slice.
    in_slice = Window.partitionBy("_slice").orderBy(time, *order)
    return (
        sliced.withColumn("_next", F.lead(time).over(in_slice))
        .join(following.select("_slice", "_following"), "_slice", "left")
        .withColumn(name, F.coalesce("_next", "_following"))
        .drop("_slice", "_next", "_following")
    )


def with_next_time(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    order: Sequence[str] = ("identReading",),
    name: str = "nextTime",
) -> DataFrame:
    """Time of the following reading of the same series, null for the last."""
    return _followed(*_slices(df, series, time), time, order, name)


def _before_long_gaps(
    sliced: DataFrame, far: DataFrame, time: str, order: Sequence[str]
) -> DataFrame:
    """The last readings, with ``nextTime``, of the days in ``far``."""
    backwards = Window.partitionBy("_slice").orderBy(*[F.col(c).desc() for c in (time, *order)])
    following = far.select("_slice", F.col("_following").alias("nextTime"))
    rows = sliced.join(following, "_slice").withColumn("_place", F.row_number().over(backwards))
    return rows.filter("_place = 1").drop("_place", "_slice")


def _steps(time: str, stride: Column) -> Column:
    """Steps from a reading on strictly before ``nextTime``, its own included."""
    distance = times.seconds_between(F.col(time), F.col("nextTime"))
    return F.coalesce(F.when(distance > 0, F.ceil(distance / (stride * 60))), F.lit(1))


def fill_counts(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    step: str = STEP,
    order: Sequence[str] = ("identReading",),
    name: str = "rows",
) -> DataFrame:
    """How many rows ``fill_gaps`` makes of each reading, itself included; none is made."""
    timed = with_next_time(df, series, time, order, "nextTime")
    return timed.withColumn(name, _steps(time, _valid_step(F.col(step))).cast("long")).drop("nextTime")


def fill_gaps(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    step: str = STEP,
    order: Sequence[str] = ("identReading",),
) -> DataFrame:
    """Each reading followed by one row per missing step up to the next reading.
    Gap rows copy the previous reading; ``isOriginal`` tells them apart. A
    reading without a positive interval gets no gap rows.

    A gap of more than ``_CHUNK`` steps becomes chunks, which go to all tasks in turn
    before they are expanded; other gaps grow where their reading is. Steps are whole
    minutes, so a gap that needs so many spans days, and the days and their least step
    alone tell whether there may be one: if not, the rows are passed once."""
    stride = _valid_step(F.col(step))
    sliced, following = _slices(df, series, time, F.min(stride).alias("_least"))
    following = written(following, "following")
    count = _steps(time, stride)
    near = _followed(sliced, following, time, order, "nextTime").withColumn("_count", count)
    short = F.when(F.col("_count") <= _CHUNK, F.col("_count")).otherwise(1)
    rows = near.withColumn("_n", F.explode(_range(0, short - 1))).select(*df.columns, "_n")

    longest = times.seconds_between(F.col("_slice._start").cast("timestamp_ntz"), F.col("_following"))
    far_days = following.filter(longest > F.col("_least") * (60 * _CHUNK))
    if not far_days.isEmpty():
        far = _before_long_gaps(sliced, far_days, time, order).withColumn("_count", count)
        far = far.filter(F.col("_count") > _CHUNK)
        chunks = far.withColumn("_chunk", F.explode(_range(1, F.col("_count") - 1, _CHUNK)))
        turn = F.xxhash64(*series, time) % 1_000_003 + F.floor(F.col("_chunk") / _CHUNK)
        dealt = chunks.repartitionById(_tasks(df), F.pmod(turn, F.lit(_tasks(df))).cast("int"))
        expanded = _expanded(dealt, F.col("_count") - 1, "_n")
        rows = rows.unionByName(expanded.select(*df.columns, "_n"))

    others = [name for name in df.columns if name != time]
    return rows.select(
        *others,
        F.when(F.col("_n") == 0, F.col(time))
        .otherwise(_minutes_after(F.col(time), F.col("_n") * F.coalesce(stride, F.lit(0))))
        .alias(time),
        (F.col("_n") == 0).alias("isOriginal"),
    )


def is_outage(flag: Column, settings: Settings) -> Column:
    return F.coalesce(flag.isin(*settings.outage_flags), F.lit(False))


def outage_value(value: Column, flag: Column, original: Column, settings: Settings) -> Column:
    """Value of a reading after filling: gaps in a power outage hold zero or
    nothing as set, other gaps nothing, readings their own value."""
    zero = F.lit("0") if settings.fill_with_zero else F.lit(None).cast("string")
    return F.when(original, value).when(is_outage(flag, settings), zero)


def interval_mark(flag: Column, original: Column, settings: Settings) -> Column:
    """``"1"`` for a reading or an outage gap, null for another gap."""
    return F.when(original | is_outage(flag, settings), "1")


def local_if_missing(local: Column, utc: Column, zone: Column) -> Column:
    return F.coalesce(local, times.to_local(utc, zone))


def complete_fill(filled: DataFrame, settings: Settings) -> DataFrame:
    """Finish gap rows: mark, value by outage rule, no quality codes, local and
    source time from UTC, and the columns derived from value or time computed
    anew. Expects ``quality_flag`` and ``isOriginal``."""
    original = F.col("isOriginal")
    flag = F.col("quality_flag")
    only_original = lambda name: F.when(original, F.col(name))
    marked = filled.withColumns(
        {
            "intervalMark": interval_mark(flag, original, settings),
            "readingsValue": outage_value(F.col("readingsValue"), flag, original, settings),
            "readingLocalTime": local_if_missing(
                only_original("readingLocalTime"),
                F.col(TIME),
                F.col("servicePointTimeZone"),
            ),
            "identReading": only_original("identReading"),
            "qualityCodesSystemId": only_original("qualityCodesSystemId"),
            "qualityCodesCategorization": only_original("qualityCodesCategorization"),
            "qualityCodesIndex": only_original("qualityCodesIndex"),
        }
    )
    return marked.withColumns(
        {
            "readingDateSource": F.col("readingLocalTime"),
            "idDateYmd": times.date_key(F.col(TIME)),
            "idDateYw": times.week_key(F.col(TIME)),
            "usageReading": norm.usage_value(F.col("readingsValue"), F.col("multiplier")),
        }
    )


def _stretched(df: DataFrame, series: Sequence[str], time: str, step: str) -> DataFrame:
    """Rows with ``_slice``, their series and day, and ``_stretch``, how many times the
    interval changed in the day before them."""
    sliced = df.withColumn("_slice", F.struct(*series, F.col(time).cast("date").alias("_day")))
    in_slice = Window.partitionBy("_slice").orderBy(time, step)
    changed = (F.row_number().over(in_slice) > 1) & ~F.col(step).eqNullSafe(F.lag(step).over(in_slice))
    so_far = F.sum("_change").over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
    return sliced.withColumn("_change", changed.cast("int")).withColumn("_stretch", so_far).drop("_change")


def _earlier_changes(stretches: DataFrame, series: Sequence[str], step: str) -> DataFrame:
    """Per slice that is not its series' first: the changes before it, ``_offset``, if any.
    ``stretches`` has a row (or several alike) per slice and ``_stretch``."""
    days = stretches.groupBy("_slice").agg(
        F.min_by(step, "_stretch").alias("_opening"),
        F.max_by(step, "_stretch").alias("_closing"),
        F.max("_stretch").alias("_changes"),
    )
    # One row per series and day: the calendar bounds how many a series has.
    calendar = Window.partitionBy(*[F.col("_slice").getField(s) for s in series]).orderBy("_slice._day")
    first = F.row_number().over(calendar) == 1
    switched = F.when(first, 0).otherwise((~F.col("_opening").eqNullSafe(F.lag("_closing").over(calendar))).cast("int"))
    earlier = calendar.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("_changes") + F.col("_switched")).over(earlier), F.lit(0)) + F.col("_switched")
    offsets = days.withColumn("_switched", switched).select("_slice", offset.alias("_offset"))
    return offsets.filter("_offset > 0")


def _numbered(stretches: DataFrame, offsets: DataFrame, name: str) -> DataFrame:
    number = F.col("_stretch") + F.coalesce("_offset", F.lit(0))
    return stretches.join(offsets, "_slice", "left").withColumn(name, number.cast("long"))


def with_segment(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    step: str = STEP,
    name: str = "segment",
) -> DataFrame:
    """Numbers, from 0, the stretches of a series in which all rows have one interval.

    An interval counts as changed where it differs from that of the row before. Rows look
    back inside their (series, day) only; each day's first and last interval and number of
    changes, one row per day, tell how many changes are before it."""
    rows = _stretched(df, series, time, step)
    stretches = rows.groupBy("_slice", "_stretch").agg(F.min(step).alias(step))
    numbered = _numbered(rows, _earlier_changes(stretches, series, step), name)
    return numbered.drop("_slice", "_stretch", "_offset")


def _bounds(time: str, mark: str) -> list[Column]:
    return [
        F.min(time).alias("minTime"),
        F.max(time).alias("maxTime"),
        F.count(mark).alias("actual"),
        F.count_if(F.col(mark).isNull()).alias("_unmarked"),
    ]


def _merged() -> list[Column]:
    """``_bounds`` of parts put together."""
    together = {"minTime": F.min, "maxTime": F.max, "actual": F.sum, "_unmarked": F.sum}
    return [merge(name).alias(name) for name, merge in together.items()]


def _expected(bounds: DataFrame) -> DataFrame:
    span = times.minutes_between(F.col("minTime"), F.col("maxTime"))
    expected = (F.floor(span / _valid_step(F.col("_step"))) + 1).cast("long")
    return bounds.withColumn("expected", expected)


def segment_summary(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    step: str = STEP,
    mark: str = "intervalMark",
) -> DataFrame:
    """Per stretch of a series with one interval: its number ``segment``, its interval,
    first and last time, expected, actual and missing readings, and the result, as
    ``series_summary`` has them per series. Gap rows have the interval of the reading
    before them, so the time up to the first reading of the next stretch is theirs.

    The rows are passed once, down to one row per day and stretch; those are written,
    numbered over the days and put together."""
    rows = _stretched(df, series, time, step).groupBy("_slice", "_stretch")
    parts = written(rows.agg(F.min(step).alias("_step"), *_bounds(time, mark)), "stretches")
    numbered = _numbered(parts, _earlier_changes(parts, series, "_step"), "segment")
    of_series = [F.col("_slice").getField(s).alias(s) for s in series]
    bounds = numbered.groupBy(*of_series, "segment").agg(F.min("_step").alias("_step"), *_merged())
    return _judged(_expected(bounds), [*series, "segment", F.col("_step").alias(step)])


def _judged(bounds: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    complete = (F.col("_unmarked") == 0) & (F.col("actual") >= F.col("expected"))
    return bounds.select(
        *columns,
        "minTime",
        "maxTime",
        "expected",
        "actual",
        F.greatest(F.col("expected") - F.col("actual"), F.col("_unmarked")).alias("missing"),
        F.when(complete, fv.RESULT_SUCCESS).otherwise(fv.RESULT_FAILED).alias("result"),
    )


def series_bounds(
    df: DataFrame, series: Sequence[str], time: str, step: str, mark: str, attributes: Sequence[str]
) -> DataFrame:
    """What ``series_summary`` judges a series by, and whether it changes its interval, a
    row per series and values of its attributes: with texts as keys, all aggregates are of
    numbers, so that the rows are hashed and never sorted or held. ``merged_bounds`` makes
    one row per series of it."""
    named = [F.col(name).alias(f"_attribute{i}") for i, name in enumerate(attributes)]
    return df.groupBy(*series, *named).agg(
        F.min(step).alias("_step"),
        F.max(step).alias("_most"),
        F.count(step).alias("_stepped"),
        F.count(F.lit(1)).alias("_rows"),
        *_bounds(time, mark),
    )


def merged_bounds(bounds: DataFrame, series: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """``series_bounds`` of each series, with the least value of every attribute."""
    return bounds.groupBy(*series).agg(
        *[F.min(f"_attribute{i}").alias(f"_attribute{i}") for i in range(len(attributes))],
        F.min("_step").alias("_step"),
        F.max("_most").alias("_most"),
        F.sum("_stepped").alias("_stepped"),
        F.sum("_rows").alias("_rows"),
        *_merged(),
    )


def series_summary(
    df: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    time: str = TIME,
    step: str = STEP,
    mark: str = "intervalMark",
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Per series: first and last time, expected, actual and missing readings and
    the result. Sums and extremes only, combined before the shuffle, and with
    ``attributes`` once more over the few rows of their values.
    ``attributes`` are descriptive columns of the series to carry along.

    A series that changes its interval is judged by its ``segment_summary``: it expects
    the sum of what its stretches do and is complete if all of them are. Only such series
    are looked at a second time. Readings off the grid
    make up for no gap: a series with an unmarked row is not complete, whatever the
    counts, and ``missing`` is at least the number of such rows, never negative."""
    bounds = series_bounds(df, series, time, step, mark, attributes)
    if attributes:
        bounds = merged_bounds(bounds, series, attributes)
    bounds = written(bounds, "series")
    carried = [F.col(f"_attribute{i}").alias(name) for i, name in enumerate(attributes)]
    several = (F.col("_step") < F.col("_most")) | (F.col("_stepped").between(1, F.col("_rows") - 1))
    steady = _judged(_expected(bounds.filter(~F.coalesce(several, F.lit(False)))), [*series, *carried])
    switched = bounds.filter(several)
    if switched.isEmpty():
        return steady
    rows = join_per_key(df, switched.select(*series), series, "left_semi")
    parts = segment_summary(rows, series, time, step, mark).groupBy(*series).agg(
        F.when(F.count("expected") == F.count(F.lit(1)), F.sum("expected")).alias("expected"),
        F.sum("missing").alias("missing"),
        F.when(F.count_if(F.col("result") != fv.RESULT_SUCCESS) == 0, fv.RESULT_SUCCESS)
        .otherwise(fv.RESULT_FAILED)
        .alias("result"),
    )
    judged = join_per_key(switched, parts, series, "inner")
    return steady.unionByName(
        judged.select(*series, *carried, "minTime", "maxTime", "expected", "actual", "missing", "result")
    )


def validate_intervals(
    df: DataFrame,
    summary: DataFrame,
    series: Sequence[str] = S.SERIES_KEY,
    mark: str = "intervalMark",
) -> DataFrame:
    """Validity of each row of an interval series: all rows of a complete series
    are valid; of an incomplete one the marked rows are, the others say why."""
    joined = join_per_key(
        df, summary.select(*series, F.col("result").alias("_result")), series
    )
    valid = (F.col("_result") == fv.RESULT_SUCCESS) | F.col(mark).isNotNull()
    return joined.withColumns(
        {
            "usageValid": valid,
            "ValidationDetail": F.when(~valid, fv.MISSING_INTERVAL_DETAIL),
            "IsGrouped": F.lit(False),
        }
    ).drop("_result")


def without_validation(df: DataFrame) -> DataFrame:
    """The validation columns of readings that form no interval series."""
    return df.withColumns(
        {
            "usageValid": F.lit(None).cast("boolean"),
            "ValidationDetail": F.lit(None).cast("string"),
            "IsGrouped": F.lit(None).cast("boolean"),
        }
    )


def order_series(
    df: DataFrame, series: Sequence[str] = S.SERIES_KEY, time: str = TIME
) -> DataFrame:
    """Rows by series and time; the range sort cuts a long series by time."""
    return df.orderBy(*series, time)


def rows_of_series(
    df: DataFrame, chosen: DataFrame, series: Sequence[str] = S.SERIES_KEY
) -> DataFrame:
    """Rows of the chosen series."""
    return join_per_key(df, chosen.select(*series), series, "left_semi")
