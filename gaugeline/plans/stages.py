"""The three stages as whole plans.

Each stage is lazy up to the tables it writes into the shared folder: numbered
readings (enrich), flagged and decided readings (clean), and filled ones when they are
asked for. Those are
the points where several later passes read the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import schema as S
from gaugeline.functions import fixed_values as fv
from gaugeline.operators import audit, enrich as en, intervals, output, quality
from gaugeline.operators import versioning
from gaugeline.operators.flatten import (
    DEFAULT_KINDS,
    flatten_readings,
    project_readings,
    read_schema,
)
from gaugeline.operators.readings import cast_readings, drop_unnamed
from gaugeline.settings import Settings
from gaugeline.sources import store
from gaugeline.sources.documents import read_readings_xml, with_source_keys
from gaugeline.sources.scratch import written
from gaugeline.sources.tables import earliest_time, recent_versions


def translate(
    spark: SparkSession,
    path: str | list[str],
    root: str | None = None,
    kinds: Iterable[str] = DEFAULT_KINDS,
    split_files: bool = True,
) -> DataFrame:
    """XML files to flat readings, in one scan of the files. Elements that do not
    parse give no reading; ``unparsed`` returns them."""
    kinds = tuple(kinds)
    documents = read_readings_xml(spark, path, None, split_files, read_schema(kinds))
    elements = flatten_readings(with_source_keys(documents, root), kinds)
    return cast_readings(project_readings(drop_unnamed(elements)))


def unparsed(
    spark: SparkSession, path: str | list[str], root: str | None = None, split_files: bool = True
) -> DataFrame:
    """The text of the elements that ``translate`` cannot read, with the keys of
    their file: ``guidFile, owner, hes, filePath, record``."""
    documents = with_source_keys(read_readings_xml(spark, path, None, split_files), root)
    broken = documents.filter(F.col(S.CORRUPT_COLUMN).isNotNull())
    return broken.select(
        "guidFile", "owner", "hes", "filePath", F.col(S.CORRUPT_COLUMN).alias("record")
    )


def enrich(
    readings: DataFrame, relation: DataFrame, variable: DataFrame, as_of: dt.date
) -> DataFrame:
    """Readings with numbers, lookup flags, UTC time and date keys."""
    prepared = en.init_version(en.add_ids(cast_readings(readings), as_of))
    numbered = en.number_rows(prepared)
    joined = en.join_variable_flags(
        en.join_relation_flags(numbered, relation), variable
    )
    return en.add_utc(en.require_timezone(joined))


def lifecycle(
    stage: str, before: DataFrame, after: DataFrame, stamp: str, settings: Settings = Settings()
) -> DataFrame:
    """The audit records of each file's start and end in ``translate`` (``before`` are its
    documents with source keys) or ``enrich``. ``clean`` gives its own. Pass the tables as
    they were written, so that they are read in three columns and not made again."""
    keyed = before if "readingsSource" in before.columns else before.withColumnRenamed("hes", "readingsSource")
    return audit.lifecycle_audit(keyed, after, stage, stamp, settings)


_FILE = ["guidFile", "owner", "readingsSource"]
_STORED = [*S.VERSION_KEY, "readingsValue", "version", *versioning._KEPT]
_REJECT_COLUMNS = [*S.READING_COLUMNS, "identReading", quality.REASON]


class Cleaned:
    """Accepted readings in final shape, rejected ones with their reason, and the audit
    records of rejects and fills, of series, and of each file's start and end. What only
    some of them need, the filled readings and the summary of series, is made and written
    when the first of these is asked for."""

    def __init__(self, flagged: DataFrame, decided: DataFrame, settings: Settings, stamp: str):
        self._flagged, self._decided = flagged, decided
        self._settings, self._stamp = settings, stamp

    @cached_property
    def _used(self) -> DataFrame:
        fresh, _ = quality.split(self._decided)
        return versioning.usage_reading(fresh.drop("copies"))

    def _profile(self) -> DataFrame:
        return intervals.quality_flag(self._used.filter(F.col("readingType") == fv.LOAD_PROFILE))

    @cached_property
    def _filled(self) -> DataFrame:
        gaps = intervals.fill_gaps(self._profile())
        return written(intervals.complete_fill(gaps, self._settings), "filled")

    @cached_property
    def _summary(self) -> DataFrame:
        return intervals.series_summary(
            self._filled, attributes=["readingType", "guidFile", "owner", "readingsSource"]
        )

    @cached_property
    def accepted(self) -> DataFrame:
        accepted = output.route_by_type(
            self._used,
            lambda _: output.final_projection(intervals.validate_intervals(self._filled, self._summary)),
            lambda rows: output.final_projection(intervals.without_validation(rows)),
        )
        return output.final_casts(accepted)

    @cached_property
    def rejected(self) -> DataFrame:
        _, refused = quality.split(self._flagged)
        _, refused_later = quality.split(self._decided)
        return (
            refused.select(*_REJECT_COLUMNS)
            .unionByName(refused_later.select(*_REJECT_COLUMNS))
            .unionByName(quality.reported_copies(self._decided).select(*_REJECT_COLUMNS))
        )

    @cached_property
    def reading_audit(self) -> DataFrame:
        # Of the gap rows it needs only what filling gives them.
        filled = self._filled if "_filled" in vars(self) else intervals.fill_gaps(self._profile())
        return audit.reading_audit(self.rejected, filled, self._settings, self._stamp)

    @cached_property
    def interval_audit(self) -> DataFrame:
        return audit.interval_audit(self._summary, self._stamp, self._settings)

    @cached_property
    def lifecycle_audit(self) -> DataFrame:
        # What is accepted, in the columns of its file: gap rows are counted, not made.
        other = self._used.filter(~(F.col("readingType") == fv.LOAD_PROFILE))
        counted = intervals.fill_counts(self._profile(), name="_rows")
        after = other.select(*_FILE, F.lit(1).cast("long").alias("_rows")).unionByName(
            counted.select(*_FILE, "_rows")
        )
        return audit.lifecycle_audit(
            self._flagged, after, "clean", self._stamp, self._settings, rows="_rows"
        )


def clean(
    enriched: DataFrame,
    stored: DataFrame,
    settings: Settings,
    as_of: dt.date,
    stamp: str | None = None,
) -> Cleaned:
    """Six quality steps. ``stored`` holds the readings accepted before. Of a versioned
    store (``sources.store``) the batch's own weeks and keys are read; of another table,
    such as ``read_stored`` or ``recent_versions`` give, the part from the batch's
    earliest time on."""
    stamp = stamp or dt.datetime.combine(as_of, dt.time()).isoformat(timespec="microseconds")

    flagged = quality.reject_unassociated(quality.reject_unknown_type(enriched))
    flagged = quality.reject_unstorable(flagged)
    flagged = quality.require_utc(flagged)
    flagged = quality.reject_out_of_window(flagged, settings, as_of)
    flagged = written(flagged, "flagged")
    passed, _ = quality.split(flagged)

    resolved = quality.resolve_duplicates(passed)
    if store.is_store(stored):
        recent = store.versions_of_batch(stored, passed).select(*_STORED)
    else:
        recent = recent_versions(stored, earliest_time(passed)).select(*_STORED)
    decided = written(
        versioning.assign_version(resolved, versioning.latest_version(recent)),
        "decided",
    )
    return Cleaned(flagged, decided, settings, stamp)
