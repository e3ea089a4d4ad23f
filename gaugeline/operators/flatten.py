"""Nested documents to flat readings.

Every reading kind is one specification: a section of the document, how to walk
it, and the columns of its entries. All wanted kinds are read in a single pass:
each document becomes one array of entries of one shape, which is exploded once,
so the XML is scanned and parsed only once however many kinds are wanted.
Whatever does not depend on the kind is computed after the explode.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import fixed_values as fv
from gaugeline.functions import normalize as norm
from gaugeline.schema import DOCUMENT_SCHEMA, READING_COLUMNS

# Text fields of an entry; a kind leaves out what it has not.
_FIELDS = [
    "variableId", "unitOfMeasure", "readingTime", "readingsValue", "ke", "channel",
    "intervalSize", "eventsCode",
]


def _flags_type(documents: T.StructType) -> str:
    """An entry carries its quality flags as the documents have them; their codes are
    found after the explode."""
    name = "IntervalData"
    intervals = (documents if name in documents.fieldNames() else DOCUMENT_SCHEMA)[name].dataType
    reading = intervals.elementType["Reading"].dataType.elementType
    return reading["QualityFlags"].dataType.simpleString()


@dataclass(frozen=True)
class Kind:
    """One reading kind. ``path`` names the section and the arrays nested in it;
    ``reads`` all that is read below the section; ``fields`` maps the innermost entry,
    the entry around it and the collection time to the fields of an entry; ``keep``
    says which entries are readings. Kinds with a log carry log number and version and
    need the meter."""

    path: tuple[str, ...]
    reading_type: str
    reads: str
    fields: Callable[[Column, Column | None, Column], dict[str, Column]]
    keep: Callable[[Column], Column] | None = None
    logged: bool = False


def _no_factor() -> Column:
    """Kinds without a multiplier attribute carry an empty factor."""
    return F.lit("")


def _words(*parts: Column) -> Column:
    """Parts joined by blanks, null if any part is missing."""
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(" "), part]
    return F.concat(*spaced)


def _renamed(unit: Column, old: str, new: str) -> Column:
    return F.when(unit == old, new).otherwise(unit)


def _demand(section: str, time_fallback: bool, degrees: bool = False) -> Kind:
    spec_name = section.removesuffix("Data") + "Spec"

    def fields(entry, _around, collected):
        spec, reading = entry.getField(spec_name), entry.getField("Reading")
        unit, taken = spec.getField("_UOM"), reading.getField("_TimeStamp")
        return dict(
            variableId=_words(
                unit, spec.getField("_Direction"), spec.getField("_TouBucket")
            ),
            unitOfMeasure=_renamed(unit, "Degree", "°") if degrees else unit,
            readingTime=F.coalesce(taken, collected) if time_fallback else taken,
            readingsValue=reading.getField("_Value"),
            ke=spec.getField("_Multiplier"),
        )

    reads = f"{spec_name} _UOM _Direction _TouBucket _Multiplier Reading _TimeStamp _Value"
    return Kind((section,), fv.REGISTERS, reads, fields)


def _demand_reset_count(entry, _around, _collected):
    return dict(
        variableId=F.lit("Demand Reset Count"),
        unitOfMeasure=_renamed(entry.getField("_UOM"), "Times", "Count"),
        readingTime=entry.getField("_TimeStamp"),
        readingsValue=entry.getField("_Count"),
        ke=_no_factor(),
    )


def _demand_reset(entry, _around, _collected):
    return dict(
        variableId=F.lit("Demand Reset"),
        unitOfMeasure=F.lit("-"),
        readingTime=entry.getField("_TimeStamp"),
        readingsValue=F.lit("0"),
        ke=_no_factor(),
    )


def _instrumentation(entry, _around, _collected):
    name = entry.getField("_Name")
    return dict(
        variableId=_words(name, entry.getField("_Phase")),
        unitOfMeasure=norm.mapped(name, fv.INSTRUMENTATION_UNITS, F.lit("-")),
        readingTime=entry.getField("_Timestamp"),
        readingsValue=entry.getField("_Value"),
        ke=_no_factor(),
    )


def _status(entry, _around, collected):
    return dict(
        variableId=_words(entry.getField("_Category"), entry.getField("_Name")),
        unitOfMeasure=F.lit("-"),
        readingTime=collected,
        readingsValue=_renamed(entry.getField("_Value"), "true", "0"),
        ke=_no_factor(),
        eventsCode=entry.getField("_Id"),
    )


def _profile_summary(entry, _around, _collected):
    channel = entry.getField("Channel")
    unit = channel.getField("_UOM")
    return dict(
        variableId=_words(unit, channel.getField("_Direction")),
        unitOfMeasure=unit,
        readingsValue=channel.getField("_SumOfIntervalValues"),
        ke=channel.getField("_Multiplier"),
    )


def _outage_count(time_field: str) -> Kind:
    def fields(entry, _around, _collected):
        count = entry.getField("OutageCount")
        return dict(
            variableId=F.lit("Outage count"),
            unitOfMeasure=F.lit("Count"),
            readingTime=count.getField(time_field),
            readingsValue=count.getField("_Value"),
            ke=_no_factor(),
        )

    return Kind(("OutageCountSummary",), fv.EVENTS, f"OutageCount {time_field} _Value", fields)


def _reverse_energy(entry, _around, _collected):
    return dict(
        variableId=F.lit("Reverse energy summary"),
        unitOfMeasure=F.lit("-"),
        readingsValue=entry.getField("ReverseEnergy").getField("_CurrentValue"),
        ke=_no_factor(),
    )


def _event_attribute(entry, event, _collected):
    return dict(
        variableId=entry.getField("_Name"),
        unitOfMeasure=F.lit("-"),
        readingTime=F.coalesce(
            event.getField("_TimeStamp"), event.getField("_DiscoveredAt")
        ),
        readingsValue=entry.getField("_Value"),
        ke=_no_factor(),
    )


def _interval(entry, interval_data, _collected):
    spec = interval_data.getField("IntervalSpec")
    unit = spec.getField("_UOM")
    return dict(
        variableId=_words(unit, spec.getField("_Direction")),
        unitOfMeasure=unit,
        readingTime=entry.getField("_TimeStamp"),
        readingsValue=entry.getField("_RawReading"),
        ke=spec.getField("_Multiplier"),
        channel=spec.getField("_Channel"),
        intervalSize=spec.getField("_Interval"),
        flags=entry.getField("QualityFlags"),
    )


_FLAG_NAMES = " ".join(name for names, _ in fv.QUALITY_CODES for name in names)

KINDS: dict[str, Kind] = {
    "max_demand": _demand("MaxDemandData", time_fallback=True),
    "demand_reset_count": Kind(
        ("DemandResetCount",), fv.REGISTERS, "_UOM _TimeStamp _Count", _demand_reset_count
    ),
    "consumption": _demand("ConsumptionData", time_fallback=False, degrees=True),
    "coincident_demand": _demand("CoincidentDemandData", time_fallback=True),
    "cumulative_demand": _demand("CumulativeDemandData", time_fallback=True),
    "demand_reset": Kind(("DemandReset",), fv.EVENTS, "_TimeStamp", _demand_reset),
    "instrumentation": Kind(
        ("InstrumentationValue",),
        fv.REGISTERS,
        "_Name _Phase _Timestamp _Value",
        _instrumentation,
    ),
    "status": Kind(
        ("Statuses", "Status"),
        fv.EVENTS,
        "Status _Category _Name _Value _Id",
        _status,
        keep=lambda entry: ~entry.getField("_Value").eqNullSafe("false"),
        logged=True,
    ),
    "profile_summary": Kind(
        ("LoadProfileSummary",),
        fv.REGISTERS,
        "Channel _UOM _Direction _SumOfIntervalValues _Multiplier",
        _profile_summary,
    ),
    "outage_count": _outage_count("_ReadingTime"),
    "previous_outage_count": _outage_count("_PreviousReadingTime"),
    "reverse_energy": Kind(
        ("ReverseEnergySummary",), fv.REGISTERS, "ReverseEnergy _CurrentValue", _reverse_energy
    ),
    "event_attribute": Kind(
        ("EventData", "Event", "EventAttribute"),
        fv.EVENTS,
        "Event _TimeStamp _DiscoveredAt EventAttribute _Name _Value",
        _event_attribute,
    ),
    "interval": Kind(
        ("IntervalData", "Reading"),
        fv.LOAD_PROFILE,
        "IntervalSpec _UOM _Direction _Multiplier _Channel _Interval "
        f"Reading _TimeStamp _RawReading QualityFlags {_FLAG_NAMES}",
        _interval,
        logged=True,
    ),
}

# The earlier outage time is left out unless asked for: it repeats the value.
DEFAULT_KINDS = tuple(name for name in KINDS if name != "previous_outage_count")



def _read_part(kind: T.DataType, names: set[str]) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_read_part(kind.elementType, names))
    if isinstance(kind, T.StructType):
        return T.StructType(
            [
                T.StructField(field.name, _read_part(field.dataType, names))
                for field in kind.fields
                if field.name in names
            ]
        )
    return kind


def read_schema(kinds: Iterable[str] = DEFAULT_KINDS) -> T.StructType:
    """The document schema without what ``flatten_readings`` and ``project_readings``
    do not read for these kinds. The meter stays whole, as its presence counts even
    if it is empty. Parsing an element costs as much as its schema is wide, and far more
    if it may have a text of its own."""
    names: dict[str, set[str]] = {}
    for kind in map(KINDS.get, kinds):
        names.setdefault(kind.path[0], set()).update((*kind.path, *kind.reads.split()))
    return T.StructType(
        [
            T.StructField(field.name, _read_part(field.dataType, names[field.name]))
            if field.name in names
            else field
            for field in DOCUMENT_SCHEMA.fields
            if field.name in names or field.name == "Meter" or field.name.startswith("_")
        ]
    )


def _nothing(flags: str) -> Column:
    texts = ",".join(f"{name}:string" for name in _FIELDS)
    return F.array().cast(f"array<struct<readingType:string,logged:boolean,{texts},flags:{flags}>>")


def _entry(kind: Kind, fields: dict[str, Column], flags: str) -> Column:
    nothing = F.lit(None)
    return F.struct(
        F.lit(kind.reading_type).alias("readingType"),
        F.lit(kind.logged).alias("logged"),
        *[fields.get(name, nothing.cast("string")).alias(name) for name in _FIELDS],
        fields.get("flags", nothing.cast(flags)).alias("flags"),
    )


def _walk(entries: Column, path, kind: Kind, flags: str, around: Column | None) -> Column:
    """Array of entries below ``entries``, one nesting level per path step."""
    if not path:
        kept = F.filter(entries, kind.keep) if kind.keep else entries
        return F.transform(
            kept,
            lambda entry: _entry(kind, kind.fields(entry, around, F.col("_CollectionTime")), flags),
        )
    deeper = F.transform(
        entries,
        lambda entry: F.coalesce(
            _walk(entry.getField(path[0]), path[1:], kind, flags, entry), _nothing(flags)
        ),
    )
    return F.flatten(deeper)


def _entries(kind: Kind, flags: str) -> Column:
    found = _walk(F.col(kind.path[0]), kind.path[1:], kind, flags, None)
    if kind.logged:
        found = F.when(F.col("_metered"), found)
    return F.coalesce(found, _nothing(flags))


def _document_columns() -> dict[str, Column]:
    """What all readings of a document have in common, made before they are exploded."""
    meter = F.col("Meter").getField
    return dict(
        servicePointId=norm.service_point(meter("_SdpIdent"), meter("_MeterIrn")),
        deviceId=meter("_MeterIrn"),
        primarySource=norm.source_label(F.col("_Source")),
        readingsSource=F.col("hes"),
        owner=F.col("owner"),
        guidFile=F.col("guidFile"),
        deviceMaster=F.col("_SourceIrn"),
        deviceDescription=meter("_Description"),
        deviceStatus=norm.device_status(meter("_IsActive")),
        serial=meter("_SerialNumber"),
        accountNumber=meter("_AccountIdent"),
        servicePointTimeZone=meter("_TimeZoneIndex"),
        mediaType=meter("_MediaType"),
        relationStartDate=meter("_InstallDate"),
        relationEndDate=meter("_RemovalDate"),
        **norm.device_profile(meter("_MeterType")),
    )


def _rows_of(documents: DataFrame, kind: Kind, prefix: list[str], flags: str) -> DataFrame:
    """The entries of one kind. No others have to share their array, so every nesting
    level is exploded as it is and the fields are compiled."""
    rows = documents.filter(F.col("_metered")) if kind.logged else documents
    kept = [*prefix, "_CollectionTime"]
    around, inner = None, F.col(kind.path[0])
    for level, step in enumerate((*kind.path[1:], None)):
        above = [f"_level{level - 1}"] if level else []
        rows = rows.select(*kept, *above, F.explode(inner).alias(f"_level{level}"))
        if step is not None:
            around, inner = F.col(f"_level{level}"), F.col(f"_level{level}").getField(step)
    entry = F.col(f"_level{len(kind.path) - 1}")
    rows = rows.filter(kind.keep(entry)) if kind.keep else rows
    fields = kind.fields(entry, around, F.col("_CollectionTime"))
    return rows.select(*prefix, _entry(kind, fields, flags).alias("entry"))


def flatten_readings(
    documents: DataFrame, kinds: Iterable[str] = DEFAULT_KINDS
) -> DataFrame:
    """One row per reading element of the wanted kinds, with the columns of its
    document. A document without a section gives no row for it."""
    wanted = [KINDS[name] for name in kinds]
    flags_type = _flags_type(documents.schema)
    columns = _document_columns()
    prefix = list(columns)
    prepared = documents.select(
        *[column.alias(name) for name, column in columns.items()],
        F.col("Meter").isNotNull().alias("_metered"),
        "_CollectionTime",
        *dict.fromkeys(kind.path[0] for kind in wanted),
    )
    if len(wanted) == 1:
        rows = _rows_of(prepared, wanted[0], prefix, flags_type)
    else:
        together = F.concat(*[_entries(kind, flags_type) for kind in wanted])
        rows = prepared.select(*prefix, F.explode(together).alias("entry"))
    flags = F.col("entry.flags")
    return rows.select(
        *prefix,
        *[F.col(f"entry.{name}") for name in ("readingType", "logged", *_FIELDS)],
        F.when(flags.isNotNull(), norm.quality_codes(flags)).alias("quality"),
    )


def project_readings(
    elements: DataFrame, literal_connection: bool = False
) -> DataFrame:
    """The 40 columns of a reading. Columns the documents cannot fill are null."""
    quality = F.col("quality").getField
    nothing = F.lit(None).cast("string")
    columns = dict(
        readingType=F.col("readingType"),
        variableId=F.col("variableId"),
        meteringType=F.lit(fv.METERING_TYPE),
        readingDateSource=F.col("readingTime"),
        readingLocalTime=F.col("readingTime"),
        dstStatus=quality("dst"),
        channel=F.col("channel"),
        unitOfMeasure=norm.uom_code(F.col("unitOfMeasure")),
        qualityCodesSystemId=quality("system"),
        qualityCodesCategorization=quality("categorization"),
        qualityCodesIndex=quality("index"),
        intervalSize=F.col("intervalSize"),
        logNumber=F.when(F.col("logged"), "1"),
        version=F.when(F.col("logged"), "Original"),
        readingsValue=F.col("readingsValue"),
        estatus=F.lit(fv.STATUS_ACTIVE),
        eventsCode=F.col("eventsCode"),
        multiplier=norm.multiplier_text(F.col("ke")),
        connectionType=norm.connection_type(F.col("mediaType"), literal_connection),
    )
    columns.update({name: F.col(name) for name in _document_columns() if name in READING_COLUMNS})
    return elements.select(
        *[columns.get(name, nothing).alias(name) for name in READING_COLUMNS]
    )
