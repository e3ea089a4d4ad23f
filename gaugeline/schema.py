"""Document schema and column lists."""

from __future__ import annotations

from pyspark.sql import types as T

ROOT_TAG = "AMRDEF"
ROW_TAG = "MeterReadings"
VALUE_TAG = "_valueTag"
CORRUPT_COLUMN = "_corrupt"


def _texts(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


def _leaf(names: str) -> T.StructType:
    return T.StructType(_texts(names + " " + VALUE_TAG))


def _node(texts: str = "", **children: T.DataType) -> T.StructType:
    fields = [T.StructField(name, kind) for name, kind in children.items()]
    return T.StructType(fields + _texts(texts))


def _many(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


_DEMAND_SPEC = _leaf("_Direction _MeasurementPeriod _Multiplier _TouBucket _UOM")
_TIMED_VALUE = _leaf("_TimeStamp _Value")

_METER = _leaf(
    "_AccountIdent _AccountName _Description _InstallDate _IsActive _Location "
    "_MediaType _MeterIrn _MeterName _MeterType _ObservesDaylightSavings "
    "_RemovalDate _SdpIdent _SerialNumber _TimeZoneIndex _TimeZoneOffset _Timezone"
)

_INTERVAL_READING = _node(
    "_RawReading _TimeStamp " + VALUE_TAG,
    QualityFlags=_leaf(
        "_ClockSetBackward _ClockSetForward _CompleteOutage _DST _InvalidTime "
        "_InvalidValue _LongInterval _PartialInterval _PartialOutage _PulseOverflow "
        "_Restoration _SkippedInterval _SuspectedOutage _Tamper _TestMode _TimeChanged"
    ),
)

_INTERVAL_SPEC = _leaf(
    "_Channel _Direction _Interval _Multiplier _TimestampEnd _TimestampStart _UOM"
)

_SUMMARY_CHANNEL = _leaf(
    "_Direction _FirstIntervalTimestamp _IntervalSeconds _Multiplier "
    "_NumIntervalsRead _ReadingRangeEndTimestamp _ReadingRangeStartTimestamp "
    "_SumOfIntervalValues _UOM"
)

_EVENT = _node(
    "_DiscoveredAt _EventInfo _Source _TimeStamp " + VALUE_TAG,
    EventAttribute=_many(_leaf("_Name _Value")),
)

# One row per meter readings element; every leaf is text.
DOCUMENT_SCHEMA = _node(
    "_CollectionTime _Initiator _Irn _Purpose _Source _SourceIrn _SourceName",
    Clock=_leaf(
        "_ActiveDayType _ActiveSeason _ActiveTier "
        "_DaylightAdjustmentInEffectAtMeter _MeterTime _ServerTime"
    ),
    CoincidentDemandData=_many(
        _node(CoincidentDemandSpec=_DEMAND_SPEC, Reading=_TIMED_VALUE)
    ),
    ConsumptionData=_many(_node(ConsumptionSpec=_DEMAND_SPEC, Reading=_TIMED_VALUE)),
    CumulativeDemandData=_many(
        _node(CumulativeDemandSpec=_DEMAND_SPEC, Reading=_TIMED_VALUE)
    ),
    DemandReset=_many(_leaf("_TimeStamp")),
    DemandResetCount=_many(_leaf("_Count _TimeStamp _UOM")),
    EventData=_many(_node(Event=_many(_EVENT), EventSpec=_leaf("_Category _Type"))),
    InstrumentationValue=_many(_leaf("_Name _Phase _Timestamp _Value")),
    IntervalData=_many(
        _node(IntervalSpec=_INTERVAL_SPEC, Reading=_many(_INTERVAL_READING))
    ),
    LoadProfileSummary=_many(_node(Channel=_SUMMARY_CHANNEL)),
    MaxDemandData=_many(_node(MaxDemandSpec=_DEMAND_SPEC, Reading=_TIMED_VALUE)),
    Meter=_METER,
    OutageCountSummary=_many(
        _node(
            OutageCount=_leaf("_PreviousReadingTime _PreviousValue _ReadingTime _Value")
        )
    ),
    ReadingQualityIndicator=_many(_leaf("_Name _Value")),
    ReverseEnergySummary=_many(
        _node(ReverseEnergy=_leaf("_CurrentValue _PreviousValue"))
    ),
    Statuses=_many(
        _node(Status=_many(_leaf("_Category _Id _Name _Type _Value")))
    ),
)

# The flat reading after translate.
READING_COLUMNS = (
    "servicePointId readingType variableId deviceId meteringType "
    "readingUtcLocalTime readingDateSource readingLocalTime dstStatus channel "
    "unitOfMeasure qualityCodesSystemId qualityCodesCategorization "
    "qualityCodesIndex intervalSize logNumber version readingsValue primarySource "
    "readingsSource owner guidFile estatus registersNumber eventsCode agentId "
    "agentDescription multiplier deviceMaster deviceDescription deviceStatus "
    "serial accountNumber servicePointTimeZone connectionType relationStartDate "
    "relationEndDate deviceType brand model"
).split()

INTEGER_COLUMNS = ["channel", "unitOfMeasure", "intervalSize", "logNumber"]

# The reading after clean.
FINAL_COLUMNS = (
    "servicePointId readingType variableId deviceId meteringType "
    "readingUtcLocalTime readingDateSource readingLocalTime dstStatus channel "
    "unitOfMeasure qualityCodesSystemId qualityCodesCategorization "
    "qualityCodesIndex intervalSize logNumber version readingsValue primarySource "
    "guidFile estatus registersNumber eventsCode agentId agentDescription "
    "multiplier deviceMaster deviceDescription deviceStatus serial accountNumber "
    "servicePointTimeZone connectionType relationStartDate relationEndDate "
    "deviceType brand model idVdi identReading idenEvent idDateYmd dateCreation "
    "usageReading usageValid ValidationDetail IsGrouped estimationReading "
    "estimationValid editionReading editionValid owner readingsSource idDateYw"
).split()

FINAL_INTEGERS = ["channel", "logNumber", "version", "idDateYmd", "idDateYw"]
# Numbers of rows pass the range of an integer.
FINAL_LONGS = ["idVdi", "identReading", "idenEvent"]
FINAL_FLOATS = ["readingsValue", "usageReading", "estimationReading", "editionReading"]

# Accepted readings as stored, the input of versioning.
STORED_COLUMNS = READING_COLUMNS + (
    "usageValid ValidationDetail IsGrouped usageReading estimationReading "
    "estimationValid editionReading editionValid"
).split()

# Keys.
CONFLICT_KEY = [
    "servicePointId", "deviceId", "meteringType", "variableId",
    "readingLocalTime", "logNumber",
]
DUPLICATE_KEY = CONFLICT_KEY + ["readingsValue"]
VERSION_KEY = [
    "servicePointId", "variableId", "logNumber", "readingUtcLocalTime",
    "meteringType", "readingsSource", "owner",
]
SERIES_KEY = ["servicePointId", "deviceId", "meteringType", "variableId", "logNumber"]
