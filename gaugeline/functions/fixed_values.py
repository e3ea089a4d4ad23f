"""Codes and labels that must equal the ones readers of the
output already know. Nothing here is computed."""

# Reading types.
REGISTERS = "REGISTERS"
EVENTS = "EVENTS"
LOAD_PROFILE = "LOAD PROFILE READING"

# How a reading was taken -> label in the output. Other texts pass unchanged.
SOURCE_LABELS = {
    "Visual": "Visual",
    "Remote": "Remoto",
    "LocalRF": "LAN",
    "Optical": "Optical",
    "Manually Estimated": "Visual",
    "LegacySystem": "HES",
}

# Unit text -> unit code.
UOM_CODES = {
    "kW": 96,
    "kWh": 74,
    "kVAr": 75,
    "kVArh": 77,
    "kVA": 78,
    "kVAh": 80,
    "kQ": 81,
    "kQh": 82,
    "-": 70,
    "V": 12,
    "A": 1,
    "ccf": 85,
    "gal": 86,
    "cgal": 87,
    "m^3": 88,
    "ft^3": 89,
    "in^3": 90,
    "yd^3": 91,
    "imp gal": 94,
    "L": 92,
    "af": 93,
    "Count": 99,
    "Hz": 97,
    "°": 98,
}

# Instrumentation name -> unit text; any other name has unit "-".
INSTRUMENTATION_UNITS = {
    "Current": "A",
    "Voltage": "V",
    "Power Factor Angle": "°",
    "Frequency": "Hz",
}

# Meter type -> (device type, brand, model). Other texts pass unchanged.
DEVICE_PROFILES = {
    "A3": ("Electric meter", "Elster", "Alpha A3"),
    "Alpha": ("Electric meter", "Elster", "Alpha"),
    "A3_ILN": ("Electric meter", "Elster", "A3 ILN"),
    "A3_Collector": ("Electric meter", "Elster", "A3 Collector"),
    "REX": ("Electric meter", "Elster", "REX"),
    "EAWater": ("Water meter", "Elster", "EAWater"),
    "EAGas": ("Gas meter", "Elster", "EAGas"),
}

# Active flag -> device status.
DEVICE_STATUS = {"true": "ENABLE", "false": "DISABLE"}

# Media type -> connection type.
CONNECTION_TYPES = {"Ethernet WIC": "TCP/Ethernet", "900Mhz": "RF"}
CONNECTION_LITERAL = "_MediaType"

# Quality flags in order of precedence -> (system, categorization, index).
QUALITY_CODES = [
    (("_TimeChanged",), ("2", "4", "9")),
    (("_ClockSetBackward",), ("1", "4", "128")),
    (("_LongInterval",), ("1", "4", "3")),
    (("_ClockSetForward",), ("1", "4", "64")),
    (("_PartialInterval",), ("1", "4", "2")),
    (("_InvalidTime",), ("1", "1", "9")),
    (("_SkippedInterval",), ("1", "4", "4")),
    (("_CompleteOutage", "_PartialOutage"), ("1", "2", "32")),
    (("_PulseOverflow",), ("1", "4", "1")),
    (("_TestMode",), ("1", "4", "5")),
    (("_Tamper",), ("1", "3", "0")),
    (("_SuspectedOutage", "_Restoration"), ("1", "2", "0")),
    (("_DST",), ("1", "4", "16")),
    (("_InvalidValue",), ("2", "5", "256")),
]

# Offset from UTC in hours, by time zone code 0 to 56. No daylight saving.
ZONE_OFFSET_HOURS = [
    -12, -11, -10, -9, -8, -7, -7, -6, -6, -6,
    -5, -5, -5, -4, -4, -3.5, -3, -3, -2, -1,
    0, 0, 1, 1, 1, 2, 2, 2, 2, 2,
    3, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 8,
    8, 9, 9.5, 9.5, 10, 10, 10, 11, 12, 12,
    -8, -7, -6, -6, -6, -6, 10,
]

# Constant columns of every reading.
METERING_TYPE = "MAIN"
STATUS_ACTIVE = "Activo"
DEVICE_CATEGORY = "METER"

# Reject reasons.
REASON_ASSOCIATION = "Estado de asociacion"
REASON_VARIABLE = "result variable - to stock "
REASON_NO_UTC = "missing utc time"
REASON_TYPE = "unknown reading type"
REASON_WINDOW = "dias pasado-futuro"
REASON_DUPLICATE = "Duplicados"
REASON_CONFLICT = "Valores inconsitentes"
REASON_SAME_VERSION = "Versionamiento duplicados"

# Audit actions and results.
ACTION_DISCARD = "Discard"
ACTION_DISCARD_TIME = "Discard lapse time"
ACTION_ZERO_FILL = "ZeroFilling"
ACTION_NULL_FILL = "NullFilling"
ACTION_VALIDATION = "Interval Validation"
RESULT_DISCARDED = "Discarded"
RESULT_FILLED = "Filled"
RESULT_SUCCESS = "Successful"
RESULT_FAILED = "Failed"

# Detail of a reading that stands for a missing interval.
MISSING_INTERVAL_DETAIL = "{'Usage':{'IntervalsError':'Interval not exist'}}"

# Audit message envelope.
AUDIT_USER = "System"
AUDIT_LEVEL = "INFO"
AUDIT_MESSAGE = " "
AUDIT_READINGS = "ReadingsProcessing"
AUDIT_LIFECYCLE = "ReadingsProcessingLifecycle"
AUDIT_PROCESS = {
    "translate": ("TRANSLATE", "Translate"),
    "enrich": ("ENRICHMENT", "Enrich"),
    "clean": ("CLEANING", "Cleaning"),
}
AUDIT_VALIDATION_SOURCE = "VALIDATION"
STAGE_STARTED = "processing_started"
STAGE_ENDED = "processing_ended"
