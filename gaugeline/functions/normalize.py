"""Column rules that turn document texts into codes and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.functions import fixed_values as fv


def mapped(col: Column, table: dict, otherwise: Column | None = None) -> Column:
    """Value of ``table`` for the text in ``col``; ``otherwise`` (default null)
    for texts the table does not know. The table is one literal map, which keeps
    the compiled code of wide rows small."""
    literal = F.create_map(*[F.lit(item) for pair in table.items() for item in pair])
    found = literal[col]
    return found if otherwise is None else F.coalesce(found, otherwise)


def source_label(source: Column) -> Column:
    return mapped(source, fv.SOURCE_LABELS, source)


def service_point(sdp: Column, meter: Column) -> Column:
    return F.coalesce(sdp, meter)


def whole_number(text: Column) -> Column:
    """Text as an integer, null if it is none. A failed cast costs an exception, so a text
    that does not begin like a number is not cast."""
    return F.when(text.rlike(r"^[\x00-\x20\x7f+.-]*[0-9]"), text.try_cast("int"))


def uom_code(unit: Column) -> Column:
    """Unit text to code. A text that is already a number stays that number,
    any other unknown text is null."""
    return mapped(unit, fv.UOM_CODES, whole_number(unit))


def device_profile(meter_type: Column) -> dict[str, Column]:
    """Device type, brand and model of a meter type."""
    names = ("deviceType", "brand", "model")
    rows = {
        key: F.struct(*[F.lit(text).alias(name) for name, text in zip(names, row)])
        for key, row in fv.DEVICE_PROFILES.items()
    }
    known = F.create_map(*[item for key, row in rows.items() for item in (F.lit(key), row)])
    row = known[meter_type]
    return {name: F.coalesce(row.getField(name), meter_type) for name in names}


def device_status(is_active: Column) -> Column:
    return mapped(is_active, fv.DEVICE_STATUS)


def connection_type(media: Column, literal_for_unknown: bool = False) -> Column:
    """Known media types are renamed, others pass through.
    ``literal_for_unknown`` writes the fixed text ``_MediaType`` for them
    instead, for users whose downstream tables already hold it."""
    other = F.lit(fv.CONNECTION_LITERAL) if literal_for_unknown else media
    return mapped(media, fv.CONNECTION_TYPES, other)


def quality_codes(flags: Column) -> Column:
    """Struct of the first present flag's codes (system, categorization, index)
    and the daylight saving mark; null fields when no flag is present."""

    def codes(system, categorization, index, dst):
        return F.struct(
            F.lit(system).cast("string").alias("system"),
            F.lit(categorization).cast("string").alias("categorization"),
            F.lit(index).cast("string").alias("index"),
            F.lit(dst).cast("string").alias("dst"),
        )

    choices = []
    for names, triple in fv.QUALITY_CODES:
        present = reduce(
            lambda a, b: a | b, [flags.getField(n).isNotNull() for n in names]
        )
        dst = "1" if names == ("_DST",) else None
        choices.append(F.when(present, codes(*triple, dst)))
    return F.coalesce(*choices, codes(None, None, None, None))


def multiplier_text(ke: Column) -> Column:
    """The multiplier map as text. A missing factor gives null, an empty one an
    empty factor."""
    return F.concat(F.lit("'MultiplierValues':{'ke':'"), ke, F.lit("'}"))


def usage_value(value: Column, multiplier: Column) -> Column:
    """Reading value times every non-empty number in the multiplier map. Null
    if the value or a factor is no number or the map is missing."""
    number = value.try_cast("double")

    def times(product: Column, factor: Column) -> Column:
        blank = factor.isNull() | (factor == "")
        return F.when(blank, product).otherwise(product * factor.try_cast("double"))

    # The map as multiplier_text writes it needs no JSON parser.
    head, tail = "'MultiplierValues':{'ke':'", "'}"
    single = multiplier.startswith(head) & multiplier.endswith(tail) & (
        F.instr(multiplier, ",") == 0
    )
    factor = F.substring(
        multiplier, F.lit(len(head) + 1), F.length(multiplier) - len(head) - len(tail)
    )
    body = F.regexp_replace(multiplier, "^[^:]*:", "")
    factors = F.map_values(
        F.from_json(body, "map<string,string>", {"allowSingleQuotes": "true"})
    )
    # Most gap rows have no value: no parser for them.
    return (
        F.when(number.isNull() | multiplier.isNull(), F.lit(None).cast("double"))
        .when(single, times(number, factor))
        .otherwise(F.aggregate(factors, number, times))
    )


def quality_flag(system: Column, categorization: Column, index: Column) -> Column:
    """``system-categorization-index``, null if any part is missing."""
    return F.concat(system, F.lit("-"), categorization, F.lit("-"), index)
