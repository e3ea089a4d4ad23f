"""Settings of the clean stage, passed as one argument."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Days a reading may lie before the start of its relation or after the run
    date, whether outage gaps are filled with zero, and the quality flags
    (``system-categorization-index``) that mean a power outage. Target and event
    type are what audit messages name as their receiver."""

    load_profile_past_days: int = 30
    load_profile_future_days: int = 1
    other_past_days: int = 30
    other_future_days: int = 1
    fill_with_zero: bool = True
    outage_flags: tuple[str, ...] = ("1-2-32", "1-2-0")
    audit_target: str = "audit"
    audit_event_type: str = "readings"

    @classmethod
    def from_document(cls, document: dict) -> "Settings":
        """Settings from the configuration record: ``configPastFutureDays``,
        ``withNullsOrCero.withCeros`` and ``QualityCode.PowerOutage``."""
        days = {item["type"]: item for item in document["configPastFutureDays"]}
        profile = days["LP"]
        other = next(item for kind, item in days.items() if kind != "LP")
        return cls(
            load_profile_past_days=int(profile["past"]),
            load_profile_future_days=int(profile["future"]),
            other_past_days=int(other["past"]),
            other_future_days=int(other["future"]),
            fill_with_zero=bool(document["withNullsOrCero"]["withCeros"]),
            outage_flags=tuple(document["QualityCode"]["PowerOutage"]),
        )
