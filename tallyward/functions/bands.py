"""Risk bands shared by the rule score and the model score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of each band, highest first; below all of them is "normal".
BAND_FLOORS = (("critical", 80), ("high", 60), ("medium", 35), ("low", 15))
BANDS = ("normal", "low", "medium", "high", "critical")

# What to do about a source-day in each band.
BAND_ACTIONS = {
    "critical": "Immediate integrity and finance review",
    "high": "Prioritise for same-day investigation",
    "medium": "Review during daily reconciliation",
    "low": "Monitor for repeated pattern",
    "normal": "No action required",
}


def risk_band(score: Column) -> Column:
    band = F.lit("normal")
    for name, floor in reversed(BAND_FLOORS):
        band = F.when(score >= floor, name).otherwise(band)
    return band


def band_action(score: Column) -> Column:
    action = F.lit(BAND_ACTIONS["normal"])
    for name, floor in reversed(BAND_FLOORS):
        action = F.when(score >= floor, BAND_ACTIONS[name]).otherwise(action)
    return action


def gravity_order(name: Column) -> Column:
    """Sort position by gravity: critical, high, medium, low, then the rest."""
    position = F.lit(len(BAND_FLOORS))
    for rank, (band, _) in reversed(list(enumerate(BAND_FLOORS))):
        position = F.when(name == band, rank).otherwise(position)
    return position
