"""Which kind of place a spatial identifier names."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Postal codes of states and territories, grid operators, and what is outside the contiguous states.
# fmt: off
STATES = (
    "AK", "AL", "AR", "AS", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "GU", "HI", "IA", "ID", "IL", "IN", "KS", "KY",
    "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MP", "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK",
    "OR", "PA", "PR", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY",
)
# fmt: on
GRID_OPERATORS = ("CAISO", "ERCOT", "ISONE", "NYISO", "MISO", "PJM", "SPP")
CONTIGUOUS = "CONUS"
NOT_CONTIGUOUS = ("AK", "HI", "PR", "GU", "VI", "AS", "MP")


class Place(NamedTuple):
    kind: str  # "state", "grid operator", "contiguous" or "station"
    code: str


def classify(identifier: str) -> Place:
    """Two letters are a state (unknown ones are an error); what is no region is a station. Case counts."""
    if len(identifier) == 2:
        if identifier not in STATES:
            raise ValueError(f"unknown state or territory: {identifier!r}")
        return Place("state", identifier)
    if identifier in GRID_OPERATORS:
        return Place("grid operator", identifier)
    return Place("contiguous" if identifier == CONTIGUOUS else "station", identifier)


def kind_of(code: Column) -> Column:
    """classify() over a column: the kind of place, null for two letters that are no state."""
    state = F.when(code.isin(*STATES), "state")
    other = F.when(code.isin(*GRID_OPERATORS), "grid operator").when(code == CONTIGUOUS, "contiguous").otherwise("station")
    return F.when(F.length(code) == 2, state).otherwise(other)


def shape_filter(place: Place) -> str | None:
    """SQL condition on a table of shapes (STUSPS for states; RTO_ISO and LOC_TYPE for grid operators); None for a station.

    One grid operator's shapes are taken whatever their LOC_TYPE.
    """
    if place.kind == "state":
        return f"STUSPS = '{place.code}'"
    if place.kind == "contiguous":
        return "STUSPS NOT IN ({})".format(", ".join(f"'{x}'" for x in NOT_CONTIGUOUS))
    if place.kind == "grid operator":
        return f"RTO_ISO = '{place.code}'" + ("" if place.code == "PJM" else " AND LOC_TYPE = 'REG'")
    return None
