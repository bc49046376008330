"""What distinguishes the two products: names of columns, flags and folders. All else is shared."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Product:
    """flags: value column to its quality flag; renames: raw name to common name."""

    name: str
    folder: str
    time: str
    station: str
    plain: tuple[str, ...]
    flags: dict[str, str]
    renames: dict[str, str] = field(default_factory=dict)

    @property
    def raw_columns(self) -> tuple[str, ...]:
        """All that is read of a raw file, each once."""
        return tuple(dict.fromkeys((*self.plain, *self.flags, *self.flags.values(), self.time)))

    @property
    def observables(self) -> tuple[str, ...]:
        names = [self.renames.get(x, x) for x in (*self.plain, *self.flags)]
        fixed = {"station_id", "latitude", "longitude", "elevation", "windSpeed", "windDir"}
        return tuple(sorted(x for x in names if x not in fixed)) + ("U10", "V10")


# The archive's variable names, flags and folders.
MESONET = Product(
    name="mesonet",
    folder="LDAD/mesonet/netCDF",
    time="reportTime",
    station="stationId",
    plain=("stationId", "latitude", "longitude", "elevation", "solarRadiation"),
    flags={"dewpoint": "dewpointDD", "temperature": "temperatureDD", "windDir": "windDirDD", "windSpeed": "windSpeedDD"},
    renames={"stationId": "station_id", "reportTime": "time"},
)
METAR = Product(
    name="metar",
    folder="point/metar/netcdf",
    time="timeObs",
    station="stationName",
    plain=("stationName", "latitude", "longitude", "elevation"),
    # The values in tenths go by the flags of the whole degrees.
    flags={"dpFromTenths": "dewpointDD", "tempFromTenths": "temperatureDD", "windDir": "windDirDD", "windSpeed": "windSpeedDD"},
    renames={"stationName": "station_id", "timeObs": "time", "tempFromTenths": "temperature", "dpFromTenths": "dewpoint"},
)
PRODUCTS = {p.name: p for p in (MESONET, METAR)}
