"""Map projections as column expressions: degrees to metres and back. Nothing but JVM arithmetic, so they fuse with what surrounds them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid of WGS 84.
AXIS, FLATTENING = 6_378_137.0, 1 / 298.257223563
#: Steps of the inverse latitude; each gains more than two digits, so the rest is below 1e-12 degrees.
STEPS = 7


def _eccentric(flattening: float) -> float:
    return math.sqrt(flattening * (2 - flattening))


def _latitude(t: Column, e: float) -> Column:
    """Latitude in radians whose conformal colatitude has the tangent t."""
    phi = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(STEPS if e else 0):
        s = F.sin(phi) * e
        phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))
    return phi


@dataclass(frozen=True)
class Mercator:
    """Spherical (web) Mercator by default; with a flattening, the ellipsoid's."""

    axis: float = AXIS
    flattening: float = 0.0
    longitude: float = 0.0

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        e = _eccentric(self.flattening)
        phi = F.radians(lat)
        y = F.log(F.tan(phi / 2 + math.pi / 4))
        if e:
            s = F.sin(phi) * e
            y = y + F.log((1 - s) / (1 + s)) * (e / 2)
        return F.radians(lon - self.longitude) * self.axis, y * self.axis

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.degrees(x / self.axis) + self.longitude, F.degrees(_latitude(F.exp(-y / self.axis), _eccentric(self.flattening)))


@dataclass(frozen=True)
class Lambert:
    """Lambert conformal conic with one or two standard parallels; the defaults are those of the station map."""

    longitude: float = -97.5
    latitude: float = 38.5
    parallels: tuple[float, float] = (38.5, 38.5)
    axis: float = AXIS
    flattening: float = FLATTENING

    def _t(self, degrees: float) -> float:
        phi, e = math.radians(degrees), _eccentric(self.flattening)
        s = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    def _m(self, degrees: float) -> float:
        phi, e = math.radians(degrees), _eccentric(self.flattening)
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    @property
    def cone(self) -> float:
        a, b = self.parallels
        if a == b:
            return math.sin(math.radians(a))
        return (math.log(self._m(a)) - math.log(self._m(b))) / (math.log(self._t(a)) - math.log(self._t(b)))

    @property
    def scale(self) -> float:
        return self.axis * self._m(self.parallels[0]) / (self.cone * self._t(self.parallels[0]) ** self.cone)

    @property
    def origin(self) -> float:
        """Radius of the origin's parallel."""
        return self.scale * self._t(self.latitude) ** self.cone

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        phi, e = F.radians(lat), _eccentric(self.flattening)
        s = F.sin(phi) * e
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
        radius, turn = F.pow(t, F.lit(self.cone)) * self.scale, F.radians(lon - self.longitude) * self.cone
        return radius * F.sin(turn), F.lit(self.origin) - radius * F.cos(turn)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        down, sign = F.lit(self.origin) - y, math.copysign(1.0, self.cone)
        radius = F.sqrt(x * x + down * down) * sign
        turn = F.atan2(x * sign, down * sign)
        t = F.pow(radius / self.scale, F.lit(1 / self.cone))
        return F.degrees(turn / self.cone) + self.longitude, F.degrees(_latitude(t, _eccentric(self.flattening)))
