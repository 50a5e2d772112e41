"""Transverse Mercator on WGS84 as Column expressions (third-order Krueger series)."""

from __future__ import annotations

from dataclasses import dataclass
from math import pi

from pyspark.sql import Column, functions as F

_F = 1 / 298.257223563
_N = _F / (2 - _F)
_E = (_F * (2 - _F)) ** 0.5
_A = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORWARD = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)


@dataclass(frozen=True)
class TransverseMercator:
    """Metres from the central meridian and the equator."""

    lon0: float = -122.4
    k0: float = 0.9996

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        phi, lam = lat * (pi / 180), (lon - self.lon0) * (pi / 180)
        t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
        xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
        x, y = eta, xi
        for j, a in enumerate(_FORWARD, 1):
            x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
            y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        return self.k0 * _A * x, self.k0 * _A * y

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        xi0, eta0 = y / (self.k0 * _A), x / (self.k0 * _A)
        xi, eta = xi0, eta0
        for j, b in enumerate(_BACK, 1):
            xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
            eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
        chi = F.asin(F.sin(xi) / F.cosh(eta))
        # conformal to geodetic latitude, by Newton steps on the isometric latitude
        phi = chi
        for _ in range(4):
            phi = F.atan(F.sinh(F.atanh(F.sin(chi)) + _E * F.atanh(_E * F.sin(phi))))
        return self.lon0 + F.atan2(F.sinh(eta), F.cos(xi)) * (180 / pi), phi * (180 / pi)
