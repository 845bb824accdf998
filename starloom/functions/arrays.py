"""Small numpy helpers on one timestream, sweep or cut-out; they know nothing of Spark."""

from __future__ import annotations

import numpy as np


def highpass(x: np.ndarray, rate: float, cutoff: float) -> np.ndarray:
    """x (samples last) without the Fourier bins below cutoff; the mean goes with them."""
    if cutoff <= 0 or not x.shape[-1]:
        return x
    f = np.fft.rfft(x)
    f[..., np.fft.rfftfreq(x.shape[-1], 1 / rate) < cutoff] = 0
    return np.fft.irfft(f, n=x.shape[-1])


def notch(x: np.ndarray, rate: float, freq: float, harmonics: int, width: float) -> np.ndarray:
    """x (samples last) without the bins within width / 2 of each harmonic below the Nyquist frequency."""
    if freq <= 0 or not x.shape[-1]:
        return x
    bins = np.fft.rfftfreq(x.shape[-1], 1 / rate)
    lines = freq * np.arange(1, harmonics + 1)
    lines = lines[lines < rate / 2]
    f = np.fft.rfft(x)
    f[..., (np.abs(bins[:, None] - lines) <= width / 2).any(axis=1)] = 0
    return np.fft.irfft(f, n=x.shape[-1])


def stride_for(n: int) -> int:
    return 1 << int(np.log2(n / 100)) if n > 100 else 1


def one_sided(power: np.ndarray, n: int) -> np.ndarray:
    power[..., 1 : -1 if n % 2 == 0 else None] *= 2
    return power


def periodogram(x: np.ndarray, rate: float) -> np.ndarray:
    """One-sided power of x (samples last) less its strided median, under a symmetric Hann window."""
    n = x.shape[-1]
    w = np.hanning(n)
    y = (x - np.median(x[..., :: stride_for(n)], axis=-1, keepdims=True)) * w
    return one_sided(np.abs(np.fft.rfft(y)) ** 2 / (rate * (w**2).sum()), n)


def welch_segment(x: np.ndarray, rate: float) -> np.ndarray:
    """One-sided power of segments (samples last) less their means, under a periodic Hann window."""
    n = x.shape[-1]
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    return one_sided(np.abs(np.fft.rfft((x - x.mean(axis=-1, keepdims=True)) * w)) ** 2 / (rate * (w**2).sum()), n)


def gauss2d_fits(x: np.ndarray, y: np.ndarray, z: np.ndarray, step: float, rounds: int = 60) -> np.ndarray:
    """(amplitude, x, y, sigma, background) of a round Gaussian for each row of z at places x, y, all at once.

    Damped least squares within bounds; each row has its own damping and stops by itself.
    """
    k, mid = np.argmax(z, axis=1), np.median(z, axis=1)
    at = np.arange(len(z))
    big = np.full(len(z), np.inf)
    lo = np.stack([0 * mid, x.min(axis=1), y.min(axis=1), 0 * mid + 0.1 * step, -big], axis=1)
    hi = np.stack([big, x.max(axis=1), y.max(axis=1), 0 * mid + 8 * step, big], axis=1)
    p = np.clip(np.stack([np.maximum(z[at, k] - mid, 1e-12), x[at, k], y[at, k], 0 * mid + 1.5 * step, mid], axis=1), lo, hi)

    def model(p: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, cx, cy, s, b = (p[:, i, None] for i in range(5))
        dx, dy = x - cx, y - cy
        r2 = dx * dx + dy * dy
        e = np.exp(-r2 / (2 * s**2))
        return a * e + b, np.stack([e, a * e * dx / s**2, a * e * dy / s**2, a * e * r2 / s**3, np.ones_like(e)], axis=2)

    f, j = model(p, x, y)
    cost, damp, left = ((z - f) ** 2).sum(axis=1), np.full(len(z), 1e-3), np.arange(len(z))
    for _ in range(rounds):
        if not len(left):
            break
        jt = j[left].transpose(0, 2, 1)
        a = jt @ j[left]
        diag = np.maximum(np.einsum("kii->ki", a), 1e-12)
        a[:, np.arange(5), np.arange(5)] += damp[left, None] * diag + 1e-300
        step_ = np.linalg.solve(a, jt @ (z[left] - f[left])[:, :, None])[:, :, 0]
        new = np.clip(p[left] + step_, lo[left], hi[left])
        g, jg = model(new, x[left], y[left])
        c = ((z[left] - g) ** 2).sum(axis=1)
        good = c < cost[left]
        won = left[good]
        small = np.zeros(len(left), dtype=bool)
        small[good] = cost[won] - c[good] < 1e-14 * np.maximum(cost[won], 1e-300)
        p[won], f[won], j[won], cost[won] = new[good], g[good], jg[good], c[good]
        damp[left] *= np.where(good, 1 / 3, 4.0)
        left = left[~small & (damp[left] <= 1e12)]
    return p


#: The larger terms of the 1980 theory of nutation.  Multiples of the moon's elongation, the sun's and the moon's mean
#: anomaly, the moon's argument of latitude and its node; sine of longitude and its change a century, cosine of obliquity and its change, in 0.0001 arc seconds.
NUTATION = np.array([
    (0, 0, 0, 0, 1, -171996, -174.2, 92025, 8.9), (-2, 0, 0, 2, 2, -13187, -1.6, 5736, -3.1), (0, 0, 0, 2, 2, -2274, -0.2, 977, -0.5), (0, 0, 0, 0, 2, 2062, 0.2, -895, 0.5),
    (0, 1, 0, 0, 0, 1426, -3.4, 54, -0.1), (0, 0, 1, 0, 0, 712, 0.1, -7, 0), (-2, 1, 0, 2, 2, -517, 1.2, 224, -0.6), (0, 0, 0, 2, 1, -386, -0.4, 200, 0),
    (0, 0, 1, 2, 2, -301, 0, 129, -0.1), (-2, -1, 0, 2, 2, 217, -0.5, -95, 0.3), (-2, 0, 1, 0, 0, -158, 0, 0, 0), (-2, 0, 0, 2, 1, 129, 0.1, -70, 0),
    (0, 0, -1, 2, 2, 123, 0, -53, 0), (2, 0, 0, 0, 0, 63, 0, 0, 0), (0, 0, 1, 0, 1, 63, 0.1, -33, 0), (2, 0, -1, 2, 2, -59, 0, 26, 0),
    (0, 0, -1, 0, 1, -58, -0.1, 32, 0), (0, 0, 1, 2, 1, -51, 0, 27, 0), (-2, 0, 2, 0, 0, 48, 0, 0, 0), (0, 0, -2, 2, 1, 46, 0, -24, 0), (2, 0, 0, 2, 2, -38, 0, 16, 0),
])
ARC = np.pi / 180 / 3600
#: The constant of aberration, the site's speed at the equator over that of light, and the obliquity of 2000.
ABERRATION, SITE_SPEED, OBLIQUITY = 20.49552 * ARC, 1.5514e-6, 84381.406 * ARC


def nutation(t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nutation in longitude and obliquity and the mean obliquity, in radians, t in centuries from 2000."""
    angles = np.radians(np.stack([297.85036 + 445267.111480 * t, 357.52772 + 35999.050340 * t, 134.96298 + 477198.867398 * t, 93.27191 + 483202.017538 * t, 125.04452 - 1934.136261 * t]))
    phase = np.tensordot(NUTATION[:, :5], angles, axes=1)
    term = NUTATION[:, 5:, None]
    dpsi = ((term[:, 0] + term[:, 1] * t) * np.sin(phase)).sum(axis=0) * 1e-4 * ARC
    deps = ((term[:, 2] + term[:, 3] * t) * np.cos(phase)).sum(axis=0) * 1e-4 * ARC
    return dpsi, deps, OBLIQUITY - 46.836769 * t * ARC


def _turned(v: np.ndarray, axis: int, b: np.ndarray) -> np.ndarray:
    """v in axes turned by b about one of them."""
    c, s, (i, j) = np.cos(b), np.sin(b), ((1, 2), (2, 0), (0, 1))[axis]
    out = [v[0], v[1], v[2]]
    out[i], out[j] = c * v[i] + s * v[j], c * v[j] - s * v[i]
    return np.stack(out)


def _precession(t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (2306.083227 * t + 0.2988499 * t**2) * ARC, (2306.077181 * t + 1.0927348 * t**2) * ARC, (2004.191903 * t - 0.4294934 * t**2) * ARC


def _orbital_speed(t: np.ndarray) -> np.ndarray:
    """The earth's speed over that of light on the axes of 2000, from its elliptic orbit."""
    g = np.radians(357.52911 + 35999.05029 * t)
    sun = np.radians(280.46646 + 36000.76983 * t - 1.3969713 * t) + np.radians((1.914602 - 0.004817 * t) * np.sin(g) + 0.019993 * np.sin(2 * g) + 0.000289 * np.sin(3 * g))
    e, perihelion = 0.016708634 - 0.000042037 * t, np.radians(102.93735 + 0.32245 * t)  # on the equinox of 2000
    x, y = np.sin(sun) - e * np.sin(perihelion), -np.cos(sun) + e * np.cos(perihelion)
    return ABERRATION * np.stack([x, y * np.cos(OBLIQUITY), y * np.sin(OBLIQUITY)])


def apparent_to_icrs(v: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Unit vectors on the true equator of date, seen by the moving earth, to the axes of 2000 at rest."""
    dpsi, deps, eps = nutation(t)
    v = _turned(_turned(_turned(v, 0, eps + deps), 2, dpsi), 0, -eps)
    zeta, z, theta = _precession(t)
    v = _turned(_turned(_turned(v, 2, z), 1, -theta), 2, zeta) - _orbital_speed(t)
    return v / np.linalg.norm(v, axis=0)


def icrs_to_apparent(v: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The way back."""
    zeta, z, theta = _precession(t)
    speed = _orbital_speed(t)
    # the same rule as above, solved for the direction that it started from: |v - speed| times the direction at rest, plus the speed
    along = (v * speed).sum(axis=0)
    size = -along + np.sqrt(along**2 + 1 - (speed**2).sum(axis=0))
    v = _turned(_turned(_turned(v * size + speed, 2, -zeta), 1, theta), 2, -z)
    dpsi, deps, eps = nutation(t)
    return _turned(_turned(_turned(v, 0, eps), 2, -dpsi), 0, -eps - deps)


def _clock(unix: np.ndarray, lon: float, dut1: float) -> tuple[np.ndarray, np.ndarray]:
    """Centuries from 2000 and the local apparent sidereal time."""
    d = unix / 86400 + 40587 - 51544.5  # days of UT from 2000 January 1, noon
    t = (d + 69.2 / 86400) / 36525
    era = 2 * np.pi * (0.7790572732640 + 1.00273781191135448 * (d + dut1 / 86400))
    dpsi, deps, eps = nutation(t)
    return t, era + (0.014506 + 4612.156534 * t + 1.3915817 * t**2) * ARC + dpsi * np.cos(eps + deps) + np.radians(lon)


def altaz_to_radec(az: np.ndarray, el: np.ndarray, unix: np.ndarray, lat: float, lon: float, dut1: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Azimuth and elevation without air, in degrees, to ICRS: earth rotation, the site's speed, nutation, precession, aberration.

    Good to an arc second with the right dut1 (UT1 - UTC in seconds); polar motion is left out.
    """
    t, lst = _clock(unix, lon, dut1)
    a, e, phi = np.radians(az), np.radians(el), np.radians(lat)
    x, y, z = np.cos(e) * np.cos(a), np.cos(e) * np.sin(a), np.sin(e)  # north, east, up
    y = y - SITE_SPEED * np.cos(phi)
    size = np.sqrt(x * x + y * y + z * z)
    x, y, z = x / size, y / size, z / size
    v = _turned(np.stack([z * np.cos(phi) - x * np.sin(phi), y, z * np.sin(phi) + x * np.cos(phi)]), 2, -lst)
    v = apparent_to_icrs(v, t)
    return np.degrees(np.arctan2(v[1], v[0])) % 360, np.degrees(np.arcsin(np.clip(v[2], -1, 1)))


def radec_to_altaz(ra: np.ndarray, dec: np.ndarray, unix: np.ndarray, lat: float, lon: float, dut1: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """ICRS to azimuth and elevation without air: the way back."""
    t, lst = _clock(unix, lon, dut1)
    r, d, phi = np.radians(ra), np.radians(dec), np.radians(lat)
    v = _turned(icrs_to_apparent(np.stack([np.cos(d) * np.cos(r), np.cos(d) * np.sin(r), np.sin(d)]), t), 2, lst)
    x, y, z = v[2] * np.cos(phi) - v[0] * np.sin(phi), v[1], v[2] * np.sin(phi) + v[0] * np.cos(phi)
    b = SITE_SPEED * np.cos(phi)
    size = -b * y + np.sqrt((b * y) ** 2 + 1 - b * b)
    x, y, z = x * size, y * size + b, z * size
    return np.degrees(np.arctan2(y, x)) % 360, np.degrees(np.arcsin(np.clip(z, -1, 1)))
