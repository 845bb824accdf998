"""Column arithmetic on directions, quaternions and times; all of it stays in generated code.

Quaternions are structs <x, y, z, w>; vectors are structs <x, y, z>; angles are degrees.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that are bodies of the solar system.
SOLAR_SYSTEM = ("sun", "moon", "mercury", "venus", "mars", "jupiter", "saturn", "uranus", "neptune")


def finite(x: Column) -> Column:
    """x, or null where it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def vec(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def quat(x: Column, y: Column, z: Column, w: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"), w.alias("w"))


def quat_from_wxyz(q: Column) -> Column:
    """A stored (w, x, y, z) array as a quaternion struct, row by row."""
    return quat(q[1], q[2], q[3], q[0])


def _unit(q: Column) -> tuple[Column, Column, Column, Column]:
    n = F.sqrt(q["x"] ** 2 + q["y"] ** 2 + q["z"] ** 2 + q["w"] ** 2)
    return q["x"] / n, q["y"] / n, q["z"] / n, q["w"] / n


def quat_rotate(q: Column, v: Column) -> Column:
    """v turned by q: v + 2 u x (u x v + w v), with u the vector part of the unit quaternion."""
    x, y, z, w = _unit(q)
    a, b, c = y * v["z"] - z * v["y"] + w * v["x"], z * v["x"] - x * v["z"] + w * v["y"], x * v["y"] - y * v["x"] + w * v["z"]
    return vec(v["x"] + 2 * (y * c - z * b), v["y"] + 2 * (z * a - x * c), v["z"] + 2 * (x * b - y * a))


def quat_rotate_inv(q: Column, v: Column) -> Column:
    return quat_rotate(quat(-q["x"], -q["y"], -q["z"], q["w"]), v)


def vec_ra(v: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(v["y"], v["x"])), F.lit(360.0))


def vec_dec(v: Column) -> Column:
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v["z"]))))


def radec_vec(ra: Column, dec: Column) -> Column:
    r, d = F.radians(ra), F.radians(dec)
    return vec(F.cos(d) * F.cos(r), F.cos(d) * F.sin(r), F.sin(d))


def boresight_dir(q: Column) -> Column:
    """The direction of the z axis turned by q."""
    return quat_rotate(q, vec(F.lit(0.0), F.lit(0.0), F.lit(1.0)))


def focalplane_x(v: Column) -> Column:
    theta, phi = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v["z"]))), F.atan2(v["y"], v["x"])
    return F.degrees(theta * F.cos(phi))


def focalplane_y(v: Column) -> Column:
    theta, phi = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v["z"]))), F.atan2(v["y"], v["x"])
    return F.degrees(theta * F.sin(phi))


def source_du(q: Column, v: Column) -> Column:
    s = quat_rotate_inv(q, v)
    return F.degrees(F.atan2(s["x"], s["z"]))


def source_dv(q: Column, v: Column) -> Column:
    s = quat_rotate_inv(q, v)
    return F.degrees(F.atan2(s["y"], s["z"]))


def ticks_to_unix(t: Column) -> Column:
    """Ticks of 10 ns as Unix seconds."""
    return t / F.lit(1e8)


def safe_name(det: Column) -> Column:
    return F.translate(det, "/\\: ", "____")


def is_solar_system_body(name: Column) -> Column:
    return F.lower(F.trim(name)).isin(*SOLAR_SYSTEM)


def pixel_center(lo: float, step: float, i: Column) -> Column:
    return F.lit(lo) + (i + 0.5) * step


def shortest_arc(d: Column, period: float = 360.0) -> Column:
    """A difference of angles brought to [-period/2, period/2)."""
    return F.pmod(d + period / 2, F.lit(period)) - period / 2
