"""Column expressions that several operators share."""

from __future__ import annotations

import fnmatch
from functools import reduce
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def struct_of(**fields: Column) -> Column:
    return F.struct(*(v.alias(k) for k, v in fields.items()))


def well_id(row: Column, col: Column, plate_type: int) -> Column:
    """``A01``; on plates of 1536 wells the 4 by 4 grid within a base well is named too, as in ``A01.a1``."""
    letter = lambda n: F.char((n + 64).cast("int"))
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    if plate_type != 1536:
        return F.concat(letter(row), F.when(col < 100, two(col)).otherwise(col.cast("int").cast("string")))
    base = lambda n: F.floor((n - 1) / 4) + 1
    within = lambda n: (n - 1) % 4
    return F.concat(letter(base(row)), two(base(col)), F.lit("."), F.char((within(row) + 97).cast("int")), (within(col) + 1).cast("int").cast("string"))


def well_of_path(path: Column) -> Column:
    """The well of an image path ``…/<row>/<col>/<image>``."""
    return F.concat(F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+/?$", 1), F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+/?$", 2))


def glob(column: Column, pattern: str) -> Column:
    """Whether the whole text matches a shell pattern."""
    body = fnmatch.translate(pattern)
    for a, b in (("(?s:", ""), (r")\z", ""), (r")\Z", ""), ("(?>", "(?:")):
        body = body.replace(a, b)
    return column.rlike(f"(?s)^(?:{body})$")


def sanitize(column: Column) -> Column:
    """A name in which every run of characters that paths dislike is one underscore."""
    return F.regexp_replace(column, r"[^A-Za-z0-9_.-]+", "_")


def log2_float(column: Column) -> Column:
    return F.log2(column).cast("float")


def duration_seconds(a: Column, b: Column) -> Column:
    """Whole seconds from ``b`` to ``a``."""
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return F.floor((micros(a) - micros(b)) / F.lit(1_000_000)).cast("long")


def sphere_radius(volume: Column) -> Column:
    return F.pow(F.lit(3.0) * volume / F.lit(4 * pi), F.lit(1 / 3))


def kernel(name: str, z: Column) -> Column:
    """Weight of a neighbour at ``z`` = distance over bandwidth."""
    z = z.cast("double")
    kernels = {
        "uniform": lambda: F.lit(0.5),
        "triangular": lambda: F.lit(1.0) - F.abs(z),
        "gaussian": lambda: F.exp(-z * z / 2) / F.lit((2 * pi) ** 0.5),
    }
    if name not in kernels:
        raise ValueError(f"unknown kernel {name!r}")
    return kernels[name]()


# Model functions: ``p`` are the parameters, ``x`` the features.
def linear(p: list[Column], x: list[Column]) -> Column:
    return reduce(lambda s, bx: s + bx[0] * bx[1], zip(p[1:], x), p[0])


def exponential(p: list[Column], x: list[Column]) -> Column:
    """``A0`` times the product of ``exp(b x)``."""
    return p[0] * F.exp(reduce(lambda s, t: s + t, [b * v for b, v in zip(p[1:], x)]))


def exponential_offset(p: list[Column], x: list[Column]) -> Column:
    return exponential(p[:-1], x) + p[-1]


def power_law(p: list[Column], x: list[Column]) -> Column:
    return reduce(lambda s, bx: s * F.pow(bx[1], bx[0]), zip(p[1:], x), p[0])


def power_law_offset(p: list[Column], x: list[Column]) -> Column:
    return power_law(p[:-1], x) + p[-1]


def safe_divide(a: Column, b: Column) -> Column:
    """Null where ``b`` is 0."""
    return F.when(b != 0, a / b)
