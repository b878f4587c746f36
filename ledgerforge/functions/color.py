"""Colour science as column functions: sRGB to CIELAB (D65), and CIEDE2000 with unit weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sRGB to XYZ matrix by rows, and the D65 white point.
_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
_WHITE = (0.95047, 1.0, 1.08883)
_EPSILON, _KAPPA = 216.0 / 24389.0, 24389.0 / 27.0
#: No pair closer than t differs in lightness by more than this times t (the lightness weight's maximum).
LIGHTNESS_BOUND = 1.7471


def with_lab(df: DataFrame, r: str = "r", g: str = "g", b: str = "b") -> DataFrame:
    """df with lab_l, lab_a, lab_b."""

    def linear(c: str) -> Column:
        x = F.col(c) / 255.0
        return F.when(x <= 0.04045, x / 12.92).otherwise(F.pow((x + 0.055) / 1.055, F.lit(2.4)))

    df = df.withColumns({"__lr": linear(r), "__lg": linear(g), "__lb": linear(b)})
    xyz = [(m[0] * F.col("__lr") + m[1] * F.col("__lg") + m[2] * F.col("__lb")) / w for m, w in zip(_XYZ, _WHITE, strict=True)]
    df = df.withColumns({f"__t{k}": t for k, t in enumerate(xyz)})
    f = [F.when(F.col(f"__t{k}") > _EPSILON, F.cbrt(f"__t{k}")).otherwise((_KAPPA * F.col(f"__t{k}") + 16) / 116) for k in range(3)]
    df = df.withColumns({f"__f{k}": x for k, x in enumerate(f)})
    df = df.withColumns({"lab_l": 116 * F.col("__f1") - 16, "lab_a": 500 * (F.col("__f0") - F.col("__f1")), "lab_b": 200 * (F.col("__f1") - F.col("__f2"))})
    return df.drop(*(f"__{x}" for x in ("lr", "lg", "lb", "t0", "t1", "t2", "f0", "f1", "f2")))


def with_delta_e(df: DataFrame, one: tuple[str, str, str], two: tuple[str, str, str], out: str = "delta_e") -> DataFrame:
    """df with the CIEDE2000 distance of two colours.

    The result stands behind a generator, so that a filter on it isn't pushed into the formula: inlined there, the formula outgrows
    the size up to which Spark compiles a method.
    """
    c = F.col
    cos = lambda x: F.cos(F.radians(x))
    l1, a1, b1, l2, a2, b2 = (c(x) for x in (*one, *two))
    seven = lambda x: F.sqrt(F.pow(x, F.lit(7.0)) / (F.pow(x, F.lit(7.0)) + 6103515625.0))
    df = df.withColumn("__g", 1.5 - 0.5 * seven((F.sqrt(a1 * a1 + b1 * b1) + F.sqrt(a2 * a2 + b2 * b2)) / 2))
    df = df.withColumns({"__p1": a1 * c("__g"), "__p2": a2 * c("__g")})
    hue = lambda b, a: F.when((a == 0) & (b == 0), 0.0).otherwise(F.pmod(F.degrees(F.atan2(b, a)) + 360, F.lit(360.0)))
    df = df.withColumns({"__c1": F.sqrt(c("__p1") * c("__p1") + b1 * b1), "__c2": F.sqrt(c("__p2") * c("__p2") + b2 * b2), "__h1": hue(b1, c("__p1")), "__h2": hue(b2, c("__p2"))})
    gray = c("__c1") * c("__c2") == 0
    gap, total = c("__h2") - c("__h1"), c("__h1") + c("__h2")
    turn = F.when(gray, 0.0).when(gap > 180, gap - 360).when(gap < -180, gap + 360).otherwise(gap)
    mean = F.when(gray, total).when(F.abs(gap) <= 180, total / 2).when(total < 360, (total + 360) / 2).otherwise((total - 360) / 2)
    df = df.withColumns({"__dh": 2 * F.sqrt(c("__c1") * c("__c2")) * F.sin(F.radians(turn / 2)), "__hm": mean, "__cm": (c("__c1") + c("__c2")) / 2, "__lm": (l1 + l2) / 2 - 50})
    t = 1 - 0.17 * cos(c("__hm") - 30) + 0.24 * cos(2 * c("__hm")) + 0.32 * cos(3 * c("__hm") + 6) - 0.20 * cos(4 * c("__hm") - 63)
    df = df.withColumns({
        "__x": (l2 - l1) / (1 + 0.015 * c("__lm") * c("__lm") / F.sqrt(20 + c("__lm") * c("__lm"))),
        "__y": (c("__c2") - c("__c1")) / (1 + 0.045 * c("__cm")),
        "__z": c("__dh") / (1 + 0.015 * c("__cm") * t),
        "__r": -2 * seven(c("__cm")) * F.sin(F.radians(60 * F.exp(-F.pow((c("__hm") - 275) / 25, F.lit(2.0))))),
    })
    square = c("__x") * c("__x") + c("__y") * c("__y") + c("__z") * c("__z") + c("__r") * c("__y") * c("__z")
    keep = [x for x in df.columns if not x.startswith("__")]
    return df.select(*keep, F.explode(F.array(F.sqrt(F.greatest(square, F.lit(0.0))))).alias(out))


def tier(delta_e: Column, close: float = 5.0) -> Column:
    """By the distance before rounding."""
    return F.when(delta_e <= close, F.lit("close")).otherwise(F.lit("substitute"))


def rounded(delta_e: Column) -> Column:
    """Two decimals, halves to even."""
    return F.bround(delta_e, 2)


def rgb_distance(one: tuple[Column, Column, Column], two: tuple[Column, Column, Column]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(one, two, strict=True)), F.lit(0)))
