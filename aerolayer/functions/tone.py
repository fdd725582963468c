"""Pixel kernels that need no neighbours (Column expressions)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ToneMap:
    """The default tone curve and the scale of digital numbers."""

    maximum: float = 3.0
    middle: float = 0.13
    gamma: float = 1.8
    offset: float = 0.01
    saturation: float = 1.15
    scale: float = 10000.0


def unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def stretch(band: Column, t: ToneMap = ToneMap()) -> Column:  # noqa: B008
    """Sigmoid contrast of a reflectance, then gamma with an offset."""
    return gamma(contrast(unit(band / F.lit(t.scale) / F.lit(t.maximum)), t.middle / t.maximum, 1.0), t)


def contrast(c: Column, middle: float, top: float) -> Column:
    """The rational curve through 0, (middle, 1/2) and 1 in units of the maximum."""
    return c * (c * F.lit(middle + top - 1) - F.lit(top)) / (c * F.lit(2 * middle - 1) - F.lit(middle))


def gamma(c: Column, t: ToneMap) -> Column:
    low = t.offset**t.gamma
    return (F.pow(c + F.lit(t.offset), F.lit(t.gamma)) - F.lit(low)) / F.lit((1 + t.offset) ** t.gamma - low)


def srgb(c: Column) -> Column:
    return F.when(c <= 0.0031308, c * 12.92).otherwise(F.lit(1.055) * F.pow(c, F.lit(1 / 2.4)) - 0.055)


def true_color(r: Column, g: Column, b: Column, t: ToneMap = ToneMap()) -> Column:  # noqa: B008
    """struct(r, g, b, a) of digital numbers: 0 to 255, truncated; alpha 255 where any number is not 0."""
    bands = [stretch(x.cast("double"), t) for x in (r, g, b)]
    base = (bands[0] + bands[1] + bands[2]) / 3.0 * F.lit(1 - t.saturation)
    out = [F.least(F.lit(255.0), F.greatest(F.lit(0.0), srgb(unit(base + x * F.lit(t.saturation))) * 255.0)).cast("int") for x in bands]
    alpha = F.when((r != 0) | (g != 0) | (b != 0), 255).otherwise(0)
    return F.struct(out[0].alias("r"), out[1].alias("g"), out[2].alias("b"), alpha.alias("a"))


def threshold(v: Column, least: float) -> Column:
    """0 below ``least`` and for negatives; what is left rounded up, from 1 to 255."""
    return F.when((v < F.lit(least)) | (v <= 0) | F.isnan(v), 0).otherwise(F.least(F.greatest(F.ceil(v), F.lit(1)), F.lit(255)).cast("int"))


def luminance_alpha(v: Column) -> Column:
    return F.struct(v.alias("l"), F.when(v > 0, 255).otherwise(0).alias("a"))


def rgba(v: Column) -> Column:
    return F.struct(v.alias("r"), v.alias("g"), v.alias("b"), F.when(v > 0, 255).otherwise(0).alias("a"))


def palette_color(palette: Column, index: Column) -> Column:
    """array(r, g, b, a) of map index to array of 3 or 4 channels; alpha 255 by default, missing colours 0."""
    c = F.try_element_at(palette, index)
    at = lambda i, d: F.coalesce(F.try_element_at(c, F.lit(i)), F.lit(d))
    return F.when(c.isNull(), F.array(*[F.lit(0)] * 3, F.lit(0))).otherwise(F.array(at(1, 0), at(2, 0), at(3, 0), at(4, 255)))


def palette_valid(palette: Column) -> Column:
    """Whether indexes are 0 to 255 and colours 3 or 4 channels of 0 to 255."""
    channel = lambda v: v.isNotNull() & (v >= 0) & (v <= 255)
    return F.forall(F.map_entries(palette), lambda e: (e["key"] >= 0) & (e["key"] <= 255) & F.size(e["value"]).isin(3, 4) & F.forall(e["value"], channel))


def is_background(pixel: Column, background: Column, tolerance: int = 0) -> Column:
    """Whether an index equals the background's, or the channels of an array differ from it by ``tolerance`` in sum."""
    if tolerance < 0:
        return pixel == background
    apart = F.aggregate(F.zip_with(pixel, background, lambda a, b: F.abs(a - b)), F.lit(0), lambda s, v: s + v.cast("int"))
    return apart <= tolerance
