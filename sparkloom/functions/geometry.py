"""Boxes, image sizes, sampling of frames, and other arithmetic on plain numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box_distance(a: Column, b: Column) -> Column:
    """Distance of two boxes [x0, y0, x1, y1]; 0 if they overlap."""
    dx = F.greatest(F.lit(0.0), b[0] - a[2], a[0] - b[2])
    dy = F.greatest(F.lit(0.0), b[1] - a[3], a[1] - b[3])
    return F.sqrt(dx * dx + dy * dy)


def box_width(box: Column) -> Column:
    return F.abs(box[2] - box[0])


def box_height(box: Column) -> Column:
    return F.abs(box[3] - box[1])


def padded_box(box: Column, width: Column, height: Column, pad: int = 5) -> Column:
    """The box grown by ``pad`` and clamped to the image."""
    zero = F.lit(0.0)
    return F.array(F.greatest(zero, box[0] - pad), F.greatest(zero, box[1] - pad), F.least(width.cast("double"), box[2] + pad), F.least(height.cast("double"), box[3] + pad))


def long_side_size(width: Column, height: Column, longest: int) -> Column:
    """struct<width, height> scaled down to a longest side, truncated; never scaled up."""
    scale = F.lit(float(longest)) / F.greatest(width, height)
    big = F.greatest(width, height) > longest
    return F.struct(
        F.when(big, (width * scale).cast("int")).otherwise(width.cast("int")).alias("width"),
        F.when(big, (height * scale).cast("int")).otherwise(height.cast("int")).alias("height"),
    )


def longest_dim_size(width: Column, height: Column, longest: int) -> Column:
    """The same with scaling up: the longer side becomes exactly ``longest``."""
    wide = width > height
    return F.struct(
        F.when(wide, F.lit(longest)).otherwise((width * (F.lit(float(longest)) / height)).cast("int")).alias("width"),
        F.when(wide, (height * (F.lit(float(longest)) / width)).cast("int")).otherwise(F.lit(longest)).alias("height"),
    )


def margin_crop(width: Column, height: Column, percent: float) -> Column:
    """Box left after a margin of ``percent`` of each side."""
    mx, my = (width * (percent / 100)).cast("int"), (height * (percent / 100)).cast("int")
    return F.array(mx, my, width.cast("int") - mx, height.cast("int") - my)


def rotated_size(width: Column, height: Column, rotation: Column) -> Column:
    """Size after rotation by 0, 90, 180 or 270 degrees; null for any other angle."""
    turned = rotation.isin(90, 270)
    size = F.struct(F.when(turned, height).otherwise(width).alias("width"), F.when(turned, width).otherwise(height).alias("height"))
    return F.when(rotation.isin(0, 90, 180, 270), size)


def tight_box(points: Column, width: Column, height: Column, pad: Column) -> Column:
    """Box around points [x, y] grown by ``pad`` (at most 20) and clamped to the image."""
    xs, ys, pad = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1]), F.least(pad, F.lit(20))
    return F.array(
        F.greatest(F.lit(0.0), F.array_min(xs) - pad), F.greatest(F.lit(0.0), F.array_min(ys) - pad), F.least(width.cast("double"), F.array_max(xs) + pad), F.least(height.cast("double"), F.array_max(ys) + pad)
    )


def rescaled_to_unit(value: Column, low: Column, high: Column) -> Column:
    """Affine map of [low, high] to [-1, 1]."""
    return (value - low) / (high - low) * 2 - 1


def frame_indices(total: Column, wanted: Column) -> Column:
    """Evenly spaced frame numbers from first to last, truncated; all frames if there are no more than wanted."""
    even = F.transform(F.sequence(F.lit(0), wanted - 1), lambda i: F.floor(i * (total - 1) / F.greatest(wanted - 1, F.lit(1))).cast("int"))
    return F.when((wanted <= 0) | (total <= 0), F.array().cast("array<int>")).when(total <= wanted, F.sequence(F.lit(0), total.cast("int") - 1)).otherwise(even)


def batch_number(row_number: Column, size: int) -> Column:
    """Number from 0 of the fixed-size batch of a row numbered from 1."""
    return F.floor((row_number - 1) / size).cast("long")


def batch_count(rows: Column, size: int) -> Column:
    return F.ceil(rows / size).cast("long")


def one_two_five(most: int) -> list[int]:
    """1, 2, 5, 10, 20, 50 ... up to ``most``."""
    return [m * 10**e for e in range(len(str(most))) for m in (1, 2, 5) if m * 10**e <= most]


def stamps(clock: Column) -> Column:
    """struct of the three date spellings in use."""
    return F.struct(F.date_format(clock, "yyyy.MM.dd").alias("day"), F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.date_format(clock, "yyyyMMddHHmmss").alias("compact"))
