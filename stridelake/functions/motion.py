"""Sample arithmetic: named features, magnitudes, scaling and histogram bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from stridelake.settings import HISTOGRAM_BINS, HISTOGRAM_MAX_VELOCITY, MOVEMENT_THRESHOLD


def feature(sample: Column, name: str, known: Sequence[str], default: float = 0.0) -> Column:
    """A named field of a sample, or the default where it is null or not a known name."""
    if name not in known:
        return F.lit(default)
    return F.coalesce(sample[name], F.lit(default))


def magnitude(*axes: Column) -> Column:
    squares = [F.coalesce(axis, F.lit(0.0)) * F.coalesce(axis, F.lit(0.0)) for axis in axes]
    total = squares[0]
    for square in squares[1:]:
        total = total + square
    return F.sqrt(total)


def scaled(value: Column, mean: float = 0.0, std: float = 1.0) -> Column:
    return (F.coalesce(value, F.lit(0.0)) - F.lit(mean)) / F.lit(std)


def scaled_columns(columns: Sequence[str], means: Mapping[str, float], stds: Mapping[str, float]) -> dict[str, Column]:
    return {c: scaled(F.col(c), means.get(c, 0.0), stds.get(c, 1.0)) for c in columns}


def masked_velocity(velocity: Column, movement_prob: Column, threshold: float = MOVEMENT_THRESHOLD) -> Column:
    return F.when(movement_prob < threshold, F.lit(0.0)).otherwise(velocity)


def histogram_bin(velocity: Column, top: float = HISTOGRAM_MAX_VELOCITY, bins: int = HISTOGRAM_BINS) -> Column:
    """Bin number from 0; speeds outside the range go to the outer bins."""
    raw = F.floor(velocity / F.lit(top / bins))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), raw)).cast("int")


def coerced_number(text: Column) -> Column:
    """A double, or 0.0 where the text is no number."""
    return F.nanvl(F.coalesce(text.try_cast("double"), F.lit(0.0)), F.lit(0.0))


# Fixed value: the longest leading number of a text, as browsers read it.
LEADING_NUMBER = r"^\s*([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))"


def leading_number(text: Column) -> Column:
    """The number a text starts with, or null."""
    return F.regexp_extract(text.cast("string"), LEADING_NUMBER, 1).try_cast("double")
