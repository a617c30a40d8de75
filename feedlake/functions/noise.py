"""Laplace mechanism as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(secret: str, *key: Column) -> Column:
    """A uniform draw in (-0.5, 0.5) fixed by a secret and the output row's key.

    52 bits of SHA-256 over secret and key. A retried task or a replayed
    micro-batch draws the same value, so a row is never published twice with
    different noise. The half step keeps the draw off both ends.
    """
    text = F.concat_ws("|", F.lit(secret), *[F.coalesce(k.cast("string"), F.lit("NULL")) for k in key])
    number = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double")
    return (number + 0.5) / F.lit(float(2**52)) - 0.5


def laplace_noise(sensitivity: float, epsilon: float, uniform: Column | None = None) -> Column:
    """Laplace(0, sensitivity/epsilon) by inverting the distribution function.

    Without ``uniform`` every evaluation draws afresh from an unseeded generator.
    """
    if sensitivity <= 0:
        raise ValueError("sensitivity must be positive")
    if epsilon <= 0:
        raise ValueError("epsilon must be positive")
    if uniform is None:
        # rand() may return exactly 0; the shrink keeps the logarithm finite
        uniform = (F.rand() - 0.5) * F.lit(1 - 2.0**-52)
    return F.lit(-sensitivity / epsilon) * F.signum(uniform) * F.log(1 - 2 * F.abs(uniform))


def add_laplace_noise(
    value: Column, sensitivity: float = 1.0, epsilon: float = 1.0, uniform: Column | None = None
) -> Column:
    """``value`` plus noise as DOUBLE, not rounded and possibly negative; NULL stays NULL."""
    return value.cast("double") + laplace_noise(sensitivity, epsilon, uniform)
