"""Kinematics: quality gates and frame transforms as columns, the sampler and its summaries by object."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distance of the centre and height of the Sun in kpc, the Sun's velocity in km/s, km/s of 1 mas/yr at 1 kpc.
R0, Z_SUN, V_SUN, K = 8.122, 0.0208, (11.1, 245.0, 7.25), 4.740470463533349
#: Rows of the rotation from equatorial to Galactic axes.
ROTATION = ((-0.0548755604162154, -0.8734370902348850, -0.4838350155487132), (0.4941094278755837, -0.4448296299600112, 0.7469822444972189), (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669))
LEAST_RATIO = 5.0
#: What the sampler draws, in the order of the covariance, and how many objects it draws side by side.
FIELDS = ("parallax", "pmra", "pmdec", "radial_velocity")
GROUP = 64


def gate(parallax: Column, error: Column, zero_point: Column) -> Column:
    """Reason to skip, or null: missing values, bad error, missing zero point, corrected parallax at most 5 times its error."""
    return (
        F.when(parallax.isNull() | error.isNull(), "gaia astrometry not available")
        .when(error <= 0, "gaia astrometry not available")
        .when(zero_point.isNull(), "zero point correction not available")
        .when((parallax - zero_point) / error <= LEAST_RATIO, "parallax uncertainty too large")
    )


def covariance(errors: list[Column], correlations: dict[tuple[int, int], Column]) -> list[list[Column]]:
    """C[i][j] = rho * error_i * error_j; a missing correlation counts as 0."""
    n = len(errors)
    rho = lambda i, j: F.lit(1.0) if i == j else F.coalesce(correlations.get((min(i, j), max(i, j)), F.lit(0.0)), F.lit(0.0))
    return [[rho(i, j) * errors[i] * errors[j] for j in range(n)] for i in range(n)]


def velocity(ra: Column, dec: Column, distance: Column, pm_ra: Column, pm_dec: Column, rv: Column) -> list[Column]:
    """Galactocentric velocity in km/s, axes towards the centre, along rotation and to the pole."""
    a, d = F.radians(ra), F.radians(dec)
    ta, td = pm_ra * distance * K, pm_dec * distance * K
    eq = (
        rv * F.cos(d) * F.cos(a) - ta * F.sin(a) - td * F.sin(d) * F.cos(a),
        rv * F.cos(d) * F.sin(a) + ta * F.cos(a) - td * F.sin(d) * F.sin(a),
        rv * F.sin(d) + td * F.cos(d),
    )
    return [sum((F.lit(m) * x for m, x in zip(row, eq)), F.lit(s)) for row, s in zip(ROTATION, V_SUN)]


def speed(v: list[Column]) -> Column:
    return F.sqrt(sum((x * x for x in v), F.lit(0.0)))


def slowest_rv(ra: Column, dec: Column, distance: Column, pm_ra: Column, pm_dec: Column) -> Column:
    """The radial velocity of least Galactocentric speed: minus the velocity at none along the line of sight."""
    v0 = velocity(ra, dec, distance, pm_ra, pm_dec, F.lit(0.0))
    a, d = F.radians(ra), F.radians(dec)
    n = (F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d))
    along = [sum((F.lit(m) * x for m, x in zip(row, n)), F.lit(0.0)) for row in ROTATION]
    return -sum((p * q for p, q in zip(along, v0)), F.lit(0.0))


def jeffreys(hits: Column, total: Column) -> tuple[Column, Column, Column]:
    """alpha, beta and mean of the Beta posterior of a share."""
    a, b = hits + 0.5, total - hits + 0.5
    return a, b, a / (a + b)


def beta_quantiles(hits: Column, total: Column) -> Column:
    """struct<p16, median, p84> of the Beta posterior of a share, by bisection on the incomplete beta function."""

    @F.pandas_udf("p16 double, median double, p84 double")
    def quantiles(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({n: beta_quantile(q, a.to_numpy(float), b.to_numpy(float)) for n, q in (("p16", 0.16), ("median", 0.5), ("p84", 0.84))})

    a, b, _ = jeffreys(hits, total)
    return quantiles(a.cast("double"), b.cast("double"))


def beta_share(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function, by its continued fraction on the side where that converges fast."""
    swap = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
    gamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(gamma(a + b) - gamma(a) - gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    c, d = np.ones_like(x), 1 / np.where(np.abs(1 - (a + b) * x / (a + 1)) < 1e-300, 1e-300, 1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            c = 1 + top / c
            d, c = np.where(np.abs(d) < 1e-300, 1e-300, d), np.where(np.abs(c) < 1e-300, 1e-300, c)
            d = 1 / d
            value = value * d * c
    out = np.where(x <= 0, 0.0, front * value)
    return np.where(swap, 1 - out, out)


def beta_quantile(q: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low, high = np.zeros_like(a), np.ones_like(a)
    for _ in range(60):
        middle = (low + high) / 2
        below = beta_share(middle, a, b) < q
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return np.round((low + high) / 2, 12)


def astrometry_error(row: dict[str, Column]) -> Column:
    """The first thing wrong with a row of astrometry, or an empty text: fields that are missing, then errors that are not positive."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    out = F.lit("")
    for f in reversed(("parallax_error", "pmra_error", "pmdec_error")):
        out = F.when(~F.coalesce(row[f] > 0, F.lit(False)), f"missing or non-positive uncertainty: {f}").otherwise(out)
    for f in reversed(REQUIRED):
        out = F.when(~F.coalesce(finite(row[f]), F.lit(False)), f"missing or invalid field: {f}").otherwise(out)
    return out


#: Fields that every row of astrometry needs; solutions of five and six parameters.
REQUIRED = ("ra", "dec", "parallax", "parallax_error", "pmra", "pmdec", "pmra_error", "pmdec_error")
FIVE, SIX = 31, 95


def corrected_parallax(row: dict[str, Column], zero_point: Column) -> Column:
    """struct<parallax, zero_point, error>: the parallax less its zero point, or one of the reasons why there is none.

    The zero point is a column of the caller's, as its calibration tables are data; null stands for a calibration that failed.
    """
    missing = [f for f in ("phot_g_mean_mag", "ecl_lat", "astrometric_params_solved", "parallax", "nu_eff_used_in_astrometry", "pseudocolour") if f not in row]
    none = F.lit(None).cast("double")
    if missing:
        return F.struct(none.alias("parallax"), none.alias("zero_point"), F.lit(f"missing zero-point columns: {', '.join(missing)}").alias("error"))
    solved = F.floor(row["astrometric_params_solved"])
    base = row["phot_g_mean_mag"].isNull() | row["ecl_lat"].isNull() | solved.isNull() | row["parallax"].isNull()
    error = (
        F.when(base, "missing required zero-point values")
        .when((solved == FIVE) & row["nu_eff_used_in_astrometry"].isNull(), "missing nu_eff_used_in_astrometry for a five-parameter solution")
        .when((solved == SIX) & row["pseudocolour"].isNull(), "missing pseudocolour for a six-parameter solution")
        .when(~solved.isin(FIVE, SIX), F.concat(F.lit("unsupported solution: "), solved.cast("string")))
        .when(zero_point.isNull(), "the calibration failed")
        .when(F.isnan(zero_point) | (F.abs(zero_point) == float("inf")), "the zero point is not finite")
        .otherwise("")
    )
    ok = error == ""
    return F.struct(F.when(ok, row["parallax"] - zero_point).alias("parallax"), F.when(ok, zero_point).alias("zero_point"), error.alias("error"))


def grid_axis(low: Column, high: Column, points: int = 5) -> Column:
    """Evenly spaced points over a range with a twentieth of it on either side; a range from none below zero stays there; without
    a range the axis is 0 to 1."""
    span = high - low
    pad = F.when(span <= 0, F.greatest(F.abs(low) * 1e-6, F.lit(1e-4))).otherwise(F.greatest(span * 0.05, F.lit(1e-4)))
    a = F.when((low >= 0) & (low - pad < 0), 0.0).otherwise(low - pad)
    z = high + pad
    known = low.isNotNull() & high.isNotNull()
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.when(known, a + (z - a) * i / (points - 1)).otherwise(i / F.lit(float(points - 1))))


def log_prior(distance: np.ndarray, alpha: np.ndarray, beta: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Log of the generalised gamma density of a distance."""
    return -((distance / length) ** alpha) + beta * np.log(distance) + np.log(alpha) - (beta + 1) * np.log(length) - np.vectorize(math.lgamma, otypes=[float])((beta + 1) / alpha)


def stretch_sampler(log_density: Callable[[np.ndarray], np.ndarray], start: np.ndarray, n: int, burn: int, rngs: list[np.random.Generator]) -> np.ndarray:
    """Affine-invariant ensemble sampling (stretch moves, both halves in turn) of many objects side by side: n draws each after
    `burn` steps, from start (objects, walkers, dimensions). Each object has its own generator, so its draws don't depend on the others."""
    count, walkers, dim = start.shape
    half, steps = walkers // 2, burn + -(-n // walkers)
    z = np.stack([(r.random((steps, 2, half)) + 1) ** 2 / 2 for r in rngs], 2)
    pick = np.stack([r.integers(half, size=(steps, 2, half)) for r in rngs], 2)
    luck = np.stack([np.log(r.random((steps, 2, half))) for r in rngs], 2)
    x, lp, kept, at = start.copy(), log_density(start), [], np.arange(count)[:, None]
    for step in range(steps):
        for side in (0, 1):
            own, other = slice(side * half, side * half + half), slice(half - side * half, walkers - side * half)
            a, b, zs = x[:, own], x[:, other][at, pick[step, side]], z[step, side]
            new = b + zs[..., None] * (a - b)
            lq = log_density(new)
            go = luck[step, side] < (dim - 1) * np.log(zs) + lq - lp[:, own]
            x[:, own] = np.where(go[..., None], new, a)
            lp[:, own] = np.where(go, lq, lp[:, own])
        if step >= burn:
            kept.append(x.copy())
    return np.concatenate(kept, 1)[:, :n]


def astrometry(objects: DataFrame) -> DataFrame:
    """object_id, alpha, beta, length, ra, dec, the values of FIELDS and their covariance as 16 numbers; what objects lack is null.

    Errors are in `<field>_error`, correlations in `parallax_pmra_corr`, `parallax_pmdec_corr` and `pmra_pmdec_corr`. Rows are
    dealt out by id: a small file holds hours of sampling.
    """
    get = lambda name: (F.col(name) if name in objects.columns else F.lit(None)).cast("double")
    cov = covariance([get(f"{f}_error") for f in FIELDS], {(i, j): get(f"{FIELDS[i]}_{FIELDS[j]}_corr") for i in range(3) for j in range(i + 1, 3)})
    spark = objects.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ("alpha", "beta", "length", "ra", "dec", *FIELDS)
    return objects.select(F.col("object_id").cast("string").alias("object_id"), *(get(n).alias(n) for n in names), F.array(*(x for row in cov for x in row)).alias("cov")).repartition(parts, "object_id")


def sampled(pdf: pd.DataFrame, samples: int, burn: int, seed: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Groups of rows of astrometry() with their draws (rows, samples, FIELDS) under prior and full covariance.

    A field without a positive error is held at its value; one without a value is NaN.
    """
    cov = np.array([[math.nan if v is None else v for v in c] for c in pdf["cov"]], float).reshape(-1, 4, 4)
    value = pdf[list(FIELDS)].to_numpy(float)
    free = (np.diagonal(cov, axis1=1, axis2=2) > 0) & ~np.isnan(value)
    code = free @ (1 << np.arange(4))
    for kind in np.unique(code):
        rows = np.flatnonzero(code == kind)
        for group in (rows[i : i + GROUP] for i in range(0, len(rows), GROUP)):
            some = pdf.iloc[group]
            out = np.repeat(value[group][:, None], samples, 1)
            if kind & 1:  # the prior is one of the parallax
                on = np.flatnonzero(free[group[0]])
                mu, c = value[group][:, on], cov[group][:, on][:, :, on]
                singular = np.linalg.matrix_rank(c) < len(on)
                inverse = np.linalg.inv(c + singular[:, None, None] * 1e-12 * np.eye(len(on)))
                alpha, beta, length = (some[n].to_numpy(float)[:, None] for n in ("alpha", "beta", "length"))

                def density(x):
                    p, diff = x[..., 0], x - mu[:, None]
                    ok = p > 0
                    safe = np.where(ok, p, 1.0)
                    return np.where(ok, log_prior(1 / safe, alpha, beta, length) - 0.5 * ((diff @ inverse) * diff).sum(-1), -np.inf)

                rngs = [np.random.default_rng([seed, zlib.crc32(str(i).encode())]) for i in some["object_id"]]
                error = np.sqrt(np.diagonal(c, axis1=1, axis2=2))
                scale = np.maximum(np.abs(mu) * 3e-3, np.maximum(error, 1e-6) * 0.05)
                start = mu[:, None] + scale[:, None] * np.stack([r.standard_normal((16, len(on))) for r in rngs])
                start[..., 0] = np.maximum(start[..., 0], error[:, :1] * 0.1)
                out[:, :, on] = stretch_sampler(density, start, samples, burn, rngs)
            yield some, out


def speeds(ra: np.ndarray, dec: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Galactocentric speed in km/s of draws (objects, samples, FIELDS); without a radial velocity the least one that is possible."""
    a, d = np.radians(ra)[:, None], np.radians(dec)[:, None]
    ta, td = x[..., 1] / x[..., 0] * K, x[..., 2] / x[..., 0] * K
    axes = np.array(ROTATION)
    n = axes @ np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d) + 0 * a])[..., 0]
    v = np.tensordot(axes, np.stack([-ta * np.sin(a) - td * np.sin(d) * np.cos(a), ta * np.cos(a) - td * np.sin(d) * np.sin(a), td * np.cos(d)]), 1) + np.array(V_SUN)[:, None, None]
    along = (n[..., None] * v).sum(0)
    v = v + n[..., None] * np.where(np.isnan(x[..., 3]), -along, x[..., 3])
    return np.sqrt((v * v).sum(0))


def draws(objects: DataFrame, samples: int = 10_000, burn: int = 500, seed: int = 42) -> DataFrame:
    """object_id and the draws of parallax, pmra, pmdec and radial_velocity, an array each, in step. Input as for posterior()."""

    def run(batches):
        for pdf in batches:
            for some, x in sampled(pdf, samples, burn, seed):
                known = ~np.isnan(x[:, 0])
                yield pd.DataFrame({"object_id": some["object_id"].to_numpy()} | {f: [v if k else None for v, k in zip(x[:, :, i], known[:, i])] for i, f in enumerate(FIELDS)})

    return astrometry(objects).mapInPandas(run, ", ".join(["object_id string", *(f"{f} array<double>" for f in FIELDS)]))


def posterior(objects: DataFrame, samples: int = 10_000, burn: int = 500, seed: int = 42) -> DataFrame:
    """16th, 50th and 84th percentiles of the distance (kpc: p16, median, p84), of pmra, pmdec and radial_velocity and of the
    Galactocentric speed of each object (object_id, parallax, parallax_error, alpha, beta, length) under its prior and normal errors.

    Proper motions, radial velocity, correlations, ra and dec are used where they are there, named as in astrometry(); a percentile
    of what is missing is null. Without a radial velocity the speed is a lower limit. Each object is sampled on its own with its
    own seed; only rows that passed the gate should come here."""
    names = ["p16", "median", "p84", *(f"{f}_{q}" for f in (*FIELDS[1:], "speed") for q in ("p16", "median", "p84"))]

    def run(batches):
        for pdf in batches:
            for some, x in sampled(pdf, samples, burn, seed):
                v = speeds(some["ra"].to_numpy(float), some["dec"].to_numpy(float), x)
                stack = np.concatenate([1 / x[..., :1], x[..., 1:], v[..., None]], 2)
                q = np.percentile(stack, (16, 50, 84), axis=1).transpose(1, 2, 0).reshape(len(some), -1)
                out = pd.DataFrame(q, columns=names).astype(object).where(~np.isnan(q), None)
                out.insert(0, "object_id", some["object_id"].to_numpy())
                yield out

    return astrometry(objects).mapInPandas(run, ", ".join(["object_id string", *(f"{n} double" for n in names)]))
