"""Tail probabilities and quantiles of the usual test distributions.

Plain NumPy on arrays; used on results of one row per test, and wrapped as
Arrow UDFs for columns of statistics. Series and continued fractions are the
textbook forms of the incomplete gamma and beta functions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def normal_sf(z):
    return 0.5 * _erfc(np.asarray(z, float) / math.sqrt(2))


def normal_cdf(z):
    return 0.5 * _erfc(-np.asarray(z, float) / math.sqrt(2))


def normal_ppf(p):
    """Inverse by Newton steps on the error function, from a rational start."""
    from statistics import NormalDist

    return np.vectorize(NormalDist().inv_cdf, otypes=[float])(np.asarray(p, float))


def beta_cdf(a, b, x):
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    x = np.clip(x, 0.0, 1.0)
    swap = x > (a + 1) / (a + b + 2)
    aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(_lgamma(aa + bb) - _lgamma(aa) - _lgamma(bb) + aa * np.log(xx) + bb * np.log1p(-xx)) / aa
    tiny = 1e-300
    guard = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c = np.ones_like(xx)
    d = 1 / guard(1 - (aa + bb) * xx / (aa + 1))
    h = d.copy()
    for m in range(1, 500):
        for num in (m * (bb - m) * xx / ((aa + 2 * m - 1) * (aa + 2 * m)),
                    -(aa + m) * (aa + bb + m) * xx / ((aa + 2 * m) * (aa + 2 * m + 1))):
            d = 1 / guard(1 + num * d)
            c = guard(1 + num / c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    val = np.where(xx <= 0, 0.0, front * h)
    return np.where(swap, 1 - val, val)


def gamma_sf(a, x):
    """Regularised upper incomplete gamma Q(a, x)."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.ones_like(x)
    for i in np.ndindex(x.shape):
        av, xv = float(a[i]), float(x[i])
        if not xv > 0:
            continue
        lead = math.exp(-xv + av * math.log(xv) - math.lgamma(av))
        if xv < av + 1:
            term = total = 1 / av
            k = av
            while abs(term) > abs(total) * 1e-16:
                k += 1
                term *= xv / k
                total += term
            out[i] = 1 - total * lead
        else:
            b = xv + 1 - av
            c, d = 1e300, 1 / b
            h = d
            for n in range(1, 1000):
                an = -n * (n - av)
                b += 2
                d = 1 / (an * d + b or 1e-300)
                c = b + an / c or 1e-300
                h *= d * c
                if abs(d * c - 1) < 1e-15:
                    break
            out[i] = lead * h
    return out


def t_sf2(t, df):
    """Two-sided p-value of Student's t."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    return beta_cdf(df / 2, 0.5, df / (df + t * t))


def f_sf(f, d1, d2):
    f, d1, d2 = (np.asarray(v, float) for v in (f, d1, d2))
    return beta_cdf(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def chi2_sf(x, df):
    return gamma_sf(np.asarray(df, float) / 2, np.asarray(x, float) / 2)


def t_ppf(p, df):
    """Quantile of Student's t by bisection (used for confidence intervals)."""
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        two = float(t_sf2(mid, df))
        cdf = 1 - two / 2 if mid > 0 else two / 2
        lo, hi = (mid, hi) if cdf < p else (lo, mid)
    return (lo + hi) / 2


def kolmogorov_sf(x):
    """Asymptotic Kolmogorov tail."""
    x = np.atleast_1d(np.asarray(x, float))
    k = np.arange(1, 101)
    s = 2 * np.sum((-1.0) ** (k - 1) * np.exp(-2 * np.outer(x * x, k * k)), axis=1)
    return np.where(x < 0.2, 1.0, np.clip(s, 0, 1))


def _series(values, like):
    return pd.Series(np.asarray(values, float), index=like.index)


def t_pvalue(t, df):
    @F.pandas_udf("double")
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        return _series(t_sf2(a, b), a)

    return udf(t, df)


def f_pvalue(f, d1, d2):
    @F.pandas_udf("double")
    def udf(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return _series(f_sf(a, b, c), a)

    return udf(f, d1, d2)


def chi2_pvalue(x, df):
    @F.pandas_udf("double")
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        return _series(chi2_sf(a, b), a)

    return udf(x, df)


def kolmogorov_pvalue(x):
    @F.pandas_udf("double")
    def udf(a: pd.Series) -> pd.Series:
        return _series(kolmogorov_sf(a), a)

    return udf(x)


# Hart's rational form of the normal tail below 5 * sqrt(2), highest power first.
HART_ABOVE = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376]
HART_BELOW = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
              440.413735824752]
HART_LIMIT, ROOT_2PI = 7.07106781186547, 2.506628274631
# Wichura's algorithm AS 241 (PPND16), numerators and denominators of the middle, the tails and the far tails.
WICHURA = [
    ([2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4, 1.3731693765509461125e+4,
      1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0],
     [5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4, 5.3941960214247511077e+3,
      6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0]),
    ([7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0, 3.64784832476320460504e+0,
      5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0],
     [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1,
      1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0]),
    ([2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1,
      1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0],
     [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2,
      1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0]),
]


def _polynomial(coefficients, x):
    """Horner's rule over a column expression, or over its SQL text."""
    out = repr(coefficients[0]) if isinstance(x, str) else F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r})" if isinstance(x, str) else out * x + c
    return out


def normal_cdf_column(z):
    """Normal CDF as a column expression, exact to about 1e-15; null stays null."""
    z = z.cast("double")
    a = F.abs(z)
    e = F.exp(-a * a / 2)
    far = a + 0.65
    for k in (4, 3, 2, 1):
        far = a + k / far
    tail = F.when(a > 37, 0.0).when(a < HART_LIMIT, e * _polynomial(HART_ABOVE, a) / _polynomial(HART_BELOW, a)).otherwise(e / far / ROOT_2PI)
    return F.when(z > 0, 1 - tail).when(z.isNotNull(), tail)


def normal_ppf_column(p):
    """Normal quantile as a column expression, exact to about 1e-15; outside of (0, 1) null."""
    p = p.cast("double")
    q = p - 0.5
    ratio = lambda k, x: _polynomial(WICHURA[k][0], x) / _polynomial(WICHURA[k][1], x)
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.signum(q) * F.when(r <= 5, ratio(1, r - 1.6)).otherwise(ratio(2, r - 5))
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, q * ratio(0, 0.180625 - q * q)).otherwise(tail))


def normal_cdf_sql(z: str) -> str:
    """The text of ``normal_cdf_column`` for a column named ``z``."""
    a = f"abs({z})"
    far = f"({a} + 0.65)"
    for k in (4, 3, 2, 1):
        far = f"({a} + {k} / {far})"
    tail = (f"CASE WHEN {a} > 37 THEN 0 WHEN {a} < {HART_LIMIT} THEN exp(-{a} * {a} / 2) * {_polynomial(HART_ABOVE, a)} / {_polynomial(HART_BELOW, a)} "
            f"ELSE exp(-{a} * {a} / 2) / {far} / {ROOT_2PI} END")
    return f"(CASE WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END)"


def normal_ppf_sql(p: str) -> str:
    """The text of ``normal_ppf_column`` for a column named ``p``."""
    ratio = lambda k, x: f"{_polynomial(WICHURA[k][0], x)} / {_polynomial(WICHURA[k][1], x)}"
    q, r = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(0, f'(0.180625 - {q} * {q})')} WHEN {r} <= 5 THEN sign({q}) * {ratio(1, f'({r} - 1.6)')} "
            f"ELSE sign({q}) * {ratio(2, f'({r} - 5)')} END)")
