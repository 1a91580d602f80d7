"""Tail probabilities that Spark has no function for, as pandas UDFs over small score tables."""

from __future__ import annotations

from pyspark.sql import functions as F


def chi2_sf():
    """P(X > x) of the chi-square distribution with integer degrees of freedom."""

    @F.pandas_udf("double")
    def tail(x, df):
        import math

        import pandas as pd

        def one(x, k):
            if x is None or k is None or math.isnan(x):
                return None
            if x <= 0:
                return 1.0
            half, k = x / 2, int(k)
            if k % 2 == 0:
                total, term, steps = 1.0, 1.0, [j for j in range(1, k // 2)]
                for j in steps:
                    term *= half / j
                    total += term
                return math.exp(-half) * total
            total, term = 0.0, math.sqrt(half) / math.gamma(1.5)
            for j in range(k // 2):
                total += term
                term *= half / (j + 1.5)
            return math.erfc(math.sqrt(half)) + math.exp(-half) * total

        return pd.Series([one(a, b) for a, b in zip(x, df)], dtype="float64")

    return tail


def range_sf():
    """P(Q > q) of the studentized range of k groups at infinite degrees of freedom.

    1 - k * integral of pdf(z) * (cdf(z) - cdf(z - q))^(k - 1), by Simpson's rule.
    """

    @F.pandas_udf("double")
    def tail(q, k):
        import math

        import numpy as np
        import pandas as pd

        z = np.linspace(-9.0, 9.0 + 9.0, 3601)
        h = z[1] - z[0]
        weights = np.where(np.arange(len(z)) % 2 == 1, 4.0, 2.0)
        weights[0] = weights[-1] = 1.0
        erf = np.vectorize(math.erf)
        pdf = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        cdf = 0.5 * (1 + erf(z / math.sqrt(2)))

        def one(q, k):
            if q is None or math.isnan(q):
                return None
            if q <= 0:
                return 1.0
            shifted = 0.5 * (1 + erf((z - q) / math.sqrt(2)))
            inside = k * h / 3 * float(np.sum(weights * pdf * (cdf - shifted) ** (k - 1)))
            return min(1.0, max(0.0, 1.0 - inside))

        return pd.Series([one(a, int(b)) for a, b in zip(q, k)], dtype="float64")

    return tail
