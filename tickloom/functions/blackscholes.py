"""Black-Scholes price, implied volatility and Greeks on numpy arrays."""
from __future__ import annotations

import numpy as np

# Rational approximation of the normal distribution (Hart 1968, double precision).
P = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
     221.213596169931, 220.206867912376]
Q = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
     637.333633378831, 793.826512519948, 440.413735824752]


def norm_cdf(x: np.ndarray) -> np.ndarray:
    a = np.abs(x)
    density = np.exp(-0.5 * a * a)
    near = density * np.polyval(P, a) / np.polyval(Q, a)
    tail = a + 0.65
    for k in (4, 3, 2, 1):
        tail = a + k / tail
    far = density / tail / 2.506628274631
    upper = np.where(a < 7.07106781186547, near, far)
    return np.where(x > 0, 1.0 - upper, upper)


def norm_pdf(x: np.ndarray) -> np.ndarray:
    return np.exp(-0.5 * x * x) / np.sqrt(2 * np.pi)


def price(call, s, k, t, r, sigma):
    d1 = (np.log(s / k) + (r + 0.5 * sigma**2) * t) / (sigma * np.sqrt(t))
    d2 = d1 - sigma * np.sqrt(t)
    c = s * norm_cdf(d1) - k * np.exp(-r * t) * norm_cdf(d2)
    return np.where(call, c, c - s + k * np.exp(-r * t))


def implied_vol(call, p, s, k, t, r, lo=1e-4, hi=5.0, steps=60):
    """Bisection over all rows at once; NaN where no volatility between `lo` and `hi` gives the price."""
    with np.errstate(all="ignore"):
        a, b = np.full(p.shape, lo), np.full(p.shape, hi)
        known = (s > 0) & (k > 0) & (t > 0) & (p > 0)
        known &= (price(call, s, k, t, r, a) <= p) & (price(call, s, k, t, r, b) >= p)
        for _ in range(steps):
            mid = 0.5 * (a + b)
            low = price(call, s, k, t, r, mid) < p
            a, b = np.where(low, mid, a), np.where(low, b, mid)
        return np.where(known, 0.5 * (a + b), np.nan)


def greeks(call, s, k, t, r, sigma):
    """Delta, gamma, vega (per unit of volatility) and theta (per year)."""
    with np.errstate(all="ignore"):
        root = sigma * np.sqrt(t)
        d1 = (np.log(s / k) + (r + 0.5 * sigma**2) * t) / root
        d2 = d1 - root
        pdf, disc = norm_pdf(d1), k * np.exp(-r * t)
        delta = np.where(call, norm_cdf(d1), norm_cdf(d1) - 1.0)
        gamma = pdf / (s * root)
        vega = s * pdf * np.sqrt(t)
        decay = -s * pdf * sigma / (2 * np.sqrt(t))
        theta = np.where(call, decay - r * disc * norm_cdf(d2), decay + r * disc * norm_cdf(-d2))
        return delta, gamma, vega, theta
