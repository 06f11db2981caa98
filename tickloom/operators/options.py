"""Order-book features, implied volatility and the volatility surface."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import blackscholes as bs
from ..plans.segments import running

GREEKS = ["iv", "delta", "gamma", "vega", "theta"]


def orderbook_features(quotes: DataFrame, interval: str = "1 minute") -> DataFrame:
    """Mean spread, mean size imbalance and summed depth per symbol and interval."""
    bid, ask = F.col("bid_size"), F.col("ask_size")
    return (
        quotes.groupBy("symbol", F.window("timestamp", interval).alias("w"))
        .agg(
            F.avg(F.col("ask_price") - F.col("bid_price")).alias("spread"),
            F.avg(F.try_divide((bid - ask).cast("double"), bid + ask)).alias("imbalance"),
            F.sum(bid.cast("long")).alias("bid_depth"),
            F.sum(ask.cast("long")).alias("ask_depth"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("symbol", F.col("w.start").alias("bucket"), "spread", "imbalance", "bid_depth", "ask_depth", "n")
    )


def implied_vol_greeks(df: DataFrame, rate: float = 0.03) -> DataFrame:
    """Implied volatility and Greeks per row of (side, price, underlying, strike, t_years).

    The solver runs on Arrow batches inside the tasks that hold the rows; no shuffle. Missing inputs give NULL.
    """
    schema = T.StructType([*df.schema.fields, *[T.StructField(g, T.DoubleType()) for g in GREEKS]])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            num = {c: pdf[c].to_numpy(dtype="float64", na_value=np.nan) for c in ("price", "underlying", "strike", "t_years")}
            call = (pdf["side"] == "CALL").to_numpy()
            p, s, k, t = num.values()
            vol = bs.implied_vol(call, p, s, k, t, rate)
            vol = np.where(pdf["side"].isin(["CALL", "PUT"]).to_numpy(), vol, np.nan)
            values = (vol, *bs.greeks(call, s, k, t, rate, vol))
            yield pdf.assign(**{g: pd.Series(v, index=pdf.index).astype("Float64") for g, v in zip(GREEKS, values)})

    out = df.mapInPandas(solve, schema)
    return out.withColumns({g: F.when(~F.isnan(g), F.col(g)) for g in GREEKS})


def iv_surface(known: DataFrame) -> DataFrame:
    """Volatility per (ymcode, ts, strike), linear between the nearest known strikes, NULL outside of them."""
    point = F.when(F.col("iv").isNotNull(), F.struct("strike", "iv"))
    near = running(
        known,
        ["ymcode", "ts"],
        ["strike"],
        F.floor(F.col("strike") / 1000).cast("long"),
        {"_lo": ("last", point), "_hi": ("next", point)},
    )
    share = F.try_divide((F.col("strike") - F.col("_lo.strike")).cast("double"), F.col("_hi.strike") - F.col("_lo.strike"))
    between = F.col("_lo.iv") + (F.col("_hi.iv") - F.col("_lo.iv")) * share
    return near.select("ymcode", "ts", "strike", F.coalesce("iv", between).alias("iv"), F.col("iv").isNull().alias("filled"))
