"""Exchange rates: priority over sources, carry-forward with an age limit, and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import currency_of, local_per_litre, positive, reciprocal, significant, usd_per_gallon, usd_per_litre
from ..schemas import FX
from .constants import CARRY_DAYS
from .grain import keep_first

CARRIED = "carried:"


def carry_forward(rates: DataFrame, capture_date, days: int = CARRY_DAYS) -> DataFrame:
    """Each currency's newest rate that wasn't itself carried, if its date is within ``days`` of the capture.

    The newest is chosen first and its age judged after: a currency whose newest rate is too old gets
    nothing, even if an earlier capture recorded a rate with a closer date.
    """
    own = rates.where(F.col("fx_source").isNotNull() & (F.col("fx_source") != "") & ~F.col("fx_source").startswith(CARRIED)).withColumn("currency", F.upper("currency"))
    row = [c for c in own.columns if c != "currency"]
    newest = own.groupBy("currency").agg(F.max_by(F.struct(*row), F.struct("capture_id", "fx_fetched_at_utc", "fx_rate_date", "units_per_usd")).alias("r"))
    day = capture_date if isinstance(capture_date, Column) else F.lit(capture_date).cast("date")
    good = positive("r.units_per_usd").isNotNull() & F.col("r.fx_rate_date").isNotNull() & (F.abs(F.datediff(day, F.col("r.fx_rate_date"))) <= days)
    return newest.where(good).select("currency", F.col("r.units_per_usd").alias("units_per_usd"), reciprocal("r.units_per_usd").alias("fx_usd_per_unit"), F.col("r.fx_rate_date").alias("fx_rate_date"), F.concat(F.lit(CARRIED), "r.fx_source").alias("fx_source"), F.col("r.fx_fetched_at_utc").alias("fx_fetched_at_utc"))


def by_priority(sources: list[DataFrame]) -> DataFrame:
    """For each currency the rate of the first source that has one."""
    ranked = [df.withColumn("_rank", F.lit(i)) for i, df in enumerate(sources)]
    out = ranked[0]
    for df in ranked[1:]:
        out = out.unionByName(df)
    return keep_first(out, ["currency"], [F.asc("_rank"), F.desc("fx_rate_date")]).drop("_rank")


def status(rates: DataFrame) -> DataFrame:
    """One row: the least fresh kind among the rates in use (``primary``, ``fallback``, ``carried``), or ``none``."""
    kind = F.when(F.col("fx_source").startswith(CARRIED), 2).when(F.col("fx_source") != "frankfurter", 1).otherwise(0)
    return rates.agg(F.element_at(F.array(F.lit("primary"), F.lit("fallback"), F.lit("carried"), F.lit("none")), F.coalesce(F.max(kind), F.lit(3)) + 1).alias("status"))


def upsert(previous: DataFrame, incoming: DataFrame) -> DataFrame:
    """``previous`` with the captures of ``incoming`` replaced; rates to ten significant digits."""
    built = incoming.withColumn("fx_usd_per_unit", F.lit(1.0) / F.col("units_per_usd")).select(FX.names)
    kept = previous.join(built.select("capture_id").distinct(), "capture_id", "left_anti").select(FX.names)
    return significant_rates(kept.unionByName(built))


def rebuild(rows: DataFrame, order: str) -> DataFrame:
    """One rate per (capture, currency), the last in ``order``."""
    kept = keep_first(rows, ["capture_id", "currency"], [F.desc(order)])
    return significant_rates(kept.withColumn("fx_usd_per_unit", F.lit(1.0) / F.col("units_per_usd")).select(FX.names))


def significant_rates(rates: DataFrame) -> DataFrame:
    return rates.withColumns({c: significant(c) for c in ("units_per_usd", "fx_usd_per_unit")})


def apply(prices: DataFrame, rates: DataFrame) -> DataFrame:
    """``prices`` (price, price_unit, capture_date, captured_at_utc) with currency, rate and derived columns.

    Dollars have the identity rate; a currency without a rate keeps its local price and null dollars.
    Nothing is rounded here.
    """
    out = prices.withColumn("currency", currency_of("price_unit")).withColumn("price_local_per_litre", local_per_litre("price", "price_unit"))
    known = rates.select("currency", *[F.col(c).alias(f"_{c}") for c in ("fx_usd_per_unit", "fx_rate_date", "fx_source", "fx_fetched_at_utc")])
    out = out.join(F.broadcast(known), "currency", "left")  # a row for each currency
    usd = F.col("currency") == "USD"
    identity = {"fx_usd_per_unit": F.lit(1.0), "fx_rate_date": F.col("capture_date"), "fx_source": F.lit("identity"), "fx_fetched_at_utc": F.col("captured_at_utc")}
    out = out.withColumns({c: F.when(usd, v).otherwise(F.col(f"_{c}")) for c, v in identity.items()}).drop(*[f"_{c}" for c in identity])
    out = out.withColumn("price_usd_per_litre", usd_per_litre("price_local_per_litre", "fx_usd_per_unit"))
    return out.withColumn("price_usd_per_gallon", usd_per_gallon("price", "price_unit", "price_usd_per_litre"))


def newest_rate(rates: DataFrame) -> DataFrame:
    """The rate in force on each date and currency, with the day it will be replaced."""
    own = Window.partitionBy("currency").orderBy("fx_rate_date", "capture_id")
    return rates.withColumn("valid_to", F.lead("fx_rate_date").over(own))
