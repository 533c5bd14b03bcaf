"""Forecast error, inventory cost and population stability expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stockcast.defaults import COST_OVER, COST_UNDER


def mean_of(total: Column, n: Column) -> Column:
    """Mean from a sum and a count; NULL without rows. Decimal sums stay exact up to the division."""
    return total.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))


def shortage(y: Column, yhat: Column) -> Column:
    """Units short: forecast below demand."""
    return F.when(y > yhat, y - yhat).when(y <= yhat, (y - yhat) * 0)


def surplus(y: Column, yhat: Column) -> Column:
    """Units over: forecast above demand."""
    return shortage(yhat, y)


def error_aggregates(y: Column, yhat: Column, eps: float = 1e-8) -> dict[str, Column]:
    """Row counts, mae, rmse and mape (a fraction) as aggregates; NULL rows are counted apart."""
    err = y - yhat
    n = F.count(err)
    relative = F.abs(err).cast("double") / F.greatest(F.abs(y).cast("double"), F.lit(eps))
    return {
        "n": n,
        "n_null": F.count(F.lit(1)) - n,
        "mae": mean_of(F.sum(F.abs(err)), n),
        "rmse": F.sqrt(mean_of(F.sum(err * err), n)),
        "mape": mean_of(F.sum(F.when(err.isNotNull(), relative)), n),
    }


def cost_from_units(short: Column, over: Column, cost_under=COST_UNDER, cost_over=COST_OVER) -> Column:
    """Asymmetric cost of already summed units; prices may be numbers or columns."""
    under_price = cost_under if isinstance(cost_under, Column) else F.lit(float(cost_under))
    over_price = cost_over if isinstance(cost_over, Column) else F.lit(float(cost_over))
    return short.cast("double") * under_price + over.cast("double") * over_price


def psi_term(reference: Column, current: Column) -> Column:
    """One bin of the population stability index; both shares must be positive."""
    return (current - reference) * F.ln(current / reference)


def clipped_share(share: Column, low: float = 1e-6) -> Column:
    return F.least(F.greatest(share, F.lit(low)), F.lit(1.0))
