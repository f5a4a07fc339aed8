"""Volume and currency measures of both feeds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cubic metres per bale of each feed, and local currency per dollar.
CHAIN_BALE_VOLUME = 0.0058
PANEL_BALE_VOLUME = 0.00579
LOCAL_PER_DOLLAR = 7900
MEASURE_LIMIT = 1_000_000.0

NAPPIES, CIGARETTES = "PANALES", "CIGARRILLOS"
PANEL_NAPPIES = "PAÑALES"


def chain_measures(
    category: Column, units: Column, content: Column, pack: Column, bale_volume: float = CHAIN_BALE_VOLUME
) -> dict[str, Column]:
    """Measures of a chain row; those its category does not have are NULL."""
    nappies = category == NAPPIES
    cigarettes = category == CIGARETTES
    return {
        "unidades": F.when(nappies, content * units).otherwise(units),
        "paquetes": F.when(nappies, units),
        "fardos": F.when(nappies, content * units * F.lit(30 / 1000000 / bale_volume)),
        "kilos": F.when(~nappies & ~cigarettes, content / 1000 * units),
        "cajas": F.when(cigarettes, pack * units / 10000),
    }


def dollars(local_amount: Column) -> Column:
    """Local amount in dollars to three places, halves to the even digit.

    Scaled, rounded and scaled back in binary; bround() works on the decimal digits of
    the quotient instead and differs from that in rare cases.
    """
    return F.rint(local_amount / LOCAL_PER_DOLLAR * 1000) / 1000


def _no_less_than_zero(value: Column) -> Column:
    return F.greatest(F.nanvl(F.coalesce(value, F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def panel_volume(sales_volume: Column, quantity: Column, content: Column) -> Column:
    """Sales volume, or quantity times content where it is not positive."""
    return F.when(sales_volume > 0, sales_volume).otherwise(quantity * content)


def panel_measures(
    category: Column,
    pack_class: Column,
    volume: Column,
    quantity: Column,
    content: Column,
    bale_volume: float = PANEL_BALE_VOLUME,
) -> dict[str, Column]:
    """kilos, cajas and fardos of a panel row; missing and negative give 0."""
    kind, pack = F.upper(category), F.upper(pack_class)
    per_pack = F.when(content == 20, F.lit(10.0)).otherwise(F.lit(20.0))
    boxes = F.when(pack == "CAJETILLAS", volume / 10000.0).when(
        pack == "GRUESAS", content * per_pack * quantity / 10000.0
    )
    bales = volume * 30.0 / 1_000_000.0 / F.lit(bale_volume)
    return {
        "kilos": _no_less_than_zero(volume),
        "cajas": _no_less_than_zero(F.when(kind == CIGARETTES, boxes)),
        "fardos": _no_less_than_zero(F.when(kind == PANEL_NAPPIES, bales)),
    }


def bounded_measure(value: Column) -> Column:
    """Not-a-number and infinite become 0, the rest is clipped to [0, MEASURE_LIMIT].

    The test for NaN comes first: greatest() and least() take NaN for the largest value.
    """
    finite = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    return F.least(F.greatest(F.coalesce(finite, F.lit(0.0)), F.lit(0.0)), F.lit(MEASURE_LIMIT))


def units_or_quantity(units: Column | None, quantity: Column) -> Column:
    """Units, or the quantity as an integer where the feed has none."""
    whole = quantity.try_cast("bigint")
    return whole if units is None else F.coalesce(units, whole)
