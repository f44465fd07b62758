"""Business formulas as column expressions; money is decimal(18,2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rates of the business rules.
VAT_DIVISOR = "1.20"
FEE_FACTOR = "1.03"
NET_COMMISSION = "0.85"
NET_GAIN = "0.664"
TAX_RATE = "0.30"
DAYS_PER_MONTH = 30
RESALE_AFTER_DAYS = 730


def _dec(text: str, kind: str) -> Column:
    return F.lit(text).cast(kind)


def _money(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(18,2)")


def instalment(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Constant monthly payment of a loan; 0 without principal, straight-line at rate 0."""
    p, r, n = principal.cast("double"), annual_rate.cast("double") / 12, months.cast("double")
    annuity = F.when(r == 0, F.try_divide(p, n)).otherwise(F.try_divide(p * r, 1 - F.pow(1 + r, -n)))
    return F.when(p > 0, _money(annuity)).otherwise(F.lit(0).cast("decimal(18,2)"))


def sale_amounts(gross: Column) -> dict[str, Column]:
    """Net of VAT, VAT and total with fees for a VAT-inclusive price."""
    gross = gross.cast("decimal(18,2)")
    net = _money(gross / _dec(VAT_DIVISOR, "decimal(3,2)"))
    return {
        "ht": net,
        "tva": _money(gross - net),
        "total": _money(gross * _dec(FEE_FACTOR, "decimal(3,2)")),
    }


def commission_split(amount: Column, rate: Column, partner: Column, partner_share: Column) -> dict[str, Column]:
    """Gross, net, partner and internal part; a partner part needs a partner."""
    gross = _money(amount.cast("decimal(18,2)") * rate.cast("decimal(9,4)"))
    part = F.when(partner.isNotNull(), _money(gross * partner_share.cast("decimal(9,4)"))).otherwise(
        F.lit(0).cast("decimal(18,2)")
    )
    return {
        "gross": gross,
        "net": _money(gross * _dec(NET_COMMISSION, "decimal(3,2)")),
        "partner": part,
        "internal": _money(gross - part),
    }


def simple_interest(amount: Column, annual_rate: Column, months: Column) -> dict[str, Column]:
    amount = amount.cast("decimal(18,2)")
    interest = _money(amount * annual_rate.cast("decimal(9,4)") * months.cast("decimal(6,0)") / F.lit(12))
    return {"interest": interest, "repayment": _money(amount + interest)}


def capital_gain(purchase: Column, final: Column) -> dict[str, Column]:
    """Gross gain, and the gain after tax; a loss is not taxed."""
    gross = (final.cast("decimal(18,2)") - purchase.cast("decimal(18,2)")).cast("decimal(18,2)")
    net = F.when(gross > 0, _money(gross * _dec(NET_GAIN, "decimal(4,3)"))).otherwise(gross)
    return {"gross": gross, "net": net}


def annual_yield(monthly_rent: Column, price: Column) -> Column:
    """Twelve rents over the price (at least 1), 4 decimals."""
    price = F.greatest(F.coalesce(price.cast("decimal(18,2)"), _dec("0", "decimal(18,2)")), _dec("1", "decimal(18,2)"))
    return F.round(monthly_rent.cast("decimal(18,2)") * 12 / price, 4).cast("decimal(18,4)")


def occupancy(vacant_days: Column, planned_rent: Column) -> dict[str, Column]:
    """Occupied share of a 30-day month, and the rent due for it."""
    days = vacant_days.cast("decimal(6,0)")
    share = F.round(F.lit(1) - days / F.lit(DAYS_PER_MONTH), 4)
    rate = F.when(days <= DAYS_PER_MONTH, F.greatest(share, _dec("0", "decimal(9,4)"))).otherwise(
        _dec("0", "decimal(9,4)")
    ).cast("decimal(9,4)")
    return {"rate": rate, "rent": _money(planned_rent.cast("decimal(18,2)") * rate)}


def tax_result(income: Column, charges: Column, depreciation: Column) -> dict[str, Column]:
    result = (
        income.cast("decimal(18,2)") - charges.cast("decimal(18,2)") - depreciation.cast("decimal(18,2)")
    ).cast("decimal(18,2)")
    taxable = F.greatest(result, _dec("0", "decimal(18,2)"))
    return {"result": result, "tax": _money(taxable * _dec(TAX_RATE, "decimal(3,2)"))}


def elapsed_days(end: Column, start: Column) -> Column:
    return F.datediff(end, start)
