"""Column expressions of the sales marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def segment3(customer_type: str = "customer_type") -> Column:
    """Business, Consumer, or Unknown for any other type and for NULL."""
    kind = F.col(customer_type)
    return F.when(kind == "B2B", "Business").when(kind == "B2C", "Consumer").otherwise("Unknown")


def segment2(customer_type: str = "customer_type") -> Column:
    """Business, or Consumer for everything else including NULL."""
    return F.when(F.col(customer_type) == "B2B", "Business").otherwise("Consumer")


def value_band(amount: Column | str, hi: int = 1000, mid: int = 100) -> Column:
    """High, Medium or Low value by amount; NULL is Low."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (
        F.when(amount > hi, "High Value").when(amount > mid, "Medium Value").otherwise("Low Value")
    )


def net_revenue(customer_type: str = "customer_type", revenue: str = "revenue") -> Column:
    """Business sales count at 85 percent, all others in full."""
    discounted = F.col(revenue) * F.expr("0.85")
    return F.when(F.col(customer_type) == "B2B", discounted).otherwise(F.col(revenue))


def calculated_amount(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    return F.col(quantity) * F.col(unit_price)


def geography_key(*parts: str) -> Column:
    """Parts joined by a hyphen; NULL as soon as one part is NULL."""
    pieces = [piece for part in parts for piece in (F.lit("-"), F.col(part))][1:]
    return F.concat(*pieces)


def quarter_number(quarter: str = "quarter") -> Column:
    """The digit of a quarter written as ``Q1``."""
    return F.substring(quarter, 2, 1).cast("tinyint")


def is_weekend(date: str) -> Column:
    return F.dayofweek(date).isin(1, 7)


def day_type(date: str) -> Column:
    return F.when(is_weekend(date), "Weekend").otherwise("Weekday")


def calendar(date: str) -> dict[str, Column]:
    """Calendar features by name. Weeks are ISO weeks; days of the week run from Sunday = 1."""
    return {
        "day_of_month": F.dayofmonth(date),
        "day_of_week_num": F.dayofweek(date),
        "day_of_week_name": F.date_format(date, "EEEE"),
        "month_name": F.date_format(date, "MMMM"),
        "week_of_year": F.weekofyear(date),
        "day_type": day_type(date),
    }
