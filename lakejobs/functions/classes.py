"""Business classes and scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category synonyms and the name each group is reported under.
CATEGORY_SYNONYMS = {
    "Electronics": ("Electronics", "Technology", "Gadgets"),
    "Apparel": ("Clothing", "Apparel", "Fashion"),
    "Home & Garden": ("Home", "Household", "Furniture"),
}


def standard_category(c: str, synonyms: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The group a category belongs to, or the category itself."""
    groups = CATEGORY_SYNONYMS if synonyms is None else synonyms
    pairs = [F.lit(x) for name, words in groups.items() for w in words for x in (w, name)]
    if not pairs:
        return F.col(c)
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(c)), F.col(c))


def tenure_segment(days: str, loyal: int = 365, regular: int = 90) -> Column:
    """Loyal, Regular or New; an unknown tenure counts as New."""
    return (
        F.when(F.col(days) > loyal, "Loyal").when(F.col(days) > regular, "Regular").otherwise("New")
    )


def value_segment(value: str, high: float = 1000, medium: float = 500) -> Column:
    v = F.col(value)
    return (
        F.when(v >= high, "High Value")
        .when(v >= medium, "Medium Value")
        .when(v.isNotNull(), "Low Value")
        .otherwise("No Purchases")
    )


def recency_status(last_sale: str, today: Column, active: int = 30, slow: int = 90) -> Column:
    last = F.col(last_sale)
    return (
        F.when(last >= F.date_sub(today, active), "Active")
        .when(last >= F.date_sub(today, slow), "Slow Moving")
        .when(last.isNotNull(), "Inactive")
        .otherwise("Never Sold")
    )


def performance_score(
    revenue: str, customers: str, w_rev: float = 0.6, w_cust: float = 0.4
) -> Column:
    """Weighted sum of revenue and customer count, missing parts counting zero."""
    return (
        F.coalesce(F.col(revenue).cast("double"), F.lit(0.0)) * w_rev
        + F.coalesce(F.col(customers).cast("double"), F.lit(0.0)) * w_cust
    )


def ratio(part: str | Column, whole: str | Column) -> Column:
    """``part / whole`` as double, NULL for a zero divisor."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))
