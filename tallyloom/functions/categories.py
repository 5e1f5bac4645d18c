"""Category rules as expressions. Backfill and its checks all come from the one rule table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.conditions import any_of
from tallyloom.schemas import CATEGORY_RULES, CategoryRule

CATEGORY = "ProductCategoryName"
SUBCATEGORY = "ProductSubCategoryName"


def _applies(rule: CategoryRule) -> Column:
    label = F.col(SUBCATEGORY)
    exact = label.isin(*rule.labels)
    return exact if rule.part is None else exact | label.contains(rule.part)


def implied_category() -> Column:
    """Category of the first rule that covers the subcategory, else NULL."""
    return F.coalesce(*[F.when(_applies(rule), F.lit(rule.category)) for rule in CATEGORY_RULES])


def backfilled_category() -> Column:
    """The recorded category where there is one, else the implied one."""
    return F.coalesce(CATEGORY, implied_category())


def covered_by_rule() -> Column:
    return any_of(_applies(rule) for rule in CATEGORY_RULES)
