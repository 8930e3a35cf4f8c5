"""Card attributes derived from the card number."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.functions.dates import DAYS_PER_YEAR, add_years, as_date
from ledgerstar.functions.keys import choose, draw, in_range, in_steps

# Card tiers as lowest limit, highest limit, step.
CARD_TIERS = {
    "Basic": (1000, 5000, 500),
    "Gold": (5000, 15000, 1000),
    "Platinum": (15000, 30000, 2500),
    "Signature": (30000, 50000, 5000),
    "Infinite": (50000, 100000, 10000),
}
# Years a card is valid, and how far back it may have been issued.
VALID_YEARS = (3, 5)
ISSUED_WITHIN_YEARS = 5

# A default list; callers may pass their own.
PROVIDERS = ("American Express", "Diners Club", "Discover", "JCB", "Maestro", "Mastercard", "VISA")


def tier(category: str | Column) -> Column:
    """The limits of a card category as struct(low, high, step); null for an unknown one."""
    entries = []
    for name, limits in CARD_TIERS.items():
        entries.append(F.lit(name))
        named = zip(("low", "high", "step"), limits)
        entries.append(F.struct(*[F.lit(value).alias(field) for field, value in named]))
    category = F.col(category) if isinstance(category, str) else category
    return F.try_element_at(F.create_map(*entries), category)


def credit_limit(key: str | Column, category: str | Column, seed: str = "") -> Column:
    """A stepped limit within the tier of ``category``."""
    limits = tier(category)
    return in_steps(
        key, seed + "limit", limits.getField("low"), limits.getField("high"), limits.getField("step")
    )


def enrich_cards(
    cards: DataFrame,
    key: str = "cc_num",
    as_of: datetime.date | str | Column | None = None,
    providers: tuple[str, ...] = PROVIDERS,
    seed: str = "",
) -> DataFrame:
    """Add provider, category, expiration date, issue date and credit limit to each card."""
    issue_date = F.date_sub(
        as_date(as_of),
        (draw(key, seed + "issue") % F.lit(ISSUED_WITHIN_YEARS * DAYS_PER_YEAR + 1)).cast("int"),
    )
    with_choices = cards.withColumns(
        {
            "card_provider": choose(key, seed + "provider", providers),
            "card_category": choose(key, seed + "category", tuple(CARD_TIERS)),
            "issue_date": issue_date,
        }
    )
    return with_choices.select(
        *cards.columns,
        "card_provider",
        "card_category",
        add_years("issue_date", in_range(key, seed + "years", *VALID_YEARS)).alias(
            "expiration_date"
        ),
        "issue_date",
        credit_limit(key, "card_category", seed).alias("credit_limit"),
    )
