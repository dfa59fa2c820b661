from shelfline.functions.measures import exact_ratio
from shelfline.functions.money import LIMBS, Money, money, together
from shelfline.functions.labels import (
    day_of_week_num,
    julian_day,
    month_label,
    quarter_label,
    ship_method,
    week_start,
)

__all__ = [
    "LIMBS",
    "Money",
    "day_of_week_num",
    "exact_ratio",
    "julian_day",
    "money",
    "month_label",
    "quarter_label",
    "ship_method",
    "together",
    "week_start",
]
