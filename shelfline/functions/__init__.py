from .demand import demand_columns
from .exact import amount_parts, exact_avg, exact_sum, from_units, portable_round, sum_of_parts, to_units
from .scalars import date_key, lenient_date, lenient_double, lenient_int, month_boundaries, season_of

__all__ = [
    "date_key",
    "demand_columns",
    "amount_parts",
    "exact_avg",
    "exact_sum",
    "from_units",
    "lenient_date",
    "lenient_double",
    "lenient_int",
    "month_boundaries",
    "portable_round",
    "sum_of_parts",
    "season_of",
    "to_units",
]
