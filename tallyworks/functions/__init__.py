from tallyworks.functions.dates import (
    assemble_timestamp,
    fiscal_period,
    half_of_year,
    season,
    weekday_gap,
)
from tallyworks.functions.numbers import MONEY, decimal_ratio, half_up, rounded_ratio
from tallyworks.functions.text import escaped, fingerprint, root_code, without_quotes

__all__ = [
    "MONEY",
    "assemble_timestamp",
    "decimal_ratio",
    "escaped",
    "fingerprint",
    "fiscal_period",
    "half_of_year",
    "half_up",
    "root_code",
    "rounded_ratio",
    "season",
    "weekday_gap",
    "without_quotes",
]
