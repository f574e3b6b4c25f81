"""Column helpers (pure ``pyspark.sql.functions`` expressions) and exact distributed ranks."""

from meterlake.functions.columns import (
    MONEY, QTY, date_lit, last_days, between_marks, money, ntz_lit, ratio,
)

__all__ = ["MONEY", "QTY", "date_lit", "last_days", "between_marks", "money", "ntz_lit", "ratio"]
