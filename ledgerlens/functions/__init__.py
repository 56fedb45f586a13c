"""Column-level helpers: text, dates, fixed code sets and business rules."""

from ledgerlens.functions import codes, dates, rules, text

__all__ = ["codes", "dates", "rules", "text"]
