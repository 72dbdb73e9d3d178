"""Column helpers, all made of built-in expressions."""

from tidemark.functions.money import MONEY, money, per, plain, units
from tidemark.functions.text import title_case
from tidemark.functions.time import hours_crossed, ntz, to_day

__all__ = ["MONEY", "money", "per", "plain", "units", "title_case", "hours_crossed", "ntz", "to_day"]
