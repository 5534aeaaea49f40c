"""Registered queries, each with the SQL that checks it."""

from workbook.core import CASES, load_all

__all__ = ["CASES", "load_all"]
