"""limpid: checking, cleaning and scoring delimited records with Spark DataFrames."""

from limpid.rules import DEFAULT, Columns, Rules

__all__ = ["DEFAULT", "Columns", "Rules"]
