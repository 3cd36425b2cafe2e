"""Panel analytics on Spark DataFrames."""

from panelkit.tables import Tables

__all__ = ["Tables"]
