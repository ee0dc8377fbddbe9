"""Invoice revenue reporting on Spark DataFrames."""

from billwright.rules import Rules
from billwright.sources.tables import InvoiceTables

__all__ = ["InvoiceTables", "Rules"]
