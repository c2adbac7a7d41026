"""Gridded ocean and climate analytics as PySpark DataFrame operators.

Fields are long tables (one row per dataset, time, level, cell and variable) and
a missing value is SQL NULL.  Every operator takes and returns DataFrames, so
Catalyst sees one declarative plan from scan to result.
"""

__version__ = "0.1.0"
