"""gridlake: electric-grid study data on Spark DataFrames.

Every operator takes DataFrames and column names and returns DataFrames, so it
runs on the canonical grid tables (``gridlake.schemas``) and on any table of the
same shape.
"""
