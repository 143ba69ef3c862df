"""fernhill: partner-report and catalogue analytics as plain Spark DataFrame jobs.

Every public helper takes and returns DataFrames (or Columns); nothing is
collected to the driver. See README.md for the map of operators.
"""

__version__ = "0.1.0"
