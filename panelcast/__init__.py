"""panelcast: monthly panel roll-ups, idempotent history appends and panel forecasts on Spark.

Every public function takes DataFrames and column names and returns a DataFrame; nothing is
collected to the driver except one-row facts used by explicit guards.
"""

__version__ = "0.1.0"
