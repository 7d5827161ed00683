"""Recurring-revenue analytics as PySpark DataFrame plans.

Every public function takes DataFrames (plus plain parameters such as the
as-of date) and returns a DataFrame; nothing here collects rows to the driver.
"""

__version__ = "0.1.0"
