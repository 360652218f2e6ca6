"""Customer-behaviour analytics for a fund-investment app, built on Spark DataFrames.

Every operator is a plain function from DataFrames to a DataFrame.  Dates are
explicit arguments (``as_of``, ``start``, ``end``); nothing reads the clock.
"""

__version__ = "0.1.0"
