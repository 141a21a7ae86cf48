"""quarry: data-mining operators as Spark DataFrame plans.

Every operator takes DataFrames and column names and returns a lazy
DataFrame.  The heavy work runs as Spark joins, aggregations and windows;
nothing whole is pulled through the driver.
"""

from quarry.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
