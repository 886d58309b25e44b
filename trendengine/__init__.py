"""Regional popularity trends on Spark.

Plain ``DataFrame -> DataFrame`` functions: read dated batches of daily scores,
clean them, turn tag lists into one row per tag, drop duplicates, keep
dimensions with stable surrogate keys and derive facts and rankings.
"""

from trendengine.schemas import CLEAN_SCHEMA, RAW_SCHEMA
from trendengine.session import build_session

__all__ = ["CLEAN_SCHEMA", "RAW_SCHEMA", "build_session"]
