"""Customer-retention analytics on Spark DataFrames."""

from stayline.config import Settings

__all__ = ["Settings"]
