"""Subscription-revenue analytics on Spark DataFrames."""

from waterline.config import RunConfig

__all__ = ["RunConfig"]
