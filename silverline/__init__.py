"""Medallion-style data preparation on Spark DataFrames."""

from silverline.session import build_session

__all__ = ["build_session"]
