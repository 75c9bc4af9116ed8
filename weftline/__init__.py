"""Sequence, interval and alignment analytics expressed as Spark DataFrames."""

from weftline.session import build_session

__all__ = ["build_session"]
