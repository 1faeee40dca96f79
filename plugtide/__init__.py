"""Occupancy analytics for logs of usage sessions at shared points, on Spark DataFrames."""

from plugtide.config import Settings

__all__ = ["Settings"]
