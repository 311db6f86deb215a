"""Column functions. Every one returns a native Spark expression; none is a Python UDF."""

from folioweave.functions import lists, numbers, text, urls

__all__ = ["lists", "numbers", "text", "urls"]
