"""Order-book analytics on Spark DataFrames."""

from depthframe.params import BookParams, ProfileParams

__all__ = ["BookParams", "ProfileParams"]
