"""Text dataset preparation as Spark table jobs."""

from texloam.config import CleanSpec, UrlSpec
from texloam.session import build_session

__all__ = ["CleanSpec", "UrlSpec", "build_session"]
