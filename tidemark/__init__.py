"""Incremental medallion analytics as Spark DataFrame plans."""

from tidemark.contracts import TableContract
from tidemark.session import build_session

__all__ = ["TableContract", "build_session"]
