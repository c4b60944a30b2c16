"""Market-data analytics over Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; all symbols are
processed in one distributed plan, never one query per symbol.
"""

from barspan.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
