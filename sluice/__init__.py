"""sluice: Spark-native record ingestion, decoding and data-quality operators.

Everything is expressed with DataFrame / SQL / Structured Streaming; see
README.md for the operator map.
"""

from sluice.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
