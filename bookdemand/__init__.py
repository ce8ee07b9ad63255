"""Booking-demand analytics on Spark DataFrames.

Everything here builds logical plans with the DataFrame / SQL API and lets
Catalyst and AQE choose the physical strategy.  Operators take and return
DataFrames; the only eager steps are explicit, bounded contract checks
(documented where they happen).
"""

from bookdemand.session import build_session, checkpoint_dir, ensure_semantics

__all__ = ["build_session", "checkpoint_dir", "ensure_semantics"]
