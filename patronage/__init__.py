"""Customer analytics on Spark: cleaning, segments, lifetime value, churn, master table."""

from patronage.params import Params
from patronage.session import build_session, stage

__all__ = ["Params", "build_session", "stage"]
