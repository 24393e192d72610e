"""adoptlens: product-usage and adoption analytics as Spark DataFrame plans.

Sub-packages
------------
sources    readers for raw event JSON, CSV extracts, roster files and the test tables
functions  column expressions (cleaning, local calendar, access state, feature class)
operators  reusable DataFrame operators (filters, de-duplication, merges, reconciliation)
plans      report builders (dashboard, leaderboard, paging, exports, adoption, team report)
streaming  Structured Streaming ingest, de-duplication and running daily counts
"""

from adoptlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
