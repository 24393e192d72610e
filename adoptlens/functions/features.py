"""Tool list handling: split multi-valued product areas and classify tools into features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feature keys with their report labels, in report order.
FEATURES = [
    ("assistant_threads", "Assistant Threads"),
    ("followups", "Follow-ups Asked"),
    ("word_addin", "Word Add-in"),
    ("workflow_runs", "Workflow Runs"),
    ("review_table_columns", "Review Table Columns"),
    ("playbook_runs", "Playbook Runs"),
]
FEATURE_KEYS = [k for k, _ in FEATURES]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tool_array(product_area: Column | str) -> Column:
    """Comma list -> array of trimmed, non-blank tools (repeats kept, order kept)."""
    parts = F.split(F.coalesce(_col(product_area), F.lit("")), ",")
    return F.filter(F.transform(parts, lambda t: F.trim(t)), lambda t: t != "")


def has_any_tool(product_area: Column | str, tools: list[str]) -> Column:
    """True when any trimmed element of the comma list is one of ``tools``."""
    wanted = F.array(*[F.lit(t) for t in tools])
    parts = F.split(_col(product_area), ",")
    return F.exists(parts, lambda t: F.array_contains(wanted, F.trim(t)))


# Feature classes in match order; a tool matching any pattern of a class
# (lower-cased, trimmed, SQL LIKE) belongs to the first such class.
FEATURE_PATTERNS = [
    ("followups", ["%follow-up%", "%follow up%", "%followup%"]),
    ("word_addin", ["%word%", "%add-in%", "%add in%"]),
    ("workflow_runs", ["%workflow%"]),
    ("playbook_runs", ["%playbook%"]),
    ("review_table_columns", ["%review%"]),
    ("assistant_threads", ["%assistant%", "%thread%"]),
]


def feature_class(tool: Column | str) -> Column:
    """Tool name -> feature key (first matching class in ``FEATURE_PATTERNS``); NULL when
    unmapped. Pure JVM expression (CASE WHEN over LIKE), usable inside higher-order
    functions."""
    t = F.lower(F.trim(_col(tool)))
    expr = None
    for key, patterns in FEATURE_PATTERNS:
        cond = reduce(lambda a, b: a | b, [t.like(p) for p in patterns])
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr
