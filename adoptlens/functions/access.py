"""Access-state derivation and status notes for the employee roster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adoptlens.functions.text import clean_text

# The four access states and their merge precedence.
GRANTED, PENDING, REVOKED, RESIGNED = "granted", "pending", "revoked", "resigned"
STATES = [GRANTED, PENDING, REVOKED, RESIGNED]
STATE_RANK = {"granted": 4, "revoked": 3, "resigned": 2, "pending": 1}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def access_state(raw_status: Column | str | None, has_status_column: bool = True) -> Column:
    """Map a raw roster status to granted / pending / revoked / resigned.

    Order matters: 'Revoked - resigned' is revoked. No status column at all means every
    row is granted; a blank status is pending.
    """
    if not has_status_column or raw_status is None:
        return F.lit(GRANTED)
    s = clean_text(raw_status)
    low = F.lower(s)
    return (
        F.when(s.isNull(), F.lit(PENDING))
        .when(s == "Added", F.lit(GRANTED))
        .when(low.startswith("revoked"), F.lit(REVOKED))
        .when(low.contains("resigned"), F.lit(RESIGNED))
        .otherwise(F.lit(PENDING))
    )


def state_rank(state: Column | str) -> Column:
    s = _col(state)
    expr = F.lit(0)
    for name, rank in STATE_RANK.items():
        expr = F.when(s == name, F.lit(rank)).otherwise(expr)
    return expr


def status_note(raw_status: Column | str, state: Column | str) -> Column:
    """Raw status if present, else a sentence by state (members without access)."""
    st = _col(state)
    return F.coalesce(
        _col(raw_status),
        F.when(st == PENDING, F.lit("Did not request for access"))
        .when(st == REVOKED, F.lit("Revoked"))
        .when(st == RESIGNED, F.lit("Resigned"))
        .otherwise(F.lit("No access")),
    )
