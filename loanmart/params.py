"""Run parameters that replace the clock and the deployment target.

The models stamp rows with the load time and compute ages against "today";
both are parameters here so a run is reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    # "today" for ages and tenure (replaces current_date()).
    as_of: dt.date = dt.date(2024, 2, 1)
    # load stamp written to every model (replaces current_timestamp()).
    run_ts: dt.datetime = dt.datetime(2024, 2, 1, 6, 0, 0)
    # PII masking on (non-production targets) or off (production).
    mask_pii: bool = True
    # rows per side under which a lookup may be broadcast.
    max_broadcast_rows: int = 100_000


DEFAULT = RunParams()
