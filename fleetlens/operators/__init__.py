"""Reusable DataFrame -> DataFrame operators."""

from fleetlens.operators.joins import (anti, asof_join, expand_matches, join_calendar, lookback_count,  # noqa: F401
                                       next_event, not_in, semi, semi_any)
from fleetlens.operators.latest import latest_by, production  # noqa: F401
from fleetlens.operators.nested import (allocate_cost, expand_hierarchy, licensed_displays,  # noqa: F401
                                        snapshot_diff, unnest)
from fleetlens.operators.reliability import (daily_reliability, distinct_counts, first_event_dates,  # noqa: F401
                                             funnel, top_errors)
from fleetlens.operators.rollup import (latest_n_dates, one_scan_union, pivot_metrics, splice_rollup,  # noqa: F401
                                        tag_union)
