"""DataFrame-in, DataFrame-out operators."""

from stratastar.operators.asof import next_at_or_after
from stratastar.operators.business import (
    group_members,
    in_ranges,
    member_pages,
    last_attributes,
    never_matched,
    previous_version,
    reconcile_stock,
    resale_candidates,
    same_region,
    status_transitions,
    tagged_pool,
)
from stratastar.operators.days import (
    business_days,
    candidate_days,
    days_between,
    days_to_process,
    next_business_day,
    observed_span,
    public_holidays,
)
from stratastar.operators import setops
from stratastar.operators.distinct import distinct_counts, distinct_state, member_numbers, merged_state
from stratastar.operators.lookup import Lookup, Target, find_keys, lookup, membership, misses, status_lookup
from stratastar.operators.lookup import target as lookup_target
from stratastar.operators.quality import (
    Check,
    accepted_values_failures,
    column_failures,
    freshness,
    not_null_failures,
    quality_log,
    run_log,
    unique_failures,
    unique_failure_counts,
)
from stratastar.operators.setops import domain_values, observed_dates, with_unknown
from stratastar.operators.versions import latest_columns, latest_of_extract, latest_version

__all__ = [name for name in dir() if not name.startswith("_")]
