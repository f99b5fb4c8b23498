from eventide.operators.scan import Running, fold_groups, ordered_scan, time_bucket
from eventide.operators.windows import sliding_count, tumbling_count, salted_count, rollup_profile
from eventide.operators.ranking import top_n_per_window
from eventide.operators.distinct import (unique_visitors, unique_visitors_bitmap, running_unique_visitors,
                                         unique_visitors_hll, hll_sketches)
from eventide.operators.capping import Capped, blacklist_warnings, cap_per_key
from eventide.operators.sequences import (consecutive_run, consecutive_pairs, fail_bursts, followed_by,
                                          order_payment_status, FollowedBy)
from eventide.operators.matching import Matched, interval_match
from eventide.operators.lateness import LateSplit, sliding_count_with_lateness, split_late

__all__ = [n for n in dir() if not n.startswith("_")]
