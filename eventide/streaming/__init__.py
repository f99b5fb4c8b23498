from eventide.streaming.eventtime import with_event_time, wm_safe_filter
from eventide.streaming.sinks import SideOutputs, split_channels, write_channels, write_stream
from eventide.streaming.twins import (stream_interval_join, stream_salted_count, stream_sliding_count, stream_top_n,
                                      stream_unique_visitors, stream_unique_visitors_hll)
from eventide.streaming.processors import (stream_cap_per_key, stream_consecutive_run, stream_fail_bursts,
                                          stream_followed_by, stream_order_payment_status,
                                          stream_first_sightings, stream_one_to_one)
from eventide.streaming.running import write_running_unique_visitors
from eventide.streaming.late_windows import latest_counts, stream_final_counts, stream_windows_with_late

__all__ = [n for n in dir() if not n.startswith("_")]
