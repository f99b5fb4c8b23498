from eventide.functions.predicates import (equals_value, not_equals_null_safe, is_static_asset,
                                           exclude_static_assets, non_empty, wm_safe_filter,
                                           filter_behavior, exclude_behavior, STATIC_ASSET_PATTERN)
from eventide.functions.bitmap import bitmap_offset
from eventide.functions.formatting import format_ranking

__all__ = ["filter_behavior", "exclude_behavior", "equals_value", "not_equals_null_safe", "is_static_asset", "exclude_static_assets",
           "non_empty", "wm_safe_filter", "STATIC_ASSET_PATTERN", "bitmap_offset", "format_ranking"]
