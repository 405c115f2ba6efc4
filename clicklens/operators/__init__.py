from clicklens.operators.ads import (
    ad_user_daily_counts,
    ads_area_rollup,
    ads_area_top3,
    ads_area_top3_json,
    ads_click_daily,
    ads_last_minute,
    ads_sliding_60s,
    ads_trend_10s,
    trend_buckets,
)
from clicklens.operators.blacklist import (
    blacklist_filtered_counts,
    blacklist_filtered_counts_by_batch,
    blacklist_users,
    blacklist_users_by_batch,
    first_clicks,
)
from clicklens.operators.categories import (
    action_routing,
    category_metric_counts,
    category_metric_pivot,
    hot_category_top10,
)
from clicklens.operators.common import bounded_broadcast, hot_keys, hot_slices, next_in_session, slice_number, top_n_per_group
from clicklens.operators.dwell import page_avg_dwell, page_dwell
from clicklens.operators.pageflow import (
    flow_pairs,
    page_conversion,
    page_steps,
    page_transitions,
    page_visits,
    session_pairs,
    target_flow,
)
from clicklens.operators.sessions import (
    category_session_counts,
    clicks,
    hot_category_session_top10,
    top_category_clicks,
)

__all__ = [
    "action_routing", "ad_user_daily_counts", "ads_area_rollup", "ads_area_top3", "ads_area_top3_json",
    "ads_click_daily", "ads_last_minute", "ads_sliding_60s", "ads_trend_10s", "blacklist_filtered_counts",
    "blacklist_filtered_counts_by_batch", "blacklist_users", "blacklist_users_by_batch", "bounded_broadcast",
    "category_metric_counts", "category_metric_pivot", "category_session_counts", "clicks", "first_clicks", "hot_keys", "hot_slices", "slice_number",
    "flow_pairs", "hot_category_session_top10", "hot_category_top10", "next_in_session", "page_avg_dwell",
    "page_conversion", "page_dwell", "page_steps", "page_transitions", "page_visits", "session_pairs", "target_flow",
    "top_category_clicks", "top_n_per_group", "trend_buckets",
]
