from clicklens.sources.adlines import bad_lines, encode_lines, parse_lines, read_line_stream
from clicklens.sources.tables import (
    ad_clicks,
    ads_log,
    bind_schema,
    catalog_scan,
    geo_dim,
    local_rows,
    read_table,
    visit_log,
    visit_actions,
    visit_log_from_events,
    with_geo,
)

__all__ = [
    "ad_clicks", "ads_log", "bad_lines", "bind_schema", "catalog_scan", "encode_lines", "geo_dim",
    "local_rows", "parse_lines", "read_line_stream", "read_table", "visit_actions", "visit_log", "visit_log_from_events",
    "with_geo",
]
