"""Column layouts of the event kinds, as DDL. ``ts`` holds epoch seconds unless noted."""

# Column order and types of the delimited event files.
USER_BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts BIGINT"
AD_CLICK = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, ts BIGINT"
LOGIN = "user_id BIGINT, ip STRING, event_type STRING, ts BIGINT"
ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, ts BIGINT"
RECEIPT = "tx_id STRING, channel STRING, ts BIGINT"
MARKETING = "user_id STRING, behavior STRING, channel STRING, ts BIGINT"  # epoch milliseconds

# Position of each field in a space-separated access log line.
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
