"""Input schemas of the shop logs (headerless CSV / text) as Spark DDL.

Times in the raw files are epoch seconds (ms for the market feed); readers
convert them to an event-time TIMESTAMP column ``ts`` and keep the raw value.
"""

# Column of a reader that keeps a malformed line.
CORRUPT = "_corrupt_record"

USER_BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts_sec BIGINT"
AD_CLICK = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, ts_sec BIGINT"
LOGIN = "user_id BIGINT, ip STRING, event_type STRING, ts_sec BIGINT"
ORDER_EVENT = "order_id BIGINT, event_type STRING, tx_id STRING, ts_sec BIGINT"
RECEIPT = "tx_id STRING, pay_channel STRING, ts_sec BIGINT"
MARKET_BEHAVIOR = "user_id BIGINT, behavior STRING, channel STRING, ts_ms BIGINT"

# Order event types and statuses.
CREATE, PAY = "create", "pay"
PAYED, PAYED_TIMEOUT, PAY_TIMEOUT = "payed", "payed timeout", "pay timeout"
PAY_WITHOUT_CREATE, OTHER_EVENT = "pay_without_create", "other_event"

# Market feed channels.
MARKET_CHANNELS = ["app store", "wechat", "weibo", "tieba"]

# Fixed value: access-log time format.
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
