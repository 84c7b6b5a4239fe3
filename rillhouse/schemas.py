"""Declared record schemas. Field names and types are fixed values shared with the producers."""

from pyspark.sql import types as T

S, L = T.StringType(), T.LongType()
_TYPES = {
    "STRING": S,
    "BIGINT": L,
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(fields: str) -> T.StructType:
    """Flat record from ``name TYPE`` pairs; usable before a session exists."""
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


# --- behaviour log -------------------------------------------------------------------------

COMMON = _struct(
    "ar STRING, ba STRING, ch STRING, is_new STRING, md STRING, mid STRING, os STRING, "
    "uid STRING, vc STRING"
)
START = _struct(
    "entry STRING, loading_time BIGINT, open_ad_id BIGINT, open_ad_ms BIGINT, "
    "open_ad_skip_ms BIGINT"
)
PAGE = _struct(
    "page_id STRING, last_page_id STRING, item STRING, item_type STRING, during_time BIGINT"
)
DISPLAY = _struct(
    "display_type STRING, item STRING, item_type STRING, order BIGINT, pos_id BIGINT"
)
ACTION_ITEM = _struct("action_id STRING, ts BIGINT")
ERROR = _struct("error_code BIGINT, msg STRING")

BASE_LOG = (
    T.StructType()
    .add("common", COMMON)
    .add("start", START)
    .add("page", PAGE)
    .add("displays", T.ArrayType(DISPLAY))
    .add("actions", T.ArrayType(ACTION_ITEM))
    .add("err", ERROR)
    .add("ts", L)
)

# --- change capture ------------------------------------------------------------------------

_CELLS = T.MapType(S, S)
CDC_VALUE = T.StructType().add("before", _CELLS).add("after", _CELLS).add("op", S)
CDC_ENVELOPE = (
    T.StructType()
    .add("database", S)
    .add("table", S)
    .add("before", _CELLS)
    .add("after", _CELLS)
    .add("type", S)
)
TABLE_PROCESS = _struct(
    "sourceTable STRING, operateType STRING, sinkType STRING, sinkTable STRING, "
    "sinkColumns STRING, sinkPk STRING, sinkExtend STRING"
)

# --- orders and payments -------------------------------------------------------------------

# user_id and the last three fields are needed by the wide record but were never declared upstream.
ORDER_INFO = _struct(
    "id BIGINT, province_id BIGINT, order_status STRING, total_amount DOUBLE, "
    "activity_reduce_amount DOUBLE, coupon_reduce_amount DOUBLE, feight_fee DOUBLE, "
    "expire_time STRING, create_time STRING, operate_time STRING, create_date STRING, "
    "create_hour STRING, create_ts BIGINT, province_name STRING, province_area_code STRING, "
    "province_3166_2_code STRING, province_iso_code STRING, user_age INT, user_gender STRING, "
    "user_id BIGINT, original_total_amount DOUBLE, feight_fee_reduce DOUBLE, "
    "refundable_time STRING"
)
ORDER_DETAIL = _struct(
    "id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DOUBLE, sku_num BIGINT, "
    "sku_name STRING, create_time STRING, split_total_amount DOUBLE, "
    "split_activity_amount DOUBLE, split_coupon_amount DOUBLE, create_ts BIGINT"
)
PAYMENT_INFO = _struct(
    "id BIGINT, order_id BIGINT, user_id BIGINT, total_amount DOUBLE, subject STRING, "
    "payment_type STRING, create_time STRING, callback_time STRING"
)
ORDER_WIDE = _struct(
    "detail_id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DOUBLE, sku_num BIGINT, "
    "sku_name STRING, split_total_amount DOUBLE, split_activity_amount DOUBLE, "
    "split_coupon_amount DOUBLE, province_id BIGINT, order_status STRING, user_id BIGINT, "
    "total_amount DOUBLE, activity_reduce_amount DOUBLE, coupon_reduce_amount DOUBLE, "
    "original_total_amount DOUBLE, feight_fee DOUBLE, feight_fee_reduce DOUBLE, "
    "expire_time STRING, refundable_time STRING, create_time STRING, operate_time STRING, "
    "create_date STRING, create_hour STRING, province_name STRING, province_area_code STRING, "
    "province_3166_2_code STRING, province_iso_code STRING, user_age INT, user_gender STRING, "
    "spu_id BIGINT, tm_id BIGINT, category3_id BIGINT, spu_name STRING, tm_name STRING, "
    "category3_name STRING"
)
PAYMENT_WIDE = _struct(
    "payment_id BIGINT, subject STRING, payment_type STRING, payment_create_time STRING, "
    "callback_time STRING, detail_id BIGINT, order_id BIGINT, sku_id BIGINT, "
    "order_price DOUBLE, sku_num BIGINT, sku_name STRING, province_id BIGINT, "
    "order_status STRING, user_id BIGINT, total_amount DOUBLE, activity_reduce_amount DOUBLE, "
    "coupon_reduce_amount DOUBLE, original_total_amount DOUBLE, feight_fee DOUBLE, "
    "split_feight_fee DOUBLE, split_activity_amount DOUBLE, split_coupon_amount DOUBLE, "
    "split_total_amount DOUBLE, order_create_time STRING, province_name STRING, "
    "province_area_code STRING, province_iso_code STRING, province_3166_2_code STRING, "
    "user_age INT, user_gender STRING, spu_id BIGINT, tm_id BIGINT, category3_id BIGINT, "
    "spu_name STRING, tm_name STRING, category3_name STRING"
)

# --- dimensions (every cell is stored as text) ---------------------------------------------

DIM_COLUMNS = {
    "DIM_USER_INFO": ["ID", "GENDER", "BIRTHDAY"],
    "DIM_BASE_PROVINCE": ["ID", "NAME", "AREA_CODE", "ISO_CODE", "ISO_3166_2"],
    "DIM_SKU_INFO": ["ID", "SKU_NAME", "CATEGORY3_ID", "SPU_ID", "TM_ID"],
    "DIM_SPU_INFO": ["ID", "SPU_NAME"],
    "DIM_BASE_TRADEMARK": ["ID", "TM_NAME"],
    "DIM_BASE_CATEGORY3": ["ID", "NAME"],
}

# --- themes --------------------------------------------------------------------------------

VISITOR_STATS = _struct(
    "stt STRING, edt STRING, vc STRING, ch STRING, ar STRING, is_new STRING, uv_ct BIGINT, "
    "pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT, ts BIGINT"
)
PRODUCT_STATS = _struct(
    "stt STRING, edt STRING, sku_id BIGINT, sku_name STRING, sku_price DOUBLE, spu_id BIGINT, "
    "spu_name STRING, tm_id BIGINT, tm_name STRING, category3_id BIGINT, "
    "category3_name STRING, display_ct BIGINT, click_ct BIGINT, favor_ct BIGINT, "
    "cart_ct BIGINT, order_sku_num BIGINT, order_amount DOUBLE, order_ct BIGINT, "
    "payment_amount DOUBLE, paid_order_ct BIGINT, refund_order_ct BIGINT, "
    "refund_amount DOUBLE, comment_ct BIGINT, good_comment_ct BIGINT, ts BIGINT"
)

# --- small records -------------------------------------------------------------------------

ACTION = _struct("userId BIGINT, action STRING")
JOIN_ONE = _struct("id STRING, name STRING, ts BIGINT")
JOIN_TWO = _struct("id STRING, sex STRING, ts BIGINT")
_LINK = _struct("linkId STRING, price DOUBLE")
_ITEM = _struct("orderItemId STRING, price DOUBLE").add("itemLinkIds", _LINK)
ORDER_TABLE_JSON = _struct("transactionId STRING, orderTime TIMESTAMP").add("orderItems", _ITEM)
ORDER_TABLE = _struct("transactionId STRING, orderTime TIMESTAMP, promiseTime TIMESTAMP")
