"""Schemas of the feeds, facts and metric tables.

The column lists below are fixed values: names and order are part of the
data contract between the jobs.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names.split()]


TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# --- application log -------------------------------------------------------
COMMON = T.StructType(_strings("mid is_new vc ch ar uid ba md os"))
PAGE = T.StructType(
    _strings("page_id last_page_id item item_type source_type")
    + [T.StructField("during_time", T.LongType())]
)
CORRUPT = "_corrupt"
LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", T.StringType()),
        T.StructField("displays", T.ArrayType(TEXT_MAP)),
        T.StructField("actions", T.ArrayType(TEXT_MAP)),
        T.StructField("err", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

# --- row changes -----------------------------------------------------------
CHANGE = T.StructType(
    _strings("database table type ts")
    + [T.StructField("data", TEXT_MAP), T.StructField("old", TEXT_MAP)]
)
ROUTING = T.StructType(_strings("source_table sink_table sink_columns sink_pk sink_extend"))
DICTIONARY = T.StructType(
    _strings("dic_code dic_name parent_code")
    + [T.StructField("create_time", T.TimestampType()), T.StructField("operate_time", T.TimestampType())]
)

# --- keys read from the `data` map of each table ---------------------------
ORDER_DETAIL_KEYS = (
    "id order_id sku_id sku_name order_price sku_num create_time source_type source_id "
    "split_total_amount split_activity_amount split_coupon_amount"
).split()
ORDER_INFO_KEYS = (
    "id consignee consignee_tel total_amount order_status user_id payment_way delivery_address "
    "order_comment out_trade_no trade_body create_time operate_time expire_time process_status "
    "tracking_no parent_order_id province_id activity_reduce_amount coupon_reduce_amount "
    "original_total_amount feight_fee feight_fee_reduce refundable_time"
).split()
ACTIVITY_KEYS = "id order_id order_detail_id activity_id activity_rule_id sku_id create_time".split()
COUPON_KEYS = "id order_id order_detail_id coupon_id coupon_use_id sku_id create_time".split()
CART_KEYS = (
    "id user_id sku_id cart_price sku_num sku_name is_checked create_time operate_time is_ordered "
    "order_time source_type source_id"
).split()

# --- facts -----------------------------------------------------------------
ORDER_WIDE = (
    "id order_id sku_id sku_name order_price sku_num create_time source_type_id source_type_name source_id "
    "split_total_amount split_activity_amount split_coupon_amount consignee consignee_tel total_amount "
    "order_status user_id payment_way delivery_address order_comment out_trade_no trade_body operate_time "
    "expire_time process_status tracking_no parent_order_id province_id activity_reduce_amount "
    "coupon_reduce_amount original_total_amount feight_fee feight_fee_reduce refundable_time "
    "order_detail_activity_id activity_id activity_rule_id order_detail_coupon_id coupon_id coupon_use_id "
    "type old row_op_ts"
).split()
ORDER_DETAIL = (
    "id order_id user_id sku_id sku_name sku_num order_price province_id activity_id activity_rule_id "
    "coupon_id create_time source_id source_type_id source_type_name split_activity_amount "
    "split_coupon_amount split_total_amount row_op_ts"
).split()
CANCEL_DETAIL = (
    "id order_id user_id sku_id sku_name province_id activity_id activity_rule_id coupon_id cancel_time "
    "source_id source_type_id source_type_name sku_num order_price split_activity_amount "
    "split_coupon_amount split_total_amount"
).split()
PAY_DETAIL = (
    "order_detail_id order_id user_id sku_id sku_name province_id activity_id activity_rule_id coupon_id "
    "payment_type_code payment_type_name callback_time source_id source_type_id source_type_name sku_num "
    "order_price split_activity_amount split_coupon_amount split_payment_amount row_op_ts"
).split()
REFUND_DETAIL = (
    "id user_id order_id sku_id province_id date_id create_time refund_type_code refund_type_name "
    "refund_reason_type_code refund_reason_type_name refund_reason_txt refund_num refund_amount ts row_op_ts"
).split()
REFUND_PAID = (
    "id user_id order_id sku_id province_id payment_type_code payment_type_name date_id callback_time "
    "refund_num refund_amount ts row_op_ts"
).split()
CART_ADD = (
    "id user_id sku_id cart_price sku_num sku_name is_checked create_time operate_time is_ordered order_time "
    "source_type_id source_type_name source_id"
).split()

# --- window metrics, in sink column order (`ts` is stamped by the sink) ----
_CATEGORY = "category1_id category1_name category2_id category2_name category3_id category3_name"
METRICS = {
    "cart_add_uu": "stt edt cart_add_uu_ct".split(),
    "order": (
        "stt edt order_unique_user_count order_new_user_count order_activity_reduce_amount "
        "order_coupon_reduce_amount order_origin_total_amount"
    ).split(),
    "payment_suc": "stt edt payment_suc_unique_user_count payment_suc_new_user_count".split(),
    "province_order": "stt edt province_id province_name order_count order_amount".split(),
    "refund": f"stt edt trademark_id trademark_name {_CATEGORY} user_id refund_count".split(),
    "user_spu_order": (
        f"stt edt trademark_id trademark_name {_CATEGORY} user_id spu_id spu_name order_count order_amount"
    ).split(),
    "page_view": "stt edt home_uv_ct good_detail_uv_ct".split(),
    "keyword": "stt edt source keyword keyword_count".split(),
    "traffic": "stt edt vc ch ar is_new uv_ct sv_ct pv_ct dur_sum uj_ct".split(),
    "login": "stt edt back_ct uu_ct".split(),
    "register": "stt edt register_ct".split(),
}
