"""Independent SQL for each query of `catalog`, run by DuckDB over the same tables."""

from __future__ import annotations

# --- shared views ----------------------------------------------------------
_TRAFFIC = """
raw as (select *, cast(json_extract(props, '$.k') as int) as k from events),
logs as (
  select event_id, event_type, ts as rt, epoch_us(ts) // 1000 as ts, k,
    strftime(ts, '%Y-%m-%d') as dt,
    cast(user_id as varchar) as mid,
    case when k % 2 = 0 then '1' else '0' end as is_new,
    'v' || (user_id % 3) as vc, 'ch' || (event_id % 5) as ch, 'ar' || (user_id % 7) as ar,
    case when event_id % 5 = 0 then null else cast(user_id as varchar) end as uid,
    case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'purchase' then 'trade'
      when 'signup' then 'login' else 'search' end as page_id,
    case event_id % 4 when 1 then 'login' when 2 then 'search' when 3 then 'home' end as last_page_id,
    case when k % 10 = 9 then null else event_type || ' Brand' || (k % 7) || ' k' || k end as item,
    case when event_id % 4 = 2 and k % 3 <> 0 then 'keyword' else 'sku_id' end as item_type,
    cast(round(value * 1000) as bigint) as during_time,
    case when event_id % 11 = 0 then '{"entry":"icon","loading_time":' || k || '}' end as start,
    case when event_type = 'error' then '{"error_code":' || k || '}' end as err,
    cast(k % 3 as bigint) as n_displays, cast(k % 4 as bigint) as n_actions,
    event_id % 97 = 0 as broken
  from raw),
good as (select * from logs where not broken),
fixed as (
  select * replace (case when is_new = '1' and dt <> first_dt then '0' else is_new end as is_new)
  from (select *, first_value(case when is_new = '1' then dt else strftime(rt - interval 1 day, '%Y-%m-%d') end)
          over (partition by mid order by ts) as first_dt from good)),
fixed_all as (
  select * replace (case when is_new = '1' and dt <> first_dt then '0' else is_new end as is_new)
  from (select *, first_value(case when is_new = '1' then dt else strftime(rt - interval 1 day, '%Y-%m-%d') end)
          over (partition by mid order by ts) as first_dt from logs)),
visitors as (
  select * from (select *, lag(dt) over (partition by mid order by ts) as was from logs where last_page_id is null)
  where was is distinct from dt),
jumps as (
  select * from (
    select *, lead(ts) over w as next_ts, lead(last_page_id) over w as next_last
    from logs window w as (partition by mid order by ts))
  where last_page_id is null and (next_ts is null or next_ts - ts >= 21600000 or next_last is null)),
kinds as (
  select * from (select *, lag(dt) over (partition by mid, page_id order by ts) as was
    from logs where page_id in ('home', 'good_detail'))
  where was is distinct from dt),
logins as (
  select *, case when was is not null and date_diff('day', cast(was as date), cast(dt as date)) >= 2
    then 1 else 0 end as back
  from (select *, lag(dt) over (partition by uid order by ts) as was
    from logs where uid is not null and (last_page_id is null or last_page_id = 'login'))
  where was is distinct from dt)
"""

_LOG_COLS = "mid, is_new, vc, ch, ar, uid, page_id, last_page_id, item, item_type, during_time"
_COMMON_JSON = (
    """'{"mid":"' || mid || '","is_new":"' || is_new || '","vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar || '"'"""
    """ || case when uid is null then '' else ',"uid":"' || uid || '"' end || '}'"""
)


def _t(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def _dec(x: str) -> str:
    return f"cast(cast({x} as decimal(18,2)) as varchar)"


_DIC = """
dic as (select distinct o_orderpriority[1:1] as dic_code, o_orderpriority[3:] as dic_name
  from orders where o_orderpriority[1:1] <> '4')
"""

_CHANGES = f"""
e as (select *, cast(json_extract(props, '$.k') as int) as k, {_t('ts')} as clock,
    cast(cast(floor(epoch(ts)) as bigint) as varchar) as chg from events),
o as (
  select *, cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as user_id,
    cast(o_custkey % 26 as varchar) as province_id, made + to_seconds(600 + o_orderkey % 3600) as later
  from (select *, timestamp '2024-01-01' + to_seconds(
          (date_diff('day', date '1995-01-01', cast(o_orderdate as date)) % 30) * 86400 + (o_orderkey * 37) % 86400)
        as made from orders)),
l as (
  select *, l_orderkey || '-' || l_linenumber as id, cast(l_orderkey as varchar) as order_id,
    cast(l_partkey as varchar) as sku_id, cast(cast(l_quantity as int) as varchar) as sku_num,
    {_dec('l_extendedprice')} as price, made + to_seconds(900 + l_orderkey % 3600) as later
  from (select *, timestamp '2024-01-01' + to_seconds(
          (date_diff('day', date '1995-01-01', cast(l_shipdate as date)) % 30) * 86400
          + (l_orderkey * 37 + l_linenumber * 11) % 86400) as made from lineitem)),
{_DIC}
"""

_TRADE = f"""
{_CHANGES},
oi as (
  select order_id, user_id, province_id, 'user' || user_id as consignee, {_dec('o_totalprice')} as total_amount,
    o_orderpriority as order_comment, status as order_status, operated as operate_time, type, was as old, op
  from (
    select *, '1001' as status, cast(null as varchar) as operated, 'insert' as type, cast(null as varchar) as was, made as op from o
    union all
    select *, case o_orderstatus when 'F' then '1003' when 'P' then '1005' else '1002' end, {_t('later')}, 'update', '1001', later from o
    union all
    select *, '1006', {_t('later')}, 'update', '1005', later + to_seconds(60) from o
    where o_orderstatus = 'P' and o_orderkey % 2 = 0)),
act as (
  select * from (select id as line, made as act_made, 'a' || id as order_detail_activity_id, cast(l_partkey % 10 as varchar) as activity_id,
      cast(l_partkey % 4 as varchar) as activity_rule_id,
      row_number() over (partition by id order by made desc, cast(l_partkey % 10 as varchar) desc,
        cast(l_partkey % 4 as varchar) desc) as rn
    from l where l_discount > 0.05) where rn = 1),
cou as (
  select * from (select id as line, made as cou_made, 'c' || id as order_detail_coupon_id, cast(l_suppkey % 8 as varchar) as coupon_id,
      cast(l_suppkey as varchar) as coupon_use_id,
      row_number() over (partition by id order by made desc, cast(l_suppkey % 8 as varchar) desc,
        cast(l_suppkey as varchar) desc) as rn
    from l where l_tax > 0.04) where rn = 1),
wide as (
  select l.id, l.order_id, l.sku_id, 'sku ' || l.sku_id as sku_name, l.price as order_price, l.sku_num,
    {_t('l.made')} as create_time, cast(1 + l_partkey % 5 as varchar) as source_type_id, dic_name as source_type_name,
    cast(l_suppkey as varchar) as source_id, l.price as split_total_amount,
    case when l_discount > 0.05 then cast(cast(round(l_discount * 100) as int) as varchar) end as split_activity_amount,
    case when l_tax > 0.04 then cast(cast(round(l_tax * 100) as int) as varchar) end as split_coupon_amount,
    consignee, cast(null as varchar) as consignee_tel, total_amount, order_status, oi.user_id,
    cast(null as varchar) as payment_way, cast(null as varchar) as delivery_address, order_comment,
    cast(null as varchar) as out_trade_no, cast(null as varchar) as trade_body, operate_time,
    cast(null as varchar) as expire_time, cast(null as varchar) as process_status, cast(null as varchar) as tracking_no,
    cast(null as varchar) as parent_order_id, oi.province_id, cast(null as varchar) as activity_reduce_amount,
    cast(null as varchar) as coupon_reduce_amount, total_amount as original_total_amount,
    cast(null as varchar) as feight_fee, cast(null as varchar) as feight_fee_reduce,
    cast(null as varchar) as refundable_time, order_detail_activity_id, activity_id, activity_rule_id,
    order_detail_coupon_id, coupon_id, coupon_use_id, type, old, {_t('greatest(l.made, oi.op)')} as row_op_ts
  from l join dic on cast(1 + l_partkey % 5 as varchar) = dic_code
    left join act on l.id = act.line left join cou on l.id = cou.line join oi on l.order_id = oi.order_id),
det as (
  select id, order_id, user_id, sku_id, sku_name, sku_num, order_price, province_id, activity_id, activity_rule_id,
    coupon_id, create_time, source_id, source_type_id, source_type_name, split_activity_amount, split_coupon_amount,
    split_total_amount, row_op_ts
  from wide where type = 'insert'),
paid as (
  select det.id as order_detail_id, det.order_id, det.user_id, sku_id, sku_name, det.province_id, activity_id,
    activity_rule_id, coupon_id, cast(1 + o_orderkey % 5 as varchar) as payment_type_code,
    dic_name as payment_type_name, {_t('later')} as callback_time, source_id, source_type_id, source_type_name,
    sku_num, order_price, split_activity_amount, split_coupon_amount,
    split_total_amount as split_payment_amount, row_op_ts
  from det join o on det.order_id = o.order_id and o_orderstatus = 'O' and o_orderkey % 9 <> 0
    join dic on cast(1 + o_orderkey % 5 as varchar) = dic_code),
refunds as (
  select 'r' || l.id || '-' || l_partkey || '-' || l_suppkey as id, cast(l_orderkey % 1000 as varchar) as user_id,
    l.order_id, sku_id, o.province_id, strftime(l.later, '%Y-%m-%d') as date_id, {_t('l.later')} as create_time,
    a.dic_code as refund_type_code, a.dic_name as refund_type_name, b.dic_code as refund_reason_type_code,
    b.dic_name as refund_reason_type_name, l_linestatus as refund_reason_txt, sku_num as refund_num,
    price as refund_amount, cast(cast(epoch(l.later) as bigint) as varchar) as ts,
    {_t('greatest(l.later, o.later)')} as row_op_ts
  from l join o on l.order_id = o.order_id and o_orderstatus = 'P'
    join dic a on cast(1 + l_linenumber % 5 as varchar) = a.dic_code
    join dic b on cast(1 + l_partkey % 5 as varchar) = b.dic_code
  where l_returnflag = 'R'),
first_lines as (
  select * from (select *, strptime(create_time, '%Y-%m-%d %H:%M:%S') as rt, row_number() over (
      partition by id order by row_op_ts, create_time, sku_id, sku_num, order_price) as rn from det) where rn = 1),
last_lines as (
  select * from (select *, strptime(create_time, '%Y-%m-%d %H:%M:%S') as rt, row_number() over (
      partition by id order by row_op_ts desc, create_time desc, sku_id desc, sku_num desc, order_price desc) as rn
    from det) where rn = 1),
buyers as (
  select *, case when was is distinct from create_time[1:10] then 1 else 0 end as uniq,
    case when was is null then 1 else 0 end as fresh
  from (select *, lag(create_time[1:10]) over (partition by user_id order by create_time, id) as was from first_lines)),
payers as (
  select * from (
    select *, strptime(callback_time, '%Y-%m-%d %H:%M:%S') as rt,
      lag(callback_time[1:10]) over (partition by user_id order by callback_time, order_detail_id) as was
    from (select *, row_number() over (partition by order_detail_id
        order by row_op_ts desc, callback_time desc, sku_id desc, sku_num desc) as rn from paid) where rn = 1)
  where was is distinct from callback_time[1:10]),
sku as (select cast(p_partkey as varchar) as sku_id, cast(p_partkey % 50 as varchar) as spu_id,
  split_part(p_brand, '#', 2) as trademark_id, p_brand as trademark_name,
  'spu ' || (p_partkey % 50) as spu_name, cast(n_nationkey as varchar) as category3_id, 'c3 ' || n_name as category3_name,
  cast(r_regionkey as varchar) as category2_id, 'c2 ' || r_name as category2_name,
  cast(r_regionkey % 2 as varchar) as category1_id, 'c1 ' || (r_regionkey % 2) as category1_name
  from part join nation on n_nationkey = p_partkey % 25 join region on r_regionkey = n_regionkey),
prov as (select cast(n_nationkey as varchar) as province_id, n_name as province_name from nation),
carts as (
  select cast(event_id as varchar) as id, cast(user_id as varchar) as user_id, cast(k as varchar) as sku_id,
    {_dec('value')} as cart_price,
    case when event_type = 'click' then cast(k % 5 + 1 as varchar)
      else cast(k % 5 + 1 - user_id % 6 as varchar) end as sku_num,
    'sku ' || k as sku_name, cast(null as varchar) as is_checked, clock as create_time,
    case when event_type = 'purchase' then {_t('ts + to_seconds(30)')} end as operate_time,
    cast(null as varchar) as is_ordered, cast(null as varchar) as order_time, dic_code as source_type_id,
    dic_name as source_type_name, cast(event_id % 10 as varchar) as source_id
  from e join dic on cast(1 + k % 5 as varchar) = dic_code
  where event_type = 'click' or (event_type = 'purchase' and k % 7 <> 0 and k % 5 + 1 > user_id % 6)),
cart_users as (
  select id, user_id, clock as cart_time, clock[1:10] as day from (
    select *, lag(clock[1:10]) over (partition by user_id order by clock, id) as was
    from (select *, coalesce(operate_time, create_time) as clock from carts))
  where was is distinct from clock[1:10]),
regs as (
  select cast(c_custkey as varchar) as user_id, timestamp '2024-01-01' + to_seconds((c_custkey * 977) % 2592000) as rt
  from customer)
"""


def _win(unit: str, col: str = "rt") -> str:
    start = f"date_trunc('{unit}', {col})"
    return f"{_t(start)} as stt, {_t(f'{start} + interval 1 {unit}')} as edt"


def _big(x: str) -> str:
    return f"cast({x} as bigint)"


def _amt(x: str) -> str:
    return f"round(cast(sum(cast({x} as decimal(18,2))) as double), 2)"


_CAT = "category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"

_METRICS = f"""
{_TRAFFIC}, {_TRADE},
win_cart_uu as (
  select {_win('hour')}, {_big('count(*)')} as cart_add_uu_ct
  from (select strptime(cart_time, '%Y-%m-%d %H:%M:%S') as rt from cart_users) group by 1, 2),
win_order as (
  select {_win('hour')}, {_big('sum(uniq)')} as order_unique_user_count, {_big('sum(fresh)')} as order_new_user_count,
    {_amt("coalesce(split_activity_amount, '0')")} as order_activity_reduce_amount,
    {_amt("coalesce(split_coupon_amount, '0')")} as order_coupon_reduce_amount,
    {_amt("cast(sku_num as int) * cast(order_price as decimal(18,2))")} as order_origin_total_amount
  from buyers group by 1, 2),
win_payment as (
  select {_win('hour')}, {_big('count(*)')} as payment_suc_unique_user_count,
    {_big('count(*)')} as payment_suc_new_user_count from payers where was is null group by 1, 2),
win_payment_returning as (
  select {_win('hour')}, {_big('count(*)')} as payment_suc_unique_user_count,
    {_big('sum(case when was is null then 1 else 0 end)')} as payment_suc_new_user_count from payers group by 1, 2),
win_province as (
  select stt, edt, province_id, province_name, order_count, order_amount from (
    select {_win('hour')}, province_id, {_big('count(distinct order_id)')} as order_count,
      {_amt('split_total_amount')} as order_amount
    from last_lines group by 1, 2, 3) join prov using (province_id)),
win_refund as (
  select {_win('day')}, trademark_id, trademark_name, {_CAT}, user_id, {_big('count(distinct order_id)')} as refund_count
  from (select *, strptime(create_time, '%Y-%m-%d %H:%M:%S') as rt from refunds) join sku using (sku_id)
  group by all),
win_user_spu as (
  select {_win('day')}, trademark_id, trademark_name, {_CAT}, user_id, spu_id, spu_name,
    {_big('count(distinct order_id)')} as order_count, {_amt('split_total_amount')} as order_amount
  from first_lines join sku using (sku_id) group by all),
win_page_uv as (
  select {_win('hour')}, {_big("sum(case when page_id = 'home' then 1 else 0 end)")} as home_uv_ct,
    {_big("sum(case when page_id = 'good_detail' then 1 else 0 end)")} as good_detail_uv_ct from kinds group by 1, 2),
words as (
  select rt, unnest(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')) as keyword from logs
  where last_page_id = 'search' and item_type = 'keyword' and item is not null),
win_keyword as (
  select {_win('hour')}, 'search' as source, keyword, {_big('count(*)')} as keyword_count from words group by all),
win_traffic as (
  select {_win('hour')}, vc, ch, ar, is_new, {_big('sum(uv)')} as uv_ct, {_big('sum(sv)')} as sv_ct,
    {_big('sum(pv)')} as pv_ct, {_big('sum(dur)')} as dur_sum, {_big('sum(uj)')} as uj_ct
  from (
    select rt, vc, ch, ar, is_new, 0 as uv, case when last_page_id is null then 1 else 0 end as sv, 1 as pv,
      during_time as dur, 0 as uj from logs
    union all select rt, vc, ch, ar, is_new, 1, 0, 0, 0, 0 from visitors
    union all select rt, vc, ch, ar, is_new, 0, 0, 0, 0, 1 from jumps)
  group by all),
win_login as (
  select {_win('hour')}, {_big('sum(back)')} as back_ct, {_big('count(*)')} as uu_ct from logins group by 1, 2),
win_register as (select {_win('hour')}, {_big('count(*)')} as register_ct from regs group by 1, 2),
d_order as (select * from win_order where stt like '2024-01-10%'),
d_spu as (select * from win_user_spu where stt like '2024-01-10%'),
d_refund as (select * from win_refund where stt like '2024-01-10%'),
d_prov as (select * from win_province where stt like '2024-01-10%'),
d_traffic as (select * from win_traffic where stt like '2024-01-10%'),
d_pay as (select * from win_payment where stt like '2024-01-10%')
"""

ORACLE: dict[str, str] = {}


def _traffic(name: str, sql: str) -> None:
    ORACLE[name] = f"with {_TRAFFIC} {sql}"


def _trade(name: str, sql: str) -> None:
    ORACLE[name] = f"with {_TRADE} {sql}"


def _changes(name: str, sql: str) -> None:
    ORACLE[name] = f"with {_CHANGES} {sql}"


def _metric(name: str, sql: str | None = None) -> None:
    ORACLE[name] = f"with {_METRICS} {sql or f'select * from {name}'}"


# --- log -------------------------------------------------------------------
_traffic("log_parse_clean", f"select {_LOG_COLS}, start, err, n_displays, n_actions, ts from good")
_traffic("log_parse_dirty", """select '{"broken":' || event_id as value from logs where broken""")
_traffic("log_split_page", f"select {_LOG_COLS}, ts from fixed where start is null")
_traffic("log_split_start", "select mid, is_new, vc, ch, ar, uid, start, ts from fixed where start is not null")
_traffic(
    "log_split_display",
    f"""select {_COMMON_JSON} as common, page_id, ts, 'sku' || i as item, cast(i as varchar) as pos
    from (select *, unnest(range(1, n_displays + 1)) as i from fixed where start is null)""",
)
_traffic(
    "log_split_action",
    f"""select {_COMMON_JSON} as common, page_id, ts + i as ts, 'sku' || i as item, 'act' as action_id
    from (select *, unnest(range(1, n_actions + 1)) as i from fixed where start is null)""",
)
_traffic("log_split_error", f"select {_LOG_COLS}, start, err, n_displays, n_actions, ts from fixed where err is not null")

# --- keyed rules -----------------------------------------------------------
_traffic("is_new_repair", "select event_id, mid, is_new, vc, ch, ar, uid from fixed_all")
_traffic("daily_unique_visitor", "select event_id, mid from visitors")
_traffic("bounce_detail", "select event_id, mid from jumps")
_traffic("page_kind_uv", "select event_id, mid, page_id from kinds")
_traffic("login_back_user", f"select event_id, uid, dt as day, {_big('back')} as back from logins")
_traffic(
    "dedup_first_ttl",
    """select event_id, mid from (select *, lag(ts) over (partition by mid order by ts) as was from logs)
    where was is null or ts - was >= 21600000""",
)
_trade("cart_unique_user", "select id, user_id, cart_time, day from cart_users")
_trade(
    "order_user_flags",
    f"""select id, user_id, create_time, create_time[1:10] as day, {_big('uniq')} as unique_user,
    {_big('fresh')} as new_user from buyers""",
)
_trade("payment_user_flags", "select order_detail_id, user_id, callback_time from payers where was is null")
_trade("dedup_first", "select id, create_time, sku_id, sku_num, order_price from first_lines")
_trade("dedup_last", "select id, create_time, sku_id, sku_num, order_price from last_lines")

# --- row changes -----------------------------------------------------------
_ROUTES = """
all_changes as (
  select 'order_info' as tab, 'insert' as type, order_id as id from o
  union all select 'order_info', 'update', order_id from o
  union all select 'order_info', 'update', order_id from o where o_orderstatus = 'P' and o_orderkey % 2 = 0
  union all select 'order_detail', 'insert', id from l
  union all select 'order_detail_activity', 'insert', 'a' || id from l where l_discount > 0.05
  union all select 'order_detail_coupon', 'insert', 'c' || id from l where l_tax > 0.04
  union all select 'payment_info', 'update', order_id from o where o_orderstatus = 'O'
  union all select 'order_refund_info', 'insert', 'r' || id || '-' || l_partkey || '-' || l_suppkey from l where l_returnflag = 'R'
  union all select 'refund_payment', 'update', 'p' || id || '-' || l_partkey || '-' || l_suppkey from l
    where l_returnflag = 'R' and l_suppkey % 2 = 0
  union all select 'cart_info', case event_type when 'click' then 'insert' else 'update' end, cast(event_id as varchar)
    from e where event_type in ('click', 'purchase')
  union all select 'coupon_use', case event_type when 'view' then 'insert' else 'update' end, cast(event_id as varchar)
    from e where event_type in ('view', 'signup', 'error')
  union all select 'favor_info', case event_type when 'view' then 'insert' else 'update' end, cast(event_id as varchar)
    from e where event_type in ('view', 'click')
  union all select 'comment_info', 'insert', cast(event_id as varchar) from e where event_type = 'purchase'
  union all select 'user_info', 'insert', cast(c_custkey as varchar) from customer
  union all select 'sku_info', 'bootstrap-insert', cast(p_partkey as varchar) from part
  union all select 'sku_info', 'update', cast(p_partkey as varchar) from part where p_size > 40
  union all select distinct 'spu_info', 'insert', cast(p_partkey % 50 as varchar) from part
  union all select 'base_trademark', 'insert', split_part(p_brand, '#', 2) from part
  union all select 'base_category3', 'insert', cast(n_nationkey as varchar) from nation
  union all select 'base_category2', 'insert', cast(r_regionkey as varchar) from region
  union all select distinct 'base_category1', 'insert', cast(r_regionkey % 2 as varchar) from region
  union all select 'base_province', 'insert', cast(n_nationkey as varchar) from nation)
"""
_changes(
    "cdc_route",
    f""", {_ROUTES} select tab as "table", type, {_big('count(*)')} as n, {_big('count(distinct id)')} as ids
    from all_changes group by all""",
)
_changes(
    "cdc_changed_to",
    f"""select order_id as id, user_id, '1003' as order_status, {_t('later')} as operate_time, '1001' as old_status
    from o where o_orderstatus = 'F'""",
)
_COUPON = (
    "cast(event_id as varchar) as id, cast(k % 8 as varchar) as coupon_id, cast(user_id as varchar) as user_id, "
    "cast(event_id % 1000 as varchar) as order_id, clock[1:10] as date_id"
)
_changes(
    "cdc_transition",
    f"select {_COUPON}, clock as order_time, chg as ts from e where event_type = 'signup' and event_id % 3 <> 0",
)
_changes("cdc_coupon_pay", f"select {_COUPON}, clock as payment_time, chg as ts from e where event_type = 'error'")
_changes(
    "cdc_coupon_pay_strict",
    f"select {_COUPON}, clock as payment_time, chg as ts from e where event_type = 'error' and event_id % 3 = 0",
)
_changes(
    "cdc_coupon_get",
    f"select * exclude (order_id) from (select {_COUPON}, clock as get_time, chg as ts from e where event_type = 'view')",
)
_changes(
    "cdc_favor",
    """select cast(event_id as varchar) as id, cast(user_id as varchar) as user_id, cast(k as varchar) as sku_id,
    clock[1:10] as date_id, clock as create_time, chg as ts
    from e where event_type = 'view' or (event_type = 'click' and k % 2 = 0)""",
)
_changes(
    "comment_fact",
    """select cast(event_id as varchar) as id, cast(user_id as varchar) as user_id, cast(k as varchar) as sku_id,
    cast(event_id % 1000 as varchar) as order_id, clock[1:10] as date_id, clock as create_time,
    dic_code as appraise_code, dic_name as appraise_name, chg as ts
    from e join dic on cast(1 + k % 5 as varchar) = dic_code where event_type = 'purchase'""",
)
_trade("cdc_cart_delta", "select * from carts")
_trade(
    "user_register",
    f"""select user_id, strftime(rt, '%Y-%m-%d') as date_id, {_t('rt')} as create_time,
    cast(cast(epoch(rt) as bigint) as varchar) as ts from regs""",
)
_trade("order_wide", "select * from wide")
_trade("order_detail", "select * from det")
_trade(
    "order_cancel",
    """select id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
    operate_time as cancel_time, source_id, source_type_id, source_type_name, sku_num, order_price,
    split_activity_amount, split_coupon_amount, split_total_amount
    from wide where type = 'update' and order_status = '1003'""",
)
_trade("pay_detail", "select * from paid")
_trade("refund_detail", "select * from refunds")
_trade(
    "refund_paid",
    f"""select 'p' || l.id || '-' || l_partkey || '-' || l_suppkey as id, o.user_id, l.order_id, l.sku_id,
    o.province_id, dic_code as payment_type_code, dic_name as payment_type_name,
    strftime(l.later + to_seconds(120), '%Y-%m-%d') as date_id, {_t('l.later + to_seconds(120)')} as callback_time,
    q.refund_num, l.price as refund_amount,
    cast(cast(epoch(l.later + to_seconds(120)) as bigint) as varchar) as ts,
    {_t('greatest(l.later + to_seconds(120), o.later + to_seconds(60))')} as row_op_ts
    from l join o on l.order_id = o.order_id and o_orderstatus = 'P' and o_orderkey % 2 = 0
      join dic on cast(1 + l_suppkey % 5 as varchar) = dic_code
      join (select order_id, sku_id, sku_num as refund_num, row_number() over (
          partition by id, l_partkey, l_suppkey order by later desc, sku_num desc) as rn from l where l_returnflag = 'R') q
        on q.order_id = l.order_id and q.sku_id = l.sku_id and q.rn = 1
    where l_returnflag = 'R' and l_suppkey % 2 = 0""",
)

# --- dimensions ------------------------------------------------------------
_changes(
    "dim_route",
    f""", {_ROUTES}, cfg as (select * from (values
      ('sku_info', 'dim_sku_info', 'category3_id,id,sku_name,spu_id,tm_id'),
      ('spu_info', 'dim_spu_info', 'id,spu_name'), ('base_trademark', 'dim_base_trademark', 'id,tm_name'),
      ('base_category3', 'dim_base_category3', 'category2_id,id,name'),
      ('base_category2', 'dim_base_category2', 'category1_id,id,name'),
      ('base_category1', 'dim_base_category1', 'id,name'), ('base_province', 'dim_base_province', 'id,name'))
      t(tab, sink_table, kept))
    select sink_table, a.id as pk, a.type, kept,
      case when a.type = 'update' then cast(cast(epoch(timestamp '2024-01-01') as bigint) + p_size as varchar)
        else cast(cast(epoch(timestamp '2024-01-01') as bigint) as varchar) end as ts
    from all_changes a join cfg on a.tab = cfg.tab
      left join part on a.tab = 'sku_info' and a.id = cast(p_partkey as varchar)""",
)
ORACLE["dim_prune"] = """
select cast(p_partkey as varchar) as id, p_name as sku_name, cast(null as varchar) as sku_desc,
  split_part(p_brand, '#', 2) as tm_id, 'bootstrap-insert' as type from part
union all
select cast(p_partkey as varchar), p_name || ' new', null, split_part(p_brand, '#', 2), 'update' from part where p_size > 40
"""
ORACLE["dim_upsert_latest"] = """
select 'dim_sku_info' as sink_table, cast(p_partkey as varchar) as pk,
  case when p_size > 40 then p_name || ' new' else p_name end as name from part
union all select distinct 'dim_spu_info', cast(p_partkey % 50 as varchar), 'spu ' || (p_partkey % 50) from part
union all select distinct 'dim_base_trademark', split_part(p_brand, '#', 2), p_brand from part
union all select 'dim_base_category3', cast(n_nationkey as varchar), 'c3 ' || n_name from nation
union all select 'dim_base_category2', cast(r_regionkey as varchar), 'c2 ' || r_name from region
union all select distinct 'dim_base_category1', cast(r_regionkey % 2 as varchar), 'c1 ' || (r_regionkey % 2) from region
union all select 'dim_base_province', cast(n_nationkey as varchar), n_name from nation
"""
for _kind, _join in (("inner", "join"), ("left", "left join")):
    ORACLE[f"dim_enrich_{_kind}"] = f"""
    select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as user_id,
      cast(o_custkey % 26 as varchar) as province_id, n_name as province_name
    from orders {_join} nation on n_nationkey = o_custkey % 26"""
_trade(
    "dim_snowflake",
    f"""select id, sku_id, cast(l_suppkey as varchar) as source_id, {_t('made')} as create_time, spu_id, trademark_id,
    category3_id, spu_name, trademark_name, category3_name, category2_id, category2_name, category1_id, category1_name
    from l join sku using (sku_id)""",
)
ORACLE["interval_join"] = """
select c.user_id, c.event_id as click_id, b.event_id as buy_id
from events c join events b on c.user_id = b.user_id and c.event_type = 'click' and b.event_type = 'purchase'
  and b.ts between c.ts - interval 1 hour and c.ts + interval 1 hour
"""
ORACLE["lookup_join"] = f"""
with {_DIC}
select event_id, cast(user_id as varchar) as "user", value, dic_name from events join dic on cast(user_id as varchar) = dic_code
"""
ORACLE["word_count"] = """
select lang, word, cast(count(*) as bigint) as n
from (select lang, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as word from documents) group by all
"""

ORACLE["dictionary_words"] = """
with runs as materialized (
  select doc_id, lang, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as run from documents),
lexicon as materialized (
  select run as word from (select distinct doc_id, run from runs where length(run) between 2 and 12)
  group by run having count(*) * 50 >= (select count(*) from documents)),
own as materialized (select run, unnest(range(1, length(run) + 1)) as a from (select distinct run from runs)),
tried as (select run, a, unnest(range(2, 13)) as n from own),
found as materialized (
  select run, a, n, substr(run, a, n) as word from tried where a + n - 1 <= length(run) and substr(run, a, n) in (from lexicon)),
covered as (select distinct run, unnest(range(a, a + n)) as a from found),
cut as (
  select run, word from found
  union all select run, substr(run, a, 1) from own anti join covered using (run, a)),
counted as (select lang, run, count(*) as times from runs group by all),
per as (select run, word, count(*) as times from cut group by all)
select lang, word, cast(sum(counted.times * per.times) as bigint) as n from counted join per using (run) group by all
"""

# --- window metrics --------------------------------------------------------
for _name in (
    "win_cart_uu win_order win_payment win_payment_returning win_province win_refund win_user_spu win_page_uv "
    "win_keyword win_traffic win_login win_register"
).split():
    _metric(_name)
ORACLE["win_ten_seconds"] = f"""
select {_t('b')} as stt, {_t('b + interval 10 second')} as edt, event_type, {_big('count(*)')} as n,
  {_amt('value')} as total
from (select *, time_bucket(interval 10 second, ts) as b from events) group by b, event_type
"""

# --- reports ---------------------------------------------------------------
for _name, _col, _rate in (
    ("rep_activity_subsidy", "activity_reduce_amount", "subsidy_rate"),
    ("rep_coupon_subsidy", "coupon_reduce_amount", "coupon_subsidy_rate"),
):
    _metric(
        _name,
        f"""select {_col}, origin_total_amount, round({_col} / nullif(origin_total_amount, 0), 20) as {_rate}
        from (select {_amt(f'order_{_col}')} as {_col}, {_amt('order_origin_total_amount')} as origin_total_amount
          from d_order having count(*) > 0)""",
    )
_metric(
    "rep_top_trademarks",
    f"""select trademark_name, {_amt('order_amount')} as order_amount from d_spu group by 1
    order by order_amount desc, trademark_name limit 5""",
)


def _sides(ids: str, names: str) -> str:
    shown = ", ".join(f"coalesce(a.{n}, b.{n}) as {n}" for n in names.split(", "))
    on = " and ".join(f"a.{i} = b.{i}" for i in ids.split(", "))
    return f"""select {shown}, coalesce(order_count, 0) as order_count, coalesce(a.uu, 0) as uu_count,
      coalesce(order_amount, 0.0) as order_amount, coalesce(refund_count, 0) as refund_count,
      coalesce(b.uu, 0) as refund_uu_count
    from (select {ids}, {names}, {_big('sum(order_count)')} as order_count, {_big('count(distinct user_id)')} as uu,
        {_amt('order_amount')} as order_amount from d_spu group by all) a
      full join (select {ids}, {names}, {_big('sum(refund_count)')} as refund_count,
        {_big('count(distinct user_id)')} as uu from d_refund group by all) b on {on}"""


_metric("rep_trademark_orders_refunds", _sides("trademark_id", "trademark_name"))
_metric(
    "rep_category_orders_refunds",
    _sides("category1_id, category2_id, category3_id", "category1_name, category2_name, category3_name"),
)
_metric(
    "rep_trademark_amounts",
    f"select trademark_name, order_amount from (select trademark_id, trademark_name, {_amt('order_amount')} as order_amount from d_spu group by 1, 2)",
)
_metric(
    "rep_spu_stats",
    f"""select spu_name, order_count, uu_count, order_amount from (select spu_id, spu_name,
    {_big('sum(order_count)')} as order_count, {_big('count(distinct user_id)')} as uu_count,
    {_amt('order_amount')} as order_amount from d_spu group by 1, 2)""",
)
_metric("rep_total_amount", f"select {_amt('order_amount')} as order_total_amount from d_prov having count(*) > 0")
_metric(
    "rep_trade_stats",
    f"""select 'order_count' as type, {_big('coalesce(sum(order_count), 0)')} as value from d_spu
    union all select 'order_users', {_big('count(distinct user_id)')} from d_spu
    union all select 'refund_count', {_big('coalesce(sum(refund_count), 0)')} from d_refund
    union all select 'refund_users', {_big('count(distinct user_id)')} from d_refund""",
)
_metric(
    "rep_province_counts",
    f"select province_name, {_big('sum(order_count)')} as order_count from d_prov group by province_id, province_name",
)
_metric(
    "rep_province_amounts",
    f"select province_name, {_amt('order_amount')} as order_amount from d_prov group by province_id, province_name",
)
_metric("rep_channel_visitors", f"select ch, {_big('sum(uv_ct)')} as uv_ct from d_traffic group by ch")
_metric("rep_channel_sessions", f"select ch, {_big('sum(sv_ct)')} as sv_ct from d_traffic group by ch")
for _name, _out, _top in (
    ("rep_pages_per_session", "pv_per_session", "pv_ct"),
    ("rep_time_per_session", "dur_per_session", "dur_sum"),
    ("rep_jump_rate", "uj_rate", "uj_ct"),
):
    _metric(
        _name,
        f"select ch, cast(sum({_top}) as double) / nullif(cast(sum(sv_ct) as double), 0) as {_out} from d_traffic group by ch",
    )
_metric(
    "rep_keyword_scores",
    f"""select keyword, {_big('sum(keyword_count * 10)')} as keyword_score from win_keyword
    where stt like '2024-01-10%' group by keyword""",
)


def _by_type(expr: str, name: str) -> str:
    return f"select '{name}' as type, max(case when is_new = '1' then {expr} end) as new, max(case when is_new = '0' then {expr} end) as old from v"


_metric(
    "rep_visitor_types",
    f""", v as (select k.is_new, {', '.join(f'cast(coalesce(sum({c}), 0) as double) as {c}' for c in ('uv_ct', 'pv_ct', 'sv_ct', 'uj_ct', 'dur_sum'))}
      from (values ('1'), ('0')) k(is_new) left join d_traffic t on t.is_new = k.is_new group by 1)
    {_by_type('uv_ct', 'uv')} union all {_by_type('pv_ct', 'pv')}
    union all {_by_type('case when sv_ct = 0 then 0 else uj_ct / sv_ct end', 'uj_rate')}
    union all {_by_type('case when sv_ct = 0 then 0 else dur_sum / sv_ct / 1000 end', 'avg_dur')}
    union all {_by_type('case when sv_ct = 0 then 0 else pv_ct / sv_ct end', 'avg_pv')}""",
)
_HOURS = f"""
  hourly as (select lpad(cast(h as varchar), 2, '0') as hr, {_big('coalesce(sum(uv_ct), 0)')} as uv_ct,
    {_big('coalesce(sum(pv_ct), 0)')} as pv_ct,
    {_big("coalesce(sum(case when is_new = '1' then uv_ct else 0 end), 0)")} as new_uv_ct
  from range(24) r(h) left join d_traffic on cast(stt[12:13] as int) = h group by h)
"""
_metric("rep_visitors_per_hour", f", {_HOURS} select * from hourly")
_metric(
    "rep_series",
    f""", {_HOURS} select '{{"categories":[' || string_agg('"' || hr || '"', ',' order by hr)
    || '],"uv_ct":[' || string_agg(cast(uv_ct as varchar), ',' order by hr)
    || '],"pv_ct":[' || string_agg(cast(pv_ct as varchar), ',' order by hr)
    || '],"new_uv_ct":[' || string_agg(cast(new_uv_ct as varchar), ',' order by hr) || ']}}' as payload from hourly""",
)


def _total(col: str, table: str) -> str:
    return f"{_big(f'coalesce(sum({col}), 0)')} from {table} where stt like '2024-01-10%'"


_metric(
    "rep_page_funnel",
    f"""select 'home' as page_id, {_total('home_uv_ct', 'win_page_uv').replace(' from', ' as uv_ct from', 1)}
    union all select 'good_detail', {_total('good_detail_uv_ct', 'win_page_uv')}
    union all select 'cart', {_total('cart_add_uu_ct', 'win_cart_uu')}
    union all select 'trade', {_total('order_unique_user_count', 'win_order')}
    union all select 'payment', {_total('payment_suc_unique_user_count', 'win_payment')}""",
)
_metric(
    "rep_user_changes",
    f"""select 'backCt' as type, {_total('back_ct', 'win_login').replace(' from', ' as user_ct from', 1)}
    union all select 'activeUserCt', {_total('uu_ct', 'win_login')}
    union all select 'newUserCt', {_total('register_ct', 'win_register')}""",
)
_metric(
    "rep_new_traders",
    f"""select 'order' as trade_type, {_total('order_new_user_count', 'win_order').replace(' from', ' as user_ct from', 1)}
    union all select 'payment', {_total('payment_suc_new_user_count', 'win_payment')}""",
)

# --- streams: the same results as over tables --------------------------------
for _name, _same in (
    ("stream_window", "win_ten_seconds"),
    ("stream_daily_unique", "daily_unique_visitor"),
    ("stream_bounce", "bounce_detail"),
    ("stream_interval_join", "interval_join"),
    ("stream_lookup_join", "lookup_join"),
    ("stream_login", "win_login"),
    ("stream_page_uv", "win_page_uv"),
    ("stream_keyword", "win_keyword"),
    ("stream_coupon_order", "cdc_transition"),
    ("stream_dimensions", "dim_upsert_latest"),
    ("stream_refund_detail", "refund_detail"),
    ("stream_refund_paid", "refund_paid"),
):
    ORACLE[_name] = ORACLE[_same]
_traffic("stream_new_flag", "select event_id, mid, is_new from fixed_all")
_traffic("stream_dedup_first", "select distinct mid || '|' || dt as id from logs")
_traffic("stream_dedup_last", "select mid || '|' || dt as id, max(event_id) as event_id from logs group by 1")
ORACLE["stream_upsert"] = """
select user_id, max(event_id) as event_id, max_by(event_type, event_id) as event_type from events group by user_id
"""
_traffic(
    "stream_log_fan_out",
    f"""select target, {_big('count(*)')} as n from (
      select case when start is null then 'page' else 'start' end as target from good
      union all select 'error' from good where err is not null
      union all select 'display' from (select unnest(range(n_displays)) from good where start is null)
      union all select 'action' from (select unnest(range(n_actions)) from good where start is null))
    group by target""",
)

# --- order streams: changes told around the bounds ----------------------------
_TOLD = f"""
{_TRADE},
sl as materialized (
  select *, row_number() over () as rid, 1704067200 + (l_orderkey * 37) % 259200 + l_linenumber as told from l),
so as (
  select *, 1704067200 + (k * 37) % 259200
    + case when type = 'insert' then 0 when order_status = '1006' then 62 + k % 5 else 2 + k % 5 end as told
  from (select *, cast(order_id as bigint) as k from oi)),
sa as (
  select a.rid, cast(b.l_partkey % 10 as varchar) as activity_id, cast(b.l_partkey % 4 as varchar) as activity_rule_id
  from sl a join sl b on a.id = b.id and b.l_discount > 0.05 and abs(b.told + b.l_partkey % 8 - a.told) <= 5
  qualify row_number() over (partition by a.rid order by b.made desc, cast(b.l_partkey % 10 as varchar) desc,
    cast(b.l_partkey % 4 as varchar) desc) = 1),
sc as (
  select a.rid, cast(b.l_suppkey % 8 as varchar) as coupon_id
  from sl a join sl b on a.id = b.id and b.l_tax > 0.04 and abs(b.told - b.l_suppkey % 8 - a.told) <= 5
  qualify row_number() over (partition by a.rid order by b.made desc, cast(b.l_suppkey % 8 as varchar) desc,
    cast(b.l_suppkey as varchar) desc) = 1),
swide as (
  select l.id, l.order_id, so.user_id, l.sku_id, 'sku ' || l.sku_id as sku_name, l.sku_num, l.price as order_price,
    so.province_id, activity_id, activity_rule_id, coupon_id, {_t('l.made')} as create_time, cast(l_suppkey as varchar) as source_id,
    cast(1 + l_partkey % 5 as varchar) as source_type_id, dic_name as source_type_name,
    case when l_discount > 0.05 then cast(cast(round(l_discount * 100) as int) as varchar) end as split_activity_amount,
    case when l_tax > 0.04 then cast(cast(round(l_tax * 100) as int) as varchar) end as split_coupon_amount,
    l.price as split_total_amount, greatest(l.told, so.told) as changed, type, order_status, operate_time,
    {_t('timestamp \'1970-01-01\' + to_seconds(greatest(l.told, so.told))')} as row_op_ts
  from sl l join dic on cast(1 + l_partkey % 5 as varchar) = dic_code
    join so on l.order_id = so.order_id and abs(so.told - l.told) <= 5
    left join sa on l.rid = sa.rid left join sc on l.rid = sc.rid)
"""
ORACLE["stream_order_detail"] = f"with {_TOLD} select * exclude (changed, type, order_status, operate_time) from swide where type = 'insert'"
ORACLE["stream_order_cancel"] = f"""with {_TOLD}
  select * exclude (changed, type, order_status, operate_time, create_time, activity_rule_id, row_op_ts),
    activity_rule_id, operate_time as cancel_time
  from swide where type = 'update' and order_status = '1003'"""
ORACLE["stream_pay_detail"] = f"""with {_TOLD}
  select s.id as order_detail_id, s.order_id, s.user_id, sku_id, sku_name, s.province_id, activity_id, activity_rule_id, coupon_id,
    cast(1 + o_orderkey % 5 as varchar) as payment_type_code, p.dic_name as payment_type_name, {_t('later')} as callback_time,
    source_id, source_type_id, source_type_name, sku_num, order_price, split_activity_amount, split_coupon_amount,
    split_total_amount as split_payment_amount, row_op_ts
  from swide s join o on s.order_id = o.order_id and o_orderstatus = 'O' and o_orderkey % 9 <> 0
    and abs(1704067200 + (o_orderkey * 37) % 259200 + 895 + o_orderkey % 16 - changed) <= 905
  join dic p on cast(1 + o_orderkey % 5 as varchar) = p.dic_code
  where type = 'insert'"""
