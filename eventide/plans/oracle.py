"""DuckDB SQL twins of every job (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views.  The
fixture views are inlined as CTEs; sliding windows use integer epoch
arithmetic ``((epoch_us(ts) // slide) - i) * slide + size`` over
``range(size / slide)``.
"""

from __future__ import annotations

from eventide.plans import jobs as J
from eventide.timeutil import seconds

K = "cast(json_extract_string(props, '$.k') as int)"

FX = {
    "fx_user_behavior": f"""select event_id as seq, user_id, cast({K} as bigint) as item_id,
        cast({K} % 10 as int) as category_id,
        case event_type when 'view' then 'pv' when 'purchase' then 'buy' when 'click' then 'cart' else 'fav' end
          as behavior, ts from events""",
    "fx_access_log": f"""select event_id as seq,
        concat('10.0.', cast(user_id % 16 as varchar), '.', cast({K} as varchar)) as ip,
        cast(user_id as varchar) as user_id, ts,
        case when {K} % 10 = 0 then 'POST' else 'GET' end as method,
        concat('/p/', cast({K} % 20 as varchar),
               case {K} % 6 when 0 then '.css' when 1 then '.png' when 2 then '.css?v=1' else '' end) as url
        from events""",
    "fx_marketing": """select event_id as seq, user_id,
        case event_type when 'click' then 'CLICK' when 'signup' then 'DOWNLOAD' when 'purchase' then 'INSTALL'
          when 'error' then 'UNINSTALL' end as behavior,
        case user_id % 3 when 0 then 'app store' when 1 then 'wechat' else 'weibo' end as channel, ts
        from events""",
    "fx_ad_click": f"""select e.event_id as seq, e.user_id, cast({K} % 3 as bigint) as ad_id, n.n_name as province,
        concat('city', cast({K} % 7 as varchar)) as city, e.ts
        from events e join nation n on n.n_nationkey = cast(e.user_id % 25 as int)
        where e.event_type in ('click', 'view', 'purchase')""",
    "fx_login": """select event_id as seq, user_id, concat('10.0.0.', cast(user_id % 256 as varchar)) as ip,
        case when event_type in ('error', 'signup') then 'fail' else 'success' end as login_state, ts
        from events""",
    "fx_order_events": """select o_orderkey * 2 as seq, o_orderkey as order_id, 'create' as event_type,
          '' as tx_id, o_orderdate + to_seconds((o_orderkey * 7919) % 80000) as ts
        from orders where o_orderkey % 11 <> 0 or o_orderkey % 5 = 0
        union all
        select o_orderkey * 2 + 1, o_orderkey, 'pay', concat('tx', cast(o_orderkey as varchar)),
          o_orderdate + to_seconds((o_orderkey * 7919) % 80000 + (o_orderkey * 13) % 1801 - 60)
        from orders where o_orderkey % 5 <> 0""",
    "fx_receipts": """select concat('tx', cast(o_orderkey as varchar)) as tx_id,
        case o_orderkey % 2 when 0 then 'alipay' else 'wechat' end as pay_channel,
        o_orderdate + to_seconds((o_orderkey * 7919) % 80000 + (o_orderkey * 13) % 1801 - 60
                                 + (o_orderkey * 17) % 15 - 7) as ts
        from orders where o_orderkey % 7 <> 0""",
}


def with_fx(*names: str, extra: str = "") -> str:
    ctes = [f"{n} as ({FX[n]})" for n in names]
    if extra:
        ctes.append(extra)
    return "with " + ",\n".join(ctes) + "\n"


def us(d) -> int:
    return int(round(seconds(d) * 1_000_000))


def sliding_sql(src: str, keys: list[str], size, slide, filt: str = "true") -> str:
    k = us(size) // us(slide)
    kc = "".join(f"{c}, " for c in keys)
    return (f"select {kc}make_timestamp(((epoch_us(ts) // {us(slide)}) - i) * {us(slide)} + {us(size)})"
            f" as window_end, count(*) as cnt from {src}, range({k}) t(i) where {filt}"
            f" group by all")


def bitmap_sql(c: str, cap: int = 1 << 29, seed: int = 43) -> str:
    return (f"list_reduce(list_prepend(0::bigint, list_transform(regexp_extract_all(cast({c} as varchar), '.'),"
            f" lambda ch: ascii(ch)::bigint)), lambda a, ch: (a * {seed} + ch) & {cap - 1})")


HOUR_END = "make_timestamp((epoch_us(ts) // 3600000000) * 3600000000 + 3600000000)"

PV = "select * from fx_user_behavior where behavior = 'pv'"
PAGES = "select * from fx_access_log where method = 'GET' and not regexp_matches(url, '\\.(css|js|png|ico)$')"
MKT = "select * from fx_marketing where behavior is distinct from 'UNINSTALL'"

ORACLE: dict[str, str] = {}

ORACLE["item_view_counts"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + \
    sliding_sql("pv", ["item_id"], J.ITEMS["size"], J.ITEMS["slide"])
ORACLE["item_view_counts_direct"] = ORACLE["item_view_counts"]
ORACLE["item_view_counts_delta"] = ORACLE["item_view_counts"]
ORACLE["sliding_pane_equals_direct"] = "with c as (" + ORACLE["item_view_counts"].replace("\n", "\n  ") + """)
select item_id, count(*) as n_windows, cast(sum(cnt) as bigint) as sum_pane, cast(sum(cnt) as bigint) as sum_delta,
       true as same from c group by item_id"""

ORACLE["hot_items"] = with_fx("fx_user_behavior", extra=f"pv as ({PV}), c as ("
                              + sliding_sql("pv", ["item_id"], J.ITEMS["size"], J.ITEMS["slide"]) + ")") + f"""
select window_end, cast(row_number() over (partition by window_end order by cnt desc, item_id) as integer) as rank,
       item_id, cnt
from c qualify rank <= {J.ITEMS['n']}"""

ORACLE["format_ranking"] = "with r as (" + ORACLE["hot_items"].replace("\n", "\n  ") + """)
select window_end,
  '==============================' || '窗口结束时间：'
  || strftime(window_end - interval 1 millisecond, '%Y-%m-%d %H:%M:%S.%g') || chr(10)
  || string_agg('NO ' || cast(rank as varchar) || '：' || '商品ID = ' || cast(item_id as varchar)
                || ' 热门度 = ' || cast(cnt as varchar) || chr(10), '' order by rank)
  || '==========================' || chr(10) || chr(10) as text
from r group by window_end"""

ORACLE["page_view_counts"] = with_fx("fx_access_log", extra=f"p as ({PAGES})") + \
    sliding_sql("p", ["url"], J.PAGES["size"], J.PAGES["slide"])

ORACLE["hot_pages"] = with_fx("fx_access_log", extra=f"p as ({PAGES}), c as ("
                              + sliding_sql("p", ["url"], J.PAGES["size"], J.PAGES["slide"]) + ")") + f"""
select window_end, cast(row_number() over (partition by window_end order by cnt desc, url) as integer) as rank,
       url, cnt
from c qualify rank <= {J.PAGES['n']}"""

ARRIVED = with_fx("fx_access_log") + f"""
, a as (select *, epoch_us(ts) + 1000000::bigint * case when seq % 7 = 0 then 21600 when seq % 5 = 0 then 1200 else 0 end
          as arrival from fx_access_log),
w as (select *, max(ts) over (order by arrival, seq rows between unbounded preceding and 1 preceding)
                  - interval {int(seconds(J.PAGES['delay']))} second as watermark from a),
p as (select * from w where method = 'GET' and not regexp_matches(url, '\\.(css|js|png|ico)$'))"""

ORACLE["late_page_events"] = ARRIVED + f"""
select seq, ip, user_id, ts, method, url, arrival, watermark from p
where make_timestamp((epoch_us(ts) // {us(J.PAGES['slide'])}) * {us(J.PAGES['slide'])} + {us(J.PAGES['size'])})
      - interval 1 millisecond + interval {int(seconds(J.PAGES['lateness']))} second <= watermark"""

ORACLE["page_view_counts_lateness"] = ARRIVED + f"""
, e as (select url, watermark, make_timestamp(((epoch_us(ts) // {us(J.PAGES['slide'])}) - i) * {us(J.PAGES['slide'])}
          + {us(J.PAGES['size'])}) as window_end
        from p, range({int(seconds(J.PAGES['size']) // seconds(J.PAGES['slide']))}) r(i))
select url, window_end, count(*) as cnt from e
where not coalesce(window_end - interval 1 millisecond + interval {int(seconds(J.PAGES['lateness']))} second <= watermark, false)
group by url, window_end"""

ORACLE["hot_pages_lateness"] = "with c as (" + ORACLE["page_view_counts_lateness"].replace("\n", "\n  ") + f""")
select window_end, cast(row_number() over (partition by window_end order by cnt desc, url) as integer) as rank,
       url, cnt
from c qualify rank <= {J.PAGES['n']}"""

ORACLE["page_view_counts_5s"] = with_fx("fx_access_log", extra=f"p as ({PAGES})") + \
    sliding_sql("p", ["url"], J.PAGES["size"], J.PAGES_SLIDE)

ORACLE["exclude_static_assets"] = with_fx("fx_access_log") + \
    "select * from fx_access_log where not regexp_matches(url, '\\.(css|js|png|ico)$')"

ORACLE["page_views_hourly"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + \
    f"select {HOUR_END} as window_end, count(*) as cnt from pv group by all"
ORACLE["page_views_salted"] = ORACLE["page_views_hourly"]

ORACLE["unique_visitors_hourly"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + \
    f"select {HOUR_END} as window_end, count(distinct user_id) as uv from pv group by all"

ORACLE["unique_visitors_hll_tolerance"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + \
    "select date_trunc('day', ts) + interval 1 day as window_end, count(distinct user_id) as uv, true as within_tolerance " \
    "from pv group by all"

ORACLE["unique_visitors_bitmap"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + \
    f"select {HOUR_END} as window_end, count(distinct {bitmap_sql('user_id')}) as uv from pv group by all"

ORACLE["unique_visitors_bitmap_small"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + \
    f"select {HOUR_END} as window_end, count(distinct {bitmap_sql('user_id', J.SMALL_CAP)}) as uv from pv group by all"

ORACLE["bitmap_offsets"] = with_fx("fx_user_behavior") + \
    f"select user_id, {bitmap_sql('user_id')} as bit_offset from (select distinct user_id from fx_user_behavior)"

ORACLE["running_unique_visitors"] = with_fx("fx_user_behavior", extra=f"pv as ({PV})") + f"""
, o as (select {HOUR_END} as window_end, {bitmap_sql('user_id')} as bit_offset, ts, seq, user_id from pv)
, f as (select window_end, bit_offset, arg_min(ts, (ts, seq)) as ts, arg_min(seq, (ts, seq)) as seq,
               arg_min(user_id, (ts, seq)) as user_id from o group by all)
select window_end, bit_offset, ts, seq, user_id,
       row_number() over (partition by window_end order by ts, seq) as uv from f"""

ORACLE["exclude_behavior"] = with_fx("fx_marketing") + MKT.replace("select *", "select *", 1)

ORACLE["marketing_by_channel"] = with_fx("fx_marketing", extra=f"m as ({MKT})") + \
    sliding_sql("m", ["channel", "behavior"], J.MARKETING["size"], J.MARKETING["slide"])

ORACLE["marketing_total"] = with_fx("fx_marketing", extra=f"m as ({MKT})") + \
    "select 'total' as channel, 'total' as behavior, window_end, cnt from (" + \
    sliding_sql("m", [], J.MARKETING["size"], J.MARKETING["slide"]) + ")"

_prof = """select channel, behavior, count(*) as n_windows, cast(sum(cnt) as bigint) as sum_cnt, max(cnt) as max_cnt
from ({inner}) group by channel, behavior"""
ORACLE["marketing_by_channel_profile"] = with_fx("fx_marketing", extra=f"m as ({MKT})") + _prof.format(
    inner=sliding_sql("m", ["channel", "behavior"], J.MARKETING_DEFAULT["size"], J.MARKETING_DEFAULT["slide"]))
ORACLE["marketing_total_profile"] = with_fx("fx_marketing", extra=f"m as ({MKT})") + _prof.format(
    inner="select 'total' as channel, 'total' as behavior, cnt from ("
          + sliding_sql("m", [], J.MARKETING_DEFAULT["size"], J.MARKETING_DEFAULT["slide"]) + ")")

ORACLE["marketing_total_profile_pane"] = ORACLE["marketing_total_profile"]

ORACLE["ads_by_province"] = with_fx("fx_ad_click") + \
    sliding_sql("fx_ad_click", ["province"], J.ADS["size"], J.ADS["slide"])

_ranked_ads = f"""r as (select *, cast(ts + interval {J.ADS['day_offset_hours']} hour as date) as day,
      row_number() over (partition by user_id, ad_id, cast(ts + interval {J.ADS['day_offset_hours']} hour as date)
                         order by ts, seq) as rn from fx_ad_click)"""
ORACLE["ad_clicks_capped"] = with_fx("fx_ad_click", extra=_ranked_ads) + \
    f"select seq, user_id, ad_id, province, city, ts from r where rn <= {J.ADS['cap']}"
ORACLE["ad_blacklist"] = with_fx("fx_ad_click", extra=_ranked_ads) + \
    f"select user_id, ad_id, day, ts as warn_ts, 'click over{J.ADS['cap']}times' as msg from r where rn = {J.ADS['cap'] + 1}"
ORACLE["ads_by_province_capped"] = with_fx("fx_ad_click", extra=_ranked_ads) + \
    sliding_sql("r", ["province"], J.ADS["size"], J.ADS["slide"], filt=f"rn <= {J.ADS['cap']}")

_lagged = """l as (select user_id, ts, login_state,
      lag(login_state) over (partition by user_id order by ts, seq) as prev_state,
      lag(ts) over (partition by user_id order by ts, seq) as prev_ts from fx_login)"""
_pw = int(seconds(J.LOGIN_PAIR_WINDOW))
ORACLE["login_fail_pairs"] = with_fx("fx_login", extra=_lagged) + f"""
select user_id, prev_ts as first_fail_ts, ts as last_fail_ts, 'login fail in {_pw}s for 2tiems' as msg from l
where login_state = 'fail' and prev_state = 'fail' and ts <= prev_ts + interval {_pw} second"""
ORACLE["login_fail_pairs_strict"] = with_fx("fx_login", extra=_lagged) + f"""
select user_id, prev_ts as first_fail_ts, ts as last_fail_ts, 'login fail in {_pw}s for 2tiems' as msg from l
where login_state = 'fail' and prev_state = 'fail' and ts < prev_ts + interval {_pw} second"""

for _name, _n in (("login_fail_runs", J.LOGIN_RUN_N), ("login_fail_runs_default", J.LOGIN_RUN_DEFAULT_N)):
    ORACLE[_name] = with_fx("fx_login") + f"""
, r as (select user_id, ts, login_state,
      sum(case when login_state = 'fail' then 1 else 0 end)
        over (partition by user_id order by ts, seq rows between {_n - 1} preceding and current row) as nf,
      first_value(ts) over (partition by user_id order by ts, seq rows between {_n - 1} preceding and current row)
        as first_ts from fx_login)
select user_id, first_ts as first_fail_ts, ts as last_fail_ts, 'login fail {_n} times in 2s' as msg
from r where nf = {_n}"""

_bw = int(seconds(J.LOGIN_BURST["window"]))
_bm = J.LOGIN_BURST["min_fails"]
ORACLE["login_fail_bursts"] = "with recursive " + f"fx_login as ({FX['fx_login']})" + f"""
, ev as (select user_id, ts, login_state = 'fail' as f,
                row_number() over (partition by user_id order by ts, seq) as rn from fx_login)
, st as (
  select user_id, rn,
         case when f then ts end as anchor, case when f then ts end as last_ts, case when f then 1 else 0 end as cnt,
         cast(null as timestamp) as e_first, cast(null as timestamp) as e_last, cast(null as integer) as e_cnt
  from ev where rn = 1
  union all
  select e.user_id, e.rn,
    case when not e.f then null
         when s.anchor is null or e.ts > s.anchor + interval {_bw} second then e.ts else s.anchor end,
    case when not e.f then null else e.ts end,
    case when not e.f then 0
         when s.anchor is null or e.ts > s.anchor + interval {_bw} second then 1 else s.cnt + 1 end,
    case when s.anchor is not null and s.cnt >= {_bm} and e.ts > s.anchor + interval {_bw} second then s.anchor end,
    case when s.anchor is not null and s.cnt >= {_bm} and e.ts > s.anchor + interval {_bw} second then s.last_ts end,
    case when s.anchor is not null and s.cnt >= {_bm} and e.ts > s.anchor + interval {_bw} second then s.cnt end
  from st s join ev e on e.user_id = s.user_id and e.rn = s.rn + 1)
, fin as (select s.* from st s
          join (select user_id, max(rn) as rn from ev group by user_id) m on m.user_id = s.user_id and m.rn = s.rn)
select user_id, first_fail_ts, last_fail_ts, fail_count,
       'login fail in {_bw}s for ' || cast(fail_count as varchar) || 'tiems' as msg
from (select user_id, e_first as first_fail_ts, e_last as last_fail_ts, cast(e_cnt as integer) as fail_count
      from st where e_first is not null
      union all
      select user_id, anchor, last_ts, cast(cnt as integer) from fin where anchor is not null and cnt >= {_bm})"""

_ot = int(seconds(J.ORDER_TIMEOUT))
_fb = f"""c as (select order_id, ts as create_ts, event_type,
      min(case when event_type = 'pay' then ts end)
        over (partition by order_id order by ts, seq rows between 1 following and unbounded following) as pay_ts
      from fx_order_events)"""
ORACLE["order_paid"] = with_fx("fx_order_events", extra=_fb) + f"""
select order_id, create_ts, pay_ts, 'payed' as result from c
where event_type = 'create' and pay_ts < create_ts + interval {_ot} second"""
ORACLE["order_timeouts"] = with_fx("fx_order_events", extra=_fb) + f"""
select order_id, create_ts, create_ts + interval {_ot} second as timeout_ts, 'timeout' as result from c
where event_type = 'create' and (pay_ts is null or pay_ts >= create_ts + interval {_ot} second)"""

ORACLE["order_payment_status"] = with_fx("fx_order_events") + f"""
, g as (select order_id, min(case when event_type = 'create' then ts end) as create_ts,
               min(case when event_type = 'pay' then ts end) as pay_ts from fx_order_events group by order_id)
, s as (select *, case
      when create_ts is not null and pay_ts is not null and pay_ts >= create_ts
           and pay_ts < create_ts + interval {_ot} second then 'payed successfully'
      when create_ts is not null and pay_ts is not null and pay_ts >= create_ts then 'payed but timeout'
      when create_ts is not null and pay_ts is not null then 'pay successfully'
      when create_ts is not null then 'timeout'
      else 'payed but not found create' end as result from g)
select order_id, create_ts, pay_ts, result,
       case when result in ('payed successfully', 'pay successfully') then 'main' else 'side' end as channel from s"""

_mb = int(seconds(J.MATCH_BOUND))
_join = """p as (select * from fx_order_events where tx_id is distinct from '')"""
_near = f"""p.tx_id = r.tx_id and r.ts >= p.ts - interval {_mb} second and r.ts <= p.ts + interval {_mb} second"""
ORACLE["pay_receipt_match"] = with_fx("fx_order_events", "fx_receipts", extra=_join) + f"""
select p.tx_id, p.order_id as pay_order_id, p.seq as pay_seq, p.ts as pay_ts,
       r.pay_channel as receipt_pay_channel, r.ts as receipt_ts
from p join fx_receipts r on {_near}"""
ORACLE["unmatched_pays"] = with_fx("fx_order_events", "fx_receipts", extra=_join) + f"""
select tx_id, order_id as pay_order_id, seq as pay_seq, ts as pay_ts from p
where not exists (select 1 from fx_receipts r where {_near})"""
ORACLE["unmatched_receipts"] = with_fx("fx_order_events", "fx_receipts", extra=_join) + f"""
select tx_id, pay_channel as receipt_pay_channel, ts as receipt_ts from fx_receipts r
where not exists (select 1 from p where {_near})"""

_g, _fb_s = J.MATCH_FIRST["groups"], int(seconds(J.MATCH_FIRST["bound"]))
ORACLE["pay_receipt_first"] = with_fx("fx_order_events", "fx_receipts") + f"""
, p as (select 'g' || cast(order_id % {_g} as varchar) as tx_id, order_id, seq, ts from fx_order_events
        where tx_id is distinct from '' qualify row_number() over (partition by order_id % {_g} order by ts, seq) = 1)
, q as (select cast(substr(tx_id, 3) as bigint) as order_id, pay_channel, ts from fx_receipts)
, r as (select 'g' || cast(order_id % {_g} as varchar) as tx_id, order_id, pay_channel, ts from q
        qualify row_number() over (partition by order_id % {_g} order by ts, order_id) = 1)
select p.tx_id, p.order_id as pay_order_id, p.seq as pay_seq, p.ts as pay_ts, r.order_id as receipt_order_id,
       r.pay_channel as receipt_pay_channel, r.ts as receipt_ts
from p join r on p.tx_id = r.tx_id and r.ts >= p.ts - interval {_fb_s} second and r.ts <= p.ts + interval {_fb_s} second"""

ORACLE["parse_user_behavior"] = with_fx("fx_user_behavior") + \
    "select user_id, item_id, category_id, behavior, date_trunc('second', ts) as ts from fx_user_behavior"
ORACLE["parse_access_log"] = with_fx("fx_access_log") + \
    "select ip, user_id, date_trunc('second', ts) as ts, method, url from fx_access_log"
ORACLE["parse_ad_click"] = with_fx("fx_ad_click") + \
    "select user_id, ad_id, province, city, date_trunc('second', ts) as ts from fx_ad_click"
ORACLE["parse_login"] = with_fx("fx_login") + \
    "select user_id, ip, login_state, date_trunc('second', ts) as ts from fx_login"
ORACLE["parse_order"] = with_fx("fx_order_events") + \
    "select order_id, event_type, tx_id, date_trunc('second', ts) as ts from fx_order_events"
ORACLE["parse_receipt"] = with_fx("fx_receipts") + \
    "select tx_id, pay_channel, date_trunc('second', ts) as ts from fx_receipts"

ORACLE["format_ranking_pages"] = "with r as (" + ORACLE["hot_pages"].replace("\n", "\n  ") + """)
select window_end,
  '==============================' || '窗口结束时间：'
  || strftime(window_end - interval 1 millisecond, '%Y-%m-%d %H:%M:%S.%g') || chr(10)
  || string_agg('NO ' || cast(rank as varchar) || '：' || '页面URL = ' || url
                || ' 浏览量 = ' || cast(cnt as varchar) || chr(10), '' order by rank)
  || '==========================' || chr(10) || chr(10) as text
from r group by window_end"""
