"""DuckDB relations the answers are built from.

They start from ``lineitem`` with typed arithmetic: no text is written and parsed
back, money is integer cents, ratios are integer ten-thousandths and scores are
integer hundredths, so nothing here shares a code path with the Spark side.
"""

from __future__ import annotations

# The text of each issue.
ISSUE_DETAILS = {
    "duplicate_bet_key": "Duplicate source_uuid + ticket_no within the same source file",
    "negative_total_stake": "Total stake amount is below zero after parsing win/place stake values",
    "missing_event_timestamp": "Event timestamp is null after combining event date and time fields",
    "cancelled_with_payout": "Cancelled bet still shows a positive payout amount",
    "payout_without_stake": "Positive payout amount exists while parsed stake amount is zero or null",
}


def r4(part: str, whole: str) -> str:
    """part / whole in ten-thousandths, half away from zero; NULL for a zero whole."""
    return (
        f"(case when ({whole}) = 0 then null else "
        f"cast(sign({part}) * sign({whole}) * ((20000 * abs(cast({part} as hugeint)) + abs({whole})) "
        f"// (2 * abs({whole}))) as bigint) end)"
    )


LINES = """
lines as (
  select row_number() over () as rn, l_returnflag as f, l_linenumber as line, l_partkey as part,
         l_suppkey as supp, l_orderkey as ord, l_linestatus as st, cast(l_shipdate as date) as ship,
         cast(l_quantity as int) as qty, cast(round(l_discount * 100) as int) as disc,
         cast(round(l_tax * 100) as int) as tax,
         cast(round(l_extendedprice * 100) as bigint) // 100 as cents,
         cast(date_trunc('quarter', l_shipdate) as date) as q
  from lineitem
),
facts as (
  select *, 'dump_' || f || '.csv' as source_file, strftime(q, '%Y%m') as ym,
         f <> 'R' and qty = 48 and line = 4 as no_stake,
         f <> 'R' and qty = 50 as zero_stake,
         case f when 'A' then disc >= 9
                when 'N' then disc >= (case when year(q) = 1998 then 4 else 7 end)
                else (year(q) = 1999 and disc >= 8) or (year(q) = 2000 and disc >= 10)
                     or (year(q) = 2001 and disc >= 9) end as negative,
         f <> 'R' and tax = 8 and st = 'F' as cancelled,
         f <> 'R' and line = 7 and st = 'O' as no_event,
         f = 'A' and qty = 2 and line = 7 as no_date,
         line = 3 and qty = 1 as own_time
  from lines
)"""

BETS = LINES + """,
typed as (
  select rn as ingestion_id, source_file, 'bets' as source_sheet, rn + 1 as source_row_number,
    case when qty = 7 then null else 'REF' || ord end as source_refid,
    case when f = 'R' then 'r-' || ord || '-' || line
         when (qty = 50 and line = 1) or (qty = 49 and line = 2) then null
         when f = 'A' then 'a' || (part // 2) || '-' || ym
         when supp % 4 = 0 then 'n' || part
         else 'n' || part || '-' || ym end as source_uuid,
    'LIC-1' as license,
    case when supp % 50 = 49 then null else 'BM' || (supp % 7) end as bookmaker_name,
    'Site ' || (supp % 5) as location_name,
    ['NSW', 'VIC', 'QLD', null][supp % 4 + 1] as state_code,
    'Metro' as area_name, 'WP' || (supp % 2) as wagering_provider, '1.0' as system_version,
    case when no_date then null
         when own_time then q + interval '9 hours 30 minutes'
         else q + to_hours(ord % 24) + to_minutes(part % 60) + to_seconds(supp % 60) end as bet_placed_at,
    case when no_event then null
         when line = 1 then cast(ship as timestamp)
         else ship + to_hours(supp % 24) + interval '30 minutes' end as event_scheduled_at,
    case when f = 'R' then part || '-' || supp || '-' || cents
         when qty = 50 and line = 1 then null
         else 'T' || ((part // 2) % 100) end as ticket_no,
    ['RACING', 'GREYHOUNDS', 'SPORT'][supp % 3 + 1] as event_category,
    'Meeting ' || (part % 50) as sport_event_name,
    'Venue ' || (supp % 20) as venue_name,
    ['NSW', 'VIC', 'QLD', null][supp % 20 % 4 + 1] as venue_state_code,
    case when line = 6 then 'PLACE' else 'WIN' end as bet_type,
    ['Terminal', 'Phone', 'Online'][ord % 3 + 1] as bet_method,
    cast(null as varchar) as bet_details,
    case when qty = 3 then null when line = 4 then 40 else line end as race_number,
    case when part % 200 = 0 then null else qty end as runner_number,
    'Runner ' || part as runner_name,
    case when no_stake then null when zero_stake then 0 when negative then -cents else cents end as stake_win,
    case when no_stake or line = 2 then null
         when line = 6 and not zero_stake and not negative then 500 + part % 100 else 0 end as stake_place,
    (part % 900 + 100) + 0.125 as win_price,
    cast(100 + part % 100 as double) / 100 as place_price,
    case when supp % 10 < 3 then null
         when line % 3 = 0 then 'Customer ' || lpad(cast(ord // 10 as varchar), 9, '0')
         when line % 3 = 1 then 'customer   ' || lpad(cast(ord // 10 as varchar), 9, '0')
         else 'CUSTOMER' || chr(9) || lpad(cast(ord // 10 as varchar), 9, '0') end as customer_name,
    case when supp % 10 < 3 then null
         else 'CUSTOMER ' || lpad(cast(ord // 10 as varchar), 9, '0') end as customer_normal,
    cast(null as varchar) as betback_claim,
    case when qty = 5 then 'fixed odds' end as bet_information,
    case when cancelled then true when qty = 20 then null else false end as is_cancelled,
    case when no_date then null
         when cancelled then q + interval '13 hours' + to_minutes(part % 60)
         when own_time then q + interval '9 hours 30 minutes'
         else cast(q as timestamp) end as cancelled_at,
    case when line = 1 then 0.155 end as bet_win_takeout,
    case when line = 1 then 0.2 end as bet_place_takeout,
    cast(null as double) as horse_win_takeout,
    cast(part as double) as horse_win_hold,
    cast(null as double) as horse_place_takeout,
    case when line = 2 then -12.3457 end as horse_place_hold,
    cast(supp * 10000000 + 1 as double) / 10000 as race_hold,
    cast(null as varchar) as betback_information,
    case when qty = 11 then null else false end as is_betback,
    qty = 10 as is_refunded,
    case when line = 3 then -0.05 end as win_deduction,
    cast(null as double) as place_deduction,
    cast(null as double) as place_result,
    cast(case when f = 'R' then cents // 2
         when f = 'A' and tax >= 5 then 2 * cents
         when f = 'N' and tax >= 7 and month(q) in (1, 7) then 2 * cents
         else 0 end as bigint) as payout_win,
    case when line = 2 then null when f = 'A' and line = 6 and tax >= 5 then 700 else 0 end as payout_place,
    'TERM-' || lpad(cast(supp % 40 as varchar), 2, '0') as bet_terminal
  from facts
),
bets as (
  select *,
    coalesce(stake_win, 0) + coalesce(stake_place, 0) as stake,
    payout_win + coalesce(payout_place, 0) as payout,
    case when payout_win > 0 then 1 end as "placing",
    case when payout_win > 0 then 1.0 else 0.0 end as win_result,
    case when payout_win > 0 then 'Paid' else 'Unpaid' end as paid_status,
    cast(bet_placed_at as date) as day,
    strftime(event_scheduled_at, '%Y-%m-%d %H:%M:%S') as event_text,
    md5(source_file || '|' || source_sheet || '|' || source_row_number) as bet_record_key,
    md5(source_file || '|' || coalesce(source_uuid, '') || '|' || coalesce(ticket_no, '')) as bet_business_key,
    coalesce(event_category, '') || '|' || coalesce(venue_state_code, '') || '|' || coalesce(venue_name, '')
      || '|' || coalesce(strftime(event_scheduled_at, '%Y-%m-%d %H:%M:%S'), '')
      || '|' || coalesce(cast(race_number as varchar), '') as event_parts,
    md5(customer_normal) as customer_key,
    row_number() over same_bet as duplicate_rank,
    count(*) over (partition by source_file, source_uuid, ticket_no) as same_rows
  from typed
  window same_bet as (partition by source_file, source_uuid, ticket_no order by source_row_number, ingestion_id)
)"""

_CASES = {
    "duplicate_bet_key": "same_rows > 1 and source_uuid is not null and ticket_no is not null",
    "negative_total_stake": "stake < 0",
    "missing_event_timestamp": "event_scheduled_at is null",
    "cancelled_with_payout": "is_cancelled and payout > 0",
    "payout_without_stake": "stake = 0 and payout > 0",
}
ISSUES = BETS + """,
rules(issue_type, issue_detail) as (values %s),
issues as (
  select r.issue_type, r.issue_detail, b.*
  from bets b, rules r
  where case r.issue_type %s end
)""" % (
    ", ".join(f"('{name}', '{detail}')" for name, detail in ISSUE_DETAILS.items()),
    " ".join(f"when '{name}' then {test}" for name, test in _CASES.items()),
)

RECON = BETS + """,
within_day as (
  select *, row_number() over (partition by source_file, day, bet_business_key order by source_row_number) as nth
  from bets
),
recon_days as (
  select source_file, day,
    count(*) as rows_all, count(distinct bet_business_key) as keys_all,
    count(*) filter (nth = 2) as dup_groups, count(*) filter (nth > 1) as dup_extra,
    count(customer_key) as named, count(*) filter (is_cancelled) as cancelled_rows,
    count(*) filter (is_refunded) as refunded_rows,
    %s,
    cast(sum(stake) as bigint) as stake, cast(sum(payout) as bigint) as payout
  from within_day group by source_file, day
),
recon as (
  select source_file, day, rows_all, keys_all, named, cancelled_rows, refunded_rows, stake, payout,
    case when day is null then 0 else dup_groups end as dup_groups,
    case when day is null then 0 else dup_extra end as dup_extra,
    %s,
    %s as paid_r4
  from recon_days
),
recon_full as (
  select *, %s as issues_all from recon
)""" % (
    ",\n    ".join(f"count(*) filter ({test}) as {name}_rows" for name, test in _CASES.items()),
    ",\n    ".join(f"case when day is null then 0 else {name}_rows end as {name}" for name in _CASES),
    r4("payout", "stake"),
    " + ".join(_CASES),
)

BOOKMAKERS = BETS + f""",
bookmaker_days as (
  select bookmaker_name, day, count(*) as rows_all, count(distinct bet_business_key) as keys_all,
    count(customer_key) as named, count(*) filter (is_cancelled) as cancelled_rows,
    count(*) filter (is_refunded) as refunded_rows,
    case when bookmaker_name is null or day is null then 0
         else count(*) filter (duplicate_rank > 1) end as dup_extra,
    cast(sum(stake) as bigint) as stake, cast(sum(payout) as bigint) as payout
  from bets group by bookmaker_name, day
),
bookmakers as (
  select *, {r4("dup_extra", "rows_all")} as dup_r4, {r4("payout", "stake")} as paid_r4 from bookmaker_days
)"""


def _tail(cte: str) -> str:
    """The part of a relation chain after the shared bets."""
    return cte[len(BETS):]


# Source alerts as one row per (day, rule), scored in integer ratios.
SOURCE_ALERTS = RECON + f""",
measured as (
  select *, {r4("dup_extra", "rows_all")} as dup_r4, {r4("negative_total_stake", "rows_all")} as neg_r4,
         {r4("issues_all", "rows_all")} as issue_r4
  from recon_full
),
source_alerts as (
  select *, 'duplicate_ratio_spike' as alert_type, 'integrity_ops' as alert_owner,
    if(dup_r4 >= 2500, 'critical', 'high') as severity,
    'Duplicate bet-key ratio ' || (dup_r4 // 100) || '.' || lpad(cast(dup_r4 % 100 as varchar), 2, '0')
      || '% exceeded threshold for ' || source_file as alert_message
  from measured where rows_all >= 500 and dup_extra >= 100 and dup_r4 >= 1000
  union all
  select *, 'negative_stake_spike', 'reconciliation_ops',
    if(neg_r4 >= 5000, 'critical', if(neg_r4 >= 2500, 'high', 'medium')),
    'Negative stake ratio ' || (neg_r4 // 100) || '.' || lpad(cast(neg_r4 % 100 as varchar), 2, '0')
      || '% exceeded threshold for ' || source_file
  from measured where rows_all >= 100 and negative_total_stake >= 50 and neg_r4 >= 1000
  union all
  select *, 'loss_day_payout_ratio', 'finance_recon', if(paid_r4 >= 12000, 'critical', 'high'),
    'Payout ratio ' || (paid_r4 // 10000) || '.' || lpad(cast(paid_r4 % 10000 as varchar), 4, '0')
      || ' exceeded loss threshold for ' || source_file
  from measured where stake >= 5000000 and paid_r4 >= 10500
)"""

BOOKMAKER_ALERTS = BOOKMAKERS + """,
bookmaker_alerts as (
  select *, 'bookmaker_duplicate_ratio_spike' as alert_type, 'integrity_ops' as alert_owner,
    if(dup_r4 >= 2500, 'critical', 'high') as severity,
    concat('Bookmaker duplicate ratio ', dup_r4 // 100, '.', lpad(cast(dup_r4 % 100 as varchar), 2, '0'),
      '% exceeded threshold for ', bookmaker_name) as alert_message
  from bookmakers where rows_all >= 100 and dup_extra >= 25 and dup_r4 >= 1000
  union all
  select *, 'bookmaker_loss_day', 'finance_recon', if(paid_r4 >= 12000, 'critical', 'high'),
    concat('Bookmaker payout ratio ', paid_r4 // 10000, '.', lpad(cast(paid_r4 % 10000 as varchar), 4, '0'),
      ' exceeded loss threshold for ', bookmaker_name)
  from bookmakers where stake >= 10000000 and paid_r4 >= 10500
)"""

FEED = SOURCE_ALERTS + _tail(BOOKMAKER_ALERTS) + """,
feed as (
  select md5('source_day|' || source_file || coalesce('|' || cast(day as varchar), '') || '|' || alert_type || '|')
      as alert_id, 'source_day' as alert_scope, day, source_file, cast(null as varchar) as bookmaker_name,
    severity, alert_type, alert_owner, alert_message, rows_all, dup_extra, dup_r4,
    negative_total_stake as neg_rows, neg_r4, issues_all, stake, payout, paid_r4
  from source_alerts
  union all
  select md5('bookmaker_day|' || coalesce('|' || cast(day as varchar), '') || '|' || alert_type
      || coalesce('|' || bookmaker_name, '')),
    'bookmaker_day', day, null, bookmaker_name, severity, alert_type, alert_owner, alert_message, rows_all,
    dup_extra, dup_r4, null, null, dup_extra, stake, payout, paid_r4
  from bookmaker_alerts
)"""

SCORES = SOURCE_ALERTS + """,
hits as (
  select source_file, day, count(*) as n, count(*) filter (severity = 'critical') as crit,
    count(*) filter (severity = 'high') as high, count(*) filter (severity = 'medium') as med
  from source_alerts group by all
),
parts as (
  select m.*, coalesce(n, 0) as alerts, coalesce(crit, 0) as crit, coalesce(high, 0) as high,
    coalesce(med, 0) as med,
    least(3000, dup_r4 * 2) as c_dup,
    least(2500, (neg_r4 * 3 + 1) // 2) as c_neg,
    least(2000, greatest(coalesce(paid_r4, 0) - 10000, 0)) as c_loss,
    least(1500, (issue_r4 + 1) // 2) as c_issue,
    100 * least(10, 10 * coalesce(crit, 0) + 6 * coalesce(high, 0) + 3 * coalesce(med, 0)) as c_alert
  from measured m left join hits h on h.source_file = m.source_file and h.day = m.day
),
scores as (
  select *, least(10000, c_dup + c_neg + c_loss + c_issue + c_alert) as score,
    greatest(c_dup, c_neg, c_loss, c_issue, c_alert) as top
  from parts
),
banded as (
  select *, md5(concat_ws('|', source_file, cast(day as varchar))) as anomaly_id,
    if(score >= 8000, 'critical', if(score >= 6000, 'high', if(score >= 3500, 'medium',
      if(score >= 1500, 'low', 'normal')))) as band,
    case when score = 0 then 'none' when c_dup = top then 'duplicate_pressure'
      when c_neg = top then 'negative_stake_pressure' when c_loss = top then 'payout_loss_pressure'
      when c_issue = top then 'issue_density' else 'alert_severity' end as driver
  from scores
),
actions(band, action) as (values
  ('critical', 'Immediate integrity and finance review'), ('high', 'Prioritise for same-day investigation'),
  ('medium', 'Review during daily reconciliation'), ('low', 'Monitor for repeated pattern'),
  ('normal', 'No action required')),
carded as (select b.*, a.action from banded b join actions a using (band))"""
