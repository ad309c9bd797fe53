"""One DuckDB statement per registered query.

Conventions shared with the Spark side: money, ratios and scores as DOUBLE, days
and timestamps as text, booleans as 'true'/'false', counts as BIGINT.
"""

from __future__ import annotations

from oracle import tables as R


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def day(c: str = "day") -> str:
    return f"cast({c} as varchar)"


def money(c: str) -> str:
    return f"cast({c} as double) / 100"


def r4(c: str) -> str:
    return f"cast({c} as double) / 10000"


def word(c: str) -> str:
    return f"cast({c} as varchar)"


def big(c: str) -> str:
    return f"cast({c} as bigint)"


def q(relations: str, select: str) -> str:
    return f"with {relations.strip()}\n{select}"


_TEXT = (
    "source_file source_sheet source_refid source_uuid license bookmaker_name location_name state_code area_name "
    "wagering_provider system_version ticket_no event_category sport_event_name venue_name venue_state_code "
    "bet_type bet_method bet_details runner_name customer_name betback_claim bet_information "
    "betback_information paid_status bet_terminal"
).split()
_DOUBLE = (
    "win_price place_price bet_win_takeout bet_place_takeout horse_win_takeout horse_win_hold horse_place_takeout "
    "horse_place_hold race_hold win_deduction place_deduction win_result place_result"
).split()

STAGED = {
    **{c: c for c in _TEXT},
    **{c: f"cast({c} as double)" for c in _DOUBLE},
    **{c: big(c) for c in ("ingestion_id", "source_row_number", "race_number", "runner_number")},
    "placing": 'cast("placing" as bigint)',
    **{c: word(c) for c in ("is_cancelled", "is_betback", "is_refunded")},
    **{c: ts(c) for c in ("bet_placed_at", "event_scheduled_at", "cancelled_at")},
    "ingested_at": "'2026-01-01 00:00:00'",
    "stake_win_amount": money("stake_win"),
    "stake_place_amount": money("stake_place"),
    "total_stake_amount": money("stake"),
    "win_payout_amount": money("payout_win"),
    "place_payout_amount": money("payout_place"),
    "total_payout_amount": money("payout"),
    "missing_refid_flag": word("source_refid is null"),
    "missing_stake_flag": word("stake_win is null and stake_place is null"),
    "negative_stake_flag": word("stake < 0"),
}
KEYS = {
    "bet_record_key": "bet_record_key",
    "bet_business_key": "bet_business_key",
    "event_key": "md5(event_parts)",
    "customer_key": "customer_key",
    "selection_key": "md5(event_parts || '|' || coalesce(cast(runner_number as varchar), '') || '|' || runner_name)",
    "duplicate_rank": big("duplicate_rank"),
    "is_duplicate_bet_key": word("duplicate_rank > 1"),
    "payout_record_key": "md5(bet_record_key || '|' || cast(cast(payout as bigint) // 100 as varchar) || '.' "
    "|| lpad(cast(payout % 100 as varchar), 2, '0'))",
}
BET = {**STAGED, **KEYS}


def columns(names, source: dict[str, str] = BET) -> str:
    return ", ".join(f'{source[n]} as "{n}"' for n in names)


RECON_OUT = {
    "source_file": "source_file",
    "report_date": day(),
    "total_bet_rows": "rows_all",
    "distinct_bet_key_count": "keys_all",
    "duplicate_bet_key_group_count": "dup_groups",
    "duplicate_extra_row_count": "dup_extra",
    "named_customer_rows": "named",
    "cancelled_bet_rows": "cancelled_rows",
    "refunded_bet_rows": "refunded_rows",
    "total_issue_rows": "issues_all",
    "duplicate_bet_key_issue_rows": "duplicate_bet_key",
    "negative_stake_issue_rows": "negative_total_stake",
    "missing_event_timestamp_issue_rows": "missing_event_timestamp",
    "cancelled_with_payout_issue_rows": "cancelled_with_payout",
    "payout_without_stake_issue_rows": "payout_without_stake",
    "total_stake_amount": money("stake"),
    "total_payout_amount": money("payout"),
    "net_revenue_amount": money("(stake - payout)"),
    "payout_ratio": r4("paid_r4"),
    "reconciliation_status": "if(issues_all > 0, 'review', 'pass')",
}
BOOKMAKER_OUT = {
    "bookmaker_name": "bookmaker_name",
    **{
        k: RECON_OUT[k]
        for k in (
            "report_date", "total_bet_rows", "distinct_bet_key_count", "named_customer_rows",
            "cancelled_bet_rows", "refunded_bet_rows", "duplicate_extra_row_count", "total_stake_amount",
            "total_payout_amount", "net_revenue_amount",
        )
    },
}
FEED_OUT = {
    **{c: c for c in ("alert_id", "alert_scope", "source_file", "bookmaker_name", "severity", "alert_type",
                      "alert_owner", "alert_message")},
    "report_date": day(),
    "total_bet_rows": "rows_all",
    "duplicate_extra_row_count": "dup_extra",
    "duplicate_ratio": r4("dup_r4"),
    "negative_stake_issue_rows": "neg_rows",
    "negative_stake_ratio": r4("neg_r4"),
    "total_issue_rows": "issues_all",
    "total_stake_amount": money("stake"),
    "total_payout_amount": money("payout"),
    "net_revenue_amount": money("(stake - payout)"),
    "payout_ratio": r4("paid_r4"),
}
COMPONENTS = {
    "duplicate_component_score": money("c_dup"),
    "negative_stake_component_score": money("c_neg"),
    "payout_loss_component_score": money("c_loss"),
    "issue_density_component_score": money("c_issue"),
    "alert_severity_component_score": money("c_alert"),
}
CARD_OUT = {
    **{k: RECON_OUT[k] for k in (
        "source_file", "report_date", "total_bet_rows", "distinct_bet_key_count", "duplicate_extra_row_count",
        "total_issue_rows", "negative_stake_issue_rows", "missing_event_timestamp_issue_rows",
        "cancelled_with_payout_issue_rows", "payout_without_stake_issue_rows", "total_stake_amount",
        "total_payout_amount", "net_revenue_amount", "payout_ratio", "reconciliation_status")},
    "anomaly_id": "anomaly_id",
    "anomaly_score": money("score"),
    "risk_band": "band",
    "primary_driver": "driver",
    "recommended_action": "action",
    "alert_count": "alerts",
    "critical_alert_count": "crit",
    "high_alert_count": "high",
    "medium_alert_count": "med",
    "duplicate_ratio": r4("dup_r4"),
    "negative_stake_ratio": r4("neg_r4"),
    "issue_ratio": r4("issue_r4"),
    **COMPONENTS,
}
ISSUE_OUT = {
    "issue_type": "issue_type",
    "issue_detail": "issue_detail",
    **{k: BET[k] for k in (
        "ingestion_id", "bet_record_key", "bet_business_key", "source_file", "source_row_number", "source_refid",
        "source_uuid", "ticket_no", "bookmaker_name", "bet_placed_at", "total_stake_amount",
        "total_payout_amount")},
}
ROW = ("source_file", "source_row_number")
FILES = "('dump_A.csv', 'dump_N.csv')"


def pick(out: dict[str, str], names=None) -> str:
    return columns(names or list(out), out)


# --- landing -----------------------------------------------------------------

DUMPS = R.LINES + """,
raw as (
  select rn, source_file, line, qty, f = 'A' and qty = 33 and part % 200 <> 0 as blank,
    row_number() over (partition by source_file order by rn) + 1 as row_no,
    case when qty = 7 then '' else 'REF' || ord end as refid,
    case when f = 'R' then 'r-' || ord || '-' || line
         when (qty = 50 and line = 1) or (qty = 49 and line = 2) then ''
         when f = 'A' then 'a' || (part // 2) || '-' || ym
         when supp % 4 = 0 then 'n' || part
         else 'n' || part || '-' || ym end as source_uuid,
    case when f = 'R' then part || '-' || supp || '-' || cents
         when qty = 50 and line = 1 then null
         else 'T' || ((part // 2) % 100) end as ticket_no,
    case when supp % 50 = 49 then null else 'BM' || (supp % 7) end as bookmaker,
    case when no_date then null when own_time then cast(q as varchar) || 'T09:30:00'
         when line = 5 then cast(q as varchar) || 'T00:00:00' else cast(q as varchar) end as bet_date,
    case when not own_time then lpad(cast(ord % 24 as varchar), 2, '0') || ':' ||
         lpad(cast(part % 60 as varchar), 2, '0') || ':' || lpad(cast(supp % 60 as varchar), 2, '0') end as bet_time,
    case when qty = 3 then null when line = 4 then '4.0' else cast(line as varchar) end as race_number,
    case when no_stake then null when zero_stake then 0 when negative then -cents else cents end as win,
    case line % 3 when 1 then cast(abs(win) // 100 as varchar) else format('{:,}', abs(win) // 100) end
      || '.' || lpad(cast(abs(win) % 100 as varchar), 2, '0') as digits,
    case when win is null then null
         when win < 0 then case line % 3 when 0 then '($' || digits || ')' when 1 then '-' || digits
                                         else '(' || digits || ')' end
         else case line % 3 when 1 then digits else '$' || digits end end as bet_amount_win
  from facts
),
landed as (select * from raw where not blank)"""

LANDED_OUT = (
    "source_file, 'bets' as source_sheet, row_no as source_row_number, refid, source_uuid, ticket_no, bookmaker, "
    "bet_date, bet_time, race_number, bet_amount_win"
)


def json_field(header: str, column: str) -> str:
    return f"'\"{header}\":' || case when {column} is null then 'null' else '\"' || {column} || '\"' end"


PAYLOAD = "'{' || " + " || ',' || ".join(
    json_field(h, c)
    for h, c in (
        ("REFID", "refid"), ("UUID", "source_uuid"), ("Bookmaker", "bookmaker"), ("Bet Date", "bet_date"),
        ("Ticket No", "ticket_no"), ("Race Number", "race_number"), ("Bet Amount Win", "bet_amount_win"),
    )
) + " || '}'"

LANDING = {
    "landing_scan": q(DUMPS, f"select {LANDED_OUT} from landed"),
    "header_contract_check": q(
        R.LINES,
        "select distinct source_file, 'Unexpected Column' as header from facts",
    ),
    "header_contract_parquet": q(
        R.LINES,
        "select distinct source_file, 'Unexpected Column' as header from facts where source_file = 'dump_R.csv'",
    ),
    "landing_multi_line": q(
        DUMPS,
        """select source_file, row_no as source_row_number, refid,
        'Row ' || refid || chr(10) || '"of", ' || source_file || chr(10) || chr(10) || 'ends' as bet_details from landed""",
    ),
    "header_rename": q(R.BETS, f"""select {columns(ROW)}, 'BM' || '' as prefix,
        bookmaker_name as bookmaker, 'Venue ' || substr(venue_name, 7) as venue from bets"""),
    "cell_to_text": """select l_orderkey, l_linenumber,
        strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as ship_text,
        strftime(l_shipdate, '%Y-%m-%d') as day_text,
        case when l_quantity > 25 then 'true' else 'false' end as big_text,
        l_returnflag || ' $1,000.00' as padded_text,
        cast(l_partkey as varchar) as part_text from lineitem""",
    "drop_blank_rows": q(
        R.LINES,
        """select source_file, rn + 1 as source_row_number from facts
        where not (f = 'A' and qty = 33 and part % 200 <> 0)""",
    ),
    "raw_payload": q(DUMPS, f"select source_file, row_no as source_row_number, {PAYLOAD} as raw_payload from landed"),
    "landing_append": q(
        DUMPS, "select source_file, 2 * count(*) as row_count from landed group by 1"
    ),
    "landing_replace_by_file": q(
        DUMPS,
        f"""select source_file, row_no as source_row_number,
        case when source_file in {FILES} then 'second' else 'first' end as load from landed""",
    ),
    "landing_replace_write": q(
        DUMPS,
        """select source_file, count(*) as row_count, count(*) as id_count from landed
        where source_file <> 'dump_R.csv' group by 1""",
    ),
    "landing_limit_files": q(
        DUMPS,
        f"""select source_file, row_no as source_row_number, refid from landed where source_file in
        (select distinct source_file from landed order by 1 limit 2)""",
    ),
    "landing_limit_rows": q(
        DUMPS,
        """select source_file, row_no as source_row_number, refid from landed l where row_no <=
        (select min(row_no) from landed s where s.source_file = l.source_file and s.row_no - 1 >= 50)""",
    ),
    "landing_profile": q(
        DUMPS,
        """select source_file, 'bets' as source_sheet, count(*) as row_count,
        arg_min('{"refid":"' || refid || '"', row_no) as sample_start from landed group by 1""",
    ),
    "landing_row_counts": q(
        DUMPS, f"select source_file, count(*) as row_count from landed where source_file in {FILES} group by 1"
    ),
}

# --- parsing, staging, keys ----------------------------------------------------

PARSING = {
    "clean_text": q(R.BETS, f"select {columns((*ROW, 'source_refid', 'source_uuid', 'event_category', 'customer_name', 'bet_information'))} from bets"),
    "parse_money": q(R.BETS, f"select {columns((*ROW, 'stake_win_amount', 'stake_place_amount', 'win_payout_amount', 'place_payout_amount'))} from bets"),
    "parse_decimal": q(R.BETS, f"select {columns((*ROW, *_DOUBLE))} from bets"),
    "parse_integer": q(R.BETS, f"select {columns((*ROW, 'race_number', 'runner_number', 'placing'))} from bets"),
    "parse_boolean_flag": q(R.BETS, f"select {columns((*ROW, 'is_cancelled', 'is_betback', 'is_refunded'))} from bets"),
    "parse_source_timestamp": q(R.BETS, f"select {columns((*ROW, 'bet_placed_at', 'event_scheduled_at', 'cancelled_at'))} from bets"),
    "normalize_customer_name": q(R.BETS, f"select {columns(ROW)}, customer_normal as customer_name_normalized from bets"),
    "stage_bets": q(R.BETS, f"select {pick(STAGED)} from bets"),
    "stage_flags": q(R.BETS, f"select {columns((*ROW, 'missing_refid_flag', 'missing_stake_flag', 'negative_stake_flag'))} from bets"),
    "stage_totals": q(R.BETS, f"select {columns((*ROW, 'total_stake_amount', 'total_payout_amount'))} from bets"),
    **{
        name: q(R.BETS, f"select {columns((*ROW, name))} from bets")
        for name in ("bet_record_key", "bet_business_key", "event_key", "customer_key", "selection_key",
                     "duplicate_rank", "is_duplicate_bet_key")
    },
    "payout_record_key": q(R.BETS, f"select {columns((*ROW, 'payout_record_key'))} from bets where payout <> 0"),
    "alert_id": q(R.FEED, "select alert_scope, alert_type, cast(day as varchar) as report_date, source_file, bookmaker_name, alert_id from feed"),
    "anomaly_id": q(R.SCORES, "select source_file, cast(day as varchar) as report_date, anomaly_id from carded"),
    "ml_score_id": q(
        R.RECON,
        """select source_file, cast(day as varchar) as report_date,
        md5('isolation_forest_source_day_v1|' || source_file || '|' || coalesce(cast(day as varchar), 'None')) as ml_score_id
        from recon""",
    ),
}

_FACT = [c for c in (*KEYS, *STAGED) if c not in {
    "payout_record_key", "ingestion_id", "betback_claim", "bet_information", "bet_win_takeout",
    "bet_place_takeout", "horse_win_takeout", "horse_win_hold", "horse_place_takeout", "horse_place_hold",
    "race_hold", "betback_information", "placing", "win_deduction", "place_deduction", "bet_terminal"}]
_PAYOUT = (
    "payout_record_key bet_record_key bet_business_key event_key customer_key source_file source_refid source_uuid "
    "ticket_no bookmaker_name bet_placed_at event_scheduled_at event_category venue_name venue_state_code "
    "race_number runner_number runner_name customer_name paid_status is_cancelled is_refunded "
    "is_duplicate_bet_key win_result place_result win_payout_amount place_payout_amount total_payout_amount"
).split()

MODELS = {
    "dim_customers": q(
        R.BETS,
        f"""select customer_key, customer_normal as customer_name_normalized,
        min(customer_name) as customer_name_example, count(*) as bet_count,
        count(distinct bookmaker_name) as bookmaker_count, count(distinct state_code) as state_count,
        {ts('min(bet_placed_at)')} as first_bet_at, {ts('max(bet_placed_at)')} as last_bet_at,
        {money('sum(stake)')} as total_stake_amount, {money('sum(payout)')} as total_payout_amount
        from bets where customer_normal is not null group by customer_key, customer_normal""",
    ),
    "dim_events": q(
        R.BETS,
        f"""select md5(event_parts) as event_key, any_value(event_category) as event_category,
        any_value(venue_name) as venue_name, any_value(venue_state_code) as venue_state_code,
        any_value({ts('event_scheduled_at')}) as event_scheduled_at,
        any_value({big('race_number')}) as race_number, count(*) as bet_count,
        count(distinct runner_number) as distinct_runner_count,
        count(distinct bookmaker_name) as bookmaker_count, {money('sum(stake)')} as total_stake_amount,
        {money('sum(payout)')} as total_payout_amount from bets group by event_parts""",
    ),
    "fct_bets_filtered": q(R.BETS, f"select {columns(_FACT)} from bets"),
    "fct_bets": q(R.BETS, f"select {columns(_FACT)} from bets"),
    "fct_payouts": q(R.BETS, f"select {columns(_PAYOUT)} from bets where payout <> 0"),
}

_RULES = ("duplicate_bet_key", "negative_total_stake", "missing_event_timestamp", "cancelled_with_payout",
          "payout_without_stake")
QUALITY = {
    **{
        f"issue_{name}": q(R.ISSUES, f"select {pick(ISSUE_OUT)} from issues where issue_type = '{name}'")
        for name in _RULES
    },
    "validation_issues": q(R.ISSUES, f"select {pick(ISSUE_OUT)} from issues"),
    "validation_summary": q(R.ISSUES, "select issue_type, count(*) as issue_count from issues group by 1"),
}

DAILY_ISSUES = f"select source_file, {day()} as report_date, issue_type, count(*) as issue_count from issues group by source_file, day, issue_type"
RECONCILE = {
    "daily_issue_summary": q(R.ISSUES, DAILY_ISSUES),
    "daily_bets_agg": q(R.RECON, "select " + pick(RECON_OUT, (
        "source_file", "report_date", "total_bet_rows", "distinct_bet_key_count", "named_customer_rows",
        "cancelled_bet_rows", "refunded_bet_rows", "total_stake_amount", "total_payout_amount")) + " from recon"),
    "duplicate_groups": q(
        R.RECON,
        f"""select source_file, {day()} as report_date, dup_groups as duplicate_bet_key_group_count,
        dup_extra as duplicate_extra_row_count from recon_days where dup_groups > 0""",
    ),
    "issue_counts_pivot": q(
        R.ISSUES,
        f"select source_file, {day()} as report_date, count(*) as total_issue_rows, "
        + ", ".join(
            f"nullif(count(*) filter (issue_type = '{n}'), 0) as "
            + ("negative_stake" if n == "negative_total_stake" else n) + "_issue_rows"
            for n in _RULES
        )
        + " from issues group by source_file, day",
    ),
    "daily_reconciliation_summary": q(R.RECON, f"select {pick(RECON_OUT)} from recon_full"),
    "daily_bookmaker_summary": q(R.BOOKMAKERS, f"select {pick(BOOKMAKER_OUT)} from bookmakers"),
    "reconciliation_after_reload": q(R.RECON, f"select {pick(RECON_OUT)} from recon_full"),
    "bookmakers_after_reload": q(R.BOOKMAKERS, f"select {pick(BOOKMAKER_OUT)} from bookmakers"),
}

ALERTS = {
    **{
        f"alert_{name}": q(R.FEED, f"select {pick(FEED_OUT)} from feed where alert_type = '{name}'")
        for name in ("duplicate_ratio_spike", "negative_stake_spike", "loss_day_payout_ratio",
                     "bookmaker_duplicate_ratio_spike", "bookmaker_loss_day")
    },
    "source_metrics": q(R.SOURCE_ALERTS, "select " + pick(CARD_OUT, (
        "source_file", "report_date", "total_bet_rows", "duplicate_extra_row_count", "negative_stake_issue_rows",
        "total_issue_rows", "total_stake_amount", "total_payout_amount", "net_revenue_amount", "payout_ratio",
        "duplicate_ratio", "negative_stake_ratio")) + " from measured"),
    "bookmaker_metrics": q(R.BOOKMAKERS, "select bookmaker_name, " + pick(FEED_OUT, (
        "report_date", "total_bet_rows", "duplicate_extra_row_count", "total_stake_amount", "total_payout_amount",
        "net_revenue_amount", "duplicate_ratio", "payout_ratio")) + " from bookmakers"),
    "source_day_alerts": q(R.FEED, f"select {pick(FEED_OUT)} from feed where alert_scope = 'source_day'"),
    "bookmaker_day_alerts": q(R.FEED, f"select {pick(FEED_OUT)} from feed where alert_scope = 'bookmaker_day'"),
    "alert_feed": q(R.FEED, f"select {pick(FEED_OUT)} from feed"),
    "alert_summary": q(
        R.FEED,
        f"select {day()} as report_date, alert_scope, severity, alert_type, count(*) as alert_count from feed group by day, alert_scope, severity, alert_type",
    ),
}

SCORECARD = {
    "alert_counts_by_source_day": q(
        R.SCORES,
        f"select source_file, {day()} as report_date, n as alert_count, crit as critical_alert_count, high as high_alert_count, med as medium_alert_count from hits",
    ),
    "score_base_metrics": q(R.SCORES, "select " + pick(CARD_OUT, [c for c in CARD_OUT if c not in (
        *COMPONENTS, "anomaly_id", "anomaly_score", "risk_band", "primary_driver", "recommended_action")]) + " from carded"),
    "score_components": q(R.SCORES, "select " + pick(CARD_OUT, ("source_file", "report_date", *COMPONENTS)) + " from carded"),
    **{
        name: q(R.SCORES, "select " + pick(CARD_OUT, ("source_file", "report_date", name)) + " from carded")
        for name in ("anomaly_score", "risk_band", "primary_driver", "recommended_action")
    },
    "anomaly_scorecard": q(R.SCORES, f"select {pick(CARD_OUT)} from carded"),
}

# --- triage --------------------------------------------------------------------

FEATURES = {
    "f_anomaly_score": money("score"),
    "f_duplicate_ratio": r4("dup_r4"),
    "f_negative_stake_ratio": r4("neg_r4"),
    "f_issue_ratio": r4("issue_r4"),
    "f_payout_ratio": f"coalesce({r4('paid_r4')}, 0.0)",
    "f_total_bet_rows": "ln(1 + rows_all)",
    "f_total_issue_rows": "ln(1 + issues_all)",
    "f_alert_count": "ln(1 + alerts)",
    "f_critical_alert_count": "ln(1 + crit)",
    "f_net_revenue_amount": "sign(stake - payout) * ln(1 + abs(cast(stake - payout as double) / 100))",
}
FEATURE_CTE = R.SCORES + ",\nfeatures as (select source_file, " + day() + " as report_date, band, score, rows_all, " + ", ".join(
    f"cast({e} as double) as {n}" for n, e in FEATURES.items()) + " from carded)"
_LABELS = ("rule anomaly score", "duplicate pressure", "negative stake pressure", "quality issue density",
           "payout ratio pressure", "bet volume", "issue volume", "alert volume", "critical alert volume",
           "net revenue movement")
_MIN_MAX = "round((score - min(score) over ()) / nullif(max(score) over () - min(score) over (), 0) * 100.0, 4)"
NORMAL = FEATURE_CTE + f""",
normal as (
  select source_file, report_date, band, rows_all, score / 100 as rule_score, cast({_MIN_MAX} as double) as ml_anomaly_score
  from features
),
judged as (
  select *, ml_anomaly_score >= 80 as high, ml_anomaly_score >= 80 or rows_all % 3 = 0 as predicted,
    if(ml_anomaly_score >= 80, 'critical', if(ml_anomaly_score >= 60, 'high', if(ml_anomaly_score >= 35, 'medium',
      if(ml_anomaly_score >= 15, 'low', 'normal')))) as ml_band
  from normal
)"""

DRIVERS = FEATURE_CTE + """,
long as (
  select source_file, report_date, i, label, x, median(x) over (partition by i) as mid
  from (
    select source_file, report_date, unnest(range(10)) as i, unnest([%s]) as label, unnest([%s]) as x
    from features
  )
),
spread as (select *, median(abs(x - mid)) over (partition by i) as mad from long),
ranked as (
  select *, row_number() over (partition by source_file, report_date
    order by abs(x - mid) / (case when mad = 0 then 1 else mad end) desc, i) as place
  from spread
)""" % (", ".join(f"'{label}'" for label in _LABELS), ", ".join(FEATURES))
def _draw(*parts: str) -> str:
    """The forest's draws: the first twelve hex digits of an md5, as a share of 16 ** 12."""
    return f"(cast('0x' || substr(md5(concat_ws('|', 42, {', '.join(parts)})), 1, 12) as bigint) / 281474976710656.0)"


_EACH = range(1, 11)
_VARYING = "list_filter(range(10), lambda k: high[k + 1] > low[k + 1])"
_STATS = f"""count(*) as n, [{', '.join(f'min(x[{k}])' for k in _EACH)}] as low, [{', '.join(f'max(x[{k}])' for k in _EACH)}] as high"""
_SPLIT = f"""select *, if(n > 1 and depth < cap and len({_VARYING}) > 0,
    ({_VARYING})[1 + cast(floor({_draw("tree", "node", "'feature'")} * len({_VARYING})) as int)], -1) as feature"""
# Levels of all trees by recursion: a row moves on while its node is split.
FOREST = "recursive " + DRIVERS.strip() + f""",
points as (
  select row_number() over (order by source_file, report_date) as r, source_file, report_date,
    source_file || '|' || coalesce(report_date, '') as row_key, cast([{', '.join(FEATURES)}] as double[]) as x from features
),
size as (select count(*) as all_rows, least(count(*), 256) as m, cast(ceil(log2(greatest(least(count(*), 256), 2))) as int) as cap from points),
sampled as (
  select tree, r, x from (
    select tree, r, x, row_number() over (partition by tree order by {_draw("tree", "row_key")}, row_key) as place
    from points, (select unnest(range(100)) as tree)
  ), size where place <= m
),
levels as (
  select tree, r, x, 1::bigint as node, 0 as depth from sampled
  union all (
    with split as ({_SPLIT} from (select tree, node, depth, {_STATS} from levels group by tree, node, depth), size)
    select l.tree, l.r, l.x, 2 * l.node + cast(l.x[s.feature + 1] > s.low[s.feature + 1]
      + {_draw("l.tree", "l.node", "'threshold'")} * (s.high[s.feature + 1] - s.low[s.feature + 1]) as int), l.depth + 1
    from levels l join split s on s.tree = l.tree and s.node = l.node where s.feature >= 0
  )
),
nodes as (
  select tree, node, depth, n as rows, feature,
    if(feature >= 0, low[feature + 1] + {_draw("tree", "node", "'threshold'")} * (high[feature + 1] - low[feature + 1]), null) as threshold,
    if(feature < 0, depth + if(n <= 1, 0.0, if(n = 2, 1.0, 2.0 * (ln(n - 1.0::double) + 0.5772156649015329) - 2.0 * (n - 1) / n)), null)::double as path
  from ({_SPLIT} from (select tree, node, depth, {_STATS} from levels group by tree, node, depth), size)
),
walked as (
  select tree, r, x, 1::bigint as node from points, (select unnest(range(100)) as tree)
  union all
  select w.tree, w.r, w.x, 2 * w.node + cast(w.x[n.feature + 1] > n.threshold as int)
  from walked w join nodes n on n.tree = w.tree and n.node = w.node where n.feature >= 0
),
isolated as (
  select r, round(pow(2.0, -(sum(path) / 100) / greatest(any_value(if(m <= 1, 0.0, if(m = 2, 1.0,
    2.0 * (ln(m - 1.0::double) + 0.5772156649015329) - 2.0 * (m - 1) / m))), 1e-12)), 12) as isolation
  from walked join nodes using (tree, node), size where feature < 0 group by r
),
ordered as (
  select list(isolation order by isolation) as l, (count(*) - 1) * (1 - least(0.2, greatest(1.0::double / count(*), 0.05))) as place from isolated
),
relative as (
  select r, isolation - (select l[cast(floor(place) as int) + 1] + (place - floor(place)) * (l[cast(ceil(place) as int) + 1] - l[cast(floor(place) as int) + 1]) from ordered) as above
  from isolated
),
scored as (
  select source_file, report_date, cast(round((above - min(above) over ()) / nullif(max(above) over () - min(above) over (), 0) * 100, 4) as double) as ml_score,
    above > 0 as predicted
  from relative join points using (r)
)"""
_SCORE_ID = "md5('isolation_forest_source_day_v1|' || c.source_file || '|' || coalesce(cast(c.day as varchar), 'None'))"
_BAND = "if(ml_score >= 80, 'critical', if(ml_score >= 60, 'high', if(ml_score >= 35, 'medium', if(ml_score >= 15, 'low', 'normal'))))"
_OUTLIER = "(predicted or ml_score >= 80)"
ML = FOREST + f""",
ml as (
  select {_SCORE_ID} as ml_score_id, 'isolation_forest_source_day_v1' as model_name, c.source_file,
    cast(c.day as varchar) as report_date, {money('c.score')} as rule_anomaly_score, c.band as rule_risk_band,
    ml_score as ml_anomaly_score, {_BAND} as ml_risk_band, cast({_OUTLIER} as varchar) as model_outlier_flag,
    r.label as model_driver, c.driver as primary_driver,
    if({_OUTLIER} and c.band in ('critical', 'high'), 'Investigate immediately; ML agrees with rule-based anomaly pressure',
      if({_OUTLIER}, 'Review model-only anomaly against raw transactions',
      if({_BAND} in ('medium', 'high'), 'Monitor during daily reconciliation', 'No ML action required'))) as recommended_action,
    c.rows_all as total_bet_rows, c.issues_all as total_issue_rows,
    c.alerts as alert_count, coalesce({r4('c.dup_r4')}, 0.0) as duplicate_ratio,
    coalesce({r4('c.neg_r4')}, 0.0) as negative_stake_ratio, coalesce({r4('c.issue_r4')}, 0.0) as issue_ratio,
    coalesce({r4('c.paid_r4')}, 0.0) as payout_ratio, {money('(c.stake - c.payout)')} as net_revenue_amount
  from carded c join ranked r on r.source_file = c.source_file and r.place = 1
      and r.report_date is not distinct from cast(c.day as varchar)
    join scored s on s.source_file = c.source_file and s.report_date is not distinct from cast(c.day as varchar)
)"""
ML_ROWS = q(ML, "select * from ml")
ML_ORDER = "order by ml_anomaly_score desc, rule_anomaly_score desc, report_date nulls last, source_file"
TRIAGE = {
    "ml_feature_rows": q(R.SCORES, "select " + pick(CARD_OUT, (
        "anomaly_id", "source_file", "report_date", "anomaly_score", "risk_band", "primary_driver",
        "recommended_action", "total_bet_rows", "total_issue_rows", "duplicate_ratio", "negative_stake_ratio",
        "issue_ratio", "payout_ratio", "alert_count", "critical_alert_count", "net_revenue_amount")) + " from carded"),
    "ml_features": q(FEATURE_CTE, "select source_file, report_date, " + ", ".join(
        f"round({f}, 6) as {f}" for f in FEATURES) + " from features"),
    "standard_scaler": q(FEATURE_CTE, "select source_file, report_date, " + ", ".join(
        f"round(({f} - avg({f}) over ()) / coalesce(nullif(stddev_pop({f}) over (), 0), 1), 6) + 0.0 as {f}"
        for f in FEATURES) + " from features"),
    "ml_normalize_scores": q(NORMAL, "select source_file, report_date, ml_anomaly_score from normal"),
    "ml_small_batch": q(NORMAL, "select source_file, report_date, ml_anomaly_score, cast(high as varchar) as predicted_outlier from judged"),
    "ml_risk_band": q(NORMAL, "select source_file, report_date, ml_band as ml_risk_band from judged"),
    "ml_outlier_flag": q(NORMAL, "select source_file, report_date, cast(predicted as varchar) as model_outlier_flag from judged"),
    "ml_recommended_action": q(NORMAL, """select source_file, report_date,
        case when predicted and band in ('critical', 'high')
             then 'Investigate immediately; ML agrees with rule-based anomaly pressure'
             when predicted then 'Review model-only anomaly against raw transactions'
             when ml_band in ('medium', 'high') then 'Monitor during daily reconciliation'
             else 'No ML action required' end as recommended_action from judged"""),
    "ml_robust_driver": q(DRIVERS, "select source_file, report_date, label as model_driver from ranked where place = 1"),
    "ml_scores": ML_ROWS,
    "ml_report_metrics": q(ML, f"""select count(*) as row_count, count(*) filter (model_outlier_flag = 'true') as outlier_count,
        max(ml_anomaly_score) as max_ml_anomaly_score, (select '[' || string_agg('{{"ml_score_id":"' || ml_score_id || '","ml_anomaly_score":'
        || ml_anomaly_score || '}}', ',' {ML_ORDER}) || ']' from (select * from ml {ML_ORDER} limit 5)) as top_rows from ml"""),
    "isolation_forest_fit": q(FOREST, "select tree, node, depth, rows, feature, round(threshold, 6) as threshold, round(path, 6) as path from nodes"),
    "isolation_forest_score": q(FOREST, "select source_file, report_date, ml_score as ml_anomaly_score, cast(predicted as varchar) as predicted_outlier from scored"),
    "exact_quantile": q(
        R.BETS,
        f"select {', '.join(f'round(quantile_cont({c}, {p}) / 100, 6) as {c}_{int(p * 100)}' for c in ('stake', 'payout') for p in (0.5, 0.95))} from bets",
    ),
}

# --- summaries, exports --------------------------------------------------------

TOP = "order by score desc, day desc nulls first, source_file limit 10"
SUMMARIES = {
    "eod_overview": q(
        R.FEED + R.SCORES[len(R.SOURCE_ALERTS):] + R.ISSUES[len(R.BETS):],
        f"""select count(*) as source_day_count, {big('sum(rows_all)')} as total_bet_rows,
        count(*) filter (issues_all > 0) as review_source_day_count,
        count(*) filter (band in ('critical', 'high')) as high_risk_source_day_count,
        {money('sum(stake)')} as total_stake_amount, {money('sum(payout)')} as total_payout_amount,
        {money('sum(stake - payout)')} as net_revenue_amount, {money('max(score)')} as max_anomaly_score,
        (select count(*) from feed) as total_alert_count, (select count(*) from issues) as total_quality_issue_count
        from carded""",
    ),
    "eod_risk_bands": q(R.SCORES, f"select band as risk_band, count(*) as source_day_count, {money('max(score)')} as max_anomaly_score from carded group by band"),
    "eod_top_anomalies": q(R.SCORES, "select " + pick(CARD_OUT, (
        "report_date", "source_file", "anomaly_score", "risk_band", "primary_driver", "recommended_action",
        "total_bet_rows", "total_issue_rows", "alert_count", "payout_ratio")) + f" from carded where score > 0 {TOP}"),
    "eod_alert_summary": q(R.FEED, "select severity, alert_type, count(*) as alert_count from feed group by all"),
    "eod_quality_issues": q(R.ISSUES, "select issue_type, count(*) as issue_count from issues group by 1"),
    "dash_kpis": q(
        ML + R.FEED[len(R.SOURCE_ALERTS):],
        f"""select count(*) as source_day_count, {big('sum(rows_all)')} as total_bet_rows,
        count(*) filter (issues_all > 0) as review_source_day_count,
        count(*) filter (band in ('critical', 'high')) as high_risk_source_day_count,
        {money('sum(stake)')} as total_stake_amount, {money('sum(payout)')} as total_payout_amount,
        {money('sum(stake - payout)')} as net_revenue_amount, {money('max(score)')} as max_rule_score,
        (select count(*) from feed) as alert_count,
        (select count(*) filter (model_outlier_flag = 'true') from ml) as ml_outlier_count, (select max(ml_anomaly_score) from ml) as max_ml_score
        from carded""",
    ),
    "dash_top_anomalies": q(R.SCORES, f"select {pick(CARD_OUT)} from carded order by score desc, day nulls last, source_file limit 5"),
    "dash_alert_mix": q(
        R.FEED,
        """select severity, alert_type, count(*) as alert_count from feed group by severity, alert_type
        order by array_position(['critical', 'high', 'medium', 'low'], severity), alert_type limit 8""",
    ),
    "dash_issue_mix": q(R.ISSUES, "select issue_type, count(*) as issue_count from issues group by 1 order by 2 desc, 1 limit 8"),
    "export_daily_reconciliation": q(R.RECON, f"select {pick(RECON_OUT)} from recon_full"),
    "export_daily_issues": q(R.ISSUES, DAILY_ISSUES),
    "export_daily_bookmaker": q(R.BOOKMAKERS, f"select {pick(BOOKMAKER_OUT)} from bookmakers"),
    "export_alert_feed": q(R.FEED, f"select {pick(FEED_OUT)} from feed"),
    "export_alert_summary": ALERTS["alert_summary"],
    "export_scorecard": q(R.SCORES, f"select {pick(CARD_OUT)} from carded"),
    "csv_sink": q(R.SCORES, f"select {pick(CARD_OUT)}, count(*) over () as rows_written from carded"),
    "ml_scores_sink": ML_ROWS,
    "dash_top_ml": q(ML, f"select * from ml {ML_ORDER} limit 5"),
    "artifact_scan": q(R.SCORES, "select 'present' as artifact, count(*) as row_count from carded union all select 'missing', 0"),
}

# --- assertions, gates -----------------------------------------------------------

# Tables broken on purpose, as the queries break them.
ODD_BAND = "select anomaly_id, " + money("score") + " as anomaly_score, 'odd' as risk_band from carded where rows_all % 2 = 0"
CHECKS = {
    "assert_not_null": q(R.BETS, f"select {columns((*ROW, 'source_uuid'))} from bets where source_uuid is null"),
    "assert_unique": q(R.BETS, "select source_uuid, count(*) as row_count from bets where source_uuid is not null group by 1 having count(*) > 1"),
    "assert_accepted_values": q(R.SCORES, "select band as risk_band, count(*) as row_count from carded where band not in ('normal', 'low') group by 1"),
    "assert_alert_scope": q(R.FEED, f"select {pick({**FEED_OUT, 'alert_scope': chr(39) + 'other' + chr(39)})} from feed where severity = 'high'"),
    "assert_summary_matches_feed": q(
        R.FEED,
        f"""select {day()} as report_date, alert_scope, severity, alert_type,
        count(*) as feed_alert_count, cast(null as bigint) as summary_alert_count
        from feed where alert_scope = 'bookmaker_day' or day is null
        group by day, alert_scope, severity, alert_type
        union all
        select null, alert_scope, severity, alert_type, null, count(*) from feed
        where alert_scope = 'source_day' and day is null group by all""",
    ),
    "assert_risk_band": q(R.SCORES, ODD_BAND),
    "assert_score_bounds": q(R.SCORES, f"select anomaly_id, {money('score')} as anomaly_score from carded where score > 5000"),
    "assert_components_sum": q(R.SCORES, "select anomaly_id, " + pick(CARD_OUT, ("anomaly_score", *COMPONENTS)) + " from carded where score > 6000"),
    "assert_source_thresholds": q(R.FEED, f"select {pick(FEED_OUT)} from feed where alert_scope = 'source_day' and alert_type = 'duplicate_ratio_spike' and dup_r4 >= 2500"),
    "assert_bookmaker_thresholds": q(R.FEED, f"select {pick({**FEED_OUT, 'alert_owner': 'if(rows_all % 2 = 0, ' + chr(39) + 'nobody' + chr(39) + ', alert_owner)'})} from feed where alert_scope = 'bookmaker_day' and (bookmaker_name is null or rows_all % 2 = 0)"),
    "assert_reconciliation_counts": q(R.RECON, f"select {pick({**RECON_OUT, 'total_bet_rows': '0'})} from recon_full where rows_all % 2 = 0"),
    "assert_reconciliation_status": q(R.RECON, f"select {pick({**RECON_OUT, 'reconciliation_status': chr(39) + 'odd' + chr(39)})} from recon_full where rows_all % 2 = 0"),
    "gate_anomaly_metrics": q(R.SCORES, f"select count(*) as anomaly_row_count, {money('max(score)')} as max_anomaly_score, count(*) filter (band = 'critical') as critical_anomaly_count from carded where source_file in {FILES}"),
    "gate_alert_types": q(R.FEED, f"select distinct alert_type from feed where source_file in {FILES}"),
    "gate_missing_alert_types": q(
        R.FEED,
        f"""select e.alert_type from (values ('duplicate_ratio_spike'), ('negative_stake_spike'),
        ('loss_day_payout_ratio'), ('bookmaker_loss_day')) e(alert_type)
        where e.alert_type not in (select alert_type from feed where source_file in {FILES})""",
    ),
    "gate_ml_metrics": q(ML, f"""select count(*) as ml_row_count, count(*) filter (model_outlier_flag = 'true') as ml_outlier_count,
        max(ml_anomaly_score) as max_ml_anomaly_score from ml where source_file in {FILES}"""),
    "run_metrics": q(
        ML + R.FEED[len(R.SOURCE_ALERTS):] + R.ISSUES[len(R.BETS):],
        f"""select count(*) as anomaly_row_count, {money('max(score)')} as max_anomaly_score,
        count(*) filter (band = 'critical') as critical_anomaly_count, (select count(*) from feed) as alert_row_count,
        (select count(*) from issues) as issue_row_count, 0::bigint as failed_check_count, count(*) as ml_row_count,
        (select count(*) filter (model_outlier_flag = 'true') from ml) as ml_outlier_count,
        (select max(ml_anomaly_score) from ml) as max_ml_anomaly_score from carded""",
    ),
    "gate_checks": q(
        R.FEED + R.SCORES[len(R.SOURCE_ALERTS):],
        f"""select 'source_files_present' as "check", 'run' as subject, 3 as observed, 'true' as passed
        union all select 'raw_rows_loaded', source_file, cast(sum(rows_all) as bigint), 'true' from recon_days
          group by source_file
        union all select 'raw_rows_loaded', 'dump_missing.csv', 0, 'false'
        union all select 'scorecard_rows', 'anomaly_scorecard', count(*), 'true' from carded
        union all select 'critical_anomaly', 'anomaly_scorecard', count(*) filter (band = 'critical'),
          cast(count(*) filter (band = 'critical') > 0 as varchar) from carded
        union all select 'expected_alert_type', e.alert_type, cast(e.alert_type in
          (select alert_type from source_alerts) as int), cast(e.alert_type in
          (select alert_type from source_alerts) as varchar)
          from (values ('duplicate_ratio_spike'), ('negative_stake_spike'), ('loss_day_payout_ratio')) e(alert_type)""",
    ),
    "output_inventory": q(
        R.FEED + R.SCORES[len(R.SOURCE_ALERTS):],
        """select 'anomaly_scorecard' as output, count(*) as row_count, 'true' as complete from carded
        union all select 'alert_feed', count(*), 'true' from feed
        union all select 'daily_issue_summary', 0, 'true'
        union all select 'ml_anomaly_scores', 0, 'false'""",
    ),
}

ANSWERS = {
    **LANDING, **PARSING, **MODELS, **QUALITY, **RECONCILE, **ALERTS, **SCORECARD, **TRIAGE, **SUMMARIES, **CHECKS,
}
