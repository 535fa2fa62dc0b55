"""The answer of every query as SQL over the supplied tables, written for DuckDB."""

from __future__ import annotations

from filingmill.schemas import BANK_CLASSES, BRANCH_DICTIONARY, METRICS, STATE_CODES

# Named subqueries, each over those before it.
_VIEWS = {
    "filed": """
        select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
               cast(o_orderdate as date) as day,
               last_day(date_trunc('quarter', cast(o_orderdate as date)) + interval 2 month)
                   as quarter_end,
               c_name, c_mktsegment, n_name
        from orders
        join customer on c_custkey = o_custkey
        join nation on n_nationkey = c_nationkey""",
    "raw_fin": """
        select case when o_orderkey % 97 <> 0 then o_custkey end as cert,
               strftime(quarter_end, '%Y%m%d') as repdte,
               c_name as name, n_name as stalp, n_name as stname, c_mktsegment as bkclass,
               o_totalprice - 20000 as asset, o_totalprice / 2 as dep, o_totalprice / 10 as eq,
               o_totalprice / 100 as netinc,
               (o_orderkey % 500) / 100 - 1 as roa, (o_orderkey % 700) / 50 as roe,
               strftime(day, '%Y-%m-%d') as _ingested_at,
               lpad(cast(o_orderkey as varchar), 12, '0') as _batch_id
        from filed""",
    "dedup_fin": """
        select * from raw_fin
        qualify row_number() over (
            partition by cert, repdte
            order by _ingested_at desc nulls last, _batch_id desc nulls last) = 1""",
    "good_fin": """
        select * from dedup_fin
        where cert is not null and repdte is not null and (asset >= 0 or asset is null)""",
    "redelivered": """
        select * replace (
            case when repdte not between '19960331' and '19971231' then asset
                 when repdte = '19970630' then -1 - abs(asset)
                 when cast(_batch_id as bigint) % 5 = 0 then -asset
                 else asset + 1000 end as asset)
        from raw_fin""",
    "redelivered_dedup": """
        select * from redelivered where cert is not null
        qualify row_number() over (
            partition by cert, repdte
            order by _ingested_at desc nulls last, _batch_id desc nulls last) = 1""",
    "fin": """
        select * replace (cast(strptime(repdte, '%Y%m%d') as date) as repdte) from good_fin""",
    "raw_branch": """
        select l_suppkey as cert,
               case when l_orderkey % 89 <> 0 then l_partkey end as uninumbr,
               c_name as namefull, o_orderpriority as citybr,
               case when o_custkey % 101 <> 0 then n_name end as stalpbr,
               n_name as stnamebr,
               case when l_linenumber = 7 then -l_extendedprice else l_extendedprice end as depsumbr,
               o_totalprice as asset,
               cast(year(l_shipdate) as bigint) as year,
               cast(year(l_shipdate) as varchar) || '0630' as repdte,
               strftime(l_shipdate, '%Y-%m-%d') as _ingested_at,
               lpad(cast(l_orderkey as varchar), 12, '0') || '-' || cast(l_linenumber as varchar)
                   as _batch_id
        from lineitem join filed on o_orderkey = l_orderkey""",
    "dedup_branch": """
        select * from raw_branch
        qualify row_number() over (
            partition by cert, uninumbr, repdte
            order by _ingested_at desc nulls last, _batch_id desc nulls last,
                     namefull desc nulls last, citybr desc nulls last, stalpbr desc nulls last,
                     stnamebr desc nulls last, depsumbr desc nulls last, asset desc nulls last,
                     year desc nulls last) = 1""",
    "good_branch": """
        select * from dedup_branch
        where cert is not null and uninumbr is not null and repdte is not null
          and (depsumbr >= 0 or depsumbr is null)""",
    "branch": """
        select * replace (cast(strptime(repdte, '%Y%m%d') as date) as repdte) from good_branch""",
    "snapshot": """
        select o_custkey as cert, cast(quarter_end as date) as snapshot_date,
               o_orderpriority as name,
               case when o_orderkey % 3 <> 0 then o_orderstatus end as city,
               n_name as state, c_mktsegment as bkclass,
               cast(null as varchar) as regagnt, cast(null as varchar) as holding_company,
               strftime(day, '%Y-%m-%d') as _ingested_at,
               lpad(cast(o_orderkey as varchar), 12, '0') as _batch_id
        from filed where o_custkey % 13 <> 0""",
    "daily": """
        select *, sha256(coalesce(name, '') || '|' || coalesce(city, '') || '|' || coalesce(state, '')
                         || '|' || coalesce(bkclass, '') || '|' || coalesce(regagnt, '') || '|'
                         || coalesce(holding_company, '')) as _hash
        from snapshot
        qualify row_number() over (
            partition by cert, snapshot_date order by _ingested_at desc, _batch_id desc) = 1""",
    "run_of": """
        select *, sum(case when _hash is distinct from before then 1 else 0 end)
                      over (partition by cert order by snapshot_date) as run
        from (select *, lag(_hash) over (partition by cert order by snapshot_date) as before
              from daily)""",
    "version": """
        select cert, run, min(snapshot_date) as first_day, min_by(name, snapshot_date) as name,
               min_by(coalesce(city, ''), snapshot_date) as city, min(state) as state,
               min(bkclass) as bkclass, min(_hash) as _hash
        from run_of group by cert, run""",
    "history": """
        select cert, name, nullif(city, '') as city, state, bkclass,
               cast(null as varchar) as regagnt, cast(null as varchar) as holding_company,
               case when run = 1 then date '1900-01-01' else first_day end as valid_from,
               cast(coalesce(lead(first_day) over (partition by cert order by run) - interval 1 day,
                             date '9999-12-31') as date) as valid_to,
               lead(first_day) over (partition by cert order by run) is null as is_current,
               _hash
        from version""",
    "dim": """
        select md5(cast(cert as varchar) || '|' || cast(valid_from as varchar)) as institution_sk,
               cert, name, city, state, bkclass, regagnt, holding_company,
               valid_from, valid_to, is_current
        from history
        union all
        select 'unknown', null, 'Unknown Institution', null, null, null, null, null,
               date '1900-01-01', date '9999-12-31', true""",
    "staged_fin": """
        select cert, repdte, name, stalp, stname, bkclass, asset, dep, eq, netinc, roa, roe,
               cast(_ingested_at as timestamp) as ingested_at, _batch_id as batch_id
        from fin""",
    "fact": """
        select coalesce((select max(d.institution_sk) from dim d
                         where d.cert = f.cert and d.valid_from <= f.repdte and d.valid_to >= f.repdte),
                        'unknown') as institution_sk,
               f.* exclude (name)
        from staged_fin f""",
    "latest": """
        select cert, max(repdte) as latest_repdte, arg_max(asset, repdte) as latest_asset
        from fact group by cert""",
    "trends": """
        select cert, repdte, stalp as state, bkclass, roa, roe,
               roa - lag(roa) over each_bank as roa_qoq_change,
               roe - lag(roe) over each_bank as roe_qoq_change
        from fact window each_bank as (partition by cert order by repdte)""",
    "growth": """
        select cert, repdte, state, bkclass, asset,
               (asset - q) / nullif(q, 0) as asset_growth_qoq,
               (asset - y) / nullif(y, 0) as asset_growth_yoy
        from (select cert, repdte, stalp as state, bkclass, asset,
                     lag(asset) over (partition by cert order by repdte) as q,
                     lag(asset, 4) over (partition by cert order by repdte) as y
              from fact)""",
    "bank_state": """
        select cert, stalpbr as state, repdte, sum(depsumbr) as total_deposits
        from branch group by all""",
    "state_total": """
        select state, repdte, sum(total_deposits) as state_total_deposits
        from bank_state group by all""",
    "shares": """
        select cert, state, repdte, total_deposits,
               total_deposits / nullif(state_total_deposits, 0) as deposit_share
        from bank_state join state_total using (state, repdte)""",
    "institution": """
        select cert, name, city, state, bkclass, regagnt, holding_company, valid_from,
               latest_asset, latest_repdte
        from dim left join latest using (cert)
        where is_current and institution_sk <> 'unknown'""",
    "event": """
        select cast(user_id as varchar) as key, user_id as CERT, strftime(ts, '%Y%m%d') as REPDTE,
               value as ASSET, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as _ingested_at,
               lpad(cast(event_id as varchar), 12, '0') as _batch_id,
               cast(user_id % 4 as int) as source_partition, event_id as first_offset,
               event_id % 53 <> 0 as marked
        from events""",
}

_FIELDS = "cert repdte name stalp stname bkclass asset dep eq netinc roa roe".split()
_FIN = ", ".join([*_FIELDS, "_ingested_at", "_batch_id"])


def _raw(**changed: str) -> str:
    """The raw fields under their own names, some of them replaced by an expression."""
    return ", ".join(f'{changed.get(name, name)} as "{name.upper()}"' for name in _FIELDS)


_RAW = _raw()
_RAW_CASED = f"{_RAW}, _ingested_at, _batch_id"


def _with(body: str) -> str:
    """`body` with the named subqueries it uses, and those they use, in front."""
    used: list[str] = []

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in _VIEWS:
            if name in words and name not in used:
                visit(_VIEWS[name])
                used.append(name)

    visit(body)
    ctes = ",\n".join(f"{name} as ({_VIEWS[name]})" for name in _VIEWS if name in used)
    return f"with {ctes}\n{body}" if ctes else body


def _codes(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _ranking(metric: str, where: str | None = None, limit: int = 51, offset: int = 0) -> str:
    mart, column = METRICS[metric]
    source = {"mart_profitability_trends": "trends", "mart_asset_growth": "growth"}[mart]
    where = where or f"repdte = (select max(repdte) from {source} )"
    return f"""
        select rank, cert, name, ranked.state, repdte, '{metric}' as metric, value
        from (select rank() over (order by {column} desc) as rank, cert as bank, cert, state, repdte,
                     {column} as value
              from {source} where {where} and {column} is not null
              order by {column} desc, cert limit {limit} offset {offset}) ranked
        left join (select cert as c, name, valid_from, valid_to from dim ) names
          on c = cert and repdte between valid_from and valid_to"""


_REASON = """case when cert is null or repdte is null then 'missing_key' else 'negative_value' end"""

_SQL = {
    "pages_unwrap": """
        select o_orderkey as "ID", o_custkey as "CERT", o_totalprice as "ASSET",
               o_orderpriority as "NAME"
        from orders""",
    "pages_complete": """
        select strftime(quarter_end, '%Y%m%d') as source, count(*) as announced,
               count(*) filter (where o_orderstatus <> 'P') as received
        from filed group by 1 having count(*) filter (where o_orderstatus = 'P') > 0""",
    "raw_stamp": f"""
        select {_RAW},
               case when bkclass = 'BUILDING' then _ingested_at else '2026-01-01T00:00:00+00:00' end
                   as _ingested_at,
               case when bkclass = 'BUILDING' then _batch_id else 'batch-1' end as _batch_id,
               'file:/landed/' || repdte as _source_url,
               '2026-01-01T00:00:00+00:00' as _consumed_at
        from raw_fin""",
    "raw_union_keys": """
        select cert as "CERT", _batch_id, case when repdte < '19980101' then name end as "NAME",
               case when repdte >= '19980101' then stalp end as "STALP"
        from raw_fin""",
    "raw_overwrite": f"""
        select {_raw(asset="case when repdte >= '19980101' then asset + 1 else asset end")},
               _ingested_at, _batch_id
        from raw_fin""",
    "partitions": """select distinct repdte as dt from raw_fin""",
    "missing_periods": """
        select 'financials' as dataset, period
        from (select strftime(last_day(date '1990-03-01' + to_months(cast(3 * n as int))), '%Y%m%d') as period
              from range(40) quarters(n))
        where period like '%0331' or period not in (select repdte from raw_fin )
        union all
        select 'sod', cast(n as varchar) from range(1990, 2000) years(n)""",
    "missing_datasets": """
        select dataset from (values ('institutions'), ('financials'), ('sod')) required(dataset)
        where dataset <> 'financials' or not exists (select 1 from raw_fin )""",
    "drift_read": f"select {_FIN} from raw_fin",
    "refresh_dates": """
        select *, cast(null as varchar) as _reject_reason from redelivered_dedup
        where cert is not null and asset >= 0
        union all
        select *, 'negative_value' from redelivered_dedup where cert is not null and asset < 0
        union all
        select *, 'missing_key' from redelivered where cert is null""",
    "period_range": """
        select cert as "CERT", repdte as "REPDTE", _batch_id from raw_fin
        where repdte between '19960331' and '19971231'""",
    "load_financials": "select * from fin",
    "load_branches": "select * from branch",
    "load_history": "select * from history",
    "replay_messages": f"""
        select cast(cert as varchar) as key, {_RAW_CASED}, repdte as _repdte_partition
        from raw_fin where cert is not null""",
    "replay_partition": """
        select cast(cert as varchar) as key, cert as "CERT", repdte as "REPDTE", asset as "ASSET",
               roa as "ROA", _batch_id, repdte as _repdte_partition
        from raw_fin where cert is not null""",
    "replay_quarantine": """
        select repdte as "REPDTE", _batch_id, 'missing_key' as _reject_reason, repdte as dt
        from raw_fin where cert is null""",
    "project_financials": f"select {_FIN} from raw_fin",
    "project_branches": "select * from raw_branch",
    "project_snapshots": "select * from snapshot",
    "stg_financials": "select * from staged_fin",
    "stg_branches": """
        select * exclude (_ingested_at, _batch_id), cast(_ingested_at as timestamp) as ingested_at,
               _batch_id as batch_id
        from branch""",
    "stg_history": "select * from history",
    "dedupe_financials": "select * from dedup_fin",
    "dedupe_branches": "select * from dedup_branch",
    "quarantine_financials": f"""
        select *, {_REASON} as _reject_reason from dedup_fin
        where cert is null or repdte is null or asset < 0""",
    "quarantine_bad_cast": """
        select repdte, _batch_id,
               case when cast(_batch_id as bigint) % 89 = 0 then 'x' || cert else cert || '.5' end
                   as raw_cert,
               cast(null as bigint) as cert
        from raw_fin
        where cert is not null
          and (cast(_batch_id as bigint) % 89 = 0 or cast(_batch_id as bigint) % 83 = 0)""",
    "clean_text_keys": """
        select * from raw_fin
        where cert is not null and cast(_batch_id as bigint) % 89 <> 0
          and cast(_batch_id as bigint) % 83 <> 0
        qualify row_number() over (
            partition by cert, repdte order by _ingested_at desc, _batch_id desc) = 1
            and asset >= 0""",
    "quarantine_snapshots": """
        select _batch_id,
               case when n % 89 <> 0 and n % 83 <> 0 and n % 79 <> 0 then key end as cert,
               case when n % 73 <> 0 and n % 71 <> 0 then snapshot_date end as snapshot_date,
               case when n % 89 = 0 or n % 83 = 0 or n % 73 = 0 then 'bad_cast' else 'missing_key' end
                   as _reject_reason,
               case when n % 89 = 0 then 'x' || key when n % 83 = 0 then key || '.5' end as raw_cert,
               case when n % 73 = 0 then '20231399' end as raw_snapshot_date
        from (select _batch_id, cast(_batch_id as bigint) as n, cert as key, snapshot_date
              from snapshot )
        where n % 89 = 0 or n % 83 = 0 or n % 79 = 0 or n % 73 = 0 or n % 71 = 0""",
    "quarantine_branches": """
        select *, case when cert is null or uninumbr is null or repdte is null then 'missing_key'
                       else 'negative_value' end as _reject_reason
        from dedup_branch
        where cert is null or uninumbr is null or repdte is null or depsumbr < 0""",
    "quarantine_all_rejects": """
        select *, 'missing_key' as _reject_reason from raw_fin where cert is null
        union all
        select *, 'negative_value' from dedup_fin where cert is not null and asset < 0""",
    "clean_financials": "select * from good_fin",
    "clean_branches": "select * from good_branch",
    "clean_with_stream": "select * from good_fin",
    "restatement": """
        select * from (
            select * from (
                select * from raw_fin
                union all
                select * replace (asset + 50000 as asset, '2100-01-01' as _ingested_at)
                from raw_fin where bkclass = 'BUILDING')
            qualify row_number() over (
                partition by cert, repdte order by _ingested_at desc, _batch_id desc) = 1)
        where cert is not null and asset >= 0""",
    "scd2_history": """
        select * replace (cast(valid_from as varchar) as valid_from,
                          cast(valid_to as varchar) as valid_to)
        from history""",
    "history_spliced": """
        select * replace (cast(valid_from as varchar) as valid_from,
                          cast(valid_to as varchar) as valid_to)
        from history""",
    "dim_institution": "select * from dim",
    "dim_date": """
        select repdte as date_day, cast(year(repdte) as bigint) as year,
               cast(quarter(repdte) as bigint) as quarter,
               cast(year(repdte) as varchar) || '-Q' || cast(quarter(repdte) as varchar) as year_quarter
        from fin group by repdte""",
    "fct_financials": "select * from fact",
    "fct_financials_swept": "select * from fact",
    "mart_latest_financials": "select * from latest",
    "mart_profitability_trends": "select * from trends",
    "mart_asset_growth": """
        select *, rank() over (partition by repdte order by asset_growth_qoq desc nulls last)
                      as qoq_growth_rank
        from growth""",
    "bank_state_deposits": """
        select * replace (round(total_deposits, 2) as total_deposits) from bank_state""",
    "state_totals": """
        select * replace (round(state_total_deposits, 2) as state_total_deposits) from state_total""",
    "mart_deposit_concentration": """
        select cert, state, repdte, round(total_deposits, 2) as total_deposits,
               round(deposit_share, 8) as deposit_share,
               round(10000 * sum(deposit_share * deposit_share) over (partition by state, repdte), 4)
                   as state_hhi
        from shares""",
    "list_institutions": "select * from institution order by cert limit 51",
    "list_institutions_filtered": """
        select * from institution
        where state = 'NATION_3' and bkclass = 'BUILDING' and latest_asset between 50000 and 400000
        order by cert limit 51""",
    "page_institutions": "select * from institution order by cert limit 21 offset 40",
    "page_institutions_after": "select * from institution where cert > 75 order by cert limit 21",
    "page_financials_after": """
        select cert, repdte, stalp as state, bkclass, asset, dep, eq, netinc, roa, roe
        from fact where cert = 7 and repdte > date '1994-06-30' and repdte <= date '1999-12-31'
        order by repdte limit 6""",
    "get_institution": "select * from institution where cert = 7",
    "institution_financials": """
        select cert, repdte, stalp as state, bkclass, asset, dep, eq, netinc, roa, roe
        from fact where cert = 7 and repdte between date '1995-06-30' and date '1999-12-31'
        order by repdte limit 11""",
    **{f"rankings_{metric}": _ranking(metric) for metric in METRICS},
    "rankings_state": _ranking("roe", "state = 'NATION_3' and repdte = date '1996-03-31'"),
    "rankings_period": _ranking("asset_growth_qoq", "repdte = date '1997-06-30'", 31, 20),
    "rankings_deep": """
        select report, roa, rank
        from (select cert * 1000000 + date_diff('day', date '1990-01-01', repdte) as report, roa,
                     rank() over (order by roa desc nulls last) as rank
              from fact )
        order by rank, report limit 40 offset 900""",
    "health": """
        select 'ok' as status, timestamp '2026-01-01' as published_at, max(repdte) as max_repdte,
               count(*) as financials_row_count, cast(null as varchar) as detail
        from fact""",
    "health_published": """
        select 'ok' as status, timestamp '2026-01-01' as published_at, max(repdte) as max_repdte,
               count(*) as financials_row_count, cast(null as varchar) as detail
        from fact""",
    "freshness": """
        select timestamp '2026-01-01' as published_at, max(repdte) as max_repdte,
               count(*) as financials_row_count
        from fact""",
    "stream_landed": """
        select CERT as "CERT", REPDTE as "REPDTE", ASSET as "ASSET", _ingested_at, _batch_id,
               'kafka://filing.received' as _source_url, REPDTE as dt,
               'filing.received' as _kafka_topic, source_partition as _kafka_partition,
               first_offset as _kafka_offset
        from event where marked""",
    "stream_mixed_types": """
        select case when first_offset % 41 <> 0 then CERT end as "CERT", REPDTE as "REPDTE",
               ASSET as "ASSET", first_offset as _kafka_offset,
               case when first_offset % 41 = 0 then 'bad_cast' end as _reject_reason
        from event""",
    "stream_counts": """
        select count(*) filter (where marked) as landed, count(*) filter (where not marked) as quarantined
        from event""",
    "stream_quarantine": """
        select key as _kafka_key, source_partition as _kafka_partition, first_offset as _kafka_offset,
               'missing_partition' as _reject_reason
        from event where not marked""",
    "stream_deduped": """
        select CERT as "CERT", REPDTE as "REPDTE", ASSET as "ASSET", _ingested_at, _batch_id
        from event where marked
        qualify row_number() over (
            partition by CERT, REPDTE order by _ingested_at desc, _batch_id desc) = 1""",
    "stream_groups": """
        select REPDTE as dt, source_partition, count(*) as rows from event where marked group by all""",
    "stream_manifest": """
        select REPDTE as dt, source_partition, min(first_offset) as first_offset,
               max(first_offset) as last_offset, count(*) as rows
        from event where marked group by all""",
    "stream_labels": """
        select REPDTE as dt, source_partition, 'batch-1' as batch, count(*) as rows,
               printf('stream-p%d-%012d-%012d', source_partition, min(first_offset),
                      max(first_offset)) as label
        from event where marked group by REPDTE, source_partition""",
    "dq_not_null": "select cert, repdte, _batch_id from raw_fin where cert is null or repdte is null",
    "dq_unique": """
        select cert, repdte, count(*) as row_count from raw_fin
        where cert is not null and repdte is not null group by all having count(*) > 1""",
    "dq_unique_branches": """
        select cert, uninumbr, repdte, count(*) as row_count from raw_branch
        where cert is not null and uninumbr is not null and repdte is not null
        group by all having count(*) > 1""",
    "dq_fct_unique": """
        select cert, repdte, count(*) as row_count from fact group by all having count(*) > 1""",
    "dq_fct_unique_planted": """
        select cert, repdte, cast(2 as bigint) as row_count from fact where cert % 7 = 0""",
    "dq_overlap_planted": """
        select b.cert, b.valid_from, b.valid_to, max(a.valid_to) as prior_valid_to
        from ends_late a join ends_late b on a.cert = b.cert and a.valid_from < b.valid_from
        where b.valid_from <= a.valid_to group by all""",
    "dq_accepted": f"""
        select bkclass, count(*) as row_count from dim
        where bkclass not in ({_codes((*BANK_CLASSES, "BUILDING", "MACHINERY"))}) group by bkclass""",
    "dq_relationships": """
        select institution_sk, count(*) as row_count from fact
        where institution_sk not in (select institution_sk from history_sk ) group by all""",
    "dq_overlap": """
        select cert, snapshot_date as valid_from,
               cast(snapshot_date + interval 100 day as date) as valid_to,
               cast(previous + interval 100 day as date) as prior_valid_to
        from (select cert, snapshot_date,
                     lag(snapshot_date) over (partition by cert order by snapshot_date) as previous
              from daily)
        where snapshot_date < previous + interval 100 day""",
    "dq_overlap_history": """
        select b.cert, b.valid_from, b.valid_to, max(a.valid_to) as prior_valid_to
        from dim a join dim b on a.cert = b.cert and a.valid_from < b.valid_from
        where b.valid_from <= a.valid_to group by all""",
    "dq_rerun": """
        select unnest(['removed', 'added']) as change, cert, repdte,
               unnest([asset, asset + 1]) as asset, _batch_id, cast(1 as bigint) as copies
        from dedup_fin where repdte = '19970630' and cert is not null and asset >= 0
        union all
        select 'added', cert, repdte, asset + 1, _batch_id, 1
        from dedup_fin
        where repdte = '19970630' and cert is not null and asset < 0 and asset + 1 >= 0""",
}

_VIEWS["ends_late"] = """
        select cert, valid_from,
               case when is_current then valid_to else cast(valid_to + interval 10 day as date) end
                   as valid_to
        from dim where cert is not null"""
_VIEWS["history_sk"] = "select institution_sk from dim where institution_sk <> 'unknown'"


def _report() -> str:
    """Failures of every declared check, one row each."""
    models = {
        "dim_institution": "dim", "dim_date": "fin", "fct_bank_quarterly_financials": "fact",
        "mart_latest_financials": "latest", "mart_profitability_trends": "trends",
        "mart_asset_growth": "growth", "mart_deposit_concentration": "shares",
        "stg_institution_history": "history", "stg_financials": "staged_fin",
        "stg_branch_deposits": "branch",
    }
    required = {
        "dim_institution": ["institution_sk"],
        "dim_date": ["date_day"],
        "fct_bank_quarterly_financials": ["cert", "repdte", "institution_sk"],
        "mart_latest_financials": ["cert", "latest_repdte"],
        "mart_profitability_trends": ["cert"],
        "mart_asset_growth": ["cert"],
        "mart_deposit_concentration": ["cert", "state"],
        "stg_institution_history": ["cert", "valid_from", "valid_to"],
        "stg_financials": ["cert", "repdte"],
        "stg_branch_deposits": ["cert", "uninumbr", "repdte"],
    }
    unique = {
        "dim_institution": "institution_sk",
        "mart_latest_financials": "cert",
        "fct_bank_quarterly_financials": "cert,repdte",
    }
    accepted = [
        ("dim_institution", "bkclass", BANK_CLASSES),
        ("dim_institution", "state", STATE_CODES),
        ("fct_bank_quarterly_financials", "bkclass", BANK_CLASSES),
    ]
    rows = []
    for model, columns in required.items():
        for column in columns:
            source = "repdte" if column == "date_day" else column
            rows.append(
                f"select 'not_null' as \"check\", '{model}' as model, '{column}' as subject, "
                f"count(*) filter (where {source} is null) as failures from {models[model]}"
            )
    for model, column, values in accepted:
        rows.append(
            f"select 'accepted_values', '{model}', '{column}', "
            f"count(*) filter (where {column} not in ({_codes(values)})) from {models[model]}"
        )
    for model, key in unique.items():
        rows.append(
            f"select 'unique', '{model}', '{key}', count(*) from "
            f"(select {key} from {models[model]} group by all having count(*) > 1)"
        )
    rows.append(
        "select 'unique', 'dim_date', 'date_day', count(*) from "
        "(select day from (select distinct repdte as day from fin ) group by day having count(*) > 1)"
    )
    rows.append(
        "select 'relationships', 'fct_bank_quarterly_financials', 'institution_sk', "
        "count(distinct institution_sk) from fact "
        "where institution_sk not in (select institution_sk from dim )"
    )
    rows.append(
        "select 'no_overlapping_windows', 'dim_institution', 'valid_from,valid_to', count(*) "
        "from dim a join dim b on a.cert = b.cert and a.valid_from < b.valid_from "
        "and b.valid_from < a.valid_to"
    )
    return "\nunion all\n".join(rows)


def _drift() -> str:
    """The branch dictionary against the raw branch columns, one of them new and one retyped."""
    present = "CERT UNINUMBR NAMEFULL CITYBR STALPBR STNAMEBR DEPSUMBR ASSET YEAR".split()
    rows = [
        "select 'BRAND_NEW' as field, 'added' as drift, cast(null as varchar) as expected, "
        "'string' as found, count(stalpbr) as rows from raw_branch",
        "select 'UNINUMBR', 'retyped', 'number', 'string', count(uninumbr) from raw_branch",
    ]
    rows += [
        f"select '{name}', 'missing', '{kind}', null, 0"
        for name, kind in BRANCH_DICTIONARY.items()
        if name not in present
    ]
    return "\nunion all\n".join(rows)


_SQL["dq_rerun_by_day"] = _SQL["dq_rerun"]
_SQL |= {  # brought up to date, they are what they are when built anew
    "mart_latest_updated": _SQL["mart_latest_financials"],
    "mart_trends_updated": _SQL["mart_profitability_trends"],
    "mart_growth_updated": _SQL["mart_asset_growth"],
    "mart_concentration_updated": _SQL["mart_deposit_concentration"],
}
_SQL["dq_report"] = _report()
_SQL["schema_drift"] = _drift()


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _SQL.items()}
