"""The same queries as SQL for an independent engine."""

from __future__ import annotations

from tidelog import fixtures as fx

_BASE = f"base as ({fx.DEMO_BASE.format(customer='customer')})"
_CDC = f"cdc as ({fx.DEMO_CDC.format(events='events')})"

_LOG = f"""{_CDC}, log as (
  select seq, 0 as sub, '+I' as row_kind, after_id as id, actor, alias from cdc where op in ('c', 'r')
  union all select seq, 0, '-U', before_id, actor, alias from cdc where op = 'u'
  union all select seq, 1, '+U', after_id, actor, alias from cdc where op = 'u'
  union all select seq, 0, '-D', before_id, actor, alias from cdc where op = 'd'
)"""

_FLAT = f"""with {_CDC}
select seq, op,
  before_id, case when before_id is not null then actor end as before_actor,
  case when before_id is not null then alias end as before_alias,
  after_id, case when after_id is not null then actor end as after_actor,
  case when after_id is not null then alias end as after_alias
from cdc"""

_DENSE = f"""{_CDC}, dense as (
  select *, row_number() over (partition by part order by seq) - 1 as "offset" from cdc
)"""

_GAPPED = f"""{_DENSE}, gapped as (
  select * replace ("offset" + "offset" // 49 as "offset"), "offset" + 1 as rank from dense
)"""

_IMAGE = """case when {0}_id is not null
  then json_object('id', {0}_id, 'actor', actor, 'alias', alias) end"""
_ENVELOPE = f"""cast(json_object('before', {_IMAGE.format('before')},
  'after', {_IMAGE.format('after')}, 'op', op) as varchar)"""

# Keyed rows of creates and updates.
_UPS = f"{_CDC}, ups as (select seq, after_id as id, actor, alias from cdc where op in ('c', 'u'))"
_LATEST = f"""{_UPS}, latest as (
  select id, actor, alias from ups qualify row_number() over (partition by id order by seq desc) = 1
)"""
_KEYED = f"""{_CDC}, keyed as (
  select seq, coalesce(after_id, before_id) as id, after_id is not null as present, actor, alias from cdc
)"""


def _applied(base: str, cdc: str, inserting: str) -> str:
    """Record-by-record application in closed form, over relations ``base`` and ``cdc``."""
    return f"""steps as (
  select before_id as id, seq * 2 as q, true as is_delete, null as actor, null as alias
  from {cdc} where op in ('u', 'd')
  union all
  select after_id, seq * 2 + 1, false, actor, alias from {cdc} where op in ({inserting})
), ends as (
  select id, max(q) filter (is_delete) as last_delete from steps group by id
), live as (
  select s.id, s.actor, s.alias from steps s join ends e on s.id = e.id
  where not s.is_delete and s.q > coalesce(e.last_delete, -1)
  qualify row_number() over (partition by s.id order by s.q) = 1
), applied as (
  select id, actor, alias from {base} b
  where not exists (select 1 from ends e where e.id = b.id and e.last_delete is not null)
  union all
  select id, actor, alias from live l
  where not exists (select 1 from {base} b join ends e on e.id = b.id
                    where b.id = l.id and e.last_delete is null)
)"""


_APPLY = f"""with {_BASE}, {_CDC}, {_applied('base', 'cdc', "'c', 'u'")} select * from applied"""

_INITIAL = f"""with {_BASE}, {_CDC}, feed as (
  select * from cdc where seq > (select max(seq) // 2 from cdc)
), {_applied('base', 'feed', "'c', 'r', 'u'")}
select * from applied"""

_UPSERT = f"""with {_BASE}, {_LATEST}
select * from base where id not in (select id from latest) union all select * from latest"""

#: Events as the timed rows have them: ``fx.FASTER`` times as fast.
_TIMED = f"timed as (select * replace (make_timestamp(epoch_us(ts) // {fx.FASTER}) as ts) from events)"

_PARTED = f"""with {_TIMED}
select cast(event_id as bigint) as id, event_type as actor, props as alias,
  strftime(ts, '%Y%m%d') as ts_date, strftime(ts, '%H') as ts_hour, strftime(ts, '%M') as ts_minute
from timed"""

_BASE_WIDE = f"with {_BASE} select cast(id as bigint) as id, actor, alias from base"


def _published(clock: str) -> str:
    return f"""{_PARTED} where date_trunc('minute', ts) + interval 1 minute < (
  select {clock} from timed)"""


ORACLES: dict[str, str] = {
    "jdbc_scan": _BASE_WIDE,
    "jdbc_scan_json": f"""with {_BASE}
select cast(json_object('id', id, 'actor', actor, 'alias', alias) as varchar) as record from base""",
    "jdbc_scan_skewed": f"""with {_BASE}
select cast(case when id % 20 = 0 then id * 1000 else id end as bigint) as id, actor, alias from base""",
    "cdc_feed": _FLAT,
    "start_earliest": f'with {_DENSE} select part as partition, "offset" from dense',
    "start_after_offset": f"""with {_DENSE} select part as partition, "offset" from dense
where "offset" >= case part when 0 then 100 when 1 then 50 else 0 end""",
    "start_initial": _INITIAL,
    "kafka_json_decode": f"with {_UPS} select * from ups",
    "upsert_kafka_table": f"""with {_KEYED}, last as (
  select * from keyed qualify row_number() over (partition by id order by seq desc) = 1
) select id, actor, alias from last where present""",
    "upsert_kafka_changelog": f"""with {_KEYED}, pairs as (
  select *, coalesce(lag(present) over w, false) as was, lag(actor) over w as old_actor,
    lag(alias) over w as old_alias
  from keyed window w as (partition by id order by seq)
)
select seq, 0 as sub, '+I' as row_kind, id, actor, alias from pairs where present and not was
union all select seq, 0, '-U', id, old_actor, old_alias from pairs where present and was
union all select seq, 1, '+U', id, actor, alias from pairs where present and was
union all select seq, 0, '-D', id, old_actor, old_alias from pairs where not present and was""",
    "envelope_decode": _FLAT,
    "envelope_decode_variant": f"""with {_CDC}, mixed as (
  select *, case seq % 3 when 1 then seq::double when 2 then seq + 0.5::double end as score,
    case seq % 4 when 0 then 'true' when 1 then 'n' end as note from cdc)
select seq, op, {', '.join(
    f"case when {side}_id is not null then {value} end as {side}_{name}"
    for side in ("before", "after")
    for name, value in (("id", f"{side}_id::bigint"), ("actor", "actor"), ("alias", "alias"), ("score", "score"), ("note", "note"))
)} from mixed""",
    "raw_string_decode": f"""with {_UPS}
select seq, cast(json_object('id', id, 'actor', actor, 'alias', alias) as varchar) as value from ups""",
    "delimited_lines": f"with {_BASE} select id, actor as name from base",
    "inline_rows": f"""with {_BASE} select actor as name, id from base
union all select * from (values ('Alice', 1), ('Bob', 2), ('Charlie', 3)) p(name, id)""",
    "op_name": f"""with {_CDC}, coded as (
  select seq, case when seq % 13 = 0 then 'x' when seq % 17 = 0 then 't' else op end as op from cdc
) select seq, op, case op when 'r' then 'READ' when 'c' then 'CREATE' when 'u' then 'UPDATE'
  when 'd' then 'DELETE' when 't' then 'TRUNCATE' when 'm' then 'MESSAGE' end as op_name from coded""",
    "row_kind_op": f"""with {_LOG}, coded as (
  select seq, sub, case when seq % 13 = 0 then '?' else row_kind end as row_kind from log
) select *, case when row_kind in ('-U', '+U') then 'UPDATE' when row_kind = '-D' then 'DELETE'
  else 'INSERT' end as operation from coded""",
    "projection": f"with {_BASE} select id, actor from base",
    "changelog_stream": f"with {_LOG} select * from log",
    "retract_stream": f"""with {_LOG}
select seq, sub, row_kind in ('+I', '+U') as is_add, id, actor, alias from log""",
    "null_record_filter": f"""with {_CDC}
select seq, after_id as id, actor, alias from cdc where after_id is not null""",
    "changelog_flatten": f"with {_LOG} select id, actor, alias from log",
    "typed_record": _BASE_WIDE,
    "resequence": f"""with {_GAPPED}
select 'demo' as topic, part as partition, "offset", {_ENVELOPE} as value, "offset" - rank as run
from gapped""",
    "resequence_stream": f"""with {_GAPPED}
select 'demo' as topic, part as partition, "offset", {_ENVELOPE} as value,
  "offset" - coalesce(lag("offset") over (partition by part order by "offset"), -1) - 1 as skipped,
  false as late
from gapped""",
    "row_to_text": f"""with {_UPS}
select seq, 'Demo(id=' || id || ', actor=' || coalesce(actor, 'null') || ', alias='
  || coalesce(alias, 'null') || ')' as line from ups""",
    "partition_columns": """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as create_time,
  strftime(ts, '%Y%m%d') as ts_date, strftime(ts, '%H') as ts_hour, strftime(ts, '%M') as ts_minute
from events""",
    "widen_cast": _BASE_WIDE,
    "upsert_kafka_encode": f"""with {_LOG}, paired as (
  select *, lead(id) over (partition by seq order by sub) as next_id from log
) select cast(json_object('id', id) as varchar) as key,
  case when row_kind not in ('-D', '-U')
    then cast(json_object('id', id, 'actor', actor, 'alias', alias) as varchar) end as value,
  seq * 2 + sub as "offset"
from paired where row_kind <> '-U' or id <> next_id""",
    "cdc_apply": _APPLY,
    "cdc_apply_stream": _APPLY,
    "resume_exactly_once": _APPLY,
    "job_initial_stream": _APPLY,
    "snapshot_diff": f"""with {_BASE}, {_CDC}, feed as (
  select * from cdc where seq <= (select max(seq) // 2 from cdc)
), {_applied('base', 'feed', "'c', 'u'")}
select (select max(seq) // 2 from cdc) as seq,
  case when b.id is null then 'c' when a.id is null then 'd' else 'u' end as op,
  b.id as before_id, b.actor as before_actor, b.alias as before_alias,
  a.id as after_id, a.actor as after_actor, a.alias as after_alias
from base b full join applied a on a.id = b.id
where a.id is null or b.id is null or a.actor is distinct from b.actor or a.alias is distinct from b.alias""",
    "insert_if_absent": f"""with {_BASE}, {_UPS}, first as (
  select id, actor, alias from ups qualify row_number() over (partition by id order by seq) = 1
) select * from base union all select * from first where id not in (select id from base)""",
    "delete_by_key": f"""with {_BASE}, {_CDC}
select * from base where id not in (select before_id from cdc where op = 'd')""",
    "upsert_apply": _UPSERT,
    "upsert_apply_stream": _UPSERT,
    "upsert_apply_deletes": f"""with {_BASE}, {_KEYED}, last as (
  select * from keyed qualify row_number() over (partition by id order by seq desc) = 1
) select * from base where id not in (select id from last)
union all select id, actor, alias from last where present""",
    "update_by_key": f"""with {_BASE}, {_LATEST}
select b.id, case when l.id is null then b.actor else l.actor end as actor,
  case when l.id is null then b.alias else l.alias end as alias
from base b left join latest l on b.id = l.id""",
    "rolling_text_sink": f"""with {_CDC}
select strftime(ts, '%Y-%m-%d--%H') as bucket, op, before_id, after_id from cdc""",
    "rolling_text_pack": f"""with {_LOG}, lines as (
  select 'Demo(id=' || log.id || ', actor=' || coalesce(log.actor, 'null') || ', alias='
    || coalesce(log.alias, 'null') || ')' as line, strftime(cdc.ts, '%Y-%m-%d--%H') as bucket
  from log join cdc using (seq))
select bucket, cast(ceil(sum(octet_length(encode(line)) + 1) / 1000.0) as bigint) as files,
  cast(sum(octet_length(encode(line)) + 1) as bigint) as bytes, count(*) as lines
from lines group by bucket""",
    "parquet_sink": _BASE_WIDE,
    "partitioned_insert": _PARTED,
    "append_only_guard": f"""with {_LOG}
select cdc.op, count(*) as rows, bool_or(row_kind <> '+I') as refused
from log join cdc using (seq) group by cdc.op""",
    "partition_commit": _published("max(ts)"),
    "partition_commit_feeds": f"""{_PARTED}, (
  select min(event_id) + 2 * ((max(event_id) - min(event_id)) // 3 + 1) as third from events) cut
where (event_id % 2 = 0 or event_id < third)
  and date_trunc('minute', ts) + interval 1 minute < least(
    (select max(ts) from timed where event_id % 2 = 0),
    (select max(case when event_id % 2 = 1 and event_id < third then ts end) from timed, (
      select min(event_id) + 2 * ((max(event_id) - min(event_id)) // 3 + 1) as third from events) c))""",
    "insert_select": f"with {_BASE} select actor as name, id from base",
    "insert_overwrite": f"with {_BASE} select id, alias as name from base",
    "text_append": f"""with {_BASE}
select id || chr(9) || 'name' || id as line from base, range(2)""",
    "drop_partition": """select event_id, strftime(ts, '%Y%m%d') as ts_date from events
where strftime(ts, '%Y%m%d') <> '20240101'""",
    "sql_script": f"""with {_BASE} select * from base
union all select id, 'a;b', alias from base where alias = 'BUILDING'""",
    "job_changelog": f"with {_LOG} select * from log",
    "job_jdbc_to_parquet": _BASE_WIDE,
    "job_image_log": f"""with {_LOG}
select 'Demo(id=' || log.id || ', actor=' || coalesce(log.actor, 'null') || ', alias='
  || coalesce(log.alias, 'null') || ')' as line, strftime(cdc.ts, '%Y-%m-%d--%H') as bucket
from log join cdc using (seq)""",
    "job_cdc_upsert": f"""with {_BASE}, {_LOG}, last as (
  select * from log qualify row_number() over (partition by id order by seq desc, sub desc) = 1
) select * from base where id not in (select id from last)
union all select id, actor, alias from last where row_kind not in ('-D', '-U')""",
    "job_partitioned_table": _published("date_trunc('second', max(ts))"),
    "job_lines_to_table": f"with {_BASE} select id, actor as name from base",
    "job_jdbc_insert_if_absent": f"""with {_BASE}
select * from base union all
select cast(c_custkey as int), 'from database ' || c_name, c_mktsegment from customer
where c_custkey not in (select id from base)""",
}
