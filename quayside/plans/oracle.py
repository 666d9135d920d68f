"""SQL that gives the same rows as the acceptance queries."""

from __future__ import annotations

from quayside.plans.acceptance import PULLED, TABLES

LO = "timestamp '2024-01-08 00:00:00'"
HI = "timestamp '2024-01-15 12:00:00'"
KEY = "regexp_replace(url, '[?#].*$', '')"

ROW_COUNTS = " union all ".join(
    f"select '{name}' as entity, count(*) as row_count from {name}" for name in TABLES
)

DECLARED = (
    "select 'click' as entity union all select 'View' union all select 'error' "
    "union all select 'missing'"
)

# One key per document, as the listing of the file selection queries.
LISTING = """
    select path, max(modified) as modified from (
        select concat('src/de/src_de_', lang, '/',
                      case source when 'src1' then '20240115120000'
                                  when 'src2' then '20240108000000' else source end,
                      '/', n_chars, '.parquet') as path,
               timestamp '2023-12-20 00:00:00' + n_chars * interval '1' hour as modified
        from documents) l
    group by path"""

MARKED = f"""
    select path, modified, w as in_window, f as forced, not e as taken from (
        select path, modified, modified > {LO} and modified <= {HI} as w,
               pulled and folder = '20240115120000' as f,
               pulled and folder = '20240108000000' as e
        from (select path, modified, split_part(path, '/', 4) as folder,
                     split_part(path, '/', 3) in ('src_de_en', 'src_de_fr') as pulled
              from ({LISTING}) k) m) x
    where w or f"""

SQL = {
    "landing_report": f"""
        with landed as (select lower(event_type) as entity, count(*) as row_count from events
                        where ts > {LO} and ts <= {HI} group by lower(event_type)),
             declared as ({DECLARED})
        select lower(d.entity) as entity, l.row_count
        from declared d join landed l on lower(d.entity) = l.entity""",
    "entity_row_counts": ROW_COUNTS,
    "entity_columns": f"""
        select c.table_name as entity, c.ordinal_position as position, c.column_name as name,
               case c.data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
                    when 'VARCHAR' then 'string' when 'DOUBLE' then 'double'
                    when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT[]' then 'array<float>'
                    else c.data_type end as type,
               n.row_count
        from information_schema.columns c join ({ROW_COUNTS}) n on c.table_name = n.entity""",
    "incremental_half_open": f"""
        select event_id, ts, event_type from events where ts > {LO} and ts <= {HI}""",
    "pull_between_inclusive": """
        select o_orderkey, o_custkey, o_orderdate from orders
        where o_orderdate between timestamp '1997-01-01 00:00:00'
                              and timestamp '1997-01-31 00:00:00'""",
    "window_or_forced_entity": f"""
        select event_id, event_type from events
        where (ts > {LO} and ts <= {HI}) or event_type in ('signup', 'error')""",
    "suffix_semi_join": f"""
        with p as (select page_id, regexp_replace({KEY}, '/[^/]*$', '') as parent from pages),
             k as (select distinct concat('/', lang) as suffix from documents
                   where lang in ('fr', 'de'))
        select page_id, parent from p
        where exists (select 1 from k where right(p.parent, length(k.suffix)) = k.suffix)""",
    "entity_from_path": f"""
        select page_id, split_part({KEY}, '/', 3) as host,
               lower(split_part({KEY}, '/', 4)) as entity,
               split_part({KEY}, '/', -1) as file_name
        from pages""",
    "rejected_keys": f"""
        select page_id, path from (select page_id, {KEY} as path from pages) p
        where length(path) - length(replace(path, '/', '')) < 5""",
    "expand_landing_path": """
        select doc_id,
               replace(replace(replace(replace(
                   '<source-system>/<cluster>/<loadid>/<entity>/part.parquet',
                   '<source-system>', source), '<cluster>', lang),
                   '<loadid>', '20240115120000'),
                   '<entity>', cast(doc_id as varchar(20))) as target_path
        from documents""",
    "last_wins_per_target": """
        select user_id, event_type, event_id, ts from (
            select *, row_number() over (partition by user_id, event_type
                                         order by ts desc, event_id desc) as rn
            from events) t
        where rn = 1""",
    "active_entities": """
        select d.doc_id, d.source, d.lang from documents d join labels l on d.doc_id = l.doc_id
        where l.quality = 1 and d.lang = 'en'""",
    "active_entities_of_source": """
        select c_name as entity, cast(c_custkey as varchar) as data_product,
               lower(c_mktsegment) as subject_area
        from customer
        where c_mktsegment = 'BUILDING' and c_nationkey = 7 and c_acctbal > 0""",
    "query_entity_config": """
        select upper(c.c_name) as entity, concat('de_', lower(c.c_name)) as source_metadata_id,
               m.c_name as first_column, 'ts' as ts_column,
               timestamp '2024-01-08 00:00:00' as last_run_ts
        from customer c join customer m
             on concat('de_', lower(upper(c.c_name))) = concat('de_', lower(m.c_name))
        where m.c_mktsegment = 'BUILDING'""",
    "per_entity_watermark_pull": f"""
        with w as (select event_type, timestamp '2024-01-02 00:00:00'
                          + (length(event_type) * interval '1' day) as last_ts
                   from (select distinct event_type from events) x)
        select e.event_id, e.event_type, e.ts
        from events e join w on e.event_type = w.event_type
        where e.ts between w.last_ts and {HI}""",
    "declared_vs_landed_counts": f"""
        with landed as (select lower(event_type) as entity, count(*) as row_count
                        from events group by lower(event_type)),
             declared as ({DECLARED})
        select d.entity, l.row_count from declared d join landed l on d.entity = l.entity""",
    "rerun_exists": f"""
        select exists(select 1 from events where event_type = 'purchase' and user_id = 8
                      and ts <= {HI}) as is_rerun""",
    "not_yet_loaded": """
        select d.doc_id, d.source from documents d
        where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)""",
    "already_loaded": """
        select d.doc_id, d.source from documents d
        where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)""",
    "window_file_count": f"""
        select count(*) as total,
               cast(sum(case when ts > {LO} and ts <= {HI} then 1 else 0 end) as bigint)
                   as in_window
        from events""",
    "watermark_upsert": f"""
        with old as (select event_type as k, max(ts) as v from events
                     where ts <= timestamp '2024-01-03 00:00:00' and event_type <> 'signup'
                     group by event_type),
             upd as (select event_type as k, max(ts) as v from events
                     where ts <= {HI} and event_type <> 'error' group by event_type)
        select coalesce(upd.k, old.k) as k, coalesce(upd.v, old.v) as v
        from old full outer join upd on old.k = upd.k""",
    "latest_status": """
        select process_id, job_run_status, logged_at, load_id from (
            select o_custkey as process_id,
                   case when o_orderstatus = 'F' then 'success' else 'Failed' end
                       as job_run_status,
                   o_orderdate as logged_at, o_orderkey as load_id,
                   row_number() over (partition by o_custkey
                                      order by o_orderdate desc, o_orderkey desc) as rn
            from orders) t
        where rn = 1""",
    "job_id_last_match": """
        select o_custkey, o_orderstatus, max(o_orderkey) as job_id
        from orders group by o_custkey, o_orderstatus""",
    "first_row": """
        select o_orderkey, o_custkey, o_orderdate from orders
        order by o_orderdate desc, o_orderkey limit 1""",
    "all_string_rows": """
        select cast(o_orderkey as varchar(30)) as o_orderkey,
               cast(o_custkey as varchar(30)) as o_custkey, o_orderstatus, o_orderpriority
        from orders""",
    "page_union": """
        select conv_id, turn, role from conversations where turn = 0
        union all select conv_id, turn, role from conversations where turn > 0""",
    "response_pages": """
        select cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn, role, text
        from conversations""",
    "failed_pages": """
        select cast(sum(case when role = 'user' then 0 else 1 end) as bigint) as failed_pages,
               count(*) as row_count
        from conversations""",
    "props_json": "select event_id, json_extract_string(props, '$.k') as k from events",
    "load_id_to_iso": """
        with ids as (select o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') as load_id
                     from orders)
        select o_orderkey, load_id,
               strftime(strptime(load_id, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S')
                   as file_watermark,
               strftime(strptime(load_id, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S.000Z')
                   as entity_watermark
        from ids""",
    "not_marker": f"""
        select page_id from pages
        where not ({KEY} like '%/') and not ({KEY} like '%$folder$')""",
    "run_details": f"""
        select entity, row_count, cast(0 as bigint) as error_count, 'success' as status
        from ({ROW_COUNTS}) x""",
    "select_files": f"select path, modified from ({MARKED}) m where taken",
    "landing_plan": f"""
        select path, entity, target_path, in_window, forced, taken,
               coalesce(taken and path = max(case when taken then path end)
                                         over (partition by target_path), false) as lands
        from (select *, split_part(split_part(path, '/', 3), '_', 3) as entity,
                     concat('src/de/20240115120000/',
                            split_part(split_part(path, '/', 3), '_', 3), '/',
                            split_part(path, '/', -1)) as target_path
              from ({MARKED}) m) t""",
    "landed_entities": """
        select lower(event_type) as entity, event_id, ts, user_id, event_type, value, props
        from events""",
    "landed_exactly": """
        select o_orderkey, o_custkey, chunk from orders, (values (1), (2), (20000)) c(chunk)
        where o_orderkey % 5 in (1, 2)""",
    "landed_as_text": """
        select cast(o_orderkey as varchar) as o_orderkey,
               case when o_orderkey % 4 <> 3 then cast(o_custkey as varchar) end as o_custkey,
               o_orderstatus, chunk
        from orders, (values (3), (20000)) c(chunk)""",
    "allowed_formats": "select o_orderkey, 'parquet' as format, 3 as refused from orders",
    "run_times": """
        select event_type as entity, count(*) as row_count, true as within, cast(1 as bigint) as ends
        from events group by event_type""",
    "resumed_load": """
        with h as (select max(o_orderdate) as hi from orders),
        p as (select o_orderkey, o_orderdate, hi from orders, h
              where o_orderdate between timestamp '1995-01-01 00:00:00' and hi)
        select cast(o_orderkey as varchar) as o_orderkey,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate,
               (select count(*) from p) as row_count, cast(1 as bigint) as details,
               (select count(*) from p) as detailed, hi as file_mark, hi as entity_mark
        from p""",
    "committed_landing": """
        select o_orderkey, o_custkey,
               (select count(*) from orders where o_orderkey % 3 = 0) as first,
               (select count(*) from orders where o_orderkey % 3 = 0) as after_one,
               (select count(*) from orders where o_orderkey % 3 = 0) as after_two,
               (select count(*) from orders where o_orderkey % 3 = 2) as written
        from orders where o_orderkey % 3 = 2""",
    "compacted_control": """
        with l as (select user_id, event_type, max(ts) as last, count(*) as n
                   from events group by user_id, event_type)
        select user_id, arg_max(event_type, last) as job_run_status,
               cast(arg_max(n, last) as varchar) as error_message, count(*) as logged,
               max(last) as mark, true as few_files
        from l group by user_id""",
    "observed_counts": """
        select lower(event_type) as entity, count(*) as observed, cast(6 as bigint) as columns,
               count(*) as row_count
        from events group by 1""",
    "ordered_pages": """
        select row_number() over (partition by conv_id order by turn) - 1 as place,
               cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn, role
        from conversations""",
    "switched_tables": f"""
        select n.name, a.row_count as first, a.row_count as after_failure, b.row_count as last
        from (values ('region', 'region', 'nation'), ('nation', 'nation', 'orders'),
                     ('orders', 'orders', 'customer'), ('customer', 'customer', 'region'),
                     ('gone', 'region', null)) n(name, now, later)
             join ({ROW_COUNTS}) a on a.entity = n.now
             left join ({ROW_COUNTS}) b on b.entity = n.later""",
    "sliced_pull": """
        with f as (select l_orderkey, l_linenumber, l_shipdate,
                          case when l_orderkey % 3 = 0 then 'hot' else 'p' || l_partkey end as entity
                   from lineitem),
        p as (select * from f
              where l_shipdate between timestamp '1995-01-01 00:00:00' + length(entity) * interval '100' day
                                   and timestamp '1997-06-30 00:00:00')
        select *, 'joined' as way from p
        union all select *, 'filtered' as way from p where entity in ('hot', 'p1', 'p22')""",
    "pull_without_repeats": """
        with b as (select * from (values
                (0, timestamp '1993-01-01 00:00:00', timestamp '1994-06-15 00:00:00'),
                (1, timestamp '1994-06-15 00:00:00', timestamp '1996-02-29 00:00:00'),
                (2, timestamp '1996-02-29 00:00:00', timestamp '1998-01-01 00:00:00')) b(pull, lo, hi))
        select o_orderkey, o_custkey, o_orderdate, pull
        from orders join b on (o_orderdate > lo and o_orderdate < hi)
             or (o_orderdate = hi and o_orderkey % 7 <> 0)
             or (o_orderdate = lo and (pull = 0 or o_orderkey % 7 = 0))""",
    "listed_by_tasks": """
        select strftime(o_orderdate, '%Y-%m') as month, count(distinct o_orderpriority) as folders,
               cast(3 as bigint) as ways, count(*) as row_count
        from orders group by 1""",
    "landed_since": """
        select load_id, (select count(*) from events) as row_count, cast(3 as bigint) as loads,
               cast(0 as bigint) as before
        from (values ('20240101000000'), ('20240102000000'), ('20240103000000')) l(load_id)""",
    "control_round_trip": """
        with m as (select strftime(o_orderdate, '%Y%m01000000') as load_id, count(*) as row_count,
                          max(o_orderdate) as last
                   from orders group by 1)
        select load_id, 'success' as job_run_status, 'ord' as entity, row_count,
               (select max(last) from m) as file_mark, (select max(last) from m) as entity_mark
        from m""",
    "published_counts": """
        select lower(event_type) as entity, count(*) as row_count, count(*) as table_count
        from events group by 1""",
    "cleared_tables": f"""
        select n.name, cast(0 as bigint) as left_over, c.row_count
        from (values ('region'), ('nation'), ('orders'), ('seen')) n(name)
             left join ({ROW_COUNTS}) c on c.entity = n.name""",
    "inventory_selection": f"select path, modified from ({MARKED}) m where taken",
    "written_pull": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
               o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate
        from orders
        where o_orderdate between timestamp '1990-01-01 00:00:00'
                              and timestamp '2000-01-01 00:00:00'""",
    "published_tables": ROW_COUNTS,
    "land_batch": " union all ".join(
        [
            f"select '{name}' as entity, 'product {name}' as data_product, "
            f"'query' as subject_area, count(*) as row_count from {name}"
            for name in PULLED
        ]
        + [
            "select 'doc_' || coalesce(lang, 'none') as entity, "
            "'product doc_' || coalesce(lang, 'none') as data_product, "
            "'file' as subject_area, count(*) as row_count from documents group by lang"
        ]
    ),
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
