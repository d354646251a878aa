"""DuckDB text of the fixture graph (the oracle side of the correctness check).

The fixture rows as CTEs over the base tables, then the loaded graph stated
in SQL of its own: one relation of vertices, one of named edges, a map of end
labels, ids by ``dense_rank``, one join that resolves every label. Every
oracle query is ``WITH <these>[, extra] <select>``; DuckDB drops the CTEs a
query does not use.
"""

BASE_CTES = r"""
mobile AS (
  select c_name as name, c_name as nm_pass, sha1(c_name) as nm_sha1,
    case when c_acctbal>0 then 'true' end as is_register, case when c_acctbal<0 then 'true' end as is_risk,
    cast(null as varchar) as is_internal, case when c_custkey%10=0 then 'true' end as is_service,
    c_mktsegment as merchant_name, cast(nullif(c_nationkey%5,0) as int) as status,
    cast(case when c_custkey%4<2 then c_custkey%4 end as int) as suspect_risk,
    cast(nullif(c_custkey%3,0) as int) as overdue_status, c_custkey as k
  from customer
),
device AS (
  select case when p_partkey%50=0
           then concat('Supplier#',lpad(cast(cast(floor(p_partkey/50) as bigint) as varchar),9,'0'))
           else concat('FP',p_partkey) end as name,
    case when p_size>40 then 'true' end as is_exception, case when p_size<5 then 'true' end as is_white,
    p_partkey as k
  from part
),
wifi_raw AS (
  select s_name as name, case when s_acctbal<0 then 'true' end as is_exception,
    cast(null as varchar) as is_white, s_suppkey as k
  from supplier
),
call_base AS (
  select m.c_name as start_name, (o_custkey*31+o_orderkey*17) % (select count(*) from customer) as target,
    case o_orderstatus when 'F' then 1 when 'P' then 0 end as mgm, o_orderkey as ord
  from orders join customer m on o_custkey=c_custkey
),
call_e AS (
  select start_name,
    case when ord%97=0 then 'missing' else concat('Customer#',lpad(cast(target as varchar),9,'0')) end as end_name,
    mgm
  from call_base
),
-- every vertex row of the three labels in one relation, the short tag of a label is its first letter
vertex AS (
  select 'MOBILE' as label, k, name, nm_pass, nm_sha1, is_register, is_risk, is_internal, is_service, merchant_name,
    status, suspect_risk, overdue_status, cast(null as varchar) as is_exception, cast(null as varchar) as is_white
  from mobile
  union all by name select 'DEVICE' as label, * from device
  union all by name select 'WIFI' as label, * from wifi_raw
),
clash AS (select name, count(distinct label) as labels from vertex group by name having count(distinct label) > 1),
vwide AS (
  select dense_rank() over (order by name) as id, * exclude (k)
  from vertex where name is not null and (label <> 'WIFI' or name not in (select name from clash))
),
-- every edge row by name in one relation
bought AS (
  select c_name as who, l_partkey, l_suppkey, l_returnflag
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
),
named AS (
  select 'CALL' as label, start_name, end_name, mgm from call_e
  union all select distinct 'USE', who, v.name, cast(null as int) from bought join vertex v on v.label = 'DEVICE' and v.k = l_partkey
  union all select distinct 'USE_WIFI', who, v.name, null from bought join vertex v on v.label = 'WIFI' and v.k = l_suppkey
  union all select distinct 'HAS', v.name, who, null from bought join vertex v on v.label = 'DEVICE' and v.k = l_partkey
            where l_returnflag = 'R'
),
ends(label, src, dst) AS (values ('CALL', 'MOBILE', 'MOBILE'), ('USE', 'MOBILE', 'DEVICE'), ('HAS', 'DEVICE', 'MOBILE'),
  ('USE_WIFI', 'MOBILE', 'WIFI')),
edges AS (
  select n.label, s.id as start_id, t.id as end_id, n.mgm
  from named n join ends using (label)
  join vwide s on (s.label, s.name) = (src, n.start_name) join vwide t on (t.label, t.name) = (dst, n.end_name)
),
printed AS (
  select id, label, array_to_string([coalesce(x, '') for x in case when label = 'MOBILE'
    then [name, nm_pass, nm_sha1, is_register, is_risk, is_internal, is_service, merchant_name, status::varchar,
          suspect_risk::varchar, overdue_status::varchar]
    else [name, is_exception, is_white] end], ',') as props
  from vwide
),
touching AS (
  select unnest([{'id': start_id, 'label': src, 'dir': 'out', 'other': end_id}, {'id': end_id, 'label': dst, 'dir': 'in',
    'other': start_id}], recursive := true), edges.label as edge, mgm
  from edges join ends on ends.label = edges.label
),
sides AS (
  select id, label, dir, string_agg(entry, '|' order by edge, other, entry) as entries
  from (select *, concat_ws(',', edge, other, case when edge = 'CALL' then coalesce(mgm::varchar, '') end) as entry from touching)
  group by all
),
adj_lines AS (
  select p.id, p.label, concat(p.id, ',', p.label, ',', min(props), chr(9),
    coalesce(any_value(entries) filter (where dir = 'in'), ''), chr(9),
    coalesce(any_value(entries) filter (where dir = 'out'), '')) as line
  from printed p left join sides s on s.id = p.id and s.label = p.label group by p.id, p.label
)
"""


def with_base(select: str, extra_ctes: str = "") -> str:
    """Full oracle text: the base CTEs, optional extra CTEs, then the query."""
    extra = f",\n{extra_ctes.strip()}" if extra_ctes.strip() else ""
    return f"WITH {BASE_CTES.strip()}{extra}\n{select.strip()}"
