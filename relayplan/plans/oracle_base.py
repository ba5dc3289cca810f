"""The logical input tables as DuckDB SQL CTEs (FIXTURES.md B).

Only the raw driver tables are views in the oracle, so every oracle query
inlines these. They must describe the same rows as ``sources/tables.py``.
"""

BASE_CTES = r"""
req as (select o_orderkey as request_id, o_custkey%5 as kind,
  concat('prj-',cast(o_orderkey%8 as varchar)) as project_id,
  concat('dst-',cast(o_custkey%4 as varchar)) as dest_project_id,
  concat('/copies/',cast(o_orderkey as varchar),'/') as dest_path,
  concat(case when o_custkey%29=0 then 'gs' else 'icav2' end,'://dst-',
    cast(o_custkey%4 as varchar),'/copies/',cast(o_orderkey as varchar),
    case when o_custkey%23=0 then '' else '/' end) as destination_uri,
  concat('/runs/',cast(year(o_orderdate) as varchar),'/',cast(o_orderkey as varchar),'/') as src_folder,
  o_custkey, o_orderdate as requested_at, md5(cast(o_orderkey as varchar)) as task_token
  from orders),
inv as (select concat('prj-',cast(l_orderkey%8 as varchar)) as project_id,
  concat('fil.',cast(l_orderkey as varchar),'.',cast(l_linenumber as varchar)) as data_id,
  concat('/runs/',cast(year(o_orderdate) as varchar),'/',cast(l_orderkey as varchar),'/',
    min(l_returnflag),'/L',cast(l_linenumber as varchar),'.dat') as path,
  concat('L',cast(l_linenumber as varchar),'.dat') as name,
  cast(min(l_quantity) as bigint)*524288 as size,
  case when l_orderkey%50=0 and l_linenumber=7 then null
       when min(l_quantity)>16 then concat(md5(concat(cast(l_orderkey as varchar),'.',cast(l_linenumber as varchar))),
         '-',cast(cast(ceil(min(l_quantity)/16) as bigint) as varchar))
       else md5(concat(cast(l_orderkey as varchar),'.',cast(l_linenumber as varchar))) end as etag,
  l_orderkey, l_linenumber
  from lineitem join orders on l_orderkey=o_orderkey
  group by l_orderkey,l_linenumber,o_orderdate),
fold as (select distinct project_id, anc as path from (
    select project_id, concat(array_to_string(list_slice(parts,1,i),'/'),'/') as anc
    from (select project_id, parts, unnest(range(1, len(parts))) as i
          from (select project_id, string_split(path,'/') as parts from inv)))
  where anc <> '/'),
inventory as (select project_id, data_id, 'FILE' as data_type, path, name, size, etag,
    'AVAILABLE' as status, project_id as owning_project_id from inv
  union all select project_id, concat('fol.',substr(md5(concat(project_id,':',path)),1,16)), 'FOLDER', path,
    regexp_extract(path,'([^/]+)/*$',1), cast(null as bigint), cast(null as varchar), 'AVAILABLE', project_id
    from fold),
ext as (select doc_id, doc_id as s3_object_id, source as bucket,
  concat(lang,'/doc_',cast(doc_id as varchar),'.txt') as key,
  concat('s3://',source,'/',lang,'/doc_',cast(doc_id as varchar),'.txt') as uri,
  n_chars as size, concat(md5(text), case when n_chars>4000 then '-2' else '' end) as etag,
  doc_id%11<>0 as current_state from documents),
src as (select request_id, 0 as pos, concat('icav2://',project_id,src_folder) as source_uri
    from req where kind in (0,1,4)
  union all select request_id, l_linenumber, concat('icav2://',inv.project_id,inv.path)
    from req join inv on l_orderkey=request_id where kind in (2,3)
  union all select request_id, 1, uri from req
    join ext on doc_id=o_custkey where kind=4),
dst as (select dest_project_id as project_id,
  concat('dst.',cast(request_id as varchar),'.',cast(l_linenumber as varchar)) as data_id,
  'FILE' as data_type, case when kind in (2,3) then concat(dest_path,name)
    else concat(dest_path,cast(request_id as varchar),'/',substr(path,length(src_folder)+1)) end as path, name,
  case when (cast(floor(request_id/10) as bigint)+l_linenumber)%7=0 then 'PARTIAL' else 'AVAILABLE' end as status,
  case when (cast(floor(request_id/10) as bigint)+l_linenumber)%7=2 then size+1 else size end as size
  from req join inv on l_orderkey=request_id
  where (cast(floor(request_id/10) as bigint)+l_linenumber)%7<=2),
job as (select event_id, concat('job-',cast(cast(floor(event_id/5) as bigint) as varchar)) as job_id,
  cast(floor(event_id/5) as bigint) as j, ts,
  case event_type when 'click' then 'WAITING_FOR_RESOURCES' when 'view' then 'RUNNING'
    when 'signup' then 'SUCCEEDED' when 'purchase' then 'PARTIALLY_SUCCEEDED' else 'FAILED' end as status
  from events),
reg as (select job_id as id, case when j%9=0 then 'OTHER' else 'JOB_ID' end as id_type,
  md5(job_id) as task_token, min(ts) as registered_at
  from job where j%3<>0 or j%9=0 group by job_id,j),
regp as (select id,id_type,task_token,registered_at from reg
  union all select concat('job-p',cast(j as varchar)),'JOB_ID',md5(concat('job-p',cast(j as varchar))),min(ts)
    from job where j%5=0 group by j),
extl as (select request_id, concat('s3://',source,'/') as ext_prefix,
  concat('s3://',source,'/',lang,'/doc_',cast(doc_id as varchar),'.txt') as uri
  from req join documents on doc_id=o_custkey where kind=4),
ren as (select request_id, 1 as item, source_uri as input_uri, cast(null as varchar) as data_id,
    'renamed_L1.dat' as output_file_name
    from src join req using(request_id) where kind in (2,3) and source_uri like '%/L1.dat'
  union all select request_id, 2, cast(null as varchar), concat('fil.',cast(request_id as varchar),'.2'), 'renamed_L2.dat'
    from src join req using(request_id) where kind in (2,3) and source_uri like '%/L2.dat'
  union all select request_id, 3, cast(null as varchar), data_id, 'renamed.dat'
    from req join inv on l_orderkey=request_id and l_linenumber=1 where kind in (0,1)
  union all select request_id, (100+l_linenumber)::int,
    case when kind in (2,3) and l_linenumber%2=1 then concat('icav2://',inv.project_id,inv.path) end,
    case when kind in (0,1) or l_linenumber%2=0 then data_id end, concat('renamed_L',l_linenumber,'.dat')
    from req join inv on l_orderkey=request_id where kind in (0,1,2,3) and (l_linenumber>2 or kind<2 and l_linenumber=2)
  union all select request_id, 4, uri, cast(null as varchar), 'renamed.txt' from extl
  union all select request_id, 5, cast(null as varchar), concat('fil.',cast(request_id+1 as varchar),'.1'), 'x.dat'
    from req where o_custkey%7=0
  union all select request_id, 6, cast(null as varchar), cast(null as varchar), 'y.dat' from req where o_custkey%31=0
  union all select request_id, 7, cast(null as varchar), concat('fil.',cast(request_id as varchar),'.1'), 'a//b.dat'
    from req where o_custkey%37=0
  union all select request_id, 8, 'gs://b/x', concat('fil.',cast(request_id as varchar),'.3'), 'both_id.dat'
    from req where o_custkey%43=0
  union all select request_id, 9, concat('icav2://',project_id,src_folder), '', 'both_uri.dat'
    from req where o_custkey%47=0
  union all select request_id, 10, cast(null as varchar), concat('fil.',cast(request_id as varchar),'.2'), 'L1.dat'
    from req where kind in (2,3) and o_custkey%3=0
  union all select request_id, 11, cast(null as varchar), concat('fil.',cast(request_id as varchar),'.3'), 'L3.dat'
    from req where kind in (2,3) and o_custkey%4=0
  union all select request_id, 12, cast(null as varchar), concat('fil.',cast(request_id as varchar),'.1'), 'A'
    from req where kind in (0,1) and o_custkey%5=1),
executions as (select concat('exec-',cast(request_id as varchar)) as execution_id,
  case when request_id%20=0 then 'RUNNING' else 'SUCCEEDED' end as status,
  json_object('taskToken', task_token)::varchar as input from req),
storage_config as (select project_id, concat('bkt-',project_id) as bucket, 'byob/' as prefix
  from (select project_id from req union select dest_project_id from req)),
resolved as (select s.request_id, s.pos, s.source_uri,
    case i.data_type when 'FILE' then 'FILE' when 'FOLDER' then 'FOLDER' else 'EXTERNAL' end as kind,
    i.project_id, i.data_id, i.path, i.name, i.size, i.etag
  from src s left join inventory i
    on regexp_extract(s.source_uri,'^([^:/?#]+)://',1)='icav2'
   and i.project_id=regexp_extract(s.source_uri,'^[^:/?#]+://([^/]*)',1)
   and i.path=regexp_extract(s.source_uri,'^[^:/?#]+://[^/]*(/.*)?$',1)),
dest as (select request_id, destination_uri as dest_uri,
    regexp_extract(destination_uri,'^([^:/?#]+)://',1) as dest_scheme,
    regexp_extract(destination_uri,'^[^:/?#]+://([^/]*)',1) as dest_project,
    regexp_replace(concat(regexp_extract(destination_uri,'^[^:/?#]+://[^/]*(/.*)?$',1),'/'),'/+$','/') as dest_folder
  from req),
targets as (select r.request_id, r.data_id, r.name, r.size, r.etag, d.dest_project as target_project,
    d.dest_folder as target_folder,
    regexp_replace(regexp_replace(concat(d.dest_folder,'/',r.name),'/(\./)+','/','g'),'/+','/','g') as target_path
  from resolved r join dest d using (request_id) where r.kind='FILE'),
fsrc as (select request_id, project_id, path as folder, name as folder_name from resolved where kind='FOLDER'),
expanded as (select f.request_id, i.data_id, i.size, i.etag, f.folder as source_folder, d.dest_project,
    regexp_replace(regexp_replace(concat(d.dest_folder, f.folder_name, '/', substr(i.path, length(f.folder)+1)),
      '/(\./)+','/','g'),'/+','/','g') as dest_path
  from fsrc f join (select *, unnest(list_transform(range(1, len(string_split(path,'/'))),
      lambda k: array_to_string(list_slice(string_split(path,'/'),1,k),'/') || '/')) as above from inventory where data_type='FILE') i
    on i.project_id=f.project_id and i.above=f.folder
  join dest d on d.request_id=f.request_id),
ftree as (select distinct f.request_id, d.dest_uri, d.dest_scheme, d.dest_project,
    regexp_replace(regexp_replace(concat(d.dest_folder, f.folder_name, '/', substr(g.path, length(f.folder)+1)),
      '/(\./)+','/','g'),'/+','/','g') as dest_folder
  from fsrc f join (select *, unnest(list_transform(range(1, len(string_split(path,'/'))),
      lambda k: array_to_string(list_slice(string_split(path,'/'),1,k),'/') || '/')) as above from fold) g on g.project_id=f.project_id and g.above=f.folder
  join dest d on d.request_id=f.request_id),
extcat as (select uri, arg_min(size, s3_object_id) as size, arg_min(etag, s3_object_id) as etag
  from ext where current_state group by uri),
planned as (select request_id, data_id, size, etag, target_project, target_folder, target_path, true as found from targets
  union all select request_id, data_id, size, etag, dest_project, regexp_replace(dest_path,'[^/]+/?$',''), dest_path, true
    from expanded
  union all select r.request_id, r.source_uri, c.size, c.etag, d.dest_project, d.dest_folder,
    regexp_replace(regexp_replace(concat(d.dest_folder,'/',
      regexp_extract(regexp_extract(r.source_uri,'^[^:/?#]+://[^/]*(/.*)?$',1),'([^/]+)/*$',1)),
      '/(\./)+','/','g'),'/+','/','g'), c.uri is not null
    from resolved r join dest d using (request_id) left join extcat c on c.uri=r.source_uri
    where r.kind='EXTERNAL' and regexp_extract(r.source_uri,'^([^:/?#]+)://',1)='s3'),
actions as (select t.*, case when not t.found then 'MISSING_SOURCE'
      when x.status is null then 'COPY' when x.status='PARTIAL' then 'REPLACE_PARTIAL'
      when x.size is not distinct from t.size then 'SKIP' else 'CONFLICT' end as action
  from planned t left join dst x on x.project_id=t.target_project and x.path=t.target_path)
"""


def with_base(body: str) -> str:
    """``WITH <fixtures>, <body>`` where body starts with more CTEs or a SELECT."""
    body = body.strip()
    if body.lower().startswith("select"):
        return f"with {BASE_CTES} {body}"
    return f"with {BASE_CTES}, {body}"
