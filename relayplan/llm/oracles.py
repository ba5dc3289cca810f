"""DuckDB twins of the queries that SQL can express, by plain definition:
all windows, all shingles, all blocks; none of the operators' methods."""

from __future__ import annotations

from relayplan.llm import hilbert_shard, license_scan, sanitise

ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
SPACE = r"'[^\x20\x09-\x0D]+'"
ASCII_LOWER = "translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"


def _list(values) -> str:
    return "[" + ",".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _templates() -> str:
    rows = [f"('{t.label}', {_list(t.words)}, {_list(sorted(set(t.words)))}, {t.threshold}, {str(t.phrase).lower()})"
            for t in license_scan.templates()]
    return "t(label, words, uniq, threshold, phrase) as (values " + ",".join(rows) + ")"


_SPAN = max(len(t.words) for t in license_scan.templates())
_S = license_scan.STRIDE

OP1 = f"""
with {_templates()},
d as (select doc_id, regexp_extract_all(lower(coalesce(text,'')), {ALNUM}) as w from documents),
b as (select doc_id, unnest(range(0, len(w), {_S})) as pos, w from d),
blocks as (select doc_id, pos, list_slice(w, pos+1, pos+{_S + _SPAN - 1}) as w from b),
met as (select doc_id, pos, w, label, words, phrase, len(list_intersect(list_distinct(w), uniq)) / len(uniq) as share
  from blocks, t where len(list_intersect(list_distinct(w), uniq)) >= threshold * len(uniq) - 1e-9),
hit as (select *, case when phrase then list_transform(list_filter(range(0, {_S}),
    lambda i: list_slice(w, i+1, i+len(words)) = words), lambda i: i + pos) end as places from met),
ok as (select * from hit where not phrase or len(places) > 0),
g as (select doc_id, sum(len(places)) as n_base, min(list_min(places)) as first_word, max(list_max(places)) as last_word,
  string_agg(distinct case when phrase then label end, ',' order by case when phrase then label end) as base_labels,
  string_agg(distinct label, ',' order by label) as labels, max(share) as score from ok group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join g using (doc_id)
"""

# windows are compared by a 64-bit hash
OP2 = """
with d as (select doc_id, hex(encode(coalesce(text,''))) as h from documents),
w as (select doc_id, p, hash(substr(h, 2*p+1, 100)) as s
  from (select doc_id, h, unnest(range(0, (len(h)/2 - 49)::bigint)) as p from d)),
f as (select s, min(doc_id) as first from w group by s),
hit as (select doc_id, p from w join f using (s) where f.first < w.doc_id),
e as (select doc_id, p, case when p > lag(p) over (partition by doc_id order by p) + 50
    or lag(p) over (partition by doc_id order by p) is null then 1 else 0 end as new from hit),
r as (select doc_id, p, sum(new) over (partition by doc_id order by p) as g from e),
span as (select doc_id, min(p) as a, max(p) + 50 as b from r group by doc_id, g),
cut as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from span
  union all select doc_id, max(b), null from span group by doc_id),
keep as (select doc_id, string_agg(substr(h, 2*a+1, case when b is null then len(h) else 2*(b-a) end), '' order by a) as h
  from cut join d using (doc_id) group by doc_id),
n as (select doc_id, sum(b-a) as n_removed, count(*) as n_spans from span group by doc_id)
select d.doc_id, (len(d.h)/2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(keep.h, d.h))) as kept_sha256
from d left join n using (doc_id) left join keep using (doc_id)
"""

OP6 = f"""
with recursive d as (select doc_id, regexp_extract_all({ASCII_LOWER}, {SPACE}) as w from documents),
s as (select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w)-3),
    lambda i: array_to_string(list_slice(w, i, i+4), ' ')) when len(w) > 0 then [array_to_string(w, ' ')] end) as x from d),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id <> b.doc_id group by all),
link as (select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * c >= 80 * (na.n + nb.n - c)),
reach as (select doc_id, doc_id as r from d union select reach.doc_id, link.b from reach join link on link.a = reach.r)
select reach.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r) as component_id
from reach left join n using (doc_id) group by reach.doc_id
"""

OP7 = f"""
with b as (select item_id, regexp_extract_all(lower(coalesce(text,'')), {ALNUM}) as w from benchmark),
bs as (select distinct item_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w)-3),
    lambda i: array_to_string(list_slice(w, i, i+4), ' ')) when len(w) > 0 then [array_to_string(w, ' ')] end) as x from b),
n as (select item_id, count(*) as n_item, any_value(len(string_split(x, ' '))) as k from bs group by item_id),
d as (select doc_id, regexp_extract_all(lower(coalesce(text,'')), {ALNUM}) as w from documents),
ds as (select distinct doc_id, unnest(list_transform(range(1, len(w)-k+2),
    lambda i: array_to_string(list_slice(w, i, i+k-1), ' '))) as x from d, (select distinct k from n)),
f as (select doc_id, item_id, count(*) as n_found from ds join bs using (x) group by all)
select doc_id, item_id, n_item, n_found, n_found / n_item as containment
from f join n using (item_id) where 10 * n_found >= 8 * n_item
"""

OP10 = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text,''), {SPACE}) as w from documents),
win as (select doc_id, p, array_to_string(list_slice(w, p+1, p+20), ' ') as s
  from (select doc_id, w, unnest(range(0, len(w)-19)) as p from d)),
hit as (select doc_id, p from (select doc_id, p, row_number() over (partition by s order by doc_id, p) as rn from win) where rn > 1),
word as (select distinct doc_id, unnest(range(p, p+20)) as i from hit),
gone as (select doc_id, list(i) as g from word group by doc_id),
k as (select doc_id, w, coalesce(len(g), 0) as n_removed,
  case when g is null then w else (select list(w[x+1] order by x) from (select unnest(range(0, len(w))) as x) where not list_contains(g, x)) end as kept
  from d left join gone using (doc_id))
select doc_id, len(w)::bigint as n_words, n_removed::bigint as n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from k
"""


def _matches(kind: int, pattern: str, condition: str) -> str:
    """Rows (doc, start, stop, value) of one kind, by adding up the lengths of
    the matches and of the text between them."""
    return f"""
k{kind} as (select doc_id, text, regexp_extract_all(text, '{pattern}') as m,
    list_transform(regexp_split_to_array(text, '{pattern}'), lambda x: length(x)) as gap from t0),
l{kind} as (select doc_id, text, m[i] as value, i, list_sum(list_slice(gap, 1, i))
    + coalesce(list_sum(list_transform(list_slice(m, 1, i-1), lambda x: length(x))), 0) as a
  from (select *, unnest(range(1, len(m)+1)) as i from k{kind})),
e{kind} as (select doc_id, a::bigint as a, {kind} as kind, (a + length(value))::bigint as b, value from l{kind} where {condition})"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(1, length({_DIGITS})+1), lambda j: "
         f"case when j % 2 = 1 then substr({_DIGITS}, length({_DIGITS})-j+1, 1)::int "
         f"else [0,2,4,6,8,1,3,5,7,9][substr({_DIGITS}, length({_DIGITS})-j+1, 1)::int+1] end)) % 10 = 0")
_NAMES = "['email','ip','card','phone','term']"

OP8 = f"""
with t0 as (select doc_id, coalesce(text,'') as text from documents),
{_matches(0, "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "true")},
{_matches(1, "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+",
          "list_max(list_transform(string_split(value, '.'), lambda x: x::hugeint)) <= 255")},
{_matches(2, "[0-9](?:[ -]?[0-9])+", f"length({_DIGITS}) between 14 and 19 and {_LUHN}")},
{_matches(3, "[+][0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) between 10 and 15")},
e as (select * from e0 union all select * from e1 union all select * from e2 union all select * from e3),
c as (select e.doc_id, e.value, greatest(a - {sanitise.REACH}, 0) as at0, b as at1, t0.text as full_text,
    lower(substr(t0.text, greatest(a - {sanitise.REACH}, 0) + 1, least(a, {sanitise.REACH})::bigint)) as before,
    lower(substr(t0.text, b + 1, {sanitise.REACH})) as after
  from e join t0 using (doc_id)),
x as (select doc_id, value, full_text, at0 as base, before as s, true as is_before from c
  union all select doc_id, value, full_text, at1, after, false from c),
y as (select *, regexp_extract_all(s, {ALNUM}) as m,
    list_transform(regexp_split_to_array(s, {ALNUM}), lambda v: length(v)) as gap from x),
z as (select doc_id, value, full_text, base, s, is_before, m[i] as term, list_sum(list_slice(gap, 1, i))
    + coalesce(list_sum(list_transform(list_slice(m, 1, i-1), lambda v: length(v))), 0) as p
  from (select *, unnest(range(1, len(m)+1)) as i from y)),
whole as (select * from z where case when is_before then p + length(term) < length(s)
    and not (length(s) >= {sanitise.REACH} and p = 0)
  else p > 0 and not (length(s) >= {sanitise.REACH} and p + length(term) = length(s)) end),
num as (select *, row_number() over (partition by doc_id, value, base, is_before
    order by case when is_before then -p else p end) as rn from whole),
near as (select doc_id, value, full_text, term, (base + p)::bigint as a, (base + p + length(term))::bigint as b
  from num where rn <= {sanitise.NEAR} and length(term) >= 2),
free as (select * from near n where not exists (select 1 from e where e.doc_id = n.doc_id and n.a < e.b and e.a < n.b)),
n_e as (select value, count(distinct doc_id) as n_e from e group by value),
n_et as (select value, term, count(distinct doc_id) as n_et, count(distinct full_text) as support from free group by all),
n_t as (select term, count(*) as n_t from (select distinct doc_id, unnest(regexp_extract_all(lower(text), {ALNUM})) as term from t0)
  where term in (select term from n_et where support >= {sanitise.SUPPORT}) group by term),
flagged as (select value, term from n_et join n_e using (value) join n_t using (term), (select count(*) as n from t0)
  where support >= {sanitise.SUPPORT} and n > n_e
    and log2(n::double * n_et / n_e / n_t) >= {sanitise.DISCLOSURE} * log2(n::double / n_e) - 1e-9),
spans as (select doc_id, a, kind, b from e
  union all select distinct doc_id, a, 4, b from free join flagged using (value, term)),
txt as (select doc_id, string_agg(concat({_NAMES}[kind+1], ':', a, ':', b), ',' order by a, kind, b) as spans,
    string_agg(case when kind < 4 then concat({_NAMES}[kind+1], ':', a, ':', b) end, ',' order by a, kind, b) as base
  from spans group by doc_id),
n as (select doc_id, count(*) filter (kind = 0) as n0, count(*) filter (kind = 1) as n1,
    count(*) filter (kind = 2) as n2, count(*) filter (kind = 3) as n3 from e group by doc_id)
select t0.doc_id, coalesce(n0, 0)::bigint as n_email, coalesce(n1, 0)::bigint as n_ip, coalesce(n2, 0)::bigint as n_card,
  coalesce(n3, 0)::bigint as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t0 left join n using (doc_id) left join txt using (doc_id)
"""


def _crc_table() -> list[int]:
    """CRC-32 of each byte value, by its polynomial."""
    out = []
    for b in range(256):
        for _ in range(8):
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        out.append(b)
    return out


def _crc32(text: str) -> str:
    """CRC-32 of a text's bytes; 0 for an empty one."""
    h = f"hex(encode({text}))"
    steps = (f"list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, (len({h})/2)::bigint), "
             f"lambda i: (concat('0x', substr({h}, 2*i+1, 2)))::bigint)), lambda c, b: "
             f"xor(tab[(xor(c, b) & 255) + 1], c >> 8))")
    return f"xor({steps}, 4294967295::bigint)"


def _cells(column: str) -> str:
    return (f"(select x, ((coalesce(sum(c) over (order by x nulls first rows between unbounded preceding and 1 preceding), 0)"
            f" * 16) // sum(c) over ())::int as q from (select {column} as x, count(*) as c from d group by 1))")


OP3 = f"""
with k as (select {_crc_table()}::bigint[] as tab, {hilbert_shard.curve_table(3, 4)}::int[] as curve),
d as (select doc_id, lang, source, strlen(coalesce(text,'')) + 1 as size, {_crc32("coalesce(text,'')")} as crc, curve
  from documents, k),
lang_cell as {_cells('lang')}, source_cell as {_cells('source')}, size_cell as {_cells('size')},
c as (select doc_id, size, crc, curve[l.q*256 + s.q*16 + z.q + 1] as curve
  from d join lang_cell l on l.x is not distinct from d.lang join source_cell s on s.x is not distinct from d.source
  join size_cell z on z.x = d.size),
r as (select *, row_number() over (order by curve, substr(md5(concat_ws(':', crc::varchar, doc_id::varchar)), 1, 2),
    crc, doc_id) - 1 as rank, count(*) over () as n from c),
p as (select *, (rank * 8) // n as shard from r)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'rows' as law, shard::int as shard,
  (rank - (shard * n + 7) // 8)::bigint as slot, null::int as grown_shard, curve::int as curve from p
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12 = f"""
with d as (select doc_id, string_split(coalesce(text,''), chr(10)) as l from documents),
x as (select doc_id, unnest(range(1, len(l) + 1)) as pos, l from d),
k as (select doc_id, pos, l[pos] as line,
  translate(trim(l[pos], {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from x),
s as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
g as (select k.*, coalesce(doc_id <> last, false) as gone from k left join s using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from g group by doc_id
"""

OP11 = f"""
with recursive k as (select {_crc_table()}::bigint[] as tab),
runs as (select doc_id, run, count(*) as c from (select doc_id,
  unnest(regexp_extract_all({ASCII_LOWER}, '[A-Za-zÀ-ÿ]+')) as run from documents) group by all),
h as (select run, c, {_crc32("concat(doc_id, ':', run)")} as h from runs, k),
v as (select word, sum(c)::bigint as n from (select c, case when h % 97 = 0
    then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run) + 2)::bigint) else run end as word from h)
  where length(word) >= 5 group by word having sum(c) >= 3),
i as (select word, unnest(range(1, length(word) + 1)) as i from v),
del as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as d from i),
near as (select a.word, b.word as other from del a join del b using (d, i) where a.word <> b.word
  union select del.word, v.word from del join v on del.d = v.word
  union select v.word, del.word from del join v on del.d = v.word),
best as (select near.word, other, o.n, count(*) over (partition by near.word) as n_near,
    row_number() over (partition by near.word order by o.n desc, other) as rank
  from near join v o on o.word = near.other),
f as (select v.word, v.n, case when best.n >= 2 * v.n then other end as form,
    case when best.n >= 2 * v.n then best.n end as form_n, coalesce(n_near, 0) as n_near
  from v left join best on best.word = v.word and rank = 1),
r as (select word, word as root, 0 as depth from f
  union all select r.word, f.form, depth + 1 from r join f on f.word = r.root where f.form is not null),
last as (select word, max_by(root, depth) as root from r group by word)
select f.word, form, root, n, n_near, form_n from f join last using (word)
"""
