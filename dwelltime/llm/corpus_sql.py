"""SQL for the operators that SQL can express, for an engine that shares no code with them."""

from __future__ import annotations

#: CRC-32 without a function for it: a table of 256 remainders by shifting, then one step a byte.
CRC = """
crc_steps as (
  select list(r order by i) as remainders from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
             case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as r
    from range(256) as bytes(i)))
"""


def crc_of(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, with `remainders` at hand."""
    spelled = f"hex(encode({text}))"
    numbers = (f"list_transform(range(1, strlen({text}) + 1), lambda i: "
               f"cast('0x' || substr({spelled}, 2 * i - 1, 2) as bigint))")
    return (f"xor(list_reduce(list_prepend(4294967295, {numbers}), lambda c, b: "
            f"xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)")


OP13 = f"""
with {CRC},
words as (
  select kind, row_id, doc_id, unnest(list) as word from (
    select 'd' as kind, row_number() over () as row_id, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as list from documents
    union all select 't', 0, 0, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') from benchmark)),
places as (
  select word, {crc_of("word")} % 10000 as bucket
  from (select distinct word from words), crc_steps),
used as (select w.*, bucket from words w join places using (word)),
totals as (select count(*) filter (where kind = 'd')::double as n_source,
                  count(*) filter (where kind = 't')::double as n_target from used),
counted as (select bucket, count(*) filter (where kind = 'd')::double as s,
                   count(*) filter (where kind = 't')::double as t from used group by bucket),
gain as (select bucket, floor(1000 * ln((t + 1) * (n_source + 10000) / ((s + 1) * (n_target + 10000)))) as g
         from counted, totals),
weighed as (
  select row_id, count(*) as n_features, floor(sum(g) / count(*))::bigint as weight
  from used join gain using (bucket) where kind = 'd' group by row_id),
scored as (
  select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')),
           1, 8) as bigint) + 0.5) / 4294967296)))::bigint as score
  from (select row_number() over () as row_id, doc_id from documents) left join weighed using (row_id)),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id nulls last, n_features, weight) as place,
         count(*) over () as n, n_features, weight, score from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end::bigint as rank from ranked
union all select doc_id, n_features, weight, score, null from scored where n_features < 20
"""

OP11 = f"""
with {CRC},
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
  from conversations where conv_id is not null),
lengths as (select conv_id, count(*) as n from turns group by conv_id),
convs as (
  select c.conv_id, c.conv_id - c.conv_id % 20 as family, h, least(h, coalesce(f.n, 0)) as m
  from (select conv_id, {crc_of("conv_id::varchar")} % 4 as h from lengths, crc_steps) c
  left join lengths f on f.conv_id = c.conv_id - c.conv_id % 20),
rebuilt as (
  select c.conv_id, place + 1 as depth, role, text from convs c join turns t on t.conv_id = family and place < h
  union all
  select c.conv_id, place - h + m + 1, role, text from convs c join turns t on t.conv_id = c.conv_id and place >= h),
spelled as (
  select conv_id, depth, md5(string_agg(md5(length(role)::varchar || ':' || role || text), '') over (
           partition by conv_id order by depth)) as name,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words from rebuilt),
named as (
  select conv_id, 0 as depth, 'root' as name, 0 as words, null as parent from convs
  union all select conv_id, depth, name, words, coalesce(lag(name) over (
    partition by conv_id order by depth), 'root') from spelled),
nodes as (select depth, name, any_value(parent) as parent, any_value(words) as words, min(conv_id) as conv_id,
                 count(*) as n_convs from named group by depth, name),
children as (select parent as name, count(*) as n from nodes where parent is not null group by parent),
counted as (select v.*, coalesce(n, 0) as n_children from nodes v left join children c using (name)),
below as (select distinct a.name, b.name as inside from named a join named b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (select b.name, count(*) filter (where n_children = 0) as n_leaves,
                sum((n_convs - 1) * words) as saved_tokens from below b join counted v on v.name = b.inside group by b.name),
lasts as (select conv_id, arg_max(name, depth) as name from named group by conv_id),
ends as (select name, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as hash from lasts group by name)
select v.conv_id, v.depth::bigint as depth, u.conv_id as parent_conv_id, v.n_convs, v.n_children, n_leaves,
       saved_tokens::bigint as saved_tokens, coalesce(hash, sha256('')) as ends_sha256
from counted v join sums using (name) left join ends using (name) left join nodes u on u.name = v.parent
"""
