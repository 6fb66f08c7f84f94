"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from retourlens.llm.licences import LEAST_SCORE, LOWER, PARAGRAPH_END, SENTENCE_END, TEMPLATES, TOKEN, UPPER, listed

OP1 = r"""
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, r.vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::bigint as score
  from rows q join rows r on q.vec_id % 50 = 0 and q.vec_id <> r.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

#: Water filling in closed form, then the hash cut that comes nearest to the rest of each budget.
OP5 = r"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 12))::bigint as h
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source asc nulls last) as turn
  from docs group by source),
weighed as (
  select *, [5.0::double, 2.0, 1.0][(turn - 1) % 3 + 1] as weight, 2.0::double * source_size as cap from sources),
ordered as (select *, cap / weight as full_at, 1.5::double * sum(source_size) over () as whole from weighed),
levels as (
  select *, (whole - coalesce(sum(cap) over (order by full_at, turn rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by full_at, turn rows between current row and unbounded following) as level
  from ordered),
goals as (
  select l.source, source_size,
    least(cap, weight * (select arg_min(level, (full_at, turn)) from levels where level <= full_at)) as target
  from levels l),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from goals),
steps as (
  select b.source, b.target - b.passes * b.source_size as rest, h, sum(sum(size)) over (partition by b.source order by h) as upto
  from docs d join budgets b on d.source is not distinct from b.source group by b.source, rest, h),
choices as (
  select source, rest, -1 as h, 0 as upto from steps group by source, rest
  union all select source, rest, h, upto from steps where rest > 0),
cuts as (select source, arg_min(h, (abs(upto - rest), h)) as cut from choices group by source)
select d.doc_id, d.size, b.source_size, b.target, ((b.passes + (d.h <= c.cut)::bigint) * d.size)::bigint as taken
from docs d join budgets b on d.source is not distinct from b.source
join cuts c on d.source is not distinct from c.source
"""

OP6 = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    count(*) over (partition by conv_id) as n,
    length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10)) as chars
  from turns),
summed as (select *, sum(chars) over (partition by conv_id order by i) as upto from numbered)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(upto) filter (role = 'assistant' or i = n))::bigint as formatted_chars
from summed group by conv_id
"""

OP7 = r"""
with texts as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
  coalesce(doc_id = min(doc_id) over g, doc_id is null and min(doc_id) over g is null) as kept, text_sha256
from texts window g as (partition by text_sha256)
"""


#: All pairs that share a shingle; classes by spreading the smallest id.
OP9 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from words),
tokens as (select doc_id, len(s) as n, unnest(s) as token from sets),
links as (
  select a.doc_id as x, b.doc_id as y from tokens a join tokens b on a.token = b.token and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached as (
  select doc_id as x, doc_id as y from sets
  union select r.x, l.y from reached r join links l on r.y = l.x)
select doc_id, len(s)::bigint as n_shingles, least_id as component_id
from sets join (select x, min(y) as least_id from reached group by x) on x = doc_id
"""


_LISTED = listed(TEMPLATES)
_VALUES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(_LISTED))
OP10 = rf"""
with templates(place, licence, notice) as (values {_VALUES}),
template_tokens as (
  select place, token, count(*) as n
  from (select place, unnest(regexp_extract_all(lower(notice), '{TOKEN}')) as token from templates) group by all),
idf as (select token, ln((1.0 + {len(_LISTED)}) / (1 + count(*))) + 1 as idf from template_tokens group by token),
vectors as (
  select place, token, n * idf / sqrt(sum(n * idf * n * idf) over (partition by place)) as w
  from template_tokens join idf using (token)),
files as (
  select doc_id, text, concat_ws('/', source, doc_id // 100) as top, doc_id % 10 = 0 as named,
    case when doc_id % 10 = 0 then concat_ws('/', source, doc_id // 100, 'LICENSE')
      else concat_ws('/', source, doc_id // 100, doc_id // 10 % 10, doc_id || '.txt') end as path
  from documents),
lines as (select doc_id, unnest(string_split(text, chr(10))) as passage from files),
passages as (
  from lines
  union all select doc_id, unnest(regexp_split_to_array(passage, '{SENTENCE_END}')) from lines where regexp_matches(passage, '{SENTENCE_END}')
  union all from (select doc_id, unnest(regexp_split_to_array(text, '{PARAGRAPH_END}')) as passage from files) where contains(passage, chr(10))
  union all select doc_id, text from files where named),
numbered as (select row_number() over () as p, doc_id, passage from passages),
tokens as (
  select p, doc_id, token, count(*) as n
  from (select p, doc_id, unnest(regexp_extract_all(translate(passage, '{UPPER}', '{LOWER}'), '{TOKEN}')) as token from numbered)
  group by all),
lengths as (
  select p, sqrt(sum(n * n * coalesce(idf, ln(1.0 + {len(_LISTED)}) + 1) * coalesce(idf, ln(1.0 + {len(_LISTED)}) + 1))) as length
  from tokens left join idf using (token) group by p),
scores as (
  select p, doc_id, place, round(sum(n * idf * w) / any_value(length), 6) as score
  from tokens join vectors using (token) join idf using (token) join lengths using (p) group by p, doc_id, place),
own as (
  select doc_id, arg_min(licence, (-score, place)) as own_licence, max(score) as own_score
  from scores join templates using (place) where score >= {LEAST_SCORE} group by doc_id),
marked as (
  select doc_id, path, top, named, own_licence, own_score,
    case when named then top else top || '/' || doc_id // 10 % 10 end as dir
  from files left join own using (doc_id)),
given as (
  select top as above, arg_min(own_licence, (-own_score, own_licence)) as given
  from marked where named and own_licence is not null group by top)
select doc_id, path, own_licence, own_score, coalesce(own_licence, given) as licence,
  case when own_licence is null then above end as inherited_from
from marked left join given on top = above
"""


OP11 = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
marked as (
  select doc_id, part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * (doc_id > min(doc_id) over (partition by t))::int as mask
  from words),
known as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
counts as (
  select part, mask, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
  from marked left join known using (doc_id) group by all),
letters(f) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (
  select filter_order, step, filter_order[step] as f, 1 << (ascii(filter_order[step]) - 65) as own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::int as before
  from orders, range(1, 6) as r(step)),
found as (
  select part, filter_order, step::int as step, f,
    coalesce(sum(n) filter (mask & (before | own) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (mask & before = 0 and mask & own <> 0), 0)::bigint as removed,
    coalesce(sum(n) filter (mask & before <> 0 and mask & own <> 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (mask = own), 0)::bigint as unique_fails,
    coalesce(sum(n) filter (mask & before = 0 and mask & own <> 0 and good), 0)::bigint as good_lost,
    coalesce(sum(n) filter (mask & before = 0 and mask & own <> 0 and toxic), 0)::bigint as toxic_lost
  from counts, steps group by part, filter_order, step, f)
select * exclude (f), sum(removed) over (partition by part, f)::bigint as shapley from found
"""

OP12 = (
    OP9.replace(">= 85 *", ">= 80 *")
    .replace("as component_id\n", "as component_id, doc_id = least_id as kept\n")
)


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of fitting one after another; every component is a row."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
d{n} as (
  select r, part, entry, sum((x - v) * (x - v))::bigint as d from xs join c{n} using (part, pos) group by r, part, entry),
a{n} as (select r, part, arg_min(entry, (d, entry)) as entry, min(d) as d from d{n} group by r, part)""")
        if n < rounds:
            steps.append(f"""
c{n + 1} as materialized (
  select part, entry, pos, coalesce(m.v, c.v) as v from c{n} c
  left join (select part, entry, pos, floor(sum(x)::double / count(*))::bigint as v from xs join a{n} using (r, part) group by all) m
  using (part, entry, pos))""")
    return rf"""
with kept as (
  select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as r,
    list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
flat as (select r, len(v) // {parts} as w, unnest(v) as x, unnest(range(len(v))) as i from kept),
xs as materialized (select r, i // w as part, i % w as pos, x from flat),
c0 as materialized (select part, r - 1 as entry, pos, x as v from xs where r <= {entries}),{",".join(steps)},
coded as (select r, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by r)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(v::varchar, ',' order by part, entry, pos)) from c{rounds}) as codebooks_sha256
from kept join coded using (r)
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_bsi_topk": OP1, "op5_mix_sources": OP5, "op6_chat_format": OP6, "op7_exact_dedup": OP7, "op9_jaccard_join": OP9,
        "op10_licence_scan": OP10, "op11_filter_audit": OP11, "op12_minhash_dedup": OP12, "op13_vector_codes": _op13(),
    }
