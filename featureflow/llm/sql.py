"""DuckDB SQL for the queries of prefix tries, licences and periodic runs."""

from __future__ import annotations

from featureflow.llm.licences import INDEXED, LOOKED_UP, LOWER, PHRASES, TEMPLATES, UPPER


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a short ASCII text, bit by bit."""
    letters = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::bigint)"
    bits = "list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[])"
    step = "xor(r >> 1, 3988292384 * (r & 1))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {letters}), lambda a, b: list_reduce({bits}, lambda r, z: {step})), 4294967295)"


#: Prefixes as SHA-256 of their turns' hashes; a node's values go to all nodes above it on its smallest member's path.
TRIE = f"""
with t as (
  select conv_id, size, x, row_number() over (partition by conv_id order by turn nulls first, x) as i from (
    select conv_id, turn, length(coalesce(text, '')) as size,
      sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as x
    from conversations where conv_id is not null)),
c as (
  select conv_id, conv_id - conv_id % 100 as base, {crc32("conv_id::varchar")} % 6 as h
  from (select distinct conv_id from conversations where conv_id is not null)),
n as (select conv_id, count(*) as n from t group by conv_id),
b as (
  select c.conv_id, t.i as d, t.x, t.size from c join t on t.conv_id = c.base and t.i <= c.h
  union all
  select t.conv_id, t.i - c.h + least(c.h, coalesce(n.n, 0)), t.x, t.size
  from t join c using (conv_id) left join n on n.conv_id = c.base where t.i > c.h),
k as (select conv_id, d, size, sha256(string_agg(x, '') over (partition by conv_id order by d)) as k from b),
p as (
  select conv_id, d, size, k, coalesce(lag(k) over (partition by conv_id order by d), '') as up from k
  union all select conv_id, 0, 0, '', null from c),
v as (select k, min(conv_id) as conv_id, any_value(d) as depth, any_value(up) as up, count(*) as n_convs, any_value(size) as size from p group by k),
kids as (select up as k, count(*) as n_children from v where depth > 0 group by up),
w as (select v.*, coalesce(n_children, 0) as n_children from v left join kids using (k)),
s as (
  select p.k, sum((n_convs - 1) * w.size) as saved, sum((n_children = 0)::int) as leaves
  from w join p on p.conv_id = w.conv_id and p.d <= w.depth group by p.k),
e as (
  select k, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, arg_max(k, d) as k from p group by conv_id) group by k)
select w.conv_id, w.depth::bigint as depth, u.conv_id as parent_conv_id, w.n_convs::bigint as n_convs, w.n_children::bigint as n_children,
  s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from w join s using (k) left join e using (k) left join w u on u.k = w.up
"""


def licences_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text + "'"

    def rows(values: list[tuple]) -> str:
        return ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in value) + ")" for value in values)

    words = [(t, k, w) for t, own in enumerate(TEMPLATES) for k, w in enumerate(own.words)]
    keys = [(t, m, place + k, w) for t, own in enumerate(TEMPLATES) for m, (place, key) in enumerate(own.places()) for k, w in enumerate(key)]
    phrases = [(label, len(phrase.split()), k, w) for label, phrase in PHRASES for k, w in enumerate(phrase.split())]
    return rf"""
with d as (
  select row_number() over () as id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
w as (select id, unnest(words) as word, unnest(range(len(words))) as i from d),
tw(t, k, word) as (values {rows(words)}),
mw(t, m, k, word) as (values {rows(keys)}),
pw(label, size, k, word) as (values {rows(phrases)}),
tl(t, label, size) as (values {rows([(t, own.label, len(own.words)) for t, own in enumerate(TEMPLATES)])}),
base as (
  select id, label, i - k as start from w join pw using (word) group by id, label, i - k having count(*) = any_value(size)),
n as (select word, count(distinct id) as n from w where word in (select word from tw) group by word),
rare as (
  select t, word from (select distinct t, word, n from tw join n using (word) where t not in (select t from mw anti join n using (word))) qualify row_number() over (partition by t order by n, word) <= {INDEXED}),
idx as (select t, k, word from tw join rare using (t, word) where t in (select t from rare group by t having count(*) > 1)),
own as (
  select id, word from (select distinct id, word, n from w join n using (word) where word in (select word from rare))
  qualify row_number() over (partition by id order by n, word) <= {LOOKED_UP}),
begins as (
  select id, t, i - k as o from w join own using (id, word) join idx using (word) group by id, t, i - k having count(*) > 1),
stands as (
  select id, t, m from begins join mw using (t) join w using (id, word) where w.i = o + k
  group by id, t, m, o having count(*) = (select count(*) from mw x where x.t = begins.t and x.m = mw.m)),
verified as (
  select id, t from (select distinct id, t, m from stands) group by id, t
  having count(*) = (select count(distinct m) from mw x where x.t = stands.t)),
shares as (
  select id, t, o, count(w.word) as n from verified join begins using (id, t) join tw using (t)
  left join w on w.id = verified.id and w.i = o + k and w.word = tw.word group by id, t, o),
found as (select id, label, max(n / tl.size) as share from shares join tl using (t) group by id, label),
b as (
  select id, count(*) as n_base, min(start) as first_word, max(start) as last_word, list_distinct(list(label)) as own from base group by id),
f as (select id, max(share) as share, list_distinct(list(label)) as own from found group by id)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  array_to_string(list_sort(coalesce(b.own, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.own, []), coalesce(f.own, [])))), ',') as labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0)::double end as score
from d left join b using (id) left join f using (id)
""".replace("from stands) group by id, t\n  having count(*) = (select count(distinct m) from mw x where x.t = stands.t)", "from stands) z group by id, t\n  having count(*) = (select count(distinct m) from mw x where x.t = z.t)")


#: Pairs of equal five-word sequences at each distance, as stretches; of those that agree the least distance is the period.
PERIODIC = rf"""
with d as (
  select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, {crc32("doc_id::varchar")} as h from documents),
e as (select *, len(w) as n, h // 10 as g from d),
f as (select *, case when h % 10 = 0 and n > 0 then g % n end as a from e),
p as (select *, 1 + (n - a) // (3 + g % 8) as p from f),
x as (
  select id, doc_id, n, case when a is null then w
    else list_transform(range(n), lambda i: w[1 + (case when i < a then i else a + (i - a) % p end)]) end as w from p),
s as (select id, n, i, array_to_string(w[i + 1:i + 5], ' ') as five from x, lateral (select unnest(range(n - 4)) as i)),
q as (select a.id, a.i, b.i - a.i as gap from s a join s b on a.id = b.id and a.five = b.five and b.i > a.i and b.i - a.i <= a.n // 4),
r as (select id, gap, i, i - row_number() over (partition by id, gap order by i) as stretch from q),
c as (select id, gap, min(i) as start, count(*) + 4 + gap as length from r group by id, gap, stretch),
runs as (select id, start, length, min(gap) as period from c where length >= greatest(6, 4 * gap) group by id, start, length),
o as (
  select id, count(*) as n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256,
    first(row(start, length, period) order by length desc, start, period) as best from runs group by id),
gone as (select distinct id, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select id, string_agg(word, ' ' order by i) as text
  from (select id, unnest(w) as word, unnest(range(n)) as i from x where id in (select id from runs)) anti join gone using (id, i) group by id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, best[1]::bigint as start, best[2]::bigint as length, best[3]::bigint as period,
  (1000 * best[2] // best[3])::bigint as exponent_milli, coalesce(runs_sha256, sha256('')) as runs_sha256,
  sha256(coalesce(kept.text, array_to_string(w, ' '))) as collapsed_sha256
from x left join o using (id) left join kept using (id)
"""
