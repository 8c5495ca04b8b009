"""DuckDB counterparts of the queries that SQL can express."""
from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = r"""
with t as (select row_number() over () rid, doc_id, coalesce(text, '') x from documents),
w as (select rid, regexp_extract_all(x, '[^\x20\x09-\x0D]+') ws from t),
g as (select rid, i, array_to_string(list_slice(ws, i, i + 7), chr(31)) k
      from (select rid, ws, unnest(range(1, greatest(len(ws) - 6, 1))) i from w)),
d as (select rid, i from (select rid, i, count(*) over (partition by rid, k) n from g) where n > 1),
rep as (select rid, sum(least(8, i - p)) n from (select rid, i, coalesce(lag(i) over (partition by rid order by i), -8) p from d) group by rid),
l as (select rid, unnest(string_split(x, chr(10))) ln, unnest(range(len(string_split(x, chr(10))))) k from t),
j as (select rid, ln, k, regexp_extract_all(ln, '[^\x20\x09-\x0D]+') ws from l),
f as (select *, len(ws) = 0 or not (
        not regexp_matches(ln, '[.!?…。！？]["''”’»)\]]*(?:[\x20\x09-\x0D]|\z)')
        or len(list_filter(ws, lambda v: v in ('|', '>', '»', '›', '•', '·', '/'))) > 0.15 * len(ws)
        or length(ln) - length(regexp_replace(ln, '[#*$%&|<>]', '', 'g')) > 0.20 * len(ws)
        or len(regexp_extract_all(ln, '[!?]{2,}')) > 0.20 * len(ws)
        or regexp_matches(ln, '(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|enable javascript|lorem ipsum|click here|subscribe to our|skip to (main )?content|sign (in|up) to)')
        or (len(ws) >= 20 and len(list_distinct(ws)) < 0.15 * len(ws))) ok from j),
s as (select rid, sum(case when ok then length(regexp_replace(ln, '[\x20\x09-\x0D]', '', 'g')) else 0 end) good,
             sum(case when ok then 0 else 1 end) bad,
             count(*) filter (len(ws) > 0) - count(distinct ln) filter (len(ws) > 0) dup from f group by rid),
a as (select t.doc_id, len(w.ws) nw, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) wc,
             length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) sy, s.dup, coalesce(rep.n, 0) rw, s.good, s.bad
      from t join w using (rid) join s using (rid) left join rep using (rid))
select doc_id, nw::bigint n_words, wc::bigint word_chars, sy::bigint n_symbols, dup::bigint n_dup_lines, rw::bigint n_repeat_words,
       (nw < 20 or 100 * rw > 30 * nw) base_failed,
       not (nw < 20 or 100 * rw > 30 * nw) and wc > 0 and good / wc >= 0.5 kept, bad::bigint n_lines_removed
from a"""


def _kind(name: str, place: int, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""select rid, {place} place, '{name}' kind, at_ + gap start, at_ + gap + n stop from (
        select *, coalesce(sum(gap + n) over (partition by rid order by k rows between unbounded preceding and 1 preceding), 0) at_ from (
            select rid, k, length(gaps[k]) gap, length(ms[k]) n, length(gs[k]) g from (
                select rid, unnest(range(1, len(ms) + 1)) k, ms, gs, gaps from (
                    select rid, regexp_extract_all(x, '{pattern}', 0) ms, regexp_extract_all(x, '{pattern}', {group}) gs,
                           regexp_split_to_array(x, '{pattern}') gaps from t)))) where g >= {least}"""


def _secrets() -> str:
    from .secrets import RULES

    kinds = "\nunion all\n".join(_kind(r.kind, i, r.pattern, r.group, r.least) for i, r in enumerate(RULES))
    text = "kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint)"
    return f"""with t as (select row_number() over () rid, doc_id, coalesce(text, '') x from documents),
found as ({kinds}),
per as (select rid, count(*) filter (kind = 'assign') a, count(*) filter (kind = 'access') b, count(*) filter (kind = 'hex') c,
               string_agg({text}, ',' order by start, place) filter (place < 3) base,
               string_agg({text}, ',' order by start, place) spans from found group by rid)
select doc_id, coalesce(a, 0)::bigint n_assign, coalesce(b, 0)::bigint n_access, coalesce(c, 0)::bigint n_hex,
       sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from t left join per using (rid)"""


def _mixture(cte: str = "documents", epochs: int = 3, seed: str = "mix") -> str:
    """Caps are passed in the order of size over weight, so one running sum tells who is capped."""
    return rf"""t as (select *, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint size,
             md5('{seed}:' || coalesce(doc_id::varchar, 'null')) key from {cte}),
src as (select source, sum(size)::bigint source_size,
               (array[1.0::double, 2.0, 3.0])[((row_number() over (order by source is null, source) - 1) % 3 + 1)::int] w from t group by source),
tot as (select sum(source_size)::double total, sum(w) weight from src),
run as (select *, {epochs}.0::double * source_size cap,
               coalesce(sum({epochs}.0::double * source_size) over q, 0) cap_before, coalesce(sum(w) over q, 0) w_before,
               row_number() over (order by source_size / w, w, source) place
        from src window q as (order by source_size / w, w, source rows between unbounded preceding and 1 preceding)),
lvl as (select arg_min((total - cap_before) / (weight - w_before), place) filter (w * ((total - cap_before) / (weight - w_before)) <= cap) lev
        from run, tot),
fill as (select source, source_size, least(cap, w * lev) target,
                case when source_size > 0 then least({epochs}.0::double, least(cap, w * lev) / source_size) else 0 end rate from run, lvl),
part as (select source, substr(key, 1, 3) p, sum(size) n from t group by all),
bef as (select source, p, coalesce(sum(n) over (partition by source order by p rows between unbounded preceding and 1 preceding), 0) b from part),
d as (select t.*, coalesce(sum(size) over (partition by source, substr(key, 1, 3) order by key, size rows between unbounded preceding and 1 preceding), 0) ins from t),
mixed as (select d.*, fill.source_size, fill.target, (floor(rate) + case when b + ins + size / 2.0::double < (rate - floor(rate)) * source_size then 1 else 0 end)::bigint repeats
          from d join fill on d.source is not distinct from fill.source
          join bef on bef.source is not distinct from d.source and bef.p = substr(key, 1, 3))"""


OP4 = f"with {_mixture()}\nselect doc_id, size, source_size, target, size * repeats taken from mixed"

OP11 = r"""
with r as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') x from conversations
           union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s as (select *, sha256(length(role) || ':' || role || x) sig from r),
e as (select *, replace(replace(replace(role, '\', '\\'), '<turn>', '\lturn>'), '</turn>', '\l/turn>') er,
             replace(replace(replace(x, '\', '\\'), '<turn>', '\lturn>'), '</turn>', '\l/turn>') ex from s)
select conv_id, count(*)::bigint n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' order by turn nulls first, sig)) turns_sha256,
       coalesce(sum(length(x)) filter (role = 'assistant'), 0)::bigint loss_chars,
       sha256(coalesce(string_agg(x, '' order by turn nulls first, sig) filter (role = 'assistant'), '')) loss_sha256,
       sum(length('<turn>') + length(replace(er, chr(10), '\n')) + 1 + length(ex) + length('</turn>') + 1)::bigint formatted_chars
from e group by conv_id"""

OP12 = r"""
with recursive bits as (select n, n::ubigint v, 0 i from range(256) t(n)
    union all select n, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end, i + 1 from bits where i < 8),
tab as (select list(v order by n) t from bits where i = 8),
turns as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || x)) p,
                 sha256(length(role) || ':' || role || x) s, strlen(x) b
          from (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') x from conversations where conv_id is not null)),
convs as (select conv_id, n, conv_id - conv_id % 5 base,
                 xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(conv_id::varchar, ''), lambda z: ord(z)::ubigint)),
                                 lambda a, z: xor(a >> 8, t[(xor(a, z) & 255)::int + 1])), 4294967295::ubigint) % 9 h
          from (select conv_id, count(*) n from turns group by 1), tab),
c2 as (select c.*, least(c.h, coalesce(b.n, 0)) taken from convs c left join convs b on b.conv_id = c.base),
own as (select c.conv_id, p - c.h::bigint + taken::bigint pos, s, b from turns t join c2 c using (conv_id) where p > c.h and c.base <> c.conv_id
        union all select c.conv_id, p, s, b from turns t join c2 c using (conv_id) where c.base = c.conv_id
        union all select c.conv_id, p, s, b from turns t join c2 c on t.conv_id = c.base and c.base <> c.conv_id where p <= c.h),
seq as (select c.conv_id, coalesce(list(s order by pos) filter (s is not null), []) l, coalesce(list(b order by pos) filter (s is not null), []) bl
        from c2 c left join own using (conv_id) group by 1),
pre as (select conv_id, unnest(range(0, len(l) + 1)) depth, l, bl from seq),
keyed as (select conv_id, depth, array_to_string(l[1:depth], '/') k, array_to_string(l[1:depth - 1], '/') up,
                 case when depth > 0 then bl[depth] else 0 end b, depth = len(l) ends from pre),
nodes as (select k, depth, any_value(up) up, min(conv_id) conv_id, count(*) n, any_value(b) b,
                 sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) e from keyed group by k, depth),
kids as (select up k, depth - 1 depth, count(*) c from nodes where depth > 0 group by 1, 2),
full_ as (select n.*, coalesce(c, 0) c, (n.n - 1) * n.b saved from nodes n left join kids using (k, depth)),
under as (select distinct a.depth adepth, array_to_string(a.l[1:a.depth], '/') ak, d.depth ddepth, array_to_string(d.l[1:d.depth], '/') dk
          from pre a join pre d on a.conv_id = d.conv_id and a.depth <= d.depth),
sums as (select adepth depth, ak k, sum((f.c = 0)::int) leaves, sum(f.saved) saved from under u join full_ f on f.k = u.dk and f.depth = u.ddepth group by 1, 2)
select f.conv_id, f.depth::bigint depth, p.conv_id parent_conv_id, f.n::bigint n_convs, f.c::bigint n_children, s.leaves::bigint n_leaves,
       s.saved::bigint saved_tokens, f.e ends_sha256
from full_ f join sums s using (k, depth) left join full_ p on p.k = f.up and p.depth = f.depth - 1 and f.depth > 0"""

OP13 = r"""
with t as (select doc_id, coalesce(source, '') part, coalesce(text, '') x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
m as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) bad
      from labels where doc_id is not null group by doc_id),
f as (select part, coalesce(good, 0) good, coalesce(bad, 0) bad,
             {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w), 'C': 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x),
              'D': regexp_matches(x, '[#$%&*|]'), 'E': coalesce(t.doc_id > min(t.doc_id) over (partition by x), false)} v from t left join m on m.doc_id = t.doc_id),
c as (select part, v.A a, v.B b, v.C c, v.D d, v.E e, count(*) n, sum(good) good, sum(bad) bad from f group by all),
fl as (select unnest(['A', 'B', 'C', 'D', 'E']) l),
o as (select a.l || b.l || c.l || d.l || e.l o from fl a, fl b, fl c, fl d, fl e
      where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s as (select o, unnest(range(1, 6)) step from o),
x as (select s.o, s.step, c.part, c.n, c.good, c.bad, o[step] mine,
             list_transform(string_split(o, ''), lambda l: case l when 'A' then a when 'B' then b when 'C' then c.c when 'D' then d else e end) fails
      from s, c),
y as (select *, list_sum(list_transform(fails, lambda z: z::int)) total, list_sum(list_transform(fails[1:step], lambda z: z::int)) upto,
             coalesce(list_sum(list_transform(fails[1:step - 1], lambda z: z::int)), 0) before, fails[step] here from x),
r as (select part, o, step, any_value(mine) mine, coalesce(sum(n) filter (upto = 0), 0) kept, coalesce(sum(n) filter (here and before = 0), 0) removed,
             coalesce(sum(n) filter (here and before > 0), 0) redundant, coalesce(sum(n) filter (here and total = 1), 0) unique_fails,
             coalesce(sum(good) filter (here and before = 0), 0) good_lost, coalesce(sum(bad) filter (here and before = 0), 0) toxic_lost
      from y group by part, o, step)
select part, o filter_order, step::int step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant, unique_fails::bigint unique_fails,
       good_lost::bigint good_lost, toxic_lost::bigint toxic_lost, (sum(removed) over (partition by part, mine))::bigint shapley from r"""

SQL = {"op1_quality_rules": OP1, "op3_secret_scan": _secrets(), "op4_source_mixture": OP4, "op11_chat_format": OP11,
       "op12_prefix_trie": OP12, "op13_filter_audit": OP13}
