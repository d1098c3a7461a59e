"""DuckDB SQL of the queries that SQL can express on whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = rf"""
with d as (select doc_id, source, coalesce(text, '') as t, {WORDS} as w from documents),
tri as (select doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] as g
        from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from tri) where n > 1),
cover as (select doc_id, count(distinct p) as n_repeat_words
          from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id),
lines as (select doc_id, source, unnest(string_split(t, chr(10))) as l from d),
good as (select doc_id, source, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as n,
                regexp_replace(trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]+', '0', 'g') as norm
         from lines where regexp_matches(l, '[^\x20\x09-\x0D]')),
dup as (select doc_id, count(*) - count(distinct l) as n_dup_lines from good group by doc_id),
hosts as (select source, count(*) as n from d group by source),
common as (select g.source, g.norm from good g join hosts h on g.source is not distinct from h.source
           group by g.source, g.norm, h.n having count(distinct doc_id) >= 20 and count(distinct doc_id) > 0.02 * h.n),
lost as (select g.doc_id, sum(g.n) as lost from good g join common c on g.norm = c.norm and g.source is not distinct from c.source group by g.doc_id),
base as (select d.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
                coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(lost, 0)::bigint as n_line_words_removed
         from d left join cover using (doc_id) left join dup using (doc_id) left join lost using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed, n_line_words_removed,
       (not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_line_words_removed > 0.3 * n_words) as kept
from base
"""

OP4 = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, g from (
        select doc_id, array_to_string(w[i:i + 4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)
        union all select doc_id, '<' || array_to_string(w, ' ') from d where len(w) between 1 and 4)),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
low as (select a as doc_id, min(b) as m from reach group by a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id
from d left join n using (doc_id) left join low using (doc_id)
"""

OP5 = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
ok as (select vec_id, e from v where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
       and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
low as (select a as vec_id, min(b) as m from reach group by a),
deg as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(m, vec_id)) as component_id,
       least(vec_id, coalesce(m, vec_id)) = vec_id as kept, 1.0::double as audit_recall
from v left join deg using (vec_id) left join low using (vec_id)
"""

OP10 = rf"""
with d as (select doc_id, {WORDS} as w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as g from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)),
again as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as lo from win) where lo < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from again),
word as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as x from d),
kept as (select doc_id, string_agg(x, ' ' order by p) as t from word anti join gone using (doc_id, p) group by doc_id),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id) left join lost using (doc_id)
"""

OP12 = rf"""
with recursive bits as (select b, 0 as k, b as v from (select unnest(range(256)) as b)
    union all select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
step as (select b, v from bits where k = 8),
words as (select 1 as kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    union all select 2, null, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
spots as (select kind, doc_id, w, unnest(range(1, len(w) + 1)) as i from words),
feature as (select kind, doc_id, unnest([array_to_string(w[i:i], ' '), case when i + 1 <= len(w) then array_to_string(w[i:i + 1], ' ') end,
                                        case when i + 2 <= len(w) then array_to_string(w[i:i + 2], ' ') end]) as f from spots),
each as (select f, hex(f) as h, strlen(f) as n from (select distinct f from feature where f is not null)),
far as (select max(n) as n from each),
place as (select 0 as d, b, v from step union all
    select d + 1, p.b, xor(p.v >> 8, s.v) from place p join step s on s.b = p.v & 255, far where d + 1 < far.n),
empty as (select 0 as n, 4294967295 as v union all
    select e.n + 1, xor(e.v >> 8, s.v) from empty e join step s on s.b = e.v & 255, far where e.n < far.n),
byte as (select f, n, n - 1 - i as d, ('0x' || substr(h, 2 * i + 1, 2))::bigint as b from (select f, h, n, unnest(range(n)) as i from each)),
bucket as (select f, xor(xor(bit_xor(p.v), any_value(e.v)), 4294967295) % 10000 as b
           from byte join place p using (d, b) join empty e on e.n = byte.n group by f),
counts as (select b, count(*) filter (kind = 1) as s, count(*) filter (kind = 2) as t from feature join bucket using (f) group by b),
total as (select coalesce(sum(s), 0) as s, coalesce(sum(t), 0) as t from counts),
gain as (select b, floor(1000 * ln((c.t + 1)::double * (total.s + 10000)::double / ((c.s + 1)::double * (total.t + 10000)::double)))::bigint as g from counts c, total),
weigh as (select doc_id, count(*) as n, sum(g)::bigint as weight from feature join bucket using (f) join gain using (b) where kind = 1 group by doc_id),
scored as (select w.doc_id, len(w.w) as n_words, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
                  coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
           from words w left join weigh on w.doc_id = weigh.doc_id where kind = 1),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from scored where n_words >= 20)
select s.doc_id, s.n_words::bigint as n_words, n_features, weight, score, case when rank <= 5 * n // 100 then rank end as rank
from scored s left join ranked using (doc_id)
"""

OP13 = r"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
                  sha256('42:' || doc_id) as x from documents),
h as (select doc_id, t, u, len(u) as n, [('0x' || substr(x, i, 8))::bigint for i in [1, 9, 17, 25]] as h from d),
cut as (select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 50 then 'plain'
                       when h[4] % 100 < 80 then 'spm' else 'psm' end as form,
               least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as z from h),
part as (select *, coalesce(array_to_string(u[1:a], ''), '') as p, coalesce(array_to_string(u[a + 1:z], ''), '') as m,
                coalesce(array_to_string(u[z + 1:], ''), '') as s from cut)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars,
       case when form <> 'plain' then length(m) end::bigint as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from part
"""

ORACLE_SQL = {"op3_quality_rules": OP3, "op4_ngram_jaccard_join": OP4, "op5_vector_dedup": OP5, "op10_substring_dedup": OP10,
              "op12_importance_resampling": OP12, "op13_fill_in_middle": OP13}
