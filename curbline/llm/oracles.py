"""The same results in another engine's SQL, for the corpus queries that SQL can express."""

from __future__ import annotations

from curbline.llm.licenses import LEAST_DICE, TEMPLATES

MIXING = r"""
with sized as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), turned as (
  select *, row_number() over (order by source nulls last) - 1 as turn from sources
), capped as (
  select *, cast(turn % 3 + 1 as double) as weight, source_size * 3.0::double as cap from turned
), levels as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over before, 0.0))
            / (sum(weight) over () - coalesce(sum(weight) over before, 0.0)) as level
  from capped
  window before as (order by cap / weight, turn rows between unbounded preceding and 1 preceding)
), first_free as (
  select cap / weight as ratio, turn, level from levels where level * weight < cap order by 1, 2 limit 1
), shares as (
  select l.source, l.source_size,
         case when f.turn is not null and (l.cap / l.weight, l.turn) >= (f.ratio, f.turn)
              then f.level * l.weight else l.cap end as target
  from levels l left join first_free f on true
), cuts as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from shares
), ordered as (
  select s.doc_id, s.size, c.source_size, c.target, c.epochs,
         cast(floor(c.target - c.epochs * c.source_size) as bigint) as rest,
         coalesce(sum(s.size) over (partition by s.source order by md5(concat('mix:', coalesce(s.doc_id::varchar, 'null'))),
                  s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0) as ahead
  from sized s join cuts c on s.source is not distinct from c.source
)
select doc_id, size, source_size, target,
       cast(epochs * size + greatest(0, least(size, rest - ahead)) as bigint) as taken
from ordered
"""

DECONTAMINATION = r"""
with texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words, row_number() over () as row
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark where item_id is not null
), item_windows as (
  select distinct item_id, least(len(words), 13) as size,
         array_to_string(words[pos : pos + least(len(words), 13) - 1], ' ') as piece
  from (select *, unnest(range(1, greatest(len(words) - 11, 2))) as pos from items where len(words) > 0)
), document_windows as (
  select row, pos, size, array_to_string(words[pos : pos + size - 1], ' ') as piece
  from (select t.row, t.words, s.size, unnest(range(1, len(words) - s.size + 2)) as pos
        from texts t, (select distinct size from item_windows) s where len(t.words) >= s.size)
), hits as (
  select d.row, d.pos, d.size, i.item_id from document_windows d join item_windows i using (size, piece)
), hit_words as (
  select row, count(distinct place) as n_hit
  from (select row, unnest(range(pos, pos + size)) as place from (select distinct row, pos, size from hits)) group by row
), hit_items as (
  select row, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct row, cast(item_id as varchar) as item from hits) group by row
)
select t.doc_id, cast(len(t.words) as bigint) as n_words, coalesce(w.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
       sha256(coalesce(i.listed, '')) as items_sha256, coalesce(w.n_hit, 0) > 0 and 20 * w.n_hit >= len(t.words) as contaminated
from texts t left join hit_words w using (row) left join hit_items i using (row)
"""

QUALITY_RULES = r"""
with texts as (
  select doc_id, coalesce(text, '') as text, row_number() over () as row,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), lines as (
  select row, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select row, unnest(string_split(text, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by row
), windows as (
  select row, pos, count(*) over (partition by row, words[pos], words[pos + 1], words[pos + 2]) as times
  from (select row, words, unnest(range(1, len(words) - 1)) as pos from texts)
), repeats as (
  select row, count(distinct place) as n_repeat_words
  from (select row, unnest([pos, pos + 1, pos + 2]) as place from windows where times > 1) group by row
), measured as (
  select t.doc_id, cast(len(words) as bigint) as n_words, coalesce(cast(list_sum([len(w) for w in words]) as bigint), 0) as word_chars,
         cast(len(text) - len(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(n_lines, 0) as n_lines, len(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
         len(regexp_replace(text, '[^A-Za-z]', '', 'g')) as n_letters, len(text) - len(replace(text, '!', '')) as n_bangs
  from texts t left join lines using (row) left join repeats using (row)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 100 * n_symbols > 10 * n_words
            or 100 * n_dup_lines > 30 * n_lines or 100 * word_chars < 200 * n_words or 100 * word_chars > 1600 * n_words
            or 100 * n_upper > 60 * n_letters or 100 * n_bangs > 30 * n_words) as kept
from measured
"""


def licenses() -> str:
    quoted = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    lower = "translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with texts as (
  select doc_id, coalesce(text, '') as text, row_number() over () as row from documents
), pieces as (
  select row, 'text' as level, text as piece from texts
  union all select row, 'line', unnest(string_split(text, chr(10))) from texts
  union all select row, 'sentence', unnest(string_split(regexp_replace(text, '([.!?])[ \t]', '\1' || chr(10), 'g'), chr(10))) from texts
), templates as (
  select * from (values {quoted}) as t(template, license, piece)
), all_pieces as (
  select 'u' as kind, row_number() over () as unit, row, level, piece from pieces
  union all select 't', template, null, null, piece from templates
), worded as (
  select kind, unit, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words, row, level from all_pieces
), grams as (
  select distinct kind, unit, words[pos] || ' ' || words[pos + 1] as gram
  from (select kind, unit, words, unnest(range(1, len(words))) as pos from worded)
), sizes as (
  select kind, unit, count(*) as n from grams group by all
), common_grams as (
  select u.unit, t.unit as template, count(*) as shared
  from grams u join grams t on u.gram = t.gram and u.kind = 'u' and t.kind = 't' group by all
), scored as (
  select o.unit, o.template, 2 * shared / (a.n + b.n) as dice
  from common_grams o join sizes a on a.kind = 'u' and a.unit = o.unit join sizes b on b.kind = 't' and b.unit = o.template
), chosen as (
  select unit, license, dice from scored join templates using (template) where dice >= {LEAST_DICE}
  qualify row_number() over (partition by unit order by dice desc, template) = 1
), by_text as (
  select w.row, count(*) as n, string_agg(distinct license, ',' order by license) as listed, max(dice) as dice
  from chosen c join worded w on w.kind = 'u' and w.unit = c.unit group by w.row
)
select doc_id, coalesce(n, 0) as n_matches, coalesce(listed, '') as licenses, coalesce(dice, 0.0)::double as dice
from texts left join by_text using (row)
"""


JACCARD = r"""
with recursive texts as (
  select doc_id, row_number() over () as row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents
), shingles as (
  select row, list_sort(list_distinct(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
         else [array_to_string(words[i : i + 4], ' ') for i in range(1, len(words) - 3)] end)) as own
  from texts
), classes as (
  select own, min(doc_id) as least, len(own) as n from shingles join texts using (row) where len(own) > 0 group by own
), grams as (
  select least, n, unnest(own) as gram from classes
), links as (
  select a.least as x, b.least as y from grams a join grams b on a.gram = b.gram and a.least < b.least
  group by a.least, b.least, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), both_ways as (
  select x, y from links union all select y, x from links
), reached as (
  select least as x, least as y from classes union select r.x, b.y from reached r join both_ways b on b.x = r.y
), parts as (
  select x, min(y) as component_id from reached group by x
)
select doc_id, cast(len(s.own) as bigint) as n_shingles, coalesce(p.component_id, doc_id) as component_id
from texts join shingles s using (row) left join classes c on c.own = s.own left join parts p on p.x = c.least
"""


PIVOT_SEARCH = r"""
with vectors as (
  select row_number() over () as row, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint::double) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
), scored as (
  select q.row as query, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on q.row <> c.row
  where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query order by score desc, vec_id nulls last) as place from scored
)
select query_id, place::int as rank, vec_id, score from ranked where place <= 5
"""

INFILLING = r"""
with lines as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
         sha256('7:' || coalesce(doc_id::varchar, '')) as digest
  from documents
), drawn as (
  select doc_id, text, units, len(units) as n,
         ('0x' || digest[1:8])::bigint % (len(units) + 1) as cut1, ('0x' || digest[9:16])::bigint % (len(units) + 1) as cut2,
         ('0x' || digest[17:24])::bigint as h3, ('0x' || digest[25:32])::bigint as h4
  from lines
), parts as (
  select doc_id, text, n,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100
              then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form,
         array_to_string(units[1:least(cut1, cut2)], '') as prefix,
         array_to_string(units[least(cut1, cut2) + 1:greatest(cut1, cut2)], '') as middle,
         array_to_string(units[greatest(cut1, cut2) + 1:], '') as suffix
  from drawn
)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
from parts
"""

MANIFEST = r"""
with recursive leaves as (
  select row_number() over () as row, doc_id, lang,
         [coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-'),
          coalesce(strlen(text) || ':' || text, '-')] as fields,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') as lowered
  from documents
), bits as (
  -- crc32 by its definition, byte by byte over the decimal id
  select doc_id, 1 as i, 4294967295::ubigint as crc, 0 as step from (select distinct doc_id from documents where doc_id is not null)
  union all
  select doc_id, case when step = 8 then i + 1 else i end,
         case when step = 0 then xor(crc, ascii((doc_id::varchar)[i])::ubigint)
              when crc & 1 = 1 then xor(crc >> 1, 3988292384::ubigint) else crc >> 1 end,
         case when step = 8 then 0 else step + 1 end
  from bits where i <= length(doc_id::varchar)
), hit as (
  select doc_id from bits where i > length(doc_id::varchar) and xor(crc, 4294967295::ubigint) % 3 = 0
), hashed as (
  select l.row, l.doc_id, l.lang, sha256(array_to_string(l.fields, '')) as leaf,
         case when h.doc_id is not null then sha256(array_to_string(l.fields[1:4], '') || l.lowered)
              else sha256(array_to_string(l.fields, '')) end as changed
  from leaves l left join hit h on l.doc_id = h.doc_id
), placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         dense_rank() over (order by lang nulls first) - 1 as tree
  from hashed
), nodes as (
  select tree, 0 as level, pos, leaf as digest from placed
  union all
  select tree, level + 1, pos // 8, sha256(string_agg(digest, '' order by pos))
  from (select *, count(*) over (partition by tree) as n from nodes) where n > 1 group by tree, level, pos // 8
), subroots as (
  select tree, arg_max(digest, level) as subroot, max(level) as height from nodes group by tree
), upper as (
  select 0 as level, tree as pos, subroot as digest from subroots
  union all
  select level + 1, pos // 8, sha256(string_agg(digest, '' order by pos))
  from (select *, count(*) over () as n from upper) where n > 1 group by level, pos // 8
), top as (
  select arg_max(digest, level) as root, max(level) as height from upper
), every as (
  select n.tree, n.level, n.pos, n.digest from nodes n join subroots s on s.tree = n.tree and n.level < s.height
  union all
  -- the levels from the subroots up stand above each tree's own
  select s.tree, s.height + u.level, u.pos, u.digest from subroots s, upper u
), fold as (
  select row, tree, 0 as level, pos, changed as digest, '' as proof from placed
  union all
  select f.row, f.tree, f.level + 1, f.slot // 8,
         sha256(string_agg(case when e.pos = f.slot then f.digest else e.digest end, '' order by e.pos)),
         any_value(f.proof) || coalesce(string_agg(e.digest, '' order by e.pos) filter (where e.pos <> f.slot), '')
  from (select fold.*, case when fold.level = s.height then fold.tree else fold.pos end as slot,
               s.height + t.height as most
        from fold join subroots s using (tree), top t) f
  join every e on e.tree = f.tree and e.level = f.level and e.pos // 8 = f.slot // 8
  where f.level < f.most
  group by f.row, f.tree, f.level, f.slot
)
select p.doc_id, p.leaf, s.subroot, t.root, sha256(f.proof) as proof_sha256, f.digest as folded_root, f.digest = t.root as verified
from placed p join subroots s using (tree) join fold f using (row), top t
where f.level = s.height + t.height
"""

ORACLE_SQL = {
    "op1_decontamination": DECONTAMINATION,
    "op2_licenses": licenses(),
    "op8_mixing": MIXING,
    "op9_quality_rules": QUALITY_RULES,
    "op10_jaccard": JACCARD,
    "op11_pivot_search": PIVOT_SEARCH,
    "op12_infilling": INFILLING,
    "op13_manifest": MANIFEST,
}
