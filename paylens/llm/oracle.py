"""DuckDB SQL equal to the queries that SQL can express."""

# Words, as the operators cut them: runs without space, \t, \n, \v, \f, \r.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op9_quality_rules"] = rf"""
with docs as (
  select row_number() over () as rid, doc_id, source as host, coalesce(text, '') as body, {WORDS} as ws
  from documents),
lines as (
  select rid, host, md5(body) as content, unnest(list_filter(string_split(body, chr(10)),
         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) as line
  from docs),
dups as (select rid, count(*) - count(distinct line) as n_dup_lines from lines group by rid),
normal as (
  select rid, host, content,
         lower(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')) as line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
  from lines),
per_host as (select host, count(distinct md5(body)) as texts from docs group by host),
frequent as (
  select normal.host, line from normal join per_host on normal.host is not distinct from per_host.host
  group by normal.host, line, texts
  having count(distinct content) >= 10 and 100 * count(distinct content) > 10 * texts),
starts as (select rid, ws, unnest(generate_series(1, len(ws) - 7)) as i from docs where len(ws) >= 8),
windows as (select rid, i, array_to_string(list_slice(ws, i, i + 7), ' ') as w from starts),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, w) as c from windows) where c > 1),
repeats as (
  select rid, sum(least(8, coalesce(nxt - i, 8))) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as nxt from twice) group by rid),
counted as (
  select docs.rid, doc_id, host, len(ws) as n_words,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::bigint as word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from docs left join dups using (rid) left join repeats using (rid)),
ruled as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted),
lost as (
  select rid, sum(n)::bigint as n from normal join frequent
  on normal.host is not distinct from frequent.host and normal.line = frequent.line group by rid)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * (n_words - n_removed) >= 50 * n_words as kept, n_removed
from (select ruled.*, case when base_failed then 0 else coalesce(lost.n, 0) end as n_removed
      from ruled left join lost using (rid))
"""

ORACLES["op6_substring_dedup"] = rf"""
with docs as (select row_number() over () as rid, doc_id, {WORDS} as ws from documents),
starts as (select rid, doc_id, ws, unnest(generate_series(1, len(ws) - 12)) as i from docs where len(ws) >= 13),
windows as (select rid, doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') as w from starts),
later as (select rid, i from (select rid, doc_id, i, min(doc_id) over (partition by w) as first from windows)
          where first < doc_id),
gone as (select distinct rid, unnest(generate_series(i, i + 12)) as i from later),
spots as (select rid, unnest(ws) as word, generate_subscripts(ws, 1) as i from docs),
kept as (
  select rid, count(*) as n, string_agg(word, ' ' order by i) as body
  from spots where not exists (select 1 from gone where gone.rid = spots.rid and gone.i = spots.i) group by rid)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(body, '')) as kept_sha256
from docs left join kept using (rid)
"""

ORACLES["op10_line_winnowing"] = r"""
with docs as (select row_number() over () as rid, doc_id, text, string_split(coalesce(text, ''), chr(10)) as ls
              from documents),
raws as (select rid, doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as raw from docs),
lines as (
  select rid, doc_id, raw, row_number() over (partition by rid order by raw) as pos,
         array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+'), ' ') as line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as size
  from raws where regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs as (
  select here.rid as rid, there.rid as other, here.pos as pos, here.pos - there.pos as shift, here.size as size
  from lines here join lines there on here.line = there.line
  where {'doc_id': there.doc_id, 'pos': there.pos} < {'doc_id': here.doc_id, 'pos': here.pos}),
runs as (
  select rid, min(pos) as start, max(pos) as stop
  from (select *, pos - row_number() over (partition by rid, other, shift order by pos) as island from pairs)
  group by rid, other, shift, island having count(*) >= 3 or sum(size) >= 50),
wholes as (
  select rid, doc_id, list(line order by pos) as body, max(pos) as stop from lines group by rid, doc_id
  having count(*) < 3 and sum(size) < 50),
short as (
  select rid, 1 as start, stop from (select *, min(doc_id) over (partition by body) as least from wholes)
  where least < doc_id),
covered as (
  select distinct rid, unnest(generate_series(start, stop)) as pos
  from (select * from runs union all select * from short)),
marked as (
  select lines.rid, raw, covered.pos is not null as gone,
         lead(raw) over w as next_raw, lead(covered.pos) over w is not null as next_gone
  from lines left join covered on lines.rid = covered.rid and lines.pos = covered.pos
  window w as (partition by lines.rid order by lines.pos)),
deleted as (
  select rid, unnest(generate_series(raw, case when next_gone then next_raw - 1 else raw end)) as raw
  from marked where gone),
kept as (
  select rid, string_agg(line, chr(10) order by raw) as body from raws
  where not exists (select 1 from deleted d where d.rid = raws.rid and d.raw = raws.raw) group by rid),
counts as (select rid, count(*) as n_lines, count(*) filter (where gone) as n_removed from marked group by rid)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(body, '')) as kept_sha256
from docs left join counts using (rid) left join kept using (rid)
"""

# CRC-32 of a text's UTF-8 bytes, from its rule: a table of 256 remainders, a step per byte.
CRC_TABLE = """select list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
         lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps"""


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of ``text``, where CRC_TABLE's ``steps`` is in scope."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(hex({text})), 2), "
            f"lambda i: ('0x' || substr(hex({text}), i, 2))::bigint)), "
            "lambda c, x: xor(steps[(xor(c, x) & 255) + 1], c >> 8)))")


ORACLES["op11_spelling_variants"] = rf"""
with recursive table256 as ({CRC_TABLE}),
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{{C0}}-\x{{FF}}]+')) as run from documents),
counted as (
  select run, n, {crc32("concat(doc_id, ':', run)")} as h
  from (select doc_id, run, count(*) as n from runs group by all), table256),
words as (
  select word, sum(n)::bigint as n from (
    select case when h % 97 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n
    from counted)
  where length(word) >= 5 group by word having sum(n) >= 3),
cut as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as part
  from (select word, n, unnest(generate_series(1, length(word))) as i from words)),
near as (
  select distinct a.word, b.word as other, b.n from cut a join cut b on a.i = b.i and a.part = b.part and a.word <> b.word
  union
  select words.word, cut.word, cut.n from words join cut on words.word = cut.part
  union
  select cut.word, words.word, words.n from words join cut on words.word = cut.part),
best as (select word, count(*) as n_near, min({{'less': -n, 'other': other}}) as b from near group by word),
forms as (
  select words.word, words.n, coalesce(n_near, 0) as n_near,
         case when -b.less >= 2 * words.n then b.other end as form, case when -b.less >= 2 * words.n then -b.less end as form_n
  from words left join best using (word)),
walk as (
  select word, word as here, 0 as steps from forms
  union all
  select walk.word, forms.form, walk.steps + 1 from walk join forms on walk.here = forms.word where forms.form is not null),
roots as (select word, arg_max(here, steps) as root from walk group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)
"""

ORACLES["op12_conversation_trie"] = rf"""
with table256 as ({CRC_TABLE}),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first) - 1 as place
  from conversations where conv_id is not null),
convs as (select conv_id, {crc32("conv_id::varchar")} % 4 as h
          from (select distinct conv_id from turns), table256),
parts as (
  select convs.conv_id, 0 as own, place, role, text from convs join turns
  on turns.conv_id = convs.conv_id - convs.conv_id % 20 and place < h
  union all
  select convs.conv_id, 1, place, role, text from convs join turns on turns.conv_id = convs.conv_id and place >= h),
rebuilt as (
  select conv_id, role, text, row_number() over (partition by conv_id order by own, place) as depth from parts),
paths as (
  select conv_id, depth, md5(string_agg(md5(role) || md5(text), '') over (partition by conv_id order by depth)) as node,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as tokens
  from rebuilt
  union all
  select conv_id, 0, 'root', 0 from convs),
linked as (
  select *, lag(node) over w as parent, lead(node) over w is null as last from paths window w as (partition by conv_id order by depth)),
nodes as (
  select depth, node, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(tokens) as tokens,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '')) as ends_sha256
  from linked group by depth, node),
children as (select depth - 1 as depth, parent as node, count(*) as n_children from nodes group by all),
full_nodes as (
  select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children
  on nodes.depth = children.depth and nodes.node = children.node),
above as (
  select distinct low.depth as depth, low.node as node, high.depth as top_depth, high.node as top
  from paths low join paths high on low.conv_id = high.conv_id and high.depth <= low.depth),
sums as (
  select top_depth as depth, top as node, sum((n_children = 0)::int)::bigint as n_leaves,
         sum((n_convs - 1) * tokens)::bigint as saved_tokens
  from above join full_nodes using (depth, node) group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
from full_nodes n join sums using (depth, node) left join full_nodes p on p.depth = n.depth - 1 and p.node = n.parent
"""
