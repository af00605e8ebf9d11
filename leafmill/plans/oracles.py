"""SQL oracles (DuckDB) of the document engine's queries, over the same fixture views."""

from __future__ import annotations

LINES = r"""
raw as (select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as ln
        from documents where text is not null),
lines0 as (select doc_id, ln::int as ln, case (doc_id * 7 + ln) % 16
  when 0 then '## ' || substr(raw, 1, 40)
  when 2 then '![Figure ' || ln || '](images/page' || (1 + (doc_id + ln) % 9) || '_fig1.png)'
  when 3 then '*Figure ' || ln || '. ' || substr(raw, 1, 30) || '*'
  when 4 then ''
  when 5 then 'Table ' || (1 + ln % 7) || '. ' || substr(raw, 1, 50)
  when 6 then '| h1 | h2 | h3 |'
  when 7 then '|----|----|----|'
  when 8 then '| ' || substr(raw, 1, 8) || ' | ' || ln || ' |  |'
  when 9 then ''
  when 11 then '- ' || raw
  when 12 then '2) ' || raw
  when 13 then '<!-- formula-not-decoded -->'
  when 14 then '### ' || substr(raw, 1, 25)
  else raw end as line from raw),
totals as (select doc_id, (sum(length(line) + 1) - 1)::int as total, string_agg(line, chr(10) order by ln) as text from lines0 group by doc_id),
starts as (select doc_id, ln, line, coalesce(sum(length(line) + 1) over (partition by doc_id order by ln rows between unbounded preceding and 1 preceding), 0)::int as char_start from lines0),
lines as (select doc_id, ln, line, char_start, least(char_start + length(line) + 1, total)::int as char_end, total from starts join totals using (doc_id))"""

KINDS = (
    LINES
    + r""",
kinds0 as (select *, case when regexp_matches(line, '^(#{1,6})\s+(.+)$') then 'heading' when regexp_matches(line, '^<!--\s*formula-not-decoded\s*-->') then 'formula'
  when regexp_matches(line, '^!\[([^\]]*)\]\(([^)]+)\)') then 'figure' when regexp_matches(line, '^\|') then 'table'
  when regexp_matches(line, '^(\s*[-*+]|\s*\d+[.)]) ') then 'list' when line = '' then 'blank' else 'text' end as kind0 from lines),
kinds as (select *, case when kind0 in ('text', 'list') and regexp_matches(line, '^\*(.+)\*$') and lag(kind0) over (partition by doc_id order by ln) = 'figure' then 'caption' else kind0 end as kind from kinds0)"""
)

BLOCKS = (
    KINDS
    + r""",
typed as (select *, case when kind in ('blank', 'text') then 'paragraph' when kind = 'caption' then 'figure' else kind end as block_type from kinds),
fresh as (select *, (kind in ('heading', 'formula', 'figure') or coalesce(lag(block_type) over (partition by doc_id order by ln) <> block_type, true))::int as fresh from typed),
islands0 as (select *, sum(fresh) over (partition by doc_id order by ln) as island from fresh),
islands as (select doc_id, island, any_value(block_type) as block_type, string_agg(line, chr(10) order by ln) as content, min(char_start) as s, max(char_end) as e,
  min(char_end) as first_end, any_value(total) as total_chars from islands0 group by doc_id, island),
flowed as (select *, lag(block_type) over w as before, lead(block_type) over w as after, lead(first_end) over w as next_end from islands window w as (partition by doc_id order by island)),
blocks0 as (select doc_id, island, block_type, case when block_type in ('paragraph', 'table', 'list') then regexp_replace(content, '^\s+|\s+$', '', 'g') else content end as content,
  case when block_type = 'paragraph' and before in ('table', 'list') then first_end else s end as char_start,
  case when (block_type in ('table', 'list') and after = 'paragraph') or (block_type = 'table' and after = 'list') then next_end else e end as char_end, total_chars from flowed),
blocks as (select doc_id, (row_number() over (partition by doc_id order by island) - 1)::int as block_id, block_type, content,
  case when block_type = 'heading' then length(regexp_extract(content, '^(#{1,6})\s+(.+)$', 1)) end as heading_level,
  regexp_extract_all(content, '!\[([^\]]*)\]\(([^)]+)\)', 2) as image_refs, block_type = 'formula' as has_formula, char_start::int as char_start, char_end::int as char_end, total_chars
  from blocks0 where content <> '')"""
)

_LEVELS = "\n".join(
    f"max(case when heading_level = {k} then block_id end) over w as p{k}, max_by(title, case when heading_level = {k} then block_id end) filter (heading_level = {k}) over w as t{k}," for k in range(1, 7)
)
_OPEN = ", ".join(
    "case when p{k} is not null and {c} then t{k} end".format(k=k, c=" and ".join(["true"] + [f"p{k} > coalesce(p{j}, -1)" for j in range(1, k)])) for k in range(1, 7)
)
PATHS = (
    BLOCKS
    + f""",
titled as (select *, case when block_type = 'heading' then regexp_replace(regexp_replace(content, '^#+\\s*', ''), '^\\s+|\\s+$', '', 'g') end as title from blocks),
levels as (select *, {_LEVELS} 1 as one from titled window w as (partition by doc_id order by block_id rows between unbounded preceding and current row)),
paths as (select * exclude (one), list_filter([{_OPEN}], lambda x: x is not null) as heading_path from levels)"""
)

CHUNKS = (
    PATHS
    + r""",
marked as (select *, block_type in ('heading', 'table', 'figure', 'formula') as hard, sum((block_type in ('heading', 'table', 'figure', 'formula'))::int) over (partition by doc_id order by block_id) as run from paths),
nexts as (select doc_id, run, min(char_start) as next_start from marked where hard group by doc_id, run),
prose as (select m.doc_id, m.run, min(block_id) as pos, string_agg(content, chr(10) || chr(10) order by block_id) as content, min_by(heading_path, block_id) as heading_path,
  flatten(list(image_refs order by block_id)) as image_refs, min_by(char_start, block_id) as char_start, any_value(total_chars) as total from marked m where not hard group by m.doc_id, m.run),
chunks0 as (
  select doc_id, pos, content, heading_path, 'paragraph' as block_type, image_refs, false as has_formula, p.char_start, coalesce(n.next_start, total) as char_end
  from prose p left join (select doc_id, run - 1 as run, next_start from nexts) n using (doc_id, run)
  union all
  select doc_id, block_id, content, heading_path, block_type, image_refs, has_formula, char_start, char_end from marked where hard and block_type <> 'heading'),
chunks as (select doc_id, (row_number() over (partition by doc_id order by pos) - 1)::int as chunk_index, content, heading_path, block_type, image_refs, has_formula, char_start::int as char_start, char_end::int as char_end,
  coalesce(nullif(regexp_extract(list_filter(image_refs, lambda r: regexp_matches(r, '(?i)page\d+'))[1], '(?i)page(\d+)', 1), '')::int, greatest(1, char_start // 3000 + 1))::int as page_number,
  greatest(1, length(content) // 4)::int as token_count from chunks0)"""
)
