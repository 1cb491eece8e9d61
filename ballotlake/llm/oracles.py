"""The text queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from ballotlake.llm import ball_tree, decontaminate, line_spread, mixing, quality_rules, suffix_dedup

# A line with a word on enough sites stays in the document with the smallest doc_id only.
LINE_SPREAD = f"""
with lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as body from documents
),
spread as (
  select body, min(doc_id) as keeper from lines
  where regexp_matches(body, '[^\\x20\\x09-\\x0D]')
  group by body 
  having count(distinct source) >= (select greatest({line_spread.FLOOR}, least({line_spread.SITES}, ceil({line_spread.SHARE} * count(distinct source)))) from documents)
),
gone as (
  select l.doc_id, list(distinct l.body) as bodies
  from lines l join spread s on l.body = s.body
  where l.doc_id is distinct from s.keeper
  group by l.doc_id
),
kept as (
  select d.doc_id, d.text, string_split(d.text, chr(10)) as parts,
         list_filter(string_split(d.text, chr(10)), lambda b: not list_contains(coalesce(g.bodies, []), b)) as remaining
  from documents d left join gone g on d.doc_id is not distinct from g.doc_id
)
select doc_id,
       case when len(remaining) < len(parts) then array_to_string(remaining, chr(10)) else text end as text,
       coalesce(len(parts) - len(remaining), 0)::bigint as n_removed
from kept
"""

# Every window of every item against every run of as many words of every document.
DECONTAMINATION = f"""
with tokens as (
  select doc_id, row_number() over () as row, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words
  from documents
),
items as (
  select coalesce(item_id::varchar, '') as item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words
  from benchmark
),
runs as (
  select item, least(len(words), {decontaminate.WINDOW}) as size,
         unnest(list_transform(range(1, greatest(len(words) - {decontaminate.WINDOW} + 1, 1) + 1),
                               lambda i: array_to_string(words[i:i + {decontaminate.WINDOW} - 1], ' '))) as body
  from items where len(words) > 0
),
sizes as (select distinct size from runs),
spots as (
  select row, words, size, unnest(range(1, len(words) - size + 2)) as spot
  from tokens, sizes where len(words) >= size
),
found as (
  select s.row, s.spot, s.size, r.item
  from spots s join runs r on r.size = s.size and r.body = array_to_string(s.words[s.spot:s.spot + s.size - 1], ' ')
),
hit as (
  select row, count(distinct w) as n_hit from (select row, unnest(range(spot, spot + size)) as w from found) group by row
),
named as (
  select row, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct row, item from found) group by row
)
select t.doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from tokens t left join hit using (row) left join named using (row)
"""

# Water filling in the order of cap per weight; golden-ratio points name every slot's source, and its slots tell what
# is taken of a source's stream.
MIXING = f"""
with sizes as (
  select doc_id, source, md5('{mixing.SEED}|' || coalesce(doc_id::varchar, '')) as shuffle,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::bigint as size
  from documents
),
named as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source is null, source) - 1 as sid
  from sizes group by source
),
capped as (
  select *, [{', '.join(map(str, mixing.CYCLE))}][(sid % {len(mixing.CYCLE)}) + 1]::bigint as weight, source_size * {mixing.MOST} as cap,
         (sum(source_size) over ())::bigint * {mixing.SHARE}::double as words
  from named
),
levels as (
  select *, (sum(weight) over ())::bigint as weights,
         coalesce(sum(cap) over filling, 0)::bigint as cap_before, coalesce(sum(weight) over filling, 0)::bigint as weight_before
  from capped
  window filling as (order by cap / weight, sid rows between unbounded preceding and 1 preceding)
),
stopped as (select *, cap <= weight * ((words - cap_before) / (weights - weight_before)) as stops from levels),
targets as (
  select source, source_size,
         case when stops then cap::double
              else weight * (words - (coalesce(sum(case when stops then cap end) over (), 0))::bigint)
                   / (weights - (coalesce(sum(case when stops then weight end) over (), 0))::bigint) end as target
  from stopped
),
needs as (
  select *, floor(target)::bigint as need, row_number() over (order by source is null, source) - 1 as sid from targets
),
edges as (
  select *, (sum(need) over (order by sid rows unbounded preceding))::bigint - need as low,
         (sum(need) over (order by sid rows unbounded preceding))::bigint as high,
         greatest((sum(source_size) over ())::bigint // {mixing.SLOTS}, 1) as block, (sum(need) over ())::bigint as words
  from needs
),
points as (
  select slot, floor((turned - floor(turned)) * words)::bigint as place
  from (select slot, words, (slot + 1) * {mixing.GOLDEN}::double as turned
        from (select distinct block, words from edges) cross join unnest(range(0, (words + block - 1) // block)) as s(slot))
),
ranked as (
  select slot, sid, block, source_size, row_number() over (partition by sid order by slot) - 1 as rank
  from points join edges on place >= low and place < high
),
drawn as (select * from ranked where rank * block < {mixing.MOST} * source_size),
reached as (
  select e.*, coalesce(sum(least(d.block, {mixing.MOST} * d.source_size - d.rank * d.block)), 0)::bigint as reach
  from edges e left join drawn d using (sid) group by all
),
placed as (
  select doc_id, size, r.*, coalesce(sum(size) over (partition by sid order by shuffle, size
                                    rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sizes s join reached r on s.source is not distinct from r.source
),
cut as (
  select *, greatest(least(reach - start, size), 0) as lap0, greatest(least(reach - source_size - start, size), 0) as lap1
  from placed
),
found as (
  select *, case when lap0 + lap1 > 0 then start // block end as rank0,
         case when lap1 > 0 then (source_size + start + lap1 - 1) // block
              when lap0 > 0 then (start + lap0 - 1) // block end as rank1
  from cut
)
select doc_id, size, f.source_size, target, (lap0 + lap1)::bigint as taken, a.slot as first_slot, b.slot as last_slot
from found f left join drawn a on a.sid = f.sid and a.rank = rank0 left join drawn b on b.sid = f.sid and b.rank = rank1
"""

# Every window of bytes, as hexadecimal text, against the first document that has it.
SUFFIX_DEDUP = f"""
with texts as (
  select doc_id, coalesce(doc_id, {suffix_dedup.LAST}) as place, row_number() over () as row,
         hex(encode(coalesce(text, ''))) as body
  from documents
),
windows as (
  select row, place, at_byte, substr(body, 2 * at_byte + 1, {2 * suffix_dedup.MATCH}) as piece
  from (select *, unnest(range(0, len(body) // 2 - {suffix_dedup.MATCH} + 1)) as at_byte from texts)
),
firsts as (select piece, min(place) as first from windows group by piece),
gone as (select row, at_byte from windows join firsts using (piece) where first < place),
edges as (
  select *, coalesce(at_byte > lag(at_byte) over (partition by row order by at_byte) + {suffix_dedup.MATCH}, true) as new
  from gone
),
spans as (
  select row, min(at_byte) as low, max(at_byte) + {suffix_dedup.MATCH} as high
  from (select *, sum(new::int) over (partition by row order by at_byte) as span from edges) group by row, span
),
gaps as (
  select row, low, high, coalesce(lag(high) over (partition by row order by low), 0) as before,
         row_number() over (partition by row order by low desc) = 1 as last
  from spans
),
cut as (
  select t.row, sum(high - low)::bigint as n_removed, count(*) as n_spans,
         string_agg(substr(body, 2 * before + 1, 2 * (low - before)) || if(last, substr(body, 2 * high + 1), ''), '' order by low) as kept
  from gaps join texts t using (row) group by t.row
)
select doc_id, (len(body) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, body))) as kept_sha256
from texts left join cut using (row)
"""

# Counts by unnested words and windows; cutoffs from the exact binomial tail over all percentages.
_PERCENTS = ", ".join(
    f"{{rule: '{rule}', pct: if({bottom} > 0, least(100 * {top} // {bottom}, 100), 0)::int}}"
    for rule, (top, bottom) in quality_rules.RULES.items()
)
QUALITY = f"""
with texts as (
  select doc_id, lang, row_number() over () as row, coalesce(text, '') as body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
  from documents
),
windows as (
  select row, spot, array_to_string(words[spot:spot + {quality_rules.WINDOW - 1}], ' ') as window_text
  from (select row, words, unnest(range(1, len(words) - {quality_rules.WINDOW - 2})) as spot from texts)
),
twice as (
  select row, count(distinct w)::bigint as n_repeat_words
  from (select row, unnest(range(spot, spot + {quality_rules.WINDOW})) as w
        from (select *, count(*) over (partition by row, window_text) as often from windows) where often > 1)
  group by row
),
counted as (
  select t.row, doc_id, lang, len(words)::bigint as n_words, len(array_to_string(words, ''))::bigint as word_chars,
         len(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         len(regexp_replace(body, '[^A-Z]', '', 'g'))::bigint as n_capitals,
         len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1]))::bigint as n_stutter
  from texts t left join twice using (row)
),
stats as (
  select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.MAX_REPEAT} * n_words as base_failed,
         [{_PERCENTS}] as percents
  from counted
),
truth as (select doc_id, min(quality) as quality from labels where quality is not null group by doc_id),
known as (
  select lang, quality, unnest(percents) as p from stats join truth using (doc_id) where not base_failed
),
spread as (
  select lang, p.rule as rule, cutoff, count(*) filter (where quality = 1) as n,
         count(*) filter (where quality = 1 and p.pct > cutoff) as k,
         count(*) filter (where quality = 0 and p.pct > cutoff) as bad
  from known, (select unnest(range(0, 100))::int as cutoff) group by all
),
tails as (
  select *, if(k >= n * {quality_rules.RATE}, 1.0, list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality_rules.RATE}) + (n - i) * ln(1 - {quality_rules.RATE}))))) as tail,
      (select count(*) from (select distinct lang, rule from spread)) as tests
  from spread
),
admitted as (
  select * from (select *, max(tail) over (partition by lang, rule order by cutoff desc) as worst from tails)
  where worst <= {quality_rules.DELTA} / tests
),
chosen as (
  select lang, rule, arg_max(cutoff, (bad - {quality_rules.GOOD_COST} * k) * 1000 + cutoff) as cutoff from admitted group by lang, rule
),
broken as (
  select row, list(rule order by list_position([{', '.join(repr(r) for r in quality_rules.RULES)}], rule)) as rules
  from (select row, s.lang, unnest(percents) as p from stats s) s
  join chosen c on c.lang is not distinct from s.lang and c.rule = s.p.rule and s.p.pct > c.cutoff
  group by row
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and rules is null as kept, coalesce(array_to_string(rules, ','), '') as rejected_by
from stats left join broken using (row)
"""

# Every document's score for every item, from the words of all documents.
LEXICAL_SEARCH = f"""
with tokens as (
  select doc_id, row_number() over () as row, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words
  from documents
),
totals as (select count(*)::bigint as docs, sum(len(words))::bigint as length from tokens where len(words) > 0),
asked as (
  select distinct item_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')) as term
  from benchmark
),
counts as (
  select row, any_value(doc_id) as doc_id, any_value(n) as n, term, count(*)::bigint as tf
  from (select row, doc_id, len(words)::bigint as n, unnest(words) as term from tokens)
  where term in (select term from asked) group by row, term
),
weighted as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
  from counts, totals group by term, docs
),
parts as (
  select row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))) as part
  from counts join weighted using (term), totals
),
scores as (
  select item_id, doc_id, sum(part)::bigint as score
  from asked join parts using (term) group by item_id, row, doc_id having sum(part) > 0
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
from scores
qualify row_number() over (partition by item_id order by score desc, doc_id nulls last) <= {ball_tree.BEST}
"""

SQL = {
    "op2_quality_rules": QUALITY,
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op3_prefix_decontamination": DECONTAMINATION,
    "op9_golden_mix": MIXING,
    "op10_line_spread": LINE_SPREAD,
    "op11_ball_tree_search": LEXICAL_SEARCH,
}
