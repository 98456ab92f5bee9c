"""SQL twins of the text queries, where SQL expresses them.

The learned scores (3, 9), XXH64 of shingles (10, and with it the pipeline), merges by rank (12) and CRC-32 (13)
have no twin.
"""

from __future__ import annotations

import string

from zephyrine.llm import licenses, linerules, queries

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK_WORD = r"[^\x20\x09-\x0D]+"
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(text: str) -> str:
    return f"regexp_extract_all({_lower(f"coalesce({text}, '')")}, '{_WORD}')"


def _rows(rows) -> str:
    def value(v) -> str:
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(map(value, v)) + "]"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return "(values " + ", ".join("(" + ", ".join(map(value, r)) + ")" for r in rows) + ")"


_PHRASES = _rows([(p.split(" "), label) for p, label in licenses.PHRASES])
_TEMPLATES = _rows(
    [
        (n, label, words := licenses.template_words(t), licenses.needed_words(len(words), 0.9), licenses.stretch(t))
        for n, (label, t) in enumerate(licenses.TEMPLATES)
    ]
)

_HALF = licenses.block_length(licenses.TEMPLATES) // 2

LICENSES = f"""
with docs as (select row_number() over () as k, doc_id, text, {_words("text")} as w from documents),
places as (
  select k, unnest(list_filter(range(0, len(w) - len(p) + 1), lambda i: w[i + 1:i + len(p)] = p)) as spot, label
  from docs cross join {_PHRASES} as phrases(p, label) where len(w) >= len(p)
),
base as (
  select k, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list_distinct(list(label)) as l
  from places group by k
),
blocks as (
  select k, w[n * {_HALF} + 1:n * {_HALF} + 2 * {_HALF}] as b
  from (select k, w, unnest(range(0, greatest(ceil((len(w) - 2 * {_HALF}) / {_HALF}::double), 0)::bigint + 1)) as n from docs where len(w) > 0)
),
held as (
  select k, label, t, needed, span, b from blocks cross join {_TEMPLATES} as templates(number, label, t, needed, span)
  where len(list_intersect(list_distinct(b), t)) >= needed
),
stretches as (
  select k, label, t, needed, b[n:n + span - 1] as stretch
  from (select *, unnest(range(1, greatest(len(b) - span + 1, 1) + 1)) as n from held)
),
hits as (
  select k, label, len(list_intersect(list_distinct(stretch), t)) / len(t) as share
  from stretches where len(list_intersect(list_distinct(stretch), t)) >= needed
),
best as (select k, list_distinct(list(label)) as l, max(share) as share from hits group by k)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.l), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.l, best.l))), ','), '') as labels,
  case when n_base > 0 then 1.0 else coalesce(share, 0.0) end::double as score
from docs left join base using (k) left join best using (k)
"""

LINE_DEDUP = f"""
with docs as (select row_number() over () as k, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (
  select k, doc_id, spot, lines[spot] as line, {_lower(f"trim(lines[spot], {_STRIP})")} as key
  from (select k, doc_id, lines, unnest(range(1, len(lines) + 1)) as spot from docs)
),
repeated as (
  select key, max(doc_id) as keeper from (select distinct key, doc_id from lines where length(key) >= 20)
  group by key having count(*) >= 3
),
judged as (
  select k, spot, line, repeated.key is not null and doc_id is distinct from keeper as lose
  from lines left join repeated using (key)
)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (lose)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by spot) filter (not lose), '')) as kept_sha256
from judged join docs using (k) group by k
"""

DECONTAMINATION = f"""
with docs as (select row_number() over () as k, doc_id, {_words("text")} as w from documents),
items as (select item_id, w, least(len(w), 10) as size from (select item_id, {_words("text")} as w from benchmark) where len(w) > 0),
uses as (
  select item_id, size, spot, w[spot + 1:spot + size] as win, len(w) - size + 1 as n_windows
  from (select item_id, w, size, unnest(range(0, len(w) - size + 1)) as spot from items)
),
doc_windows as (
  select k, size, start, w[start + 1:start + size] as win
  from (select k, w, size, unnest(range(0, len(w) - size + 1)) as start
        from docs cross join (select distinct size from items) where len(w) >= size)
),
hits as (
  select k, start, uses.size, item_id, spot, n_windows
  from doc_windows join uses on doc_windows.size = uses.size and doc_windows.win = uses.win
),
covered as (
  select k, count(distinct pos) as n_hit
  from (select k, unnest(range(start, start + size)) as pos from (select distinct k, start, size from hits)) group by k
),
found as (
  select k, count(distinct item_id) as n_items,
    array_to_string(list_sort(list_distinct(list(item_id::varchar))), ',') as ids from hits group by k
),
aligned as (
  select k, max(share) as containment
  from (select k, count(distinct spot) / n_windows as share from hits group by k, item_id, start - spot, n_windows) group by k
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
  coalesce(containment, 0.0)::double as containment
from docs left join covered using (k) left join found using (k) left join aligned using (k)
"""

_R = linerules.Rules()


def _phrase_words(phrase: str) -> str:
    """Words of a line that belong to the phrase; four blanks between words, two around a phrase."""
    line = f"('  ' || array_to_string({_words('line')}, '    ') || '  ')"
    whole = f"  {phrase.replace(' ', '    ')}  "
    return f"(length({line}) - length(replace({line}, '{whole}', ''))) // {len(whole)} * {len(phrase.split(' '))}"


_FURNITURE = f"({' + '.join(map(_phrase_words, linerules.BOILERPLATE))})"
LINE_RULES = f"""
with docs as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{_BLANK_WORD}') as w
  from documents
),
windows as (
  select k, spot, w[spot:spot + 2] as win from (select k, w, unnest(range(1, len(w) - 1)) as spot from docs where len(w) >= 3)
),
again as (select k, win from windows group by k, win having count(*) > 1),
covered as (
  select k, count(distinct pos) as n_repeat
  from (select k, unnest(range(spot, spot + 3)) as pos from windows join again using (k, win)) group by k
),
lines as (
  select k, spot, line, w, len(w) as n, len(list_distinct(w)) as kinds,
    len(list_filter(w, lambda x: regexp_matches(x, '{linerules.NOISY}'))) as noisy,
    len(list_filter(w, lambda x: regexp_matches(x, '{linerules.FIGURE}'))) as figures,
    len(regexp_extract_all(line, '{linerules.PIECE_END}')) + 1 as pieces,
    regexp_matches({_lower("line")}, '{"|".join(linerules.BOILERPLATE)}')
      and {_FURNITURE} >= len({_words("line")}) * {_R.boilerplate_share} as furniture
  from (select k, spot, ls[spot] as line, regexp_extract_all(ls[spot], '{_BLANK_WORD}') as w
        from (select k, ls, unnest(range(1, len(ls) + 1)) as spot
              from (select k, string_split(text, chr(10)) as ls from docs)))
),
line_windows as (
  select k, spot, n, place, w[place:place + 2] as win
  from (select k, spot, n, w, unnest(range(1, n - 1)) as place from lines
        where n >= {_R.repeat_words} and kinds < n * {_R.distinct_share})
),
near as (
  select k, spot, n, place, least(place - lag(place) over same, lead(place) over same - place) as away
  from line_windows window same as (partition by k, spot, win order by place)
),
repeating as (
  select k, spot
  from (select k, spot, n, unnest(range(place, place + 3)) as pos from near where away <= {_R.repeat_reach})
  group by k, spot, n having count(distinct pos) > n * {_R.repeated_share}
),
judged as (
  select k, line, n, n > 0 and (
      noisy >= greatest(n * {_R.noisy_words}, 2)
      or (pieces >= {_R.bar_pieces} and n / pieces <= {_R.piece_words} and figures < n * {_R.figure_words})
      or (n <= {_R.boilerplate_words} and furniture)
      or repeating.k is not null) as fails
  from lines left join repeating using (k, spot)
),
sums as (
  select k, count(*) filter (n > 0) - count(distinct line) filter (n > 0) as n_dup,
    count(*) filter (fails) as n_failed, coalesce(sum(n) filter (fails), 0) as n_lost
  from judged group by k
),
counts as (
  select docs.k, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, n_dup, coalesce(n_repeat, 0) as n_repeat, n_failed, n_lost,
    len(w) < {_R.min_words} or 100 * coalesce(n_repeat, 0) > {_R.max_repeat_percent} * len(w) as base_failed
  from docs join sums using (k) left join covered using (k)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup::bigint as n_dup_lines, n_repeat::bigint as n_repeat_words, base_failed,
  not base_failed and n_lost <= n_words * {_R.max_loss} as kept,
  n_failed::bigint as n_failed_lines, n_lost::bigint as n_lost_words
from counts
"""

URL_FILTER = f"""
with parts as (
  select row_number() over () as k, page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
),
urls as (
  select k, page_id, {_lower("regexp_extract(rest, '^[^/?#]*')")} as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
),
fits as (
  select k, h || p as rule, v, row_number() over (partition by k order by length(h || p) desc, length(h) desc) as n
  from urls join {_rows(queries.URL_RULES)} as rules(h, p, v)
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
),
listed as (
  select distinct k from urls join {_rows([(h,) for h in queries.BLOCKED_HOSTS])} as hosts(h)
    on host = h or ends_with(host, '.' || h)
)
select page_id, host, path, rule, case when rule is not null then v when listed.k is not null then 'block' else 'allow' end as verdict
from urls left join (select * from fits where n = 1) as best using (k) left join listed using (k)
"""

WARC = """
with rows as (select page_id, encode(coalesce(html, '')) as body, sha1(encode(coalesce(html, ''))) as h from pages),
firsts as (select h, min(page_id) as first_id from rows group by h),
letters as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as a)
select page_id, octet_length(body)::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr(a, ((
    (('0x' || substr(h, (i // 4) * 5 + 1, 5))::bigint) >> (15 - 5 * (i % 4))::bigint) & 31)::int + 1, 1)), '') as payload_digest,
  case when first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
  case when first_id is not null and page_id is distinct from first_id then first_id end as refers_to,
  true as intact
from rows join firsts using (h) cross join letters
"""

#: The exponent is bisected by recursion: the least flattening that reaches the entropy, then as
#: much of it as the repetition limit allows.
MIXING = f"""
with recursive docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_BLANK_WORD}'))::bigint as n from documents
),
sums as (select source, sum(n)::bigint as t from docs group by source having sum(n) > 0),
total as (select sum(t)::bigint as budget, count(*) as sources from sums),
shares as (select source, t, t / budget as s from sums cross join total),
spread(step, low, high, fits) as (
  select 0, 0.0::double, 1.0::double, (select -sum(s * ln(s)) >= 0.98 * ln(greatest(any_value(sources), 2)) from shares cross join total)
  union all
  select step + 1,
    case when ok then (low + high) / 2 else low end, case when ok then high else (low + high) / 2 end, fits
  from (
    select step, low, high, fits, (
      select -sum(w * ln(w)) >= 0.98 * ln(greatest(any_value(sources), 2))
      from (select pow(s, (low + high) / 2) / sum(pow(s, (low + high) / 2)) over () as w from shares) cross join total
    ) as ok
    from spread where step < 60 and not fits
  )
),
first_exponent as (select case when fits then 1.0 else low end as x from spread order by step desc limit 1),
limited(step, low, high, fits) as (
  select 0, x, 1.0::double, (select max(pow(s, x) / s) / sum(pow(s, x)) <= 4.0 from shares) from first_exponent
  union all
  select step + 1,
    case when ok then low else (low + high) / 2 end, case when ok then (low + high) / 2 else high end, fits
  from (
    select step, low, high, fits,
      (select max(pow(s, (low + high) / 2) / s) / sum(pow(s, (low + high) / 2)) <= 4.0 from shares) as ok
    from limited where step < 60 and not fits
  )
),
exponent as (select round(case when fits then low else high end, 9) as x from limited order by step desc limit 1),
weights as (select source, t, round(pow(s, x) / sum(pow(s, x)) over (), 9) as weight from shares cross join exponent),
quotas as (select source, t, weight, floor(weight * budget)::bigint as quota, budget from weights cross join total),
known as (
  select doc_id, docs.source, n, coalesce(t, 0) as t, coalesce(weight, 0.0) as weight, coalesce(quota, 0) as quota,
    case when t > 0 then quota // t else 1 end as whole
  from docs left join quotas on docs.source is not distinct from quotas.source
),
copies as (
  select *, substr(md5(concat_ws(':', '17', epoch::varchar, doc_id::varchar)), 1, 13) as place
  from (select *, unnest(range(0, whole + 1)) as epoch from known)
),
placed as (
  select *, coalesce(sum(n) over (partition by source, epoch order by place, doc_id
    rows between unbounded preceding and 1 preceding), 0) as before
  from copies
)
select doc_id, source, n as n_tokens, weight, epoch::bigint as epoch, place,
  least(floor(case when t > 0 then (epoch + ('0x' || place)::bigint / pow(16.0, 13)) / greatest(quota / t, 1e-9)
    else ('0x' || place)::bigint / pow(16.0, 13) end * blocks), blocks - 1)::bigint as block
from placed cross join (select greatest(ceil(budget / 131072.0), 1)::bigint as blocks from total)
where epoch < whole or (quota > whole * t and before < quota - whole * t)
"""

SEARCH = f"""
with docs as (select row_number() over () as k, doc_id, {_words("text")} as w from documents),
sizes as (select count(*) as n_docs, sum(len(w)) as n_terms from docs where len(w) > 0),
items as (select row_number() over () as q, item_id, list_distinct({_words("text")}) as terms from benchmark),
asked as (select q, item_id, unnest(terms) as term from items),
tfs as (
  select k, doc_id, len(w) as n, term, count(*) as tf
  from (select k, doc_id, w, unnest(w) as term from docs) where term in (select term from asked)
  group by k, doc_id, len(w), term
),
weights as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as w
  from tfs cross join sizes group by term
),
scores as (
  select q, item_id, k, doc_id,
    sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::bigint as score
  from asked join tfs using (term) join weights using (term) cross join sizes group by q, item_id, k, doc_id
)
select item_id, row_number() over (partition by q order by score desc, doc_id nulls first)::int as rank, doc_id, score
from scores where score > 0
qualify rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_license_scan": LICENSES,
    "op2_line_dedup": LINE_DEDUP,
    "op4_decontamination": DECONTAMINATION,
    "op5_line_rules": LINE_RULES,
    "op6_url_filter": URL_FILTER,
    "op7_temperature_mix": MIXING,
    "op8_warc": WARC,
    "op11_lexical_search": SEARCH,
}
