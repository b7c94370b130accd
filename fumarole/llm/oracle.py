"""DuckDB SQL for the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
A_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {}

ORACLE["op1_ngram_jaccard_join"] = rf"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{A_Z}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from worded
), items as (select doc_id, len(s) as n, unnest(s) as x from sets
), links as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach as (
  select doc_id as a, doc_id as b from documents
  union select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.b) as component_id
from sets s join reach r on r.a = s.doc_id group by all
"""

ORACLE["op3_substring_dedup"] = rf"""
with worded as (select doc_id, {WORDS} as w from documents
), starts as (select doc_id, w, unnest(range(1, len(w) - 18)) as p from worded
), windows as (select doc_id, p, array_to_string(w[p:p + 19], ' ') as x from starts
), later as (
  select doc_id, p from (select doc_id, p, row_number() over (partition by x order by doc_id, p) as k from windows) where k > 1
), gone as (select distinct doc_id, p + unnest(range(0, 20)) as p from later
), counted as (select doc_id, list(p) as gone from gone group by doc_id
), each as (
  select d.doc_id, w, unnest(range(1, len(w) + 1)) as p from worded d
), kept as (
  select e.doc_id, string_agg(e.w[e.p], ' ' order by e.p) as t from each e anti join gone g on g.doc_id = e.doc_id and g.p = e.p group by e.doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(len(c.gone), 0) as bigint) as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from worded d left join counted c using (doc_id) left join kept k using (doc_id)
"""

ORACLE["op6_mixing_sources"] = rf"""
with sized as (
  select doc_id, coalesce('0' || source, '1') as key, cast(len({WORDS}) as bigint) as size,
    cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 9) as bigint) as place
  from documents
), sources as (select key, cast(sum(size) as bigint) as source_size from sized group by key
), ranked as (
  select key, source_size, [5.0::double, 2.0, 1.0][(row_number() over (order by key) - 1) % 3 + 1] as weight, 3 * cast(source_size as double) as most from sources
), rising as (
  select *, (sum(source_size) over ()) - coalesce(sum(most) over (order by most / weight, key rows between unbounded preceding and 1 preceding), 0) as lft,
    sum(weight) over (order by most / weight, key rows between current row and unbounded following) as weights_left from ranked
), goals as (
  select key, source_size, least(most, weight * max(case when most / weight >= lft / weights_left then lft / weights_left end) over ()) as target from rising
), budgets as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from goals
), cells as (select key, place, sum(size) as size from sized group by key, place
), upto as (
  select c.key, place, size, sum(size) over (partition by c.key order by place) as upto, target - whole * source_size as budget
  from cells c join budgets b on b.key = c.key
), ends as (
  select key, coalesce(max(case when upto <= budget then upto end), 0) as spent, min(budget) as budget,
    min(case when upto > budget then struct_pack(place := place, size := size) end) as edge
  from upto group by key
), plan as (
  select b.*, case when edge is null then 1::bigint << 40
    else edge.place + (case when edge.size - (budget - spent) < budget - spent then 1 else 0 end) end as threshold
  from budgets b join ends e on e.key = b.key
)
select doc_id, size, source_size, round(target, 6) as target, cast(size * (whole + (case when place < threshold then 1 else 0 end)) as bigint) as taken
from sized s join plan p on p.key = s.key
"""

ORACLE["op8_line_dedup"] = rf"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents
), each as (select doc_id, unnest(range(1, len(l) + 1)) as p, l from split
), keyed as (select doc_id, p, l[p] as line, translate(trim(l[p], {BLANKS}), '{A_Z}', '{LOWER}') as key from each
), judged as (
  select doc_id, p, line, length(key) >= 10 and min(doc_id) over (partition by key) < doc_id as gone from keyed
)
select doc_id, count(*) as n_lines, cast(sum(cast(gone as int)) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by p) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

ORACLE["op9_quality_rules"] = rf"""
with worded as (select doc_id, coalesce(text, '') as t, {WORDS} as w from documents
), starts as (select doc_id, w, unnest(range(1, len(w) - 3)) as p from worded
), windows as (select doc_id, p, count(*) over (partition by doc_id, array_to_string(w[p:p + 4], ' ')) as n from starts
), repeated as (select doc_id, count(distinct q) as n from (select doc_id, p + unnest(range(0, 5)) as q from windows where n > 1) group by doc_id
), lined as (
  select doc_id, list_filter(string_split(t, chr(10)), lambda x: trim(x, {BLANKS}) <> '') as l from worded
), measured as (
  select d.doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(l) as bigint) as n_lines,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
    len(regexp_extract_all(t, '\p{{L}}')) as letters, len(regexp_extract_all(t, '\p{{Lu}}')) as capitals, len(regexp_extract_all(t, '[!?]{{2}}')) as shouts
  from worded d join lined using (doc_id) left join repeated r using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 10 * n_symbols > n_words or (n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines)
    or word_chars < 2 * n_words or word_chars > 20 * n_words or 10 * capitals > 4 * letters or 10 * shouts > n_words or 2 * letters < word_chars) as kept
from measured
"""

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(\||/s>|/?INST\])', '\1\2\\\3', 'g')"

ORACLE["op10_chat_formatting"] = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, i, case when i = 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) r(i)
), marked as (
  select *, role is distinct from lag(role) over o as starts, role is distinct from lead(role) over o as ends,
    row_number() over o as k, replace(replace({_ESCAPED.format("role")}, '\', '\\'), chr(10), '\n') as head
  from turns window o as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length({_ESCAPED.format("text")}) + (case when starts then 12 + length(head) + 1 else 10 end) + (case when ends then 11 else 0 end)) as bigint) as formatted_chars
from marked group by conv_id
"""

ORACLE["op13_minhash_near_dedup"] = rf"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{A_Z}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) end as s
  from worded
), items as (select doc_id, len(s) as n, unnest(s) as x from sets
), links as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
  select doc_id as a, doc_id as b from documents
  union select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.b) as component_id, s.doc_id = min(r.b) as kept
from sets s join reach r on r.a = s.doc_id group by s.doc_id, s.s
"""

ORACLE["op11_fill_in_middle"] = r"""
with drawn as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || cast(doc_id as varchar)) as h from documents
), numbers as (
  select doc_id, t, u, len(u) as n, list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(h, i, 8) as bigint)) as h from drawn
), cut as (
  select doc_id, t, u, n, h, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b from numbers
), parts as (
  select doc_id, t, n, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 90 then 'plain'
      when h[4] % 100 < 20 then 'spm' else 'psm' end as form,
    array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:n], '') as s
  from cut
)
select doc_id, cast(n as bigint) as n, form, cast(case when form <> 'plain' then length(p) end as bigint) as prefix_chars,
  cast(case when form <> 'plain' then length(m) end as bigint) as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""

_FIELD = "coalesce(octet_length(encode({0})) || ':' || {0}, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)")) + " || " + _FIELD


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit: a byte comes in, and -1 stands for each of its eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda d: [cast(ascii(d) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))"
    shifted = "xor(c >> 1, 3988292384 * (c & 1))"
    return f"xor(list_reduce([4294967295::bigint] || {steps}, lambda c, x: case when x >= 0 then xor(c, x) else {shifted} end), 4294967295)"


ORACLE["op12_merkle_manifest"] = rf"""
with recursive leaves as (
  select doc_id, source, sha256({_LEAF.format("text")}) as leaf,
    sha256({_LEAF.format(f"(case when {_crc32('cast(doc_id as varchar)')} % 5 = 0 then translate(text, '{A_Z}', '{LOWER}') else text end)")}) as held,
    row_number() over (partition by source order by doc_id) - 1 as place, count(*) over (partition by source) as n
  from documents
), nodes as (
  select 0 as level, source, place, n, leaf as h from leaves
  union all
  select level + 1, source, place // 16, (n + 15) // 16, sha256(string_agg(h, '' order by place)) from nodes where n > 1 group by level, source, place // 16, n
), subroots as (
  select source, h, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n from nodes where n = 1
), tops as (
  select 0 as level, place, n, h from subroots
  union all
  select level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' order by place)) from tops where n > 1 group by level, place // 16, n
), siblings as (
  select a.level, a.source, a.place, coalesce(string_agg(b.h, '' order by b.place) filter (b.place < a.place), '') as l,
    coalesce(string_agg(b.h, '' order by b.place) filter (b.place > a.place), '') as r
  from nodes a join nodes b on a.level = b.level and a.source is not distinct from b.source and a.place // 16 = b.place // 16 where a.n > 1 group by all
), top_siblings as (
  select a.level, a.place, coalesce(string_agg(b.h, '' order by b.place) filter (b.place < a.place), '') as l,
    coalesce(string_agg(b.h, '' order by b.place) filter (b.place > a.place), '') as r
  from tops a join tops b on a.level = b.level and a.place // 16 = b.place // 16 where a.n > 1 group by all
), steps as (
  select d.doc_id, s.level, s.l, s.r from leaves d join siblings s on d.source is not distinct from s.source and s.place = d.place // cast(power(16, s.level) as bigint)
  union all
  select d.doc_id, 100 + t.level, t.l, t.r from leaves d join subroots s on d.source is not distinct from s.source
    join top_siblings t on t.place = s.place // cast(power(16, t.level) as bigint)
), paths as (
  select doc_id, list(struct_pack(l := l, r := r) order by level) as path, sha256(string_agg(l || r, '' order by level)) as proof from steps group by doc_id
), folds as (
  select doc_id, held as h, 1 as k from leaves
  union all
  select f.doc_id, sha256(path[k].l || h || path[k].r), k + 1 from folds f join paths p on f.doc_id = p.doc_id where k <= len(path)
)
select d.doc_id, d.leaf, s.h as subroot, t.h as root, coalesce(p.proof, sha256('')) as proof_sha256, f.h as folded_root, f.h = t.h as verified
from leaves d join subroots s on d.source is not distinct from s.source join tops t on t.n = 1 left join paths p on p.doc_id = d.doc_id
join folds f on f.doc_id = d.doc_id and f.k = coalesce(len(p.path), 0) + 1
"""
