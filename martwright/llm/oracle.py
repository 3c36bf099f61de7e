"""Reference SQL for the corpus queries that SQL can express."""

from martwright.llm.quality_rules import BOILERPLATE, SEPARATORS

ORACLE_SQL: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_PHRASES = " or ".join(f"contains(lower(l), {_quoted(p)})" for p in BOILERPLATE)
_LINKS = " + ".join(
    f"(length(l) - length(replace(l, {_quoted(p)}, ''))) / 3.0" for p in SEPARATORS
)
_TERMINAL = _quoted(r"""[.!?:;…"'”’»)\]][\x20\x09-\x0D]*\z""")
_FAILS = f"""(
    (length(l) < 80 and not regexp_matches(l, {_TERMINAL}))
    or (length(l) - length(replace(l, '!!', ''))) / 2.0 * 40 > length(l)
    or (length(l) - length(translate(l, '#*$%&|<>{{}}', ''))) * 10 > length(l)
    or (({_LINKS}) >= 3 and ({_LINKS}) * 40 > length(l))
    or {_PHRASES})"""

ORACLE_SQL["op1_quality_rules"] = rf"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
words as (
    select r, unnest(w) as word, generate_subscripts(w, 1) as pos
    from (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from texts)),
windows as (
    select r, pos, concat_ws(' ', word, b, c) as text
    from (select r, pos, word,
                 lead(word) over (partition by r order by pos) as b,
                 lead(word, 2) over (partition by r order by pos) as c from words)
    where c is not null),
twice as (
    select r, pos, lead(pos) over (partition by r order by pos) as next
    from (select r, pos, count(*) over (partition by r, text) as n from windows) where n > 1),
repeats as (select r, sum(least(3, coalesce(next - pos, 3))) as n from twice group by r),
lines as (
    select r, l, regexp_matches(l, '[^\x20\x09-\x0D]') as full_line
    from (select r, unnest(string_split(t, chr(10))) as l from texts)),
judged as (
    select r,
        count(l) filter (where full_line)
            - count(distinct l) filter (where full_line) as n_dup_lines,
        count(*) filter (where full_line and {_FAILS}) as lines_removed,
        coalesce(sum(length(l)) filter (where full_line and {_FAILS}), 0) as lost,
        sum(length(l)) as chars
    from lines group by r),
counted as (
    select doc_id,
        len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as n_words,
        length(translate(t, {_SPACES}, '')) as word_chars,
        length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
        n_dup_lines, coalesce(repeats.n, 0) as n_repeat_words, lines_removed, lost, chars
    from texts join judged using (r) left join repeats using (r))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
    n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
    n_repeat_words::bigint as n_repeat_words,
    (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
        and lost * 100 <= chars * 50 as kept,
    lines_removed::bigint as lines_removed
from counted"""

ORACLE_SQL["op6_warc"] = """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
        sha1(coalesce(html, '')) as payload_digest from pages),
last as (select payload_digest, max(page_id) as last_id from payloads group by payload_digest)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id is distinct from last_id
        and last_id is not null then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id is distinct from last_id then last_id end as refers_to
from payloads join last using (payload_digest)"""

_ESCAPE = r"""regexp_replace(replace({0}, chr(92), repeat(chr(92), 2)),
    '(<|\[)(/?s>|/?INST\]|</?SYS>>|/SYS>>)', '\1\\\2', 'g')"""

ORACLE_SQL["op8_chat_formatting"] = f"""
with turns as (
    select conv_id, turn, replace(coalesce(role, ''), chr(10), ' ') as role,
        coalesce(text, '') as text
    from (select conv_id, turn, role, text from conversations
          union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
          union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
told as (
    select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
        coalesce(string_agg(text, '' order by turn, role, text)
            filter (where role = 'assistant'), '') as loss,
        sum(8 + length({_ESCAPE.format("role")}) + length({_ESCAPE.format("text")})) as size
    from turns group by conv_id)
select conv_id, n_turns::bigint as n_turns, sha256(turns) as turns_sha256,
    length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
    size::bigint as formatted_chars
from told"""

ORACLE_SQL["op3_minhash_near_dedup"] = r"""
with recursive words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents),
shingles as (
    select distinct doc_id, s from (
        select doc_id, unnest(
            case when len(w) = 0 then []
                 when len(w) < 5 then [array_to_string(w, ' ')]
                 else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            end) as s
        from words)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
    select a, b from common
    join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * common.n >= 75 * (x.n + y.n - common.n)),
both_ways as (select a, b from links union all select b, a from links),
reached as (
    select a as doc_id, a as other from both_ways
    union
    select reached.doc_id, both_ways.b from reached join both_ways on reached.other = both_ways.a),
smallest as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, coalesce(sizes.n, 0)::bigint as n_shingles,
    coalesce(component_id, doc_id) as component_id,
    doc_id = coalesce(component_id, doc_id) as kept
from documents left join sizes using (doc_id) left join smallest using (doc_id)"""

ORACLE_SQL["op9_suffix_array_dedup"] = """
with texts as (select doc_id, encode(coalesce(text, '')) as b from documents),
starts as (select doc_id, b, unnest(range(1, octet_length(b) - 48)) as i from texts),
strings as (select doc_id, i, b[i:i + 49] as s from starts),
firsts as (select s, min(doc_id) as low from strings group by s),
hits as (select doc_id, i from strings join firsts using (s) where low < doc_id),
marked as (
    select doc_id, i,
        case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as fresh
    from hits),
numbered as (
    select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run from marked),
runs as (
    select doc_id, min(i) as a, max(i) + 49 as z from numbered group by doc_id, run),
gaps as (
    select doc_id, lag(z, 1, 0) over (partition by doc_id order by a) + 1 as a, a - 1 as z from runs
    union all
    select doc_id, max(z) + 1, 9000000000 from runs group by doc_id),
left_over as (
    select gaps.doc_id,
        unhex(string_agg(case when z >= a then hex(b[a:z]) else '' end, '' order by a)) as kept
    from gaps join texts using (doc_id) group by gaps.doc_id),
totals as (
    select doc_id, sum(z - a + 1) as n_removed, count(*) as n_spans from runs group by doc_id)
select doc_id, octet_length(b)::bigint as n_bytes,
    coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
    sha256(coalesce(kept, b)) as kept_sha256
from texts left join left_over using (doc_id) left join totals using (doc_id)"""

_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

ORACLE_SQL["op11_phrase_collocations"] = rf"""
with pieces as (
    select lang, regexp_extract_all(p, '[^\x20\x09]+') as w
    from (select coalesce(lang, 'und') as lang,
            unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) as p
          from documents)),
grams as (
    select lang, k as size, unnest(list_transform(
        range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
    from pieces, (values (1), (2), (3)) as sizes(k) where len(w) >= k),
counts as (select lang, size, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f) as n from counts where size = 1 group by lang),
candidates as (
    select lang, size, phrase, f as a, string_split(phrase, ' ') as w
    from counts where size > 1 and f >= 10),
cuts as (
    select c.lang, c.phrase, c.size, a, k, x.f as l, y.f as r,
        (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
scored as (
    select lang, phrase, any_value(size) as size, any_value(a) as a,
        arg_min(l, (score, k)) as l, arg_min(r, (score, k)) as r, min(score) as score
    from cuts group by lang, phrase),
inside as (
    select lang, array_to_string(w[i:i + 1], ' ') as phrase, max(a) as longer
    from candidates, (values (1), (2)) as places(i) where size = 3 group by all),
ranked as (
    select s.*, row_number() over (
        partition by s.lang order by score desc, a desc, s.phrase) as rank
    from scored s left join inside i on i.lang = s.lang and i.phrase = s.phrase and s.size = 2
    where i.longer is null or 100 * i.longer < 50 * a)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r,
    n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000"""

ORACLE_SQL["op12_spelling_variants"] = rf"""
with recursive polynomial as (
    select list(c order by i) as steps from (
        select i, list_reduce(range(8),
            lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
        from range(256) as bytes(i))),
found as (
    select doc_id, run, count(*) as times from (
        select doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as run
        from documents)
    group by all),
coded as (
    select run, times, list_reduce(
        flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
            lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195, unicode(c) - 64] end)),
        lambda crc, b: xor(crc >> 8, steps[(xor(crc, b) & 255) + 1]), 4294967295) as crc
    from found, polynomial where length(run) >= 6),
typed as (
    select times, case when xor(crc, 4294967295) % 199 = 0
        then left(run, (xor(crc, 4294967295) % length(run))::int)
            || substr(run, (xor(crc, 4294967295) % length(run))::int + 2)
        else run end as word
    from coded),
words as (
    select word, sum(times)::bigint as n from typed
    where length(word) >= 6 group by word having sum(times) >= 5),
shorter as (
    select word, n, i, left(word, i - 1) || substr(word, i + 1) as less
    from (select *, unnest(range(1, length(word) + 1))::int as i from words)),
pairs as (
    select a.word as word, b.word as other from shorter a
    join shorter b on a.less = b.less and a.i = b.i and a.word <> b.word
    union
    select s.word, w.word from shorter s join words w on s.less = w.word
    union
    select w.word, s.word from shorter s join words w on s.less = w.word),
near as (
    select p.word, count(*) as n_near, arg_min(p.other, (-o.n, p.other)) as best, max(o.n) as best_n
    from pairs p join words o on o.word = p.other group by p.word),
forms as (
    select w.word, w.n, coalesce(n_near, 0) as n_near,
        case when best_n >= 5 * w.n then best end as form,
        case when best_n >= 5 * w.n then best_n end as form_n
    from words w left join near using (word)),
chains as (
    select word, form as last, 1 as step from forms where form is not null
    union all
    select c.word, f.form, step + 1 from chains c join forms f on f.word = c.last where f.form is not null),
roots as (select word, arg_max(last, step) as root from chains group by word)
select word, form, coalesce(root, word) as root, n, n_near::bigint as n_near, form_n::bigint as form_n
from forms left join roots using (word)"""
