"""DuckDB SQL for the queries that SQL can express, over the whole tables."""

from __future__ import annotations

from tablesync.llm import mixing as mix
from tablesync.llm import quality_rules as rules

_SPACE = r"[\x20\x09-\x0D]"


def _distance(counts: str, shares: str) -> str:
    """Jensen-Shannon distance of tables (doc_id, lang, bin, n) and (lang, bin, q)."""
    return f"""
select c.doc_id, sqrt(greatest(sum(
    case when c.n > 0 then c.n / t.n * log2(c.n / t.n / ((c.n / t.n + s.q) / 2)) else 0 end
    + case when s.q > 0 then s.q * log2(s.q / ((c.n / t.n + s.q) / 2)) else 0 end) / 2, 0)) as d
from {counts} c join (select doc_id, sum(n)::double as n from {counts} group by 1) t using (doc_id)
join {shares} s on s.lang = c.lang and s.bin = c.bin group by 1"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality_rules(docs: str = "documents", limits: rules.Rules = rules.Rules(), final: str | None = None) -> str:
    """The verdicts; or, with ``final``, a select over ``verdicts``."""
    listed = ", ".join(f"({_quoted(k)}, {_quoted(w)})" for k, words in rules.COMMON_WORDS.items() for w in words)
    languages = ", ".join(_quoted(k) for k in rules.COMMON_WORDS)
    gone = lambda pattern: f"length(text) - length(regexp_replace(text, '{pattern}', '', 'g'))"
    return f"""
with docs as (select doc_id, coalesce(text, '') as text,
    case when lower(lang) in ({languages}) then lower(lang) else '{rules.OTHER}' end as lang from {docs}),
listed(lang, word) as (values {listed}),
words as (select doc_id, lang, word, row_number() over (partition by doc_id order by i) as i from (
    select doc_id, lang, unnest(l) as word, generate_subscripts(l, 1) as i
    from (select doc_id, lang, regexp_split_to_array(text, '{_SPACE}+') as l from docs)) where word <> ''),
triples as (select *, count(*) over (partition by doc_id, a, b, c) as times from (
    select doc_id, i, word as a, lead(word) over w as b, lead(word, 2) over w as c
    from words window w as (partition by doc_id order by i)) where c is not null),
repeats as (select doc_id, count(distinct p) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as p from triples where times > 1) group by 1),
lines as (select doc_id, count(*) - count(distinct line) as n from (
    select doc_id, unnest(string_split(text, chr(10))) as line from docs)
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by 1),
counts as (select doc_id, lang, length(regexp_replace(text, '{_SPACE}', '', 'g')) as word_chars, {gone('[#*$%&|<>]')} as symbol, {gone('[A-Z]')} as upper,
    strlen(text) - length(text) as wide, length(regexp_replace(text, '[a-z\\x20\\x09-\\x0D]', '', 'g')) as special
    from docs),
classes as (select doc_id, lang, unnest([upper, symbol, wide, special - upper - symbol, word_chars - special])::double as n,
    unnest([1, 2, 3, 4, 5]) as bin from counts),
class_shares as (select lang, bin, sum(n) / sum(sum(n)) over (partition by lang) as q from classes group by lang, bin),
class_distance as ({_distance('classes', 'class_shares')}),
found as (select w.doc_id, w.lang, coalesce(l.word, '') as bin, count(*) as n
    from words w left join listed l using (lang, word) group by all),
common as (select d.doc_id, d.lang, l.word as bin, coalesce(f.n, 0)::double as n from docs d
    join (from listed union all select distinct lang, '' from listed) l using (lang)
    left join found f on f.doc_id = d.doc_id and f.bin = l.word),
word_shares as (select lang, bin, sum(n) / sum(sum(n)) over (partition by lang) as q from common group by lang, bin),
word_distance as ({_distance('common', 'word_shares')}),
base as (select doc_id, (select count(*) from words w where w.doc_id = d.doc_id) as n_words, word_chars, symbol as n_symbols,
    coalesce(l.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
    from counts d left join lines l using (doc_id) left join repeats r using (doc_id)),
verdicts as (select b.*, n_words < {limits.min_words} or 100 * n_repeat_words > {limits.max_repeat_percent} * n_words as base_failed,
    not base_failed and (word_chars < {limits.class_guard} or c.d is null or c.d <= {limits.max_class_distance})
    and (n_words < {limits.word_guard} or w.d is null or w.d <= {limits.max_word_distance}) as kept
    from base b left join class_distance c using (doc_id) left join word_distance w using (doc_id))
{final or 'select * from verdicts'}"""


def mixing(docs: str = "documents", mixture: mix.Mixture = mix.PRODUCTION, columns: str = "d.doc_id, {names}, d.tokens") -> str:
    """A row per document and epoch; ``columns`` of the document d, and ``epoch``."""
    names = [level.name for level in mixture.levels]
    keys = [f"coalesce(cast({level.sql} as varchar), '') as {level.name}" for level in mixture.levels]
    allowed = " and ".join(f"({level.weight_sql()}) > 0" for level in mixture.levels)
    wanted = "sum(tokens)" if mixture.total_tokens is None else str(mixture.total_tokens)
    parts = [f"""docs as (select *, {', '.join(keys)} from {docs}),
rows_ as (select *, len([w for w in regexp_split_to_array(coalesce(text, ''), '{_SPACE}+') if w <> '']) as tokens from docs),
leaves as (select {', '.join(names)}, sum(tokens)::hugeint as tokens from rows_ group by all),
caps as (select *, case when {allowed} then tokens * {mixture.max_epochs} else 0 end as cap from leaves),
b0 as (select least(coalesce({wanted}, 0), coalesce(sum(cap), 0))::hugeint as above, 0 as top from caps)"""]
    for depth, level in enumerate(mixture.levels):
        path, parent = ", ".join(names[: depth + 1]), ", ".join(names[:depth]) or "top"
        parts.append(f"""n{depth} as (select *, case when weight > 0 then cap::double / weight else 0 end as ratio from (
    select {path}, 0 as top, sum(cap)::hugeint as cap, ({level.weight_sql()})::hugeint as weight from caps group by {path})
    join b{depth} using ({', '.join([*names[:depth], 'top'])})),
f{depth} as (select *, cap * sum(weight) over (partition by {parent} order by ratio, {level.name} rows between current row and unbounded following)
    <= weight * (above - coalesce(sum(cap) over (partition by {parent} order by ratio, {level.name} rows between unbounded preceding and 1 preceding), 0)) as filled from n{depth}),
b{depth + 1} as (select {path}, 0 as top, case when filled then cap else weight * (above - coalesce(sum(case when filled then cap end) over (partition by {parent}), 0))
    // sum(case when not filled then weight end) over (partition by {parent}) end as above from f{depth})""")
    last, path = len(names), ", ".join(names)
    place = f"md5(concat('{mixture.seed}', ':', e, ':', coalesce(cast(doc_id as varchar), '')))"
    parts.append(f"""plan as (select l.*, above as budget, case when tokens > 0 then above // tokens else 0 end as epochs from leaves l join b{last} using ({path})),
placed as (select r.*, p.budget, p.epochs, p.budget - p.epochs * p.leaf_tokens as left_over, p.epochs + 1 as e
    from rows_ r join (select {path}, tokens as leaf_tokens, budget, epochs from plan where budget > 0) p using ({path})),
d as (select *, epochs + case when left_over > 0 and upto <= left_over then 1 else 0 end as copies
    from (select *, sum(tokens) over (partition by {path} order by {place} range between unbounded preceding and current row) as upto from placed))""")
    chosen = columns.format(names=", ".join(f"d.{n}" for n in names))
    return "with " + ",\n".join(parts) + f"\nselect {chosen}, unnest(range(1, copies::bigint + 1))::int as epoch from d where copies > 0"


WARC = """
with records as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from records)
select page_id, payload_bytes, payload_digest,
    case when first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
    case when page_id is distinct from first then first end as refers_to from firsts"""


def _shingle_sets(docs: str, width: int) -> str:
    """CTEs up to ``sets`` (doc_id, shingle, distinct) and ``sizes``."""
    return f"""words as (select doc_id, [w for w in regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+') if w <> ''] as w from {docs}),
sets as (select distinct doc_id, array_to_string(w[i : i + {width - 1}], ' ') as shingle
    from (select doc_id, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from sets group by 1)"""


def jaccard(docs: str = "documents", width: int = 4, least: int = 85, of: int = 100) -> str:
    return f"""
with recursive {_shingle_sets(docs, width)},
links as (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as both_
        from sets x join sets y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by 1, 2) p
    join sizes s on s.doc_id = a join sizes t on t.doc_id = b where {of} * both_ >= {least} * (s.n + t.n - both_)),
reach as (select doc_id as a, doc_id as b from sizes union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(r.component_id, d.doc_id) as component_id
from {docs} d left join sizes s using (doc_id)
left join (select a as doc_id, min(b) as component_id from reach group by 1) r using (doc_id)"""


_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, flatten([[(ord(c) >> b) & 1 for b in range(8)] for c in string_split({text}, '')])),
    lambda a, b: xor(a >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295)"""


def prefix_trie(conversations: str = "conversations") -> str:
    return f"""
with src as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from {conversations} where conv_id is not null)),
ids as (select conv_id, conv_id - conv_id % 5 as donor, {_CRC.format(text="cast(conv_id as varchar)")} % 9 as h from (select distinct conv_id from src)),
rebuilt as (select i.conv_id, s.pos, s.role, s.text from ids i join src s on s.conv_id = i.donor and s.pos <= i.h
    union all select i.conv_id, s.pos, s.role, s.text from ids i join src s on s.conv_id = i.conv_id and s.pos > i.h),
steps as (select conv_id, row_number() over w as depth, list(row(role, text)) over w as path, strlen(text) as bytes
    from rebuilt window w as (partition by conv_id order by pos rows between unbounded preceding and current row)),
nodes as (select depth, path, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes from steps group by depth, path
    union all select 0, [row('', '')][1:0], min(conv_id), count(*), 0 from ids having count(*) > 0),
kids as (select path[1:depth - 1] as path, count(*) as n from nodes where depth > 0 group by 1),
facts as (select a.*, coalesce(k.n, 0) as n_children, (n_convs - 1) * bytes as saved from nodes a left join kids k using (path)),
sums as (select path[1:d] as path, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
    from (select *, unnest(range(0, depth + 1)) as d from facts) group by 1),
lasts as (select i.conv_id, coalesce(l.path, [row('', '')][1:0]) as path from ids i left join (
    select conv_id, arg_max(path, depth) as path from steps group by 1) l using (conv_id)),
ends as (select path, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256 from lasts group by 1)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens::bigint as saved_tokens,
    coalesce(e.ends_sha256, sha256('')) as ends_sha256
from facts f join sums s using (path) left join ends e using (path) left join nodes p on f.depth > 0 and p.path = f.path[1:f.depth - 1]"""
