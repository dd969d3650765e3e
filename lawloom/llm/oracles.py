"""DuckDB SQL for the rows of the queries that SQL can express."""

_DOMAIN = (
    "case when regexp_matches(source, '^src[0-9]{1,9}$') then case when try_cast(source[4:] as int) < 5 then 'web' "
    "when try_cast(source[4:] as int) < 10 then 'books' when try_cast(source[4:] as int) < 15 then 'code' else 'forum' end else 'forum' end"
)


def _share(level: str, parent: str, source: str, names: list[str]) -> str:
    """Budgets of one level: children filled in the order of capacity per weight, the rest by weight."""
    part = f"partition by {', '.join(names[:-1])}" if names[:-1] else "partition by 1"
    keys = ", ".join(names)
    order = f"{part} order by capacity / weight, {names[-1]}"
    return f"""
{level}_nodes as (
  select {', '.join('l.' + n for n in names)}, sum(l.capacity)::bigint capacity, first(l.{names[-1]}_weight) weight, first({parent}) parent_budget
  from leaves l {source} where l.capacity > 0 group by {', '.join('l.' + n for n in names)}),
{level}_order as (
  select *, coalesce(sum(capacity) over ({order} rows between unbounded preceding and 1 preceding), 0) filled,
    sum(weight) over ({order} rows between current row and unbounded following) open from {level}_nodes),
{level}_full as (select *, filled * weight + capacity * open <= parent_budget * weight is_full from {level}_order),
{level}_budget as (
  select {keys}, case when is_full then capacity else ((parent_budget - coalesce(sum(capacity) filter (is_full) over ({part}), 0)) * weight)
    // coalesce(sum(weight) filter (not is_full) over ({part}), 1) end::bigint budget from {level}_full),"""


OP1 = f"""
with words as (
  select doc_id, {_DOMAIN} domain, coalesce(lang, '') lang, coalesce(source, '') source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens from documents),
counted as (select * from words where n_tokens > 0),
leaves as (
  select *, tokens * 2 capacity, least(floor((sum(tokens) over ()) * 0.625::double), sum(tokens * 2) over ())::bigint total from (
    select domain, lang, source, sum(n_tokens)::bigint tokens,
      case domain when 'web' then 5 when 'books' then 3 when 'code' then 2 else 1 end domain_weight,
      case lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end lang_weight, 1 source_weight
    from counted group by all)),
{_share('d', 'l.total', '', ['domain'])}
{_share('l', 'b.budget', 'join d_budget b using (domain)', ['domain', 'lang'])}
{_share('s', 'b.budget', 'join l_budget b using (domain, lang)', ['domain', 'lang', 'source'])}
given as (select l.domain, l.lang, l.source, b.budget, b.budget // l.tokens whole, b.budget % l.tokens part
  from leaves l join s_budget b using (domain, lang, source) where b.budget > 0),
rows as (select c.*, g.* exclude (domain, lang, source) from counted c join given g using (domain, lang, source)),
placed as (select *, sum(n_tokens) over (partition by domain, lang, source
    order by md5(concat('17:', whole, ':', coalesce(doc_id::varchar, '')))[1:15], doc_id) - n_tokens before from rows where part > 0)
select doc_id, unnest(range(whole)) epoch, domain, lang, source, n_tokens, n_tokens take_tokens, budget leaf_budget from rows where whole > 0
union all
select doc_id, whole, domain, lang, source, n_tokens, least(n_tokens, part - before)::bigint, budget from placed where before < part
"""

OP2 = r"""
with crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
ids as (
  select doc_id, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10 = 0 held_out from documents, crc_table),
docs as (
  select doc_id, held_out, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), ' ') w from ids),
tokens as (select doc_id, held_out, unnest(w) v, unnest(list_prepend('  ', w[:-2])) u from docs),
c1 as (select v, count(*) c from tokens where not held_out group by v),
ch as (select * from c1 union all select '  ', count(*) from docs where not held_out),
c2 as (select u, v, count(*) c from tokens where not held_out group by u, v),
total as (select sum(c)::bigint n, count(*) types from c1),
scored as (
  select t.doc_id, t.held_out, c1.c is not null known, (coalesce(c1.c, 0) + 0.1::double) / (n + 0.1::double * (types + 1)) p1, coalesce(ch.c, 0) h, coalesce(c2.c, 0) c
  from tokens t cross join total left join c1 on t.v = c1.v left join ch on t.u = ch.v left join c2 on t.u = c2.u and t.v = c2.v)
select doc_id, held_out, count(*) n_tokens, count(*) filter (known) n_known, (select n from total) train_tokens,
  round(sum(log10(p1)), 6) base_score, round(sum(log10((c + 4 * p1) / (h + 4))), 6) score
from scored group by doc_id, held_out
"""

OP5 = """
with parts as (
  select page_id, url, case when contains(url, '://') then url[strpos(url, '://') + 3:] else '' end rest from pages),
cut as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path, regexp_extract(rest, '^[^?#]*([^#]*)', 1) query from parts),
rules(rule_host, rule_path, rule_verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) rule, arg_max(rule_verdict, length(rule_host || rule_path)) said
  from cut join rules on ends_with('.' || host, '.' || rule_host) and starts_with(path, rule_path) group by page_id),
globs(n, "glob", pattern) as (values (1, '*casino*', '%casino%'), (2, '*free-bets*', '%free-bets%'), (3, '*cheap-pills*', '%cheap-pills%'),
  (4, '*.ads-*', '%.ads-%'), (5, '*/ads/*', '%/ads/%'), (6, '*?popup=*', '%_popup=%')),
hits as (select page_id, arg_min("glob", n) "glob" from cut join globs on '.' || host || path || query like pattern group by page_id)
select c.page_id, c.host, c.path, f.rule, coalesce(f.said, case when h."glob" is null then 'allow' else 'block' end) verdict, h."glob"
from cut c left join fits f using (page_id) left join hits h using (page_id)
"""

_ESC = r"replace(replace(replace({}, '\', '\e'), '#', '\h'), '<', '\l')"

OP6 = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
pieces as (
  select *, length('### ' || replace({_ESC.format('role')}, ':', '\c') || ': ' || {_ESC.format('text')} || '</turn>' || chr(10)) n from turns)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  length(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256,
  sum(n)::bigint formatted_chars,
  case when list(role order by turn, role, text) = ['user', 'assistant'] then 'prompt'
    when list(role order by turn, role, text) = ['system', 'user', 'assistant'] then 'instruction'
    when list(role order by turn, role, text)[1] = 'system' and not list_has_any(list(role), ['human', 'gpt']) then 'conversations'
    else 'messages' end layout
from pieces group by conv_id
"""

OP8 = """
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size, doc_id = max(doc_id) over same kept,
  sha256(coalesce(text, '')) text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
with items as (select item_id::varchar item_id, {_WORDS} w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) size, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') words
  from (select *, unnest(range(len(w) - least(len(w), 10) + 1)) i from items where len(w) > 0)),
sizes as (select distinct size from windows),
docs as (select doc_id, {_WORDS} w from documents),
runs as (
  select doc_id, size, unnest(range(len(w) - size + 1)) i, w from docs, sizes where len(w) >= size),
found as (
  select r.doc_id, r.i, r.size, v.item_id from (select doc_id, size, i, array_to_string(w[i + 1:i + size], ' ') words from runs) r
  join windows v on r.words = v.words and r.size = v.size),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + size)) p from found) group by doc_id),
named as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids from (select distinct doc_id, item_id from found) group by doc_id)
select d.doc_id, len(d.w)::bigint n_words, coalesce(h.n_hit, 0)::bigint n_hit, coalesce(n.n_items, 0)::bigint n_items,
  sha256(coalesce(n.ids, '')) items_sha256, coalesce(h.n_hit, 0) > 0 contaminated
from docs d left join hit h using (doc_id) left join named n using (doc_id)
"""

_CRC_TABLE = "(select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t)"


def _crc32(data: str) -> str:
    """crc32 of a text's UTF-8 bytes; the query joins _CRC_TABLE for t."""
    octets = f"list_transform(range(octet_length(encode({data}))), lambda i: ('0x' || hex(encode({data}))[2 * i + 1:2 * i + 2])::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


OP11 = f"""
with crc_table as {_CRC_TABLE},
docs as (select doc_id, {_WORDS} w from documents),
items as (select {_WORDS} w from benchmark),
vocabulary as (select distinct unnest(w) word from (select w from docs union all select w from items)),
hashed as (select word, {_crc32('word')} % 10000 bucket from vocabulary, crc_table),
source as (select bucket, count(*) n from (select unnest(w) word from docs) join hashed using (word) group by bucket),
target as (select bucket, count(*) n from (select unnest(w) word from items) join hashed using (word) group by bucket),
sums as (select (select coalesce(sum(n), 0) from source)::double s, (select coalesce(sum(n), 0) from target)::double t),
gains as (
  select h.word, floor(1000 * ln((coalesce(b.n, 0) + 1)::double * (sums.s + 10000) / ((coalesce(a.n, 0) + 1)::double * (sums.t + 10000))))::bigint gain
  from hashed h left join source a using (bucket) left join target b using (bucket) cross join sums),
summed as (select doc_id, floor(sum(gain)::double / count(*))::bigint weight from (select doc_id, unnest(w) word from docs) join gains using (word) group by doc_id),
scored as (
  select d.doc_id, len(d.w)::bigint n_features, coalesce(s.weight, 0) weight,
    coalesce(s.weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint score
  from docs d left join summed s using (doc_id)),
drawn as (select doc_id, row_number() over (order by score desc, doc_id) rank from scored where n_features >= 20)
select s.*, case when r.rank <= (select count(*) from drawn) * 10 // 100 then r.rank end rank from scored s left join drawn r using (doc_id)
"""

OP12 = f"""
with crc_table as {_CRC_TABLE},
own as (
  select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) w from conversations where conv_id is not null group by conv_id),
heads as (select o.conv_id, o.w, coalesce(b.w, o.w[:0]) lead, ({_crc32('o.conv_id::varchar')} % 6)::int h
  from own o cross join crc_table left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
whole as (select conv_id, list_concat(lead[1:h], w[h + 1:]) w from heads),
prefixes as (select conv_id, d, w[1:d] p, len(w) = d ends from (select *, unnest(range(len(w) + 1)) d from whole)),
nodes as (
  select p, any_value(d) d, min(conv_id) conv_id, count(*) n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) ends_sha256
  from prefixes group by p),
children as (select p[1:d - 1] p, count(*) n from nodes where d > 0 group by 1),
own_totals as (select n.p, n.d, c.n is null leaf, case when n.d = 0 then 0 else (n_convs - 1) * length(n.p[n.d].t) end saved from nodes n left join children c using (p)),
totals as (select p[1:k] p, count(*) filter (leaf) n_leaves, sum(saved)::bigint saved_tokens from (select *, unnest(range(d + 1)) k from own_totals) group by 1)
select n.conv_id, n.d depth, u.conv_id parent_conv_id, n.n_convs, coalesce(c.n, 0) n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
from nodes n join totals t using (p) left join children c using (p) left join nodes u on n.d > 0 and u.p = n.p[1:n.d - 1]
"""

#: The pages at hand put their main text into one <article> of h1 and p elements, so plain cuts give the rows that the classifier must find.
OP13 = r"""
with cut as (
  select page_id, url, regexp_split_to_array(replace(regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's'), '<br>', ' '), '</?(p|h1)>') b from pages),
cleaned as (
  select page_id, url, list_transform(b, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'),
    '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) b from cut)
select page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10) || chr(10)) "text",
  length(array_to_string(list_filter(b, lambda x: x <> ''), chr(10) || chr(10)))::bigint n_chars
from cleaned
"""

ORACLES = {
    "op1_source_mixing": OP1, "op2_lm_score": OP2, "op5_url_filter": OP5, "op6_chat_format": OP6, "op8_exact_dedup": OP8, "op10_decontamination": OP10,
    "op11_importance_resampling": OP11, "op12_prefix_trie": OP12, "op13_html_extraction": OP13,
}
