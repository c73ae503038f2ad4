"""Plain SQL of the queries that SQL can express, for a second engine."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ALNUM_BREAKS = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
BREAKS = r"[ \t-\r]+"


def _words(text: str, breaks: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{breaks}'), lambda x: x <> '')"


CAPTURES = """
with p as (select page_id, sha1(coalesce(html, '')) sha, octet_length(encode(coalesce(html, ''))) n from pages),
f as (select *, min(page_id) over (partition by sha) lead from p)
select page_id, cast(n as bigint) payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast((cast('0x' || substr(sha, cast((i // 8) * 10 + 1 as integer), 10) as bigint) >> cast(35 - 5 * (i % 8) as integer)) & 31 as integer) + 1, 1)), '') payload_digest,
  case when page_id = lead then 'response' else 'revisit' end record_type, case when page_id <> lead then lead end refers_to
from f"""

DECONTAMINATION = f"""
with d as (select doc_id, {_words(LOWER, ALNUM_BREAKS)} w from documents),
b as (select item_id, {_words(LOWER, ALNUM_BREAKS)} w from benchmark),
phrases as (select distinct item_id, least(len(w), 13) n, w[i:i + least(len(w), 13) - 1] s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) i from b where len(w) > 0)),
spots as (select doc_id, i, n, w[i:i + n - 1] s from (
  select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, (select distinct n from phrases) where len(w) >= n)),
hits as (select doc_id, i, spots.n, item_id from spots join phrases on spots.n = phrases.n and spots.s = phrases.s),
covered as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(range(i, i + n)) k from hits) group by doc_id),
named as (select doc_id, count(*) n_items, sha256(string_agg(item, ',' order by item)) h
  from (select distinct doc_id, cast(item_id as varchar) item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, coalesce(h, sha256('')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join covered using (doc_id) left join named using (doc_id)"""

SUBSTRINGS = f"""
with p as (select doc_id, {_words("coalesce(text, '')", BREAKS)} w from documents),
spots as (select doc_id, i, hash(w[i:i + 34]) h, md5(array_to_string(w[i:i + 34], ' ')) s
  from (select doc_id, w, unnest(range(1, len(w) - 33)) i from p where len(w) >= 35)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by h, s) c from spots) where c > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) k from twice),
kept as (select x.doc_id, string_agg(x.v, ' ' order by x.k) t, count(*) n
  from (select doc_id, unnest(w) v, unnest(range(1, len(w) + 1)) k from p) x anti join gone g on x.doc_id = g.doc_id and x.k = g.k group by x.doc_id)
select p.doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256
from p left join kept using (doc_id)"""

_FIELD = "coalesce(cast(octet_length(encode(cast({0} as varchar))) as varchar) || ':' || cast({0} as varchar), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{t}")) + ")"
_UP = """select tree, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' order by pos)), list(h order by pos) from {0} where n > 1
  group by tree, lvl, pos // 8, n"""
_FOLD = """select c.k, r.lvl, r.pos, sha256(array_to_string(list_transform(r.kids, lambda h, i: case when i = c.pos % 8 + 1 then c.f else h end), '')),
    c.sibs || array_to_string(list_filter(r.kids, lambda h, i: i <> c.pos % 8 + 1), '')
  from {0} c {1} join {2} r on r.lvl = c.lvl + 1 and r.pos = c.pos // 8"""
_TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: bit by bit over its characters."""
    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    byte = f"list_reduce(list_prepend(xor(c, cast(b as bigint)), [cast(0 as bigint) for _ in range(8)]), lambda c, z: {step})"
    return (f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split({text}, ''), lambda ch: cast(ord(ch) as bigint))),"
            f" lambda c, b: {byte}), 4294967295)")


MANIFEST = f"""
with recursive d as (
  select *, row_number() over () k from documents),
l as (select k, doc_id, coalesce('=' || lang, '') tree, {_LEAF.format(t="text")} h,
  case when {_crc32("cast(doc_id as varchar)")} % 3 = 0 then {_LEAF.format(t=_TAMPERED)} else {_LEAF.format(t="text")} end f from d),
o as (select *, row_number() over (partition by tree order by doc_id nulls first, h, k) - 1 pos, count(*) over (partition by tree) n from l),
low(tree, lvl, pos, n, h, kids) as (select tree, 0, pos, n, h, cast(null as varchar[]) from o union all {_UP.format("low")}),
subs as (select tree name, h, row_number() over (order by encode(tree)) - 1 pos, count(*) over () n from low where n = 1),
high(tree, lvl, pos, n, h, kids) as (select '', 0, pos, n, h, cast(null as varchar[]) from subs union all {_UP.format("high")}),
below(k, lvl, pos, f, sibs) as (select k, 0, pos, f, '' from o union all {_FOLD.format("below", "join o using (k)", "low").replace("r on", "r on r.tree = o.tree and")}),
mid as (select k, max_by(f, lvl) f, max_by(sibs, lvl) sibs from below group by k),
above(k, lvl, pos, f, sibs) as (select mid.k, 0, subs.pos, mid.f, mid.sibs from mid join o on o.k = mid.k join subs on subs.name = o.tree
  union all {_FOLD.format("above", "", "high")}),
ends as (select k, max_by(f, lvl) f, max_by(sibs, lvl) sibs from above group by k)
select o.doc_id, o.h leaf, subs.h subroot, root.h root, sha256(sibs) proof_sha256, ends.f folded_root, ends.f = root.h verified
from o join ends using (k) join subs on subs.name = o.tree cross join (select h from high where n = 1) root"""

TRIE = f"""
with t as (select conv_id, coalesce(role, '') r, coalesce(text, '') t, row_number() over (partition by conv_id order by turn nulls first) i
  from conversations where conv_id is not null),
own as (select conv_id, list(octet_length(encode(r)) || ':' || r || t order by i) a, list(len({_words("t", BREAKS)}) order by i) w from t group by conv_id),
h as (select *, cast({_crc32("cast(conv_id as varchar)")} % 4 as integer) h, conv_id - conv_id % 20 base from own),
re as (select h.conv_id, coalesce(b.a[1:h.h], []) || h.a[h.h + 1:] a, coalesce(b.w[1:h.h], []) || h.w[h.h + 1:] w from h left join own b on b.conv_id = h.base),
pre as (select conv_id, len(a) n, d, sha256(array_to_string(list_transform(a[1:d], lambda x: sha256(x)), '')) k, coalesce(w[d], 0) w
  from (select *, unnest(range(0, len(a) + 1)) d from re)),
node as (select d, k, min(conv_id) conv_id, count(*) n_convs, max(w) w, string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = d) ends
  from pre group by d, k),
up as (select node.*, p.k pk from node left join pre p on p.conv_id = node.conv_id and p.d = node.d - 1),
kids as (select d - 1 d, pk k, count(*) n_children from up where d > 0 group by all),
full_ as (select up.*, coalesce(n_children, 0) n_children from up left join kids using (d, k)),
sub as (select p.d, p.k, sum(cast(f.n_children = 0 as bigint)) n_leaves, sum((f.n_convs - 1) * f.w) saved from full_ f join pre p on p.conv_id = f.conv_id and p.d <= f.d group by all)
select f.conv_id, cast(f.d as bigint) depth, par.conv_id parent_conv_id, f.n_convs, f.n_children, cast(n_leaves as bigint) n_leaves, cast(saved as bigint) saved_tokens,
  sha256(coalesce(f.ends, '')) ends_sha256
from full_ f join sub using (d, k) left join node par on par.d = f.d - 1 and par.k = f.pk"""

_ESCAPED = r"regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\]|\|)', '\1\\\2\3', 'g')"
CHAT = f"""
with recursive c as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from (select conv_id, turn, role, text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
r as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) i, len({_words("text", BREAKS)}) + 2 size,
  length({_ESCAPED.format("text")}) + length(regexp_replace({_ESCAPED.format("role")}, '(\\|)(\\\\*)>', '\\1\\\\\\2>', 'g')) + 8 chars from c),
t as (select *, cast(sum(size) over (partition by conv_id order by i) as bigint) upto from r),
s as (select conv_id, role = 'system' lead, case when role = 'system' then size else 0 end lead_size, case when role = 'system' then chars else 0 end lead_chars from t where i = 1),
w(conv_id, k, first, origin) as (
  select conv_id, 0, cast(lead as bigint) + 1, cast(lead_size as bigint) from s
  union all
  select w.conv_id, w.k + 1, min(t.i), min(t.upto - t.size) from w join s on s.conv_id is not distinct from w.conv_id
    join t on t.conv_id is not distinct from w.conv_id and t.i > w.first
      and t.upto - w.origin > case when w.k = 0 then 1024 - lead_size else greatest(1024 - lead_size - 256, 1) end
  group by w.conv_id, w.k),
more as (select w.conv_id, sum(lead_chars + coalesce((select sum(chars) from t where t.conv_id is not distinct from w.conv_id and t.i < w.first
    and t.i >= greatest(w.first - 4, cast(lead as bigint) + 1) and w.origin - (t.upto - t.size) <= 256), 0)) extra
  from w join s on s.conv_id is not distinct from w.conv_id where w.k > 0 group by w.conv_id),
g as (select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) turns_sha256,
  coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '') loss, sum(chars) chars from t group by conv_id)
select g.conv_id, n_turns, turns_sha256, cast(length(loss) as bigint) loss_chars, sha256(loss) loss_sha256, cast(chars + coalesce(extra, 0) as bigint) formatted_chars
from g left join more on more.conv_id is not distinct from g.conv_id"""

ORACLES = {"op12_chat_formatting": CHAT, "op11_conversation_trie": TRIE, "op13_merkle_manifest": MANIFEST, "op6_warc": CAPTURES, "op9_benchmark_decontamination": DECONTAMINATION, "op10_substring_dedup": SUBSTRINGS}
