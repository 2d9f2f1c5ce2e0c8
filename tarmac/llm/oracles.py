"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"
_PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; needs the CTE ``crc_table``."""
    octets = f"list_transform(range(0, strlen({text})), lambda i: cast('0x' || substr(hex(encode({text})), cast(2 * i + 1 as int), 2) as bigint))"
    return (
        f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b:"
        " xor(c >> 8, crcs[cast((xor(c, b) & 255) + 1 as int)])), 4294967295)"
    )


_CRC_TABLE = """crc_steps(i, c, k) as (
  select range, range, 0 from range(256) union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc_steps where k < 8),
crc_table as (select list(c order by i) crcs from crc_steps where k = 8)"""


def _merkle_levels(nodes: str, name: str, levels: int) -> str:
    """CTEs ``name``1 to ``name``<levels>: every node's parents. A tree that is down to one node stays as it is.

    The columns of ``nodes``: tree, pos, n, h.
    """
    return ",\n".join(
        f"""{name}{k} as (
  select tree, case when n > 1 then pos // 8 else 0 end pos, cast(any_value(case when n > 1 then (n + 7) // 8 else n end) as bigint) n,
    case when any_value(n) > 1 then sha256(string_agg(h, '' order by pos)) else any_value(h) end h
  from {nodes if k == 1 else f"{name}{k - 1}"} q group by q.tree, case when n > 1 then q.pos // 8 else 0 end)"""
        for k in range(1, levels + 1)
    )


def _merkle_way(start: str, nodes: str, name: str, levels: int, column: str) -> str:
    """CTEs that follow every row of ``start`` (id, tree, pos, n, h, proof) up through the levels, with h folded anew."""
    steps = []
    for k in range(1, levels + 1):
        level = nodes if k == 1 else f"{name}{k - 1}"
        steps.append(f"""{column}{k} as (
  select s.id, s.tree, case when s.n > 1 then s.pos // 8 else 0 end pos, case when s.n > 1 then (s.n + 7) // 8 else s.n end n,
    case when s.n > 1 then sha256(string_agg(case when q.pos = s.pos then s.h else q.h end, '' order by q.pos)) else s.h end h,
    case when s.n > 1 then s.proof || coalesce(string_agg(q.h, '' order by q.pos) filter (q.pos <> s.pos), '') else s.proof end proof
  from {start if k == 1 else f"{column}{k - 1}"} s join {level} q
    on q.tree = s.tree and (q.pos // 8 = s.pos // 8 and s.n > 1 or s.n = 1 and q.pos = s.pos)
  group by s.id, s.tree, s.pos, s.n, s.h, s.proof)""")
    return ",\n".join(steps)


def _merkle_field(name: str) -> str:
    return f"coalesce(strlen(cast({name} as varchar)) || ':' || {name}, '-')"


# Trees of up to 8 ** 7 leaves and 8 ** 3 groups.
_MERKLE_UP, _MERKLE_TOP = 7, 3
_MERKLE_SQL = f"""
with recursive {_CRC_TABLE},
docs as (
  select row_number() over () id, *, {" || ".join(map(_merkle_field, ["doc_id", "source", "lang", "n_chars"]))} front,
    case when {_crc32("cast(doc_id as varchar)")} % 3 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      else text end held
  from documents, crc_table),
hashed as (
  select id, doc_id, coalesce('=' || lang, '') tree, sha256(front || {_merkle_field("text")}) leaf,
    sha256(front || {_merkle_field("held")}) held_leaf
  from docs),
leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf, id) - 1 pos, count(*) over (partition by tree) n, leaf h
  from hashed),
{_merkle_levels("leaves", "up", _MERKLE_UP)},
subroots as (
  select '' tree, tree grp, row_number() over (order by tree) - 1 pos, count(*) over () n, h from up{_MERKLE_UP}),
{_merkle_levels("subroots", "top", _MERKLE_TOP)},
held as (select id, tree, pos, n, held_leaf h, '' proof from leaves),
{_merkle_way("held", "leaves", "up", _MERKLE_UP, "held")},
high as (
  select w.id, s.tree, s.pos, s.n, w.h, w.proof from held{_MERKLE_UP} w join subroots s on s.grp = w.tree),
{_merkle_way("high", "subroots", "top", _MERKLE_TOP, "high")}
select l.doc_id, l.leaf, s.h subroot, t.h root, sha256(g.proof) proof_sha256, g.h folded_root, g.h = t.h verified
from leaves l join subroots s on s.grp = l.tree join high{_MERKLE_TOP} g on g.id = l.id, top{_MERKLE_TOP} t"""

ORACLES = {
    "op11_merkle_manifest": _MERKLE_SQL,
    # A deleted place is marked, so that equal marks are a replacement and an unmarked equal is an insertion.
    "op13_spelling_variants": rf"""
with recursive {_CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) run from documents),
counted as (select doc_id, run, count(*) n, cast(doc_id as varchar) || ':' || run k from runs group by all),
coded as (select run, n, {_crc32("k")} h from counted, crc_table),
spelled as (
  select n, case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
      else run end word
  from coded),
words as (
  select word, cast(sum(n) as bigint) n from spelled where length(word) >= 5 group by word having sum(n) >= 3),
cut as (
  select word, n, i, substr(word, 1, i) || substr(word, i + 2) rest
  from words, unnest(range(length(word))) t(i)),
near as (
  select a.word, b.word other, b.n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select c.word, w.word, w.n from cut c join words w on w.word = c.rest
  union select w.word, c.word, c.n from cut c join words w on w.word = c.rest),
best as (
  select word, count(*) n_near, first(other order by n desc, other) other, max(n) most from near group by word),
found as (
  select w.word, case when b.most >= 2 * w.n then other end form, w.n, coalesce(n_near, 0) n_near,
    case when b.most >= 2 * w.n then most end form_n
  from words w left join best b using (word)),
followed as (
  select word, word root, form next from found union all
  select f.word, f.next, g.form from followed f join found g on g.word = f.next)
select word, form, root, n, n_near, form_n from found join (select word, root from followed where next is null)
  using (word)""",
    "op2_decontaminate": rf"""
with docs as (select doc_id, regexp_extract_all({_LOWER}, '{_PLAIN_WORDS}') ws from documents),
items as (select item_id, regexp_extract_all({_LOWER}, '{_PLAIN_WORDS}') ws from benchmark),
item_windows as (
  select distinct item_id, least(len(ws), 10) size,
    array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') k
  from items, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) t(i) where len(ws) > 0),
doc_windows as (
  select doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') k
  from docs, (select distinct size from item_windows), unnest(range(1, len(ws) - size + 2)) t(i)),
found as (select doc_id, size, i, item_id from doc_windows join item_windows using (size, k)),
hits as (
  select doc_id, count(distinct p) n_hit
  from (select doc_id, unnest(range(i, i + size)) p from found) group by doc_id),
owners as (
  select doc_id, count(distinct item_id) n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') names
  from found group by doc_id)
select doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(names, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
from docs left join hits using (doc_id) left join owners using (doc_id)""",
    "op4_warc_archives": r"""
with pages_ as (
  select page_id, coalesce(html, '') payload, sha1(coalesce(html, '')) h, lower(coalesce(url, '')) u
  from pages),
parts as (
  select *, regexp_replace(regexp_replace(u, '^[a-z][a-z0-9+.-]*://', ''), '#[\s\S]*$', '') rest,
    min(page_id) over (partition by payload) first
  from pages_),
keyed as (
  select *, case when u = '' then '' else
    array_to_string(list_reverse(string_split(regexp_extract(rest, '^([^/?]*)', 1), '.')), ',')
    || ')' || regexp_replace(rest, '^[^/?]*', '') end url_key
  from parts)
select page_id, cast(strlen(payload) as bigint) payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda n:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(
      (cast('0x' || substr(h, cast(n // 4 * 5 + 1 as int), 5) as int) >> cast(15 - n % 4 * 5 as int)) & 31
      as int) + 1, 1)), '') payload_digest,
  case when page_id = first then 'response' else 'revisit' end record_type,
  case when page_id <> first then first end refers_to,
  url_key, row_number() over (order by url_key, page_id) - 1 history_no
from keyed""",
    "op7_substring_dedup": rf"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') ws from documents),
windows as (
  select doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) k
  from docs, unnest(range(1, len(ws) - 33)) t(i)),
repeated as (select doc_id, i from windows qualify count(*) over (partition by k) > 1),
removed as (select distinct doc_id, unnest(range(i, i + 35)) p from repeated),
words as (select doc_id, unnest(ws) w, generate_subscripts(ws, 1) p from docs),
kept as (
  select doc_id, count(*) n, string_agg(w, ' ' order by p) t
  from words anti join removed using (doc_id, p) group by doc_id)
select doc_id, cast(len(ws) as bigint) n_words, cast(len(ws) - coalesce(n, 0) as bigint) n_removed,
  sha256(coalesce(t, '')) kept_sha256
from docs left join kept using (doc_id)""",
    "op10_ngram_jaccard": rf"""
with recursive docs as (select doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') ws from documents),
grams as (
  select distinct doc_id, md5(array_to_string(ws[i : i + 4], ' ')) g
  from docs, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) t(i) where len(ws) > 0),
sizes as (select doc_id, count(*) n from grams group by doc_id),
common as (
  select a.doc_id a, b.doc_id b, count(*) n
  from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by all),
links as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 100 * c.n >= 75 * (x.n + y.n - c.n)),
reached(a, b) as (
  select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a)
select d.doc_id, cast(coalesce(any_value(s.n), 0) as bigint) n_shingles,
  least(d.doc_id, coalesce(min(r.b), d.doc_id)) component_id
from docs d left join sizes s on s.doc_id = d.doc_id left join reached r on r.a = d.doc_id
group by d.doc_id""",
}
