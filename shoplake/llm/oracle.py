"""Oracle SQL of the operators whose results SQL can express, for DuckDB."""

from __future__ import annotations

#: SQL of a text with A-Z lower-cased.
LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format


def crc32(number: str) -> str:
    """SQL of the unsigned crc32 of an integer's decimal text, bit by bit."""
    bit = "case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]), lambda v, i: {bit})"
    chars = f"list_transform(string_split(cast({number} as varchar), ''), lambda d: cast(ord(d) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {chars}), lambda c, b: {byte}), 4294967295)"


EXACT_DEDUP = """
select doc_id, max(doc_id) over (partition by body) as keep_id,
  count(*) over (partition by body) as group_size,
  doc_id = max(doc_id) over (partition by body) as kept, sha256(body) as text_sha256
from (select cast(doc_id as bigint) as doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
      from documents)"""


def _merkle() -> str:
    """Levels one after the other: enough for 16 ** 6 leaves of a source and 16 ** 4 sources."""

    def field(value: str) -> str:
        return f"coalesce(strlen(cast({value} as varchar)) || ':' || cast({value} as varchar), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def level(kind: str, k: int) -> str:
        below = f"{kind}{k - 1}"
        return f"""{kind}{k} as (select tree, pos // 16 as pos, max((n + 15) // 16) as n,
  sha256(string_agg(digest, '' order by pos)) as digest from {below} where n > 1 group by tree, pos // 16)"""

    def rise(kind: str, k: int, before: str) -> str:
        """Ways one level further up; those at their root stay."""
        return f"""{before}{k} as (select f.rid, any_value(f.tree) as tree, any_value(f.pos) // 16 as pos,
  any_value((f.n + 15) // 16) as n,
  any_value(f.proof) || coalesce(string_agg(case when s.pos <> f.pos then s.digest end, '' order by s.pos), '') as proof,
  case when any_value(f.n) = 1 then any_value(f.seen)
    else sha256(string_agg(case when s.pos = f.pos then f.seen else s.digest end, '' order by s.pos)) end as seen
  from {before}{k - 1} f left join {kind}{k - 1} s
    on f.n > 1 and s.tree is not distinct from f.tree and s.pos // 16 = f.pos // 16 group by f.rid)"""

    deep, high = 6, 4
    parts = [
        f"""leaves as (select row_number() over () as rid, doc_id, source as tree, {leaf('text')} as digest,
  case when doc_id is not null and {crc32('doc_id')} % 5 = 0 then {leaf(LOWERED('text'))} end as altered
  from documents)""",
        """s0 as (select rid, tree, digest, row_number() over (partition by tree order by doc_id nulls first, digest, rid) - 1 as pos,
  count(*) over (partition by tree) as n from leaves)""",
        *[level("s", k) for k in range(1, deep + 1)],
        "sub as ("
        + " union all ".join(f"select tree as source, digest from s{k} where n = 1" for k in range(deep + 1))
        + ")",
        """t0 as (select 0 as tree, source, digest, row_number() over (order by source nulls first) - 1 as pos,
  count(*) over () as n from sub)""",
        *[level("t", k) for k in range(1, high + 1)],
        "top as (" + " union all ".join(f"select digest from t{k} where n = 1" for k in range(high + 1)) + ")",
        """f0 as (select s0.rid, s0.tree, s0.pos, s0.n, '' as proof, coalesce(altered, s0.digest) as seen
  from s0 join leaves using (rid))""",
        *[rise("s", k, "f") for k in range(1, deep + 1)],
        f"""g0 as (select f.rid, 0 as tree, t0.pos, t0.n, f.proof, f.seen
  from f{deep} f join leaves l using (rid) join t0 on t0.source is not distinct from l.tree)""",
        *[rise("t", k, "g") for k in range(1, high + 1)],
    ]
    return f"""with {', '.join(parts)}
select l.doc_id, l.digest as leaf, sub.digest as subroot, top.digest as root, sha256(g.proof) as proof_sha256,
  g.seen as folded_root, g.seen = top.digest as verified
from g{high} g join leaves l using (rid) join sub on sub.source is not distinct from l.tree cross join top"""


MERKLE = _merkle()

TRIE = f"""
with turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
heads as (select distinct c, c - c % 20 as base, {crc32('c')} % 4 as h from turns),
joint as (
  select heads.c, 0 as part, turns.pos, role, text from heads join turns on turns.c = heads.base and turns.pos <= h
  union all
  select heads.c, 1, turns.pos, role, text from heads join turns on turns.c = heads.c and turns.pos > h),
path as (
  select c, row_number() over w as depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words,
    list([role, text]) over (w rows between unbounded preceding and current row) as prefix
  from joint window w as (partition by c order by part, pos)),
ways as (
  select c, depth, words, sha256(cast(to_json(prefix) as varchar)) as node,
    coalesce(lag(sha256(cast(to_json(prefix) as varchar))) over (partition by c order by depth), '') as above
  from path union all select c, 0, 0, '', null from heads),
nodes as (
  select node, depth, any_value(above) as above, any_value(words) as words, min(c) as conv_id, count(*) as n_convs
  from ways group by node, depth),
lasts as (select c, arg_max(node, depth) as node from ways group by c),
ends as (select node, string_agg(cast(c as varchar), ',' order by c) as ids from lasts group by node),
kids as (select above as node, count(*) as kids from nodes where above is not null group by above),
under as (
  select top.node, count(*) filter (kids.kids is null) as n_leaves, sum((low.n_convs - 1) * low.words) as saved
  from nodes low join ways reach on reach.c = low.conv_id and reach.depth <= low.depth
    join nodes top on top.node = reach.node left join kids on kids.node = low.node
  group by top.node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(kids.kids, 0) as n_children, under.n_leaves,
  cast(under.saved as bigint) as saved_tokens, sha256(coalesce(ends.ids, '')) as ends_sha256
from nodes n left join nodes p on p.node = n.above left join kids on kids.node = n.node
  join under on under.node = n.node left join ends on ends.node = n.node"""

DECONTAMINATION = f"""
with texts as (
  select row_number() over () as rid, doc_id,
    coalesce(regexp_extract_all({LOWERED('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as words
  from documents),
items as (
  select item_id, regexp_extract_all({LOWERED('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
  from benchmark where text is not null),
windows as (
  select distinct item_id, least(len(words), 10) as size, array_to_string(words[i:i + 9], ' ') as phrase
  from (select item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) as i from items where len(words) > 0)),
sizes as (select distinct size from windows),
places as (
  select rid, size, i, array_to_string(words[i:i + size - 1], ' ') as phrase
  from (select rid, words, size, unnest(generate_series(1, len(words) - size + 1)) as i
        from texts, sizes where len(words) >= size)),
met as (select p.rid, p.i, p.size, w.item_id from places p join windows w on w.size = p.size and w.phrase = p.phrase),
hits as (
  select rid, count(distinct k) as n_hit from (select rid, unnest(generate_series(i, i + size - 1)) as k from met) group by rid),
named as (
  select rid, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct rid, cast(item_id as varchar) as name from met where item_id is not null) group by rid)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts left join hits using (rid) left join named using (rid)"""
