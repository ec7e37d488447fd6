"""DuckDB statements for the queries that SQL can express."""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every run of 13 words of a document is looked up among those of the items; shorter items likewise by their own length.
CONTAMINATION = f"""
with item as (select item_id, regexp_extract_all({_FOLD}, '{_WORD}') w from benchmark where text is not null),
win as (select distinct cast(item_id as varchar) item_id, w[s:s + least(len(w), 13) - 1] p, least(len(w), 13) n
        from (select *, unnest(generate_series(1, greatest(1, len(w) - 12))) s from item where len(w) > 0)),
doc as (select doc_id, regexp_extract_all({_FOLD}, '{_WORD}') w from documents),
place as (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) s from doc, (select distinct n from win)
       where len(w) >= n),
hit as (select doc_id, s, n, item_id from place join win using (n) where w[s:s + n - 1] = p),
word as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(generate_series(s, s + n - 1)) k from hit) group by 1),
named as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id, ',' order by item_id) ids from hit group by 1)
select doc_id, coalesce(len(w), 0)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
 sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) contaminated
from doc left join word using (doc_id) left join named using (doc_id)
"""


def _clusters(k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64) -> str:
    """Plain k-means: every vector against every centroid, the rounds written out."""
    parts = [f"""kept as (select vec_id, row_number() over () r, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) v from embeddings
        where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {size}),
      c0 as (select (row_number() over (order by sha256('1:' || vec_id)) - 1)::int c, v from kept order by sha256('1:' || vec_id) limit {k})"""]
    for n in range(rounds + 1):
        parts.append(f"""d{n} as (select r, vec_id, c, list_sum(list_transform(range(1, {size + 1}), lambda i: (kept.v[i] - c{n}.v[i]) * (kept.v[i] - c{n}.v[i])))::bigint d
            from kept cross join c{n}), a{n} as (select r, any_value(vec_id) vec_id, arg_min(c, d * {k} + c) c, min(d) d from d{n} group by r)""")
        if n < rounds:
            parts.append(f"""m{n} as (select c, i, floor(sum(x)::double / count(*))::bigint m from (
              select c, unnest(v) x, unnest(range({size})) i from a{n} join (select r, v from kept) using (r)) group by c, i),
            c{n + 1} as (select c, coalesce(w.v, c{n}.v) v from c{n} left join (select c, list(m order by i) v from m{n} group by c) w using (c))""")
    last = f"a{rounds}"
    return "with " + ", ".join(parts) + f"""
      select vec_id, c as cluster, d as distance, (sum(d) over (partition by c))::bigint cluster_inertia, (sum(d) over ())::bigint inertia,
        sha256(array_to_string(c{rounds}.v, ',')) centroid_sha256 from {last} join c{rounds} using (c)"""


CLUSTERS = _clusters()

# A node is the list of its turns; the CRC runs over the digits of an id, bit by bit.
TRIE = """
with own as (select conv_id c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} order by turn nulls first) l from conversations
        where conv_id is not null group by 1),
head as (select c, l, (xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(c::varchar, ''), lambda ch: ascii(ch)::ubigint)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)::ubigint[]), lambda a, step: xor(a >> 1, (a & 1) * 3988292384::ubigint))),
        4294967295::ubigint) % 9)::int h from own),
rebuilt as (select head.c, list_concat(coalesce(base.l[1:h], []), head.l[h + 1:]) l from head left join own base on base.c = head.c - head.c % 5),
prefix as (select c, len(l) n, l, unnest(range(len(l) + 1)) d from rebuilt),
node as (select d, l[1:d] k, min(c) conv_id, count(*) n_convs, list(c order by c) filter (where n = d) ends from prefix group by 1, 2),
child as (select d - 1 d, k[1:d - 1] k, count(*) n from node where d > 0 group by 1, 2),
own_sum as (select node.d, node.k, (n is null)::int leaf, case when node.d > 0 then (n_convs - 1) * strlen(node.k[node.d].x) else 0 end saved
        from node left join child on child.d = node.d and child.k = node.k),
above as (select unnest(range(d + 1)) u, k, leaf, saved from own_sum),
sub as (select u d, k[1:u] k, sum(leaf)::bigint n_leaves, sum(saved)::bigint saved_tokens from above group by 1, 2)
select node.conv_id, node.d::bigint as depth, up.conv_id parent_conv_id, node.n_convs, coalesce(child.n, 0) n_children, n_leaves, saved_tokens,
  sha256(coalesce(array_to_string(node.ends, ','), '')) ends_sha256
from node join sub on sub.d = node.d and sub.k = node.k left join child on child.d = node.d and child.k = node.k
left join node up on up.d = node.d - 1 and up.k = node.k[1:node.d - 1]
"""
