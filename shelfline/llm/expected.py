"""SQL of queries whose operators have none beside them: what `op1`, `op9` and `op10` must return, by plain definitions."""

from __future__ import annotations


def suffix_dedup(length: int = 100) -> str:
    """All strings of `length` bytes, each byte as two hex digits."""
    return f"""
    with texts as materialized (
        select doc_id, lower(hex(encode(coalesce(text, '')))) as x, octet_length(encode(coalesce(text, ''))) as n from documents
    ), pieces as (
        -- Strings that start within 256 bytes are cut from one piece, as cutting takes time with what it cuts from.
        select doc_id, n, c, substring(x, 512 * c + 1, 2 * ({length} + 255)) as x
        from (select doc_id, x, n, unnest(range(0, greatest(n - {length} + 256, 0) // 256)) as c from texts)
    ), strings as (
        select doc_id, 256 * c + s as s, md5_number(substring(x, 2 * s + 1, 2 * {length})) as v
        from (select doc_id, c, x, unnest(range(0, least(256, n - {length} + 1 - 256 * c))) as s from pieces)
    ), later as (
        select doc_id, s from (select doc_id, s, row_number() over (partition by v order by doc_id, s) as k from strings) where k > 1
    ), apart as (
        select doc_id, s, s - lag(s) over (partition by doc_id order by s) as gap from later
    ), runs as (
        select doc_id, s, sum(case when gap is null or gap > {length} then 1 else 0 end) over (partition by doc_id order by s) as run from apart
    ), spans as materialized (
        select doc_id, run, min(s) as a, max(s) + {length} as b from runs group by doc_id, run
    ), edges as (
        select doc_id, list(a order by a) as a, list(b order by a) as b from spans group by doc_id
    ), kept as (
        select t.doc_id, t.n, coalesce(len(e.a), 0) as spans,
               case when e.a is null then t.x
                    else list_reduce(list_prepend('', list_transform(range(0, len(e.a) + 1), lambda i:
                         t.x[2 * (case when i = 0 then 0 else e.b[i] end) + 1 : 2 * (case when i = len(e.a) then t.n else e.a[i + 1] end)])), lambda p, q: p || q)
               end as x
        from texts t left join edges e using (doc_id)
    )
    select doc_id, cast(n as bigint) as n_bytes, cast(n - len(x) // 2 as bigint) as n_removed, cast(spans as bigint) as n_spans, sha256(unhex(x)) as kept_sha256 from kept
    """


def near_dedup(percent: int = 85, size: int = 3) -> str:
    """All pairs of sets that share a shingle, and what their links reach."""
    words = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""
    return f"""
    with recursive words as materialized (
        select doc_id, {words} as w from documents
    ), shingles as materialized (
        select distinct doc_id, array_to_string(w[s : s + {size - 1}], ' ') as v
        from (select doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) as s from words where len(w) > 0)
    ), sizes as materialized (
        select doc_id, count(*) as n from shingles group by doc_id
    ), links as materialized (
        select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.v = b.v and a.doc_id <> b.doc_id
        join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
        group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= {percent} * (x.n + y.n - count(*))
    ), reached as (
        select doc_id, doc_id as other from documents union select r.doc_id, l.b from reached r join links l on l.a = r.other
    ), least as (
        select doc_id, min(other) as component_id from reached group by doc_id
    )
    select d.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, l.component_id, d.doc_id = l.component_id as kept
    from documents d join least l using (doc_id) left join sizes s using (doc_id)
    """


def vector_links(least: float = 0.95) -> str:
    """All pairs of vectors, and what their links reach."""
    return f"""
    with recursive held as materialized (
        select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
          and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links as materialized (
        select a.vec_id as a, b.vec_id as b from held a join held b on a.vec_id <> b.vec_id where list_cosine_similarity(a.v, b.v) >= {least}
    ), reached as (
        select vec_id, vec_id as other from embeddings union select r.vec_id, l.b from reached r join links l on l.a = r.other
    ), parts as (
        select vec_id, min(other) as component_id from reached group by vec_id
    ), counted as (
        select a as vec_id, count(*) as n from links group by a
    )
    select e.vec_id, cast(coalesce(c.n, 0) as bigint) as n_links, p.component_id, e.vec_id = p.component_id as kept
    from embeddings e join parts p using (vec_id) left join counted c using (vec_id)
    """
