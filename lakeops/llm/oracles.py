"""Expected results as DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

#: Every pair of a query and another vector, once for each component; vec_id, not rows, tells vectors apart.
_TOP_K = """
with clean as (
    select vec_id, min(v) as v
    from (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
          from embeddings
          where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)
    group by vec_id),
scored as (
    select q.vec_id as query_id, c.vec_id,
           cast(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
    from clean q join clean c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0),
ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

ORACLES: dict[str, str] = {"op1_topk": _TOP_K}
