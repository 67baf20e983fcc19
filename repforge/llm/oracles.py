"""DuckDB SQL of the operators whose steps need more than one statement's worth
of SQL: written from the contract, not from the operators."""

from __future__ import annotations


def centroid_sql(size: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> str:
    """op12 in plain SQL: every distance of every vector, round by round."""
    ctes = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
          list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        "parts AS MATERIALIZED (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept)",
        f"""first_k AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c FROM kept
        QUALIFY c < {k})""",
        "c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS j FROM first_k)"]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM
          (SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS d FROM parts JOIN c{r} USING (j) GROUP BY rid, c)
          GROUP BY rid)""")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT o.c, o.j, CASE WHEN n IS NULL THEN o.y
          ELSE (s - ((s % n) + n) % n) // n END AS y FROM c{r} o LEFT JOIN
          (SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM parts JOIN a{r} USING (rid) GROUP BY c, j) m
          USING (c, j))""")
    return "WITH " + ",\n".join(ctes) + f"""
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
    FROM kept JOIN a{rounds} USING (rid)
    JOIN (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY c) USING (c)"""


def repair_sql() -> str:
    """op11 in plain SQL: per conversation the least ``cost, audit`` string of
    each grammar state, row by row; crc32 byte by byte."""
    def add(v: str, cost, letter: str) -> str:
        return f"lpad((left({v}, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({v}, 7) || '{letter}'"

    def to_user(cost, letter: str) -> str:
        return ", ".join(add(f"p.{x}", cost, letter) for x in "nsa")

    insert = f"""list_transform([b], lambda w: struct_pack(
        n := w.n, s := w.s, u := least(w.u, {add('w.n', 5, 'I')}, {add('w.s', 5, 'I')}, {add('w.a', 5, 'I')}),
        a := least(w.a, {add('w.u', 5, 'I')})))"""
    twice = f"""list_transform({insert}, lambda w: struct_pack(
        n := w.n, s := w.s, u := least(w.u, {add('w.a', 5, 'I')}), a := least(w.a, {add('w.u', 5, 'I')})))[1]"""
    return f"""
    WITH RECURSIVE tbl AS (SELECT list_transform(range(256), lambda n: list_reduce(
        [n, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    hashed AS (SELECT keyed.*, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, tbl),
    hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM hashed, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
    placed AS (SELECT *, row_number() OVER c AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
        lag(role) OVER c AS before
      FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
    faults AS (SELECT *, left(role, 1) AS initial,
        CASE WHEN said = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
             WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
    steps AS (
      SELECT conv_id, 0::BIGINT AS i, struct_pack(n := '000000', s := NULL::VARCHAR, u := NULL::VARCHAR, a := NULL::VARCHAR) AS b
      FROM (SELECT DISTINCT conv_id FROM conversations)
      UNION ALL
      SELECT conv_id, i, struct_pack(n := {add('p.n', 2, 'D')},
          s := least({add('p.s', 2, 'D')}, CASE WHEN live AND initial = 's' THEN {add('p.n', 'extra', 'K')} END),
          u := least({add('p.u', 2, 'D')}, CASE WHEN live AND initial = 'u' THEN least({to_user('extra', 'K')}) END,
                     CASE WHEN live THEN least({to_user('extra + 1', 'R')}) END),
          a := least({add('p.a', 2, 'D')}, CASE WHEN live AND initial = 'a' THEN {add('p.u', 'extra', 'K')} END,
                     CASE WHEN live THEN {add('p.u', 'extra + 1', 'R')} END))
      FROM (SELECT s.conv_id, f.i, f.initial, f.fault IN ('', 'truncated') AS live,
                   CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra, {twice} AS p
            FROM steps s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1)),
    best AS (SELECT conv_id, least(b.n, b.a, {add('b.u', 5, 'I')}, {add('b.s', 10, 'II')}) AS v
      FROM steps QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
    letters AS (SELECT conv_id, unnest(string_split(substr(v, 7), '')) AS edit,
        generate_subscripts(string_split(substr(v, 7), ''), 1) AS spot FROM best),
    matched AS (SELECT *, sum((edit <> 'I')::INT) OVER w AS i, sum((edit <> 'D')::INT) OVER w AS o
      FROM letters WHERE edit <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
    made AS (SELECT m.conv_id, spot, o - (first_value(edit = 'K' AND f.initial = 's') OVER (
          PARTITION BY m.conv_id ORDER BY spot))::INT AS p, edit, f.role, f.text
      FROM matched m JOIN faults f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = greatest(m.i, 1) WHERE edit <> 'D'),
    lines AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN p % 2 = 1 THEN 'user' ELSE 'assistant' END
          || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS said FROM made GROUP BY conv_id),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (i > 1 AND left(before, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM faults GROUP BY conv_id)
    SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(v, 6)::BIGINT AS cost,
        substr(v, 7) AS audit, sha256(coalesce(said, '')) AS repaired_sha256
    FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
    LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM b.conv_id"""
