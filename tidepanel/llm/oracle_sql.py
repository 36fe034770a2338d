"""DuckDB oracles of the manifest and of the vectors' links, written out level by level."""

from __future__ import annotations

#: CRC-32 of a decimal id, bit by bit.
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({id}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
 lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda d, z: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384::BIGINT) ELSE d >> 1 END)), 4294967295::BIGINT)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _levels(name: str, count: int, fan: int) -> str:
    """{name}0 must have (grp, idx, d); every further level is made of the runs of the one before."""
    out = []
    for k in range(count):
        source = f"{name}0" if k == 0 else f"(SELECT grp, idx // {fan} AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d FROM {name}s{k - 1} WHERE n > 1 GROUP BY grp, idx // {fan})"
        others = "coalesce(string_agg(d, '') OVER (PARTITION BY grp, idx // {fan} ORDER BY idx ROWS BETWEEN {rows}), '')"
        out.append(f"{name}s{k} AS (SELECT grp, idx, d, count(*) OVER (PARTITION BY grp) AS n, {others.format(fan=fan, rows='UNBOUNDED PRECEDING AND 1 PRECEDING')} AS b, {others.format(fan=fan, rows='1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS a FROM {source})")
    return ",\n".join(out)


def _climb(name: str, count: int, fan: int, below: str) -> str:
    """Adds to the rows of ``below`` (grp, idx, proof, f) the siblings of every level; f is the folded digest."""
    for k in range(count):
        below = f"(SELECT r.* REPLACE (r.proof || coalesce(s.b || s.a, '') AS proof, CASE WHEN s.d IS NULL THEN r.f ELSE sha256(s.b || r.f || s.a) END AS f) FROM {below} r LEFT JOIN {name}s{k} s ON s.n > 1 AND s.grp = r.grp AND s.idx = r.idx // {fan**k})"
    return below


def merkle_sql(fan: int = 16, levels: int = 6, top_levels: int = 4) -> str:
    """Right for groups of up to fan ** levels rows and fan ** top_levels groups."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    shared = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    subroots = " UNION ALL ".join(f"SELECT grp, d FROM ms{k} WHERE n = 1" for k in range(levels))
    rows = "(SELECT doc_id, leaf, grp, idx, '' AS proof, CASE WHEN fifth THEN changed ELSE leaf END AS f FROM placed)"
    up = "(SELECT c.* REPLACE ('' AS grp, t.idx AS idx), c.grp AS name FROM climbed c JOIN tops t ON t.name = c.grp)"
    return f"""
WITH leaves AS (SELECT doc_id, coalesce('=' || source, '') AS grp, sha256({shared} || {_field('text')}) AS leaf, sha256({shared} || {_field(lowered)}) AS changed,
 coalesce({CRC32.format(id='doc_id')} % 5 = 0, false) AS fifth FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
m0 AS (SELECT grp, idx, leaf AS d FROM placed),
{_levels('m', levels, fan)},
subroots AS ({subroots}),
tops AS (SELECT grp AS name, d, row_number() OVER (ORDER BY encode(grp)) - 1 AS idx FROM subroots),
u0 AS (SELECT '' AS grp, idx, d FROM tops),
{_levels('u', top_levels, fan)},
whole AS ({' UNION ALL '.join(f'SELECT d FROM us{k} WHERE n = 1' for k in range(top_levels))}),
climbed AS (SELECT * FROM {_climb('m', levels, fan, rows)})
SELECT doc_id, leaf, s.d AS subroot, w.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = w.d AS verified
FROM {_climb('u', top_levels, fan, up)} r JOIN subroots s ON s.grp = r.name CROSS JOIN whole w
"""


#: All pairs of a label, in double precision; components by repeated least neighbours.
VECTOR_LINKS = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT reach.a AS r, min(w.vec_id) AS component_id FROM reach JOIN v w ON w.r = reach.b GROUP BY reach.a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""
