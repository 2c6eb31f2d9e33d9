"""DuckDB SQL for those queries of this subpackage that SQL can express.

Each states a result from its definition alone, without the operator's method: no
blocks of vectors, no sketch of rarities, no bitmaps.
"""

from __future__ import annotations

from clickloom.llm.licenses import NOTICES

#: Integer vectors; every query row against every other row.
OP6_EXACT_TOP_K = """
with vectors as (
    select vec_id, [floor(256 * cast(x as double)) for x in embedding] as w
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), queries as (
    select distinct vec_id, w from vectors where vec_id % 50 = 0
), scores as (
    select q.vec_id as query_id, q.w as query_row, c.vec_id,
        cast(list_inner_product(
            list_resize(q.w, greatest(len(q.w), len(c.w)), 0.0),
            list_resize(c.w, greatest(len(q.w), len(c.w)), 0.0)) as bigint) as score
    from queries as q join vectors as c on q.vec_id <> c.vec_id
), ranked as (
    select query_id, vec_id, score,
        cast(row_number() over (
            partition by query_id, query_row order by score desc, vec_id) as integer) as rank
    from scores
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

#: Sets of words by first place; a prefix of each in order of rarity finds the partners.
OP5_LINE_DEDUP = r"""
with cut as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as parts
    from documents where doc_id is not null
), numbered as (
    select doc_id, cast(unnest(range(len(parts))) as integer) as line, unnest(parts) as content
    from cut
), lines as (
    select doc_id, line, list_sort(list_distinct([
        w for w in regexp_split_to_array(content, '[\x20\x09-\x0D]+') if w <> ''])) as words
    from numbered
), sets as (
    select words, min({'doc_id': doc_id, 'line': line}) as place, len(words) as n
    from lines where len(words) > 0 group by words
), tokens as (
    select place, n, unnest(words) as token from sets
), counted as (
    select place, n, token, count(*) over (partition by token) as often from tokens
), prefixes as (
    select place, n, token,
        row_number() over (partition by place order by often, token) as position
    from counted qualify position <= n - (4 * n + 4) // 5 + 1
), candidates as (
    select distinct a.place as earlier, b.place
    from prefixes as a join prefixes as b
        on a.token = b.token and a.place < b.place and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), matched as (
    select distinct c.place
    from candidates as c
    join sets as a on a.place = c.earlier
    join sets as b on b.place = c.place
    where 9 * len(list_intersect(a.words, b.words)) >= 4 * (a.n + b.n)
)
select distinct l.doc_id, l.line
from lines as l join sets as s on s.words = l.words
where {'doc_id': l.doc_id, 'line': l.line} <> s.place
   or s.place in (select place from matched)
"""

_TEMPLATES = ", ".join(
    "('{}', '{}')".format(*(part.replace("'", "''") for part in notice)) for notice in NOTICES
)

#: Shared shingles by a plain join; every window of a template that holds enough of them.
OP2_LICENSE_SCAN = rf"""
with texts as (
    select row_number() over () as row, doc_id, coalesce(text, '') as text from documents
), notices as (
    select row_number() over () as template, license, text
    from (values {_TEMPLATES}) as n(license, text)
), text_words as (
    select row, doc_id, [
        w for w in regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+') if w <> ''] as words
    from texts
), notice_words as (
    select template, license, [
        w for w in regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+') if w <> ''] as words
    from notices
), shingles as (
    select row, doc_id, unnest(range(len(words) - 4)) as place,
        unnest([array_to_string(words[i + 1:i + 5], ' ') for i in range(len(words) - 4)]) as shingle
    from text_words where len(words) >= 5
), wanted as (
    select template, license, len(words) - 4 as t,
        unnest([array_to_string(words[i + 1:i + 5], ' ') for i in range(len(words) - 4)]) as shingle
    from notice_words where len(words) >= 5
), sizes as (
    select template, count(distinct shingle) as n from wanted group by template
), held as (
    select distinct row, doc_id, template, license, t, shingle, place
    from shingles join wanted using (shingle)
), windows as (
    select row, doc_id, license, template, first,
        count(distinct shingle) / any_value(n) as containment, min(place) as place
    from (select *, unnest(list_distinct([greatest(place // t - 1, 0), place // t])) * t as first
          from held)
    join sizes using (template)
    group by row, doc_id, license, template, first
    having count(distinct shingle) / any_value(n) >= 0.8
), compared as (
    select *, max(containment) over (
        partition by row order by place range between 10 preceding and 10 following) as best
    from windows
)
select doc_id, license, max(containment) as containment, count(*) as n_windows
from compared where containment = best
group by row, doc_id, license
"""


def _levels(name: str, start: str, depth: int) -> str:
    """WITH parts of one kind of tree: nodes of each level, then each node's siblings there."""
    parts = [f"{name}0 as ({start})"]
    for k in range(depth):
        parts.append(f"""{name}_path{k} as (
    select tree, idx, n,
        coalesce(string_agg(digest, '') over (partition by tree, idx // 16 order by idx
            rows between unbounded preceding and 1 preceding), '') as before,
        coalesce(string_agg(digest, '') over (partition by tree, idx // 16 order by idx
            rows between 1 following and unbounded following), '') as after
    from {name}{k} where n > 1
)""")
        parts.append(f"""{name}{k + 1} as (
    select tree, idx // 16 as idx, sha256(string_agg(digest, '' order by idx)) as digest,
        (any_value(n) + 15) // 16 as n
    from {name}{k} where n > 1 group by tree, idx // 16
)""")
    return ", ".join(parts)


def _last(name: str, depth: int) -> str:
    return " union all ".join(
        f"select tree, digest from {name}{k} where n = 1" for k in range(depth + 1)
    )


#: Levels of the trees that the SQL spells out; 16 ** 7 rows per source, 16 ** 4 sources.
_DEPTH, _TOP_DEPTH = 7, 4


def _steps() -> str:
    """One WITH part per level, so that the folded digest is named and not repeated."""
    parts, source = [], "leaves"
    levels = [("own", k, "tree", "idx") for k in range(_DEPTH)]
    levels += [("top", k, "0", "tree") for k in range(_TOP_DEPTH)]
    for number, (name, k, tree, idx) in enumerate(levels):
        parts.append(f"""step{number} as (
    select s.* exclude (proof, folded), s.proof || coalesce(p.before || p.after, '') as proof,
        case when p.before is null then s.folded else sha256(p.before || s.folded || p.after) end as folded
    from {source} as s left join {name}_path{k} as p
        on p.tree = s.{tree} and p.idx = s.{idx} // {16 ** k}
)""".replace("s.0", "0"))
        source = f"step{number}"
    return ", ".join(parts)


_FIELDS = ["doc_id", "source", "lang", "n_chars"]
_PARTS = " || ".join(
    f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in _FIELDS
)
_BYTES = "[ord(c) for c in string_split(cast(doc_id as varchar), '')]"

#: Level by level with windows; CRC-32 bit by bit over the decimal digits.
OP13_MERKLE_MANIFEST = rf"""
with digests as (
    select doc_id, source,
        sha256({_PARTS} || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        sha256({_PARTS} || coalesce(strlen(text) || ':' ||
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) as lowered,
        xor(list_reduce(list_concat([4294967295::bigint], {_BYTES}), lambda c, b:
            list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, i:
                xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint) as crc
    from documents
), leaves as (
    select doc_id, leaf, dense_rank() over (order by source nulls first) - 1 as tree,
        row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
        count(*) over (partition by source) as n, '' as proof,
        case when crc % 5 = 0 then lowered else leaf end as folded
    from digests
), {_levels("own", "select tree, idx, leaf as digest, n from leaves", _DEPTH)},
subroots as ({_last("own", _DEPTH)}),
{_levels("top", "select 0 as tree, tree as idx, digest, count(*) over () as n from subroots", _TOP_DEPTH)},
root as ({_last("top", _TOP_DEPTH)}),
{_steps()}
select s.doc_id, s.leaf, r.digest as subroot, root.digest as root, sha256(s.proof) as proof_sha256,
    s.folded as folded_root, s.folded = root.digest as verified
from step{_DEPTH + _TOP_DEPTH - 1} as s join subroots as r on r.tree = s.tree cross join root
"""
