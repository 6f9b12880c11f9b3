"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from loomtext.llm import chat, manifest, mixing, search, secrets
from loomtext.llm.common import WORD


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _secrets() -> str:
    parts = []
    for i, (_, pattern, least) in enumerate(secrets.KINDS):
        whole = _quoted(f"(?s)(.*?)({pattern})")
        parts.append(f"""
        select id, {i} as kind, {least} as least, unnest(regexp_extract_all(text, '{whole}', 1)) as gap,
            unnest(regexp_extract_all(text, '{whole}', 2)) as hit, unnest(regexp_extract_all(text, '{whole}', 4)) as value,
            unnest(range(len(regexp_extract_all(text, '{whole}', 2)))) as nth from d
        where regexp_matches(text, '{_quoted(pattern)}')""")
    base = len(secrets.BASE)
    counts = ", ".join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in secrets.BASE)
    per = ", ".join(f"count(*) filter (kind = {i}) as n_{k}" for i, k in enumerate(secrets.BASE))
    names = "[" + ", ".join(f"'{k}'" for k, _, _ in secrets.KINDS) + "]"
    return f"""
    with d as (select row_number() over () as id, doc_id, coalesce(text, '') as text, coalesce(source, '?null') as owner,
            concat_ws('/', source, lang) as repo from documents),
    m as ({" union all ".join(parts)}),
    p as (select *, sum(length(gap) + length(hit)) over (partition by id, kind order by nth) as stop from m),
    s as (select id, kind, (stop - length(hit))::bigint as start, stop::bigint as stop, value from p
        where length(value) >= least and (kind < {base} or (regexp_matches(value, '[0-9]')
            and regexp_matches(value, '[A-Z]') and regexp_matches(value, '[a-z]')))),
    o as (select value, count(distinct owner) as owners from s join d using (id) group by value),
    j as (select s.*, owners >= {secrets.COPIED_OWNERS} as copied, owners = 1 and regexp_matches(value, '[0-9]')
            and regexp_matches(value, '[A-Za-z]') as live from s join o using (value)),
    k as (select * from j where kind < {base} or (live and not exists (select 1 from j b where b.id = j.id
            and b.kind < {base} and b.start < j.stop and j.start < b.stop))),
    a as (select id, {per}, count(*) filter (live) as n_live, count(*) filter (copied) as n_copied,
            string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' order by start, kind) filter (kind < {base}) as base,
            string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' order by start, kind) as spans
        from k group by id)
    select doc_id, {counts}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
        coalesce(n_live, 0)::bigint as n_live, coalesce(n_copied, 0)::bigint as n_copied from d left join a using (id)"""


def _permuted(x: str, n: str, salt: str) -> str:
    """The permutation of mixing.permute_round as a fold over the round numbers."""
    one = mixing.permute_round("x", f"({n})::bigint", salt, "r", "('0x' || {})::bigint")
    steps = ", ".join(map(str, range(mixing.ROUNDS)))
    return f"list_reduce([({x})::bigint, {steps}], lambda x, r : {one})"


def _mix() -> str:
    n, w = mixing.BLOCK_WORDS, "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    words = f"len(regexp_extract_all(coalesce(text, ''), '{WORD}'))"
    salt = f"({mixing.SEED} + rank * 7919 + pass * 104729)"
    return f"""
    with d as (select doc_id, source, {words}::bigint as size,
            coalesce(('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint, 0) as h from documents),
    t as (select source, sum(size)::bigint as source_size from d group by source),
    r as (select *, row_number() over (order by source nulls last) - 1 as rank from t),
    u as (select *, {w}[rank % {len(mixing.WEIGHTS)} + 1] as w, source_size * {mixing.CAP} as most from r),
    v as (select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / w, rank
            rows between unbounded preceding and 1 preceding), 0))::double
        / (sum(w) over () - coalesce(sum(w) over (order by most / w, rank
            rows between unbounded preceding and 1 preceding), 0))::double as level from u),
    l as (select level from v where level <= most / w order by most / w, rank limit 1),
    g as (select v.* exclude (level), least(most::double, l.level * w) as target from v, l),
    h as (select *, floor(target + 1e-9)::bigint as goal from g),
    p as (select *, case when source_size > 0 then goal // source_size else 0 end as passes,
        ceil(source_size / {n})::bigint as blocks, source_size // {n} as full_blocks from h),
    q as (select *, goal - passes * source_size as rest from p),
    s as (select *, passes * blocks + ceil(rest / {n})::bigint as slots from q),
    s2 as (select *, greatest(1, ceil(sum(slots) over () / {mixing.SHARD_SLOTS}))::bigint as shards from s),
    e as (select *, unnest(range(slots)) as nth from s2),
    e2 as (select *, nth // blocks as pass, nth % blocks as pos, greatest(full_blocks, 1) as n from e),
    e3 as (select rank, case when pos < full_blocks then {_permuted('pos', 'n', salt)} else pos end as block,
        least({n}, case when pass < passes then {n} else rest - pos * {n} end) as words,
        ('0x' || {mixing.shard_draw(mixing.SEED)})::bigint % shards as shard from e2),
    b as (select greatest(1, ceil(count(*) / {mixing.BUCKET_ROWS})::bigint) as buckets from d),
    f as (select d.*, rank, source_size, target, (coalesce(sum(size) over (partition by rank order by h % buckets, doc_id, size
        rows between unbounded preceding and 1 preceding), 0))::bigint as start
        from d join s2 x on d.source is not distinct from x.source and d.size >= 0, b),
    f2 as (select *, unnest(range(start // {n}, (start + size - 1) // {n} + 1)) as block from f where size > 0),
    k as (select doc_id, sum(greatest(0, least(start + size, f2.block * {n} + words) - greatest(start, f2.block * {n})))::bigint
            as taken, min(case when least(start + size, f2.block * {n} + words) > greatest(start, f2.block * {n}) then shard end)
            as first_shard
        from f2 join e3 on f2.rank = e3.rank and f2.block = e3.block group by doc_id)
    select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken, coalesce(first_shard, -1)::bigint as first_shard, source
    from f left join k using (doc_id)"""


def _chat() -> str:
    def esc(x: str) -> str:
        return f"regexp_replace({x}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"

    end = f"'{chat.END}' || chr(10)"
    return f"""
    with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    r as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as nth from t),
    l as (select *, lag(role) over (partition by conv_id order by nth) as before from r),
    p as (select *, case when before = role then '{chat.MORE}' else case when nth > 1 then {end} else '' end
        || '{chat.TURN}' || replace({esc('role')}, chr(10), '{chat.LINE}') || chr(10) end || {esc('text')} as piece from l)
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by nth)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = '{chat.LOSS_ROLE}'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by nth) filter (role = '{chat.LOSS_ROLE}'), '')) as loss_sha256,
        (sum(length(piece)) + {len(chat.END) + 1})::bigint as formatted_chars,
        coalesce(sum(length({esc('text')})) filter (role = '{chat.LOSS_ROLE}'), 0)::bigint as masked_chars
    from p group by conv_id"""


def _search() -> str:
    return f"""
    with v as (select row_number() over () as n, vec_id, list_transform(embedding, lambda x : floor({search.SCALE} * x::double)::bigint) as e
        from embeddings where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0),
    s as (select q.n as q, q.vec_id as query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint as score
        from v q join v c on q.vec_id % {search.QUERY_MOD} = 0 and q.n <> c.n),
    r as (select *, row_number() over (partition by q order by score desc, vec_id) as rank from s)
    select query_id, rank::int as rank, vec_id, score from r where rank <= {search.K}"""


def _manifest() -> str:
    def h(x: str) -> str:
        return f"sha256({x})"

    def leaf(more: str = "") -> str:
        cols = [f"({c}{more if c == 'n_chars' else ''})::varchar" for c in manifest.FIELDS]
        return h(" || ".join(f"case when {c} is null then '-' else strlen({c}) || ':' || {c} end" for c in cols))

    # CRC-32 of the decimal digits, bit by bit; 3988292384 is its reversed polynomial
    bits = ("list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k : "
            "case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)")
    crc = ("xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), "
           f"lambda c : ascii(c)::bigint)), lambda a, b : {bits}), 4294967295)")

    def tree(name: str, rows: str) -> str:
        """The levels of each grp of rows (grp, list), as (grp, level, list)."""
        one = "coalesce(list[2 * i + 1], '') || coalesce(list[2 * i + 2], '')"
        return f"""{name} as ({rows} union all
            select grp, level + 1, list_transform(range((len(list) + 1) // 2), lambda i : {h(one)}) from {name} where len(list) > 1)"""

    def steps(pos: str, levels: str) -> str:
        """(left, right) of every level that has more than one node."""
        at = f"({pos} // (1 << l.level)::bigint)"
        return (f"list_transform(list_filter({levels}, lambda l : len(l.list) > 1), lambda l : struct_pack("
                f"lft := case when {at} % 2 = 1 then l.list[{at}] else '' end, "
                f"rgt := case when {at} % 2 = 0 then coalesce(l.list[{at} + 2], '') else '' end))")

    return f"""
    with recursive d as (select doc_id, lang, {leaf()} as leaf, case when {crc} % {manifest.TAMPER_MOD} = 0
            then {leaf(' + 1')} else {leaf()} end as start from documents),
    r as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from d),
    l as (select lang, list(leaf order by pos) as list from r group by lang),
    g as (select lang, list, row_number() over (order by lang nulls first) - 1 as grp from l),
    {tree('t', 'select grp, 0 as level, list from g')},
    s as (select grp, list[1] as subroot from t where len(list) = 1),
    {tree('u', 'select 0 as grp, 0 as level, list(subroot order by grp) as list from s')},
    tl as (select grp, list(struct_pack(level := level, list := list) order by level) as levels from t group by grp),
    ul as (select list(struct_pack(level := level, list := list) order by level) as tops, max(list[1]) filter (len(list) = 1) as root from u),
    p as (select r.*, s.subroot, ul.root, list_concat({steps('r.pos', 'tl.levels')}, {steps('g.grp', 'ul.tops')}) as path
        from r join g on r.lang is not distinct from g.lang join s on s.grp = g.grp join tl on tl.grp = g.grp, ul),
    f as (select *, list_reduce(list_concat([struct_pack(lft := start, rgt := '')], path),
            lambda a, b : struct_pack(lft := {h('b.lft || a.lft || b.rgt')}, rgt := '')).lft as folded_root from p)
    select doc_id, leaf, subroot, root, {h("coalesce(array_to_string(list_transform(path, lambda x : x.lft || x.rgt), ''), '')")} as proof_sha256,
        folded_root, folded_root = root as verified from f"""


ORACLE: dict[str, str] = {
    "op11_merkle_manifest": _manifest(),
    "op5_chat_format": _chat(),
    "op9_topk_search": _search(),
    "op2_secret_scan": _secrets(),
    "op10_mix_sources": _mix(),
}
