"""Check SQL (DuckDB) of the collocation and manifest queries."""

COLLOCATIONS = r"""
with recursive pieces as (
  select coalesce(lang, 'und') as lang, doc_id, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
starts as (select lang, w, unnest(generate_series(1, len(w))) as i from words where len(w) > 0),
grams as (
  select lang, w[i] as w1, cast(null as varchar) as w2, cast(null as varchar) as w3 from starts
  union all select lang, w[i], w[i + 1], null from starts where i + 1 <= len(w)
  union all select lang, w[i], w[i + 1], w[i + 2] from starts where i + 2 <= len(w)),
f as (select lang, w1, w2, w3, count(*)::hugeint as f from grams group by all),
total as (select lang, sum(f)::hugeint as n from f where w2 is null group by lang),
one as (select lang, w1, f from f where w2 is null),
two as (select lang, w1, w2, f from f where w2 is not null and w3 is null),
three as (select * from f where w3 is not null and f >= 10),
cuts as (
  select p.lang, p.w1 || ' ' || p.w2 as phrase, p.f as a, x.f as l, y.f as r, 1 as k
  from two p join one x on x.lang = p.lang and x.w1 = p.w1 join one y on y.lang = p.lang and y.w1 = p.w2
  where p.f >= 10 and not exists (
    select 1 from three t where t.lang = p.lang and 100 * t.f >= 50 * p.f
      and ((t.w1 = p.w1 and t.w2 = p.w2) or (t.w2 = p.w1 and t.w3 = p.w2)))
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  from three t join one x on x.lang = t.lang and x.w1 = t.w1 join two y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  from three t join two x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join one y on y.lang = t.lang and y.w1 = t.w3),
scored as (select *, (1000000 * a * a) // (l * r) as score from cuts),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join total using (lang) where rank <= 2000
"""


def _field(name: str) -> str:
    return f"case when {name} is null then '-' else strlen({name}::varchar) || ':' || {name}::varchar end"


def manifest_sql(levels: int = 14) -> str:
    """Trees of up to 3 ** levels leaves, one query block per level.

    Each level keeps, per node, its digest and that of its run; proofs are folded upwards
    along the ranks, so this is another way to the result than the descent.
    """
    first = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    cut = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _field("replace(text, chr(10), '')")
    ctes = [
        "base as materialized (select row_number() over (order by doc_id) as row_no, * from documents)",
        # CRC-32 of the decimal key: of nine steps a byte, the first mixes it in and eight shift
        "crc(row_no, digits, step, value) as (select row_no, doc_id::varchar, 0, 4294967295::bigint from base union all "
        "select row_no, digits, step + 1, case when step % 9 = 0 then xor(value, ascii(digits[step // 9 + 1])::bigint) "
        "when value % 2 = 1 then xor(value // 2, 3988292384) else value // 2 end from crc where step < 9 * len(digits))",
    ]
    ctes.append(
        "even as (select row_no, xor(value, 4294967295) % 2 = 0 as even from crc where step = 9 * len(digits))"
    )
    ctes.append(
        f"leaves as materialized (select row_no, doc_id, case when source is null then '' else '>' || source end as g, sha256({first}) as d, "
        f"case when even and text is not null then sha256({cut}) else sha256({first}) end as t from base join even using (row_no))"
    )
    ctes.append("l0 as materialized (select g, row_number() over (partition by g order by doc_id, d) - 1 as i, d, row_no from leaves)")

    def tree(prefix: str, group: str) -> None:
        for k in range(levels):
            ctes.append(
                f"{prefix}{k + 1} as materialized (select {group}, i // 3 as i, sha256(string_agg(d, '' order by i)) as d from {prefix}{k} "
                f"where {group} in (select {group} from {prefix}{k} where i = 1) group by {group}, i // 3)"
            )

    tree("l", "g")
    ctes.append("subs as materialized (" + " union all ".join(
        f"select g, d from l{k} where i = 0 and g not in (select g from l{k} where i = 1)" for k in range(levels + 1)) + ")")
    ctes.append("s0 as materialized (select 0 as z, row_number() over (order by g) - 1 as i, d, g from subs)")
    tree("s", "z")
    ctes.append("root as (" + " union all ".join(
        f"select d from s{k} where i = 0 and z not in (select z from s{k} where i = 1)" for k in range(levels + 1)) + ")")

    def climb(prefix: str, group: str, source: str, key: str) -> str:
        last = source
        for k in range(levels):
            node = f"{prefix}{k}"
            sides = (
                f"select {group}, i, coalesce(string_agg(d, '' order by i) over (partition by {group}, i // 3 order by i rows between unbounded preceding and 1 preceding), '') as before, "
                f"coalesce(string_agg(d, '' order by i) over (partition by {group}, i // 3 order by i rows between 1 following and unbounded following), '') as after "
                f"from {node} where {group} in (select {group} from {node} where i = 1)"
            )
            name = f"c{prefix}{k}"
            ctes.append(
                f"{name} as materialized (select c.* exclude (p, f, i, before, after), c.i // 3 as i, p || coalesce(before, '') || coalesce(after, '') as p, "
                f"case when before is null then f else sha256(before || f || after) end as f from "
                f"(select c.*, x.before, x.after from {last} c left join ({sides}) x on c.{group} = x.{group} and c.i = x.i) c)"
            )
            last = name
        return last

    ctes.append("w0 as materialized (select l0.row_no, l0.g, l0.i, '' as p, t as f from l0 join leaves using (row_no))")
    done = climb("l", "g", "w0", "g")
    ctes.append(f"w1 as materialized (select c.row_no, 0 as z, s0.i, c.p, c.f, s0.d as subroot from {done} c join s0 on c.g = s0.g)")
    done = climb("s", "z", "w1", "z")
    return "with recursive " + ",\n".join(ctes) + (
        f"\nselect doc_id, leaves.d as leaf, subroot, root.d as root, sha256(c.p) as proof_sha256, c.f as folded_root, c.f = root.d as verified "
        f"from {done} c join leaves using (row_no), root"
    )
