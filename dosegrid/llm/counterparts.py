"""DuckDB counterparts of the URL filters, the manifest and the vector codes."""

from __future__ import annotations

from dosegrid.llm import codes, manifest, reputation

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def reputation_sql() -> str:
    """Counts by host, domain and suffix, the priors level by level, then each page's rule or bound."""
    low, high = reputation.WEIGHTS
    z = reputation.DEVIATIONS

    def shrunk(name: str, groups: str) -> str:
        spread = "(sum(seen * (bad / seen - above) * (bad / seen - above) / (above * (1 - above))) - count(*)) / nullif(sum(seen - 1), 0)"
        weight = f"select coalesce(case when rho <= 0 then {high} else least(greatest(1 / rho - 1, {low}), {high}) end, {high}) as weight from (select {spread} as rho from {groups} where seen > 0)"
        return f"{name} as (select g.*, weight, (bad + weight * above) / (seen + weight) as mean from {groups} g, ({weight}))"

    last = lambda n: f"array_to_string(names[greatest(len(names) - {n - 1}, 1):], '.')"
    two = ", ".join(f"'{s}'" for s in reputation.SUFFIXES)
    number = "regexp_matches(bare, '^[0-9]+(\\.[0-9]+){3}$')"
    ruled = "null"
    for r in sorted(reputation.RULES, key=lambda r: (len(r.text), r.text)):
        name, _, rest = r.text.partition("/")
        ruled = f"case when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{rest}') then '{r.text}' else {ruled} end"
    verdicts = " ".join(f"when '{r.text}' then '{r.verdict}'" for r in reputation.RULES)
    m, n = "mean", "(seen + weight)"
    bound = f"({m} + {z * z} / (2 * {n}) - {z} * sqrt({m} * (1 - {m}) / {n} + {z * z} / (4 * {n} * {n}))) / (1 + {z * z} / {n})"
    return f"""with p as (select page_id, coalesce({_LOWER.format("regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)")}, '') as host, coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages),
ids as (select doc_id as page_id, count(bad)::double as seen, count(*) filter (where bad)::double as bad from (select doc_id, quality = 0 or toxic = 1 as bad from labels) where doc_id is not null and bad is not null group by 1),
h as (select host, coalesce(sum(seen), 0) as seen, coalesce(sum(bad), 0) as bad from p left join ids using (page_id) group by 1),
named as (select host, seen, bad, bare, string_split(bare, '.') as names from (select *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as bare from h)),
n as (select host, seen, bad, case when {number} then bare when {last(2)} in ({two}) then {last(3)} else {last(2)} end as domain, case when {number} then bare when {last(2)} in ({two}) then {last(2)} else {last(1)} end as suffix from named),
su as (select suffix, sum(seen) as seen, sum(bad) as bad, (select (sum(bad) + 0.5) / (sum(seen) + 1) from n) as above from n group by 1),
{shrunk("su2", "su")},
dom as (select n.suffix, domain, sum(n.seen) as seen, sum(n.bad) as bad, max(su2.mean) as above from n join su2 on su2.suffix = n.suffix group by 1, 2),
{shrunk("dom2", "dom")},
ho as (select host, n.seen, n.bad, dom2.mean as above from n join dom2 on dom2.domain = n.domain),
{shrunk("ho2", "ho")},
j as (select page_id, p.host, path, {ruled.replace("host", "p.host")} as rule, mean, {bound} as bound from p join ho2 on ho2.host = p.host)
select page_id, host, path, rule, case rule {verdicts} else case when bound > {reputation.TOLERATED} then 'block' else 'allow' end end as verdict, round(mean, 6) as bad_share, round(bound, 6) as bad_bound from j"""


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs of nodes by level (g, n, r, d), each node's siblings (g, r, a, b), and the top of each group."""
    out = [f"{name}0 as (select g, n, r, d from {leaves})"]
    for k in range(1, levels + 1):
        out.append(f"{name}{k} as (select g, n, r // 8 as r, sha256(string_agg(d, '' order by r)) as d from {name}{k - 1} where n > {8 ** (k - 1)} group by 1, 2, 3)")
    for k in range(levels):
        side = lambda frame: f"coalesce(string_agg(d, '') over (partition by g, r // 8 order by r rows between {frame}), '')"
        out.append(f"{name}s{k} as (select g, r, {side('unbounded preceding and 1 preceding')} as a, {side('1 following and unbounded following')} as b from {name}{k} where n > {8**k})")
    tops = " union all ".join(f"select g, d from {name}{k} where n <= {8**k}" + (f" and n > {8 ** (k - 1)}" if k else "") for k in range(levels + 1))
    return ", ".join([*out, f"{name}top as ({tops})"])


def manifest_sql(levels: int = 8, over: int = 3) -> str:
    """For 8 ** levels documents of a language and 8 ** over languages at most."""

    def leaf(columns: dict[str, str]) -> str:
        return "sha256(" + " || ".join(f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end" for c in columns.values()) + ")"

    fields = {c: c for c in manifest.FIELDS}
    crc = "xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(1, length(s) + 1), lambda i: list_concat([ascii(s[i])::bigint], [-1, -1, -1, -1, -1, -1, -1, -1]::bigint[])))), lambda c, v: case when v >= 0 then xor(c, v) else xor(c >> 1, 3988292384::bigint * (c & 1)) end), 4294967295::bigint)"
    joins, folds = "", []
    pieces = []
    for k in range(levels + over):
        t, j, row = ("t", k, "l") if k < levels else ("u", k - levels, "o")
        on = f"on {t}s{j}.g = {row}.g and {t}s{j}.r = {row}.r // {8**j}"
        joins += f" left join {t}s{j} {on}"
        pieces.append(f"coalesce({t}s{j}.a || {t}s{j}.b, '')")
        folds.append(f"{t}s{j}.a as a{k}, {t}s{j}.b as b{k}")
    steps = []
    for k in range(levels + over):
        steps.append(f"f{k + 1} as (select * replace (case when a{k} is null then given else sha256(a{k} || given || b{k}) end as given) from f{k})")
    return f"""with raw as (select doc_id, case when lang is null then '' else '+' || lang end as g, {leaf(fields)} as d, {leaf(fields | {"text": _LOWER.format("text")})} as changed, coalesce(doc_id::varchar, '') as s from documents),
le as (select doc_id, g, d, case when {crc} % 3 = 0 then changed else d end as given, row_number() over (partition by g order by doc_id nulls first, d) - 1 as r, count(*) over (partition by g) as n from raw),
{_tree("t", "le", levels)},
tops as (select '' as g, g as lang, d, row_number() over (order by g) - 1 as r, count(*) over () as n from ttop),
{_tree("u", "tops", over)},
f0 as (select l.doc_id, l.d as leaf, o.d as subroot, (select d from utop) as root, sha256({" || ".join(pieces)}) as proof_sha256, l.given, {", ".join(folds)} from le l join tops o on o.lang = l.g{joins}),
{", ".join(steps)}
select doc_id, leaf, subroot, root, proof_sha256, given as folded_root, given = root as verified from f{levels + over}"""


def codes_sql() -> str:
    """Each round is a table of nearest entries and a table of their means."""
    parts, entries, size = codes.PARTS, codes.ENTRIES, 8  # vectors of 64 numbers
    gap = f"list_sum(list_transform(range(1, {size + 1}), lambda i: (x.c[i] - b.c[i]) * (x.c[i] - b.c[i])))"
    means = ", ".join(f"floor(sum(c[{k}]) / count(*))::bigint" for k in range(1, size + 1))
    out = [
        f"kept as materialized (select row_number() over () as id, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::double)::bigint) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"x as materialized (select id, p, list_slice(v, p * {size} + 1, p * {size} + {size}) as c from kept, (select unnest(range({parts})) as p))",
        f"b0 as materialized (select p, e, list_slice(v, p * {size} + 1, p * {size} + {size}) as c from (select v, row_number() over (order by vec_id, v) - 1 as e from kept), (select unnest(range({parts})) as p) where e < {entries})",
    ]
    for k in range(codes.ROUNDS + 1):
        out.append(f"n{k} as materialized (select id, x.p as p, any_value(x.c) as c, min({gap} * {entries} + e)::bigint as m from x join b{k} b on b.p = x.p group by 1, 2)")
        if k < codes.ROUNDS:
            out.append(f"b{k + 1} as materialized (select b.p, b.e, coalesce(m.c, b.c) as c from b{k} b left join (select p, m % {entries} as e, [{means}] as c from n{k} group by 1, 2) m on m.p = b.p and m.e = b.e)")
    last = codes.ROUNDS
    out.append(f"r as (select id, string_agg(printf('%02x', m % {entries}), '' order by p) as code, sum(m // {entries})::bigint as error from n{last} group by 1)")
    out.append("s as (select vec_id, label, code, error from r join kept using (id))")
    return f"""with {", ".join(out)}
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, (select sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' order by p, e)) from b{last}) as codebooks_sha256 from s"""
