"""DuckDB SQL for the queries of this package that SQL can express, beside the shorter ones in ``queries``."""

from __future__ import annotations


def merkle(levels: int = 7, top_levels: int = 3) -> str:
    """op13 level by level: enough for 8 ** levels rows a language and 8 ** top_levels languages."""
    def field(e: str) -> str:
        return f"coalesce(strlen({e})::varchar || ':' || {e}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(e) for e in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    zeros = "[" + ", ".join(["0::bigint"] * 8) + "]"
    # crc32 bit by bit: eight shifts for each character of the decimal doc_id
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), {zeros}), lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)))"""
    ctes = [f"""hashed as materialized (select doc_id, lang, {leaf('text')} as leaf, case when doc_id is not null and {crc} % 3 = 0 then {leaf(lowered)} else {leaf('text')} end as folded from documents)""",
            "langs as materialized (select lang, row_number() over (order by lang nulls first) - 1 as tree from (select distinct lang from documents))",
            """p0 as materialized (select doc_id, leaf, folded, '' as proof, tree, tree as own, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos
            from hashed h join langs l on h.lang is not distinct from l.lang)""",
            "a0 as materialized (select tree, pos, leaf as digest, count(*) over (partition by tree) as size from p0)"]

    def climb(n: int) -> None:
        ctes.append(f"r{n} as materialized (select tree, size, pos // 8 as up, list(digest order by pos) as run from a{n} group by all)")
        ctes.append(f"a{n + 1} as materialized (select tree, up as pos, case when size = 1 then run[1] else sha256(array_to_string(run, '')) end as digest, (size + 7) // 8 as size from r{n})")
        before, after = "run[:pos % 8]", "run[pos % 8 + 2:]"
        ctes.append(f"""p{n + 1} as materialized (select doc_id, leaf, own, case when size = 1 then folded else sha256(array_to_string({before} || [folded] || {after}, '')) end as folded,
            proof || array_to_string({before} || {after}, '') as proof, p.tree, up as pos from p{n} p join r{n} r on p.tree = r.tree and p.pos // 8 = r.up)""")

    for n in range(levels):
        climb(n)
    top = levels + 1
    ctes.append(f"a{top} as materialized (select -1 as tree, tree as pos, digest, count(*) over () as size from a{levels})")
    ctes.append(f"p{top} as materialized (select doc_id, leaf, own, folded, proof, -1 as tree, own as pos from p{levels})")
    for n in range(top, top + top_levels):
        climb(n)
    last = top + top_levels
    return f"""with {', '.join(ctes)}
        select doc_id, leaf, s.digest as subroot, a.digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = a.digest as verified
        from p{last} p join a{levels} s on s.tree = own cross join a{last} a"""


def ranked_search() -> str:
    """op11 by scoring every document that shares a term with an item."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"translate(unnest(regexp_extract_all(text, '{pattern}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""with docs as (select row_number() over () as d, doc_id, text from documents),
        occurrences as (select d, {terms} as term from docs),
        lengths as (select d, count(*) as n from occurrences group by d),
        sums as (select count(*) as docs, sum(n)::bigint as terms from lengths),
        tfs as (select d, term, count(*) as tf from occurrences group by d, term),
        dfs as (select term, count(*) as df from tfs group by term),
        items as (select row_number() over () as i, item_id, text from benchmark),
        asked as (select distinct i, term from (select i, {terms} as term from items)),
        scores as (select i, d, sum(floor(1000 * ln((2 * s.docs + 2) / (2 * df + 1)))::bigint * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * s.docs) // s.terms))))::bigint as score
            from asked join dfs using (term) join tfs using (term) join lengths using (d) cross join sums s group by i, d),
        ranked as (select i, doc_id, score, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scores join docs using (d) where score > 0)
        select item_id, rank, doc_id, score from ranked join items using (i) where rank <= 10"""


def bm25_topk() -> str:
    """op7 by scoring every document that shares a term with a query."""
    terms = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))"
    return f"""with docs as (select row_number() over () as d, doc_id, text from documents),
        occurrences as (select d, {terms} as term from docs),
        tfs as (select d, term, count(*) as tf from occurrences group by d, term),
        lengths as (select d, sum(tf) as n from tfs group by d),
        sums as (select (select count(*) from docs) as docs, greatest(1.0, (select count(*) from occurrences)::double / (select count(*) from docs)) as mean),
        dfs as (select term, count(*) as df from tfs group by term),
        asked as (select distinct doc_id as query_id, term from tfs join docs using (d) where doc_id % 50 = 0),
        scores as (select query_id, d, round(sum(ln(1 + (s.docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / s.mean))), 6) as score
            from asked join dfs using (term) join tfs using (term) join lengths using (d) cross join sums s group by query_id, d),
        ranked as (select query_id, row_number() over (partition by query_id order by score desc, doc_id nulls last) as rank, doc_id, score from scores join docs using (d) where score > 0)
        select query_id, rank, doc_id, score from ranked where rank <= 10"""
