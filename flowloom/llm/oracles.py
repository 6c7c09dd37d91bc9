"""DuckDB text of the operators that SQL can express, stated over plain tables without their methods."""

from __future__ import annotations

from flowloom.llm.mixing import DIMENSIONS
from flowloom.llm.secrets import ASSIGN, MIXED

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(separator: str) -> str:
    return f"list_filter(string_split_regex({_LOWER}, '{separator}'), lambda x: x <> '')"


def _secret_sql() -> str:
    """Every match with its place; mixed tokens count where few owners have them and no base span touches."""
    kinds = [("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16), ("owned", MIXED, 0, 20)]
    parts = []
    for k, (_, pattern, group, least) in enumerate(kinds, 1):
        p = _quoted(pattern)
        parts.append(
            f"select doc_id, source, {k} as kind, {least} as least, string_split_regex(coalesce(text, ''), {p}) as gaps,"
            f" regexp_extract_all(coalesce(text, ''), {p}) as found, regexp_extract_all(coalesce(text, ''), {p}, {group}) as vals from documents"
        )
    names = "case kind " + " ".join(f"when {k} then '{name}'" for k, (name, *_) in enumerate(kinds, 1)) + " end"
    return f"""
with pieces as ({" union all ".join(parts)}),
matches as (
  select doc_id, source, kind, least, gaps, found, vals, unnest(range(1, len(found) + 1)) as i from pieces where len(found) > 0),
placed as (
  select doc_id, coalesce(source, '') as owner, kind, vals[i] as val,
    cast(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as bigint) as a,
    length(found[i]) as n from matches where length(vals[i]) >= least),
spans as (select doc_id, owner, kind, val, a, a + n as b from placed),
likely as (
  select * from spans s where kind < 4 or (regexp_matches(val, '[0-9].*[0-9].*[0-9].*[0-9]')
    and regexp_matches(val, '[A-Za-z].*[A-Za-z].*[A-Za-z].*[A-Za-z]')
    and not exists (select 1 from spans t where t.doc_id = s.doc_id and t.kind < 4 and t.a < s.b and t.b > s.a))),
judged as (select l.*, o.owners <= 2 as live from likely l join (select val, count(distinct owner) as owners from likely group by val) o using (val)),
texts as (
  select doc_id, count(*) filter (kind = 1) as n_assign, count(*) filter (kind = 2) as n_access, count(*) filter (kind = 3) as n_hex,
    string_agg({names} || ':' || a || ':' || b, ',' order by a, kind) filter (kind < 4) as base,
    string_agg({names} || ':' || a || ':' || b, ',' order by a, kind) filter (kind < 4 or live) as spans,
    count(*) filter (live) as n_live, count(*) filter (not live) as n_copied from judged group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from documents left join texts using (doc_id)"""


NEAR = f"""
with recursive w as materialized (select doc_id, {_words(r"[\x20\x09-\x0D]+")} as w from documents),
sh as materialized (
  select distinct doc_id, array_to_string(w[s + 1:s + least(5, len(w))], ' ') as g
  from (select doc_id, w, unnest(range(greatest(1, len(w) - 4))) as s from w where len(w) > 0)),
sizes as materialized (select doc_id, count(*) as n from sh group by doc_id),
pairs as materialized (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as materialized (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as materialized (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
roots as (select a as doc_id, least(a, min(b)) as root from reach group by a)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(root, doc_id) as component_id, doc_id = coalesce(root, doc_id) as kept
from documents left join sizes using (doc_id) left join roots using (doc_id)"""


def _mixing_sql(sweeps: int = 10, rounds: int = 8, share: float = 0.5) -> str:
    ctes = [
        """rows as materialized (
  select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang,
    case when coalesce(text, '') = '' then '(none)' when contains(text, ' | ') then 'table'
      when regexp_matches(text, '(?i)licen[cs]ed? |rights reserved') then 'legal' when contains(text, '@') then 'contact' else 'prose' end as topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens from documents)""",
        "c0 as materialized (select source, lang, topic, sum(n_tokens)::double as tokens, sum(n_tokens)::double as weight from rows group by all)",
    ]
    for dim in DIMENSIONS:
        ctes.append(
            f"t_{dim} as materialized (select {dim}, sqrt(sum(tokens)) / nullif((select sum(x) from (select sqrt(sum(tokens)) as x from c0 group by {dim})), 0)"
            f" as target from c0 group by {dim})"
        )
    n = 0
    for _ in range(sweeps):
        for dim in DIMENSIONS:
            ctes.append(
                f"c{n + 1} as materialized (select source, lang, topic, tokens, case when s > 0 then weight * (coalesce(target, 0) / s) else 0 end as weight"
                f" from c{n} join (select {dim}, sum(weight) as s from c{n} group by {dim}) using ({dim}) left join t_{dim} using ({dim}))"
            )
            n += 1
    ctes.append(f"rated as materialized (select *, case when tokens > 0 then weight / tokens else 0 end as ratio from c{n})")
    ctes.append(f"s0 as materialized (select {share} * coalesce(sum(tokens), 0) as scale from rated)")
    for k in range(rounds):
        ctes.append(
            f"s{k + 1} as materialized (select case when capped > 0 and free > 0 then greatest(scale, ({share} * total - capped) / free) else scale end as scale"
            f" from (select scale, sum(tokens) as total, sum(tokens) filter (ratio * scale >= 1) as capped, sum(weight) filter (ratio * scale < 1) as free"
            f" from rated, s{k} group by scale))"
        )
    ctes.append(f"p as (select source, lang, topic, weight, case when tokens > 0 then least(1.0, ratio * scale) else 1.0 end as p from rated, s{rounds})")
    draw = "cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8)) as bigint) / 4294967296.0"
    return f"""with {", ".join(ctes)}
select doc_id, source, lang, topic, n_tokens, round(weight, 9) as weight, round(p, 6) as p, {draw} < p as sampled
from rows join p using (source, lang, topic)"""


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(hex, {5 * k + 1}, 5) as bigint) >> {s}) & 31)::int, 1)" for k in range(8) for s in (15, 10, 5, 0)
)
WARC = f"""
with hashed as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
owned as (select *, max(page_id) over (partition by hex) as owner from hashed)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = owner then 'response' else 'revisit' end as record_type, case when page_id <> owner then owner end as refers_to from owned"""

LEAKS = f"""
with d as materialized (select doc_id, {_words(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")} as w from documents),
i as (select coalesce(cast(item_id as varchar), 'null') as item, {_words(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")} as w from benchmark),
grams as materialized (
  select distinct item, n, array_to_string(w[s + 1:s + n], ' ') as g
  from (select item, w, least(10, len(w)) as n, unnest(range(len(w) - least(10, len(w)) + 1)) as s from i where len(w) > 0)),
places as materialized (
  select doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') as g
  from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as s from d, (select distinct n from grams) where len(w) >= n)),
hits as materialized (select doc_id, item, s, places.n from places join grams on places.g = grams.g and places.n = grams.n),
found as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by doc_id),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated from d left join found using (doc_id) left join covered using (doc_id)"""

NEAREST = """
with v as materialized (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20"""

ORACLE = {
    "op1_secret_scan": _secret_sql(),
    "op4_near_dedup": NEAR,
    "op5_mixing": _mixing_sql(),
    "op6_warc": WARC,
    "op8_decontaminate": LEAKS,
    "op9_knn": NEAREST,
}
