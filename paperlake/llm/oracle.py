"""Registered queries as SQL for DuckDB, where SQL can express them on whole tables."""

from __future__ import annotations

_WORDS = r"[\x20\x09-\x0D]+"
_LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _word_lists(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{_WORDS}'), lambda x: x <> '')"


_NGRAM_JOIN = f"""
  with recursive docs as (select doc_id, {_word_lists(_LOWERED.format("coalesce(text, '')"))} as words from documents),
  sets as (
    select doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
      lambda i: array_to_string(words[i:i + 4], ' '))) as shingles
    from docs where len(words) > 0),
  texts as (select min(doc_id) as node, list_sort(shingles) as shingles from sets group by all),
  held as (select node, len(shingles) as n, unnest(shingles) as shingle from texts),
  links as (
    select a.node as a, b.node as b from held a join held b on a.shingle = b.shingle and a.node < b.node
    group by a.node, b.node, a.n, b.n
    having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  edges as (select a, b from links union select b, a from links),
  reach as (select a as node, b as other from edges union select r.node, e.b from reach r join edges e on r.other = e.a),
  found as (select node, least(node, min(other)) as component from reach group by node)
  select d.doc_id, coalesce(len(s.shingles), 0) as n_shingles,
    coalesce(f.component, t.node, d.doc_id) as component_id
  from docs d left join sets s using (doc_id)
  left join texts t on list_sort(s.shingles) = t.shingles
  left join found f on f.node = t.node"""


_NEIGHBOURS = """
  with usable as (
    select vec_id, embedding::double[] as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  scores as (
    select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(
      list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) as score
    from usable q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0)
  select query_id, cast(row_number() over nearest as integer) as rank, vec_id, score
  from scores window nearest as (partition by query_id order by score, vec_id) qualify rank <= 10"""


_REVISITS = """
  with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages),
  hashed as (
    select page_id, strlen(payload) as payload_bytes, translate(
      array_to_string(list_transform(range(8),
        lambda i: to_base(cast('0x' || substr(digest, 1 + 5 * i, 5) as bigint), 32, 4)), ''),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest
    from payloads),
  firsts as (select *, min(page_id) over (partition by payload_digest, payload_bytes) as first from hashed)
  select page_id, payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
  from firsts"""

_MIXTURE = """
  with sizes as (select source, count(*) as n_docs from documents group by source),
  rates as (
    select source, pow(n_docs, 0.5) / sum(pow(n_docs, 0.5)) over () * sum(n_docs) over () / n_docs as rate
    from sizes),
  steps as (
    select source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as step
    from (select source, rate, unnest(range(0, cast(ceil(rate + 12 * sqrt(rate) + 30) as bigint) + 1)) as k from rates)),
  cdf as (select source, list(step order by k) as steps from steps group by source),
  drawn as (
    select d.*, cast('0x' || substr(md5(doc_id || ':17'), 1, 13) as bigint) / 4503599627370496.0 as u, steps
    from documents d join cdf using (source)),
  copied as (
    select doc_id, text, lang, source, n_chars, unnest(range(1, len(list_filter(steps, lambda s: s <= u)) + 1)) as copy
    from drawn)
  select doc_id, text, lang, source, n_chars, cast(copy as integer) as copy,
    substr(md5(doc_id || ':' || copy || ':17'), 1, 16) as shuffle_key
  from copied"""


def _labelled(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || cast({value} as varchar), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_labelled, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# crc32 bit by bit: eight steps a byte over the decimal digits of doc_id.
_CRC_STEP = "case when {0} % 2 = 1 then xor({0} >> 1, 3988292384) else {0} >> 1 end"
_MANIFEST = f"""
  with recursive digits as (
    select doc_id, cast(doc_id as varchar) as d from documents),
  crc as (
    select doc_id, d, 0 as pos, 0 as bit, 4294967295::bigint as c from digits
    union all
    select doc_id, d, pos + (bit = 8)::int, case when bit = 8 then 0 else bit + 1 end,
      case when bit = 0 then xor(c, ascii(d[pos + 1])::bigint) else {_CRC_STEP.format("c")} end
    from crc where pos < length(d)),
  touched as (select doc_id from crc where pos = length(d) and xor(c, 4294967295::bigint) % 7 = 0),
  leaves as (
    select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as i,
      count(*) over (partition by lang) as n, {_leaf("n_chars")} as h, {_leaf("(n_chars + 1)")} as changed
    from documents),
  trees as (
    select lang, 0 as level, i, n, h from leaves
    union all
    select lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i))
    from trees where n > 1 group by lang, level, i // 2, n),
  subroots as (
    select lang, h, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n
    from trees where n = 1),
  over as (
    select 0 as level, i, n, h from subroots
    union all
    select level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i))
    from over where n > 1 group by level, i // 2, n),
  root as (select h from over where n = 1),
  heights as (select lang, max(level) as height from trees group by lang),
  steps as (
    select l.doc_id, t.level, t.h as sibling, l.i >> t.level as place
    from leaves l join (select distinct lang, level, n from trees where n > 1) s on s.lang is not distinct from l.lang
    left join trees t on t.lang is not distinct from l.lang and t.level = s.level and t.i = xor(l.i >> s.level, 1)
    where t.h is not null
    union all
    select l.doc_id, k.height + o.level, o.h, r.i >> o.level
    from leaves l join heights k on k.lang is not distinct from l.lang
    join subroots r on r.lang is not distinct from l.lang
    join over o on o.n > 1 and o.i = xor(r.i >> o.level, 1)),
  proofs as (select doc_id, sha256(string_agg(sibling, '' order by level)) as proof from steps group by doc_id),
  tops as (select max(level) as top from over),
  fold as (
    select l.doc_id, 0 as level, k.height + (select top from tops) as height,
      case when t.doc_id is not null and l.changed is not null and d.n_chars is not null then l.changed else l.h end as h
    from leaves l join heights k on k.lang is not distinct from l.lang join documents d using (doc_id)
    left join touched t on t.doc_id = l.doc_id
    union all
    select f.doc_id, f.level + 1, f.height, case when s.sibling is null then sha256(f.h)
      when s.place % 2 = 1 then sha256(s.sibling || f.h) else sha256(f.h || s.sibling) end
    from fold f left join steps s on s.doc_id = f.doc_id and s.level = f.level where f.level < f.height),
  ends as (select doc_id, h from fold where level = height)
  select l.doc_id, l.h as leaf, r.h as subroot, root.h as root, coalesce(p.proof, sha256('')) as proof_sha256,
    e.h as folded_root, e.h = root.h as verified
  from leaves l join subroots r on r.lang is not distinct from l.lang cross join root
  join ends e using (doc_id) left join proofs p using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": _NGRAM_JOIN,
        "op4_revisits": _REVISITS,
        "op6_poisson_mixture": _MIXTURE,
        "op9_block_matrix": _NEIGHBOURS,
        "op13_interval_manifest": _MANIFEST,
    }
