"""The registered queries as SQL for DuckDB, over the same tables.

Written from the rules, not from the Spark code; queries that only differ in how
Spark gets to the result share their SQL.
"""

from __future__ import annotations

# Characters Python's str.strip() removes, as a SQL expression.
_BLANKS = " || ".join(f"chr({i})" for i in range(0x3001) if chr(i).isspace())

_PROVIDERS = "['arxiv', 'pubmed', 'ieee', 'acm', 'springer']"
_ENABLED = "('arxiv', 'pubmed', 'ieee', 'acm')"
_CLEANED = ("title", "abstract", "full_text", "authors", "keywords")
_MASTER = (
    "id, doi, title, authors, abstract, full_text, journal, publication_date, keywords, "
    "pdf_url, pdf_s3_path, source, doi_valid"
)
_DATED = (
    "cast(year(publication_date) as integer) as year, cast(month(publication_date) as integer) as month, "
    "cast(day(publication_date) as integer) as day"
)


def _id(title: str, authors: str, date: str) -> str:
    def plain(x: str) -> str:
        return f"coalesce(trim(lower({x}), {_BLANKS}), '')"

    return f"sha256({plain(title)} || '||' || {plain(authors)} || '||' || coalesce({date}, ''))"


def _papers(edition: int) -> str:
    published = "(date '2024-01-01' + cast(n_chars % 60 as integer))"
    doc = f"(doc_id + {edition})"
    title = "split_part(text, chr(10), 1)"
    return f"""
      select doc_id, {_id(title, 'lang', f'cast({published} as varchar)')} as id,
        case {doc} % 5 when 0 then '10.' || (1000 + doc_id) || '/' || source
          when 1 then 'doi:10.1000/' || source when 2 then '10.12/' || source
          when 3 then '10.5555/' || lang || ' ' || source end as doi,
        {title} as title, lang as authors,
        case {doc} % 7 when 0 then 'null' when 1 then '   ' when 2 then null
          else split_part(text, chr(10), 2) end as abstract,
        text as full_text, 'J ' || source as journal, {published} as publication_date,
        case {doc} % 6 when 0 then 'NULL' when 1 then ' null ' when 2 then 'Null'
          else ' ' || lang || '; ' || source || ' ' end as keywords,
        case when {doc} % 4 <> 3 then 'https://example.org/' || doc_id || '.pdf' end as pdf_url,
        cast(null as varchar) as pdf_s3_path,
        {_PROVIDERS}[1 + (cast(substr(source, 4) as integer) + {edition}) % 5] as source
      from documents"""


def _clean(c: str) -> str:
    return f"case when {c} not in ('null', 'NULL') and trim({c}) <> '' then trim({c}) end"


_VALID_DOI = r"coalesce(regexp_matches(doi, '^10\.\d{4,}/.+'), false)"


def _refined(edition: int) -> str:
    cleaned = ", ".join(f"{_clean(c)} as {c}" for c in _CLEANED)
    return f"""
      select * replace (substr(abstract, 1, 50000) as abstract, substr(full_text, 1, 1000000) as full_text),
        {_VALID_DOI} as doi_valid, {_DATED}
      from (select * replace ({cleaned}) from ({_papers(edition)}))
      where length(title) >= 10"""


def _best(relation: str, stamp: str) -> str:
    return f"""
      select {_MASTER}, year, month, day, '{stamp}' as ingestion_timestamp
      from ({relation})
      qualify row_number() over (
        partition by id order by list_position({_PROVIDERS}, source), doc_id) = 1"""


_MERGED_COLUMNS = ", ".join(
    f"coalesce(s.{c}, m.{c}) as {c}" for c in [*_MASTER.split(", "), "year", "month", "day"]
)
_KEYS = "m.id = s.id and m.year = s.year and m.month = s.month and m.day = s.day"

_WITH = f"""with papers as ({_papers(0)}), refined as ({_refined(0)}), refined_1 as ({_refined(1)}),
  master as ({_best(f'select * from refined_1 where source in {_ENABLED}', '2024-02-01 00:00:00')}),
  staging as ({_best('select * from refined', '2024-03-01 00:00:00')}),
  merged as (select {_MERGED_COLUMNS}, coalesce(s.ingestion_timestamp, m.ingestion_timestamp) as ingestion_timestamp
    from master m full join staging s on {_KEYS})
"""


def _raw_table(*editions: str) -> str:
    columns = f"{_MASTER}, year, month, day, '2024-03-01 00:00:00' as ingestion_timestamp"
    return _WITH + " union ".join(f"select {columns} from {e}" for e in editions)


_BUCKET = "cast('0x' || substr(md5(token), 1, 8) as bigint) % 64"


def _counts(relation: str, key: str) -> str:
    """Term counts per hashed bucket of the ``text`` column."""
    return f"""
      select {key}, cast({_BUCKET} as integer) as bucket, count(*) as n
      from (select {key}, unnest(string_split(lower(text), ' ')) as token from ({relation}))
      group by 1, 2"""


_EMBED_TEXT = "concat_ws(' ', title, abstract, full_text)"


def _search(relation: str) -> str:
    return (
        _WITH
        + f""", points as ({_counts(f'select id, {_EMBED_TEXT} as text from ({relation})', 'id')}),
      asked as ({_counts('select item_id as query_id, text from benchmark', 'query_id')}),
      lengths as (select id, sqrt(sum(n * n)) as len from points group by id),
      asked_lengths as (select query_id, sqrt(sum(n * n)) as len from asked group by query_id),
      dots as (select query_id, id, sum(a.n * p.n) as dot from asked a join points p using (bucket) group by all),
      scores as (
        select query_id, id, round(coalesce(dot, 0) / (l.len * a.len), 6) as score
        from asked_lengths a cross join lengths l left join dots d using (query_id, id))
      select query_id, id, score, cast(row_number() over w as integer) as rank
      from scores window w as (partition by query_id order by score desc, id) qualify rank <= 10"""
    )


_CENTERS = """
  with centers as (
    select label as query_id, list(mean order by pos) as q
    from (select label, pos, avg(cast(value as double)) as mean
          from (select label, unnest(embedding) as value, generate_subscripts(embedding, 1) as pos from embeddings)
          group by label, pos)
    group by label)"""

_VECTOR_TOPK = _CENTERS + """, scores as (
    select query_id, vec_id as id, round(list_cosine_similarity(embedding::double[], q), 6) as score
    from centers cross join embeddings)
  select query_id, id, score, cast(row_number() over w as integer) as rank
  from scores window w as (partition by query_id order by score desc, id) qualify rank <= 10"""



def _pdf_path(day: str) -> str:
    return f"case when pdf_url <> '' then 's3://papers-bucket/raw_pdfs/' || source || '/' || {day} || '/' || id || '.pdf' end"


_PDF_PATH = _pdf_path("'2024/03/01'")

# What a record says, without the path that names the day it was fetched.
_CONTENT = [c for c in _MASTER.split(", ") if c != "pdf_s3_path"]
_RECORD_HASH = "cast('0x' || substr(md5({}), 1, 15) as bigint)".format(
    " || ',' || ".join(f"coalesce(md5(cast({c} as varchar)), '-')" for c in _CONTENT)
)

# Edition 1 lands on day 0, edition 0 on day 1; a record that was there before is not stored again.
_VERSIONS = (
    _WITH
    + f""", landed as (
        select * exclude (doc_id), 0 as landing from refined_1
        union all select * exclude (doc_id), 1 from refined),
      named as (
        select * replace ({_pdf_path("case landing when 0 then '2024/02/29' else '2024/03/01' end")} as pdf_s3_path)
        from landed where source in {_ENABLED}),
      hashed as (select *, {_RECORD_HASH} as record_hash from named),
      raw as (
        select * from hashed
        qualify row_number() over (partition by id, source, record_hash order by landing) = 1)
"""
)


def _latest(relation: str) -> str:
    """Per id the best source, then the latest landing, then the record hash."""
    return f"""
      select * from {relation}
      qualify row_number() over (
        partition by id order by list_position({_PROVIDERS}, source), landing desc, record_hash) = 1"""


def _points(relation: str) -> str:
    counts = _counts(f"select id, {_EMBED_TEXT} as text from {relation}", "id")
    return f"select c.id, doi, source, bucket, n from ({counts}) c join {relation} using (id)"


def oracle_sql() -> dict[str, str]:
    landed = _WITH + f"select {_MASTER.removesuffix(', doi_valid')} from papers"
    merged = _WITH + f"select {_MASTER}, year, month, day, ingestion_timestamp from merged"
    upsert_source = f"from staging s join master m on {_KEYS}"
    return {
        "scan_parquet": "select doc_id, text, lang, source, cast(null as varchar) as doi, n_chars from documents",
        "scan_typed_parquet": _WITH
        + f"""select {_MASTER.removesuffix(', doi_valid')},
            case when doc_id % 3 = 1 then '2024-02-01 00:00:00' end as ingestion_timestamp from papers""",
        "scan_json_roundtrip": landed,
        "scan_parquet_roundtrip": landed,
        "raw_table_roundtrip": _raw_table("refined", "refined_1"),
        "landing_stream": _raw_table(
            "(select * replace ('pubmed' as source) from refined)",
            "(select * replace ('pubmed' as source) from refined_1)",
        ),
        "enabled_sources": _WITH + f"select doc_id, id, source from papers where source in {_ENABLED}",
        "field_mapping": """
          select cast(doc_id as varchar) as id, null::varchar as doi, null::varchar as title, lang as authors,
            null::varchar as abstract, text as full_text, source as journal,
            null::varchar as publication_date, null::varchar as keywords, null::varchar as pdf_url,
            null::varchar as pdf_s3_path, 'arxiv' as source, null::varchar as ingestion_timestamp
          from documents""",
        "paper_id": f"select doc_id, {_id('text', 'lang', 'source')} as id from documents",
        "clean_text": _WITH + f"select doc_id, {', '.join(f'{_clean(c)} as {c}' for c in _CLEANED)} from papers",
        "title_filter": _WITH + "select doc_id, title from papers where length(trim(title)) >= 10",
        "truncate_text": _WITH
        + "select doc_id, substr(abstract, 1, 200) as abstract, substr(full_text, 1, 1000) as full_text from papers",
        "doi_valid": _WITH + f"select doc_id, doi, {_VALID_DOI} as doi_valid from papers",
        "partition_cols": _WITH + f"select doc_id, publication_date, {_DATED} from papers",
        "refine_papers": _WITH + "select * exclude (pdf_s3_path) from refined",
        "refine_sql": _WITH + "select * exclude (pdf_s3_path) from refined",
        "malformed_lines": _WITH
        + """, found as (select *, doc_id % 3 = 0 as cut from papers),
            stored as (select distinct * exclude (doc_id, source) from refined where doc_id % 3 <> 0)
          select 'source_acm' as check_name, true as passed, 'loaded' as state, count(*) as rows_read,
            count(*) filter (cut) as rows_malformed,
            count(*) filter (not cut and doc_id in (select doc_id from refined)) as rows_kept,
            (select count(*) from stored) as rows_stored
          from found""",
        "lookback_filter": _WITH
        + "select doc_id, id, publication_date from refined where publication_date >= date '2024-03-01' - 7",
        "pdf_path": _WITH + f"select doc_id, {_PDF_PATH} as pdf_s3_path from papers",
        "union_sources": """
          with united as (
            select doc_id::varchar as id, text as full_text, lang as authors, source as journal,
              null as pdf_url, null as keywords, 'arxiv' as source from documents
            union all select page_id::varchar, html, null, null, url, null, 'pubmed' from pages
            union all select item_id::varchar, text, null, null, null, null, 'ieee' from benchmark
            union all select conv_id::varchar, text, role, null, null, turn::varchar, 'acm' from conversations)
          select id, null::varchar as doi, null::varchar as title, authors, null::varchar as abstract, full_text,
            journal, null::varchar as publication_date, keywords::varchar as keywords, pdf_url::varchar as pdf_url,
            null::varchar as pdf_s3_path, source, null::varchar as ingestion_timestamp
          from united""",
        "dedup_papers": _WITH
        + f"""select id, doc_id, source, title, publication_date from refined
          qualify row_number() over (
            partition by id order by list_position({_PROVIDERS}, source), doc_id) = 1""",
        "merge_master": merged,
        "master_upsert": merged,
        "merge_updates": _WITH + f"select {_MERGED_COLUMNS}, s.ingestion_timestamp {upsert_source}",
        "merge_inserts": _WITH
        + f"""select {_MASTER}, year, month, day, ingestion_timestamp from staging s
          where not exists (select 1 from master m where {_KEYS})""",
        "touched_partitions": _WITH
        + """select id, year, month, day from master where (year, month, day) in (
            select (year, month, day) from refined where publication_date >= date '2024-03-01' - 7)""",
        "source_counts": _WITH + "select source, count(*) as n_rows from refined group by source",
        "master_count": _WITH + "select count(*) as n_rows from merged",
        "quality_report": _WITH
        + f"""select source, count(*) as rows_in,
            count(*) filter (coalesce(length({_clean('title')}) >= 10, false)) as rows_kept,
            count(*) filter (not coalesce(length({_clean('title')}) >= 10, false)) as short_titles,
            count(*) filter ({_clean('abstract')} is null) as null_abstracts,
            count(*) filter (doi is not null and not {_VALID_DOI}) as invalid_dois,
            count(*) filter (coalesce(doi in ('null', 'NULL'), false)) as null_spelled_dois
          from papers group by source""",
        "stale_doi_flags": _WITH
        + f"""select source, count(*) as n_rows,
            count(*) filter ({_VALID_DOI} and not doi_valid) as stale_flags
          from merged group by source""",
        "output_checks": _WITH
        + f"""select 'raw_data_found' as check_name, count(*) > 0 as passed, null::bigint as rows_read from papers
          union all select 'master_found', count(*) > 0, null from merged
          union all select 'vectors_found', count(*) > 0, null from master
          union all select 'master_ids_unique', count(*) = count(distinct id), null from merged
          union all select 'vectors_complete',
            count(*) filter (id not in (select id from master)) = 0, null from merged
          union all select 'source_' || source, source <> 'ieee', count(*) from papers
            where source in {_ENABLED} group by source""",
        "full_run": _VERSIONS
        + f""", first as (select * from raw where landing = 0 and publication_date >= date '2024-03-01' - 30),
            second as (select * from raw where publication_date >= date '2024-03-01' - 30),
            m as ({_latest('first')}), s as ({_latest('second')})
          select {_MERGED_COLUMNS} from m full join s on {_KEYS}""",
        "latest_version": _VERSIONS
        + f""", wanted as (select * from raw where publication_date >= date '2024-03-01' - 60)
          select {_MASTER}, year, month, day from ({_latest('wanted')})""",
        "raw_refetch": _WITH
        + f""", fetched as (
            select * replace ({_pdf_path("'2024/02/28'")} as pdf_s3_path), {_RECORD_HASH} as record_hash
            from refined where source in {_ENABLED})
          select {_MASTER}, record_hash, '2024-02-28' as landed_at, year, month, day from fetched
          group by all""",
        "embed_text": _WITH + f"select doc_id, {_EMBED_TEXT} as text from refined",
        "embed_payload": _WITH
        + f"select id, title, authors, publication_date, doi, source, {_EMBED_TEXT} as text from staging",
        "hash_embed": _counts("select doc_id, text from documents", "doc_id"),
        "embed_documents": f"""
          select doc_id, bucket, round(n / sqrt(sum(n * n) over (partition by doc_id)), 6) as weight
          from ({_counts('select doc_id, text from documents', 'doc_id')})""",
        "l2_normalize": """
          with cells as (
            select vec_id, unnest(embedding)::double * (vec_id % 4) as value,
              cast(generate_subscripts(embedding, 1) - 1 as integer) as pos
            from embeddings)
          select vec_id, pos, round(case when norm = 0 then 0 else value / norm end, 6) + 0.0::double as value
          from (select *, sqrt(sum(value * value) over (partition by vec_id)) as norm from cells)""",
        "vector_cosine": _CENTERS
        + """
          select vec_id, label, round(list_cosine_similarity(embedding::double[], q), 6) + 0.0 as score
          from embeddings join centers on label = query_id""",
        "vector_topk": _VECTOR_TOPK,
        "vector_topk_blocks": _VECTOR_TOPK,
        "paper_search": _search("select * from staging"),
        "vector_topk_filtered": _search(
            f"select * from staging where source in {_ENABLED} and publication_date >= date '2024-03-01' - 30"
        ),
        "vector_upsert": _WITH
        + f"""{_points('staging')} union all
          select * from ({_points('master')}) where id not in (select id from staging)""",
        "vector_table": _WITH
        + f""", again as (select * from staging where publication_date >= date '2024-03-01' - 30),
            untouched as (select * from master where publication_date not in (select publication_date from again))
          {_points('again')} union all {_points('untouched')}""",
    }
