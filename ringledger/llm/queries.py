"""The registered queries of this subpackage and their DuckDB checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ringledger.llm import (
    bilinear,
    dartminhash,
    decontaminate,
    gam,
    hardnegatives,
    language,
    line_dedup,
    packing,
    perplexity,
    phrases,
    sharding,
    toxicity,
    warc,
)
from ringledger.llm.tokens import tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_perplexity_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "lang", "text")
    return perplexity.quality_rules(docs, keep_text=False).drop("lang")


def op2_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return gam.classify(docs, _table(spark, folder, "labels"))


def op3_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.deduplicated_pages(_table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return packing.pack(docs, tokenizer_file(), keep_ids=False)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(_table(spark, folder, "documents"))
    sha = F.sha2(F.col("text"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", sha)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item found in it."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, _table(spark, folder, "benchmark"))
    pairs = found.select("doc_id", F.explode("matches").alias("match"))
    return pairs.select("doc_id", "match.*")


def op7_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.cross_checked(docs).select("doc_id", "held_out", "lang_pred", "score")


def op8_log_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    return bilinear.score(_table(spark, folder, "documents").select("doc_id", "text"))


def op9_histogram_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs).select(
        "doc_id",
        "size",
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = dartminhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.classify(docs, _table(spark, folder, "labels"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents").select("lang", "text"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)


OP3_SQL = r"""
with hashed as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
),
compared as (
    select *, count(*) over (partition by payload) as copies,
           max(page_id) over (partition by payload) as original
    from hashed
)
select page_id, strlen(payload)::bigint as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(hex, 5 * (i // 4)::int + 1, 5))::int
               >> (15 - 5 * (i % 4))::int)) & 31), 1)), 'string_agg', '') as payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id < original then original end as refers_to
from compared
"""

OP5_SQL = r"""
with split as (
    select doc_id, row_number() over () as row_id,
           string_split(coalesce(text, ''), chr(10)) as lines
    from documents
),
lines as (
    select row_id, unnest(lines) as line, unnest(range(len(lines))) as position from split
),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
),
shared as (
    select key from keyed where length(key) >= 1
    group by key having count(distinct row_id) >= 10
),
kept as (
    select row_id, count(*) as n_lines, count(shared.key) as n_dropped,
           coalesce(string_agg(line, chr(10) order by position)
               filter (where shared.key is null), '') as text
    from keyed left join shared on keyed.key = shared.key
    group by row_id
)
select doc_id, n_lines, n_dropped, sha256(text) as kept_sha256
from split join kept using (row_id)
"""

OP12_SQL = r"""
with pieces as (
    select lang, row_number() over () as piece, words
    from (
        select coalesce(lang, 'und') as lang, list_filter(
            string_split_regex(unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'),
            lambda w: w <> '') as words
        from documents
    )
),
totals as (select lang, sum(len(words))::bigint as n from pieces group by lang),
starts as (select lang, words, unnest(range(1, len(words) + 1)) as start from pieces),
grams as (
    select lang, words[start:start + size - 1] as phrase, size
    from starts, (select unnest([1, 2, 3, 4]) as size)
    where start + size - 1 <= len(words)
),
counted as (
    select lang, phrase, size, count(*) as f from grams group by all having count(*) >= 30
),
cuts as (
    select c.lang, c.phrase, c.size, c.f, k, x.f as l, y.f as r,
           (2000000::hugeint * c.f // (x.f + y.f))::bigint as score
    from (select *, unnest(range(1, size)) as k from counted where size > 1) c
    join counted x on x.lang = c.lang and x.phrase = c.phrase[1:k]
    join counted y on y.lang = c.lang and y.phrase = c.phrase[k + 1:c.size]
),
lowest as (
    select * from cuts
    qualify row_number() over (partition by lang, phrase order by score, k) = 1
),
around as (
    select lang, inner_ as phrase, max(f) as outer_
    from (
        select lang, f, phrase[start:start + part - 1] as inner_
        from (select *, unnest(range(1, size)) as start from counted where size > 2),
             (select unnest([2, 3]) as part)
        where part < size and start + part - 1 <= size
    )
    group by all
),
ranked as (
    select lowest.*, array_to_string(lowest.phrase, ' ') as spelled
    from lowest left join around using (lang, phrase)
    where outer_ is null or 100 * outer_::hugeint < 80 * f::hugeint
)
select lang, rank, spelled as phrase, f as a, l, r, n, score
from (
    select *, row_number() over (partition by lang order by score desc, f desc, spelled) as rank
    from ranked
) join totals using (lang)
where rank <= 2000
"""

OP13_SQL = """
with vectors as (
    select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
           list_dot_product(a.v, b.v)::bigint as score
    from vectors a join vectors b on a.vec_id <> b.vec_id
    where a.vec_id % 50 = 0
),
positives as (
    select * from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, p.vec_id as positive_id,
       (row_number() over (partition by anchor_id, p.vec_id order by n.score desc, n.vec_id))::int
           as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n using (anchor_id)
where not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""


def queries() -> dict[str, Query]:
    named = [
        op1_perplexity_rules,
        op2_quality_gam,
        op3_warc_revisits,
        op4_packing,
        op5_line_dedup,
        op6_decontamination,
        op7_language_profiles,
        op8_log_bilinear,
        op9_histogram_sharding,
        op10_near_duplicates,
        op11_toxicity,
        op12_phrase_collocations,
        op13_hard_negatives,
    ]
    return {query.__name__: query for query in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_revisits": OP3_SQL, "op5_line_dedup": OP5_SQL, "op12_phrase_collocations": OP12_SQL,
            "op13_hard_negatives": OP13_SQL}
