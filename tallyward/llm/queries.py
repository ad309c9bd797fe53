"""One query per operator over its whole table, with production parameters, and the SQL that answers it where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe, decontaminate, embedding_dedup, importance, licenses, minhash_dedup, perplexity, quotations, suffix_dedup, suffix_tree, toxicity, vector_codes, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_draw(n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(-1))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table's messages quote nothing; links come from quotations drawn by hash.
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return quotations.conversations(quotations.quoting(chats))


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_draw(7) == 2
    fitted = suffix_tree.train(docs.where(~held_out).select("text"))
    if fitted is None:  # nothing to learn from: every score is 0
        n_tokens = F.lit(1).cast("long") + F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), 0))
        zero, none = F.lit(0.0), F.lit(0).cast("long")
        return docs.select("doc_id", n_tokens.alias("n_tokens"), none.alias("n_known"), none.alias("train_tokens"), zero.alias("base_score"), zero.alias("score"), held_out.alias("held_out"))
    return suffix_tree.score(docs, *fitted).withColumn("held_out", held_out)


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with known damage, drawn by the hash of the id: some bodies altered, some records lost."""
    draw = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    altered = F.when(draw == "3a", F.concat(F.coalesce("html", F.lit("")), F.lit("."))).otherwise(F.col("html"))
    return pages.where((draw != "5c") | F.col("page_id").isNull()).select("page_id", "url", altered.alias("html"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.fixity_report(pages, damaged(pages))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.train(docs.where(id_draw(3) != 1), labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("held_out", id_draw(3) == 1)


def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.Judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).report()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_licenses": op4_licenses,
    "op5_quotations": op5_quotations,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_toxicity": op8_toxicity,
    "op9_perplexity": op9_perplexity,
    "op10_decontamination": op10_decontamination,
    "op11_orchard_codes": op11_orchard_codes,
    "op12_importance": op12_importance,
    "op13_suffix_dedup": op13_suffix_dedup,
    "pipeline": pipeline,
}

OP7 = """
with records as (
    select page_id,
        'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id
        || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, '')))
        || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as record
    from pages
), sized as (
    select page_id, octet_length(encode(record)) as length, sha256(record) as sha256, substr(md5(page_id::varchar), 1, 2) as draw
    from records
)
select page_id, 1::bigint as n_records,
    (sum(length) over (order by page_id) - length)::bigint as "offset", length::bigint as length, sha256,
    case draw when '3a' then 'altered' when '5c' then 'missing' else 'intact' end as status
from sized
"""

OP2 = """
with recursive
v as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
), n as (
    select vec_id, label, e, sqrt(list_dot_product(e, e)) as norm from v
    where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_dot_product(e, e) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from n a join n b on a.label = b.label and a.vec_id <> b.vec_id
    where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reach as (
    select a as id, b as other from links union select r.id, l.b from reach r join links l on l.a = r.other
), smallest as (
    select id, min(other) as m from reach group by id
), counted as (
    select a, count(*) as n_links from links group by a
)
select vec_id, coalesce(n_links, 0)::bigint as n_links, least(vec_id, coalesce(m, vec_id)) as component_id,
    vec_id = least(vec_id, coalesce(m, vec_id)) as kept
from embeddings left join counted on a = vec_id left join smallest on id = vec_id
"""

OP11 = """
with recursive kept as (
    select row_number() over () as r, vec_id, label, embedding::double[] as e from embeddings
    where embedding is not null and len(embedding) > 0 and len(embedding) % 16 = 0
        and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
), x as (
    select r, vec_id, ((i - 1) // (len(e) // 16))::bigint as p, (i - 1) % (len(e) // 16) as j, floor(256 * e[i])::bigint as x
    from (select *, unnest(range(1, len(e) + 1)) as i from kept)
), seeds as (
    select vec_id, r, row_number() over (order by vec_id) - 1 as entry from kept qualify entry < 64
), rounds as (
    select 0 as round, p, entry, j, x as c from x join seeds using (r)
    union all (
        with apart as (
            select r, p, b.entry, sum((a.x - b.c) * (a.x - b.c)) as d from x a join rounds b using (p, j) group by all
        ), nearest as (
            select r, p, arg_min(entry, d * 64 + entry) as entry from apart group by all
        ), means as (
            select p, entry, j, floor(sum(x)::double / count(*))::bigint as c from x join nearest using (r, p) group by all
        )
        select o.round + 1, p, entry, j, coalesce(m.c, o.c) from rounds o left join means m using (p, entry, j) where o.round < 2
    )
), final as (
    select p, entry, j, c from rounds where round = 2
), apart as (
    select r, p, f.entry, sum((a.x - f.c) * (a.x - f.c)) as d from x a join final f using (p, j) group by all
), nearest as (
    select r, p, arg_min(entry, d * 64 + entry) as entry, min(d) as d from apart group by all
), coded as (
    select r, string_agg(printf('%02x', entry::int), '' order by p) as code, sum(d)::bigint as error from nearest group by r
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
    (select sha256(string_agg(c::varchar, ',' order by p, entry, j)) from final) as codebooks_sha256
from coded join kept using (r)
"""

#: The hash table comes from its rule: eight steps of the reflected polynomial 0xEDB88320 (a fixed value).
OP12 = r"""
with recursive crc_steps as (
    select n as byte, 0 as step, n::ubigint as c from range(256) t(n)
    union all
    select byte, step + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from crc_steps where step < 8
), crc_table as (
    select list(c order by byte) as t from crc_steps where step = 8
), texts as (
    select 'd' as side, row_number() over () as r, doc_id, text from documents
    union all select 'b', row_number() over (), null, text from benchmark
), split as (
    select side, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
), words as (
    select side, r, unnest(w) as word, generate_subscripts(w, 1) as i from split
), features as (
    select side, r, word as f from words
    union all
    select a.side, a.r, a.word || ' ' || b.word from words a join words b on a.side = b.side and a.r = b.r and b.i = a.i + 1
), hashed as (
    select f, xor(list_reduce(
        list_prepend(4294967295::ubigint, list_transform(string_split(regexp_replace(hex(encode(f)), '(..)', '\1 ', 'g'), ' ')[:-2], lambda h: ('0x' || h)::ubigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) % 256)::int + 1])
    ), 4294967295::ubigint) % 10000 as bucket
    from (select distinct f from features), crc_table
), counted as (
    select bucket, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t from features join hashed using (f) group by bucket
), gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain
    from counted
), weighed as (
    select r, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
    from features join hashed using (f) join gains using (bucket) where side = 'd' group by r
), scored as (
    select x.r, doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, len(w) as n_words,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
    from texts x join split s on x.side = s.side and x.r = s.r left join weighed on x.r = weighed.r where x.side = 'd'
), ranked as (
    select r, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from scored where n_words >= 20
)
select doc_id, n_features, weight, score, rank
from scored left join (select r, rank from ranked where rank <= 25 * n // 100) using (r)
"""

ANSWERS: dict[str, str] = {"op11_orchard_codes": OP11, "op12_importance": OP12, "op2_embedding_dedup": OP2, "op7_warc_fixity": OP7}
