"""Registered queries of this subpackage and their reference SQL for DuckDB."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from . import ann, chat, langid, lexical, mixing, ngram_join, packing, pii, quality, secret_scan, topk, vcodes, warc
from .common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PII_KEY = "corpus-2024"


def op1_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_secrets(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op5_chat(spark, sf_dir):
    return chat.repair(table(spark, sf_dir, "conversations"))


def op6_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), 5, 50)


def op8_warc(spark, sf_dir):
    """Records of all pages against a replica in which known records were changed or lost, on either side."""
    written = warc.records(table(spark, sf_dir, "pages"))
    key = F.col("record_id")
    first = written.filter(F.coalesce(key % 103, F.lit(0)) != 5)
    torn = F.encode(F.overlay(F.decode("record", "ISO-8859-1"), F.lit("#"), F.col("length").cast("int") - 4), "ISO-8859-1")
    second = written.filter(F.coalesce(key % 101, F.lit(0)) != 7).withColumn(
        "record", F.when(key % 97 == 13, torn).otherwise(F.col("record")))
    return warc.audit(first, second).select("record_id", "kind")


def op9_pii(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op10_topk(spark, sf_dir):
    return topk.top_products(table(spark, sf_dir, "embeddings"), 10, 100)


def op11_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op12_vcodes(spark, sf_dir):
    return vcodes.encode(table(spark, sf_dir, "embeddings"))


def op13_lexical(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_ngram_join, op3_packing, op4_secrets, op5_chat, op6_mixing, op7_ann, op8_warc, op9_pii, op10_topk,
                                   op11_langid, op12_vcodes, op13_lexical)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
        select page_id as record_id,
               case when page_id % 103 = 5 then 'added' when page_id % 101 = 7 then 'lost' else 'changed' end as kind
        from pages
        where (page_id % 103 = 5) <> (page_id % 101 = 7)
           or (page_id % 97 = 13 and page_id % 103 <> 5 and page_id % 101 <> 7)""",
    "op10_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
            from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, rank::int as rank, vec_id, score from r where rank <= 10""",
}

#: Fixed values of op13's contract: the term pattern and the letters that are lower-cased.
_TERMS = r"""regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE_SQL["op13_lexical"] = f"""
    with d as (select row_number() over () as row, doc_id, {_TERMS.format('text')} as t from documents),
    s as (select count(*) filter (where len(t) > 0) as nn, sum(len(t)) as ll from d),
    q as (select distinct item_id, term from (select item_id, unnest({_TERMS.format('text')}) as term from benchmark)),
    p as (select d.row, d.doc_id, len(d.t) as n, u.term from d, unnest(d.t) as u(term)),
    tf as (select row, doc_id, n, term, count(*) as tf from p where term in (select term from q) group by row, doc_id, n, term),
    df as (select term, count(*) as df from tf group by term),
    w as (select term, floor(1000 * ln((2.0 * s.nn + 2) / (2.0 * df.df + 1)))::bigint as w from df, s),
    sc as (
        select q.item_id, tf.row, tf.doc_id,
               sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * tf.n * s.nn) // s.ll))))::bigint as score
        from q join tf using (term) join w using (term), s
        group by q.item_id, tf.row, tf.doc_id),
    r as (select *, row_number() over (partition by item_id order by score desc, doc_id, row) as rank from sc where score > 0)
    select item_id, rank::int as rank, doc_id, score from r where rank <= 10"""


def _codes_sql(rounds: int = 4) -> str:
    """op12 as plain k-means: each round assigns all parts to all entries and takes floored means."""
    steps = []
    for r in range(1, rounds + 2):
        steps.append(f"""
    dd{r} as (select p.rn, p.j, b.e, coalesce(list_sum(list_transform(list_zip(p.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), 0) as dist
              from parts p join b{r - 1} b using (j)),
    a{r} as (select rn, j, e, dist from (select *, row_number() over (partition by rn, j order by dist, e) as q from dd{r}) where q = 1)""")
        if r <= rounds:
            steps.append(f"""
    c{r} as (select a.j, a.e, pos.i, sum(p.x[pos.i]) as total, count(*) as n
             from a{r} a join parts p using (rn, j), range(1, 1 + (select max(len(x)) from parts)) pos(i)
             where pos.i <= len(p.x) group by a.j, a.e, pos.i),
    b{r} as (select b.j, b.e, coalesce(m.x, b.x) as x from b{r - 1} b left join (
                 select j, e, list(floor(total / n)::bigint order by i) as x from c{r} group by j, e) m using (j, e))""")
    return f"""
    with kept as (
        select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
        from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    dim as (select len(v) as d from kept order by vec_id nulls last, v limit 1),
    k as (select row_number() over (order by vec_id nulls last, v) as rn, kept.* from kept, dim where len(v) = dim.d),
    parts as (select rn, j, list_slice(v, j * d // 4 + 1, (j + 1) * d // 4) as x from k, dim, range(4) t(j)),
    b0 as (select j, rn - 1 as e, x from parts where rn <= 256),{",".join(steps)},
    fin as (select rn, string_agg(format('{{:02x}}', e), '' order by j) as code, sum(dist)::bigint as error from a{rounds + 1} group by rn),
    res as (select k.vec_id, k.label, fin.code, fin.error from fin join k using (rn)),
    lab as (select label, sum(error)::bigint as label_error from res group by label),
    dig as (select sha256(string_agg(c::varchar, ',' order by j, e, i)) as h
            from (select j, e, unnest(x) as c, generate_subscripts(x, 1) as i from b{rounds}))
    select vec_id, code, error, label_error, (select h from dig) as codebooks_sha256
    from res join lab on res.label is not distinct from lab.label"""


ORACLE_SQL["op12_vcodes"] = _codes_sql()
