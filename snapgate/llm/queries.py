"""The registered queries of the operators, each over its whole table, with SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapgate.llm import (decontaminate, divergence, licences, middle, mixing, pieces, quality, repeats, secret_scan, simhash, topk,
                          toxicity, urls)
from snapgate.llm.common import table


def tokenizer(name="piece_bpe_32k.model"):
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mix_sources(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_repeats(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op3_pieces(spark, sf_dir):
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer(), with_ids=False)


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licences(spark, sf_dir):
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op6_secrets(spark, sf_dir):
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op7_urls(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), urls.train(spark))


def op8_topk(spark, sf_dir):
    vectors = topk.usable(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("id % 50 = 0"), vectors)


def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op10_quality(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_middle(spark, sf_dir):
    turned = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = middle.restored(F.col("output"), F.col("form"))
    return turned.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                         F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_repeats, op3_pieces, op4_toxicity, op5_licences, op6_secrets, op7_urls,
                                   op8_topk, op9_simhash, op10_quality, op11_decontaminate, op12_divergence, op13_middle)}
SQL = {
    "op8_topk": """
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op11_decontaminate": r"""
with d as (select row_number() over () as r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select distinct item_id::varchar as item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item, least(len(w), 10) as size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as t
       from (select item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from b where len(w) > 0)),
sizes as (select distinct size from bw),
dw as (select r, i, size, array_to_string(w[i:i + size - 1], ' ') as t
       from (select r, w, size, unnest(generate_series(1, len(w) - size + 1)) as i from d, sizes)),
h as (select dw.r, dw.i, dw.size, bw.item from dw join bw using (size, t)),
hw as (select r, count(distinct k) as n from (select r, unnest(generate_series(i, i + size - 1)) as k from h) group by 1),
hi as (select r, count(*) as n, string_agg(item, ',' order by item) as s
       from (select distinct r, item from h where item is not null) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(hw.n, 0) as n_hit, coalesce(hi.n, 0) as n_items,
       sha256(coalesce(hi.s, '')) as items_sha256, hw.n is not null as contaminated
from d left join hw using (r) left join hi using (r)""",
    "op12_divergence": r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
o as (select lang, source, term, count(*) as n, count(distinct r) as docs
      from (select r, lang, source, unnest(w) as term from d) group by all),
k as (select lang, term, sum(n) as n from o group by all having sum(docs) >= 10),
v as (select lang, count(*) as v, sum(n) as total from k group by 1),
g as (select x.lang, x.source, coalesce(v.v, 0) as v, v.total as lang_total,
             (select coalesce(sum(o.n), 0) from o join k using (lang, term) where o.lang = x.lang and o.source = x.source) as total
      from (select distinct lang, source from d) x left join v using (lang)),
p as (select g.lang, g.source, k.term, coalesce(o.n, 0) as n,
             (1 + 1000000000::hugeint * (coalesce(o.n, 0) + 2) // (g.total + 2 * g.v))::bigint as p,
             (1 + 1000000000::hugeint * (k.n + 2) // (g.lang_total + 2 * g.v))::bigint as q
      from g join k using (lang) left join o using (lang, source, term)),
f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
      from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
s as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
      from g a join g b on a.lang = b.lang and a.source <> b.source
      left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
      union all
      select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p where n > 0 and p > q),
t as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from s)
select * from t where part = 'pair' or rank <= 10""",
    "op13_middle": r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
t as (select *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as w,
             ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3,
             ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, len(w)::bigint as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from t),
x as (select *, array_to_string(w[1:a], '') as p, array_to_string(w[a + 1:b], '') as m, array_to_string(w[b + 1:], '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256 from x""",
}
