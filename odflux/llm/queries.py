"""One registered query per operator, over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.llm.bpe_codec import round_trip
from odflux.llm.common import read_table
from odflux.llm.decontaminate import find_leaks
from odflux.llm.exact_topk import exact_topk
from odflux.llm.fill_middle import fill_in_middle, restore
from odflux.llm.filter_audit import audit_filters
from odflux.llm.html_text import extract_text
from odflux.llm.ngram_join import ngram_components
from odflux.llm.quality import score_quality
from odflux.llm.sentence_spans import remove_repeated_spans
from odflux.llm.token_counts import with_token_counts
from odflux.llm.toxicity import score_toxicity
from odflux.llm.url_graph import Rule, judge_urls
from odflux.llm.warc import archive_and_read_back

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs, TOKENIZER).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(read_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20, factor=64)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read_back(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), shortest=1)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "removed_sentences", "removed_words", "text",
                      F.length("text").cast("long").alias("text_length"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, TOKENIZER).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select("doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"),
                       F.length("middle").cast("long").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"),
                       digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


URL_RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
             Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_exact_topk, op3_warc, op4_decontaminate, op5_quality, op6_sentence_spans, op7_html_text, op8_toxicity, op9_bpe_round_trip, op10_ngram_join,
    op11_fill_in_middle, op12_url_filter, op13_filter_audit)}
ORACLES = {
    "op2_exact_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
                   where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id as query_id, v.vec_id, list_dot_product(q.e, v.e)::bigint as score
              from v q join v on v.vec_id <> q.vec_id where q.vec_id % 20 = 0),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, rank::integer as rank, vec_id, score from r where rank <= 20""",
    # Base32 is eight times four letters of twenty bits, five hexadecimal digits, each.
    "op3_warc": """
        with p as (select page_id, coalesce(html, '') as payload from pages),
        h as (select *, strlen(payload) as n, sha1(payload) as digest from p),
        f as (select *, min(page_id) over (partition by digest) as first from h),
        b as (select *, list_transform(range(8), lambda i: ('0x' || substr(digest, (i * 5 + 1)::integer, 5))::bigint) as parts from f)
        select page_id, n::bigint as payload_bytes,
               array_to_string(list_transform(parts, lambda x: array_to_string(list_transform([15, 10, 5, 0],
                   lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((x >> s) & 31) + 1)::integer, 1)), '')), '') as payload_digest,
               case when page_id = first then 'response' else 'revisit' end as record_type,
               case when page_id = first then null else first end as refers_to
        from b""",
    "op11_fill_in_middle": """
        with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
        r as (select *, length(t) as n, list_transform(range(4), lambda k: ('0x' || substr(h, (1 + 8 * k)::integer, 8))::bigint) as u from d),
        c as (select *, least(u[1] % (n + 1), u[2] % (n + 1)) as a, greatest(u[1] % (n + 1), u[2] % (n + 1)) as b,
                     case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or u[3] % 100 >= 90 then 'plain'
                          when u[4] % 100 < 20 then 'spm' else 'psm' end as form from r),
        p as (select *, substr(t, 1, a) as pre, substr(t, a + 1, b - a) as mid, substr(t, b + 1, n - b) as suf from c)
        select doc_id, n::bigint as n, form, case when form <> 'plain' then a end as prefix_chars,
               case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                                when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else t end) as output_sha256,
               sha256(t) as restored_sha256
        from p""",
    # Every host has an edge of no weight to itself, so that it stays in the rounds when nothing arrives.
    "op12_url_filter": r"""
        with recursive u as (select page_id, coalesce(html, '') as html,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
        f as (select *, case
                when ('.' || host) like '%.www.example.com' and path like '/en/%' then 'www.example.com/en/'
                when ('.' || host) like '%.example.com' and path like '/en/%' then 'example.com/en/'
                when ('.' || host) like '%.net' and path like '/es/%' then 'net/es/'
                when ('.' || host) like '%.net' and path like '/fr/%' then 'net/fr/'
                when ('.' || host) like '%.com' and path like '/%' then 'com/' end as rule from u),
        j as (select *, case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block' end as action from f),
        a as (select host as source, translate(unnest(regexp_extract_all(html,
                '(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s<>]+)', 1)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as target from j),
        l as (select source, target, count(*) as links from a where source <> '' and target <> '' and source <> target group by all),
        arcs as (select source as host, target as dest, false as against, links from l
                 union all select target, source, true, links from l),
        seeds as (select host, avg((coalesce(action, '') = 'allow')::integer) as trust, avg((coalesce(action, '') = 'block')::integer) as distrust
                  from j where host <> '' group by host),
        hosts as (select host, max(trust) as trust, max(distrust) as distrust
                  from (select * from seeds union all select source, 0, 0 from l union all select target, 0, 0 from l) group by host),
        base as (select host, false as against, trust as base from hosts union all select host, true, distrust from hosts),
        shares as (select host, dest, against, links / sum(links) over (partition by host, against) as share from arcs
                   union all select host, host, against, 0.0 from base),
        rounds as (select 0 as i, host, against, base::double as score from base
                   union all
                   select r.i + 1, s.dest, s.against, any_value(b.base) + 0.85 * sum(s.share * r.score)
                   from rounds r join shares s on r.host = s.host and r.against = s.against
                   join base b on b.host = s.dest and b.against = s.against
                   where r.i < 40 group by r.i, s.dest, s.against),
        last as (select host, max(score) filter (where not against) as trust, max(score) filter (where against) as distrust
                 from rounds where i = 40 group by host)
        select page_id, j.host, path, rule,
               coalesce(action, case when distrust >= 0.5 and distrust > trust then 'block' else 'allow' end) as verdict
        from j left join last on j.host = last.host""",
    "op13_filter_audit": r"""
        with marks as (select doc_id, max((quality = 1)::integer) as good, max((toxic = 1)::integer) as toxic from labels group by doc_id),
        d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
        c as (select doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
                     length(regexp_replace(t, '[^A-Z]', '', 'g')) as capitals, min(doc_id) over (partition by t) as least from d),
        b as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
                     [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * capitals > 5 * length(t),
                      regexp_matches(t, '[#$%&*|]'), coalesce(c.doc_id > least, false)] as failing
              from c left join marks on c.doc_id = marks.doc_id),
        f as (select part, good, toxic, list_sum(list_transform(range(5), lambda k: case when failing[k + 1] then (1 << k::integer) else 0 end))::integer as failed,
                     count(*) as docs from b group by all),
        x as (select unnest(range(5))::integer as k),
        o as (select [a.k, b.k, c.k, d.k, e.k] as filters from x a, x b, x c, x d, x e
              where len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
        s as (select array_to_string(list_transform(filters, lambda k: substr('ABCDE', k + 1, 1)), '') as filter_order, step::integer as step,
                     1 << filters[step] as bit,
                     coalesce(list_sum(list_transform(filters[:step - 1], lambda k: 1 << k)), 0)::integer as earlier
              from o, (select unnest(range(1, 6)) as step)),
        r as (select part, filter_order, step, bit,
                     coalesce(sum(docs) filter (where failed & (earlier | bit) = 0), 0)::bigint as kept,
                     coalesce(sum(docs) filter (where failed & bit <> 0 and failed & earlier = 0), 0)::bigint as removed,
                     coalesce(sum(docs) filter (where failed & bit <> 0 and failed & earlier <> 0), 0)::bigint as redundant,
                     coalesce(sum(docs) filter (where failed = bit), 0)::bigint as unique_fails,
                     coalesce(sum(docs) filter (where failed & bit <> 0 and failed & earlier = 0 and good = 1), 0)::bigint as good_lost,
                     coalesce(sum(docs) filter (where failed & bit <> 0 and failed & earlier = 0 and toxic = 1), 0)::bigint as toxic_lost
              from f, s group by all)
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) over (partition by part, bit))::bigint as shapley
        from r""",
}
