"""Registered queries of the subpackage: thin calls of the operators over whole
tables, with the columns that their contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm import (
    bpe,
    decontaminate,
    html_extract,
    importance,
    line_dedup,
    mixing,
    ngram_join,
    phrases,
    pii_crf,
    quality_gam,
    rules,
    sharding,
    url_filter,
)

#: Share of documents kept out of training: crc32 of the id as text, modulo 5.
FOLDS = 5
#: Scores from here on count as label 1.
QUALITY_CUT = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[dict[bytes, int], str]:
    """(ranks, pattern) of the tokenizer that the queries use."""
    import public_tokenizers
    return (bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
            public_tokenizers.PATTERN)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"), width=3,
                              threshold=ngram_join.Threshold(9, 10))


def quality_model(spark: SparkSession, sf_dir: str) -> quality_gam.Gam:
    return quality_gam.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                             held_out("doc_id"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_gam.score(docs, quality_model(spark, sf_dir)).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    return bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=24)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"), ["page_id", "url"]).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_kept", "text")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])

    def count(kind: str):
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii_crf.KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


#: URL rules (fixed values).
ALLOW = ("com/", "www.example.com/en/")
BLOCK = ("example.com/en/", "net/es/", "net/fr/")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    def keys(values: tuple[str, ...]) -> DataFrame:
        return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias("key"))

    return url_filter.judge(table(spark, sf_dir, "pages"), keys(ALLOW), keys(BLOCK))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=10, inside=50, top=2000)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3, seed=42).select(
        "doc_id", "size", "source_size", "target", "taken")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                               percent=5, least_words=20, seed=42).drop("n_words")


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_quality, op3_bpe, op4_rules, op5_sharding, op6_html, op7_line_dedup, op8_pii,
    op9_url_filter, op10_decontamination, op11_collocations, op12_mixing, op13_importance)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op4_rules": rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, {_WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) as ls
  from documents
), win as (
  select r, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
  from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
), again as (
  select r, i from (select r, i, count(*) over (partition by r, a, b, c) as n from win) where n >= 2
), covered as (
  select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from again) group by r
), s as (
  select d.r, doc_id, t, w, len(w)::bigint as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, len(ls) as n_lines,
         coalesce(covered.n, 0)::bigint as n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
         length(regexp_replace(t, '[^!?]', '', 'g')) as n_marks,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_stutters
  from d left join covered on covered.r = d.r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 100 * n_symbols > 40 * n_words
            or 100 * n_upper > 50 * word_chars or 100 * n_marks > 50 * n_words
            or 100 * n_dup_lines > 60 * n_lines or 100 * n_stutters > 30 * n_words
            or word_chars < 2 * n_words or word_chars > 15 * n_words) as kept
from s""",
    "op9_url_filter": r"""
with u as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages
), rules(h, p, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hosts as (
  select distinct host, path from u
), best as (
  select host, path, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as v
  from hosts join rules on (host = h or host like '%.' || h) and starts_with(path, p)
  group by host, path
)
select page_id, u.host, u.path, rule, coalesce(v, 'allow') as verdict
from u left join best on best.host = u.host and best.path = u.path""",
    "op11_collocations": r"""
with p as (
  select row_number() over () as piece, lang,
         regexp_extract_all(s, '[^\x20\x09]+') as w
  from (select coalesce(lang, 'und') as lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as s
        from documents)
), t as (
  select lang, w[i] as a, w[i + 1] as b, w[i + 2] as c
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from p)
), totals as (select lang, count(*) as n from t group by lang
), f1 as (select lang, a, count(*) as n from t group by lang, a
), f2 as (select lang, a, b, count(*) as n from t where b is not null group by lang, a, b
), f3 as (select lang, a, b, c, count(*) as n from t where c is not null group by lang, a, b, c
), cuts as (
  select x.lang, 2 as words, x.a || ' ' || x.b as phrase, x.n as a, 1 as k, p.n as l, q.n as r
  from f2 x join f1 p on p.lang = x.lang and p.a = x.a join f1 q on q.lang = x.lang and q.a = x.b where x.n >= 10
  union all
  select x.lang, 3, concat(x.a, ' ', x.b, ' ', x.c), x.n, 1, p.n, q.n
  from f3 x join f1 p on p.lang = x.lang and p.a = x.a
  join f2 q on q.lang = x.lang and q.a = x.b and q.b = x.c where x.n >= 10
  union all
  select x.lang, 3, concat(x.a, ' ', x.b, ' ', x.c), x.n, 2, p.n, q.n
  from f3 x join f2 p on p.lang = x.lang and p.a = x.a and p.b = x.b
  join f1 q on q.lang = x.lang and q.a = x.c where x.n >= 10
), scored as (
  select *, 1000000::hugeint * a * a // (l::hugeint * r) as score from cuts
), best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
  select lang, pair, max(n) as n
  from (select lang, unnest([a || ' ' || b, b || ' ' || c]) as pair, n from f3 where n >= 10) group by lang, pair
), kept as (
  select best.* from best left join longer on longer.lang = best.lang and pair = phrase and words = 2
  where longer.n is null or 100 * longer.n < 50 * best.a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select ranked.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r,
       totals.n::bigint as n, score::bigint as score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000""",
    "op12_mixing": r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents
), s as (
  select source, source_size, 3 * source_size as most, case place % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from (select source, source_size, row_number() over (order by source asc nulls last) - 1 as place
        from (select source, sum(size)::bigint as source_size from d group by source))
), total as (select sum(source_size) as words from s
), capped as (
  select x.source, x.source_size, x.weight, x.most,
         (select sum(least(y.most::hugeint * x.weight, x.most::hugeint * y.weight)) from s y)
           <= (select words from total) * x.weight as full_source
  from s x
), rest as (
  select (select words from total) - coalesce(sum(most) filter (full_source), 0) as words,
         sum(weight) filter (not full_source) as weight
  from capped
), t as (
  select source, source_size, case when full_source then most::double
                                   else (capped.weight * rest.words)::double / rest.weight::double end as target
  from capped, rest
), e as (
  select d.*, t.source_size, t.target, case when t.source_size > 0
           then floor(t.target / t.source_size * 1000000000000.0)::bigint else 0 end as expected,
         ('0x' || substr(sha256('42:' || coalesce('=' || d.source, 'null')), 1, 15))::bigint % 1000000000000 as start
  from d join t on t.source is not distinct from d.source
), sums as (
  select *, start + sum(expected) over (partition by source order by size, h, doc_id
                                        rows between unbounded preceding and current row) as upto
  from e
)
select doc_id, size, source_size, target,
       (size * (upto // 1000000000000 - (upto - expected) // 1000000000000))::bigint as taken
from sums""",
}
