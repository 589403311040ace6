"""Catalogue entries: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import centroids, decontam, langid, packing, pii, quality, records, rules, sharding, simhash, spelling, topk, warc
from .common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    measured = stored(
        rules.measure(docs, keep={"doc_id": F.col("doc_id"), "stratum": F.coalesce("lang", F.lit("none"))}), "rule-counts"
    )
    labels = _table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    cutoffs = rules.calibrate(measured, labels.select("doc_id", (F.col("quality") > 0).alias("good")))
    failed = rules.base_failed()
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~cutoffs.verdict(F.col("stratum"))).alias("kept"),
    )


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.documents_as_records(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("row")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs)).select(
        F.col("whole.doc_id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_as_archive(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        F.col("whole.doc_id").alias("doc_id"), quality.held_out(F.col("whole.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~quality.held_out(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        F.col("whole.doc_id").alias("doc_id"), quality.held_out(F.col("whole.doc_id")).alias("held_out"),
        "lang_pred", "score", "rejected",
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), first as (
  select html, min(page_id) as least from p group by html
)
select p.page_id, strlen(p.html) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    -- the i-th group of five bits: hex digits 5*(i//4) .. +5 are twenty bits, four groups
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(
      (cast('0x' || substr(h, cast(5 * (i // 4) + 1 as int), 5) as bigint) >> cast(15 - 5 * (i % 4) as int)) & 31
    as int) + 1, 1)), '') as payload_digest,
  case when p.page_id = least then 'response' else 'revisit' end as record_type,
  case when p.page_id = least then null else least end as refers_to
from p join first using (html)
"""


def rules_sql() -> str:
    """DuckDB text of op7_rules: counts, exact binomial tests and the chosen cutoffs."""
    blanks = "[\\x20\\x09-\\x0D]"
    cutoffs = ", ".join(f"('{rule}', {n}, {cutoff})" for rule, (_, _, cs) in rules.RULES.items() for n, cutoff in enumerate(cs))
    over = " ".join(f"when '{rule}' then 1000 * {num} > cutoff * {den}" for rule, (num, den, _) in rules.RULES.items())
    verdict = " or ".join(
        f"(rule = '{rule}' and 1000 * {num} > cutoff * {den})" for rule, (num, den, _) in rules.RULES.items()
    )
    return f"""
with t as (
  select doc_id, coalesce(lang, 'none') as stratum, coalesce(text, '') as text,
    list_filter(string_split_regex(coalesce(text, ''), '{blanks}+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{blanks[1:]}')) as l
  from documents
), g as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from t, unnest(range(1, len(w) - 1)) as r(i)
), again as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as n from g) where n > 1
), covered as (
  select doc_id, count(distinct i + k) as n_repeat_words from again, (values (0), (1), (2)) as o(k) group by doc_id
), m as (
  select t.doc_id, stratum, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(len(l) as bigint) as n_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from t left join covered using (doc_id)
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
), marked as (
  select b.*, quality > 0 as good from b join labels using (doc_id)
  where not base_failed and quality is not null
    -- crc32 of the id's decimal digits, bit by bit; remainder 2 is held out
    and list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, 8 * length(doc_id::varchar)),
          lambda k: ((ascii(substr(doc_id::varchar, cast(k // 8 + 1 as int), 1)) >> cast(k % 8 as int)) & 1)::bigint)),
          lambda c, d: case when (c & 1) <> d then xor(c >> 1, 3988292384::bigint) else c >> 1 end) & 3 <> 1
), c as (
  select rule, n, cutoff from (values {cutoffs}) as v(rule, n, cutoff)
), k as (
  select stratum, rule, n, cutoff, count(*) filter (good) as n_good,
    count(*) filter (good and case rule {over} end) as k_good, count(*) filter (not good and case rule {over} end) as k_bad
  from marked, c group by all
), p as (
  select *, (select sum(exp(lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1)
      + j * ln({0.02 / len(rules.RULES)!r}) + (n_good - j) * ln(1 - {0.02 / len(rules.RULES)!r}))) from unnest(range(0, k_good + 1)) as u(j)) as tail
  from k where n_good > 0
), tested as (
  select *, bool_and(tail <= 0.05 / ((select count(distinct stratum) from p) * {len(rules.RULES)}))
    over (partition by stratum, rule order by n) as certified from p
), chosen as (
  select stratum, rule, cutoff from (
    select *, row_number() over (partition by stratum, rule order by k_bad desc, n) as place from tested where certified
  ) where place = 1
)
select b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not exists (
    select 1 from chosen where chosen.stratum = b.stratum and ({verdict})
  ) as kept
from b
"""


SPELLING_SQL = """
with recursive tab as (
  -- the CRC-32 table: eight shifts of each byte
  select list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) as t
), runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents) group by all
), hashed as (
  select run, k, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
      string_split(doc_id::varchar || ':' || run, ''),
      lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h
  from runs, tab where length(run) >= 7
), cut as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, k
  from hashed
), words as materialized (
  select word, cast(sum(k) as bigint) as n from cut where length(word) >= 7 group by word having sum(k) >= 2
), less as materialized (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as v from words, unnest(range(1, length(word) + 1)) as u(i)
), pairs as (
  select a.word as x, b.word as y from less a join less b on a.v = b.v and a.i = b.i and a.word <> b.word
  union select l.word, w.word from less l join words w on l.v = w.word
  union select w.word, l.word from less l join words w on l.v = w.word
), near as (
  select x as word, words.word as near, words.n as near_n from pairs join words on y = words.word
), best as (
  select *, row_number() over (partition by word order by near_n desc, near) as place, count(*) over (partition by word) as n_near
  from near
), formed as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * w.n then near end as form,
    case when near_n >= 10 * w.n then near_n end as form_n
  from words w left join best b on w.word = b.word and place = 1
), path as (
  select word, coalesce(form, word) as root, form is null as done from formed
  union all
  select p.word, coalesce(f.form, p.root), f.form is null from path p join formed f on p.root = f.word where not p.done
)
select f.word, f.form, p.root, f.n, f.n_near, f.form_n from formed f join path p on f.word = p.word and p.done
"""

FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

TOPK_SQL = f"""
with v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
  from embeddings where {FINITE}
), s as (
  select a.r, a.vec_id as query_id, b.vec_id, coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1),
    lambda i: a.q[i] * b.q[i])), 0) as score
  from v a join v b on a.vec_id <> b.vec_id or b.vec_id is null where a.vec_id % 100 = 0
), ranked as (
  select *, row_number() over (partition by r order by score desc, vec_id nulls last) as rank from s
)
select query_id, cast(rank as int) as rank, vec_id, cast(score as bigint) as score from ranked where rank <= 10
"""


def centroids_sql(rounds: int = 5) -> str:
    """DuckDB text of op12_centroids: every vector against every centroid, round by round."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} as materialized (
  select r, min(64 * d + c) as m from (
    select v.r, c, list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - k.q[i]) * (v.q[i] - k.q[i]))) as d from v, c{n} k
  ) group by r
)""")
        if n < rounds:
            steps.append(f"""c{n + 1} as materialized (
  select k.c, coalesce(m.q, k.q) as q from c{n} k left join (
    -- the remainder is made positive, so that the division is exact: a floor
    select c, list((s - ((s % n) + n) % n) // n order by i) as q from (
      select a.m % 64 as c, i, sum(v.q[i])::bigint as s, count(*) as n from a{n} a join v using (r), unnest(range(1, 65)) as u(i) group by all
    ) group by c
  ) m using (c)
)""")
    return f"""
with v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings where {FINITE} and len(embedding) = 64
), c0 as materialized (
  select row_number() over (order by h nulls last, q) - 1 as c, q from (
    select sha256('2:' || vec_id) as h, q from v order by h nulls last, q limit 40
  )
), {", ".join(steps)}
, d as (select r, cast(m % 64 as int) as cluster, cast(m // 64 as bigint) as distance from a{rounds})
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(k.q, ',')) as centroid_sha256
from d join v using (r) join c{rounds} k on k.c = d.cluster
"""


QUERIES = {
    "op1_packing": op1_packing,
    "op2_pii": op2_pii,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_rules": op7_rules,
    "op8_token_records": op8_token_records,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_centroids": op12_centroids,
    "op13_topk": op13_topk,
}
#: the SQL of the operators that SQL can express
ORACLE_SQL: dict[str, str] = {
    "op3_warc": WARC_SQL, "op7_rules": rules_sql(), "op11_spelling": SPELLING_SQL, "op12_centroids": centroids_sql(),
    "op13_topk": TOPK_SQL,
}
