"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfeed.llm import (
    decontaminate,
    extraction,
    fill_middle,
    language,
    licenses,
    neighbours,
    packing,
    pii,
    resampling,
    sharding,
    simhash,
    topk,
    toxicity,
)
from meshfeed.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of three phrases in every document, and the labels of these and of the notices found."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.build_index(docs))
    base = F.transform("base_places", lambda p: p["label"])
    own = F.transform("license_matches", lambda m: m["label"])
    starts = F.transform("base_places", lambda p: p["start"])
    best = F.array_max(F.transform("license_matches", lambda m: m["share"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licenses.joined(base).alias("base_labels"),
        licenses.joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("base_places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest id of its class of near copies."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, radius=2)
    digits = F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty largest inner products of every twentieth vector with all other rows, exactly. Each row is
    a query of its own, also one that comes twice; its copies are among its candidates."""
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"), scale=64)
    return topk.top_k(vectors, F.col("id") % 20 == 0, k=20, each_row=True)


TOP_K_SQL = """
with v as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings
  where vec_id is not null and embedding is not null
    and not list_contains([x is not null and isfinite(x) for x in embedding], false)),
scores as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) as bigint) as score
  from v as q join v as c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v))
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 20
"""


def remainder(column: str, divisor: int):
    """crc32 of an id's text, modulo; rows of one remainder are held out of a fit. A null id: null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, _table(spark, sf_dir, "labels"), held_out=remainder("doc_id", 4) == 2)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of label 1. A null id is in no part of the split: ``held_out`` is null,
    and nothing is learned from it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return found.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"),
        F.size("offending").alias("offending_sentences"),
    )


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base patterns' counts and digest, and all spans with those that the trees add, for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    proposed = stage(pii.propose(docs).drop("text"), "candidates")
    found = pii.select(proposed, pii.fit(proposed))
    counts = [
        F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        for kind in pii.KINDS[:4]
    ]
    base = F.sha2(pii.span_list("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.span_list("pii_spans").alias("spans"))


def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language. A null id's ``held_out`` is null; such rows are learned from."""
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs, held_out=remainder("doc_id", 5) == 0)
    found = language.identify(docs.select("doc_id", "text"), model)
    held_out = (remainder("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", F.col("lang_score").alias("score"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of at most 4,096 tokens and their places in sequences."""
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        capacity=4096,
        end_id=1,
        content={"ids_crc32": F.crc32("ids")},
    )


SHARD_BYTES = 1 << 20


def extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document; shards hold at most ``SHARD_BYTES``."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    return sharding.assign(docs, "bytes", SHARD_BYTES)


SHARDING_SQL = f"""
with d as (
  select doc_id, cast(strlen(text) as bigint) as bytes, coalesce(cast(strlen(text) as bigint), 0) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 11) as bigint) as hash
  from documents),
levels as (
  select d.doc_id, d.bytes, d.hash, l.depth, d.hash >> (44 - l.depth) as bucket,
    sum(d.size) over w as shard_bytes, count(*) over w as shard_rows
  from d, unnest(range(0, 45)) as l(depth) where d.size <= {SHARD_BYTES}
  window w as (partition by l.depth, d.hash >> (44 - l.depth))),
best as (
  select *, row_number() over (partition by doc_id order by depth) as n from levels where shard_bytes <= {SHARD_BYTES})
select doc_id, bytes, 's' || right(lpad(bin(bucket), 64, '0'), cast(depth as integer)) as shard_id,
  cast(depth as integer) as depth, cast(shard_bytes as bigint) as shard_bytes, shard_rows, false as oversize
from best where n = 1
"""


def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by a labeller fitted to the table's own pages."""
    pages = _table(spark, sf_dir, "pages")
    found = extraction.extract(pages, extraction.fit(pages))
    text = F.col("main_text")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark, by windows of ten words."""
    docs, bench = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs.select("doc_id", "text"), bench, window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION_SQL = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as k
  from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0),
hits as (
  select d.doc_id, x.i, l.n, windows.item_id
  from d, (select distinct n from windows) as l, unnest(range(1, len(d.w) - l.n + 2)) as x(i)
  join windows on windows.n = l.n and windows.k = array_to_string(d.w[x.i:x.i + l.n - 1], ' ')),
words as (
  select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as t(p) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(words.n_hit, 0) as n_hit,
  coalesce(found.n_items, 0) as n_items, sha256(coalesce(found.items, '')) as items_sha256,
  coalesce(words.n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join found using (doc_id)
"""


def target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark; a row for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = resampling.fit(docs, _table(spark, sf_dir, "benchmark"), least=1, most=1, buckets=10000)
    scored = resampling.weigh(docs, model).drop("text")
    scored = scored.withColumn("score", resampling.noisy_score("doc_id", "weight", seed=2024))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = resampling.ranked(scored, 10, F.col("n_words") >= 20, order)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 of every different word, byte by byte from a table that is made by its rule
RESAMPLING_SQL = """
with recursive steps(v, c, n) as (
  select i, i, 0 from range(256) as t(i)
  union all select v, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n + 1 from steps where n < 8),
lookup as (select list(c order by v) as s from steps where n = 8),
d as (select doc_id, {words} as w from documents),
b as (select {words} as w from benchmark),
vocabulary as (
  select distinct w, hex(encode(w)) as h from (select unnest(w) as w from d union all select unnest(w) from b)),
hashed as (
  select w, xor(list_reduce(list_prepend(cast(4294967295 as bigint),
      [cast('0x' || h[2 * i + 1:2 * i + 2] as bigint) for i in range(len(h) // 2)]),
    lambda c, x: xor(c >> 8, s[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket
  from vocabulary, lookup),
raw as (select bucket, count(*) as s from (select unnest(w) as w from d) join hashed using (w) group by bucket),
goal as (select bucket, count(*) as t from (select unnest(w) as w from b) join hashed using (w) group by bucket),
gains as (
  select bucket, cast(floor(1000 * ln(
    cast(coalesce(t, 0) + 1 as double) * cast((select sum(s) from raw) + 10000 as double)
    / (cast(s + 1 as double) * cast((select coalesce(sum(t), 0) from goal) + 10000 as double)))) as bigint) as gain
  from raw left join goal using (bucket)),
weights as (
  select doc_id, cast(sum(gain) as bigint) as weight
  from (select doc_id, unnest(w) as w from d) join hashed using (w) join gains using (bucket) group by doc_id),
scored as (
  select d.doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0)
    + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || cast(d.doc_id as varchar)), 1, 8) as bigint) + 0.5::double)
      / 4294967296::double))) as bigint) as score
  from d left join weights using (doc_id)),
places as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
  from scored where n_features >= 20)
select scored.*, case when rank <= 10 * n // 100 then rank end as rank from scored left join places using (doc_id)
""".replace("{words}", _WORDS)


def approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors that a forest finds for every hundredth one."""
    vectors = neighbours.usable(_table(spark, sf_dir, "embeddings"))
    return neighbours.nearest(vectors, F.col("id") % 100 == 0, k=10)


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged, and put back together from what came out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    moved = fill_middle.transform(docs, seed=1, percent=90, suffix_first_percent=20).drop("text")
    back = fill_middle.restore(moved, out="restored")
    return back.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


FILL_MIDDLE_SQL = """
with d as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || cast(doc_id as varchar)) as h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units from documents),
draws as (
  select *, cast(len(units) as bigint) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from d),
cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
      then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from draws),
parts as (
  select *, coalesce(array_to_string(units[1:a], ''), '') as prefix, coalesce(array_to_string(units[a + 1:b], ''), '') as middle,
    coalesce(array_to_string(units[b + 1:n], ''), '') as suffix from cuts)
select doc_id, n, form, case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_top_k": exact_top_k,
        "op2_toxicity_scores": toxicity_scores,
        "op3_personal_data": personal_data,
        "op4_language_identification": language_identification,
        "op5_best_fit_packing": best_fit_packing,
        "op6_extendible_sharding": extendible_sharding,
        "op7_html_main_text": html_main_text,
        "op8_benchmark_decontamination": benchmark_decontamination,
        "op9_license_scan": license_scan,
        "op10_simhash_near_duplicates": simhash_near_duplicates,
        "op11_target_resampling": target_resampling,
        "op12_approximate_neighbours": approximate_neighbours,
        "op13_fill_in_middle": fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": TOP_K_SQL,
        "op6_extendible_sharding": SHARDING_SQL,
        "op8_benchmark_decontamination": DECONTAMINATION_SQL,
        "op11_target_resampling": RESAMPLING_SQL,
        "op13_fill_in_middle": FILL_MIDDLE_SQL,
    }
