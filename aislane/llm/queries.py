"""The package's registered queries, and the same in DuckDB's SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.llm import (
    balltree,
    decontam,
    exact,
    katz,
    languages,
    pieces,
    quality,
    secrets,
    simhash,
    tokenbin,
    toxicity,
    urls,
    whitening,
)
from aislane.llm.common import ready, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(table(spark, sf_dir, "documents"))
    good = (F.col("score") >= quality.KEEP_FROM).cast("int")
    return scored.select("doc_id", "posterior", "score", "n_votes", good.alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_classes(table(spark, sf_dir, "documents"), simhash.CONTRACT)
    return classes.select("doc_id", F.lower(F.hex("code")).alias("fingerprint"), "component_id")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = tokenbin.shard_folder(spark)
    manifest = tokenbin.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    return tokenbin.read_shards(manifest, folder)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = exact.exact_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    counted = hits.withColumn("n_hit", decontam.hit_words())
    return counted.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_odds")


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.held_out_languages(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_token_ids": op4_token_ids,
    "op5_pieces": op5_pieces,
    "op6_secrets": op6_secrets,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_katz": op9_katz,
    "op10_urls": op10_urls,
    "op11_ball_tree": op11_ball_tree,
    "op12_language": op12_language,
    "op13_whitening": op13_whitening,
}

_WORDS = r"""
  regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words"""

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": r"""
with plain as (
  select doc_id, length(coalesce(text, '')) as n_chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as plain
  from documents),
placed as (
  select *, first_value(doc_id) over w as keep_id, count(*) over (partition by plain) as group_size
  from plain window w as (partition by plain order by n_chars desc, doc_id))
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(plain) as text_sha256 from placed""",
    "op8_decontamination": f"""
with item as (select item_id, {_WORDS} from benchmark),
docs as (select doc_id, {_WORDS} from documents),
windows as (
  select distinct item_id, least(len(words), 10) as size,
    array_to_string(words[pos : pos + least(len(words), 10) - 1], ' ') as shingle
  from (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as pos from item where len(words) > 0)),
sizes as (select distinct size from windows),
places as (
  select doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') as shingle
  from (select doc_id, words, size, unnest(range(1, greatest(len(words) - size + 1, 0) + 1)) as pos from docs, sizes)),
hits as (select p.doc_id, p.pos, p.size, w.item_id from places p join windows w using (size, shingle)),
hit_words as (
  select doc_id, count(distinct word) as n_hit
  from (select doc_id, unnest(range(pos, pos + size)) as word from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hit_words using (doc_id) left join hit_items using (doc_id)""",
    "op11_ball_tree": f"""
with texts as (select row_number() over () as doc, doc_id, {_WORDS} from documents),
asked as (
  select row_number() over () as item, item_id, {_WORDS}
  from (select distinct item_id, coalesce(text, '') as text from benchmark)),
counted as (select doc, doc_id, len(words) as n, words from texts where len(words) > 0),
whole as (select count(*) as docs, cast(sum(n) as bigint) as total from counted),
held as (select doc, term, count(*) as tf from (select doc, unnest(words) as term from counted) group by doc, term),
wanted as (select item, item_id, term, count(*) as times
  from (select item, item_id, unnest(words) as term from asked) group by all),
weighed as (
  select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
  from held, whole where term in (select term from wanted) group by term),
scored as (
  select item, item_id, c.doc, doc_id,
    cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) as bigint) as score
  from wanted join weighed using (term) join held using (term) join counted c using (doc), whole
  group by item, item_id, c.doc, doc_id),
placed as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from placed where rank <= 20""",
}
