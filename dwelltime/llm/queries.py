"""The operators as queries over the corpus tables, with production parameters and over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwelltime.llm import (bag_minhash, compact_windows, conversation_trie, corpus_sql, decontaminate, fingerprints,
                           importance, lm_scoring, personal_data, quality_rules, run_length_index, sentencepiece, sharding, warc)
from dwelltime.llm.tables import prepare, table


def op1_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.passages(table(prepare(spark), sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(prepare(spark), sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(table(prepare(spark), sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(prepare(spark), sf_dir, "documents"))


def op5_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_length_index.remove_repeats(table(prepare(spark), sf_dir, "documents"))


def op6_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.classes(table(prepare(spark), sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(prepare(spark), sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_index(table(prepare(spark), sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matches(docs, benchmark).drop("key")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.learn(docs, table(spark, sf_dir, "labels")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(prepare(spark), sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(prepare(spark), sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, benchmark)


QUERIES = {
    "op1_compact_windows": op1_compact_windows,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_personal_data": op4_personal_data,
    "op5_run_length_index": op5_run_length_index,
    "op6_bag_minhash": op6_bag_minhash,
    "op7_sharding": op7_sharding,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_importance_resampling": op13_importance_resampling,
}

# A shard is the first prefix of a document's hash whose documents fit the limit.
OP7_SQL = """
with sized as (
  select doc_id, coalesce(octet_length(encode(text)), 0)::bigint as n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as bits
  from documents),
levels as (
  select s.*, d.depth, s.bits >> (60 - d.depth) as prefix
  from sized s cross join (select unnest(range(0, 31))::int as depth) d),
sums as (select depth, prefix, sum(n_bytes) as held from levels group by all),
first as (
  select l.doc_id, l.n_bytes, min(l.depth) as depth
  from levels l join sums s using (depth, prefix) where s.held <= 1048576 group by all)
select f.doc_id, f.n_bytes,
       case when f.depth = 0 then '' else lpad(bin(l.prefix), f.depth, '0') end as shard
from first f join levels l using (doc_id, depth)
"""

ORACLES: dict[str, str] = {
    "op7_sharding": OP7_SQL,
    "op11_conversation_trie": corpus_sql.OP11,
    "op13_importance_resampling": corpus_sql.OP13,
}
