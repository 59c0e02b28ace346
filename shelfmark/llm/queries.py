"""The operators as queries ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import (
    chat,
    collocations,
    decontamination,
    jaccard,
    licenses,
    line_dedup,
    neighbours,
    packing,
    quality,
    quality_rules,
    toxicity,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_toxicity(spark, sf_dir):
    return toxicity.op3(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.op2(_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard.op9(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    return decontamination.op7(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_packing(spark, sf_dir):
    return packing.op5(_table(spark, sf_dir, "documents"))


def op6_neighbours(spark, sf_dir):
    return neighbours.op6(_table(spark, sf_dir, "embeddings"))


def op8_license_scan(spark, sf_dir):
    return licenses.op8(_table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    return warc.op4(_table(spark, sf_dir, "pages"))


def op10_chat_format(spark, sf_dir):
    return chat.op10(_table(spark, sf_dir, "conversations"))


def op1_quality(spark, sf_dir):
    return quality.op1(_table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations.op11(_table(spark, sf_dir, "documents"))


def op12_quality_rules(spark, sf_dir):
    return quality_rules.op12(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_whitening(spark, sf_dir):
    return whitening.op13(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_neighbours": op6_neighbours,
    "op7_decontamination": op7_decontamination,
    "op8_license_scan": op8_license_scan,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_chat_format": op10_chat_format,
    "op11_collocations": op11_collocations,
    "op12_quality_rules": op12_quality_rules,
    "op13_whitening": op13_whitening,
}
