"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matricula.llm import contamination, jaccard, language, license, manifest, mixing, neighbours, pii, ranking, simhash, sql, suffixes, toxicity, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.license_labels(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), jaccard.Rule(size=4, percent=85))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def source_domain(source: Column) -> Column:
    """The documents name no domain; sources are dealt to four by the number in their name."""
    return F.concat(F.lit("d"), F.coalesce(F.try_to_number(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("999999999")), F.lit(0)).cast("int") % 4)


def mix_weights(spark: SparkSession) -> DataFrame:
    """Stated target weights; a node that is not listed has weight 1."""
    return spark.sql("SELECT * FROM VALUES ('d0', 4), ('d1', 3), ('d2', 2), ('d3', 1), ('d0/en', 3), ('d1/en', 2), ('d2/en', 2), ('d0/es', 2) AS t(path, weight)")


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs, mix_weights(docs.sparkSession), source_domain(F.col("source")), total=0.6, epochs=3, seed=7)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"), manifest.tampered_leaf())


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top; it uses this module

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {f.__name__: f for f in (op1_license_scan, op2_near_duplicates, op3_personal_data, op4_mix_sources, op5_language, op6_nearest, op7_url_filter, op8_decontaminate, op9_toxicity, op10_repeated_passages, op11_merkle_manifest, op12_simhash, op13_ranked_search, pipeline)}
LLM_SQL: dict[str, str] = {"op4_mix_sources": sql.mix(), "op8_decontaminate": sql.DECONTAMINATE, "op11_merkle_manifest": sql.MERKLE, "op13_ranked_search": sql.RANK}
