"""Registered queries of the operators: name, query, and DuckDB statement where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.llm import bit_planes, bpe, exact_dedup, fingerprints, graph_index, licenses, line_dedup, mixing
from mercatura.llm import near_dedup, periodic_runs, secrets, sql, substring_dedup, toxicity
from mercatura.llm.common import documents


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(documents(spark, folder)))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.summary(secrets.scan(documents(spark, folder)))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.find_groups(documents(spark, folder))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digests(documents(spark, folder))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.find_groups(documents(spark, folder), words=2)


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder))


def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_graph_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return graph_index.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op10_fuzzy_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.kept_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_bit_plane_clusters(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    found = bit_planes.inertia(bit_planes.cluster(vectors, clusters=8, rounds=10, scale=1024, seed="3"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(documents(spark, folder))
    return periodic_runs.digests(periodic_runs.runs_of(docs))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.digests(fingerprints.compare_neighbours(documents(spark, folder)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_secret_scan,
        op3_exact_dedup,
        op4_substring_dedup,
        op5_minhash_near_dedup,
        op6_bpe,
        op7_mix_sources,
        op8_toxicity,
        op9_graph_neighbours,
        op10_fuzzy_line_dedup,
        op11_bit_plane_clusters,
        op12_periodic_runs,
        op13_fingerprints,
    )
}

SQL: dict[str, str] = {
    "op3_exact_dedup": sql.EXACT_DEDUP,
    "op4_substring_dedup": sql.SUBSTRING_DEDUP,
    "op5_minhash_near_dedup": sql.NEAR_DEDUP,
    "op7_mix_sources": sql.MIX_SOURCES,
    "op11_bit_plane_clusters": sql.CLUSTERS,
}
