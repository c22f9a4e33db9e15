"""A corpus from raw documents to a training mixture: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import quality_forest, secret_scan, simhash_trie, source_mix, winnowing
from ledgerloom.llm.common import table
from ledgerloom.session import materialize

#: Isolation forests and SimHash are no SQL; the operators behind the stages are tested against plain versions.
ORACLE_SQL = None


class Plain:
    """A table under plain column names, so that its own cannot clash with those of an operator."""

    def __init__(self, docs: DataFrame) -> None:
        self.names = docs.columns
        self.columns = [f"column{i}" for i in range(len(self.names))]
        self.docs = docs.toDF(*self.columns)

    def __getitem__(self, name: str) -> str:
        return self.columns[self.names.index(name)]

    def back(self, df: DataFrame, *more: str) -> DataFrame:
        return df.select(*(F.col(c).alias(n) for c, n in zip(self.columns, self.names)), *more)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the forest keep."""
    p = Plain(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(p["doc_id"]), "quality")
    judged = quality_forest.judge_quality(p.docs, labels, keep=p.columns, ident=p["doc_id"], text=p["text"])
    return p.back(judged.filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id (none: last), then the least digest of its row; of rows alike in all columns, one."""
    p = Plain(docs)
    # NULLs are no part of a digest, so where they stand is
    row = [*(F.isnull(c) for c in p.columns), *p.columns]
    marked = p.docs.withColumns({"digest1": F.xxhash64(F.lit(1), *row), "digest2": F.xxhash64(F.lit(2), *row)})
    groups = simhash_trie.near_duplicates(marked, ident=p["doc_id"], text=p["text"], keep=[p["doc_id"], "digest1", "digest2"])
    order = F.struct(F.isnull(p["doc_id"]).alias("no_id"), p["doc_id"], "digest1", "digest2")
    first = groups.groupBy("component").agg(F.min(order).alias("s")).select("s.digest1", "s.digest2")
    kept = marked.join(first, ["digest1", "digest2"], "left_semi").dropDuplicates(["digest1", "digest2"])
    return p.back(kept)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark item to count as contaminated."""
    p = Plain(docs)
    judged = winnowing.contamination(p.docs, table(spark, sf_dir, "benchmark"), ident=p["doc_id"], text=p["text"], keep=p.columns)
    return p.back(judged.filter("not contaminated"))


def secrets_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; spans whose value is not a widely copied example are replaced by a mark, and ``n_chars`` follows the text."""
    p = Plain(docs)
    scanned = secret_scan.scan_secrets(p.docs, owner=p["source"], repository=p["doc_id"], ident=p["doc_id"], text=p["text"], keep=p.columns)
    clean = secret_scan.redact(scanned.select(*p.columns, "owned_spans"), p["text"], "owned_spans")
    size = F.when(F.col("owned_spans") == "", F.col(p["n_chars"])).otherwise(F.char_length(p["text"]).cast("bigint"))
    return p.back(clean.withColumn(p["n_chars"], size))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, ``copy`` counting from 0."""
    p = Plain(docs)
    return p.back(source_mix.emit(source_mix.mix(p.docs, p["doc_id"], p["source"], p["text"])), "copy")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets_removed),
    ("source_mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
