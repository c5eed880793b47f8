"""Truth files, page ledgers and fact files (OP-S2 to S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRUTH = "orgnr string, journalnr string, period_from string, period_to string, regnskapstype string, oppstillingsplan string, valuta string, key_metrics map<string,double>, flat_numbers map<string,double>"
DIFF = "orgnr string, concept_id string, period_end string, kind string, v1_value double, v2_value double, abs_delta double, rel_delta double"


def truth_of_json(df: DataFrame, text: str) -> DataFrame:
    """Truth records from JSON texts (OP-S4): the number is required, missing metrics are an empty map."""
    out = df.select(*[c for c in df.columns if c != text], F.from_json(text, TRUTH).alias("t")).select(*[c for c in df.columns if c != text], "t.*")
    out = out.withColumn("key_metrics", F.coalesce("key_metrics", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))))
    return out.where(F.when(F.col("orgnr").isNull(), F.raise_error(F.lit("record without orgnr")).cast("boolean")).otherwise(True))


def read_truth(spark: SparkSession, folder: str) -> DataFrame:
    """Truth records of a folder of JSON files, local or in an object store (OP-S2, S3); of one number the last file counts."""
    files = spark.read.text(f"{folder.rstrip('/')}/*.json", wholetext=True).select(F.input_file_name().alias("file"), "value")
    records = truth_of_json(files, "value")
    rest = [c for c in records.columns if c not in ("orgnr", "file")]
    return records.groupBy("orgnr").agg(F.max_by(F.struct(*rest), "file").alias("r")).select("orgnr", "r.*")


def ledger_records(cells: DataFrame, consensus: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """One record per page: who took part, every observer's cells, consensus and diagnostics (OP-S5)."""
    page = ["doc_id", "page_no"]
    cell = F.struct("text", "confidence", "bbox", "from_ocr")
    by_voter = cells.groupBy(*page, "voter").agg(F.array_sort(F.collect_list(F.struct("cell_idx", cell.alias("cell")))).alias("c")).groupBy(*page).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("voter", F.transform("c", lambda x: x["cell"]).alias("cells"))))).alias("per_voter"))
    agreed = consensus.groupBy(*page).agg(F.transform(F.array_sort(F.collect_list(F.struct("cell_idx", "text", "confidence"))), lambda x: F.struct(x["text"].alias("text"), x["confidence"].alias("confidence"))).alias("consensus"))
    judged = diagnostics.groupBy(*page).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cluster_id", F.struct("consensus_text", "voters_hit", "voters_attempted").alias("d"))))).alias("diagnostics"))
    joined = by_voter.join(agreed, page, "left").join(judged, page, "left")
    meta = F.struct(F.lit("v2").alias("audit_schema_version"), F.unix_timestamp(F.current_timestamp()).cast("double").alias("ts"), F.col("doc_id").alias("document_id"), "page_no", F.map_keys("per_voter").alias("voters"))
    return joined.select(meta.alias("_meta"), "per_voter", "consensus", "diagnostics")


def write_ledger(records: DataFrame, folder: str | None) -> None:
    """Append page records as JSON lines; nothing where no folder is given (OP-S5)."""
    if folder is not None:
        records.write.mode("append").json(folder)


def write_lines(df: DataFrame, json: str, folder: str) -> int:
    """One JSON object a line; the number of lines (OP-S6), counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.select(F.col(json).alias("value")).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(folder)
    return seen.get["n"]


def write_diff(entries: DataFrame, folder: str) -> int:
    """Diff entries as parquet with the fixed schema, also where there are none (OP-S7); their number."""
    from pyspark.sql import Observation

    seen = Observation()
    fields = [f.strip().split(" ") for f in DIFF.split(",")]
    entries.select(*[F.col(n).cast(t).alias(n) for n, t in fields]).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    return seen.get["n"]


def write_documents(documents: DataFrame, folder: str) -> None:
    """Exchange documents, a folder per entity (OP-S8)."""
    documents.select("entity", F.col("document").alias("value")).write.mode("overwrite").partitionBy("entity").text(folder)
