"""Payment files under any known header, booked against balances as they arrive.

The stream carries the names of new files only. Each epoch resolves the header
of each of its files, sets files without the required columns and rows that
cannot be read aside, and books the rest against what is still due after the
epochs before. Everything an epoch writes has its number in the path and its
totals are saved last, so an epoch that is tried again replaces what it left
unfinished, and one that was finished is not booked again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import amount_text
from ..operators.decisions import reconcile, reconcile_rejects
from ..session import materialize
from ..sources.files import REQUIRED, path_exists, resolve_columns
from .logs import payment_table

# Headers a payment file may use, in lower case.
HEADERS = {
    "account": (["sk_id_curr", "account_id", "client_id", "account"], "string", REQUIRED),
    "amount": (["amount", "amount_paid", "amount_fcfa", "paid"], "string", REQUIRED),
    "paid_at": (["paid_at"], "timestamp_ntz", None),
    "payment_id": (["payment_id"], "string", None),
}
KINDS = {
    "booked": "account_id bigint, payment_id string, paid_at timestamp_ntz, amount decimal(18,2), due_before decimal(38,2), due_after decimal(38,2), outcome string",
    "rejected": "account string, amount string, payment_id string, reject_rule string",
    "audit": "account_id bigint, payment_id string, officer_name string, contact_outcome string, promise_amount decimal(18,2), notes string, created_at timestamp_ntz",
    "files": "path string, reject_rule string",
}


def new_files(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Names of the files of a folder (or pattern) as a stream; their content is not read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path).select("path")


def read_payment_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Rows of the files with their target columns as text, and the files that lack a required column.

    Files of one header are read together. A row without an own number is known
    by its file and place, one without a time by the time of its file.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(tuple(spark.read.option("header", True).csv(p).columns), []).append(p)
    parts, refused = [], []
    for header, files in groups.items():
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
        raw = spark.read.option("header", True).schema(schema).csv(files) if header else None
        try:
            if raw is None:
                raise ValueError("no columns")
            # the place of a row is kept as columns, which cannot be named like a header in use
            placed = raw.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_time"), F.monotonically_increasing_id().cast("string").alias("_place"))
            spec = HEADERS | {"_file": (["_path"], "string", None), "_at": (["_time"], "timestamp_ntz", None), "_n": (["_place"], "string", None)}
            parts.append(resolve_columns(placed, spec, case_insensitive=True))
        except ValueError:
            refused += [(f, "missing_columns") for f in files]
    empty = spark.createDataFrame([], "account string, amount string, paid_at timestamp_ntz, payment_id string, _file string, _at timestamp_ntz, _n string")
    rows = reduce(DataFrame.unionByName, parts, empty)
    own = F.concat_ws("#", "_file", "_n")
    return rows.select("account", "amount", F.coalesce("paid_at", "_at").alias("paid_at"), F.coalesce("payment_id", own).alias("payment_id")), refused


def book_epoch(spark: SparkSession, out: str, balances: DataFrame, paths: list[str], epoch: int, fold_after: int = 8) -> None:
    """Book the payments of one epoch's files; ``balances`` has ``account_id`` and ``balance_due``."""
    totals = payment_table(spark, f"{out}/totals", fold_after=fold_after)
    if totals.holds(epoch):
        return
    rows, refused = read_payment_files(spark, paths)
    given = materialize(rows.withColumn("account_id", F.col("account").try_cast("bigint")), "payment-files")
    readable = given.filter("account_id is not null")
    asked = balances.join(readable.select("account_id").distinct(), "account_id", "left_semi")
    if totals.started():
        paid = totals.read().select("account_id", F.col("paid").alias("_paid"))
        zero = F.lit(0).cast("decimal(38,2)")
        due = F.greatest(zero, F.col("balance_due") - F.coalesce("_paid", zero)).cast("decimal(38,2)").alias("balance_due")
        asked = asked.join(paid, "account_id", "left").select("account_id", due)
    asked = materialize(asked.select("account_id", "balance_due"), "payment-balances")
    booked = reconcile(asked, readable)
    # the same number may stand on several rows, so the rule is found on each row's own place
    placed = materialize(given.withColumn("_row", F.monotonically_increasing_id().cast("string")), "payment-rows")
    rules = reconcile_rejects(asked, placed.filter("account_id is not null").withColumn("payment_id", F.col("_row"))).select(F.col("payment_id").alias("_row"), "reject_rule")
    unreadable = placed.filter("account_id is null").select("_row", F.lit("unreadable_account").alias("reject_rule"))
    rejected = placed.join(rules.unionByName(unreadable), "_row").select("account", "amount", "payment_id", "reject_rule")
    _write(booked, out, "booked", epoch)
    done = spark.read.schema(KINDS["booked"]).parquet(f"{out}/booked/epoch={epoch}")
    _write(rejected, out, "rejected", epoch)
    note = F.concat(F.lit("Bulk payment settlement reconciled via CSV upload ("), amount_text(F.col("amount")), F.lit(" FCFA)."))
    _write(done.select("account_id", "payment_id", F.lit("Auto-Reconciliation").alias("officer_name"), F.col("outcome").alias("contact_outcome"),
                       F.col("amount").alias("promise_amount"), note.alias("notes"), F.col("paid_at").alias("created_at")), out, "audit", epoch)
    _write(spark.createDataFrame(refused, KINDS["files"]), out, "files", epoch)
    totals.save(done.groupBy("account_id").agg(F.sum("amount").cast("decimal(38,2)").alias("paid"), F.count(F.lit(1)).alias("payments")), epoch)


def _write(df: DataFrame, out: str, kind: str, epoch: int) -> None:
    wanted = df.sparkSession.createDataFrame([], KINDS[kind]).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in wanted]).write.mode("overwrite").parquet(f"{out}/{kind}/epoch={epoch}")


def book_payment_files(files: DataFrame, balances: DataFrame, out: str, checkpoint: str, fold_after: int = 8) -> StreamingQuery:
    """Book every file of the stream once."""

    def save(batch: DataFrame, epoch: int) -> None:
        # as many names as one trigger takes at most
        book_epoch(batch.sparkSession, out, balances, sorted(r["path"] for r in batch.collect()), epoch, fold_after)

    return files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def read_result(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """All epochs of one kind of result."""
    if not path_exists(spark, f"{out}/{kind}"):
        return spark.createDataFrame([], f"{KINDS[kind]}, epoch int")
    return spark.read.schema(f"{KINDS[kind]}, epoch int").parquet(f"{out}/{kind}")
