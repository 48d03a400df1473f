"""Index documents: building, ids, schemas, upserts, bulk lines, batches."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake import schemas
from scanlake.functions import nested, paths
from scanlake.operators.ordered import running_rank
from scanlake.sources.records import json_text

# Fixed values of the summary document.
NO_SECRETS_TYPE = "NO_SECRETS_FOUND"
NO_SECRETS_TEXT = "No secrets found in repository"

# Fixed value: documents per flush.
BULK_SIZE = 50


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns and types of a document schema, after the kept columns."""
    return df.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def secret_documents(scans: DataFrame, index: str = "secrets") -> DataFrame:
    """One document per finding; a scan without findings gives one summary document.

    The summary is also written for failed scans, so read scan_status before calling a
    repository clean. The finding's service is dropped. In-row explode, no shuffle.
    """
    rows = scans.select(
        "org", "name", "scanned_at", "processed_at", "scan_status", "worker_id",
        F.posexplode_outer("valid_secrets").alias("idx", "f"),
    )
    none = F.col("idx").isNull()

    def part(field: str, empty) -> Column:
        return F.when(none, F.lit(empty)).otherwise(F.col(f"f.{field}"))

    org, name = F.col("org"), F.col("name")
    doc_id = F.when(none, paths.summary_id(org, name, F.col("scanned_at"))).otherwise(
        paths.finding_id(org, name, F.col("f.commit"), F.col("f.line"), F.col("idx"))
    )
    docs = rows.select(
        F.lit(index).alias("index"),
        doc_id.alias("id"),
        org.alias("organization"),
        name.alias("repository"),
        part("secret_type", NO_SECRETS_TYPE).alias("secret_type"),
        part("description", NO_SECRETS_TEXT).alias("description"),
        part("file", "").alias("file_path"),
        part("line", 0).alias("line_number"),
        part("commit", "").alias("commit_hash"),
        part("confidence", "").alias("confidence"),
        part("validated", False).alias("validated"),
        "scanned_at", "processed_at", "scan_status", "worker_id",
    )
    return conform(docs, schemas.SECRET_DOCUMENT, keep=("index", "id"))


def vulnerability_documents(
    scans: DataFrame, index: str = "vulnerabilities", band_scores: bool = False
) -> DataFrame:
    """One document per scan with severity counts and the indexed vulnerability fields.

    vulnerability_count is the record's own count; details, aliases and fixed are dropped.
    """
    # Zipping field arrays stays in generated code, unlike building structs in a lambda.
    found = F.col("vulnerabilities")
    zipped = F.arrays_zip(*[found[name].alias(name) for name in schemas.INDEXED_VULNERABILITY.names])
    indexed = F.coalesce(zipped.cast(T.ArrayType(schemas.INDEXED_VULNERABILITY)), F.array())
    counts = nested.severity_counts(F.col("vulnerabilities"), band_scores)
    docs = scans.withColumn("_counts", counts).select(
        F.lit(index).alias("index"),
        paths.vulnerability_id(F.col("org"), F.col("name"), F.col("scanned_at")).alias("id"),
        F.col("org").alias("organization"),
        F.col("name").alias("repository"),
        F.col("vulnerabilities_found").alias("vulnerability_count"),
        "_counts.*",
        "scanned_at", "processed_at", "scan_status", "scan_duration", "worker_id", "error_message",
        indexed.alias("vulnerabilities"),
    )
    return conform(docs, schemas.VULNERABILITY_DOCUMENT, keep=("index", "id"))


def latest_documents(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The last write of each key. A map-side combined aggregate: a hot key shrinks to one
    row per task before the shuffle."""
    body = [name for name in df.columns if name not in keys]
    last = F.max_by(F.struct(*body), F.struct(*seq)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def upsert_documents(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], seq: Sequence[str]
) -> DataFrame:
    """The target with the batch written over it: last write wins, the batch wins ties.

    The target holds one row per key. A target stored bucketed by the keys is not shuffled
    again, and neither side has a hot key once the batch is reduced.
    """
    body = [name for name in target.columns if name not in keys]
    new = latest_documents(batch.select(*target.columns), keys, seq)
    old = target.select(*keys, F.struct(*seq).alias("_old_seq"), F.struct(*body).alias("_old"))
    new = new.select(*keys, F.struct(*seq).alias("_new_seq"), F.struct(*body).alias("_new"))
    keep_old = F.col("_new").isNull() | F.coalesce(F.col("_old_seq") > F.col("_new_seq"), F.lit(False))
    kept = F.when(keep_old, F.col("_old")).otherwise(F.col("_new"))
    merged = old.join(new, list(keys), "full").select(*keys, kept.alias("_kept"))
    return merged.select(*keys, "_kept.*").select(*target.columns)


def bulk_pairs(
    docs: DataFrame, index: str = "index", id: str = "id", omit_empty: Sequence[str] = ()
) -> DataFrame:
    """(index, id, action, body): the two JSON lines of each document."""
    fields = [f for f in docs.schema if f.name not in (index, id)]
    action = F.struct(F.struct(F.col(id).alias("_id"), F.col(index).alias("_index")).alias("index"))
    return docs.select(
        index, id, F.to_json(action).alias("action"), json_text(fields, omit_empty).alias("body")
    )


def bulk_lines(
    docs: DataFrame, index: str = "index", id: str = "id", omit_empty: Sequence[str] = ()
) -> DataFrame:
    """Per document the action line (pos 0), then the body line (pos 1)."""
    pairs = bulk_pairs(docs, index, id, omit_empty)
    return pairs.select(index, id, F.posexplode(F.array("action", "body")).alias("pos", "line"))


def write_bulk(docs: DataFrame, path: str, **kwargs) -> None:
    """Bulk payload files: both lines of a document go out as one text, so they stay together."""
    pairs = bulk_pairs(docs, **kwargs)
    pairs.select(F.concat_ws("\n", "action", "body").alias("value")).write.mode("overwrite").text(path)


def assign_batches(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str],
    slice_by: Column | str,
    size: int = BULK_SIZE,
) -> DataFrame:
    """Add batch (from 0) and position (from 1): flushes of ``size`` documents per source.

    ``slice_by`` cuts a hot source's order, see ``ordered``.
    """
    if size <= 0:
        raise ValueError("size must be greater than 0")
    ranked = running_rank(df, keys, order, slice_by, "_rank")
    at = F.col("_rank") - 1
    return (
        ranked.withColumn("batch", F.floor(at / size))
        .withColumn("position", (at % size + 1).cast("int"))
        .drop("_rank")
    )


def severity_rollup(
    findings: DataFrame, keys: Sequence[str], severity: str = "severity", band_scores: bool = False
) -> DataFrame:
    """The five severity counts of flat findings per key."""
    level = nested.severity_level(F.col(severity), band_scores)
    counts = [
        F.count_if(level == name).alias(f"{name}_count") for name in (*nested.SEVERITIES, "unknown")
    ]
    return findings.groupBy(*keys).agg(*counts)
