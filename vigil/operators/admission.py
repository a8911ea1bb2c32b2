"""Which uploaded files are taken, what they hold and where they go.

All operators work on a manifest: one row per file with `path` and `size`.
"""

import re
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from vigil import constants as C
from vigil.functions.text import dataset_type_of, file_extension, sanitize_key


def admit_files(manifest: DataFrame) -> DataFrame:
    """Add extension, reason and valid; the format is judged before the size."""
    extension, size = F.col("extension"), F.col("size")
    reason = (
        F.when(~extension.isin(C.FILE_EXTENSIONS),
               F.concat(F.lit("Unsupported file format: "), extension))
        .when(size > C.MAX_FILE_BYTES,
              F.concat(F.lit("File size "), size.cast("string"),
                       F.lit(f" exceeds maximum {C.MAX_FILE_BYTES}"))))
    return manifest.withColumn("extension", file_extension(F.col("path"))) \
        .withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def with_dataset_type(manifest: DataFrame, match: str = "token") -> DataFrame:
    return manifest.withColumn("dataset_type", dataset_type_of(F.col("path"), match))


def default_tags(manifest: DataFrame) -> DataFrame:
    """Fill the required tags where they are absent."""
    defaults = {"dataset_type": C.DATASET_TYPES[0], "source_organization": "unknown"}
    return manifest.withColumns({
        c: F.coalesce(c, F.lit(v)) if c in manifest.columns else F.lit(v)
        for c, v in defaults.items()})


def processing_results(admitted: DataFrame, failed: Column | None = None) -> DataFrame:
    """Per file: status success, failed or error, and the reason.

    `failed` gives the message of files whose processing raised, null otherwise.
    """
    error = F.lit(None).cast("string") if failed is None else failed
    status = F.when(error.isNotNull(), "error").when(F.col("valid"), "success") \
        .otherwise("failed")
    return admitted.select("path", status.alias("status"),
                           F.coalesce(error, "reason").alias("reason"))


def processing_summary(results: DataFrame) -> DataFrame:
    """Files per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("processed"))


def relative_key(path: Column, root: str) -> Column:
    """The path below root; scheme, authority and leading slashes do not count."""
    bare = F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    start = "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", root).strip("/") + "/"
    below = F.when(F.startswith(bare, F.lit(start)), F.substr(bare, F.lit(len(start) + 1)))
    return F.coalesce(below, F.ltrim(bare, F.lit("/")))


def quarantine(rejected: DataFrame, day: date, root: str | None = None) -> DataFrame:
    """Give rejected files their key under quarantine/yyyy/MM/dd/, relative to root."""
    key = F.col("path") if root is None else relative_key(F.col("path"), root)
    return rejected.withColumns({
        "quarantine_date": F.lit(day),
        "quarantine_key": F.concat(F.lit(f"quarantine/{day:%Y/%m/%d}/"), key),
    })


def sanitized_names(manifest: DataFrame) -> DataFrame:
    name = F.regexp_replace("path", r"^.*/", "")
    return manifest.withColumn("file_name", sanitize_key(name))
