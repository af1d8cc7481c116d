"""Control table (S1-S3): one record per feed, drives landing and loading.

The control file is one multi-line JSON document ``{schema_version,
sources: [...]}``, read with a declared schema (no inference, FAILFAST) and
turned into one row per source with ``inline``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("description", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("auth_type", T.StringType()),
    T.StructField("secret_name", T.StringType()),
    T.StructField("http_method", T.StringType()),
    T.StructField("response_format", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("landing_container", T.StringType()),
    T.StructField("landing_path_template", T.StringType()),
    T.StructField("file_name_template", T.StringType()),
    T.StructField("incremental_strategy", T.StringType()),
    T.StructField("date_window_days", T.IntegerType()),
    T.StructField("notes", T.StringType()),
])
CONTROL = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("sources", T.ArrayType(SOURCE)),
])

# Fixed values that must equal the reference's: the placeholder replaced in
# path and file templates, the date format it takes, and the documented
# values of the control fields ("header" auth is documented but has no
# landing branch; the control file itself also uses "once" and "annual").
PLACEHOLDER = "{ingest_date}"
DATE_FORMAT = "yyyy-MM-dd"
AUTH_TYPES = ("none", "api_key", "header")
RESPONSE_FORMATS = ("json", "csv")
DOCUMENTED_FREQUENCIES = ("daily", "monthly", "quarterly")


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """One row per source record (plus ``schema_version``)."""
    doc = (spark.read.schema(CONTROL).option("multiLine", True).option("mode", "FAILFAST")
           .json(path))
    return doc.select("schema_version", F.inline("sources"))


def enabled_sources(control: DataFrame, auth_type: str | None = None) -> DataFrame:
    """Enabled records, optionally of one ``auth_type``. An unknown auth
    type raises instead of being skipped silently (trap T13)."""
    known = F.col("auth_type").isin(*AUTH_TYPES)
    checked = control.withColumn("auth_type", F.when(known, F.col("auth_type")).otherwise(
        F.raise_error(F.concat(F.lit("unknown auth_type: "), F.coalesce(F.col("auth_type"),
                                                                        F.lit("NULL"))))))
    out = checked.filter(F.col("enabled"))
    if auth_type is not None:
        out = out.filter(F.col("auth_type") == auth_type)
    return out


def _date_col(ingest_date) -> Column:
    if isinstance(ingest_date, Column):
        return F.date_format(ingest_date, DATE_FORMAT)
    if isinstance(ingest_date, (dt.date, dt.datetime)):
        ingest_date = ingest_date.strftime("%Y-%m-%d")
    return F.date_format(F.lit(str(ingest_date)).cast("date"), DATE_FORMAT)


def landing_plan(control: DataFrame, ingest_date) -> DataFrame:
    """S3: ``DF[source_id, auth_type, url, dir, file, path]`` for one run date.

    Templates without the placeholder pass through unchanged.
    """
    d = _date_col(ingest_date)
    ph = F.lit(PLACEHOLDER)
    dir_ = F.replace(F.col("landing_path_template"), ph, d)
    file_ = F.replace(F.col("file_name_template"), ph, d)
    return control.select(
        "source_id", "auth_type", F.replace(F.col("base_url"), ph, d).alias("url"),
        dir_.alias("dir"), file_.alias("file"),
        F.concat_ws("/", F.col("landing_container"), dir_, file_).alias("path"))


def validate_control(control: DataFrame) -> DataFrame:
    """Data tests of the control table (one aggregate pass plus the key check).

    Unknown auth types and response formats are errors; a frequency outside
    the documented list is a warning (trap T13b: the reference's own file has
    ``once`` and ``annual``).
    """
    from ..operators.quality import accepted_values, not_null, run_checks, unique
    return run_checks(control, [
        not_null("source_id"), unique("source_id"),
        accepted_values("auth_type", AUTH_TYPES),
        accepted_values("response_format", RESPONSE_FORMATS),
        accepted_values("frequency", DOCUMENTED_FREQUENCIES, severity="warn"),
    ])
