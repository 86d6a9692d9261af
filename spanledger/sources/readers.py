"""Readers: JSON lines, whole texts, pages, catalogs, annotator output, optional tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

# Record schemas as DDL.
PAGES = "doc_id STRING, page_number INT, text STRING, char_count INT"
SPANS = "doc_id STRING, seq BIGINT, span_id STRING, kind STRING, section STRING, path ARRAY<STRING>, byte_start BIGINT, byte_end BIGINT, text STRING"
ANNOTATIONS = "doc_id STRING, span_id STRING, agent STRING, label STRING, embedded ARRAY<STRING>, reason STRING, confidence STRING"
STATEMENTS = "doc_id STRING, seq BIGINT, req_id STRING, source_span_id STRING, verbatim_quote STRING, atomic_statement STRING, modality STRING, applicability_tags ARRAY<STRING>, ambiguous BOOLEAN"
EDGES = "doc_id STRING, seq BIGINT, rel_id STRING, src STRING, dst STRING, type STRING, evidence STRING, ambiguous BOOLEAN"
CLAIMS = "doc_id STRING, stage STRING, batch_id STRING, status STRING, item_count INT, item_ids ARRAY<STRING>"


class BadRecords(ValueError):
    """A strict read met lines that are not of the schema."""


def json_lines(spark: SparkSession, path: str, schema: str | StructType, missing_ok: bool = False) -> DataFrame:
    """Lines of JSON; blank lines are skipped. missing_ok: a path without files is an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def json_lines_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """json_lines, but a line which does not parse raises BadRecords with its file and number. Only then is that one file read whole, to count."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), "value").filter(F.trim("value") != "")
    parsed = lines.withColumn("row", F.from_json("value", f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    first = parsed.filter("row._corrupt IS NOT NULL").select("file", "value").head(1)
    if first:
        file, bad = first[0]["file"], first[0]["value"]
        at = spark.read.text(file, wholetext=True).select(F.array_position(F.split("value", "\r?\n"), bad).alias("n")).first()["n"]
        raise BadRecords(f"{file}:{at}: {bad[:200]}")
    return parsed.select("row.*").drop("_corrupt")


def json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object per file; files that do not parse are dropped."""
    raw = spark.read.schema(f"{schema}, _corrupt STRING").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True)
    return raw.withColumn("file", F.input_file_name()).filter("_corrupt IS NULL").drop("_corrupt")  # read with the file, so that the corrupt column never stands alone


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """file, n_bytes, sha256 of binary files."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def catalog(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The registry rows of root/<jurisdiction>/<slug>/meta.json, by document id."""
    at = json_objects(spark, f"{root.rstrip('/')}/*/*/meta.json", schema)
    return at.withColumn("doc_id", F.regexp_extract("file", r"/([^/]+/[^/]+)/meta\.json$", 1)).filter(valid_doc_id(F.col("doc_id"))).drop("file")


def bad_metas(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The meta.json files that catalog drops: they do not parse, or their folders name no document (review_site is none)."""
    doc_id = F.regexp_extract("file", r"/([^/]+/[^/]+)/meta\.json$", 1)
    found = whole_texts(spark, f"{root.rstrip('/')}/*/*/meta.json").withColumn("doc_id", doc_id).filter(~F.startswith("doc_id", F.lit("review_site/")))
    row = F.from_json("text", f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return found.withColumn("row", row).filter(F.col("row._corrupt").isNotNull() | F.col("row").isNull() | ~valid_doc_id(F.col("doc_id"))).select("file")


def valid_doc_id(doc_id):
    """<jurisdiction>/<slug>; what does not match never becomes part of a path."""
    return doc_id.rlike("^[a-z]+/[a-z0-9][a-z0-9-]{0,119}$")


def annotator_output(requests: DataFrame, annotations: DataFrame) -> DataFrame:
    """requests (doc_id, span_id, agent) with what annotators said; missing tells which have no answer."""
    t = requests.join(annotations.withColumn("answered", F.lit(True)), ["doc_id", "span_id", "agent"], "left")
    return t.withColumn("missing", F.col("answered").isNull()).drop("answered")


def require_answers(requests: DataFrame, annotations: DataFrame) -> DataFrame:
    """annotator_output, but a request without an answer raises BadRecords and is named."""
    out = annotator_output(requests, annotations)
    first = out.filter("missing").select("doc_id", "span_id", "agent").head(1)
    if first:
        raise BadRecords("no answer of {2} for {1} of {0}".format(*first[0]))
    return out.drop("missing")
