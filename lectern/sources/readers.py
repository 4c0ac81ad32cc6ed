"""Readers of a corpus' files as DataFrames with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

UNIT = "unit_id int, numeral string, section string, title string, text string, page int"
TOKEN = "text string, x1 double, y1 double, x2 double, y2 double"
LEDGER = "seq bigint, id string, ts timestamp, decision_type string, unit_id int, word_index int, chosen_source string, chosen_text string, snapshot string, needs_revisit boolean, note string, reviewer string, applied_decision_id string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def json_or_empty(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """A JSON file; a missing one is an empty table."""
    return spark.read.schema(schema).json(path, multiLine=not lines) if _exists(spark, path) else spark.createDataFrame([], schema)


def corpus(spark: SparkSession, path: str, wrapper: str = "units") -> DataFrame:
    """Units stored as a bare list or as one object around it."""
    rows = spark.read.schema(f"{UNIT}, {wrapper} array<struct<{UNIT}>>").json(path, multiLine=True)
    bare = rows.where(F.col("unit_id").isNotNull()).drop(wrapper)
    return bare.unionByName(rows.where(F.col(wrapper).isNotNull()).select(F.inline(wrapper)))


def corpus_parts(spark: SparkSession, paths: list[str], wrapper: str = "units") -> DataFrame:
    """Several parts together; a unit id in two of them is an error."""
    from functools import reduce

    all_ = reduce(DataFrame.unionByName, [corpus(spark, p, wrapper) for p in paths])
    twice = all_.groupBy("unit_id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"unit {twice[0][0]} is in the parts twice")
    return all_


def page_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(page, token_index, text, x1, y1, x2, y2) of a folder of page_N.json files, each a list of tokens."""
    raw = spark.read.text(f"{folder}/*.json", wholetext=True).select(F.regexp_extract("_metadata.file_name", r"(\d+)", 1).cast("long").alias("page"), F.from_json("value", f"array<struct<{TOKEN}>>").alias("t"))
    return raw.select("page", F.posexplode("t").alias("token_index", "t")).select("page", "token_index", "t.*")


def missing_pages(tokens: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.select("page").join(tokens.select("page"), "page", "left_anti")


def sections(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(unit_id, text) of a text file cut at lines that match ``header``, whose first group is the id; text before
    the first header, or of a file without one, is unit 0."""
    t = spark.read.text(path, wholetext=True)
    ids = F.concat(F.array(F.lit("0")), F.regexp_extract_all("value", F.lit(f"(?m)^{header}.*$"), F.lit(1)))
    parts = F.split("value", f"(?m)^{header}.*$")
    return t.select(F.inline(F.arrays_zip(ids.alias("unit_id"), parts.alias("text")))).select(F.col("unit_id").cast("int"), F.trim(F.regexp_replace("text", r"^\s+|\s+$", "")).alias("text")).where("text <> ''")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger of JSON lines, blank lines skipped."""
    return json_or_empty(spark, path, LEDGER, lines=True).where("id is not null")


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("form")).where("form <> ''").distinct()


def nested_texts(spark: SparkSession, path: str) -> DataFrame:
    """Every string of an arbitrarily nested tree of lists and objects: (book, text), the book by file name."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("book"), "value")
    pattern = F.lit(r'"((?:[^"\\]++|\\.)*+)"(\s*:)?')
    found = F.arrays_zip(F.regexp_extract_all("value", pattern, F.lit(1)).alias("s"), F.regexp_extract_all("value", pattern, F.lit(2)).alias("key"))
    text = F.from_json(F.concat(F.lit('["'), F.col("s"), F.lit('"]')), "array<string>")
    return raw.select("book", F.inline(found)).where("key = ''").select("book", F.get(text, F.lit(0)).alias("text"))
