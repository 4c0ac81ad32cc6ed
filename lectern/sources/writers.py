"""Sinks: JSON, plain text and page layouts in XML."""

from __future__ import annotations

import json
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, functions as F


def json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


# What a ledger's row may decide.
TYPES = ("candidate_choice", "disputed_choice", "manual_correction", "klal_flag", "punctuation_choice", "witness_choice", "apply_event")


def stamped(rows: DataFrame, after: int) -> DataFrame:
    """Rows with ``seq`` from ``after`` + 1 on, an ``id`` of twelve hex digits and the time in UTC, ready to append.

    A row of another type than a ledger knows is an error when the rows are written, and nothing is appended. seq grows
    but may leave gaps."""
    checked = F.when(F.col("decision_type").isin(*TYPES), F.col("decision_type")).otherwise(F.raise_error(F.concat(F.lit("no such decision type: "), F.coalesce("decision_type", F.lit("null")))))
    return rows.withColumn("decision_type", checked).withColumn("seq", F.monotonically_increasing_id() + after + 1).withColumn("id", F.left(F.replace(F.uuid(), F.lit("-"), F.lit("")), F.lit(12))).withColumn("ts", F.current_timestamp())


def append(rows: DataFrame, ledger: DataFrame, path: str) -> None:
    """New rows behind those of a ledger kept as JSON lines."""
    json_lines(stamped(rows, ledger.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]), path)


def apply_events(outcomes: DataFrame) -> DataFrame:
    """The ledger rows that tell which decisions were put into the texts: one for each applied or confirmed."""
    return outcomes.where(F.col("outcome").isin("applied", "confirmed")).select(F.lit("apply_event").alias("decision_type"), "unit_id", F.col("id").alias("applied_decision_id"))


def small_json(df: DataFrame, path: str) -> None:
    """One indented JSON list, streamed row by row; for outputs that fit a file."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for k, row in enumerate(df.toLocalIterator()):
            f.write(("," if k else "") + "\n  " + json.dumps(row.asDict(True), ensure_ascii=False, indent=2, default=str).replace("\n", "\n  "))
        f.write("\n]\n")


def plain(units: DataFrame, path: str, headed: bool = False) -> None:
    """Texts in order of units, with a heading line each if asked."""
    line = F.concat(F.lit("=== "), F.col("unit_id").cast("string"), F.lit(" "), F.coalesce("title", F.lit("")), F.lit("\n"), F.col("text")) if headed else F.col("text")
    units.orderBy("unit_id").select(line.alias("value")).write.mode("overwrite").text(path)


def _alto(page, f) -> str:
    at = lambda v: str(int(v * 10000))
    words = "".join(f"<String CONTENT={quoteattr(r.text)} HPOS={quoteattr(at(r.x1))} VPOS={quoteattr(at(r.y1))} WIDTH={quoteattr(at(r.x2 - r.x1))} HEIGHT={quoteattr(at(r.y2 - r.y1))}/>" for r in f.itertuples())
    return f'<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#"><Layout><Page ID="p{page}" WIDTH="10000" HEIGHT="10000"><PrintSpace><TextBlock ID="b{page}"><TextLine>{words}</TextLine></TextBlock></PrintSpace></Page></Layout></alto>'


def _pagexml(page, f) -> str:
    at = lambda v: str(int(v * 10000))
    box = lambda r: f"{at(r.x1)},{at(r.y1)} {at(r.x2)},{at(r.y1)} {at(r.x2)},{at(r.y2)} {at(r.x1)},{at(r.y2)}"
    words = "".join(f'<Word id="w{k}"><Coords points={quoteattr(box(r))}/><TextEquiv><Unicode>{escape(r.text)}</Unicode></TextEquiv></Word>' for k, r in enumerate(f.itertuples()))
    return f'<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2019-07-15"><Page imageFilename="page_{page}" imageWidth="10000" imageHeight="10000"><TextRegion id="r{page}">{words}</TextRegion></Page></PcGts>'


def _tei(page, f) -> str:
    body = "".join(f"<w>{escape(r.text)}</w> " for r in f.itertuples())
    return f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><pb n="{page}"/><p>{body}</p></body></text></TEI>'


LAYOUTS = {"alto": _alto, "page": _pagexml, "tei": _tei}


def layout(tokens: DataFrame, kind: str) -> DataFrame:
    """(page, xml): one document a page, words by token index; coordinates times 10000, truncated."""
    make = LAYOUTS[kind]

    def fold(key, f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"page": [key[0]], "xml": [make(key[0], f.sort_values("token_index"))]})

    return tokens.select(F.col("page").cast("long"), "token_index", "text", "x1", "y1", "x2", "y2").groupBy("page").applyInPandas(fold, "page long, xml string")


def boxed(words: DataFrame, boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """Words with their box, else their unit's region, else the whole page."""
    box = lambda p: [F.col(c).alias(p + c) for c in ("x1", "y1", "x2", "y2")]
    j = words.join(boxes.select("unit_id", "word_index", *box("b")), ["unit_id", "word_index"], "left").join(regions.select("unit_id", *box("r")), "unit_id", "left")
    return j.select(*words.columns, *[F.coalesce(f"b{c}", f"r{c}", F.lit(d)).alias(c) for c, d in (("x1", 0.0), ("y1", 0.0), ("x2", 1.0), ("y2", 1.0))])
