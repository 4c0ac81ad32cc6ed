"""Words on pages: (page, token_index, text, x1, y1, x2, y2) with coordinates from 0 to 1, and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def union_box(tokens: DataFrame, *key: str) -> DataFrame:
    return tokens.groupBy(*key).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count(F.lit(1)).alias("n"))


def reading_order(tokens: DataFrame, tolerance: float = 0.008, right_to_left: bool = True) -> DataFrame:
    """``line`` and ``rank`` of each token: lines part where the centre falls by more than the tolerance from the
    token before; in a line, from the right (or left) edge."""
    cy = (F.col("y1") + F.col("y2")) / 2
    down = W.partitionBy("page").orderBy("_cy", "token_index")
    t = tokens.withColumn("_cy", cy).withColumn("_new", (F.col("_cy") - F.lag("_cy").over(down) > tolerance).cast("int"))
    t = t.withColumn("line", F.coalesce(F.sum("_new").over(down), F.lit(0)).cast("int"))
    across = F.desc("x2") if right_to_left else F.asc("x1")
    return t.withColumn("rank", F.row_number().over(W.partitionBy("page").orderBy("line", across, "token_index")) - 1).drop("_cy", "_new")


def overlapping_lines(tokens: DataFrame, least: float = 0.5) -> DataFrame:
    """Lines by vertical overlap with a line's growing box; order-dependent, so a fold per page."""

    def fold(f):
        f = f.sort_values(["y1", "x1", "token_index"])
        lines, out = [], []
        for t in f.itertuples():
            best, share = -1, 0.0
            for k, (a, b) in enumerate(lines):
                over = (min(b, t.y2) - max(a, t.y1)) / max(1e-9, min(b - a, t.y2 - t.y1))
                if over >= least and over > share:
                    best, share = k, over
            if best < 0:
                lines.append([t.y1, t.y2])
                best = len(lines) - 1
            else:
                lines[best] = [min(lines[best][0], t.y1), max(lines[best][1], t.y2)]
            out.append(best)
        return f[["page", "token_index"]].assign(line=out)

    return tokens.select("page", "token_index", "x1", "y1", "x2", "y2").groupBy("page").applyInPandas(fold, "page long, token_index int, line int")


def starts(markers: DataFrame) -> DataFrame:
    """Each usable, trusted marker (unit_id, page, y, status, trusted) with the next usable one, trusted or not."""
    usable = markers.where(F.col("status").isin("ok", "marker_found_content_mismatch") & F.col("y").isNotNull())
    w = W.partitionBy("part").orderBy("unit_id")
    return usable.withColumn("next_page", F.lead("page").over(w)).withColumn("next_y", F.lead("y").over(w)).where("trusted")


def in_band(starts: DataFrame, tokens: DataFrame, tolerance: float = 0.004) -> DataFrame:
    """Tokens of the start page from a marker's height down to the next one on that page."""
    cy = (F.col("y1") + F.col("y2")) / 2
    same = F.col("next_page") == F.col("page")
    return starts.join(tokens, "page").where((cy >= F.col("y") - tolerance) & (F.coalesce(~same, F.lit(True)) | (cy < F.col("next_y") - tolerance)))


def continuations(starts: DataFrame) -> DataFrame:
    """The pages behind a start's up to the next start's."""
    s = starts.where("next_page > page")
    return s.select("unit_id", F.explode(F.sequence(F.col("page") + 1, F.col("next_page"))).alias("page"))


def contained(tokens: DataFrame, regions: DataFrame, slack: float = 0.006) -> DataFrame:
    """Tokens inside regions (page, unit_id, rx1, ry1, rx2, ry2) of their page."""
    return tokens.join(regions, "page").where((F.col("x1") >= F.col("rx1") - slack) & (F.col("y1") >= F.col("ry1") - slack) & (F.col("x2") <= F.col("rx2") + slack) & (F.col("y2") <= F.col("ry2") + slack))


def trim_overlaps(regions: DataFrame, gap: float = 0.0) -> DataFrame:
    """A region that reaches into that of the next id on its page ends ``gap`` before it, but not above its own top.

    Only ids that follow each other by one are compared, and only the earlier one changes. A join on the id, not an
    order, so no page and no part is one task's work."""
    after = regions.select((F.col("unit_id") - 1).alias("unit_id"), "page", F.col("ry1").alias("_top")).groupBy("unit_id", "page").agg(F.min("_top").alias("_top"))
    end = F.when(F.col("ry2") > F.col("_top"), F.greatest(F.col("ry1") + gap, F.col("_top") - gap)).otherwise(F.col("ry2"))
    return regions.join(after, ["unit_id", "page"], "left").withColumn("ry2", end).select(regions.columns)


def nearest_rank(spots: DataFrame, tokens: DataFrame) -> DataFrame:
    """Of the tokens with a spot's text on its page, the one whose rank is nearest the spot's share of the page.

    spots: (spot, page, text, share from 0 to 1); tokens: (page, rank, text, n). The first of equals."""
    j = spots.join(tokens.select("page", "text", "rank", "n"), ["page", "text"])
    far = F.abs(F.col("rank") - F.col("share") * F.col("n"))
    return j.groupBy("spot").agg(F.min_by("rank", F.struct(far, F.col("rank"))).alias("rank"))


def first_neighbour(items: DataFrame, known: DataFrame) -> DataFrame:
    """The first known value at +1, -1, +2, -2, +3, -3 from an item's index on its page."""
    offsets = F.array(*[F.struct(F.lit(k).alias("priority"), F.lit(o).alias("offset")) for k, o in enumerate((1, -1, 2, -2, 3, -3))])
    near = items.select("page", "word_index", F.inline(offsets)).withColumn("_at", F.col("word_index") + F.col("offset"))
    k = known.select("page", F.col("word_index").alias("_at"), "value").where("value is not null")
    return near.join(k, ["page", "_at"]).groupBy("page", "word_index").agg(F.min_by("value", "priority").alias("value"))


def line_height(tokens: DataFrame) -> DataFrame:
    """The upper median height of a page's tokens."""
    h = F.sort_array(F.collect_list(F.col("y2") - F.col("y1")))
    return tokens.groupBy("page").agg(h.alias("_h")).select("page", F.get("_h", (F.size("_h") / 2).cast("int")).alias("height"))


def insert_box(gaps: DataFrame, tokens: DataFrame) -> DataFrame:
    """The box from the token before a gap to the one behind it; null without either."""
    side = lambda d, p: tokens.select("page", (F.col("token_index") + d).alias("token_index"), *[F.col(c).alias(p + c) for c in ("x1", "y1", "x2", "y2")])
    j = gaps.join(side(1, "b"), ["page", "token_index"], "left").join(side(0, "a"), ["page", "token_index"], "left")
    return j.select(*gaps.columns, F.least("bx1", "ax1").alias("x1"), F.least("by1", "ay1").alias("y1"), F.greatest("bx2", "ax2").alias("x2"), F.greatest("by2", "ay2").alias("y2"))


def coverage(units: DataFrame, spans: DataFrame, least: float = 0.85) -> DataFrame:
    """Stored words of the units that a span (first_id, last_id, tokens) covers, over its tokens; low ones flagged."""
    ranges = spans.select("*", F.explode(F.sequence("first_id", "last_id")).alias("unit_id"))
    got = ranges.join(units.select("unit_id", "n_words"), "unit_id", "left").groupBy("first_id", "last_id", "tokens").agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"), F.count_if(F.col("n_words").isNull()).alias("unmeasured"))
    share = F.col("words") / F.nullif("tokens", F.lit(0))
    return got.withColumn("coverage", share).withColumn("low", F.coalesce(share < least, F.lit(False)))


def catchwords(tokens: DataFrame, real, first: int = 4) -> DataFrame:
    """(page, catchword, found): whether a page's last real token is among the first of the next page."""
    t = tokens.where(real)
    ends = t.groupBy("page").agg(F.max_by("text", "token_index").alias("catchword"))
    rank = F.row_number().over(W.partitionBy("page").orderBy("token_index"))
    heads = t.withColumn("_r", rank).where(F.col("_r") <= first).groupBy((F.col("page") - 1).alias("page")).agg(F.collect_set("text").alias("_heads"))
    return ends.join(heads, "page").select("page", "catchword", F.array_contains("_heads", F.col("catchword")).alias("found"))


def trusted(alignment: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Alignment rows whose page is trusted and from ``first`` to ``last``, and all others: none is lost."""
    good = F.coalesce(F.col("trusted") & F.col("matched_page").between(first, last), F.lit(False))
    return alignment.where(good), alignment.where(~good)


def page_offsets(counts: DataFrame, width: int = 1 << 12) -> DataFrame:
    """(page, n, offset): how many tokens the pages before hold. Sums of ``width`` pages are added up apart from the
    pages in them, so no task orders all pages."""
    c = counts.withColumn("_b", F.floor(F.col("page") / width))
    inside = F.coalesce(F.sum("n").over(W.partitionBy("_b").orderBy("page").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = c.groupBy("_b").agg(F.sum("n").alias("_n")).select("_b", before.alias("_before"))
    return c.withColumn("_in", inside).join(sums, "_b").select("page", "n", (F.col("_in") + F.col("_before")).alias("offset"))


def x_band(tokens: DataFrame) -> DataFrame:
    """Leftmost and rightmost edge and number of each page's tokens."""
    return tokens.groupBy("page").agg(F.min("x1").alias("left"), F.max("x2").alias("right"), F.count(F.lit(1)).alias("n"))


def coverage_means(covered: DataFrame) -> DataFrame:
    """Mean coverage and number of spans on one page and across pages: covered has (coverage, same_page)."""
    return covered.where("coverage is not null").groupBy("same_page").agg(F.avg("coverage").alias("mean"), F.count(F.lit(1)).alias("n"))


def unmeasured_reasons(spans: DataFrame) -> DataFrame:
    """Why spans (first_id, last_id, tokens, unmeasured) have no coverage, a row a reason."""
    why = F.when(F.col("tokens").isNull(), "no_end").when(F.col("tokens") <= 0, "no_tokens").when(F.col("last_id") < F.col("first_id"), "out_of_order").when(F.col("unmeasured") > 0, "unit_missing")
    return spans.select(why.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def attributed(ops: DataFrame, origin: DataFrame, tokens: DataFrame, *key: str) -> DataFrame:
    """Regions of units from an alignment of a page's tokens with its units' words: (key..., unit_id, box, n).

    origin: (key..., j, unit_id) of the words; tokens: (key..., i, x1, y1, x2, y2). A replaced word takes the token at
    its place in the replaced run, words beyond the run its last token."""
    use = ops.where(F.col("tag").isin("equal", "replace") & (F.col("i2") > F.col("i1")))
    at = use.select(*key, "i1", "i2", "j1", F.explode(F.sequence(F.col("j1"), F.col("j2") - 1)).alias("j")).where("j >= j1")
    at = at.withColumn("i", F.col("i1") + F.least(F.col("j") - F.col("j1"), F.col("i2") - F.col("i1") - 1))
    return union_box(at.join(origin, [*key, "j"]).join(tokens, [*key, "i"]), *key, "unit_id")
