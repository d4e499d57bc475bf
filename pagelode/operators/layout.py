"""Layout operators: table clusters, tables over page breaks, heading ranks, raised and lowered text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions import geometry as G
from pagelode.session import materialize


def cluster_boxes(boxes: DataFrame, by: list[str]) -> DataFrame:
    """Groups of boxes whose vertical intervals meet (closed): adds ``cluster`` from 0 down the page.

    Gaps and islands: a new group begins where a box starts below everything before it. One sort per page,
    no pairs.
    """
    order = Window.partitionBy(*by).orderBy("bbox.y0", "bbox.y1", "bbox.x0")
    reach = F.max("bbox.y1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.col("_reach").isNull() | (F.col("bbox.y0") > F.col("_reach")), 1).otherwise(0)
    n = F.sum(starts).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return boxes.withColumn("_reach", reach).withColumn("cluster", (n - 1).cast("int")).drop("_reach")


def merge_boxes(boxes: DataFrame, by: list[str]) -> DataFrame:
    """One box per cluster with the number of its members; ``merged`` says whether there were several."""
    c = cluster_boxes(boxes, by)
    out = c.groupBy(*by, "cluster").agg(
        F.count("*").alias("n_boxes"), F.min("bbox.x0").alias("x0"), F.min("bbox.y0").alias("y0"), F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1")
    )
    return out.select(*by, "cluster", "n_boxes", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("bbox"), (F.col("n_boxes") > 1).alias("merged"))


def table_blocks(detected: DataFrame, by: list[str]) -> DataFrame:
    """Table blocks of pages from detected tables (``by``, bbox, raw_text, clip_text): (``by``, cluster, bbox, raw_text, extraction_method).

    Tables that meet vertically become one, whose texts follow one another down the page; a table without text has what
    the page shows in its box (``clip_text``). A merged one is labelled so.
    """
    c = cluster_boxes(detected, by)
    own = F.when(F.trim(F.coalesce("raw_text", F.lit(""))) != "", F.col("raw_text")).otherwise(F.coalesce("clip_text", F.lit("")))
    text = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("bbox.y0", "bbox.x0", own.alias("t")))), lambda x: x["t"]), lambda t: t != ""), "\n")
    out = c.groupBy(*by, "cluster").agg(
        F.count("*").alias("_n"), F.min("bbox.x0").alias("x0"), F.min("bbox.y0").alias("y0"), F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1"), text.alias("raw_text")
    )
    label = F.when(F.col("_n") > 1, "table_merged").otherwise("table_detected")
    return out.select(*by, "cluster", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("bbox"), "raw_text", label.alias("extraction_method"))


def cluster_adjacent(boxes: DataFrame, by: list[str], box_id: str, gap: float = 5.0, least: float = 0.5, sideways: bool = False) -> DataFrame:
    """The older clustering by adjacency (gap and overlap ratio): (``by``, ``box_id``, ``cluster``).

    Neighbours are found among the boxes of one page; groups are the connected components, by passing on the
    smallest id, and that box's own smallest, until nothing changes. A page holds few boxes, so its pairs are few.
    """
    a = boxes.select(*by, F.col(box_id).alias("a"), F.col("bbox").alias("_a"))
    b = boxes.select(*by, F.col(box_id).alias("b"), F.col("bbox").alias("_b"))
    near = G.adjacent_vertically(F.col("_a"), F.col("_b"), gap, least)
    if sideways:
        near = near | G.adjacent_horizontally(F.col("_a"), F.col("_b"), gap, least)
    links = materialize(a.join(b, by).filter((F.col("a") != F.col("b")) & near).select(*by, "a", "b"), "links")
    label = boxes.select(*by, F.col(box_id).alias("a"), F.col(box_id).alias("cluster"))
    while True:
        heard = links.join(label.select(*by, F.col("a").alias("b"), F.col("cluster").alias("_c")), [*by, "b"]).groupBy(*by, "a").agg(F.min("_c").alias("_c"))
        step = label.join(heard, [*by, "a"], "left").withColumn("_n", F.least("cluster", F.coalesce("_c", "cluster")))
        far = label.groupBy(*by, F.col("a").alias("_n")).agg(F.min("cluster").alias("_f"))
        low = F.least("_n", F.coalesce("_f", "_n"))
        new = materialize(step.join(far, [*by, "_n"], "left").select(*by, "a", low.alias("cluster"), (low < F.col("cluster")).alias("_moved")), "labels")
        label = new.drop("_moved")
        if new.filter("_moved").isEmpty():
            break
    return label.withColumnRenamed("a", box_id)


def stitch_links(blocks: DataFrame, heights: DataFrame, bottom: float = 0.08, top: float = 0.08, least_width: float = 0.5, edge: float = 2.0) -> DataFrame:
    """Tables that go on over a page break: (document_id, page, upper, lower, take).

    The bottommost table of a page meets the topmost of the next if both stand in the margins, are the
    outermost blocks of their pages and overlap in width. One pass takes links greedily: where single-table
    pages form a chain, every other link; ``take`` marks them by the parity of the place in the chain.
    """
    bottom, top = max(0.0, min(0.25, bottom)), max(0.0, min(0.25, top))
    tables = blocks.filter("block_type = 'table'")
    ends = tables.groupBy("document_id", "page").agg(
        F.max_by(F.struct("block_id", "bbox"), F.struct("bbox.y1", "block_id")).alias("low"),
        F.min_by(F.struct("block_id", "bbox"), F.struct("bbox.y0", "block_id")).alias("high"),
    )
    extent = blocks.groupBy("document_id", "page").agg(F.min("bbox.y0").alias("min_y"), F.max("bbox.y1").alias("max_y"))
    page = ends.join(extent, ["document_id", "page"]).join(heights, ["document_id", "page"])
    nxt = page.select("document_id", (F.col("page") - 1).alias("page"), F.col("high").alias("n_high"), F.col("low").alias("n_low"), F.col("min_y").alias("n_min"), F.col("height").alias("n_height"))
    pair = page.join(nxt, ["document_id", "page"])
    ok = (
        (F.col("height") > 0) & (F.col("n_height") > 0)
        & (F.col("low.bbox.y1") >= F.col("height") * (1.0 - bottom)) & (F.col("n_high.bbox.y0") <= F.col("n_height") * top)
        & (G.width_overlap(F.col("low.bbox"), F.col("n_high.bbox")) >= least_width)
        & (F.abs(F.col("low.bbox.y1") - F.col("max_y")) <= edge) & (F.abs(F.col("n_high.bbox.y0") - F.col("n_min")) <= edge)
    )
    links = pair.filter(ok).select("document_id", "page", F.col("low.block_id").alias("upper"), F.col("n_high.block_id").alias("lower"), (F.col("n_high.block_id") == F.col("n_low.block_id")).alias("_through"))
    w = Window.partitionBy("document_id").orderBy("page")
    new = F.when((F.lag("page").over(w) == F.col("page") - 1) & F.lag("_through").over(w), 0).otherwise(1)
    chain = Window.partitionBy("document_id", "_chain").orderBy("page")
    links = links.withColumn("_new", new).withColumn("_chain", F.sum("_new").over(w))
    return links.withColumn("take", F.row_number().over(chain) % 2 == 1).select("document_id", "page", "upper", "lower", "take")


def stitch_tables(blocks: DataFrame, heights: DataFrame, **margins: float) -> DataFrame:
    """Blocks with tables over page breaks joined, pass after pass until none is left; every pass takes a table off."""
    cur = blocks if "multi_page_bboxes" in blocks.columns else blocks.withColumn("multi_page_bboxes", F.lit(None).cast("array<struct<page:int,bbox:struct<x0:double,y0:double,x1:double,y1:double>>>"))
    while True:
        links = materialize(stitch_links(cur, heights, **margins).filter("take"), "stitch")
        if links.isEmpty():
            break
        low = cur.select("document_id", F.col("block_id").alias("lower"), F.col("raw_text").alias("_text"), F.col("page").alias("_page"), F.col("bbox").alias("_bbox"))
        gain = links.join(low, ["document_id", "lower"]).select("document_id", F.col("upper").alias("block_id"), "_text", "_page", "_bbox")
        gone = links.select("document_id", F.col("lower").alias("block_id"))
        kept = cur.join(gone, ["document_id", "block_id"], "left_anti").join(gain, ["document_id", "block_id"], "left")
        hit = F.col("_page").isNotNull()
        rtrim = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+$", "")
        ltrim = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"^\s+", "")
        own = F.coalesce("multi_page_bboxes", F.array(F.struct(F.col("page").cast("int").alias("page"), F.col("bbox").alias("bbox"))))
        method = F.coalesce("extraction_method", F.lit("table"))
        cur = materialize(
            kept.withColumns({
                "raw_text": F.when(hit, F.trim(F.concat(rtrim("raw_text"), F.lit("\n\n"), ltrim("_text")))).otherwise(F.col("raw_text")),
                "multi_page_bboxes": F.when(hit, F.concat(own, F.array(F.struct(F.col("_page").cast("int").alias("page"), F.col("_bbox").alias("bbox"))))).otherwise(F.col("multi_page_bboxes")),
                "extraction_method": F.when(hit & ~F.contains(method, F.lit("+cross_page_merge")), F.concat(method, F.lit("+cross_page_merge"))).otherwise(F.col("extraction_method")),
            }).drop("_text", "_page", "_bbox"), "stitched",
        )
    return cur


#: Roles of text sizes from the largest down.
ROLES = ("heading1", "heading2", "heading3", "body", "caption", "comment")


def size_tiers(spans: DataFrame) -> DataFrame:
    """(document_id, tier, role): distinct sizes above 0 in half points, largest first; from the sixth on all are comments."""
    tiers = spans.filter("size > 0").select("document_id", (F.bround(F.col("size") * 2, 0) / 2).alias("tier")).distinct()
    rank = F.dense_rank().over(Window.partitionBy("document_id").orderBy(F.desc("tier")))
    roles = F.array(*map(F.lit, ROLES))
    return tiers.withColumn("rank", rank).select("document_id", "tier", F.get(roles, F.least(F.col("rank"), F.lit(len(ROLES))) - 1).alias("role"))


def span_roles(spans: DataFrame) -> DataFrame:
    """Spans with the role of the tier nearest to their size in half points; of two equally near the larger counts.

    Without tiers all are body; a missing size counts as 11. Tiers of a document are few: they travel as one array per document.
    """
    tiers = size_tiers(spans).groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("tier")).alias("neg"), "tier", "role"))).alias("_tiers"))
    def nearest(size):  # noqa: ANN001, ANN202
        return F.array_min(F.transform("_tiers", lambda t: F.struct(F.abs(t["tier"] - size).alias("d"), t["neg"].alias("n"), t["role"].alias("role"))))["role"]
    return spans.join(tiers, "document_id", "left").withColumn("role", F.coalesce(nearest(F.bround(F.coalesce("size", F.lit(11.0)) * 2, 0) / 2), F.lit("body"))).drop("_tiers")


def tag_headings(blocks: DataFrame, spans: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """Text of blocks as role-tagged spans, matched by box within a tolerance: (document_id, block_id, tagged).

    ``spans`` carry (document_id, page, block_no, block_box, span_no, text, size); the first layout block
    of the page that fits is used.
    """
    s = span_roles(spans).filter("text <> ''")
    near = F.lit(True)
    for c in ("x0", "y0", "x1", "y1"):
        near = near & (F.abs(F.col(f"bbox.{c}") - F.col(f"block_box.{c}")) <= tolerance)
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tagged = F.concat(F.lit("<"), F.col("role"), F.lit(">"), esc, F.lit("</"), F.col("role"), F.lit(">"))
    b = blocks.filter(F.col("block_type").isin("text", "equation")).select("document_id", "page", "block_id", "bbox")
    hit = b.join(s, ["document_id", "page"]).filter(near).withColumn("_t", tagged)
    first = F.min("block_no").over(Window.partitionBy("document_id", "block_id"))
    one = hit.withColumn("_first", first).filter("block_no = _first")
    return one.groupBy("document_id", "block_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_no", "_t"))), lambda x: x["_t"]), "").alias("tagged")
    )


def script_roles(spans: DataFrame, line_key: list[str]) -> DataFrame:
    """``script`` of each span of a line: ``sup``, ``sub`` or ``normal``, by size and height against the line's body."""
    w = Window.partitionBy(*line_key)
    cy = (F.col("bbox.y0") + F.col("bbox.y1")) / 2
    ref = F.max(F.coalesce("size", F.lit(0.0))).over(w)
    s = spans.filter("text <> ''").withColumn("_ref", F.when(ref <= 0, 12.0).otherwise(ref)).withColumn("_cy", cy)
    body = F.coalesce(F.avg(F.when(F.col("size") >= F.col("_ref") * 0.91, F.col("_cy"))).over(w), F.avg("_cy").over(w), F.lit(0.0))
    s = s.withColumn("_body", body)
    role = (
        F.when(F.coalesce("flags", F.lit(0)).bitwiseAND(F.lit(1)) == 1, "sup")
        .when(F.col("bbox").isNull() | (F.coalesce("size", F.lit(0.0)) >= F.col("_ref") * 0.92), "normal")
        .when(F.col("_cy") < F.col("_body") - 0.07 * F.col("_ref"), "sup")
        .when(F.col("_cy") > F.col("_body") + 0.05 * F.col("_ref"), "sub")
        .otherwise("normal")
    )
    return s.withColumn("script", role).drop("_ref", "_cy", "_body")


def script_text(spans: DataFrame, block_key: list[str], line: str = "line_no", max_length: int = 50) -> DataFrame:
    """Block text with ``<sup>`` and ``<sub>`` around raised and lowered spans: (block_key, text)."""
    s = script_roles(spans, [*block_key, line])
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    length = F.length(bare) + 3 * F.regexp_count(bare, F.lit("\t"))
    wrap = F.when((F.col("script") == "normal") | (length > max_length), esc).otherwise(F.concat(F.lit("<"), F.col("script"), F.lit(">"), esc, F.lit("</"), F.col("script"), F.lit(">")))
    lines = s.withColumn("_t", wrap).groupBy(*block_key, line).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("bbox.x0").alias("x"), "span_no", "_t"))), lambda x: x["_t"]), "").alias("_l")
    )
    return lines.groupBy(*block_key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(line, "_l"))), lambda x: x["_l"]), "\n").alias("text"))


def font_sizes(blocks: DataFrame, spans: DataFrame) -> DataFrame:
    """(document_id, block_id, size): mean size of the spans that meet the block's box, within 6..24, 11 without any."""
    s = spans.select("document_id", "page", F.col("bbox").alias("_s"), "size")
    hit = blocks.select("document_id", "page", "block_id", "bbox").join(s, ["document_id", "page"], "left")
    mean = F.avg(F.when(G.intersection_area(F.col("bbox"), F.col("_s")) > 0, F.col("size")))
    return hit.groupBy("document_id", "block_id").agg(F.greatest(F.lit(6.0), F.least(F.lit(24.0), F.coalesce(mean, F.lit(11.0)))).alias("size"))
