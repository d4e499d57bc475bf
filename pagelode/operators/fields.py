"""Bit-field parsing, the band join to instructions, overrides and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, split_lines, strip
from pagelode.operators.blocks import running_by_page

OK_CONFIDENCE = 0.55


def evidence_pages(refs: str = "source_refs"):  # noqa: ANN201
    """Distinct pages from 1 on that a row refers to."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(F.col(refs), F.array()), lambda r: r["page"]), lambda p: p >= 1))


def block_reference(blocks: DataFrame) -> Column:
    """What a row cites of its block: the block's first reference, else its page, box and id."""
    names = ["page", "method", "block_id", "bbox"]
    kinds = ["int", "string", "string", "array<double>"]
    own = {"page": F.coalesce("page", F.lit(1)), "block_id": F.col("block_id")}
    if "bbox" in blocks.columns:
        own["bbox"] = F.array(*(F.col(f"bbox.{c}") for c in ("x0", "y0", "x1", "y1")))
    null = {n: F.lit(None).cast(k) for n, k in zip(names, kinds)}
    fallback = F.struct(*(own.get(n, null[n]).cast(k).alias(n) for n, k in zip(names, kinds)))
    if "source_refs" not in blocks.columns:
        return fallback
    held = blocks.schema["source_refs"].dataType.elementType.fieldNames()
    first = F.get("source_refs", 0)
    return F.when(first.isNotNull(), F.struct(*((first[n] if n in held else null[n]).cast(k).alias(n) for n, k in zip(names, kinds)))).otherwise(fallback)


def computed_once(df: DataFrame, **columns) -> DataFrame:  # noqa: ANN003
    """Adds columns through a generator, behind which the optimizer neither repeats nor moves their expressions.

    Filters on a projected column are otherwise pushed below it with the expression written out, once per use.
    """
    return df.select("*", F.inline(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))))


def parsed_fields(blocks: DataFrame) -> DataFrame:
    """Fields found in blocks: block columns with ``block_idx`` (all blocks counted), ``field_idx`` and the field's columns.

    Tables are read by rows and columns (a first row that names either column is a header), other text by its lines;
    blocks without text count but give nothing. Each step is a column of its own, so nothing is parsed twice.
    """
    c = F.col
    numbered = running_by_page(blocks, [c("block_id"), c("trace_id")], F.lit(1), "block_idx").withColumn("block_idx", c("block_idx") - 1)
    keep = ["document_id", "page", "block_id", "block_type", "block_idx", "ref"]
    some = numbered.filter(blank_to_null("raw_text").isNotNull()).withColumn("ref", block_reference(numbered)).select(*keep, split_lines("raw_text").alias("lines"))

    t = some.filter("block_type = 'table'").withColumn("lines", F.filter("lines", lambda x: strip(x) != ""))
    t = computed_once(t, head=S.split_row(F.coalesce(F.get("lines", 0), F.lit(""))))
    t = computed_once(t, **{k: S.header_column(c("head"), k) for k in ("field", "bits", "word")})
    t = t.select(*keep, "field", "bits", "word", F.posexplode("lines").alias("line_no", "line")).filter("line_no > 0 OR (field = 0 AND bits = 0)")
    # A header with only one of the columns is dropped, but does not map the rows below it.
    t = computed_once(t, cells=S.split_row("line"), mapped=(c("field") > 0) & (c("bits") > 0))
    t = computed_once(t, field_name=S.row_field_name(c("cells"), c("mapped"), c("field")), bits_text=S.row_bits_text(c("cells"), c("mapped"), c("bits")))
    t = computed_once(t.filter("field_name IS NOT NULL"), bit_range=S.bits_in(c("bits_text"))).filter("bit_range <> ''")
    t = t.select(*keep, "line_no", "field_name", "bit_range", S.row_word(c("cells"), c("mapped"), c("word")).alias("word_index"), S.row_confidence(c("mapped"), c("bit_range")).alias("row_confidence"))

    x = some.filter("block_type IN ('text', 'equation', 'image')").select(*keep, F.posexplode("lines").alias("line_no", "line"))
    x = computed_once(x.filter(c("line").rlike(S.LOOSE_LINE)), f=S.loose_field("line"))
    x = x.select(*keep, "line_no", "f.field_name", "f.bit_range", F.lit(0).alias("word_index"), (c("f.row_confidence") * 0.85).alias("row_confidence"))

    w = Window.partitionBy("document_id", "page", "block_id", "block_idx").orderBy("line_no")
    out = t.unionByName(x).withColumn("field_idx", F.row_number().over(w) - 1)
    return out.select(*keep, "field_idx", "field_name", "bit_range", "word_index", "row_confidence")


def candidates_for_pages(pages: DataFrame, catalog: DataFrame, reach: int = 1) -> DataFrame:
    """Instructions for each (document_id, page): those cited within ``reach`` pages, else the document's first.

    The band is widened on the instruction side, so it is an equi-join on (document, page). Columns: document_id,
    page, instruction_name, variation, inst_pos, n_candidates, fallback. ``catalog`` needs ``pos``, its order.
    """
    inst = catalog.select("document_id", "pos", "instruction_name", "variation", evidence_pages().alias("_pages"))
    wide = inst.select("*", F.explode(F.array_distinct(F.flatten(F.transform("_pages", lambda p: F.sequence(p - reach, p + reach))))).alias("page")).drop("_pages")
    want = pages.select("document_id", "page").distinct()
    hits = want.join(wide, ["document_id", "page"], "left")
    per = Window.partitionBy("document_id", "page")
    hits = hits.withColumn("n_candidates", F.count("pos").over(per))
    first = catalog.groupBy("document_id").agg(F.min_by(F.struct("instruction_name", "variation", "pos"), "pos").alias("_f"))
    out = hits.join(first, "document_id")
    none = F.col("pos").isNull()
    return out.select(
        "document_id", "page",
        F.when(none, F.col("_f.instruction_name")).otherwise(F.col("instruction_name")).alias("instruction_name"),
        F.when(none, F.col("_f.variation")).otherwise(F.col("variation")).alias("variation"),
        F.coalesce("pos", "_f.pos").alias("inst_pos"), "n_candidates", none.alias("fallback"),
    )


def field_map(blocks: DataFrame, catalog: DataFrame, run_id: str = "run", stage: str = "field_parsing") -> DataFrame:
    """Parsed fields times the instructions of their page, with confidence, doubt and the reference of their block."""
    fields = parsed_fields(blocks)
    multi = (F.col("n_candidates") > 1) | F.col("fallback")
    unsure = multi | (F.col("block_type") != "table")
    base = F.when(unsure, OK_CONFIDENCE).otherwise(F.col("row_confidence"))
    conf = F.least(F.lit(0.95), F.greatest(F.lit(0.25), base * F.when(multi, 0.9).otherwise(1.0)))
    # Candidates of all pages are cheaper than parsing the blocks twice to know which pages have fields.
    j = fields.join(candidates_for_pages(blocks, catalog), ["document_id", "page"])
    name, var = F.upper(strip(F.coalesce("instruction_name", F.lit("UNKNOWN")))), S.normalize_variation("variation")
    return j.select(
        S.trace_id(run_id, F.lit("field"), F.col("block_idx"), F.col("field_idx"), S.scope_label("instruction_name", "variation")).alias("trace_id"),
        F.lit(stage).alias("stage_name"), F.lit(run_id).alias("stage_run_id"), "document_id", "page", "block_id", "inst_pos", name.alias("instruction_name"), var.alias("variation"), "field_name", "bit_range", "word_index",
        F.round(conf, 4).alias("confidence_score"), (unsure | (conf < OK_CONFIDENCE)).alias("uncertain"), F.array("ref").alias("source_refs"),
    )


def catalog_scopes(catalog: DataFrame) -> DataFrame:
    """Distinct scopes of a catalog, first occurrence wins: (document_id, scope, name, variation, page, pos)."""
    s = catalog.select(
        "document_id", S.scope_label("instruction_name", "variation").alias("scope"), F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("name"),
        S.normalize_variation("variation").alias("variation"), F.coalesce(F.get(F.filter(F.transform(F.coalesce("source_refs", F.array()), lambda r: r["page"]), lambda p: p >= 1), 0), F.lit(1)).alias("page"), "pos",
    )
    return s.groupBy("document_id", "scope").agg(F.min_by(F.struct("name", "variation", "page"), "pos").alias("_s"), F.min("pos").alias("pos")).select("document_id", "scope", "_s.*", "pos")


def apply_overrides(rows: DataFrame, catalog: DataFrame, sheet: DataFrame, run_id: str = "run") -> tuple[DataFrame, DataFrame]:
    """Field rows with an override sheet applied, and the warnings.

    ``sheet``: (scope, fields array<struct<field_name,bit_range,word_index>>); a null array is an invalid entry.
    A catalog scope takes its own entry, else that of its name without variation; entries without usable fields
    leave the parsed rows; parsed rows of scopes outside the catalog stay. The sheet is a joined table.
    """
    key_rows = rows.withColumn("scope", S.scope_label("instruction_name", "variation"))
    scopes = catalog_scopes(catalog)
    exact = sheet.select(F.col("scope").alias("_e"), F.col("fields").alias("_ef"), F.lit(True).alias("_has_e"))
    base = sheet.select(F.col("scope").alias("_b"), F.col("fields").alias("_bf"), F.lit(True).alias("_has_b"))
    s = scopes.join(exact, F.col("scope") == F.col("_e"), "left").join(base, F.col("variation").isNotNull() & (F.col("name") == F.col("_b")), "left")
    has_e, has_b = F.coalesce("_has_e", F.lit(False)), F.coalesce("_has_b", F.lit(False))
    s = s.select("document_id", "scope", "name", "variation", "page", F.when(has_e, F.col("_e")).when(has_b, F.col("_b")).alias("used"), F.when(has_e, F.col("_ef")).when(has_b, F.col("_bf")).alias("fields"))
    good = F.filter("fields", lambda f: f.isNotNull() & blank_to_null(f["field_name"]).isNotNull() & blank_to_null(f["bit_range"]).isNotNull())
    s = s.withColumn("good", F.when(F.size(good) > 0, good))
    over = s.filter("good IS NOT NULL").select("document_id", "scope", "name", "variation", "page", "used", F.posexplode("good").alias("i", "f"))
    from_sheet = over.select(
        S.trace_id(run_id, F.lit("field:cheat"), F.col("scope"), F.col("i")).alias("trace_id"), "document_id", "page", F.col("name").alias("instruction_name"), "variation",
        strip(F.col("f.field_name")).alias("field_name"), strip(F.col("f.bit_range")).alias("bit_range"), F.coalesce("f.word_index", F.lit(0)).alias("word_index"),
        F.lit(0.95).alias("confidence_score"), F.lit(False).alias("uncertain"), F.col("used").alias("sheet_key"),
    )
    kept = key_rows.join(s.filter("good IS NOT NULL").select("document_id", "scope"), ["document_id", "scope"], "left_anti").drop("scope")
    have = key_rows.select("document_id", "scope").distinct().withColumn("_rows", F.lit(True))
    state = s.join(have, ["document_id", "scope"], "left").withColumn("_rows", F.coalesce("_rows", F.lit(False)))
    kinds = F.array(
        F.when(F.col("used").isNotNull() & (F.col("used") != F.col("scope")), "variation_fallback"),
        F.when(F.col("used").isNotNull() & F.col("fields").isNull(), "invalid_entry"),
        F.when((F.size("fields") == 0), "empty_fields"),
        F.when((F.size("fields") > 0) & F.col("good").isNull(), "no_valid_fields"),
        F.when(F.col("used").isNull() & ~F.col("_rows"), "missing"),
        F.when(F.col("used").isNotNull() & F.col("fields").isNull() & ~F.col("_rows"), "missing_rows"),
    )
    warnings = state.select("document_id", "scope", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("warning"), F.col("used").alias("sheet_key"))
    return kept.unionByName(from_sheet, allowMissingColumns=True), warnings


def scope_coverage(rows: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Status per scope: (document_id, scope, status, n_rows); scopes outside the catalog are ``extra``.

    ``fully_confident`` if no row is uncertain or below 0.55, else ``partial_or_uncertain``; ``missing`` without rows.
    Without a catalog the scopes of the rows are all there is.
    """
    conf = F.coalesce(F.col("confidence_score").try_cast("double"), F.lit(0.0))
    weak = F.coalesce(F.col("uncertain"), F.lit(False)) | (conf < OK_CONFIDENCE)
    per = rows.groupBy("document_id", S.scope_label("instruction_name", "variation").alias("scope")).agg(F.count("*").alias("n_rows"), F.bool_or(weak).alias("weak"))
    grade = F.when(F.col("weak"), "partial_or_uncertain").otherwise("fully_confident")
    if catalog is None:
        return per.select("document_id", "scope", grade.alias("status"), "n_rows")
    scopes = catalog.select("document_id", S.scope_label("instruction_name", "variation").alias("scope")).distinct().withColumn("_in", F.lit(True))
    j = scopes.join(per, ["document_id", "scope"], "full_outer")
    status = F.when(F.col("n_rows").isNull(), "missing").when(F.col("_in").isNull(), "extra").otherwise(grade)
    return j.select("document_id", "scope", status.alias("status"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def coverage_summary(status: DataFrame) -> DataFrame:
    """Counts per document over :func:`scope_coverage`."""
    n = lambda s: F.count_if(F.col("status") == s)
    return status.groupBy("document_id").agg(
        F.count_if(F.col("status") != "extra").alias("scopes_total"), n("fully_confident").alias("scopes_fully_confident"),
        n("partial_or_uncertain").alias("scopes_partial_or_uncertain"), n("missing").alias("scopes_missing"), n("extra").alias("scopes_extra"),
    )


def canonical_field_name(name: str = "field_name"):  # noqa: ANN201
    """Stripped name with white space as underscores; case is kept."""
    return F.regexp_replace(strip(F.coalesce(F.col(name), F.lit(""))), r"\s+", "_")


def global_fields(rows: DataFrame) -> DataFrame:
    """Distinct canonical field names over all rows, with the number of scopes that have them."""
    r = rows.select(canonical_field_name().alias("field_name"), F.struct("document_id", S.scope_label("instruction_name", "variation")).alias("scope"))
    return r.filter("field_name <> ''").groupBy("field_name").agg(F.count_distinct("scope").alias("n_scopes"))


def scope_fields(rows: DataFrame) -> DataFrame:
    """(document_id, scope, fields): sorted distinct canonical names per scope."""
    r = rows.select("document_id", S.scope_label("instruction_name", "variation").alias("scope"), canonical_field_name().alias("f")).filter("f <> ''")
    return r.groupBy("document_id", "scope").agg(F.array_sort(F.collect_set("f")).alias("fields"))


def field_lines(rows: DataFrame) -> DataFrame:
    """Lines ``INST|VAR|FIELD`` for prompts, rows without name or field left out."""
    r = rows.select("*", F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("_n"), strip(F.coalesce("field_name", F.lit(""))).alias("_f"))
    return r.filter("_n <> '' AND _f <> ''").select("document_id", F.concat_ws("|", "_n", F.coalesce(S.normalize_variation("variation"), F.lit("")), "_f").alias("line"))


def page_coverage(catalog: DataFrame, first: int, last: int, document: str | None = "document_id") -> DataFrame:
    """Per page of [first, last]: rows citing it, greatest confidence, and whether it is cited; every page has a row."""
    if first > last or first < 1:
        raise ValueError("invalid page range")
    by = [document] if document else []
    docs = catalog.select(*by).distinct() if by else catalog.sparkSession.range(1).select()
    return _covered(docs.select(*by, F.explode(F.sequence(F.lit(first), F.lit(last))).alias("page")), _cited(catalog, by).filter(F.col("page").between(first, last)), by)


def whole_coverage(catalog: DataFrame, pages: DataFrame) -> DataFrame:
    """``page_coverage`` of whole documents: from page 1 to the last page there is or that is cited.

    ``pages``: (document_id, total_pages). Documents without catalog rows have their pages too.
    """
    by, cited = ["document_id"], _cited(catalog, ["document_id"])
    ends = pages.select("document_id", F.col("total_pages").alias("page")).unionByName(catalog.select("document_id", F.array_max(evidence_pages()).alias("page")))
    last = ends.groupBy("document_id").agg(F.greatest(F.max("page"), F.lit(1)).alias("last"))
    return _covered(last.select("document_id", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("page")), cited, by)


def _cited(catalog: DataFrame, by: list[str]) -> DataFrame:
    return catalog.select(*by, F.coalesce(F.col("confidence_score"), F.lit(0.0)).alias("c"), F.explode(evidence_pages()).alias("page"))


def _covered(spine: DataFrame, cited: DataFrame, by: list[str]) -> DataFrame:
    agg = cited.groupBy(*by, "page").agg(F.count("*").alias("instruction_count"), F.max(F.when(~F.isnan("c"), F.col("c"))).alias("max_confidence"))
    out = spine.join(agg, [*by, "page"], "left")
    n = F.coalesce("instruction_count", F.lit(0))
    return out.select(*by, "page", F.when(n > 0, 1).otherwise(0).alias("binary"), n.alias("instruction_count"), F.round(F.coalesce("max_confidence", F.lit(0.0)), 4).alias("max_confidence"))
