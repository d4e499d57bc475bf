"""Vector retrieval: indexing rows, exact top-k by inner product, and narrowing with its fallbacks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions.text import blank_to_null
from pagelode.operators.blocks import filter_block_ids, prompt_order, running_by_page

TEXT_CAP, PREVIEW, TOP_K = 12_000, 500, 48


def normalized(vec: Column | str) -> Column:
    """A vector of unit length; a zero vector stays zero (norm of at least 1e-12)."""
    v = F.col(vec) if isinstance(vec, str) else vec
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / F.greatest(norm, F.lit(1e-12)))


def inner_product(a: Column, b: Column) -> Column:
    """Accumulated in double precision and in order, so that results repeat."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def embed(texts: DataFrame, embedder, column: str = "text", batch: int = 64) -> DataFrame:  # noqa: ANN001
    """Adds ``vec``: texts embedded by an injected callable (list of texts to list of vectors), batch by batch."""
    import numpy as np

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out: list = []
            for i in range(0, len(s), batch):
                m = np.asarray(embedder(s.iloc[i : i + batch].fillna("").tolist()), dtype=np.float64)
                out.extend(m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12))
            yield pd.Series(out)

    return texts.withColumn("vec", run(column))


def index_rows(blocks: DataFrame) -> DataFrame:
    """What an index keeps of each block with text: its place on the page, page totals, header and capped stripped text, preview.

    Ids are per document, so that numbering needs no global sort.
    """
    b = blocks.withColumn("raw_text", blank_to_null("raw_text")).filter("raw_text IS NOT NULL")
    b = running_by_page(b, [*prompt_order()[1:], F.col("trace_id")], F.lit(1), "vec_no")
    page = Window.partitionBy("document_id", "page")
    at = F.row_number().over(page.orderBy("block_id", "block_type", "trace_id")) - 1
    b = b.withColumns({"vec_no": F.col("vec_no") - 1, "index_on_page": at, "blocks_on_page": F.count("*").over(page)})
    head = F.concat(F.lit("[page="), F.col("page").cast("string"), F.lit(" block_id="), "block_id", F.lit(" type="), "block_type", F.lit(" index_on_page="), F.col("index_on_page").cast("string"), F.lit("]\n"))
    return b.select(
        "document_id", "vec_no", "page", "block_id", "block_type", "index_on_page", "blocks_on_page",
        F.concat(head, F.left("raw_text", F.lit(TEXT_CAP))).alias("text"), F.left("raw_text", F.lit(PREVIEW)).alias("text_preview"),
    )


def page_hierarchy(index: DataFrame) -> DataFrame:
    """(document_id, page, block_ids): the blocks of each page in order."""
    return index.groupBy("document_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("index_on_page", "block_id"))), lambda x: x["block_id"]).alias("block_ids"))


def top_k(vectors: DataFrame, query: list[float], k: int = TOP_K, vec: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """The ``k`` rows most similar to one query vector: exact, best first, ties by id.

    Each task keeps its own k before they are merged (TakeOrderedAndProject).
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.select(row_id, inner_product(F.col(vec), q).alias("score")).orderBy(F.desc("score"), row_id).limit(k)


def _best(score, ids, k: int):  # noqa: ANN001, ANN202
    """The k best columns of each row by score, ties by id: partitioned as a matrix, sorted only where few are left."""
    import numpy as np

    if score.shape[1] > k:
        edge = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
        # Of the ties at the edge the smallest ids stay.
        tied = np.where(score == edge, ids, np.iinfo(np.int64).max)
        room = k - (score > edge).sum(axis=1, keepdims=True)
        last = np.take_along_axis(np.sort(tied, axis=1), room - 1, 1)
        keep = (score > edge) | ((score == edge) & (ids <= last))
        at = np.argsort(~keep, axis=1, kind="stable")[:, :k]
        score, ids = np.take_along_axis(score, at, 1), np.take_along_axis(ids, at, 1)
    return score, ids


def top_k_many(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, vec: str = "embedding", row_id: str = "vec_id", query_block: int = 16_384) -> DataFrame:
    """The ``k`` best rows for each row of a stated query set: (query_id, ``row_id``, score, rank).

    Queries go to the workers in blocks of ``query_block``, each of which is one scan of the vectors; a batch of vectors
    meets 256 queries at a time in a matrix product, and only the best k per query leave the task. ``queries``: (query_id, ``vec``).
    """
    import numpy as np

    spark = vectors.sparkSession
    schema = f"query_id bigint, `{row_id}` bigint, score double"
    buf: list[tuple[int, list[float]]] = []
    out = None

    def scan(block: list[tuple[int, list[float]]]) -> DataFrame:
        held = spark.sparkContext.broadcast((np.array([q for q, _ in block], dtype=np.int64), np.array([v for _, v in block], dtype=np.float64)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, mat = held.value
            best_s = np.full((len(ids), k), -np.inf)
            best_i = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)
            for pdf in batches:
                if not len(pdf):
                    continue
                rows, own = np.array(pdf[vec].tolist(), dtype=np.float64).T, pdf[row_id].to_numpy(np.int64)
                for i in range(0, len(ids), 256):
                    s = mat[i : i + 256] @ rows
                    cat_s = np.concatenate([best_s[i : i + 256], s], axis=1)
                    cat_i = np.concatenate([best_i[i : i + 256], np.broadcast_to(own, s.shape)], axis=1)
                    best_s[i : i + 256], best_i[i : i + 256] = _best(cat_s, cat_i, k)
            real = np.isfinite(best_s)
            q = np.broadcast_to(ids[:, None], best_s.shape)
            yield pd.DataFrame({"query_id": q[real], row_id: best_i[real], "score": best_s[real]})

        return vectors.filter(F.col(vec).isNotNull()).select(row_id, vec).mapInPandas(run, schema)

    for r in queries.select("query_id", vec).toLocalIterator():
        buf.append((r[0], list(r[1])))
        if len(buf) == query_block:
            out = scan(buf) if out is None else out.unionByName(scan(buf))
            buf = []
    if buf or out is None:
        out = scan(buf) if out is None else out.unionByName(scan(buf))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), row_id)
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ranked_block_ids(hits: DataFrame) -> DataFrame:
    """Block ids of ranked hits, each at its first rank."""
    return hits.groupBy("block_id").agg(F.min("rank").alias("rank"))


def narrow_blocks(blocks: DataFrame, hits, enabled: bool = True) -> tuple[DataFrame, dict]:  # noqa: ANN001
    """Blocks named by retrieval, and why: off, error, no hits and no match all fall back to every block.

    ``hits`` is a callable that gives a DataFrame with block_id (and document_id); its errors never fail the caller.
    """
    if not enabled:
        return blocks, {"rag_used": False, "reason": "disabled"}
    try:
        found = hits()
        if found is None or found.isEmpty():
            return blocks, {"rag_used": False, "reason": "no_hits"}
        kept = filter_block_ids(blocks, found)
        if kept.isEmpty():
            return blocks, {"rag_used": False, "reason": "no_matching_blocks"}
        return kept, {"rag_used": True, "reason": "ok"}
    except Exception as e:  # retrieval is an optimisation
        return blocks, {"rag_used": False, "reason": "error", "rag_error": str(e)[:500]}


def chat_context(hits: DataFrame, max_hits: int = 8) -> DataFrame:
    """(conv_id, context): previews of the best hits with scores, in order of rank."""
    line = F.concat(F.lit("["), F.format_number("score", 4), F.lit("] page="), F.col("page").cast("string"), F.lit(" block_id="), "block_id", F.lit("\n"), "text_preview")
    return hits.filter(F.col("rank") <= max_hits).groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))), lambda x: x["l"]), "\n\n").alias("context")
    )


#: Ways to look for blocks.
MODES = ("vector", "keyword", "hybrid")


@dataclass(frozen=True)
class RetrievalConfig:
    """Settings of retrieval before extraction: whether, how many, with which query and in which mode."""

    enabled: bool = False
    top_k: int = TOP_K
    query: str = ""
    mode: str = "hybrid"


def retrieve(blocks: DataFrame, cfg: RetrievalConfig, embedder, query: str = "") -> DataFrame:  # noqa: ANN001
    """(document_id, block_id, rank) of the ``top_k`` blocks for a query: by vectors, by words of the query, or by both.

    Each block is a text of its own (its header and stripped text). ``hybrid`` adds the reciprocal ranks of both ways; ids
    come out once, at their best rank.
    """
    if cfg.mode not in MODES:
        raise ValueError(f"no such mode: {cfg.mode}")
    text = query or cfg.query
    rows = index_rows(blocks).select(F.concat_ws("\u0000", "document_id", "block_id").alias("id"), "text")
    ways = []
    if cfg.mode in ("vector", "hybrid"):
        q = [float(x) for x in embedder([text])[0]]
        ways.append(top_k(embed(rows, embedder), q, cfg.top_k, "vec", "id").select("id", "score"))
    if cfg.mode in ("keyword", "hybrid"):
        words = sorted({w.lower() for w in text.split()})
        found = [F.when(F.contains(F.lower("text"), F.lit(w)), 1.0).otherwise(0.0) for w in words] or [F.lit(0.0)]
        ways.append(rows.select("id", sum(found[1:], found[0]).alias("score")).filter("score > 0").orderBy(F.desc("score"), "id").limit(cfg.top_k))
    # At most top_k rows a way: their ranks need no partition.
    ranked = [w.select("id", F.row_number().over(Window.orderBy(F.desc("score"), "id")).alias("r")) for w in ways]
    both = ranked[0] if len(ranked) == 1 else ranked[0].unionByName(ranked[1])
    best = both.groupBy("id").agg(F.sum(1.0 / (F.col("r") + 60)).alias("score")).orderBy(F.desc("score"), "id").limit(cfg.top_k)
    parts = F.split("id", "\u0000")
    return best.select(parts[0].alias("document_id"), parts[1].alias("block_id"), F.row_number().over(Window.orderBy(F.desc("score"), "id")).alias("rank"))


def with_neighbours(hits: DataFrame, blocks: DataFrame, reach: int = 1) -> DataFrame:
    """Blocks of hits and those up to ``reach`` places before and after them in reading order: (document_id, block_id)."""
    from pagelode.operators.blocks import reading_position

    placed = reading_position(blocks).select("document_id", "block_id", "read_pos")
    around = placed.join(hits.select("document_id", "block_id").distinct(), ["document_id", "block_id"]).select("document_id", F.explode(F.sequence(F.col("read_pos") - reach, F.col("read_pos") + reach)).alias("read_pos")).distinct()
    return placed.join(around, ["document_id", "read_pos"]).select("document_id", "block_id")


def coverage_metric(coverage: DataFrame, metric: str = "binary") -> DataFrame:
    """(page, value) of one coverage measure for a chart."""
    if metric not in ("binary", "instruction_count", "max_confidence"):
        raise ValueError(f"no such measure: {metric}")
    return coverage.select("page", F.col(metric).cast("double").alias("value"))
