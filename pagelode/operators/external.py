"""Calls to outside engines (documents, optical reading, language models) as injected, replayable strategies.

None of the engines is a dependency: a callable is handed in, runs in the Python workers, and its replies can be
kept as a table, from which later runs answer without the engine.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ChatClient = Callable[[str, str], str]  # (system prompt, user message) -> reply text
PageReader = Callable[[bytes, str], list[dict]]  # (document bytes, document id) -> page_blocks rows
OcrEngine = Callable[..., object]  # image bytes (, region, dpi) -> text, or lists of texts or of (box, text, score)

_FENCE = re.compile(r"^\s*```[A-Za-z0-9]*\s*\n?(.*?)\n?\s*```\s*$", re.S)


@dataclass(frozen=True)
class ChatConfig:
    """Settings of a chat endpoint; read by the injected client, never by the engine."""

    model: str = ""
    base_url: str | None = None
    temperature: float = 0.0
    timeout_s: float = 120.0
    extra: dict = field(default_factory=dict)


_SAID: set[str] = set()


def said_once(source: str, error: Exception) -> None:
    """Logs the first failure of a source in this process; an optional engine that is missing is no news after that."""
    if source not in _SAID:
        _SAID.add(source)
        logging.getLogger("pagelode").warning("%s: %s", source, error)


def recognized_text(result: object) -> str:
    """Text of whatever shape an engine answers in: text, dicts with ``text`` or ``rec_texts``, (box, text, score), and lists of these.

    Text is kept as the engine gives it; blank lines of a list are left out.
    """
    if result is None:
        return ""
    if isinstance(result, str):
        return result
    if isinstance(result, dict):
        return recognized_text(result.get("text", result.get("rec_texts")))
    if isinstance(result, (list, tuple)):
        if len(result) > 1 and not isinstance(result[0], str) and isinstance(result[1], (str, tuple)):
            return recognized_text(result[1][0] if isinstance(result[1], tuple) else result[1])
        return "\n".join(t for t in map(recognized_text, result) if t.strip())
    return ""


def json_object(reply: str | None) -> str:
    """The JSON object in a reply, fences removed; anything else is ``{}``."""
    text = (reply or "").strip()
    if m := _FENCE.match(text):
        text = m[1]
    try:
        value = json.loads(text)
    except ValueError:
        return "{}"
    return json.dumps(value) if isinstance(value, dict) else "{}"


def prompt_key(system: str, user: str = "prompt") -> F.Column:
    return F.sha2(F.concat_ws("\u0000", F.lit(system), F.col(user)), 256)


def chat_json(prompts: DataFrame, system: str, client: ChatClient | None, replay: DataFrame | None = None) -> DataFrame:
    """Adds ``reply_key`` and ``reply`` (a JSON object) to prompts (…, prompt).

    Replies of ``replay`` (reply_key, reply) are used first; only the rest is asked for, and without a client they get
    ``{}``. A client's error becomes an object with ``error``. Keep (reply_key, reply) to replay the run.
    """
    keyed = prompts.withColumn("reply_key", prompt_key(system))
    if replay is not None:
        keyed = keyed.join(replay.select("reply_key", F.col("reply").alias("_known")).dropDuplicates(["reply_key"]), "reply_key", "left")
    else:
        keyed = keyed.withColumn("_known", F.lit(None).cast("string"))
    if client is None:
        return keyed.withColumn("reply", F.coalesce("_known", F.lit("{}"))).drop("_known")

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for message in s:
                try:
                    out.append(json_object(client(system, message)))
                except Exception as e:
                    out.append(json.dumps({"error": str(e)[:500]}))
            yield pd.Series(out, dtype="object")

    # Python functions are not skipped inside a condition, so known prompts take another way.
    known = keyed.filter("_known IS NOT NULL").withColumn("reply", F.col("_known"))
    asked = keyed.filter("_known IS NULL").withColumn("reply", ask("prompt"))
    return known.unionByName(asked).drop("_known")


def reply_items(replies: DataFrame, array: str, item_schema: str) -> DataFrame:
    """Items of the array ``array`` in replies, one row each with ``pos``; other shapes give none."""
    e = replies.withColumn("_o", F.from_json("reply", f"{array} array<struct<{item_schema}>>"))
    keep = [c for c in ("document_id", "reply_key") if c in replies.columns]
    return e.select(*keep, F.posexplode(F.col(f"_o.{array}")).alias("pos", "_i")).filter("_i IS NOT NULL").select(*keep, "pos", "_i.*")


INSTRUCTION_ITEMS = "instruction_name:string,variation:string,aliases:array<string>,opcode_raw:string,execution_unit:string,instruction_kind:string,instruction_kind_confidence:string,confidence_score:string,source_page:string"
TYPE_ITEMS = "type_id:string,type_name_raw:string,category:string,description:string,value_constraint_summary:string,source_page:string"
MAPPING_ITEMS = "instruction_name:string,variation:string,field_name:string,data_type_raw:string,data_type_ref:string,source_page:string"
DOMAIN_ITEMS = "instruction_name:string,variation:string,field_name:string,allowed_value_form:string,allowed_values_or_range:string,source_page:string"
CONSTRAINT_ITEMS = "constraint_category_candidate:string,constraint_content:string,verbatim_sentence:string,field_name:string,instruction_name:string,source_page:string"
BINDING_ITEMS = "node_id:string,property:string,value:string,source_page:string"


def normalized_domains(items: DataFrame) -> DataFrame:
    """Domain rows from extracted items: named fields only, form ``range`` by default."""
    from pagelode.functions.scalars import normalize_variation
    from pagelode.functions.text import blank_to_null, strip

    return items.filter(blank_to_null("field_name").isNotNull()).select(
        *[c for c in ("document_id",) if c in items.columns], "pos", F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("instruction_name"), normalize_variation("variation").alias("variation"),
        F.trim("field_name").alias("field_name"), F.coalesce(blank_to_null("allowed_value_form"), F.lit("range")).alias("allowed_value_form"),
        strip(F.coalesce("allowed_values_or_range", F.lit(""))).alias("allowed_values_or_range"), F.coalesce(F.col("source_page").try_cast("int"), F.lit(1)).alias("page"),
    )


def mapped_types(items: DataFrame) -> DataFrame:
    """Field types from extracted items: named instructions and fields only, the raw type defaults to the reference."""
    from pagelode.functions.scalars import normalize_variation
    from pagelode.functions.text import blank_to_null, strip

    ref = strip(F.coalesce("data_type_ref", F.lit("")))
    named = items.filter(blank_to_null("instruction_name").isNotNull() & blank_to_null("field_name").isNotNull())
    return named.select(
        *[c for c in ("document_id",) if c in items.columns], "pos", F.upper(strip("instruction_name")).alias("instruction_name"), normalize_variation("variation").alias("variation"), strip("field_name").alias("field_name"),
        F.coalesce(blank_to_null("data_type_raw"), ref).alias("data_type_raw"), ref.alias("data_type_ref"), F.coalesce(F.col("source_page").try_cast("int"), F.lit(1)).alias("page"),
    )


def bound_values(items: DataFrame) -> DataFrame:
    """Values bound to nodes from extracted items; those without a node are left out."""
    from pagelode.functions.text import blank_to_null, strip

    text = lambda c: strip(F.coalesce(c, F.lit("")))
    return items.filter(blank_to_null("node_id").isNotNull()).select(
        *[c for c in ("document_id",) if c in items.columns], strip("node_id").alias("node_id"), text("property").alias("property"), text("value").alias("value"), F.coalesce(F.col("source_page").try_cast("int"), F.lit(1)).alias("source_page")
    )


def read_documents(spark: SparkSession, path: str, reader: PageReader, glob: str = "*.pdf") -> DataFrame:
    """Page blocks of document files: one file per row, read by an injected reader in the workers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    src = files.select(F.regexp_extract("path", r"([^/]+?)(\.[^./]+)?$", 1).alias("document_id"), "content")
    names = ["document_id", "page", "block_id", "block_type", "x0", "y0", "x1", "y1", "raw_text", "extraction_method"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (d, r.get("page"), r.get("block_id"), r.get("block_type", "text"), *(r.get("bbox") or [None] * 4), r.get("raw_text"), r.get("extraction_method"))
                for d, c in zip(pdf["document_id"], pdf["content"]) for r in reader(c, d)
            ]
            yield pd.DataFrame(rows, columns=names)

    return src.mapInPandas(run, "document_id string, page int, block_id string, block_type string, x0 double, y0 double, x1 double, y1 double, raw_text string, extraction_method string").select(
        "document_id", "page", "block_id", "block_type", F.struct("x0", "y0", "x1", "y1").alias("bbox"), "raw_text", "extraction_method"
    )


def read_optically(images: DataFrame, engine: OcrEngine | None, image: str = "image", full_page: bool = False, region: str | None = None, dpi: int | None = None) -> DataFrame:
    """Adds ``raw_text`` and ``confidence_score`` from an optical engine; without one, and where it fails, texts are empty.

    With ``region`` (a column of boxes) or ``dpi`` the engine is called with (image, box or None, dpi).
    """
    from pagelode.functions.scalars import ocr_confidence

    if engine is None:
        return images.withColumn("raw_text", F.lit("")).withColumn("confidence_score", ocr_confidence("raw_text", full_page))

    plain = region is None and dpi is None

    def one(x: bytes | None, box: object) -> str:
        if x is None:
            return ""
        try:
            return recognized_text(engine(x) if plain else engine(x, box, dpi))
        except Exception as e:
            said_once("optical engine", e)
            return ""

    @F.pandas_udf("string")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s, boxes in batches:
            yield pd.Series([one(x, None if b is None else list(b)) for x, b in zip(s, boxes)], dtype="object")

    box = F.lit(None).cast("array<double>") if region is None else F.array(*(F.col(f"{region}.{c}") for c in ("x0", "y0", "x1", "y1")))
    return images.withColumn("raw_text", read(F.col(image), box)).withColumn("confidence_score", ocr_confidence("raw_text", full_page))


def table_text(cells: DataFrame, by: list[str]) -> DataFrame:
    """TSV text of detected table cells (``by``, row, col, text): rows by newline, cells by tab."""
    rows = cells.groupBy(*by, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]), "\t").alias("_l"))
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "_l"))), lambda x: x["_l"]), "\n").alias("raw_text"))


def prefer_text(base, other):  # noqa: ANN001, ANN201
    """The other engine's text where it says something."""
    return F.coalesce(F.when(F.trim(other) != "", other), base)


