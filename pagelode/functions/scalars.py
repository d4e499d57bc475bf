"""Scalar functions as Column expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelode.functions.text import blank_to_null, split_lines, strip

#: Value forms, instruction kinds, datatype categories and their defaults.
VALUE_FORMS = ("enum", "range", "mask", "set", "other")
INSTRUCTION_KINDS = ("macro", "micro", "unknown")
DATATYPE_CATEGORIES = ("software_primitive", "ip_architecture", "alias", "unknown")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys -----------------------------------------------------------------------------------------


def normalize_variation(raw: Column | str) -> Column:
    """Stripped upper-case variation; null and blank become null."""
    return F.upper(blank_to_null(_c(raw)))


def row_key(name: Column | str, variation: Column | str) -> Column:
    """Key struct (name, variation): upper case, a missing variation is ''."""
    return F.struct(
        F.upper(strip(F.coalesce(_c(name), F.lit("")))).alias("name"),
        F.coalesce(normalize_variation(variation), F.lit("")).alias("variation"),
    )


def scope_label(name: Column | str, variation: Column | str) -> Column:
    """``NAME`` or ``NAME|VAR``."""
    return F.concat_ws("|", F.upper(strip(F.coalesce(_c(name), F.lit("")))), normalize_variation(variation))


def trace_id(run: Column | str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(run) if isinstance(run, str) else run, *(p.cast("string") for p in parts))


# --- opcodes and bit fields -------------------------------------------------------------------------


def opcode_value(raw: Column | str) -> Column:
    """Value of ``0x`` hexadecimal or (signed) decimal text; null otherwise or beyond 63 bits."""
    s = strip(_c(raw))
    hexa = F.regexp_extract(s, r"^0[xX]0*([0-9A-Fa-f]{1,15})$", 1)
    return (
        F.when(s.rlike(r"^0[xX]0*[0-9A-Fa-f]{1,15}$"), F.conv(F.when(hexa == "", F.lit("0")).otherwise(hexa), 16, 10).try_cast("bigint"))
        .when(s.rlike(r"^-?[0-9]+$"), s.try_cast("bigint"))
    )


def opcode_radix(raw: Column | str) -> Column:
    """``hex``, ``dec`` or ``unknown``."""
    s = strip(_c(raw))
    return (
        F.when(s.rlike(r"^0[xX][0-9A-Fa-f]+$") & opcode_value(raw).isNotNull(), "hex")
        .when(s.rlike(r"^-?[0-9]+$") & opcode_value(raw).isNotNull(), "dec")
        .otherwise("unknown")
    )


def opcode_text(raw: Column | str, value: Column | str) -> Column:
    """Raw text where it says something, else the value as ``0x…``, else ``UNKNOWN``."""
    s = blank_to_null(_c(raw))
    return F.coalesce(F.when(F.upper(s) != "UNKNOWN", s), F.concat(F.lit("0x"), F.lower(F.hex(_c(value).cast("bigint")))), F.lit("UNKNOWN"))


def bit_width(bit_range: Column | str) -> Column:
    """``a:b`` → |a−b|+1; digits → 1; anything else → 4."""
    s = strip(F.coalesce(_c(bit_range), F.lit("")))
    a = F.regexp_extract(s, r"^([0-9]{1,9})\s*:\s*([0-9]{1,9})$", 1).try_cast("int")
    b = F.regexp_extract(s, r"^([0-9]{1,9})\s*:\s*([0-9]{1,9})$", 2).try_cast("int")
    return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) + 1).when(s.rlike(r"^[0-9]+$"), 1).otherwise(4)


def type_id_for_width(width: Column | str) -> Column:
    w = _c(width)
    return F.when(w <= 0, "uint4").when(w <= 64, F.concat(F.lit("uint"), w.cast("string"))).otherwise("uint_wide")


def _all_ones(width: Column) -> Column:
    """2^width - 1 for widths below 63."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.least(width, F.lit(62)).cast("int")) - 1


def domain_for_width(width: Column | str) -> Column:
    """``0..2^w-1`` written out below 63 bits, symbolic from there; no width counts as 4 bits."""
    w = F.when(_c(width) <= 0, 4).otherwise(_c(width)).cast("int")
    small = F.concat(F.lit("0.."), _all_ones(w).cast("string"))
    return F.when(w < 63, small).otherwise(F.concat(F.lit("0..2^"), w.cast("string"), F.lit("-1")))


# --- table rows ---------------------------------------------------------------------------------------


def split_row(line: Column | str) -> Column:
    """Cells of a table line: at tabs (empty cells kept) if there are any, else at runs of two or more spaces."""
    s = strip(_c(line))
    tabbed = F.transform(F.split(s, "\t", -1), strip)
    spaced = F.filter(F.transform(F.split(s, r"\s{2,}", -1), strip), lambda x: x != "")
    return F.when(F.contains(s, F.lit("\t")), tabbed).otherwise(spaced)


def header_column(cells: Column, kind: str) -> Column:
    """1-based place of the first header cell of a kind (field, bits, word); 0 if there is none."""
    def is_kind(x: Column) -> Column:
        t = F.lower(strip(x))
        if kind == "field":
            return t.rlike(r"field|name|signal")
        if kind == "bits":
            return t.rlike(r"bits|\bbit\b|msb|lsb|\[")
        return t.rlike(r"word") | (t == "w")

    return F.coalesce(F.array_position(F.transform(cells, is_kind), F.lit(True)), F.lit(0)).cast("int")


#: Bit ranges, bit numbers and field names inside cells and lines.
_BIT_RANGE = r"([0-9]{1,2})\s*:\s*([0-9]{1,2})"
_BIT_SINGLE = r"\b([0-9]{1,2})\b"
_FIELD_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
LOOSE_LINE = r"\b([A-Za-z_][A-Za-z0-9_]*)\s+([0-9]{1,2}\s*:\s*[0-9]{1,2}|[0-9]{1,2})\b"


def bits_in(cell: Column) -> Column:
    """First ``a:b`` of a text, else its first lone number of at most two digits; '' without either."""
    a, b = F.regexp_extract(cell, _BIT_RANGE, 1), F.regexp_extract(cell, _BIT_RANGE, 2)
    return F.when(a != "", F.concat_ws(":", a, b)).otherwise(F.regexp_extract(cell, _BIT_SINGLE, 1))


def loose_field(line: Column | str) -> Column:
    """First ``IDENT bits`` of a line as struct (field_name, bit_range, row_confidence); null without one.

    Confidence is 0.42 for a range and 0.38 for a lone number.
    """
    s = _c(line)
    bits = F.regexp_replace(F.regexp_extract(s, LOOSE_LINE, 2), r"\s", "")
    conf = F.when(F.contains(bits, F.lit(":")), 0.42).otherwise(0.38)
    return F.when(s.rlike(LOOSE_LINE), F.struct(F.regexp_extract(s, LOOSE_LINE, 1).alias("field_name"), bits.alias("bit_range"), conf.alias("row_confidence")))


def row_field_name(cells: Column, mapped: Column, field_at: Column) -> Column:
    """Name cell of a table row: the mapped one, else the first; null unless it is an identifier."""
    name = F.coalesce(F.get(cells, F.when(mapped, field_at - 1).otherwise(0)), F.lit(""))
    return F.when(name.rlike(_FIELD_NAME), name)


def row_bits_text(cells: Column, mapped: Column, bits_at: Column) -> Column:
    """Where a table row's bits are looked for: the mapped cell, else all cells after the first."""
    rest = F.array_join(F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))), " ")
    return F.when(mapped, F.coalesce(F.get(cells, bits_at - 1), F.lit(""))).otherwise(rest)


def row_confidence(mapped: Column, bits: Column) -> Column:
    """0.78 with both columns known, 0.62 for a range elsewhere, 0.48 for a lone number."""
    return F.when(mapped, 0.78).when(F.contains(bits, F.lit(":")), 0.62).otherwise(0.48)


def row_word(cells: Column, mapped: Column, word_at: Column) -> Column:
    """Word index of a table row: the first number of its mapped word cell, else 0."""
    cell = F.coalesce(F.get(cells, word_at - 1), F.lit(""))
    return F.coalesce(F.when(mapped & (word_at > 0), F.regexp_extract(cell, r"([0-9]{1,9})", 1).try_cast("int")), F.lit(0))


# --- domains and constraints ---------------------------------------------------------------------------


def value_form(raw: Column | str) -> Column:
    s = F.lower(strip(F.coalesce(_c(raw), F.lit(""))))
    return F.when(s.isin(*VALUE_FORMS), s).otherwise("range")


#: Intervals inside a domain text, and what stands for an empty domain.
_RANGE_DOTS = r"(0x[0-9a-fA-F]+|[0-9]+)\s*\.\.\s*(0x[0-9a-fA-F]+|[0-9]+)"
_RANGE_DASH = r"([0-9]+)\s*-\s*([0-9]+)"
_FILL = "/* unspecified — fill allowed_values_or_range in field_domain_catalog */"


def structured_domain(form: Column | str, values: Column | str) -> Column:
    """Struct (form, values, lo_raw, hi_raw, raw): values of an enum, bounds of a range, else the raw text."""
    f, raw = value_form(form), strip(F.coalesce(_c(values), F.lit("")))
    items = F.filter(F.transform(F.split(raw, r"[|,;]+", -1), strip), lambda x: x != "")
    items = F.when(F.size(items) > 0, items).otherwise(F.array(raw))
    dots, dash = F.regexp_extract(raw, _RANGE_DOTS, 1), F.regexp_extract(raw, _RANGE_DASH, 1)
    lo = F.when(dots != "", dots).when(dash != "", dash)
    hi = F.when(dots != "", F.regexp_extract(raw, _RANGE_DOTS, 2)).when(dash != "", F.regexp_extract(raw, _RANGE_DASH, 2))
    is_range = f == "range"
    return F.struct(
        f.alias("form"),
        F.when((f == "enum") & (raw != ""), items).alias("values"),
        F.when(is_range, lo).alias("lo_raw"),
        F.when(is_range, hi).alias("hi_raw"),
        raw.alias("raw"),
    )


def domain_expression(field: Column | str, form: Column | str, values: Column | str) -> Column:
    """``F IN (…)``, ``lo <= F <= hi``, ``F RANGE raw`` or ``F (form) raw``; a blank domain is said to be unspecified."""
    name = F.coalesce(blank_to_null(_c(field)), F.lit("UNKNOWN"))
    d = structured_domain(form, values)
    blank = (
        F.when(d["form"].isin("enum", "range"), F.concat(name, F.when(d["form"] == "enum", " IN (").otherwise(" RANGE ("), F.lit(_FILL + ")")))
        .when(d["form"] == "mask", F.concat(name, F.lit(" MASK (/* unspecified */)")))
        .when(d["form"] == "set", F.concat(name, F.lit(" SET (/* unspecified */)")))
        .otherwise(F.concat(name, F.lit(" ("), d["form"], F.lit(", values unspecified)")))
    )
    return (
        F.when(d["raw"] == "", blank)
        .when(d["form"] == "enum", F.concat(name, F.lit(" IN ("), F.array_join(d["values"], ", "), F.lit(")")))
        .when(d["lo_raw"].isNotNull(), F.concat_ws(" <= ", d["lo_raw"], name, d["hi_raw"]))
        .when(d["form"] == "range", F.concat_ws(" ", name, F.lit("RANGE"), d["raw"]))
        .otherwise(F.concat(name, F.lit(" ("), d["form"], F.lit(") "), d["raw"]))
    )


def canonical_interval(values: Column | str) -> Column:
    """``0x0~0xF``, ``[0,15]``, ``0 to 15``, ``15:0`` and ``4-bit unsigned`` as ``0..15``; null for anything else."""
    s = F.lower(strip(F.coalesce(_c(values), F.lit(""))))
    num = r"(0x[0-9a-f]{1,15}|[0-9]{1,18})"
    pat = rf"^[\[(]?\s*{num}\s*(?:\.\.|~|-|–|:|,|\bto\b)\s*{num}\s*[\])]?$"
    val = lambda x: F.when(x.startswith("0x"), F.conv(F.substring(x, 3, 20), 16, 10)).otherwise(x).try_cast("bigint")
    a, b = val(F.regexp_extract(s, pat, 1)), val(F.regexp_extract(s, pat, 2))
    bits = F.regexp_extract(s, r"^([0-9]{1,2})\s*-?\s*bits?(?:\s+unsigned)?$", 1).try_cast("int")
    return F.when(s.rlike(pat), F.concat_ws("..", F.least(a, b).cast("string"), F.greatest(a, b).cast("string"))).when(
        bits.isNotNull() & bits.between(1, 62), F.concat(F.lit("0.."), _all_ones(bits).cast("string"))
    )


def field_slug(name: Column | str) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(_c(name), F.lit(""))), r"[^A-Z0-9]+", "_"), r"^_+|_+$", "")
    return F.when(s == "", "FIELD").otherwise(s)


def instruction_node_id(name: Column | str, variation: Column | str, opcode: Column | str) -> Column:
    """``Instr:`` with the opcode, else the name, and the variation."""
    body = F.coalesce(_c(opcode).cast("bigint").cast("string"), F.upper(strip(F.coalesce(_c(name), F.lit("")))))
    return F.concat(F.lit("Instr:"), F.concat_ws("_", body, normalize_variation(variation)))


# --- confidence, routing, clamps -------------------------------------------------------------------------


def text_confidence(page_chars: Column, block_chars: Column) -> Column:
    """0.72 + 0.13·min(1, page/1500) + 0.15·min(1, block/400), rounded to 4 in whole numbers, half up."""
    page, block = F.least(page_chars.cast("bigint"), F.lit(1500)), F.greatest(F.lit(0), F.least(block_chars.cast("bigint"), F.lit(400)))
    return F.floor((432_030 + 52 * page + 225 * block) / 60) / 10_000


def table_confidence(chars: Column) -> Column:
    """0.55 without text, else 0.78 + 0.2·min(1, chars/800), at most 0.98, rounded to 4 half up."""
    return F.when(chars <= 0, 0.55).otherwise(F.floor((15_601 + 5 * F.least(chars.cast("bigint"), F.lit(800))) / 2) / 10_000)


def image_confidence() -> Column:
    return F.lit(0.25)


def ocr_confidence(text: Column | str, full_page: bool = False) -> Column:
    n = F.length(strip(_c(text)))
    ramp = F.least(F.lit(0.92), 0.55 + 0.001 * n) if full_page else F.least(F.lit(0.9), 0.45 + 0.005 * n)
    return F.when(F.coalesce(n, F.lit(0)) == 0, 0.0).otherwise(F.round(ramp, 4))


def ocr_reasons(chars: Column, text_blocks: Column, images: Column, tables: Column, min_chars: int = 40, image_weight: int = 1) -> Column:
    """Reasons to read a page optically; the page needs it if there is any."""
    rules = [
        (chars < min_chars, "low_text_char_count"),
        ((images > 0) & (chars < 2 * min_chars), "image_heavy_low_text"),
        ((text_blocks == 0) & ((images > 0) | (tables > 0)), "no_text_layer_blocks"),
        ((chars < 8) & (images >= image_weight), "scanned_or_bitmap_heavy"),
    ]
    return F.filter(F.array(*(F.when(cond, F.lit(name)) for cond, name in rules)), lambda x: x.isNotNull())


def is_equation(text: Column | str) -> Column:
    """Short text with TeX delimiters, dollar signs around something, or mathematical signs."""
    t = strip(F.coalesce(_c(text), F.lit("")))
    return (t != "") & (F.length(t) <= 200) & t.rlike(r"\\\(|\\\[|\$.*\$|[∑∫≤≥±]")


def repeat_key(text: Column | str) -> Column:
    """Text by which repeated lines are recognised: lower case, digits as #, single spaces."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(F.coalesce(_c(text), F.lit("")))), r"[0-9]+", "#"), r"\s+", " ")


def clamp_choice(raw: Column | str, allowed: tuple[str, ...], default: str) -> Column:
    s = F.lower(strip(F.coalesce(_c(raw), F.lit(""))))
    return F.when(s.isin(*allowed), s).otherwise(default)


def clamp_unit(raw: Column | str, default: float) -> Column:
    """A number kept within 0..1; text that is no number, null and NaN give the default."""
    v = _c(raw).try_cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(F.isnan(v), None).otherwise(v))) if default is None else F.coalesce(
        F.when(v.isNull() | F.isnan(v), None).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))), F.lit(default)
    )


def merge_spans(lines: Column) -> Column:
    """Spans of lines as text: lines joined by newline, or the spans of a single line by space."""
    each = F.transform(lines, lambda ln: F.array_join(F.transform(ln["spans"], lambda s: s["text"]), ""))
    one = F.array_join(F.transform(F.get(lines, 0)["spans"], lambda s: s["text"]), " ")
    return F.when(F.size(lines) > 1, F.array_join(each, "\n")).otherwise(F.coalesce(one, F.lit("")))


#: Fixed value: role-tagged segments of text.
_SEGMENT = r"(?s)<(heading1|heading2|heading3|body|caption|comment)>(.*?)</\1>"


def heading_segments(raw: Column | str) -> Column:
    """Array of (role, text) of role-tagged text; untagged text is one body segment."""
    s = F.coalesce(_c(raw), F.lit(""))
    roles, texts = F.regexp_extract_all(s, F.lit(_SEGMENT), F.lit(1)), F.regexp_extract_all(s, F.lit(_SEGMENT), F.lit(2))
    plain = lambda t: F.replace(F.replace(F.replace(F.replace(F.replace(F.regexp_replace(t, r"</?(sup|sub)>", ""), F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&quot;"), F.lit('"')), F.lit("&#x27;"), F.lit("'")), F.lit("&amp;"), F.lit("&"))
    tagged = F.transform(F.arrays_zip(roles.alias("role"), texts.alias("text")), lambda x: F.struct(x["role"].alias("role"), plain(x["text"]).alias("text")))
    return F.when(F.size(roles) > 0, tagged).otherwise(F.array(F.struct(F.lit("body").alias("role"), plain(s).alias("text"))))


def block_header(page: Column, block_id: Column, block_type: Column) -> Column:
    return F.concat(F.lit("--- page="), page.cast("string"), F.lit(" block_id="), block_id, F.lit(" type="), block_type, F.lit(" ---"))


def block_prompt(page: Column, block_id: Column, block_type: Column, text: Column) -> Column:
    """Header and stripped text of a block for a prompt; '' for a blank block."""
    body = blank_to_null(text)
    return F.when(body.isNull(), "").otherwise(F.concat(block_header(page, block_id, block_type), F.lit("\n"), body))
