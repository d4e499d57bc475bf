"""Documented extensions of the pipeline: glossary merging, alias chains, routing by size, test combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions.text import strip
from pagelode.session import materialize


def overlapping_chunks(docs: DataFrame, size: int, overlap: float = 0.1) -> DataFrame:
    """(document_id, chunk_no, text): chunks of ``size`` characters, each sharing a tenth with the one before."""
    step = max(1, size - int(size * overlap))
    n = F.greatest(F.lit(1), F.ceil((F.length("text") - F.lit(size - step)) / F.lit(step))).cast("int")
    d = docs.filter(F.length("text") > 0).select("document_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no"))
    return d.select("document_id", "chunk_no", F.substring("text", F.col("chunk_no") * step + 1, F.lit(size)).alias("text"))


def route_by_size(docs: DataFrame) -> DataFrame:
    """(document_id, est_tokens, route): whole below 30 000 estimated tokens, chunked to 100 000, tree beyond."""
    n = F.ceil(F.length(F.coalesce("text", F.lit(""))) / 3.0).cast("bigint")
    return docs.select("document_id", n.alias("est_tokens"), F.when(n < 30_000, "single").when(n <= 100_000, "chunked").otherwise("tree").alias("route"))


def merge_terms(terms: DataFrame) -> DataFrame:
    """Terms equal but for case: (term_key, name, frequency, definition), the commonest spelling and the shortest definition."""
    t = terms.select(F.lower(strip("name")).alias("term_key"), strip("name").alias("name"), F.nullif(strip("definition"), F.lit("")).alias("d")).filter("term_key <> ''")
    spell = t.groupBy("term_key", "name").agg(F.count("*").alias("n"), F.min(F.when(F.col("d").isNotNull(), F.struct(F.length("d").alias("l"), "d"))).alias("d"))
    return spell.groupBy("term_key").agg(F.max_by("name", F.struct("n", "name")).alias("name"), F.sum("n").alias("frequency"), F.min("d").alias("_d")).select("term_key", "name", "frequency", F.col("_d.d").alias("definition"))


def top_terms(terms: DataFrame, k: int = 50) -> DataFrame:
    return merge_terms(terms).orderBy(F.desc("frequency"), "term_key").limit(k)


def flatten_aliases(aliases: DataFrame) -> DataFrame:
    """(alias, target): chains of aliases followed to their end by pointer doubling; a circle, and what leads into it, ends at
    its smallest name. Of several targets of an alias the smallest counts. As many doublings as the number of aliases
    can need: no chain is longer than they are many."""
    cur = aliases.select("alias", "target").groupBy("alias").agg(F.min("target").alias("target")).withColumn("low", F.least("alias", "target"))
    cur = materialize(cur, "aliases")
    for _ in range(cur.count().bit_length()):
        hop = cur.select(F.col("alias").alias("target"), F.col("target").alias("_t"), F.col("low").alias("_l"))
        nxt = cur.join(hop, "target", "left").select("alias", F.coalesce("_t", "target").alias("target"), F.least("low", F.coalesce("_l", "low")).alias("low"), F.col("_t").isNotNull().alias("_moved"))
        nxt = materialize(nxt, "aliases")
        cur = nxt.drop("_moved")
        if nxt.filter("_moved").isEmpty():
            break
    # What still moves has walked round a circle, whose smallest name its end has met.
    circle = cur.select(F.col("alias").alias("target"), F.col("low").alias("_low"))
    return cur.join(circle, "target", "left").select("alias", F.coalesce("_low", "target").alias("target"))


def rewrite_edges(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """Edges with both ends replaced by their final names, distinct."""
    a = aliases.select(F.col("alias").alias("from"), F.col("target").alias("_f"))
    b = aliases.select(F.col("alias").alias("to"), F.col("target").alias("_t"))
    return edges.join(a, "from", "left").join(b, "to", "left").select(F.coalesce("_f", "from").alias("from"), "rel", F.coalesce("_t", "to").alias("to")).distinct()


def match_aliases(names: DataFrame, known: DataFrame, most: int = 2) -> DataFrame:
    """(name, canonical, distance): the nearest known name within ``most`` edits.

    A known name is cut into ``most`` + 1 segments, one of which every name within ``most`` edits has unchanged, moved
    by ``most`` places at most: names meet by length of the known name, number of the segment and segment.
    """
    def keyed(df: DataFrame, out: str) -> DataFrame:
        return df.select(F.col("name").alias(out), F.lower(F.regexp_replace(strip("name"), r"[^\p{L}\p{N}]", "")).alias(f"{out}_k")).distinct()

    m = most + 1
    cut = f"substring({{k}}, i * {{n}} div {m} + 1 + {{s}}, (i + 1) * {{n}} div {m} - i * {{n}} div {m})"
    own = f"transform(sequence(0, {most}), i -> struct(length(canonical_k) AS n, i AS i, {cut.format(k='canonical_k', n='length(canonical_k)', s='0')} AS seg))"
    fits = f"i * n div {m} + s >= 0 AND (i + 1) * n div {m} + s <= length(name_k)"
    moved = (
        f"flatten(flatten(transform(sequence(greatest(0, length(name_k) - {most}), length(name_k) + {most}), n -> transform(sequence(0, {most}), i -> "
        f"transform(filter(sequence(-{most}, {most}), s -> {fits}), s -> struct(n AS n, i AS i, {cut.format(k='name_k', n='n', s='s')} AS seg))))))"
    )
    a, b = keyed(names, "name").withColumn("block", F.explode(F.expr(moved))), keyed(known, "canonical").withColumn("block", F.explode(F.expr(own)))
    j = a.join(b, "block").select("name", "name_k", "canonical", "canonical_k").distinct()
    d = F.levenshtein("name_k", "canonical_k", most)
    near = j.withColumn("distance", d).filter("distance >= 0")
    return near.groupBy("name").agg(F.min(F.struct("distance", "canonical")).alias("m")).select("name", F.col("m.canonical").alias("canonical"), F.col("m.distance").alias("distance"))


def boundary_values(domains: DataFrame) -> DataFrame:
    """(document_id, scope, field_name, value): for an interval its ends and the values beside them, for an enumeration all its values.

    Choosing boundary values is the feature: it keeps test combinations finite.
    """
    from pagelode.functions.scalars import canonical_interval, structured_domain

    iv = F.split(canonical_interval("allowed_values_or_range"), r"\.\.")
    lo, hi = F.get(iv, 0).try_cast("bigint"), F.get(iv, 1).try_cast("bigint")
    ends = F.array_distinct(F.array(lo, F.least(lo + 1, hi), F.greatest(hi - 1, lo), hi))
    d = structured_domain("allowed_value_form", "allowed_values_or_range")
    vals = F.when(lo.isNotNull(), F.transform(ends, lambda x: x.cast("string"))).when(d["form"] == "enum", d["values"])
    return domains.select("document_id", "scope", "field_name", F.explode(vals).alias("value"))


def combination_matrix(values: DataFrame, most: int = 1000, block_bytes: int = 1 << 24) -> DataFrame:
    """Combinations of field values per scope as maps: (document_id, scope, combo, assignment).

    All of them where there are at most ``most`` or no more than a covering set has; else a covering set, in which every
    pair of values of any two fields occurs. Mixed-radix numbering: combination n assigns each field the value its digit
    names, so no product is built by joins. Covering set: q is the least prime not below the most values of a field, and
    for each digit h of the fields' numbers in base q, row (h, a, b) assigns field i the value a + b * digit mod q; two
    fields differ in some digit, and there the rows run through all pairs.

    A scope's values are never repeated for each of its rows: rows come in blocks of ``block_bytes`` at most, a block has
    the values once, and equal rows of a covering set are found by the numbers of their values. Scopes are written once.
    """
    per = values.groupBy("document_id", "scope", "field_name").agg(F.array_sort(F.collect_set("value")).alias("vals"))
    scopes = per.groupBy("document_id", "scope").agg(F.array_sort(F.collect_list(F.struct("field_name", "vals"))).alias("fs"))
    prime = "filter(sequence(_v, 2 * _v), n -> forall(sequence(2, greatest(2, int(sqrt(n)))), m -> m >= n OR n % m <> 0))[0]"
    digits = "aggregate(sequence(1, 31), struct(1 AS t, bigint(_q) AS p), (a, x) -> if(a.p >= size(fs), a, struct(a.t + 1 AS t, a.p * _q AS p))).t"
    scopes = scopes.withColumn("_v", F.expr("greatest(2, array_max(transform(fs, f -> size(f.vals))))")).withColumn("_q", F.expr(prime).cast("bigint"))
    scopes = scopes.withColumn("_rows", F.expr(digits) * F.col("_q") * F.col("_q")).withColumn("_most", F.greatest(F.lit(most).cast("bigint"), "_rows"))
    scopes = scopes.withColumn("_steps", F.expr("aggregate(fs, array(1L), (a, f) -> array_append(a, least(_most + 1, element_at(a, -1) * size(f.vals))))"))
    scopes = scopes.withColumn("_whole", F.expr("element_at(_steps, -1) <= _most")).withColumn("_n", F.expr("if(_whole, element_at(_steps, -1), _rows)"))
    scopes = scopes.withColumn("_wide", F.expr("aggregate(fs, 0L, (a, f) -> a + 64 + octet_length(f.field_name) + array_max(transform(f.vals, v -> octet_length(v))))"))
    scopes = scopes.withColumn("_per", F.greatest(F.lit(1).cast("bigint"), F.expr(f"{block_bytes}L div _wide")))
    scopes = materialize(scopes.select("document_id", "scope", "fs", "_q", "_steps", "_whole", "_n", "_per"), "combination-scopes")

    numbered = "transform({combos}, n -> struct(n, n div _q % _q AS a, n % _q AS b, bigint(pow(_q, n div (_q * _q))) AS p))"
    digit = "int((c.a + c.b * (i div c.p % _q)) % _q % {size})"
    row = "struct({n} AS combo, transform(fs, (f, i) -> struct(f.field_name AS key, f.vals[{at}] AS value)) AS out)"
    whole = lambda combos: f"transform({combos}, n -> {row.format(n='n', at='int(n div _steps[i] % size(f.vals))')})"
    cover = f"transform({numbered.format(combos='combos')}, c -> {row.format(n='c.n', at=digit.format(size='size(f.vals)'))})"
    rows = lambda df, made: df.select("document_id", "scope", F.explode(F.expr(made)).alias("r"))
    short = "_whole AND _n <= _per"
    out, long = rows(scopes.filter(short), whole("sequence(0L, _n - 1)")), scopes.filter(f"NOT ({short})")
    blocks = long.agg(F.sum(F.expr("(_n - 1) div _per + 1"))).first()[0]
    if blocks:
        spread = lambda df: df.repartition(1 + blocks // 8, "document_id", "scope", "block")
        cut = long.select("document_id", "scope", "_q", "_whole", "_n", "_per", F.expr("transform(fs, f -> size(f.vals))").alias("_sizes"), F.explode(F.expr("sequence(0L, (_n - 1) div _per)")).alias("block"))
        cut = cut.withColumn("combos", F.expr("sequence(block * _per, least(_n, (block + 1) * _per) - 1)"))
        keys = f"transform({numbered.format(combos='combos')}, c -> struct(c.n AS combo, transform(_sizes, (s, i) -> {digit.format(size='s')}) AS at))"
        keys = spread(cut.filter("NOT _whole")).select("document_id", "scope", "_per", F.explode(F.expr(keys)).alias("k"))
        first = keys.groupBy("document_id", "scope", "_per", "k.at").agg(F.min("k.combo").alias("combo"))
        kept = first.groupBy("document_id", "scope", F.expr("combo div _per").alias("block")).agg(F.collect_list("combo").alias("combos"))
        # A merge join hands on one block after the other; other joins may hold all blocks of a scope at once, each with the values.
        named = long.select("document_id", "scope", "fs", "_q", "_steps").hint("merge")
        joined = lambda df: spread(df.select("document_id", "scope", "block", "combos").join(named, ["document_id", "scope"]))
        out = out.unionByName(rows(joined(cut.filter("_whole")), whole("combos"))).unionByName(rows(joined(kept), cover))
    return out.select("document_id", "scope", "r.combo", F.map_from_entries("r.out").alias("assignment"))


def checked_values(values: DataFrame, constraints: DataFrame) -> DataFrame:
    """Adds ``holds`` to values (document_id, scope, field_name, value): whether all constraints on the field hold, null if none can be checked.

    ``constraints``: (document_id, applies_to, domain_constraint_meta). A value is checked once, not in every combination.
    """
    from pagelode.operators.constraints import evaluate_domain

    c = constraints.filter("applies_to.entity_type = 'Field' AND domain_constraint_meta IS NOT NULL").select(
        "document_id", F.upper("applies_to.entity_name").alias("_f"), F.col("domain_constraint_meta.structured_domain").alias("structured_domain")
    ).distinct()
    distinct = values.select("document_id", "field_name", "value").distinct()
    verdict = distinct.withColumn("_f", F.upper("field_name")).join(c, ["document_id", "_f"]).select("document_id", "field_name", "value", evaluate_domain().alias("ok"))
    held = verdict.groupBy("document_id", "field_name", "value").agg(F.bool_and("ok").alias("holds"))
    return values.join(held, ["document_id", "field_name", "value"], "left")


def test_cases(values: DataFrame, constraints: DataFrame, prune: bool = True, most: int = 1000) -> DataFrame:
    """Combinations with ``constraint_satisfaction_status``: (document_id, scope, combo, assignment, status).

    With ``prune`` values that break a constraint are left out before anything is combined, else their combinations are
    marked ``violated``; where some value could be checked and all hold it is ``satisfied``, else ``assumed_valid``.
    """
    checked = materialize(checked_values(values, constraints), "checked-values")
    used = checked.filter("holds IS NULL OR holds") if prune else checked
    m = combination_matrix(used.select("document_id", "scope", "field_name", "value"), most)
    known = used.filter("holds IS NOT NULL").select("document_id", "scope", F.struct("field_name", "value").alias("p"), "holds")
    facts = known.groupBy("document_id", "scope").agg(F.collect_set(F.when(F.col("holds"), F.col("p"))).alias("_yes"), F.collect_set(F.when(~F.col("holds"), F.col("p"))).alias("_no"))
    # A scope's values are its fields' boundary values, so its lists are short.
    pairs = F.transform(F.map_entries("assignment"), lambda e: F.struct(e["key"].alias("field_name"), e["value"].alias("value")))
    status = F.when(F.arrays_overlap(pairs, "_no"), "violated").when(F.arrays_overlap(pairs, "_yes"), "satisfied").otherwise("assumed_valid")
    return m.join(facts, ["document_id", "scope"], "left").select("document_id", "scope", "combo", "assignment", status.alias("constraint_satisfaction_status"))


def wide_cases(cases: DataFrame, names: list[str], unused: str = "X") -> DataFrame:
    """Test cases as a table with a column for each canonical field; fields that a case does not use hold ``unused`` (do not care)."""
    return cases.select("document_id", "scope", "combo", "constraint_satisfaction_status", *(F.coalesce(F.col("assignment")[n], F.lit(unused)).alias(n) for n in names))


def running_counts(events: DataFrame, key: str, at: str) -> DataFrame:
    """Cumulative frequency of each key in order, the relational core of a running glossary."""
    w = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("seen", F.count("*").over(w))
