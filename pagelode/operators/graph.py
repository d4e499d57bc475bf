"""The ontology as two tables, nodes and edges, with the integrity rules of its consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions import scalars as S
from pagelode.functions.text import blank_to_null, strip
from pagelode.operators.catalog import first_wins, last_wins
from pagelode.session import materialize


def _unit(c: str = "execution_unit"):  # noqa: ANN202
    return F.coalesce(blank_to_null(c), F.lit("UNKNOWN_UNIT"))


def _node(df: DataFrame, kind: str, rank: int, node_id, order, **props) -> DataFrame:  # noqa: ANN001, ANN003
    p = F.to_json(F.struct(*(v.alias(k) for k, v in props.items()))) if props else F.lit("{}")
    return df.select(node_id.alias("id"), F.lit(kind).alias("type"), p.alias("props"), F.struct(F.lit(rank).alias("kind"), order.cast("string").alias("at")).alias("pos"))


def ontology_nodes(constraints: DataFrame, instructions: DataFrame, datatypes: DataFrame, registry: DataFrame, ip: str = "sample") -> DataFrame:
    """Nodes (id, type, props): of several with one id the last wins. ``instructions`` and ``constraints`` carry ``pos``."""
    spark = constraints.sparkSession
    root = spark.createDataFrame([(ip,)], "n string")
    def at(df: DataFrame):  # noqa: ANN202
        return F.col("pos") if dict(df.dtypes)["pos"] == "string" else F.lpad(F.col("pos").cast("string"), 20, "0")

    fields = datatypes.select(strip(F.col("field_name")).alias("f")).filter("f <> ''").distinct()
    types = registry.select(strip(F.col("type_id")).alias("t")).filter("t <> ''").distinct()
    units = instructions.select(_unit().alias("u")).distinct()
    cons = constraints.filter(blank_to_null("constraint_id").isNotNull())
    nodes = (
        _node(root, "IP", 0, F.lit(f"IP:{ip}"), F.lit(""), ip_name=F.col("n"))
        .unionByName(_node(units, "ExecutionUnit", 1, F.concat(F.lit("EU:"), "u"), F.col("u"), name=F.col("u")))
        .unionByName(_node(
            instructions, "Instruction", 2, S.instruction_node_id("instruction_name", "variation", "opcode_value"), at(instructions),
            instruction_name=F.upper(strip(F.col("instruction_name"))), variation=S.normalize_variation("variation"), opcode_value=F.col("opcode_value"),
        ))
        .unionByName(_node(fields, "Field", 3, F.concat(F.lit("Field:"), F.upper("f")), F.col("f"), name=F.col("f")))
        .unionByName(_node(types, "DataType", 4, F.concat(F.lit("DT:"), "t"), F.col("t"), type_id=F.col("t")))
        .unionByName(_node(cons, "Constraint", 5, F.concat(F.lit("Constraint:"), strip(F.col("constraint_id"))), at(cons), constraint_id=strip(F.col("constraint_id"))))
    )
    return last_wins(nodes, ["id"], "pos").select("id", "type", "props", "pos")


def ontology_edges(constraints: DataFrame, instructions: DataFrame, datatypes: DataFrame, ip: str = "sample", scope: list[str] | None = None) -> DataFrame:
    """Distinct edges (from, rel, to); ends may be missing among the nodes.

    ``scope`` names columns (such as document_id) within which names are looked up; of several instructions
    with one name or key the first by ``pos`` is meant. Constraints without such a column are looked up in all.
    """
    scope = scope or []
    own = [x for x in scope if x in constraints.columns]
    iid = S.instruction_node_id("instruction_name", "variation", "opcode_value")
    inst = instructions.select(
        *scope, "pos", iid.alias("iid"), _unit().alias("unit"), F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("name"), F.coalesce(S.normalize_variation("variation"), F.lit("")).alias("var")
    )
    root = F.lit(f"IP:{ip}")
    runs = inst.select(F.col("iid").alias("from"), F.lit("EXECUTES_ON").alias("rel"), F.concat(F.lit("EU:"), "unit").alias("to"))
    has = inst.select(root.alias("from"), F.lit("HAS_INSTRUCTION").alias("rel"), F.col("iid").alias("to"))
    c = constraints.select(
        *own, F.concat(F.lit("Constraint:"), strip(F.col("constraint_id"))).alias("from"), strip(F.coalesce("applies_to.entity_type", F.lit("Field"))).alias("et"), blank_to_null("applies_to.entity_name").alias("en")
    ).filter(blank_to_null("constraint_id").isNotNull() & F.col("en").isNotNull())
    rel = F.lit("APPLIES_TO").alias("rel")
    to_field = c.filter("et = 'Field'").select("from", rel, F.concat(F.lit("Field:"), F.upper("en")).alias("to"))
    to_doc = c.filter("et = 'Document'").select("from", rel, root.alias("to"))
    by_name = first_wins(inst.select(*own, "name", "iid", "pos"), [*own, "name"], "pos")
    to_inst = c.filter("et = 'Instruction'").withColumn("name", F.upper("en")).join(by_name, [*own, "name"]).select("from", rel, F.col("iid").alias("to"))
    by_key = first_wins(inst.filter("name <> ''").select(*scope, "name", "var", "iid", "pos"), [*scope, "name", "var"], "pos")
    f = datatypes.select(
        *scope, F.upper(strip(F.coalesce("instruction_name", F.lit("")))).alias("name"), F.coalesce(S.normalize_variation("variation"), F.lit("")).alias("var"),
        F.concat(F.lit("Field:"), F.upper(blank_to_null("field_name"))).alias("fid"), blank_to_null("data_type_ref").alias("dt"),
    ).filter("fid IS NOT NULL").distinct()
    fields = f.join(by_key, [*scope, "name", "var"]).select(F.col("iid").alias("from"), F.lit("HAS_FIELD").alias("rel"), F.col("fid").alias("to"))
    types = f.filter("dt IS NOT NULL").select(F.col("fid").alias("from"), F.lit("HAS_DATATYPE").alias("rel"), F.concat(F.lit("DT:"), "dt").alias("to"))
    out = runs
    for part in (has, to_field, to_doc, to_inst, fields, types):
        out = out.unionByName(part)
    return out.distinct()


def sound_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes, as a graph database takes them."""
    ids = nodes.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", "from"), "from", "left_semi").join(ids.withColumnRenamed("id", "to"), "to", "left_semi").select("from", "rel", "to")


def dangling_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with a missing end, which ends are missing, and nothing else."""
    ids = materialize(nodes.select("id").distinct(), "node-ids")  # joined to both ends
    a, b = ids.select(F.col("id").alias("from"), F.lit(True).alias("_f")), ids.select(F.col("id").alias("to"), F.lit(True).alias("_t"))
    j = edges.join(a, "from", "left").join(b, "to", "left").filter("_f IS NULL OR _t IS NULL")
    return j.select("from", "rel", "to", F.col("_f").isNull().alias("from_missing"), F.col("_t").isNull().alias("to_missing"))


def viewer_graph(nodes: DataFrame, edges: DataFrame, max_edges: int) -> tuple[DataFrame, DataFrame]:
    """At most ``max_edges`` edges in order, and nodes with stand-ins for missing ends, as a viewer draws them."""
    e = edges.orderBy("from", "rel", "to").limit(max_edges)
    ends = e.select(F.explode(F.array("from", "to")).alias("id")).distinct().join(nodes.select("id"), "id", "left_anti")
    n = first_wins(nodes.select("id", "type", "pos"), ["id"], "pos").select("id", "type")
    return n.unionByName(ends.select("id", F.lit("Unknown").alias("type"))), e


def sample_edges(nodes: DataFrame, edges: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` edges with the kinds of their ends, in order."""
    k = nodes.select("id", "type")
    e = edges.join(k.withColumnsRenamed({"id": "from", "type": "from_type"}), "from").join(k.withColumnsRenamed({"id": "to", "type": "to_type"}), "to")
    return e.orderBy("from", "rel", "to").limit(limit)


def props_text(props, limit: int = 12_000):  # noqa: ANN001, ANN201
    """Properties as text of at most ``limit`` characters, cut ones marked."""
    return F.when(F.length(props) > limit, F.concat(F.left(props, F.lit(limit)), F.lit("…"))).otherwise(props)


def node_degrees(edges: DataFrame) -> DataFrame:
    """(id, out_degree, in_degree) of all ends."""
    e = edges.select(F.explode(F.array(F.struct(F.col("from").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("to").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
    return e.groupBy("x.id").agg(F.sum("x.o").alias("out_degree"), F.sum("x.i").alias("in_degree"))
