"""Deeply nested records -> related flat tables.

Spark has no recursive type, so a record is parsed once into VARIANT and its levels are unrolled:
level n+1 is ``flatten(transform(level n, node -> children(node)))``, where the inner transforms
attach the parent's path, the member name and the position. One ``inline`` per target table emits
the rows. How many levels a batch needs comes from a cheap scan of the bracket nesting of the texts that
parse; beyond ``LEVELS_PER_PASS`` the nodes that are still open are written as rows and unrolled again, until
none is open, so no depth is lost and depth in other members costs nothing.

Defined results: text that is no JSON, or whose root is no object, yields nothing; null and empty
texts likewise; an object in place of a list is position 0; null elements (and anything else that is
no object) yield no row but keep their position. Repeated deliveries of a key count once: the latest
valid one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, read_table

#: Which members of which kind of node hold children, and of what kind.
FOLLOWED = {
    "control": {"controls": "control", "parts": "part", "params": "param"},
    "part": {"parts": "part"},
    "param": {},
}
LEVELS_PER_PASS = 16
_NODE = "struct<node_kind:string,node_path:string,parent_path:string,v:variant>"


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _children(level: str, followed: dict[str, dict[str, str]]) -> str:
    """SQL for the nodes one level below those of the array ``level``: for each node its followed members, for each member its elements (a
    single object is position 0), each with its parent's path and its own. Elements that are no objects drop out, positions stay."""
    members = ", ".join(f"struct('{of}' as of, '{m}' as member, '{kind}' as kind)" for of, by in followed.items() for m, kind in by.items())
    inside = lambda kind: f"try_variant_get(x.v, concat('$.', f.member), '{kind}')"
    node = "struct(f.kind as node_kind, concat(x.node_path, '/', f.member, '/', i) as node_path, x.node_path as parent_path, e as v)"
    elements = f"transform(coalesce({inside('array<variant>')}, array({inside('variant')})), (e, i) -> if(try_variant_get(e, '$', 'map<string,variant>') is null, null, {node}))"
    return f"flatten(transform({level}, x -> array_compact(flatten(transform(filter(array({members}), f -> f.of = x.node_kind), f -> {elements})))))"


def nesting_depth(texts: DataFrame, column: str) -> int:
    """The deepest nesting of objects in any text, from brackets outside of strings: at least the depth of any node.

    Texts deeper than one pass count only if they parse; shallower ones are not parsed for this.
    """
    bare = F.regexp_replace(F.regexp_replace(F.col(column), r'"(?:[^"\\]|\\.)*+"', ""), r"[^{}]", "")
    deepest = F.aggregate(
        F.split(bare, ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda a, ch: F.struct(
            (a["now"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)).alias("now"),
            F.greatest(a["most"], a["now"] + F.when(ch == "{", 1).otherwise(0)).alias("most"),
        ),
        lambda a: a["most"],
    )
    deep = texts.select(F.col(column).alias("t"), deepest.alias("n")).where((F.col("n") <= LEVELS_PER_PASS) | F.try_parse_json("t").isNotNull())
    return deep.agg(F.max("n")).first()[0] or 0


def latest_documents(raw: DataFrame, key: str, text: str, received: str) -> DataFrame:
    """key, v: the latest valid document of each key. Ties go by the text's hash."""
    parsed = raw.select(key, F.try_parse_json(text).alias("v"), received, F.xxhash64(text).alias("h"))
    return (
        parsed.where(F.col("v").isNotNull())
        .groupBy(key)
        .agg(F.max_by("v", F.struct(F.coalesce(F.col(received).cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")), "h")).alias("v"))
    )


def explode_tree(docs: DataFrame, key: str, depth: int, followed: dict[str, dict[str, str]] = FOLLOWED, root_kind: str = "control", only: str | None = None) -> DataFrame:
    """Every node of the documents (key, v): key, node_kind, node_path, parent_path, v.

    ``depth`` is at least the depth of any node; ``followed`` says which members of which kind of node
    hold children of what kind; ``only`` names the kind whose rows are wanted, for one inline per target table.
    """
    root = F.when(
        _is_object(F.col("v")),
        F.array(F.struct(F.lit(root_kind).alias("node_kind"), F.lit("$").alias("node_path"), F.lit("").alias("parent_path"), F.col("v").alias("v"))),
    ).otherwise(F.array().cast(f"array<{_NODE}>"))
    level = docs.select(key, root.alias("level0"))
    done = []

    def emitted(names: list[str]) -> DataFrame:
        nodes = F.flatten(F.array(*names))
        return level.select(key, F.inline(nodes if only is None else F.filter(nodes, lambda x: x["node_kind"] == only)))

    while True:
        count = min(depth, LEVELS_PER_PASS)
        for n in range(count):
            level = level.selectExpr("*", f"{_children(f'level{n}', followed)} as level{n + 1}")
        names = [f"level{n}" for n in range(count + 1)]
        if depth <= LEVELS_PER_PASS:
            done.append(emitted(names))
            break
        done.append(emitted(names[:-1]))
        # Only nodes that are still open are written, not the documents.
        level = checkpointed(level.select(key, F.explode(names[-1]).alias("node")).select(key, F.array("node").alias("level0")))
        if level.isEmpty():
            break
        depth -= count
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def flat_nodes(raw: DataFrame, key: str = "raw_id", text: str = "raw_json", received: str = "received_at", only: str | None = None) -> DataFrame:
    return explode_tree(latest_documents(raw, key, text, received), key, nesting_depth(raw, text), only=only)


def _text(member: str) -> Column:
    return F.try_variant_get("v", f"$.{member}", "string")


def p2_found(spark, base: str) -> DataFrame:
    return flat_nodes(read_table(spark, base, "oscal_raw")).select("raw_id", "node_kind", "node_path", "parent_path")


def _table(spark, base: str, kind: str, members: dict[str, str]) -> DataFrame:
    nodes = flat_nodes(read_table(spark, base, "oscal_raw"), only=kind)
    return nodes.select(
        "raw_id", "node_path", "parent_path",
        F.element_at(F.split("node_path", "/"), -1).try_cast("int").alias("position"),
        *[_text(m).alias(a) for m, a in members.items()],
    )


def p2_controls(spark, base: str) -> DataFrame:
    return _table(spark, base, "control", {"id": "control_id", "class": "control_class", "title": "title"})


def p2_parts(spark, base: str) -> DataFrame:
    return _table(spark, base, "part", {"id": "part_id", "name": "name", "title": "title", "prose": "prose"})


def p2_params(spark, base: str) -> DataFrame:
    return _table(spark, base, "param", {"id": "param_id", "label": "label", "usage": "usage"})
