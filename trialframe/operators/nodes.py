"""Match trees. The tree of record is a JSON text; ``match_nodes`` is its flat form.

match_nodes: (key, node_path, op, body): ``op`` is and, or, clinical or genomic; ``body`` the leaf's JSON (null for and/or).

Trees are read level by level inside their own row, with Spark's JSON functions: a level is an array of nodes, and the next one holds their
children. The plan has as many levels as the deepest tree of the table, which one aggregation over the texts' brackets bounds; trees are
rebuilt from the last level up. Names are resolved by joins, once each.

Defined outcomes, listed by ``rejects``: text that is no JSON object and trees of over LEVELS levels have no nodes and validate to null; a name that is no
text (a list, a number) can't be resolved and is dropped. Children that are no objects aren't nodes, but keep their number (a child that is a text which spells an
object counts as that object). Null trees have no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from . import vocab

DIAGNOSIS = "oncotree_primary_diagnosis"


def diagnosis_leaf(name: Column) -> Column:
    return F.to_json(F.struct(F.struct(name.alias(DIAGNOSIS)).alias("clinical")))


def diagnoses_to_node(names: Column) -> Column:
    """JSON: none gives null, one a leaf, several an ``or`` of leaves."""
    leaves = F.transform(names, lambda n: F.struct(F.struct(n.alias(DIAGNOSIS)).alias("clinical")))
    return F.when(F.size(names) == 1, diagnosis_leaf(F.try_element_at(names, F.lit(1)))).when(F.size(names) > 1, F.to_json(F.struct(leaves.alias("or"))))


def union_nodes(nodes: Column) -> Column:
    """All suggestions that aren't null, in order, repeats kept."""
    return F.array_compact(nodes)


def append_node(steps: Column, node: Column) -> Column:
    """``node`` at the end of the first step's match list; nothing changes where it is null."""
    return F.transform(steps, lambda s, i: F.when((i == 0) & node.isNotNull(), s.withField("match", F.array_append(s["match"], node))).otherwise(s))


#: deeper trees are rejected
LEVELS = 100
_PARTS = "and string, or string, clinical string, genomic string"


def _brackets(text: Column) -> Column:
    """How deep lists are nested in a JSON text, strings left out."""
    plain = F.regexp_replace(text, r'"[^"\\]*(?:\\.[^"\\]*)*"', "")
    signs = F.split(F.regexp_replace(plain, r"[^\[\]]", ""), "")
    step = lambda x, c: F.struct((x["now"] + F.when(c == "[", 1).when(c == "]", -1).otherwise(0)).alias("now"), F.greatest(x["most"], x["now"] + F.when(c == "[", 1).otherwise(0)).alias("most"))
    return F.aggregate(signs, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step)["most"]


def _op(parts: Column) -> Column:
    return F.when(parts["and"].isNotNull(), "and").when(parts["or"].isNotNull(), "or").when(parts["clinical"].isNotNull(), "clinical").otherwise("genomic")


def _level(rows: DataFrame, nodes: Column, name: str) -> DataFrame:
    """``rows`` with an array of nodes (at, parent, text) as a level: each node's parts and operator, objects only."""
    objects = F.filter(nodes, lambda n: F.coalesce(n["text"].startswith("{"), F.lit(False)))
    read = F.transform(objects, lambda n: F.struct(n["at"].alias("at"), n["parent"].alias("parent"), n["text"].alias("text"), F.from_json(n["text"], _PARTS).alias("parts")))
    return rows.withColumn(name, F.transform(read, lambda n: n.withField("op", _op(n["parts"]))))


def _children(level: Column) -> Column:
    """The children of a level's nodes in order, with the place of their parent in the level."""

    def of(n: Column, i: Column) -> Column:
        listed = F.when(n["op"] == "and", n["parts"]["and"]).when(n["op"] == "or", n["parts"]["or"])
        own = F.when(listed.startswith("["), F.from_json(listed, "array<string>"))
        nodes = F.transform(own, lambda c, j: F.struct(F.concat(n["at"], F.array(j)).alias("at"), i.alias("parent"), c.alias("text")))
        return F.coalesce(nodes, F.array().cast("array<struct<at:array<int>,parent:int,text:string>>"))

    return F.flatten(F.transform(level, of))


def _levels(trees: DataFrame, key: str, node: str, levels: int) -> tuple[DataFrame, int]:
    """(rows, n): the trees that aren't null (key, node), with ``deep``, whether there are more levels, and else columns level0 to level{n - 1}:
    arrays of nodes (at, parent, op, text), with the text of leaves only."""
    rows = trees.filter(F.col(node).isNotNull()).select(key, F.col(node).cast("string").alias("node"))
    deepest = rows.agg(F.max(_brackets(F.col("node")))).head()[0] or 0
    root = F.when(F.ltrim("node").startswith("{") & F.try_parse_json("node").isNotNull(), F.get(F.from_json(F.concat(F.lit("["), F.col("node"), F.lit("]")), "array<string>"), F.lit(0)))
    first = F.array(F.struct(F.array().cast("array<int>").alias("at"), F.lit(-1).alias("parent"), root.alias("text")))
    rows, n = _level(rows, first, "level0"), 1
    while n <= min(deepest, levels - 1):
        rows, n = _level(rows, _children(F.col(f"level{n - 1}")), f"level{n}"), n + 1
    more = F.size(F.filter(_children(F.col(f"level{n - 1}")), lambda c: c["text"].startswith("{"))) > 0 if deepest >= levels else F.lit(False)
    rows = rows.withColumn("deep", more)
    leaf = lambda x: F.struct(x["at"].alias("at"), x["parent"].alias("parent"), x["op"].alias("op"), F.when(~x["op"].isin("and", "or"), x["text"]).alias("text"))
    return rows.select(key, "node", "deep", *[F.when(~F.col("deep"), F.transform(f"level{i}", leaf)).alias(f"level{i}") for i in range(n)]), n


def _fields(clinical: Column) -> Column:
    return F.from_json(clinical, "map<string,variant>")


def _name(fields: Column) -> Column:
    """The diagnosis name of a clinical leaf's fields, null if it is no text."""
    value = F.try_element_at(fields, F.lit(DIAGNOSIS))
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _flat(rows: DataFrame, n: int, key: str) -> DataFrame:
    every = F.flatten(F.array_compact(F.array(*[F.col(f"level{i}") for i in range(n)])))
    found = rows.select(key, F.explode(every).alias("n"))
    return found.select(key, F.col("n.at").alias("node_path"), "n.op", F.col("n.text").alias("body"))


def flatten_nodes(trees: DataFrame, key: str, node: str, levels: int = LEVELS) -> DataFrame:
    """match_nodes of one JSON tree for each row of ``trees``, in one pass and without a shuffle."""
    return _flat(*_levels(trees, key, node, levels), key)


def rejects(trees: DataFrame, key: str, node: str, levels: int = LEVELS) -> DataFrame:
    """(key, node, reason): trees that aren't read as a whole."""
    rows, n = _levels(trees, key, node, levels)
    every = F.flatten(F.array_compact(F.array(*[F.col(f"level{i}") for i in range(n)])))
    fields = F.transform(F.filter(every, lambda x: x["op"] == "clinical"), lambda x: _fields(F.get_json_object(x["text"], "$.clinical")))
    odd = F.exists(fields, lambda f: F.try_element_at(f, F.lit(DIAGNOSIS)).isNotNull() & _name(f).isNull())
    reason = F.when(F.col("deep"), f"over {levels} levels").when(F.size("level0") == 0, "no JSON object").when(odd, "a name that is no text")
    return rows.select(key, "node", reason.alias("reason")).filter("reason IS NOT NULL")


def has_diagnosis(nodes: DataFrame, key: str) -> DataFrame:
    """(key, has_diagnosis): whether a diagnosis leaf is anywhere in the tree."""
    return nodes.groupBy(key).agg(F.bool_or(is_diagnosis()).alias("has_diagnosis"))


def is_diagnosis() -> Column:
    return (F.col("op") == "clinical") & F.coalesce(F.get_json_object("body", f"$.clinical.{DIAGNOSIS}").isNotNull(), F.lit(False))


def validate_nodes(trees: DataFrame, vocabulary: DataFrame, key: str, node: str, corrections: dict[str, str | None] | None = None, levels: int = LEVELS) -> DataFrame:
    """(key, node): trees with their diagnosis names resolved; names that can't be are dropped, and so are leaves
    and and/or nodes that become empty. A clinical leaf's genomic part is lost; genomic leaves stay as they are.

    There is one row for each tree that isn't null; text without nodes gives null. Equal texts give equal trees, so each text is
    validated once and joined to the keys that have it. Names are resolved once each, and go back to the texts as one map for each.
    """
    trees = stored(trees.filter(F.col(node).isNotNull()).select(key, F.col(node).cast("string").alias("node")), "trees")
    # dealt out again, since few bytes of text are much work
    texts = trees.select("node").distinct().repartition(int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = stored(texts.withColumn("tree", F.monotonically_increasing_id()), "texts")
    valid = stored(_validated(texts, vocabulary, corrections, levels).join(texts, "tree").select(F.col("node").alias("__text"), "valid"), "valid")
    return trees.join(valid, F.col("node") == F.col("__text"), "left").select(key, F.col("valid").alias("node"))


def _validated(texts: DataFrame, vocabulary: DataFrame, corrections: dict[str, str | None] | None, levels: int) -> DataFrame:
    """(tree, valid) of texts (tree, node)."""
    rows, n = _levels(texts, "tree", "node", levels)
    rows = stored(rows.drop("node", "deep"), "levels")
    leaves = _flat(rows, n, "tree").filter("op = 'clinical'").select("tree", _fields(F.get_json_object("body", "$.clinical")).alias("fields"))
    used = leaves.select("tree", _name(F.col("fields")).alias("name")).filter("name IS NOT NULL").distinct()
    used = stored(used, "names")  # several joins look them up
    resolved = vocab.resolve(used.select("name").distinct(), vocabulary, corrections=corrections).filter("resolved IS NOT NULL")
    own = used.join(resolved, "name").groupBy("tree").agg(F.map_from_entries(F.collect_list(F.struct("name", "resolved"))).alias("names"))
    rows = rows.join(own, "tree", "left").withColumn("names", F.coalesce("names", F.create_map().cast("map<string,string>")))

    # an expression that a lambda mentions twice is worked out twice: name and kept are made in steps of their own
    def leaf(n: Column) -> Column:
        return F.struct(n["parent"].alias("parent"), n["op"].alias("op"), n["text"].alias("text"), F.when(n["op"] == "clinical", _fields(F.get_json_object(n["text"], "$.clinical"))).alias("fields"))

    def named(n: Column) -> Column:
        return n.withField("name", F.try_element_at("names", _name(n["fields"])))

    def kept(n: Column) -> Column:
        return n.withField("fields", F.map_filter(n["fields"], lambda k, v: (k != DIAGNOSIS) | n["name"].isNotNull()))

    def fixed(n: Column) -> Column:
        """A clinical leaf's text, null if nothing is left."""
        fields = F.transform_values(n["fields"], lambda k, v: F.when(k == DIAGNOSIS, n["name"].cast("variant")).otherwise(v))
        return F.when(F.size(n["fields"]) > 0, F.concat(F.lit('{"clinical":'), F.to_json(fields), F.lit("}")))

    def rebuilt(below: str | None) -> Callable[[Column, Column], Column]:
        """A node with its children's texts, which are in the level below."""

        def kids(at: Column) -> Column:
            if below is None:
                return F.array().cast("array<string>")
            return F.transform(F.filter(below, lambda c: (c["parent"] == at) & c["text"].isNotNull()), lambda c: c["text"])

        return lambda x, at: x.withField("kids", F.when(x["op"].isin("and", "or"), kids(at)))

    def written(x: Column) -> Column:
        inner = F.when(F.size(x["kids"]) > 0, F.concat(F.lit('{"'), x["op"], F.lit('":['), F.array_join(x["kids"], ","), F.lit("]}")))
        text = F.when(x["op"].isin("and", "or"), inner).when(x["op"] == "clinical", fixed(x)).otherwise(x["text"])
        return F.struct(x["parent"].alias("parent"), text.alias("text"))

    for i in reversed(range(n)):
        level, below = f"level{i}", f"level{i + 1}" if i + 1 < n else None
        # a column that is mentioned twice isn't copied into what uses it: a level is worked out once, not for every node above
        made = F.transform(F.transform(F.transform(F.transform(F.transform(level, leaf), named), kept), rebuilt(below)), written)
        rows = rows.withColumn(level, made if below is None else F.when(F.size(below).isNotNull(), made))
    return rows.select("tree", F.get(F.col("level0"), F.lit(0))["text"].alias("valid"))
