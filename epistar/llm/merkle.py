"""Merkle manifest of a table, and proofs checked by a recursive query over its stored nodes.

Every row is a leaf: H (lowercase hex SHA-256) of its fields, each written as
``-`` if null and else as byte count, ``:``, value. Leaves of one tree column value
(``lang``) in ascending order of id form a tree of runs of eight; the trees'
roots, in bytewise order of that column with null first, form the top tree, whose
root stands for the whole table. A tree of one leaf has that leaf as its root.

The levels are built bottom up, one grouping each, and stored as parent-linked
rows, one for each run: its digests (``kids``), the id of the run above and its
place there. A ``WITH RECURSIVE`` query then ascends from every leaf: in each round
a leaf meets the run above it, folds the digest it carries with its siblings'
and takes the parent link, until no run is above.

What keeps this even at any size:

* Leaves are numbered in the global order by ranges of (tree, id), so a tree
  that holds most rows is spread over many tasks.
* All leaves meet the runs near the root. A run is therefore stored once for
  each ``BLOCK`` consecutive leaves below it, and they meet on (run, block): no key
  serves more than ``BLOCK`` leaves, at 1 / ``BLOCK`` rows a leaf and level.
* The digests of a run are carried by the first of each ``SHARE`` neighbouring
  leaves below it, and the others read them there when the proof is put
  together, so rounds move a digest a leaf and not all its siblings.

Defined cases: null ids come first; rows equal in id are ordered by their digest, and equal
rows are leaves of their own; null and empty texts differ (``-`` and ``0:``); an
empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epistar.llm.common import table
from epistar.session import cut_lineage

FANOUT = 8
BLOCK = 4096
SHARE = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "top"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


@dataclass
class Manifest:
    """``leaves``: leaf, row_id, digest, shown, up, slot; ``runs``: id, block, first, kids, parent, slot, tops; ``root``: hex or None."""

    leaves: DataFrame
    runs: DataFrame
    root: str | None


def leaf_hash(fields: Sequence[Column]) -> Column:
    """H over the fields of a row."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def numbered(df: DataFrame, order: Sequence[str], out_col: str) -> DataFrame:
    """``df`` with its rank (from 0, nulls first) as ``out_col``, without a global sort in one task.

    Positions inside range partitions are fixed in the shared folder, then shifted by the sizes of the
    partitions before (one number a partition, whose count is a setting).
    """
    cols = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    ranged = cut_lineage(ranged.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    sizes = sorted((r["_pid"], r["n"]) for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    before, rows = 0, []
    for pid, n in sizes:
        rows.append((pid, before))
        before += n
    offsets = df.sparkSession.createDataFrame(rows, "_pid int, _off long")
    place = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    return ranged.join(F.broadcast(offsets), "_pid").withColumn(out_col, F.col("_off") + place).drop("_pid", "_mid", "_off")


def _climbed(n: int) -> int:
    return -(-n // FANOUT)


def _name(tree: Column, level: int, pos: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(level), pos.cast("string"))


def _levels(nodes: DataFrame, widest: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of every level, and the roots, of trees given as (tree, pos, n, digest, first, last).

    ``n`` is the number of nodes of the tree at this level, ``widest`` the largest of them.
    Runs: tree, level, pos, n (of the level they make), kids (hex), digest, first, last (leaf numbers below).
    """
    runs, roots, level = [], [nodes.where("n = 1")], 0
    while widest > 1:
        level, widest = level + 1, _climbed(widest)
        kid = F.struct("pos", "digest")
        made = (
            nodes.where("n > 1").groupBy("tree", F.expr(f"pos DIV {FANOUT}").alias("up"))
            .agg(
                F.max(F.expr(f"(n + {FANOUT - 1}) DIV {FANOUT}")).alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
                F.array_join(F.transform(F.array_sort(F.collect_list(kid)), lambda k: k["digest"]), "").alias("kids"),
            )
            .withColumn("digest", F.sha2("kids", 256))
        )
        made = cut_lineage(made.select("tree", F.col("up").alias("pos"), "n", "digest", "first", "last", "kids"))
        runs.append(made.withColumn("level", F.lit(level)))
        nodes = made.drop("kids")
        roots.append(nodes.where("n = 1"))
    return runs, roots


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def build_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "lang",
    shown: Mapping[str, Column] | None = None,
) -> Manifest:
    """The leaves and stored runs of ``docs``. ``shown`` replaces fields of the version that is to be checked against it."""
    seen = [(shown or {}).get(f, F.col(f"`{f}`")) for f in fields]
    hashed = docs.select(
        F.col(f"`{id_col}`").alias("row_id"), F.col(f"`{tree_col}`").cast("string").alias("tree_value"),
        leaf_hash([F.col(f"`{f}`") for f in fields]).alias("digest"), leaf_hash(seen).alias("shown"),
    )
    # texts are hashed once, whatever the range sampling reads again
    leaves = numbered(cut_lineage(hashed), ["tree_value", "row_id", "digest", "shown"], "leaf")
    leaves = cut_lineage(leaves)
    trees = leaves.groupBy("tree_value").agg(F.min("leaf").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = cut_lineage(numbered(trees, ["tree_value"], "tree"))
    counts = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("widest"), F.sum("n").alias("leaves")).first()
    if not counts["trees"]:
        runs = docs.sparkSession.createDataFrame([], "id string, block long, first long, kids binary, parent string, slot int, tops boolean")
        empty = leaves.select("leaf", "row_id", "digest", "shown", F.lit("").alias("up"), F.lit(0).alias("slot"))
        return Manifest(empty, runs, None)
    leaves = _with_tree(leaves, trees)

    base = leaves.select("tree", "pos", "n", "digest", F.col("leaf").alias("first"), F.col("leaf").alias("last"))
    runs, roots = _levels(base, counts["widest"])
    subroots = cut_lineage(_union([r.select("tree", "digest", "first", "last") for r in roots]))
    tops = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("pos"), F.lit(counts["trees"]).alias("n"), "digest", "first", "last")
    top_runs, top_roots = _levels(tops, counts["trees"])
    root = _union([r.select("digest") for r in top_roots]).first()["digest"]

    many = F.lit(counts["trees"] > 1)
    over_tree = F.when(many, _name(F.lit(TOP), 1, F.expr(f"tree DIV {FANOUT}")))

    def linked(frame: DataFrame, level: int) -> DataFrame:
        """Parent and slot of nodes of a tree at ``level``; a tree's root hangs in the top tree."""
        up = F.when(F.col("n") > 1, _name(F.col("tree"), level + 1, F.expr(f"pos DIV {FANOUT}"))).otherwise(over_tree)
        slot = F.when(F.col("n") > 1, F.col("pos") % FANOUT).otherwise(F.col("tree") % FANOUT)
        return frame.withColumns({"parent": up, "slot": slot.cast("int")})

    stored = []
    for k, made in enumerate(runs, 1):
        stored.append(linked(made, k).withColumns({"id": _name(F.col("tree"), k, F.col("pos")), "tops": F.lit(False)}))
    for k, made in enumerate(top_runs, 1):
        up = F.when(F.col("n") > 1, _name(F.lit(TOP), k + 1, F.expr(f"pos DIV {FANOUT}")))
        stored.append(made.withColumns({
            "parent": up, "slot": (F.col("pos") % FANOUT).cast("int"), "id": _name(F.lit(TOP), k, F.col("pos")), "tops": F.lit(k == 1),
        }))
    columns = ["id", "first", "last", "kids", "parent", "slot", "tops"]
    spark = docs.sparkSession
    whole = _union([s.select(*columns) for s in stored]) if stored else spark.createDataFrame(
        [], "id string, first long, last long, kids string, parent string, slot int, tops boolean")
    blocks = F.explode(F.sequence(F.expr(f"first DIV {BLOCK}"), F.expr(f"last DIV {BLOCK}")))
    whole = whole.select("id", blocks.alias("block"), "first", F.unhex("kids").alias("kids"), "parent", "slot", "tops")
    hung = linked(leaves, 0).select("leaf", "row_id", "digest", "shown", F.col("parent").alias("up"), "slot")
    return Manifest(hung, cut_lineage(whole), root)


def _with_tree(leaves: DataFrame, trees: DataFrame) -> DataFrame:
    """Leaves with their tree's number and size and their place in it (a row of ``trees`` for each value of the tree column)."""
    side = trees.select(F.col("tree_value").alias("_value"), "tree", "start", "n")
    met = leaves.join(side, F.col("tree_value").eqNullSafe(F.col("_value")))
    return met.withColumn("pos", F.col("leaf") - F.col("start")).drop("_value", "tree_value", "start")


CLIMB = f"""
WITH RECURSIVE climb(leaf, level, via, up, slot, at, folded, kids, row_id, digest, subroot) AS (
  SELECT leaf, 0, CAST(NULL AS STRING), up, slot, 0, unhex(shown), CAST(NULL AS BINARY), row_id, unhex(digest), CAST(NULL AS BINARY)
  FROM {{leaves}}
  UNION ALL
  SELECT c.leaf, c.level + 1, r.id, r.parent, r.slot, c.slot,
    unhex(sha2(lower(concat(
      hex(substring(r.kids, 1, 32 * c.slot)), hex(c.folded), hex(substring(r.kids, 32 * c.slot + 33)))), 256)),
    CASE WHEN c.leaf = greatest(r.first, c.leaf DIV {SHARE} * {SHARE}) THEN r.kids END,
    CAST(NULL AS {{{{id_type}}}}), CAST(NULL AS BINARY), CASE WHEN r.tops THEN substring(r.kids, 32 * c.slot + 1, 32) END
  FROM climb c JOIN {{runs}} r ON r.id = c.up AND r.block = c.leaf DIV {BLOCK})
SELECT * FROM climb LIMIT ALL
"""


def check_proofs(spark: SparkSession, made: Manifest) -> DataFrame:
    """For each leaf: row_id, leaf, subroot, root, proof_sha256, folded_root (of the shown version), verified.

    The proof is the leaf's siblings, level by level, left to right.
    """
    query = CLIMB.replace("{{id_type}}", made.leaves.schema["row_id"].dataType.simpleString().upper())
    steps = spark.sql(query, leaves=made.leaves, runs=made.runs)
    # one exchange serves the window and the grouping: both are within neighbouring leaves
    steps = steps.withColumn("near", F.expr(f"leaf DIV {SHARE}")).repartition("near")
    # the run's digests stand at the first of the neighbouring leaves below it
    kids = F.max("kids").over(Window.partitionBy("near", "via"))
    steps = steps.withColumn("kids", F.when(F.col("level") > 0, kids))
    siblings = F.concat(F.expr("hex(substring(kids, 1, 32 * at))"), F.expr("hex(substring(kids, 32 * at + 33))"))
    steps = steps.withColumn("siblings", F.when(F.col("level") > 0, F.lower(siblings)).otherwise(F.lit("")))
    digest_hex = lambda c: F.lower(F.hex(c))
    proofs = steps.groupBy("near", "leaf").agg(
        F.max("row_id").alias("row_id"), digest_hex(F.max("digest")).alias("digest"), digest_hex(F.max("subroot")).alias("subroot"),
        digest_hex(F.max_by("folded", "level")).alias("folded_root"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("level", "siblings"))), lambda s: s["siblings"]), "").alias("proof"),
    )
    root = F.lit(made.root).cast("string")
    return proofs.select(
        "row_id", F.col("digest").alias("leaf"), F.coalesce("subroot", root).alias("subroot"), root.alias("root"),
        F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"),
    )


# Letters that tampering turns into small ones.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` and the check of every row against it, a third of the rows tampered with.

    A row whose ``crc32(doc_id)`` 3 divides shows its text in small letters; null ids and texts are not tampered with.
    An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    shown = {"text": F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))}
    return check_proofs(spark, build_manifest(docs, shown=shown)).withColumnRenamed("row_id", "doc_id")
