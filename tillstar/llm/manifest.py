"""Merkle manifest of a table, and a proof for every row from one multiproof per run of leaves.

A leaf is the hash of a row.  The leaves of a source form a tree of arity 16,
and the roots of the sources another one.  Hashes are SHA-256 as lowercase hex
text; a node is the hash of its children's text in order.  The nodes that hash
to one parent are a run; a run is named by its level and its parent's place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import ROW, small
from tillstar.session import write_shared

BITS = 4
ARITY = 1 << BITS
LOCAL_LEVELS = 3  # levels of a tree that one task builds from a run of leaves,
CHUNK = ARITY**LOCAL_LEVELS  # which are so many
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_text(value: Column) -> Column:
    """A field as it is hashed: ``-`` for NULL, otherwise the count of its UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field_text, fields)), 256)


def folded(leaf: Column, places: Column, siblings: Column) -> Column:
    """The root that a leaf and its proof give: per level, its place in its run and the text of the others there."""
    level = F.arrays_zip(places.alias("place"), siblings.alias("others"))

    def up(node: Column, step: Column) -> Column:
        at = step["place"] * HEX
        others = step["others"]
        return F.sha2(F.concat(F.substring(others, F.lit(1), at), node, F.substring(others, at + 1, F.length(others))), 256)

    return F.aggregate(level, leaf, up)


def height(count: Column) -> Column:
    """Levels above the leaves of a tree of so many."""
    return sum((F.when(count > ARITY**k, 1).otherwise(0) for k in range(15)), F.lit(0))


def missing(place: Column, low: Column | int, top: Column) -> Column:
    """What lacks to prove all that lies below node ``place`` of level ``low`` up to level ``top``.

    The least set of coordinates (level, run, at): one run a level, however many
    leaves lie below the node; parents are derived, so none is asked for.
    """
    low = low if isinstance(low, Column) else F.lit(low)
    step = lambda k: F.struct(
        (low + k).alias("level"),
        F.call_function("shiftright", place, k * BITS + BITS).alias("run"),
        F.call_function("shiftright", place, k * BITS).bitwiseAND(ARITY - 1).cast("int").alias("at"),
    )
    return F.when(top > low, F.transform(F.sequence(F.lit(0), top - low - 1), step))


# Inside a task ------------------------------------------------------------------


def parents(nodes: Sequence[str]) -> list[str]:
    return [hashlib.sha256("".join(nodes[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(nodes), ARITY)]


def runs_of(nodes: Sequence[str]) -> list[str]:
    return ["".join(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]


def levels_below(count: int) -> int:
    """How many of ``LOCAL_LEVELS`` levels there are above a tree's nodes, if they are so many."""
    levels = 0
    while count > 1 and levels < LOCAL_LEVELS:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def without(run: str, place: int) -> str:
    return run[: HEX * place] + run[HEX * (place + 1) :]


NODES = "tree string, width long, is_run boolean, level int, place long, nodes string"


def chunk_builder(level: int, with_runs: bool) -> Callable[[pa.Table], pa.Table]:
    """Of a chunk of a level's nodes, the node above all of them, and their runs and those on the way up."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        tree, width, first = (rows[name][0].as_py() for name in ("tree", "width", "place"))
        nodes, out = rows["digest"].to_pylist(), []
        levels = levels_below(width)
        for up in range(levels):
            if with_runs:
                start = first >> (BITS * (up + 1))
                out += [(tree, width, True, level + up, start + i, run) for i, run in enumerate(runs_of(nodes))]
            nodes = parents(nodes)
        out.append((tree, width, False, level + levels, first // CHUNK, nodes[0]))
        names = ["tree", "width", "is_run", "level", "place", "nodes"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.string()]
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names)

    return build


def expander(columns: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """All proofs of a chunk's leaves, from the leaves themselves and the runs that were fetched for them."""

    def expand(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        own, nodes = [], rows["leaf"].to_pylist()
        for _ in range(levels_below(rows["width"][0].as_py()) if nodes else 0):
            own.append(runs_of(nodes))
            nodes = parents(nodes)
        fetched = fetched.sort_by([("of_top", "ascending"), ("level", "ascending")])
        above_at = fetched["at"].to_pylist()
        above = [without(run, at) for run, at in zip(fetched["nodes"].to_pylist(), above_at)]
        places, siblings = [], []
        for i in range(len(rows)):
            at = [(i >> (BITS * k)) & (ARITY - 1) for k in range(len(own))]
            places.append(at + above_at)
            siblings.append([without(runs[i >> (BITS * (k + 1))], at[k]) for k, runs in enumerate(own)] + above)
        proofs = [pa.array(places, pa.list_(pa.int32())), pa.array(siblings, pa.list_(pa.string()))]
        return pa.table([*(rows[c] for c in columns), *proofs], [*columns, "places", "siblings"])

    return expand


# Over the tables ------------------------------------------------------------------


def with_places(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Add ``place``, from 0 within the ``tree`` in the given order, and ``width``, how many the tree has.

    Rows are range-partitioned by (tree, order), so that a tree of any size is
    spread, and stored, because range bounds are sampled.  A count per
    (tree, partition), summed up over a tree's partitions, tells where each starts.
    """
    slot = F.col("__slot")
    stored = write_shared(
        rows.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("__slot", F.monotonically_increasing_id()),
        f"{label}-sorted",
    ).withColumn("__part", F.shiftright(slot, 33))
    whole = Window.partitionBy("__tree")
    starts = write_shared(
        stored.groupBy(F.col("tree").alias("__tree"), F.col("__part").alias("__in"))
        .agg(F.count("*").alias("__n"), F.min("__slot").alias("__first"))
        .select(
            "__tree",
            "__in",
            (F.sum("__n").over(whole.orderBy("__in")) - F.col("__n") - F.col("__first")).alias("__start"),
            F.sum("__n").over(whole).alias("width"),
        ),
        f"{label}-starts",
    )
    same = (F.col("tree") == F.col("__tree")) & (F.col("__part") == F.col("__in"))
    return (
        stored.join(F.broadcast(starts) if small(starts, 128) else starts, same)
        .withColumn("place", F.col("__start") + slot)
        .drop("__slot", "__part", "__tree", "__in", "__start")
    )


def build_trees(leaves: DataFrame, with_leaf_runs: bool, label: str) -> tuple[DataFrame, DataFrame]:
    """Roots (tree, width, nodes) and stored runs (tree, level, place, nodes) of all trees over (tree, place, width, digest).

    A pass turns every 4,096 nodes of a level into one, three levels up, each
    chunk a group of its own, so neither a tree nor a level lies in one task.
    The runs of the leaves' own chunks are left out unless ``with_leaf_runs``.
    """
    highest = leaves.agg(F.max("width")).first()[0] or 0
    roots, runs, level, nodes = [], [], 0, leaves.select("tree", "place", "width", "digest")
    while True:
        at = F.floor(F.col("place") / CHUNK).alias("chunk")
        build = chunk_builder(level, with_leaf_runs or level > 0)
        made = write_shared(nodes.groupBy("tree", at).applyInArrow(build, NODES), f"{label}-nodes")
        above = made.filter("NOT is_run")
        roots.append(above.filter(F.col("width") <= CHUNK).select("tree", "nodes"))
        runs.append(made.filter("is_run").select("tree", "level", "place", "nodes"))
        if highest <= CHUNK:
            return reduce(DataFrame.union, roots), reduce(DataFrame.union, runs)
        highest, level = -(-highest // CHUNK), level + LOCAL_LEVELS
        width = F.ceil(F.col("width") / CHUNK).alias("width")
        nodes = above.filter(F.col("width") > CHUNK).select("tree", "place", width, F.col("nodes").alias("digest"))


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame  # tree, place, width (leaves of the tree), leaf, and the columns given along
    subroots: DataFrame  # tree, subroot, place and width among the trees
    runs: DataFrame  # of the trees, from the level of the leaves' chunks on
    top_runs: DataFrame  # of the tree over the subroots
    root: str | None  # None of an empty table


def build_manifest(leaves: DataFrame, order: Sequence[str]) -> Manifest:
    """The trees over ``leaves`` (tree, leaf, ...), which ascend by ``order`` within a tree."""
    placed = write_shared(with_places(leaves, order, "manifest"), "manifest-leaves")
    subroots, runs = build_trees(placed.withColumnRenamed("leaf", "digest"), False, "manifest")
    one = F.lit("").alias("tree")
    sorted_roots = with_places(
        subroots.select(one, F.col("tree").alias("of"), F.col("nodes").alias("digest")), ["of"], "manifest-top"
    )
    sorted_roots = write_shared(sorted_roots, "manifest-roots")
    top, top_runs = build_trees(sorted_roots, True, "manifest-top")
    root = top.first()
    told = sorted_roots.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "place", "width")
    return Manifest(placed, told, runs, top_runs, root and root["nodes"])


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf with ``subroot``, ``root`` and its proof: ``places`` and ``siblings`` per level, up to the root.

    Leaf partitions are the chunks of 4,096 neighbouring leaves.  For each the
    least union of missing runs is worked out (:func:`missing`) and fetched once,
    in one join with the stored runs; what lies inside the chunk is derived from
    its leaves, and the proofs of all of them are expanded there.
    """
    chunk = F.shiftright("place", BITS * LOCAL_LEVELS).alias("chunk")
    leaves = manifest.leaves.withColumn("chunk", chunk)
    # A chunk's first leaf stands for it.
    chunks = leaves.filter(F.col("place") % CHUNK == 0).select("tree", "chunk", "width")
    inside = chunks.select(
        "tree", "chunk", F.explode(missing(F.col("chunk"), LOCAL_LEVELS, height(F.col("width")))).alias("at")
    ).select("tree", "chunk", "at.*")
    over = manifest.subroots.select(
        "tree", F.explode(missing(F.col("place"), 0, height(F.col("width")))).alias("at")
    ).select("tree", "at.*")

    def fetch(wanted: DataFrame, runs: DataFrame, on: Column, *names: str) -> DataFrame:
        held = runs.select(F.col("tree").alias("__tree"), F.col("level").alias("__level"), F.col("place").alias("__run"), "nodes")
        same = on & (F.col("level") == F.col("__level")) & (F.col("run") == F.col("__run"))
        return wanted.join(held, same).select(*names, "level", "at", "nodes")

    of_top = F.lit(True).alias("of_top")
    above = fetch(over, manifest.top_runs, F.lit(True), "tree")
    above = chunks.select("tree", "chunk").join(above, "tree").select("tree", "chunk", of_top, "level", "at", "nodes")
    below = fetch(inside, manifest.runs, F.col("tree") == F.col("__tree"), "tree", "chunk")
    fetched = below.select("tree", "chunk", ~of_top, "level", "at", "nodes").toDF(*above.columns).union(above)

    columns = [c for c in leaves.columns if c != "chunk"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema if f.name != "chunk")
    proved = (
        leaves.groupBy("tree", "chunk")
        .cogroup(fetched.groupBy("tree", "chunk"))
        .applyInArrow(expander(columns), f"{schema}, places array<int>, siblings array<string>")
    )
    subroots = manifest.subroots.select("tree", "subroot")
    subroots = F.broadcast(subroots) if small(subroots, 256) else subroots
    return proved.join(subroots, "tree").withColumn("root", F.lit(manifest.root))


def tree_of(group: Column) -> Column:
    """A name per group that sorts as the groups do, NULL first, and is never NULL."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def prove_documents(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    changed: Callable[[dict[str, Column]], tuple[Column, dict[str, Column]]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: order, tree, leaf, subroot, root, places, siblings and, of changed rows, changed_leaf.

    Leaves of a group ascend by ``order``, NULL first; rows that repeat a value
    ascend by their hashes, and rows alike in all fields, whose leaves are equal,
    stand side by side.  A NULL field is hashed as ``-``, an empty one as ``0:``.
    A NULL group is a source of its own, ahead of all others; texts may be of any
    length; columns that are not named are not looked at.  An empty table gives no
    rows.  ``changed`` tells which rows are changed and by what their fields are
    replaced, from the fields' columns; ``changed_leaf`` is then the hash of the
    changed row, whose proof is still that of the row as it was.
    """
    held = {name: F.col(f"`{name}`") for name in fields}
    change, replaced = changed(held) if changed else (F.lit(False), {})
    leaves = docs.select(
        F.col(f"`{order}`").alias("order"),
        tree_of(F.col(f"`{group}`")).alias("tree"),
        leaf_hash(*held.values()).alias("leaf"),
        F.when(change, leaf_hash(*(replaced.get(n, c) for n, c in held.items()))).alias("changed_leaf"),
    ).withColumn(ROW, F.monotonically_increasing_id())
    # Equal rows in any number have different numbers, so no range holds more of them than others.
    stored = write_shared(leaves, "manifest-hashed")
    return prove(build_manifest(stored, ["order", "leaf", ROW])).drop(ROW, "place", "width")
