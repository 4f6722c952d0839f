"""Merkle manifest of a dataset: a digest tree per source, and one over the sources.

Every row is a leaf, the digest of its fields. Within a source leaves ascend by ``doc_id``;
sixteen consecutive nodes, the last run fewer, become their digest on the next level, until
one is left, the source's subroot. The subroots, by source, have a tree of their own, whose
top is the root.

A level is two window passes. Fixed-offset lag and lead columns bring the digests before and
after a node, masked by its slot in the run and by the run's length; the first node of a run
hashes itself and what follows into the parent, and all nodes of a run have their siblings.
Windows are cut at every ``BLOCK`` nodes, a multiple of sixteen, so a source that holds a
third of all rows is spread over as many tasks as it has blocks; a node's place comes from
range-partitioned numbering, without a task that sees a whole source. Proofs are put together
from the top down: a node's path is its siblings and then its parent's path, so a level meets
one row per parent.

Defined cases: a NULL field is ``-``, any other its UTF-8 byte count, ``:`` and its text; NULL
ids and NULL sources come first; rows of one id are ordered by their leaf, and equal rows are
leaves of their own; a source with one row is its own subroot, a single source its own root;
an empty table has no rows and no root; other columns are not part of a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.ordering import with_row_ids
from strata.session import cut_lineage

ARITY = 16
BLOCK = 256 * ARITY  # nodes of one window
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """A field as text that cannot run into its neighbour."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[encoded(fields[name]) for name in FIELDS]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _slot() -> Column:
    return F.pmod(F.col("pos"), F.lit(ARITY))


def _run_length() -> Column:
    return F.least(F.lit(ARITY), F.col("n") - F.col("pos") + _slot())


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the joined digests ``before`` and ``after`` each in its run."""
    window = Window.partitionBy("group", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    before = [F.when(_slot() >= j, F.lag("digest", j).over(window)) for j in range(ARITY - 1, 0, -1)]
    after = [F.when(_slot() + j < _run_length(), F.lead("digest", j).over(window)) for j in range(1, ARITY)]
    return nodes.withColumns({"before": F.concat_ws("", *before), "after": F.concat_ws("", *after)})


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of all groups that have more than one node."""
    first = with_siblings(nodes.filter("n > 1").select("group", "pos", "n", "digest")).filter(_slot() == 0)
    return first.select(
        "group", F.floor(F.col("pos") / ARITY).alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"),
        F.sha2(F.concat("digest", "after"), 256).alias("digest"))


def levels(leaves: DataFrame) -> list[DataFrame]:
    """All levels from the leaves (``group, pos, n, digest``) up; a group ends where ``n`` is 1."""
    largest = leaves.agg(F.max("n")).first()[0] or 1
    out = [leaves]
    while largest > 1:
        out.append(cut_lineage(parents(out[-1]), "merkle-level"))
        largest = -(-largest // ARITY)
    return out


def tops(tree: list[DataFrame]) -> DataFrame:
    """``group, digest`` of every group's last node."""
    found = [nodes.filter("n = 1").select("group", "digest") for nodes in tree]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_paths(tree: list[DataFrame], top: DataFrame) -> DataFrame:
    """The leaves with ``path array<struct<before, after>>`` from their own level up, and all
    columns of ``top`` (``group, path, ...``), whose path goes on above the group."""
    carried = [c for c in top.columns if c not in ("group", "path")]
    below = None
    for nodes in reversed(tree):
        own = [c for c in nodes.columns if c not in ("before", "after")]
        here = nodes.filter("n = 1").join(top, "group").select(*own, "path", *carried)
        if below is not None:
            up = below.select("group", F.col("pos").alias("__up"), F.col("path").alias("__path"), *carried)
            inner = with_siblings(nodes.filter("n > 1")).withColumn("__up", F.floor(F.col("pos") / ARITY))
            inner = inner.join(up, ["group", "__up"])
            step = F.array(F.struct("before", "after"))
            here = here.unionByName(inner.select(*own, F.concat(step, "__path").alias("path"), *carried))
        below = here
    return below


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, path, subroot, root`` of every row, and the columns of ``extra``, which are
    computed from the row in the one pass over the texts."""
    extra = extra or {}
    leaves = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("__id"), "doc_id", "source",
        leaf_digest({name: F.col(name) for name in FIELDS}).alias("digest"),
        *[column.alias(f"__{name}") for name, column in extra.items()]), "merkle-leaves")
    numbered = with_row_ids(leaves, ["source", "doc_id", "digest", "__id"], "row_id")
    sources = numbered.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first"))
    sources = cut_lineage(
        with_row_ids(cut_lineage(sources, "merkle-sources"), ["source"], "place"), "merkle-sources"
    ).select(F.col("source").alias("__source"), "n", "first", (F.col("place") - 1).alias("group"))
    placed = cut_lineage(numbered.join(sources, F.col("source").eqNullSafe(F.col("__source"))).select(
        "group", (F.col("row_id") - F.col("first")).alias("pos"), "n", "digest", "doc_id",
        *[f"__{name}" for name in extra]), "merkle-level")
    tree = levels(placed)
    number = tops(tree).agg(F.count(F.lit(1)).alias("n")).scalar()
    crown = levels(cut_lineage(tops(tree).select(
        F.lit(0).cast("long").alias("group"), F.col("group").alias("pos"), number.alias("n"), "digest"), "merkle-level"))
    none = F.array().cast("array<struct<before:string,after:string>>")
    root = tops(crown).select("group", none.alias("path"), F.col("digest").alias("root"))
    top = cut_lineage(with_paths(crown, root).select(
        F.col("pos").alias("group"), "path", F.col("digest").alias("subroot"), "root"), "merkle-subroots")
    return with_paths(tree, top).select(
        "doc_id", F.col("digest").alias("leaf"), "path", "subroot", "root",
        *[F.col(f"__{name}").alias(name) for name in extra])


def verified(docs: DataFrame, changed: Column) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row; where
    ``changed`` holds, the row is checked with its text in small ASCII letters."""
    fields = {name: F.col(name) for name in FIELDS}
    altered = F.when(changed, leaf_digest(fields | {"text": lower_ascii(F.col("text"))}))
    rows = manifest(docs, {"altered": altered})
    folded = fold(F.col("path"), F.coalesce("altered", "leaf"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
