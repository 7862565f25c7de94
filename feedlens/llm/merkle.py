"""A Merkle manifest of a table as a persistent, path-copying tree.

Every row is a leaf. Per ``lang`` the leaves ascend by doc_id, and every ``FANOUT`` consecutive nodes become one, until
one is left, the lang's subroot; the subroots, ordered by lang, become the root the same way.

The tree is built in aligned blocks of ``FANOUT ** STEPS`` nodes: a block's nodes lie below one common ancestor, so a
task works on it alone, and only the blocks' roots go on to the next tier, which is cut into blocks in turn until each
lang has a single block. Nothing but digests is shuffled, and no group exceeds a block.

A version of the tree is a changed leaf: it copies the ancestors of that leaf, within its block and then, tier by
tier, above it, and shares all other nodes with the original tree. Its copied nodes hash the original siblings, which
a block's descent hands down once for all its leaves, so a version costs a path, not a tree.

Defined results: a NULL cell is hashed as ``-``, an empty text as ``0:``; the NULL lang is a lang, first in order;
rows without a doc_id come first in their lang; repeated rows of a doc_id are leaves of their own, ordered by leaf
digest; a version whose text holds no capitals changes nothing and is verified; an empty table has no leaves and gives no rows;
very long texts are hashed whole where they are read; other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.shipping import ship_package
from feedlens.operators.ranking import with_positions
from feedlens.session import written_table

#: Children of a node, and levels in a block.
FANOUT, STEPS = 8, 3
#: Versions are made of the documents whose crc32 this divides.
TAMPERED = 3

Path = list[tuple[str, str]]


# --- one block

def node(digests: str) -> str:
    return hashlib.sha256(digests.encode()).hexdigest()


def block_levels(digests: list[str], steps: int | None) -> list[list[str]]:
    """A block's nodes level by level, ``steps`` levels up, or (None) until one is left."""
    levels = [digests]
    while len(levels) <= steps if steps is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([node("".join(below[at:at + FANOUT])) for at in range(0, len(below), FANOUT)])
    return levels


def sibling_path(levels: list[list[str]], place: int) -> Path:
    """The siblings (those before, those after) of a block's node on each level below its root."""
    path = []
    for level in levels[:-1]:
        start = place - place % FANOUT
        path.append(("".join(level[start:place]), "".join(level[place + 1:start + FANOUT])))
        place = start // FANOUT
    return path


def copied_path(leaf: str, path: Path) -> list[str]:
    """The nodes that a version with this leaf copies: its ancestors, lowest first."""
    copies = []
    for before, after in path:
        leaf = node(before + leaf + after)
        copies.append(leaf)
    return copies


def proof_digest(path: Path) -> str:
    return node("".join(before + after for before, after in path))


def _levels(row: dict, steps: int) -> list[list[str]]:
    """Later blocks and full ones rise by ``steps`` levels; a first block that is not full is its lang's last tier."""
    digests = [member["digest"].hex() for member in row["members"]]
    return block_levels(digests, None if row["block"] == 0 and len(digests) < FANOUT**steps else steps)


# --- tiers of blocks

_ABOVE = "array<struct<before: string, after: string>>"
_HANDED = f"part string, block long, subroot string, above {_ABOVE}"
_HANDED_SCHEMA = pa.schema([
    ("part", pa.string()), ("block", pa.int64()), ("subroot", pa.string()),
    ("above", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
])


def _block_roots(steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict({
                "part": batch.column("part"), "block": batch.column("block"),
                "size": pa.array([len(row["members"]) for row in rows], pa.int32()),
                "root": pa.array([bytes.fromhex(_levels(row, steps)[-1][0]) for row in rows], pa.binary()),
            })

    return run


def _tiers(nodes: DataFrame, steps: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks (``part, block, members``) above ``part, position, digest, changed, doc_id``, and ``part, root`` of every part."""
    tiers, finished = [], None
    doc_type = nodes.schema["doc_id"].dataType.simpleString()
    block = FANOUT**steps
    while True:
        member = F.struct((F.col("position") % block).cast("int").alias("place"), "digest", "changed", "doc_id")
        blocks = written_table(
            nodes.groupBy("part", F.expr(f"position div {block}").alias("block"))
            .agg(F.sort_array(F.collect_list(member)).alias("members")),
            "merkle-blocks",
        )
        tiers.append(blocks)
        roots = written_table(blocks.mapInArrow(_block_roots(steps), "part string, block long, size int, root binary"), "merkle-roots")
        last = (F.col("block") == 0) & (F.col("size") < block)
        done = roots.where(last).select("part", "root")
        finished = done if finished is None else finished.unionByName(done)
        nodes = roots.where(~last).select(
            "part", F.col("block").alias("position"), F.col("root").alias("digest"),
            F.lit(None).cast("binary").alias("changed"), F.lit(None).cast(doc_type).alias("doc_id"),
        )
        if nodes.isEmpty():
            return tiers, finished


def _hand_down(steps: int, of_lang: bool):
    """``part, block, subroot, above`` of what each member of a block is the root of: siblings in the block, then those above it.

    Members are blocks of the tier below, or (``of_lang``) the langs themselves, named by their ``doc_id``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                levels = _levels(row, steps)
                for member in row["members"]:
                    path = sibling_path(levels, member["place"])
                    rows.append({
                        "part": member["doc_id"] if of_lang else row["part"],
                        "block": 0 if of_lang else row["block"] * FANOUT**steps + member["place"],
                        "subroot": member["digest"].hex() if of_lang else row["subroot"],
                        "above": [{"before": before, "after": after} for before, after in path] + row["above"],
                    })
            yield pa.RecordBatch.from_pylist(rows, _HANDED_SCHEMA)

    return run


_LEAF_ROW = (
    "doc_id {doc_type}, part string, position long, leaf string, changed_leaf string, subroot string, proof_sha256 string, "
    "copied array<string>"
)


def _leaf_rows(steps: int):
    """Leaves with their proof and, for changed ones, the nodes their version copies; for the others the nodes recomputed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_type = batch.schema.field("members").type.value_type.field("doc_id").type
            rows = []
            for row in batch.to_pylist():
                levels = _levels(row, steps)
                above = [(step["before"], step["after"]) for step in row["above"]]
                for member in row["members"]:
                    path = sibling_path(levels, member["place"]) + above
                    leaf = member["digest"].hex()
                    changed = member["changed"].hex() if member["changed"] is not None else None
                    rows.append({
                        "doc_id": member["doc_id"], "part": row["part"], "position": row["block"] * FANOUT**steps + member["place"],
                        "leaf": leaf, "changed_leaf": changed, "subroot": row["subroot"], "proof_sha256": proof_digest(path),
                        "copied": copied_path(changed or leaf, path),
                    })
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("doc_id", doc_type), ("part", pa.string()), ("position", pa.int64()), ("leaf", pa.string()), ("changed_leaf", pa.string()),
                ("subroot", pa.string()), ("proof_sha256", pa.string()), ("copied", pa.list_(pa.string())),
            ]))

    return run


def _descend(tiers: list[DataFrame], tops: DataFrame, steps: int) -> DataFrame:
    """The lowest tier's blocks with ``subroot, above``, from ``part, block, subroot, above`` of every part's last block."""
    handed = None
    for number in range(len(tiers) - 1, -1, -1):
        # A part's last block takes the part's own path, every other block the one handed down by the tier above.
        last = (F.col("block") == 0) & (F.size("members") < FANOUT**steps)
        known = tiers[number].where(last).join(tops, ["part", "block"])
        if handed is not None:
            known = known.unionByName(tiers[number].where(~last).join(handed, ["part", "block"]))
        if number:
            handed = written_table(known.mapInArrow(_hand_down(steps, False), _HANDED), "merkle-paths")
    return known


# --- leaves

def _cell(value: Column) -> Column:
    """A cell as hashed: its length in bytes and itself, or ``-``."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    cells = [_cell(F.col("doc_id")), _cell(F.col("source")), _cell(F.col("lang")), _cell(F.col("n_chars")), _cell(text)]
    return F.unhex(F.sha2(F.concat(*cells).cast("binary"), 256))


def tampered_text(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def is_tampered() -> Column:
    """Rows without a doc_id are not tampered with."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))


def versions(
    documents: DataFrame, changed_text: Column | None = None, changes: Column | None = None, steps: int = STEPS
) -> DataFrame:
    """``doc_id, part, position, leaf, changed_leaf, subroot, root, proof_sha256, copied`` of every document.

    ``changes`` chooses the documents that get a version, ``changed_text`` is their text in it. ``copied`` are the
    digests of the version's copied nodes from the leaf's parent up to the version's root; for documents without a
    version, the same path recomputed from the leaf. ``position`` is the leaf's place in its lang, from 0. Blocks have ``steps`` levels.
    """
    ship_package(documents.sparkSession)
    changed_text = tampered_text(F.col("text")) if changed_text is None else changed_text
    changes = is_tampered() if changes is None else changes
    # NULL before all others, in bytewise order.
    part = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))
    leaves = written_table(
        documents.select(
            "doc_id", part.alias("part"), leaf_digest(F.col("text")).alias("digest"),
            F.when(changes, leaf_digest(changed_text)).alias("changed"),
        ),
        "merkle-leaves",
    )
    placed = with_positions(leaves, ["part"], [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    tiers, subroots = _tiers(placed.withColumn("position", F.col("position") - 1), steps)

    # The tree of the langs: the same, with the subroots as leaves.
    of_lang = written_table(subroots, "merkle-subroots").select(
        F.lit("").alias("part"), F.col("root").alias("digest"), F.lit(None).cast("binary").alias("changed"), F.col("part").alias("doc_id")
    )
    of_lang = with_positions(of_lang, ["part"], [F.col("doc_id")])
    upper, tops = _tiers(of_lang.withColumn("position", F.col("position") - 1), steps)
    top = tops.first()  # at most one row
    root = F.lit(top["root"].hex() if top else None).cast("string")
    own = tops.select("part", F.lit(0).cast("long").alias("block"), root.alias("subroot"), F.array().cast(_ABOVE).alias("above"))
    langs = written_table(_descend(upper, own, steps).mapInArrow(_hand_down(steps, True), _HANDED), "merkle-langs")

    doc_type = documents.schema["doc_id"].dataType.simpleString()
    blocks = _descend(tiers, langs, steps)
    return blocks.mapInArrow(_leaf_rows(steps), _LEAF_ROW.format(doc_type=doc_type)).withColumn("root", root)


def manifest_report(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    folded = F.coalesce(F.try_element_at("copied", F.lit(-1)), F.coalesce("changed_leaf", "leaf"))
    return versions(documents).withColumn("folded_root", folded).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
