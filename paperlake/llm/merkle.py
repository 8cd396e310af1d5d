"""A Merkle manifest of a table, its nodes labelled by the leaf ranks they cover.

Leaves are ranked within their language. A node carries the interval of ranks it
covers, so it is an ancestor of what its interval contains, and what a parent's
interval has besides the node's own is the sibling's. Ten levels at a time form a
tier of buckets of at most 1,024 nodes, so a tree of n leaves has log1024(n) tiers.
Going down again, the members of a bucket get the path of the node that contains
them by a join on bucket and interval.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.session import materialize

# Levels of a tier; a bucket has at most 2 ** bits members.
BUCKET_BITS = 10
# Documents whose crc32 this divides are tampered with in the manifest's check.
TAMPER_MODULUS = 7

LEFT, RIGHT, ALONE = "L", "R", "-"

_MEMBER = "rank long, lo long, hi long, digest string, doc_id long, shown string, name string"
_TOPS = "tree string, n long, rank long, lo long, hi long, digest string"
_MEMBERS_ABOVE = f"{_MEMBER}, path array<string>, subroot string, root string"
_MEMBER_COLUMNS = [field.split()[0] for field in _MEMBER.split(", ")]
_ABOVE_COLUMNS = ["tree", "rank", "lo", "hi", "path", "subroot", "root"]


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def labelled(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digests(documents: DataFrame) -> DataFrame:
    """``doc_id, tree, digest, shown``; ``shown`` is the digest after tampering, null where nothing changes.

    The tree is the language's, ``-`` for null and ``=`` before a name, which sorts as the manifest does.
    """
    chars = F.col("n_chars").cast("decimal(20,0)")
    touched = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(TAMPER_MODULUS)) == 0) & chars.isNotNull()

    def leaf(n_chars: Column) -> Column:
        values = (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
        return digest(*map(labelled, values))

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        leaf(chars).alias("digest"),
        F.when(touched, leaf(chars + 1)).alias("shown"),
    )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` from 0 within ``tree`` and the tree's size ``n``.

    Rows are sorted over all tasks, so that a tree with most of the rows is split by
    range, also where its keys are equal. Each task's share of each tree is counted, and
    the shares before it are added up; that table has a row per task and tree.
    """
    ties = [*order, "_at"]
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange("tree", *ties)
    dealt = dealt.sortWithinPartitions("tree", *ties).drop("_at")
    placed = materialize(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_task", F.shiftright("_place", 33))
    shares = placed.groupBy("tree", "_task").agg(F.min("_place").alias("_first"), F.count("*").alias("_count"))
    before = Window.partitionBy("tree").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "tree",
        "_task",
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(Window.partitionBy("tree")).alias("n"),
    )
    # Written first, so that Spark knows its size.
    shares = materialize(shares, "rank-shares")
    found = placed.join(shares, ["tree", "_task"]).withColumn("rank", F.col("_place") + F.col("_shift"))
    return found.drop("_task", "_place", "_shift")


def _levels(members: int, whole_tree: int, bits: int) -> int:
    """Levels above a bucket's members: all of a tier, or what the tree's only bucket needs."""
    return bits if whole_tree > 1 << bits else max(members - 1, 0).bit_length()


def _labelled_nodes(lows: list[int], highs: list[int], digests: list[str], levels: int) -> list[dict]:
    """Per level from the members up, the digest of each interval; two consecutive nodes make one."""
    nodes = list(zip(lows, highs, digests))
    found = [{(lo, hi): node for lo, hi, node in nodes}]
    for _ in range(levels):
        runs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
        nodes = [
            (run[0][0], run[-1][1], hashlib.sha256("".join(n[2] for n in run).encode()).hexdigest()) for run in runs
        ]
        found.append({(lo, hi): node for lo, hi, node in nodes})
    return found


def _paths(levels: list[dict]) -> dict[tuple[int, int], list[str]]:
    """Per member the siblings on the way to the bucket's top: what the parent's interval has besides the node's."""
    paths: dict[tuple[int, int], list[str]] = {top: [] for top in levels[-1]}
    for nodes, parents in zip(reversed(levels[:-1]), reversed(levels[1:])):
        below = {}
        around = iter(parents)
        parent = next(around)
        for lo, hi in nodes:
            while hi > parent[1]:
                parent = next(around)
            if lo > parent[0]:
                step = LEFT + nodes[parent[0], lo]
            elif hi < parent[1]:
                step = RIGHT + nodes[hi, parent[1]]
            else:
                step = ALONE
            below[lo, hi] = [step, *paths[parent]]
        paths = below
    return paths


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict[str, list]]]:
    """Each bucket's own columns and its members, column by column."""
    for batch in batches:
        others = batch.drop_columns(["members"]).to_pylist()
        members = batch.column("members")
        fields = members.type.value_type
        for own, value in zip(others, members):
            structs = value.values
            yield own, {fields.field(i).name: structs.field(i).to_pylist() for i in range(fields.num_fields)}


def _tier(nodes: DataFrame, bits: int) -> DataFrame:
    """Nodes (tree, n and the member columns) in buckets of consecutive ranks: ``tree, n, bucket, members``."""
    bucket = F.shiftright("rank", bits).alias("bucket")
    members = F.array_sort(F.collect_list(F.struct(*_MEMBER_COLUMNS))).alias("members")
    return nodes.groupBy("tree", "n", bucket).agg(members)


def _tops(tier: DataFrame, bits: int) -> DataFrame:
    """The node over each bucket."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, m in _buckets(batches):
            levels = _labelled_nodes(m["lo"], m["hi"], m["digest"], _levels(len(m["lo"]), own["n"], bits))
            (((lo, hi), node),) = levels[-1].items()
            buckets = -(-own["n"] // (1 << bits))
            values = [own["tree"], buckets, own["bucket"], lo, hi, node]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], tops)

    tops = [field.split()[0] for field in _TOPS.split(", ")]
    return tier.mapInArrow(top, _TOPS)


def _members(rows: DataFrame) -> DataFrame:
    """Rows of tree, n, rank and digest with all member columns; a leaf covers its own rank."""
    own = {"lo": F.col("rank"), "hi": F.col("rank") + 1}
    empty = {c: F.lit(None).cast(kind) for c, kind in (("doc_id", "long"), ("shown", "string"), ("name", "string"))}
    return rows.withColumns({c: value for c, value in (own | empty).items() if c not in rows.columns})


def _tiers(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers from the leaves up, and the top of each tree."""
    tiers = []
    while True:
        tiers.append(materialize(_tier(nodes, bits), "merkle-tier"))
        tops = _tops(tiers[-1], bits)
        most = tiers[-1].agg(F.max("n")).first()[0]
        if most is None or most <= 1 << bits:
            return tiers, tops
        nodes = _members(tops)


def _attached(tiers: list[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    """The leaves of all trees with their paths, down from ``above``, the path of each tree's top."""

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, m in _buckets(batches):
            paths = _paths(_labelled_nodes(m["lo"], m["hi"], m["digest"], _levels(len(m["lo"]), own["n"], bits)))
            whole = [[*paths[label], *own["path"]] for label in zip(m["lo"], m["hi"])]
            columns = [pa.array([own["tree"]] * len(whole), pa.string())]
            columns += [pa.array(m[c], pa.int64() if c in ("rank", "lo", "hi", "doc_id") else pa.string()) for c in _MEMBER_COLUMNS]
            columns.append(pa.array(whole, pa.list_(pa.string())))
            columns += [pa.array([own[c]] * len(whole), pa.string()) for c in ("subroot", "root")]
            yield pa.RecordBatch.from_arrays(columns, ["tree", *_MEMBER_COLUMNS, "path", "subroot", "root"])

    for tier in reversed(tiers):
        over = above.select(*_ABOVE_COLUMNS).toDF("tree", "bucket", "over_lo", "over_hi", "path", "subroot", "root")
        first, last = F.element_at("members", 1), F.element_at("members", -1)
        contained = (first["lo"] >= F.col("over_lo")) & (last["hi"] <= F.col("over_hi"))
        found = tier.join(over, ["tree", "bucket"]).filter(contained).drop("over_lo", "over_hi")
        above = found.mapInArrow(attach, f"tree string, {_MEMBERS_ABOVE}")
    return above


def manifest(documents: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """``doc_id, leaf, shown, subroot, root, proof`` for every row of ``documents``.

    Columns read: doc_id, source, lang, n_chars, text. ``proof`` has an entry per level from
    the leaf to the root: ``L`` or ``R`` and the digest of the sibling on that side, or ``-``
    where the node is alone. ``shown`` is the leaf as found when checking, null if intact.

    Rows with a null language form a tree of their own, which comes first; a null doc_id
    comes before others; equal doc_ids are ordered by their leaves. Nulls, empty and very
    long texts are labelled values like others; other columns are ignored. An empty table
    has no rows and no root.
    """
    leaves = materialize(leaf_digests(documents), "merkle-leaves")
    tiers, subroots = _tiers(_members(ranked(leaves, ["doc_id", "digest"])), bits)
    subroots = materialize(subroots, "merkle-subroots")

    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    over, root = _tiers(_members(ranked(named, ["name"])), bits)
    no_path, no_subroot = F.array().cast("array<string>"), F.lit(None).cast("string")
    top = root.withColumns({"path": no_path, "subroot": no_subroot, "root": F.col("digest")})
    found = _attached(over, top, bits).select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    above = materialize(found.join(subroots.select("tree", "rank", "lo", "hi"), "tree"), "merkle-above")
    rows = _attached(tiers, above, bits)
    return rows.select("doc_id", F.col("digest").alias("leaf"), "shown", "subroot", "root", F.col("path").alias("proof"))


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's siblings, from the leaf's up."""
    siblings = F.filter(proof, lambda step: step != ALONE)
    return F.sha2(F.array_join(F.transform(siblings, lambda step: F.substring(step, 2, 64)), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""

    def up(node: Column, step: Column) -> Column:
        side, sibling = F.substring(step, 1, 1), F.substring(step, 2, 64)
        both = F.when(side == LEFT, F.concat(sibling, node)).when(side == RIGHT, F.concat(node, sibling))
        return F.sha2(both.otherwise(node), 256)

    return F.aggregate(proof, leaf, up)


def verified(manifest_rows: DataFrame) -> DataFrame:
    """Adds ``proof_sha256``, ``folded_root`` of the leaf as found, and ``verified``: whether that is the root."""
    found = manifest_rows.withColumns(
        {
            "proof_sha256": proof_digest(F.col("proof")),
            "folded_root": folded(F.coalesce("shown", "leaf"), F.col("proof")),
        }
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
