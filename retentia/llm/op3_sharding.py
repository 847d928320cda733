"""Operator 3, sharding: hierarchical weighted hash tree.

A topology is a tree of regions, racks and shards with a weight on every shard; the weight of an inner node is the
sum below it. A key descends the tree: on every level each child gets a draw -ln(u) / weight, where u in (0, 1) is a
hash of the key and of the child's own name, and the smallest draw wins. A child's draw depends on nothing but the key
and that child's weight, so after a weight change

* rows move only into subtrees whose weight grew, or out of subtrees whose weight shrank, never between two
  subtrees that kept their weights;
* a new region takes rows only into itself. ``with_extra_shard`` therefore opens a region with one rack and one shard.

Placement is a pure expression (no shuffle). Only the numbering inside the shards moves rows, and then ids and sizes
only, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import gapless_rank, salts_for, table


@dataclass(frozen=True)
class Node:
    """A leaf has a shard number and a weight; an inner node has children."""
    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def topology(regions: Sequence[Sequence[Sequence[float]]]) -> Node:
    """Tree from nested weights: ``regions[r][k]`` holds the shard weights of rack k of region r, shards numbered in order."""
    number = 0
    tops = []
    for r, racks in enumerate(regions):
        rack_nodes = []
        for k, weights in enumerate(racks):
            leaves = []
            for w in weights:
                if w < 0:
                    raise ValueError("weights must not be negative")
                leaves.append(Node(f"region{r}/rack{k}/shard{number}", shard=number, own_weight=float(w)))
                number += 1
            rack_nodes.append(Node(f"region{r}/rack{k}", tuple(leaves)))
        tops.append(Node(f"region{r}", tuple(rack_nodes)))
    tree = Node("", tuple(tops))
    if not tree.weight > 0:
        raise ValueError("a topology needs a shard of positive weight")
    return tree


def shard_numbers(node: Node) -> list[int]:
    return [node.shard] if not node.children else [s for c in node.children for s in shard_numbers(c)]


def with_extra_shard(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own: existing regions keep their weights and their rows."""
    r, shard = len(tree.children), max(shard_numbers(tree)) + 1
    leaf = Node(f"region{r}/rack0/shard{shard}", shard=shard, own_weight=float(weight))
    return Node("", (*tree.children, Node(f"region{r}", (Node(f"region{r}/rack0", (leaf,)),))))


def _draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight with u = (top 53 bits of XXH64 + 1/2) / 2^53."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11).cast("double") + 0.5) * (2.0 ** -53)
    return -F.ln(u) / F.lit(node.weight)


def _descend(key: Column, node: Node) -> Column:
    if not node.children:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return _descend(key, live[0])
    best = F.least(*[F.struct(_draw(key, c).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(live)])["child"]
    chosen = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(live))):
        chosen = F.when(best == i, _descend(key, c)).otherwise(chosen)
    return chosen


def place(key: Column, tree: Node) -> Column:
    """Shard number of a key. A null key is a key like any other; equal keys share a shard."""
    return _descend(F.coalesce(key.cast("string"), F.lit("")), tree)


def shard_documents(docs: DataFrame, tree: Node, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes + 1), text_crc32, shard, slot, grown_shard (with one more shard).

    Null text counts as no bytes (size 1, CRC 0); null ids hash like the empty string; repeated rows are placed
    alike and get slots of their own; an empty table gives no rows; other columns are ignored.
    """
    key = F.col(id_col)
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(key.alias("doc_id"), (F.octet_length(raw).cast("long") + 1).alias("size"),
                       F.crc32(raw).alias("text_crc32"), place(key, tree).alias("shard"),
                       place(key, with_extra_shard(tree)).alias("grown_shard"))
    return gapless_rank(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slot", salts_for(docs.sparkSession))


#: Eight equal shards: two regions of two racks of two shards.
PRODUCTION_TREE = topology([[[1, 1], [1, 1]], [[1, 1], [1, 1]]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(table(spark, sf_dir, "documents"), PRODUCTION_TREE)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
