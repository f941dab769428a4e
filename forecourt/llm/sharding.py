"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks in a region and shards in a rack, each with a weight;
an inner node weighs what its shards weigh.  A row descends from the root: at
every level each child draws ``-ln(u) / weight`` with ``u`` in (0, 1) hashed from
(child's name, key), and the smallest draw wins, so a child gets rows in
proportion to its weight and a draw depends on no other child.  When the weight
of a child changes, rows move only into it or out of it; below the others nothing
moves.  A shard added as a region of its own therefore takes rows only into itself.

Everything is DataFrame expressions; no row is compared with another one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: (region, [(rack, [(shard number, weight), ...]), ...])
Tree = list[tuple[str, list[tuple[str, list[tuple[int, float]]]]]]

#: Rows that one numbering group should have at most.
SLOT_GROUP_ROWS = 20_000


def even_tree(shards: int = 8, shards_per_rack: int = 2, racks_per_region: int = 2) -> Tree:
    """Shards of weight 1 in racks, racks in regions, filled in order."""
    racks = [(f"rack{i}", [(s, 1.0) for s in range(i * shards_per_rack, min(shards, (i + 1) * shards_per_rack))])
             for i in range(-(-shards // shards_per_rack))]
    return [(f"region{i}", racks[i * racks_per_region:(i + 1) * racks_per_region])
            for i in range(-(-len(racks) // racks_per_region))]


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, as a region of its own: no older node changes its weight."""
    new = 1 + max(s for _, racks in tree for _, shards in racks for s, _ in shards)
    return [*tree, (f"region{len(tree)}", [("rack0", [(new, weight)])])]


def _weight(racks) -> float:
    return sum(w for _, shards in racks for _, w in shards)


def _draw(key, children: list[tuple[str, float]]):
    """Index of the child that wins the draw (first one, should two draws be equal)."""
    if len(children) == 1:
        return F.lit(0)
    draws = []
    for i, (name, weight) in enumerate(children):
        bits = F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(name + "|"), key)), 11)
        draws.append(F.struct((-F.log((bits.cast("double") + 0.5) / F.lit(float(2 ** 53))) / weight).alias("d"),
                              F.lit(i).alias("i")))
    return F.array_min(F.array(*draws))["i"]


def shard_of(key, tree: Tree):
    """Shard number of a string key column, by descent through the tree."""
    region = _draw(key, [(r, _weight(racks)) for r, racks in tree])
    by_region = []
    for r, racks in tree:
        rack = _draw(key, [(f"{r}/{k}", sum(w for _, w in shards)) for k, shards in racks])
        by_rack = []
        for k, shards in racks:
            leaf = _draw(key, [(f"{r}/{k}/{s}", w) for s, w in shards])
            by_rack.append(F.element_at(F.array(*[F.lit(s) for s, _ in shards]), leaf + 1))
        by_region.append(_pick(rack, by_rack))
    return _pick(region, by_region)


def _pick(index, values):
    return reduce(lambda rest, iv: F.when(index == iv[0], iv[1]).otherwise(rest),
                  list(enumerate(values))[-2::-1], values[-1])


def with_shard(df: DataFrame, key_col: str, tree: Tree, out: str = "shard") -> DataFrame:
    """Adds the shard of each row.  A null key counts as the empty string; equal
    keys meet in one shard; an empty table stays empty."""
    return df.withColumn(out, shard_of(F.coalesce(F.col(key_col).cast("string"), F.lit("")), tree))


def with_slot(df: DataFrame, key_col: str, tie_cols: list[str], shard_col: str = "shard", out: str = "slot",
              groups_per_shard: int | None = None) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps.

    Rows are numbered in groups that a hash of the key makes, and a group starts
    where the counts of the groups before it end, so no task holds a whole shard.
    The counts read the key column alone.  Rows equal in key and ties are
    interchangeable.
    """
    if groups_per_shard is None:
        groups_per_shard = max(32, -(-df.select(key_col).count() // SLOT_GROUP_ROWS))
    g, n = "_slot_group", "_slot_start"
    grouped = df.withColumn(g, F.pmod(F.xxhash64(F.lit("slot"), F.col(key_col)), F.lit(groups_per_shard)))
    counts = grouped.groupBy(shard_col, g).agg(F.count("*").alias(n))
    before = W.partitionBy(shard_col).orderBy(g).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn(n, F.coalesce(F.sum(n).over(before), F.lit(0)))
    order = W.partitionBy(shard_col, g).orderBy(key_col, *tie_cols)
    return (grouped.join(starts, [shard_col, g])
            .withColumn(out, (F.col(n) + F.row_number().over(order) - 1).cast("long"))
            .drop(g, n))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Every row of (doc_id, text) with its size (UTF-8 bytes and one), checksum,
    shard, slot, and the shard it has when there is one shard more.

    Null text: size 1, checksum 0.  Null doc_id: the empty key.  Rows that repeat
    a doc_id share its shard and get slots of their own.  Other columns are ignored."""
    tree = even_tree(shards)
    sized = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    placed = with_shard(with_shard(sized, "doc_id", tree), "doc_id", grown(tree), "grown_shard")
    return with_slot(placed, "doc_id", ["text_crc32", "size"])
