"""Links between near copies found through shared keys, without ever listing all pairs of a group.

Every key (a prefix token, a band of a signature) has members. In each round one member of every key leads: the others
are compared to it, what links is joined to components, and keys whose members are all of one component are done.
When few pairs of unlike components are left, they are compared all. So each pair that shares the needed keys
is either compared or known to be connected, and a group of n copies costs about n comparisons, not n squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folioline.llm import shingles
from folioline.session import settle, ship_package

#: Rounds of leaders at most; and so many pairs for each row of the index may be left for the last step.
ROUNDS, FEW = 6, 20
#: The same if a round leaves more than this share of the pairs.
STEADY = 0.9
#: Bits of the filter that keeps rows without any candidate from being shuffled; 1 MB, whatever the data.
FILTER_BITS = 1 << 23


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges (a, b)``: the least node that it is connected with.

    Large and small stars in turn, until nothing changes. All steps are joins and minima over narrow rows; a minimum is
    combined in the tasks before the shuffle, so a node of very many edges is no matter.
    """
    now = _settled(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: each later neighbour of a node is joined to the node's least one
        large = _settled(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")
        # small star: so is each earlier one, and the node itself
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select("u", "m")).distinct()
        now = _settled(small, "edges")
        sums = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if sums == before:
            break
        before = sums
    # stars now: each node has one edge, to the least of its component
    return now.union(now.select("b", "b").distinct()).toDF("node", "component")


def _settled(df: DataFrame, purpose: str) -> DataFrame:
    """A narrow table, stored by as many tasks as there are cores: with few rows for each partition, their number is the cost."""
    return settle(df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism)), purpose)


def node_filter(nodes: DataFrame) -> bytes:
    """A bit for each ``node``, a number that is a hash itself. Set bits come to the driver in ``FILTER_BITS / 64`` rows at most."""
    place = F.pmod("node", F.lit(FILTER_BITS))
    words = nodes.select(F.shiftright(place, 6).alias("w"), F.pmod(place, F.lit(64)).cast("int").alias("i"))
    ones = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("b"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for row in ones.collect():
        bits[row["w"]] = row["b"]
    return bits.astype("<i8").tobytes()


def in_filter(bits: bytes, node: int) -> bool:
    """False if ``node`` is surely not among those of the filter."""
    place = node % FILTER_BITS
    return bits[place >> 3] >> (place & 7) & 1 == 1


SET_ROWS = "node long, items binary, sketch array<long>"


def set_rows(nodes: list[int], items: list[np.ndarray]) -> pa.RecordBatch:
    """Sets as rows of :data:`SET_ROWS`."""
    words = np.frombuffer(b"".join(shingles.odd_sketch(s) for s in items), np.int64)
    sketches = pa.ListArray.from_arrays(pa.array(np.arange(len(items) + 1, dtype=np.int32) * shingles.SKETCH), pa.array(words, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([s.tobytes() for s in items], pa.binary()), sketches], ["node", "items", "sketch"])


def _sets_of(wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, items) of ``sets`` for the ``wanted`` nodes, and for few others."""
    bits = wanted.sparkSession.sparkContext.broadcast(node_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(0).to_numpy().astype(np.int64) % FILTER_BITS
            bytes_ = np.frombuffer(bits.value, np.uint8)
            yield batch.filter(pa.array((bytes_[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))

    return sets.select("node", "items").mapInArrow(run, "node long, items binary")


def compare_sets(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, b, ca, cb)``, nodes and their components so far, plus ``linked``: whether 100 * intersection >= percent * union.

    ``sets (node, items)``: ascending 64-bit numbers as binary, one row for each node. Only those of the pairs are shuffled.
    """
    ship_package(pairs.sparkSession)
    pairs = _settled(pairs, "pairs")
    sets = _sets_of(pairs.select(F.col("a").alias("node")).distinct().union(pairs.select(F.col("b").alias("node")).distinct()), sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(4), batch.column(5)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                common = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(p) else 0
                linked.append(common > 0 and 100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(linked, pa.bool_())], ["a", "b", "ca", "cb", "linked"])

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b").select(
        "a", "b", "ca", "cb", "x", "y")
    return both.mapInArrow(run, "a long, b long, ca long, cb long, linked boolean")


def link(index: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all nodes that link with another.

    ``index (key, node)``: pairs to be compared share a key. ``sets`` as in :func:`compare_sets` with the ``sketch`` of each.
    """
    def fit(n: Column, n2: Column, sketch: Column, sketch2: Column) -> Column:
        """By size, and as members of one set only are at most (100 - percent) / (100 + percent) of all of both."""
        unlike = reduce(lambda a, b: a + b, [F.bit_count(sketch[i].bitwiseXOR(sketch2[i])) for i in range(shingles.SKETCH)])
        return (100 * F.least(n, n2) >= percent * F.greatest(n, n2)) & ((100 + percent) * unlike <= (100 - percent) * (n + n2))

    # keys with the same members say the same: of copies that share hundreds of tokens a few groups are left
    signs = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"s{k}") for k in (1, 2)]
    groups = index.groupBy("key").agg(*signs, F.count("*").alias("m"))
    unlike = _settled(groups.where("m > 1").groupBy("s1", "s2", "m").agg(F.min("key").alias("key")).select("key"), "keys")
    live = _settled(index.select("key", "node").join(unlike, "key", "left_semi").withColumn("comp", F.col("node")), "index")
    marks = _settled(sets.select("node", (F.length("items") / 8).cast("int").alias("n"), "sketch"), "marks")
    done, found, before = None, None, None
    for turn in range(ROUNDS + 1):
        groups = live.groupBy("key", "comp").count().groupBy("key").agg(
            F.count("*").alias("comps"), F.sum("count").alias("m"), F.sum(F.col("count") * F.col("count")).alias("same"))
        open_keys = _settled(groups.where("comps > 1"), "keys")
        left = open_keys.agg(F.sum((F.col("m") * F.col("m") - F.col("same")) / 2).alias("pairs"), F.sum("m").alias("rows")).first()
        if not left["rows"]:
            break
        live = live.join(open_keys.select("key"), "key", "left_semi")
        # rounds that leave nearly all pairs would go on so: what is left does not link
        last = turn == ROUNDS or left["pairs"] <= FEW * left["rows"] or (before is not None and left["pairs"] > STEADY * before)
        before = left["pairs"]
        if last:
            marked = live.join(marks, "node")
            other = marked.select("key", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("sketch").alias("sketch2"))
            met = marked.join(other, "key").where(
                (F.col("node") < F.col("node2")) & (F.col("comp") != F.col("comp2")) & fit(*[F.col(c) for c in ("n", "n2", "sketch", "sketch2")]))
        else:
            # a component drawn by lot leads, so that small ones have their turn beside one very large one
            lot = F.struct(F.xxhash64("comp", F.lit(turn)).alias("l"), F.xxhash64("node", F.lit(turn)).alias("k"),
                           F.col("node").alias("node2"), F.col("comp").alias("comp2"))
            leaders = live.groupBy("key").agg(F.min(lot).alias("s")).select("key", "s.node2", "s.comp2")
            met = live.join(leaders, "key").where(F.col("comp") != F.col("comp2"))
        first, second = F.col("node") < F.col("node2"), F.col("node") >= F.col("node2")
        pairs = met.select(
            F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"),
            F.when(first, F.col("comp")).otherwise(F.col("comp2")).alias("ca"),
            F.when(second, F.col("comp")).otherwise(F.col("comp2")).alias("cb")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        if not last:
            # few are left of the pairs, which many keys share: their sketches are fetched once
            a, b = (marks.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
            pairs = pairs.join(a, "a").join(b, "b").where(fit(*[F.col(c) for c in ("na", "nb", "sa", "sb")])).select("a", "b", "ca", "cb")
        compared = _settled(compare_sets(pairs, sets, percent), "compared")
        done = compared.select("a", "b") if done is None else done.unionByName(compared.select("a", "b"))
        fresh = compared.where("linked").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        if fresh.take(1):
            roots = components(fresh)
            named = roots.select(F.col("node").alias("comp"), "component")
            live = live.join(named, "comp", "left").withColumn("comp", F.coalesce("component", "comp")).drop("component")
            if found is not None:
                old = found.join(named.withColumnRenamed("component", "root"), F.col("component") == F.col("comp"), "left").select(
                    "node", F.coalesce("root", "component").alias("component"))
                roots = roots.join(found.select("node"), "node", "left_anti").unionByName(old)
            found = _settled(roots, "components")
        if last:
            break
        live = _settled(live, "index")
    return found if found is not None else index.select("node", F.col("node").alias("component")).limit(0)
