"""Chat formatting: cumulative snapshots collapsed to the longest, then rendered.

Logs often hold a conversation again after every turn. Each turn gets a hash of all turns up to it; a conversation whose
last such hash occurs within a longer one is a prefix of that and goes. Of equal conversations the one with the
least id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioline.session import settle

#: A rendered conversation is cut into parts of so many turns, so that no row grows without bound.
TURNS_PER_PART = 256


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text hash columns) of ``turns`` with ``pos`` from 0 and both prefix hashes.

    The order is by ``turn``, then role and text; nulls first. The prefix hash is the running exclusive-or of hashes
    of (position, role, text), twice with different seeds. The rows are sorted over ranges of (conv_id, turn), so that
    a conversation of any length is spread; within a range the running values are windows, and what the
    ranges before a conversation's part have added is one row for each range that it touches.
    """
    ids = turns.select("conv_id", "turn", F.col("role"), F.xxhash64(F.lit(1), "text").alias("_t1"),
                       F.xxhash64(F.lit(2), "text").alias("_t2"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha"))
    # ranges are cut in the very order of positions, so that equal turns spread over ranges keep one order
    ranged = settle(ids.repartitionByRange("conv_id", "turn", "role", "_sha").withColumn("_range", F.spark_partition_id()), "turns")
    part = Window.partitionBy("conv_id", "_range")
    ordered = part.orderBy("turn", "role", "_sha")
    local = ranged.withColumn("_i", F.row_number().over(ordered) - 1)
    counts = ranged.groupBy("conv_id", "_range").count()
    before = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("conv_id").alias("_c"), F.col("_range").alias("_r"),
                            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r"))
    placed = local.join(offsets, same).withColumn("pos", F.col("_before") + F.col("_i"))
    own = [F.xxhash64(F.lit(k), "pos", "role", f"_t{k}") for k in (1, 2)]
    placed = settle(placed.select("conv_id", "turn", "role", "_sha", "_range", "pos", own[0].alias("_h1"), own[1].alias("_h2")), "placed")
    totals = placed.groupBy("conv_id", "_range").agg(F.bit_xor("_h1").alias("_x1"), F.bit_xor("_h2").alias("_x2"))
    carried = totals.select(F.col("conv_id").alias("_c"), F.col("_range").alias("_r"), *[
        F.coalesce(F.bit_xor(f"_x{k}").over(before), F.lit(0).cast("long")).alias(f"_b{k}") for k in (1, 2)])
    running = part.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hashed = placed.withColumns({f"_p{k}": F.bit_xor(f"_h{k}").over(running) for k in (1, 2)})
    return hashed.join(carried, same).select(
        "conv_id", "turn", "role", "_sha", "pos", *[F.col(f"_p{k}").bitwiseXOR(F.col(f"_b{k}")).alias(f"prefix{k}") for k in (1, 2)])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns): the conversations that are no prefix of a longer one, one of each group of equals.

    A null id is a conversation of its own. An empty table has none.
    """
    marked = settle(numbered_turns(turns).drop("_sha"), "prefixes")
    return _maximal(marked)


def _maximal(marked: DataFrame) -> DataFrame:
    last = marked.groupBy("conv_id").agg(F.max(F.struct("pos", "prefix1", "prefix2")).alias("e")).select(
        "conv_id", (F.col("e.pos") + 1).alias("n_turns"), F.col("e.prefix1").alias("prefix1"), F.col("e.prefix2").alias("prefix2"))
    # equal conversations first: one narrow row for each conversation; nulls last, so that a real id stays
    kept = settle(last.groupBy("n_turns", "prefix1", "prefix2").agg(F.min("conv_id").alias("conv_id")), "unequal")
    # positions that are not the last of their conversation are where shorter ones may end
    inner = marked.join(last.select(F.col("conv_id").alias("_c"), F.col("n_turns").alias("_n")),
                        F.col("conv_id").eqNullSafe(F.col("_c"))).where(F.col("pos") + 1 < F.col("_n")).select(
        (F.col("pos") + 1).alias("n_turns"), "prefix1", "prefix2").distinct()
    return kept.join(inner, ["n_turns", "prefix1", "prefix2"], "left_anti").select("conv_id", "n_turns")


def render_turn(role: Column, text: Column) -> Column:
    """One turn in the usual markup of chat templates; null role and text count as empty."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")),
                    F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, text) of the maximal conversations in ``turns (conv_id, turn, role, text, ...)``.

    ``part`` counts from 0 in steps of :data:`TURNS_PER_PART` turns; ``n_turns`` is that of the part.
    """
    marked = settle(numbered_turns(turns), "prefixes")
    kept = settle(_maximal(marked.drop("_sha")).select(F.col("conv_id").alias("_k")), "maximal")
    order = marked.join(kept, F.col("conv_id").eqNullSafe(F.col("_k")), "left_semi").select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("role").alias("_r"), F.col("_sha").alias("_s"), "pos").dropDuplicates(
        ["_c", "_t", "_r", "_s", "pos"])
    # turns that repeat in full share their positions: each text goes with the row numbers of its copies
    place = order.groupBy("_c", "_t", "_r", "_s").agg(F.sort_array(F.collect_list("pos")).alias("_at"))
    texts = turns.select("conv_id", "turn", "role", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha")).dropDuplicates(
        ["conv_id", "turn", "role", "_sha"])
    met = texts.join(place, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
                     & F.col("role").eqNullSafe(F.col("_r")) & (F.col("_sha") == F.col("_s")))
    rendered = met.select("conv_id", F.explode("_at").alias("pos"), render_turn(F.col("role"), F.col("text")).alias("_line"))
    parts = rendered.groupBy("conv_id", F.floor(F.col("pos") / TURNS_PER_PART).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "_line"))).alias("_lines"))
    return parts.select("conv_id", "part", F.size("_lines").cast("long").alias("n_turns"),
                        F.array_join(F.transform("_lines", lambda x: x["_line"]), "").alias("text"))
