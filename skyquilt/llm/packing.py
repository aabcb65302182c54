"""Packing by minimum bin slack.

Documents are cut into full windows and one remainder each. How many remainders there are of each length is
a table of at most ``capacity`` rows; from it the driver fills window after window: the longest remainder
left goes in, and a subset-sum over the other lengths, held as bitsets, finds the multiset that comes closest
to the capacity, its counts read off by going back through the bitsets. A window's multiset is repeated as
often as the counts allow, after which some length has fewer pieces left than the multiset has of it, at most
capacity / length: so there are at most as many multisets as the sum of 1 + capacity / length over all lengths,
under 18,000 for 2048, of at most 63 lengths each, whatever the corpus holds. Pieces find their place by their rank
among those of their length.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.llm.tokens import cut_pieces
from skyquilt.plans.scratch import Scratch

CAPACITY = 2048


def fill_window(counts: Mapping[int, int], capacity: int) -> dict[int, int]:
    """The multiset {length: how many} that holds the longest length and leaves least of ``capacity``; lengths go downwards."""
    first = max(counts)
    room, full = capacity - first, (1 << (capacity - first + 1)) - 1
    reach, trail = 1, []
    for length in sorted(counts, reverse=True):
        left = counts[length] - (length == first)
        if reach >> room & 1:
            break
        if length > room or not left:
            continue
        k = 1
        left = min(left, room // length)
        while left:  # counts as sums of powers of two, so that few shifts do
            take = min(k, left)
            trail.append((length, take, reach))
            reach |= reach << length * take & full
            left, k = left - take, 2 * k
    at, out = reach.bit_length() - 1, {first: 1}
    for length, take, before in reversed(trail):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= length * take
    return out


def plan_windows(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Lines (length, from rank, to rank, per window, offset, first window) that place every rank of every length."""
    left, used, lines, window = {k: n for k, n in counts.items() if n}, dict.fromkeys(counts, 0), [], 0
    while left:
        own = fill_window(left, capacity)
        times, offset = min(left[k] // n for k, n in own.items()), 0
        for length, n in own.items():
            lines.append((length, used[length], used[length] + n * times, n, offset, window))
            used[length] += n * times
            offset += n * length
            left[length] -= n * times
            if not left[length]:
                del left[length]
        window += times
    return lines


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``pieces``, which have length (1 to ``capacity``) and task, the part of the table they lie in.

    Sequences are numbered from 0 and filled without gaps from offset 0. No pieces give no rows; equal pieces
    are told apart by any order. ``task`` must be fixed in the rows, as the ranks are taken inside each.
    """
    spark = pieces.sparkSession
    per = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per = Scratch(spark).save(per.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"a piece has 1 to {capacity} ids")
    kind = "length long, low long, high long, per long, at long, window long"
    plan = spark.createDataFrame(plan_windows(counts, capacity), kind)
    # A few lines for each of at most `capacity` lengths, whatever the corpus holds.
    lines = plan.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "per", "at", "window"))).alias("lines"))
    inside = Window.partitionBy("length", "task").orderBy("doc_id", "start")
    ranked = pieces.withColumn("_r", F.row_number().over(inside) - 1).join(per.select("length", "task", "base"), ["length", "task"]).withColumn("_r", F.col("_r") + F.col("base"))
    ranked = ranked.join(F.broadcast(lines), "length")
    line = F.filter("lines", lambda x: (x["low"] <= F.col("_r")) & (F.col("_r") < x["high"]))[0]
    ranked = ranked.withColumn("_l", line).withColumn("_i", F.col("_r") - F.col("_l.low"))
    return ranked.select(
        *pieces.columns, (F.col("_l.window") + F.floor(F.col("_i") / F.col("_l.per"))).alias("sequence_id"), (F.col("_l.at") + F.col("_i") % F.col("_l.per") * F.col("length")).alias("offset"),
    )


def pack_documents(documents: DataFrame, model: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset for each piece of every whole text.

    A null text is empty and has its end id alone; a null doc_id stays null; repeated rows are packed each.
    """
    pieces = Scratch(documents.sparkSession).save(cut_pieces(documents, model, capacity))
    return pack(pieces, capacity).drop("task")
