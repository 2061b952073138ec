"""Chat formatting without cumulative snapshots.

Loggers often store a conversation again each time it grows. Rolling hashes of turn
prefixes tell which conversations are the beginning of another; an anti-join keeps
those that are not, and they are rendered. DataFrame expressions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.folders import written

#: Turns of a part.
PART_TURNS = 256
#: The rendering of a turn.
TEMPLATE = "<|{role}|>\n{text}\n<|end|>\n"


def _turn(role: Column, text: Column) -> Column:
    head, rest = TEMPLATE.split("{role}")
    middle, tail = rest.split("{text}")
    return F.concat(F.lit(head), role, F.lit(middle), text, F.lit(tail))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``(conv, place, role, text, one, two)``: two 64-bit hashes of all turns up to each.

    Distinct turns are range-partitioned in their order, so a conversation is cut where a
    task ends, whatever its turn numbers are. Counts and sums of a conversation's turns in
    each task come first; those of earlier tasks are added to the places and the running
    sums within a task.
    """
    # the bounds of ranges are sampled: a digest stands for role and text
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.md5(F.concat_ws("\0", "role", "text"))]
    ordered = turns.groupBy("conv", "turn", "role", "text").count().drop("count").repartitionByRange(*order).sortWithinPartitions(*order)
    # the upper bits of this number are the task's
    ordered = ordered.withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered.withColumn("task", F.shiftright("at", 33)), "turns")
    tasks = ordered.groupBy("conv", "task").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumnsRenamed({"conv": "c", "task": "s"})
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("task") == F.col("s"))
    placed = ordered.join(tasks, same).withColumn("place", F.col("before") + F.col("at") - F.col("first") + 1)
    hashed = placed.withColumns({name: F.xxhash64(F.lit(salt), "place", "role", "text") for salt, name in ((1, "one"), (2, "two"))})
    sums = hashed.groupBy("conv", "task").agg(F.bit_xor("one").alias("x"), F.bit_xor("two").alias("y"))
    sums = sums.withColumns({f"{c}_before": F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)) for c in ("x", "y")}).select(
        F.col("conv").alias("c"), F.col("task").alias("s"), "x_before", "y_before")
    hashed = hashed.drop("c", "s").join(sums, same)
    running = Window.partitionBy("conv", "task").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.select(
        "conv", "task", "place", "turn", "role", "text", F.col("x_before").bitwiseXOR(F.bit_xor("one").over(running)).alias("one"),
        F.col("y_before").bitwiseXOR(F.bit_xor("two").over(running)).alias("two"))


def maximal(hashed: DataFrame) -> DataFrame:
    """``(conv, n_turns)`` of conversations that no other begins with; of equal ones, the smallest id's."""
    length = hashed.groupBy("conv").agg(F.max(F.struct("place", "one", "two")).alias("l")).select("conv", F.col("l.place").alias("n_turns"), "l.one", "l.two")
    whole = length.groupBy("n_turns", "one", "two").agg(F.min(F.struct(F.col("conv").isNull().alias("none"), "conv")).alias("m")).select(
        F.col("m.conv").alias("conv"), "n_turns", "one", "two")
    ends = length.withColumnsRenamed({"conv": "c"}).select("c", F.col("n_turns").alias("n"))
    # The last turn is no prefix of a longer conversation; prefixes are made distinct before the join.
    inner = hashed.join(ends, F.col("conv").eqNullSafe(F.col("c"))).where("place < n").select(F.col("place").alias("n_turns"), "one", "two").distinct()
    return whole.join(inner, ["n_turns", "one", "two"], "left_anti").select("conv", "n_turns")


def render(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
           text_column: str = "text") -> DataFrame:
    """``(conv, part, n_turns, text)``: maximal conversations, rendered in order of their turns.

    A conversation that is the beginning of another is left out, and of equal ones all
    but that with the smallest id. Null roles and texts are empty; rows with a null id
    are one conversation, its id comes after all others; repeated rows are one turn. Turns
    are in order of their numbers, null first, those of one number by the MD5 of role and
    text. The first PART_TURNS turns are part 0, and so on, whatever their numbers are;
    ``n_turns`` counts the whole conversation. Other columns are ignored.
    """
    empty = F.lit("")
    turns = conversations.select(
        F.col(id_column).alias("conv"), F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), empty).alias("role"), F.coalesce(F.col(text_column).cast("string"), empty).alias("text"))
    hashed = written(prefix_hashes(turns), "hashed")
    kept = maximal(hashed).withColumnsRenamed({"conv": "c"})
    lines = hashed.join(kept, F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv", F.floor((F.col("place") - 1) / PART_TURNS).alias("part"), "place", "n_turns", _turn(F.col("role"), F.col("text")).alias("line"))
    # a part has PART_TURNS turns at most, however many a conversation has
    parts = lines.groupBy("conv", "part").agg(F.max("n_turns").alias("n_turns"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines"))
    return parts.select("conv", "part", "n_turns", F.array_join("lines.line", "").alias("text"))
