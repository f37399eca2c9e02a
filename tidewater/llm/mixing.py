"""Mix sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Targets: the sources, in code point order with null last, weigh 3, 1, 2 in turn and share ``share`` times all sizes.
A target stops at ``most`` times its source's size; the excess is shared again by weight until none is above.
That is ``least(most * size, level * weight)`` with one level for all, found from running sums over the sources.

Selection: each source first gives as many complete epochs as its target holds. The rest of the target is filled
in the order of exponential keys ``-ln(u) / quality`` (least first), u a hash of the id, until the running sum of
sizes would pass it; texts larger than what is left are passed over. What that text leaves open is filled by the texts
after it, in order, each that fits into what is then left, until none does. The running sum is taken in two steps: sums per slot of the key's range, then, only in the one
slot where a source's budget ends, row by row. So no task holds a whole source. Of the texts after it, those of one size can fill what is left only in their
order, so the first ``left / size`` of each size are enough: fewer than left * (ln left + 1) rows a source, where left is under one text's size.

Null and blank texts have size 0 and take nothing. Rows that are equal throughout are told apart by nothing, so
which of them is taken makes no difference. Equal keys are ordered by id. Empty tables give empty results. A column ``repeats`` of the input is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewater.llm.common import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
SLOTS = 4096
LEAST_WEIGHT = 0.25


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """Weight of a document: 1 where its words are 2 to 12 characters long on average, a quarter elsewhere."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(mean.between(3, 13), 1.0).otherwise(LEAST_WEIGHT)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """From (source, source_size): add ``target``. One row per source, so the windows hold the sources only."""
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    up = W.orderBy("ratio", F.col("source").asc_nulls_last())
    every = W.partitionBy()
    upto, all_ = up.rowsBetween(W.unboundedPreceding, W.currentRow), every
    sums = ranked.select("*", F.sum("cap").over(upto).alias("caps"), F.sum("weight").over(upto).alias("capped"), F.sum("weight").over(all_).alias("weights"), (share * F.sum("source_size").over(all_)).alias("budget"), F.lead("ratio").over(up).alias("next"))
    level = (F.col("budget") - F.col("caps")) / F.nullif(F.col("weights") - F.col("capped"), F.lit(0.0))
    # the level after the first k sources are capped holds, for the first k at which the next source stays under its cap
    fits = F.when(F.col("next").isNotNull() & (level <= F.col("next")), F.struct("caps", level.alias("level")))
    first = F.when((F.col("budget") / F.col("weights")) <= F.min("ratio").over(every), F.col("budget") / F.col("weights"))
    chosen = sums.withColumn("level", F.coalesce(first, F.min(fits).over(every)["level"]))
    return chosen.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def sampling_key(id_col: Column, weight: Column, seed: int) -> Column:
    """``1 - exp(-e)`` of the exponential key e = -ln(u) / weight: the same order, in the range 0 to 1."""
    digits = F.substring(F.md5(F.concat_ws("-", F.lit(seed), id_col.cast("string")).cast("binary")), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**48)
    return 1 - F.pow(u, 1 / weight)


def slot(key: Column) -> Column:
    """Place of a key among ``SLOTS``: its own order, stretched where keys of the least weight crowd, so no slot holds more than some thousandth of them."""
    return F.floor((1 - F.pow(1 - key, LEAST_WEIGHT)) * SLOTS)


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per row: id, ``size``, ``source``, ``source_size``, ``target`` and ``taken``, the words that the mix takes of it."""
    return placed_rows(docs, weights, share, most, seed, id_col, source_col, text_col).select(F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target", "taken")


def placed_rows(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """Per row: ``id``, ``mark`` (a hash of the text), ``size``, ``source``, ``source_size``, ``target`` and ``taken``."""
    size = words(F.col(text_col))
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(source_col).cast("string").alias("source"), size.alias("size"), quality(F.col(text_col), size).alias("quality"))
    rows = checkpointed(narrow.withColumn("key", sampling_key(F.col("id"), F.col("quality"), seed)).withColumns({"slot": slot(F.col("key")), "n": F.monotonically_increasing_id()}))
    slots = rows.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    targets = source_targets(slots.groupBy("source").agg(F.sum("slot_size").alias("source_size")), weights, share, most)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    left = checkpointed(targets.withColumn("left", F.col("rest")).withColumnRenamed("source", "plan_source"))
    rows, left = filled(rows, left)
    own = F.col("source").eqNullSafe(F.col("plan_source"))
    late = still_fitting(rows.where("not more and size > 0").join(left.select("plan_source", "left"), own, "inner").where("size <= left"))
    placed = rows.join(left, own, "inner").join(late, "n", "left")
    return placed.select("id", "mark", "size", "source", "source_size", "target", (F.col("size") * (F.col("epochs") + (F.col("more") | F.col("late").isNotNull()).cast("long"))).cast("long").alias("taken"))


def filled(rows: DataFrame, left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``more``, set for those that fill their source's budget up to the first that would pass it, and what then is left.

    ``left`` has a row per source (``plan_source``, ``left`` and columns that stay). Both are checkpointed.
    """
    own = F.col("source").eqNullSafe(F.col("plan_source"))
    open_ = (F.col("size") > 0) & (F.col("size") <= F.col("left"))
    slots = rows.join(left, own, "inner").where(open_).groupBy("source", "slot").agg(F.sum("size").alias("slot_size"), F.first("left").alias("left"))
    before = F.coalesce(F.sum("slot_size").over(W.partitionBy("source").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = slots.withColumn("before", before).where("before + slot_size > left").groupBy("source").agg(F.min(F.struct("slot", "before")).alias("cut"))
    cuts = checkpointed(left.join(cut, own, "left").select("plan_source", "left", "cut"))
    placed = rows.join(cuts, own, "inner")
    edge = placed.where("slot = cut.slot")
    whole = placed.where("cut is null or slot <> cut.slot").withColumn("more", open_ & (F.col("cut").isNull() | (F.col("slot") < F.col("cut.slot"))))
    inside = F.sum(F.when(open_, F.col("size"))).over(W.partitionBy("source").orderBy("key", F.col("id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, W.currentRow))
    edge = edge.withColumn("more", open_ & (F.col("cut.before") + inside <= F.col("left")))
    both = checkpointed(whole.unionByName(edge).select(*rows.columns, "more"))
    given = both.where("more").groupBy("source").agg(F.sum("size").alias("given"))
    after = left.join(given, own, "left").withColumn("left", F.col("left") - F.coalesce("given", F.lit(0))).drop("source", "given")
    return both, checkpointed(after)


def still_fitting(rows: DataFrame) -> DataFrame:
    """``n`` (and ``late``) of the rows that go into what is ``left`` of their source, taken in order where they fit. All rows come after the one that did not fit.

    Of one size only the first ``left / size`` can be taken, found by counts of slots and then by rank; a source folds these in order.
    """
    room, sizes = F.floor(F.col("left") / F.col("size")), ["source", "size"]
    slots = rows.groupBy(*sizes, "slot").agg(F.count("*").alias("held"), F.first("left").alias("left"))
    before = F.coalesce(F.sum("held").over(W.partitionBy(*sizes).orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = slots.withColumn("before", before).where(F.col("before") < room).select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("slot").alias("t"))
    near = rows.join(first, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slot") == F.col("t")), "left_semi")
    rank = F.row_number().over(W.partitionBy(*sizes).orderBy("key", F.col("id").asc_nulls_last()))
    order = F.struct("key", F.col("id").isNull().alias("none"), "id", "size", "n")
    lists = near.withColumn("rank", rank).where(F.col("rank") <= room).groupBy("source").agg(F.array_sort(F.collect_list(order)).alias("rows"), F.first("left").alias("left"))
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<bigint>").alias("taken"))
    step = lambda a, r: F.when(r["size"] <= a["left"], F.struct((a["left"] - r["size"]).alias("left"), F.concat(a["taken"], F.array(r["n"])).alias("taken"))).otherwise(a)
    return lists.select(F.explode(F.aggregate("rows", start, step)["taken"]).alias("n"), F.lit(True).alias("late"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents of the mix with ``repeats``, how often each is read. Rows are told apart by id, which may be null, source and text.

    Of rows that are alike in these, which may get different numbers, those that come first by their other columns get more.
    """
    docs = docs.drop("repeats")
    taken = placed_rows(docs, weights, share, most, seed, id_col, source_col, text_col).where("size > 0").select("id", "mark", "source", F.expr("cast(taken / size as int)").alias("times"))
    rows = docs.withColumn("__tw_mark", F.xxhash64(text_col)).alias("d")
    groups = taken.groupBy("id", "mark", "source").agg(F.sum("times").alias("__tw_times"), (F.count("*") > 1).alias("__tw_more")).where("__tw_times > 0").alias("g")
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("g.id")) & (F.col("d.__tw_mark") == F.col("g.mark")) & F.col(f"d.{source_col}").cast("string").eqNullSafe(F.col("g.source"))
    found = rows.join(groups, same).select("d.*", "__tw_times", "__tw_more")
    others = sorted(c for c in docs.columns if not docs.schema[c].dataType.simpleString().startswith("map"))
    like = W.partitionBy(id_col, "__tw_mark", source_col)
    numbered = found.where("__tw_more").withColumn("__tw_n", F.count("*").over(like)).withColumn("__tw_k", F.row_number().over(like.orderBy(*[F.col(c).asc_nulls_last() for c in others])))
    share_of = F.floor(F.col("__tw_times") / F.col("__tw_n")) + (F.col("__tw_k") <= F.pmod("__tw_times", "__tw_n")).cast("int")
    out = found.where("not __tw_more").withColumn("repeats", F.col("__tw_times").cast("int")).select(*docs.columns, "repeats")
    return out.unionByName(numbered.withColumn("repeats", share_of.cast("int")).where("repeats > 0").select(*docs.columns, "repeats"))
