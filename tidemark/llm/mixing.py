"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a budget of words. Whole epochs of the source come first; the rest of the budget is filled
by a weighted sample without replacement: a document of weight ``w`` draws the key ``-ln(u) / w`` with ``u``
uniform in (0, 1), documents are sorted by key, and their sizes are summed up until the budget is used. The
document on the border is taken in part.

Only built-in functions are used. A source may hold most of the rows: its keys are cut into ranges, sizes
are summed per range first (with map-side combine), and only rows of one range are ever sorted together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.frames import unused, written
from tidemark.operators import keyfilter

#: Key ranges per source; more ranges make smaller tasks and give the same result.
RANGES = 2048
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Words between white space; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(
    sources: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """The budget of each source: ``sources(source, source_size)``, one row each, plus ``target``.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share ``share`` times all sizes by
    weight. A source stops at ``cap`` times its size; what is above is shared again by weight, until nothing
    is. Sources fill up in the order of cap by weight, so running sums over that order find the level at
    which the rest share. Its windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    most = F.col("source_size") * F.lit(cap)
    rated = (
        sources.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", turn)
        .withColumn("most", most)
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    fill = W.orderBy("ratio", F.col("source").asc_nulls_last())
    full_before = F.coalesce(F.sum("most").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy()) * F.lit(share)
    # If all earlier sources are full, this is what each unit of weight of the others gets.
    level = rated.withColumn("level", (total - full_before) / weight_left).withColumn(
        "turn", F.row_number().over(fill)
    )
    # A source is not full if the level at its turn is below its ratio; the first such level holds for all.
    open_level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("turn", "level"))).over(
        W.partitionBy()
    )["level"]
    target = F.least(F.col("most"), F.coalesce(open_level * F.col("weight"), F.col("most")))
    return level.select("source", "source_size", target.alias("target"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: Column | None = None,
    size: Column | None = None,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 11,
    ranges: int = RANGES,
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``taken`` (words) and ``copies`` (rows to write).

    ``quality`` is a document's positive weight in the fractional epoch, 1 by default; ``size`` its words, by
    default counted in ``text_col`` (which may then also be a hash of the text). ``copies`` counts the
    whole epochs, plus one if at least half of the document is taken in the last one.

    * NULL text has size 0; a NULL source is a source of its own, last in order.
    * Documents without words take nothing and are copied once per whole epoch.
    * Rows equal in id, text and size are interchangeable; keys are a function of id, text and seed, so
      reruns agree. Ties of the key go by id, then size.
    * An empty frame gives an empty result. Columns of the result's names are replaced.
    """
    made = ("size", "source_size", "target", "taken", "copies")
    docs = docs.withColumn("__quality", F.lit(1.0) if quality is None else quality.cast("double"))
    rows = docs.drop(*[c for c in docs.columns if c.lower() in made])
    names = [c for c in rows.columns if c != "__quality"]
    part = unused(rows, "key_range")
    bits = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    weight = F.greatest(F.coalesce(F.col("__quality"), F.lit(1.0)), F.lit(1e-6))
    rows = (
        rows.withColumn("size", word_count(text_col) if size is None else size)
        .withColumn("__key", -F.log(uniform) / weight)
        # A monotone map of the key to ranges; keys of weight 1 fill them evenly.
        .withColumn(part, F.floor((F.lit(1.0) - F.exp(-F.col("__key"))) * ranges).cast("int"))
    )
    # NULL is a source of its own, so sources are told apart by a text that is never NULL.
    rows = rows.withColumn("__source", F.coalesce(F.concat(F.lit("+"), F.col(source_col)), F.lit("-")))
    range_sizes = rows.groupBy("__source", part).agg(F.sum("size").alias("range_size"))
    per_source = range_sizes.groupBy("__source").agg(F.sum("range_size").alias("source_size"))
    name = F.when(F.col("__source") != "-", F.expr("substring(__source, 2)"))
    budgets = targets(per_source.select(name.alias("source"), "source_size"), weights, share, cap).select(
        F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("__source"), "source_size", "target"
    )
    earlier = W.partitionBy("__source").orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    begun = range_sizes.select(
        "__source", part, F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("__range_begin")
    ).join(budgets, "__source")
    in_range = (
        W.partitionBy("__source", part).orderBy("__key", id_col, "size").rowsBetween(W.unboundedPreceding, -1)
    )
    summed = rows.withColumn("__in_range", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
    joined = summed.join(begun, ["__source", part])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target") - epochs * F.col("source_size")).cast("long")
    left = rest - F.col("__range_begin") - F.col("__in_range")
    last = F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")
    chosen = (F.col("size") > 0) & (last * 2 >= F.col("size"))
    return joined.select(
        *names,
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"),
        (epochs + F.when(chosen, 1).otherwise(0)).cast("int").alias("copies"),
    )


def cutoffs(
    rows: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    ranges: int = RANGES,
) -> DataFrame:
    """Where each source's mix ends, one row per source, of narrow rows ``(source, size, key, tie)``.

    Rows are taken in the order of ``key``, then ``tie``; rows equal in both are interchangeable and of one
    size. Gives ``source``, ``epochs`` (whole ones), and of the last, fractional epoch ``end_key`` and
    ``end_tie`` of the row on the border (NULL if it takes nothing), how many ``equal`` rows stand there, and
    how many of them, ``chosen``, are taken by half of their size at least.

    Sizes are summed per range of keys with map-side combine; only the range that holds a source's border is
    sorted, with equal rows counted first.
    """
    placed = rows.select(
        F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("name"), "size", "key", "tie",
        F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * ranges).cast("long").alias("range"),
    )
    sizes = written(placed.groupBy("name", "range").agg(F.sum("size").alias("size")), "ranges")
    per_source = sizes.groupBy("name").agg(F.sum("size").alias("source_size"))
    source = F.when(F.col("name") != "-", F.expr("substring(name, 2)")).alias("source")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = targets(per_source.select(source, "source_size"), weights, share, cap).select(
        F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("name"),
        "source",
        epochs.alias("epochs"),
        F.round(F.col("target") - epochs * F.col("source_size")).cast("long").alias("rest"),
    )
    # One row per source and range; then the one range in which the rest runs out.
    through = F.sum("size").over(W.partitionBy("name").orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow))
    border = (
        sizes.withColumn("through", through)
        .join(budgets, "name")
        .filter((F.col("rest") > F.col("through") - F.col("size")) & (F.col("rest") <= F.col("through")))
        .select("name", "range", (F.col("rest") - F.col("through") + F.col("size")).alias("left"))
    )
    border = written(border, "border")
    near = placed.filter("size > 0").join(border, ["name", "range"]).groupBy("name", "left", "key", "tie", "size").agg(
        F.count(F.lit(1)).alias("equal")
    )
    before = W.partitionBy("name").orderBy("key", "tie", "size").rowsBetween(W.unboundedPreceding, -1)
    begun = near.withColumn("left", F.col("left") - F.coalesce(F.sum(F.col("size") * F.col("equal")).over(before), F.lit(0)))
    whole = F.expr("left div size")
    half = F.when((F.col("left") % F.col("size")) * 2 >= F.col("size"), 1).otherwise(0)
    last = begun.filter((F.col("left") > 0) & (F.col("left") <= F.col("size") * F.col("equal"))).select(
        "name", F.col("key").alias("end_key"), F.col("tie").alias("end_tie"), "equal", (whole + half).alias("chosen")
    )
    return budgets.join(last, "name", "left").select("source", "epochs", "end_key", "end_tie", "equal", "chosen")


#: Rows of a key range, beyond which there are more ranges.
ROWS_PER_RANGE = 50_000
#: Copies of one row made by one task at a time.
CHUNK = 1 << 12


def mixture(
    docs: DataFrame,
    ratings: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 11,
) -> DataFrame:
    """The mix itself: the rows, each as often as it is to be copied, in the columns of ``docs``.

    Decided on narrow rows: ``cutoffs`` gives one row per source, and each document is compared with its
    source's border where it lies, as if it had weight 1. Documents that come out otherwise by their own weight
    in ``ratings(rated_id, weight)``, one row per id, are found among the narrow rows; a filter of their hashes
    of bounded size tells which texts need to cross the cluster to meet that list. Keys are drawn from a hash
    of the whole row, so only rows equal in every column tie; should they stand on a border, those copies are
    made of one of them.

    A document's weight in the fractional epoch is positive, 1 without a rating. NULL text and text without
    words has size 0 and is copied once per whole epoch; a NULL source is a source of its own, a NULL id has
    no rating. Repeated rows are copied each; an empty frame gives an empty one. No column is overwritten.
    """
    names = [f"`{c}`" for c in docs.columns]
    tie = F.xxhash64(*names).alias("tie")
    bits = F.shiftrightunsigned(F.xxhash64("tie", F.lit(seed)), 11)
    draw = -F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53)))

    narrow = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), tie)
    if ratings is not None:
        narrow = narrow.join(ratings, F.col("id") == F.col("rated_id"), "left")
    weight = F.lit(1.0) if ratings is None else F.greatest(F.coalesce("weight", F.lit(1.0)), F.lit(1e-6))
    narrow = written(narrow.select("source", "size", "tie", (draw / weight).alias("key")), "narrow")
    ranges = max(RANGES, narrow.count() // ROWS_PER_RANGE)
    ends = written(cutoffs(narrow, weights, share, cap, ranges), "cutoffs").withColumnRenamed("source", "of_source")
    same_source = F.col("source").eqNullSafe(F.col("of_source"))
    parted = F.coalesce((F.col("chosen") > 0) & (F.col("chosen") < F.col("equal")), F.lit(False))
    border = F.coalesce(F.col("tie") == F.col("end_tie"), F.lit(False))

    def copies(key: Column, sized: Column) -> Column:
        """Of a row with its source's border; rows of a border that is parted are copied apart."""
        earlier = (key < F.col("end_key")) | ((key == F.col("end_key")) & (F.col("tie") < F.col("end_tie")))
        taken = F.coalesce(sized & F.when(border, F.col("chosen") == F.col("equal")).otherwise(earlier), F.lit(False))
        return F.when(sized & border & parted, 0).otherwise(F.col("epochs") + F.when(taken, 1).otherwise(0)).cast("long")

    own, plain = copies(F.col("key"), F.col("size") > 0), copies(draw, F.col("size") > 0)
    judged = narrow.join(ends, same_source).select(F.col("tie").alias("other_tie"), own.alias("other"), plain.alias("plain"))
    others = written(judged.filter("other <> plain").select("other_tie", "other").distinct(), "others")

    row = F.struct(*names).alias("row")
    sized = F.coalesce(F.col(text_col).rlike(WORDS), F.lit(False)).alias("sized")
    met = docs.select(row, F.col(source_col).alias("source"), sized, tie).join(ends, same_source)
    marked = keyfilter.with_suspicion(met.select("row", "tie", copies(draw, F.col("sized")).alias("copies")), "tie", others.select(F.col("other_tie").alias("hash")), "marked")
    whole = _copied(marked.filter(~F.col("marked")).select("row", "copies"))
    exact = marked.filter("marked").join(others, F.col("tie") == F.col("other_tie"), "left")
    whole = whole.unionByName(_copied(exact.select("row", F.coalesce("other", "copies").alias("copies"))))
    if ends.filter(parted).count():
        # One row stands for all that are equal to it; its copies are made in many tasks.
        one = met.filter(F.col("sized") & border & parted).select("row", (F.col("epochs") * F.col("equal") + F.col("chosen")).alias("copies"))
        chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {CHUNK}"))).alias("chunk")
        dealt = one.distinct().select("row", "copies", chunks).repartition("chunk")
        left = F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK)
        whole = whole.unionByName(_copied(dealt.select("row", left.alias("copies"))))
    return whole.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _copied(rows: DataFrame) -> DataFrame:
    """``row`` as often as ``copies`` says."""
    return rows.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row")


#: Weight of a document in the fractional epoch by its quality label; without a label it weighs 1.
QUALITY = {0: 0.5, 1: 2.0}


def ratings(labels: DataFrame) -> DataFrame:
    """``(rated_id, weight)`` by quality label; the greatest if labelled more than once. NULL ids rate nothing."""
    weight = reduce(
        lambda w, q: F.when(F.col("quality") == q, F.lit(QUALITY[q])).otherwise(w), QUALITY, F.lit(1.0)
    )
    known = labels.filter(F.col("doc_id").isNotNull())
    return known.groupBy(F.col("doc_id").alias("rated_id")).agg(F.max(weight).alias("weight"))


def rated(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows with ``mixing_weight``, by quality label; an earlier column of that name is replaced."""
    rows = docs.drop("mixing_weight")
    rates = ratings(labels).withColumnRenamed("weight", "mixing_weight")
    return rows.join(rates, F.col(id_col) == F.col("rated_id"), "left").drop("rated_id")
