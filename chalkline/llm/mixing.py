"""Mixing sources to target weights by hierarchical budgeting, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.session import materialized

# Documents of a leaf in one hash range, about: so many are summed up one after the other by one task.
RANGE_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"
# Places are 60-bit numbers.
PLACES = float(1 << 60)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def budgets(leaves: DataFrame, levels: list[str], epochs: int) -> DataFrame:
    """``budget`` of each leaf in place of the whole's; ``leaves``: the levels' columns, ``weight`` and ``tokens`` (longs,
    tokens of one epoch) and ``budget`` (long, the same in all rows).

    Top down, a node shares its budget among its children by weight; a node's weight is the sum of its leaves' weights.
    A child takes at most its capacity, ``epochs`` times its tokens. What it can't take goes to its siblings by their
    weights; only what the whole family can't take goes to its parent's siblings. Shares are whole tokens, rounded
    down. Tokens times weights must stay below 2^63. This works on one row per leaf.
    """
    tree = leaves.withColumn("capacity", F.col("tokens") * epochs)
    for depth, level in enumerate(levels):
        above = levels[:depth]
        # children that take all they can are the first ones by capacity per weight
        family = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = family.orderBy(F.col("capacity") / F.col("weight"), F.col("capacity"), level)
        nodes = tree.groupBy(*above, level).agg(
            F.sum("weight").alias("weight"), F.sum("capacity").alias("capacity"), F.min("budget").alias("given")
        )
        nodes = nodes.withColumns({
            "place": F.row_number().over(order),
            "left": F.col("given") - F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "rest": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        })
        # the first child that can't be filled fixes the share of a unit of weight, for itself and all after it
        unfilled = F.when(F.col("capacity") * F.col("rest") > F.col("left") * F.col("weight"), F.struct("place", "left", "rest"))
        nodes = nodes.withColumn("open", F.min(unfilled).over(family)).withColumn(
            "budget",
            F.when(F.col("open").isNull() | (F.col("place") < F.col("open.place")), F.col("capacity"))
            .otherwise(F.expr("(weight * open.left) div open.rest")),
        )
        tree = tree.drop("budget").join(nodes.select(*above, level, "budget"), [*above, level])
    return tree.drop("capacity")


def place_of(doc_id: str, text: str, epoch: Column, seed: int) -> Column:
    """Place of a document in an epoch's order, from the MD5 of seed, epoch and id (without an id, its text)."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.coalesce(F.md5(F.col(text)), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name)), 1, 15), 16, 10).cast("long")


def mix(
    docs: DataFrame, weights: DataFrame, permille: int = 500, epochs: int = 2, seed: int = 7, doc_id: str = "doc_id",
    text: str = "text", levels: tuple[str, ...] = ("domain", "lang", "source"),
) -> DataFrame:
    """The documents of the mix, once for each epoch that takes them, with ``epoch`` and ``n_words`` added.

    ``docs`` has the ``levels`` as columns; ``weights`` has them and ``weight``, a positive long, one row per leaf. The
    mix is to hold ``permille`` thousandths of the corpus's words, shared out by ``budgets``. A leaf takes whole epochs
    as long as its budget lasts; of the next epoch it takes a prefix in that epoch's seeded order: all documents up to
    the place where the sum of words would pass the budget.

    Null level values are one leaf. Leaves without a weight, and leaves that hold no words at all, get nothing. Other
    null or empty texts have no words and go with their place in the order. Rows of one place, which are repeated rows, stand or fall together. A null doc_id is
    placed by its text. Other columns pass through; columns with the added names are replaced. No rows, or no weights,
    give no rows.

    Two passes over the documents; neither text nor ids of documents are shuffled for the second, which only compares
    places with one cut per leaf. The running sum needs no window over a leaf: sums of hash ranges of about
    ``RANGE_ROWS`` documents tell in which range the budget ends, and only that range is summed up row by row.
    """
    keys = [f"__{c}" for c in levels]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({f"__{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in levels})

    counted = keyed(docs).withColumn("n_words", word_count(F.col(text)))
    leaves = materialized(counted.groupBy(*keys).agg(F.sum("n_words").alias("tokens"), F.count("*").alias("rows")), "leaves")
    weighted = keyed(weights).where("weight > 0").groupBy(*keys).agg(F.max("weight").cast("long").alias("weight"))
    total = F.expr(f"sum(tokens) * {permille} div 1000").cast("long")
    whole = F.coalesce(leaves.agg(total.alias("total")).scalar(), F.lit(0).cast("long"))
    plan = materialized(
        budgets(leaves.join(weighted, keys).withColumn("budget", whole), keys, epochs)
        .where("tokens > 0")
        .select(
            *keys,
            F.expr("least(budget div tokens, {0})".format(epochs)).alias("full"),
            F.expr("budget % tokens").alias("over"),
            F.ceil(F.col("rows") / RANGE_ROWS).alias("ranges"),
        ),
        "mix-plan",
    )
    place = place_of(doc_id, text, F.col("full") + 1, seed)
    placed = counted.join(plan.where(F.col("full") < epochs), keys).select(*keys, place.alias("place"), "n_words", "over", "ranges")
    at = materialized(
        placed.groupBy(*keys, "over", "ranges", "place").agg(F.sum("n_words").alias("n_words"))
        .withColumn("range", F.floor(F.col("place") / PLACES * F.col("ranges"))),
        "mix-places",
    )
    so_far = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        at.groupBy(*keys, "over", "range").agg(F.sum("n_words").alias("words"), F.max("place").alias("last"))
        .withColumn("until", F.sum("words").over(so_far))
    )
    ends = ranges.where("until > over").groupBy(*keys).agg(F.min_by(F.struct("range", (F.col("until") - F.col("words")).alias("before")), "range").alias("end"))
    inside = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        at.join(ends.select(*keys, F.col("end.range").alias("range"), F.col("end.before").alias("before")), [*keys, "range"])
        .withColumn("until", F.col("before") + F.sum("n_words").over(inside))
        .where("until <= over").groupBy(*keys).agg(F.max("place").alias("cut"))
    )
    before_end = ranges.where("until <= over").groupBy(*keys).agg(F.max("last").alias("cut"))
    cuts = materialized(
        plan.select(*keys, "full").join(last.unionByName(before_end).groupBy(*keys).agg(F.max("cut").alias("cut")), keys, "left")
        .select(*keys, F.col("full").alias("__full"), F.coalesce("cut", F.lit(-1)).alias("__cut"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).where("epoch <= __full + 1"),
        "mix-cuts",
    )
    taken = (F.col("epoch") <= F.col("__full")) | (place_of(doc_id, text, F.col("epoch"), seed) <= F.col("__cut"))
    return counted.drop("epoch").join(cuts, keys).where(taken).drop(*keys, "__full", "__cut")
