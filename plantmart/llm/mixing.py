"""Mixing sources to target weights by Pfair scheduling of their blocks.

Each source's documents, in the order of their ids, are cut into blocks, and blocks take slots in proportion
to the weights. Sources are the leaves of a binary tree and every inner node is a supertask of Pfair
scheduling: its slots are dealt to its two sides by release times and deadlines, side by side, so that of
the first m slots a side with the share f has had m f, rounded to the nearest whole number. A block's slot
follows from its number alone, by one formula on each step from its source up to the root; there is no
schedule to work out, no period and no limit on sources or blocks, and no error grows with the slots.

The tree is a Huffman tree over classes of weights that agree up to a factor of two, and balanced within a
class. A rounding of half a slot shrinks by the shares above it, so a source is never more than a few
blocks from its weight, however long the mix and however many sources: tests measure less than two.

Nothing is dropped or repeated: when a source has run out, its slots stay empty and the others keep theirs.

Defined cases: rows without a source form a source of their own; rows are ordered within their source by
doc_id (those without come first), then by a hash of the row, and equal rows take places of their
own; a source without a weight, or a weight that is not positive, is an error; weights count up to
2^-40 of their sum; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantmart.llm.storing import stored, unused

# The period of the plain schedule, whole_shares() and schedule(), which tests compare with.
PERIOD = 1000
# Weights are whole numbers that add up to about this.
TOTAL = 1 << 40

Weights = Mapping[str | None, float] | DataFrame


def whole_shares(weights: Mapping[str | None, float], period: int = PERIOD) -> dict[str | None, int]:
    """Weights as whole numbers of slots that add up to the period, at least one each."""
    if not weights:
        return {}
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources do not fit into {period} slots")
    if min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    names = sorted(weights, key=lambda s: (s is not None, s))
    total, free = sum(weights.values()), period - len(names)
    exact = {s: weights[s] / total * free for s in names}
    shares = {s: 1 + int(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: int(exact[s]) - exact[s])[: period - sum(shares.values())]:
        shares[s] += 1
    return shares


def schedule(shares: Mapping[str | None, int]) -> list[tuple[str | None, int, int]]:
    """(source, block, slot) for one period: earliest deadline first among the released blocks."""
    period = sum(shares.values())
    names = sorted(shares, key=lambda s: (s is not None, s))
    waiting = [(0, place, 0) for place in range(len(names))]
    ready: list[tuple[int, int, int]] = []
    slots = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, place, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * period // shares[names[place]]), place, block))
        _, place, block = heapq.heappop(ready)
        slots.append((names[place], block, slot))
        if block + 1 < shares[names[place]]:
            heapq.heappush(waiting, ((block + 1) * period // shares[names[place]], place, block + 1))
    return slots


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row, but for maps, which cannot be hashed."""
    return F.xxhash64(*[docs[f.name] for f in docs.schema if not f.dataType.simpleString().startswith("map")])


def _huffman(weights: Mapping[int, int]) -> dict[int, list[tuple[int, int, bool]]]:
    """For each class the steps (own weight, weight of both sides, left?) from it up to the root."""
    heap = [(w, c, [c]) for c, w in sorted(weights.items())]
    heapq.heapify(heap)
    steps: dict[int, list[tuple[int, int, bool]]] = {c: [] for c in weights}
    while len(heap) > 1:
        (v, _, right), (w, least, left) = heapq.heappop(heap), heapq.heappop(heap)
        for members, own, side in ((left, w, True), (right, v, False)):
            for c in members:
                steps[c].append((own, v + w, side))
        heapq.heappush(heap, (v + w, least, left + right))
    return steps


STEPS = "array<struct<own: bigint, both: bigint, left: boolean>>"


def paths(weights: DataFrame) -> DataFrame:
    """(of, steps): the steps from each source up to the root. `weights` has one row (of, weight) per source."""
    spark = weights.sparkSession
    sound = F.col("weight").isNotNull() & (F.col("weight") > 0) & (F.col("weight") < float("inf"))
    checked = F.when(sound, F.col("weight")).otherwise(F.raise_error(F.lit("weights must be positive")).cast("double"))
    weights = stored(weights.select("of", checked.alias("weight")), "mixing-weights")
    total = weights.agg(F.sum("weight")).first()[0]
    if total is None:
        return spark.createDataFrame([], f"of string, steps {STEPS}")
    own = F.greatest(F.round(F.col("weight") / F.lit(total) * F.lit(float(TOTAL))).cast("bigint"), F.lit(1).cast("bigint"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("of")).cast("bigint") - 1
    sized = weights.select("of", own.alias("own")).withColumn("class", F.length(F.bin("own")))
    leaves = stored(sized.withColumn("node", rank), "mixing-leaves")

    # At most forty classes, whatever the number of sources.
    classes = leaves.groupBy("class").agg(F.sum("own").alias("own"), F.count("*").alias("n")).collect()
    above = _huffman({r["class"]: r.own for r in classes})
    depth = max((r.n - 1).bit_length() for r in classes)
    top = spark.createDataFrame(list(above.items()), f"class int, above {STEPS}")

    levels = leaves.select(
        "of", "class", "own", F.col("node").alias("leaf"), F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    ).withColumn("node", F.expr("shiftright(leaf, level)"))
    sums = stored(levels.groupBy("class", "level", "node").agg(F.sum("own").alias("own")), "mixing-nodes")
    parents = sums.select("class", (F.col("level") - 1).alias("level"), F.col("node").alias("up"), F.col("own").alias("both"))
    steps = levels.drop("own").join(sums, ["class", "level", "node"])
    steps = steps.withColumn("up", F.expr("shiftright(node, 1)")).join(parents, ["class", "level", "up"])
    step = F.struct("level", "own", "both", (F.col("node") % 2 == 0).alias("left"))
    # A node without a sibling hands its slots on as they are.
    below = steps.where("own < both").groupBy("class", "leaf").agg(F.sort_array(F.collect_list(step)).alias("found"))
    below = below.select("class", F.col("leaf").alias("node"), F.expr("transform(found, x -> struct(x.own, x.both, x.left))").alias("below"))
    joined = leaves.join(below, ["class", "node"], "left").join(F.broadcast(top), "class")
    none = F.array().cast(STEPS)
    return joined.select("of", F.concat(F.coalesce(F.col("below").cast(STEPS), none), F.col("above").cast(STEPS)).alias("steps"))


# The slot, counted from one, at the upper node of the j-th slot of one of its sides. With f = own / both the
# left side has floor(m f + 1/2) of the first m slots and the right side the others.
_HALVES = "(cast(2 * j - 1 as decimal(19,0)) * cast(s.both as decimal(14,0)))"
_TWICE = "cast(2 * s.own as decimal(15,0))"
SLOT = f"""aggregate(steps, block + 1, (j, s) -> if(s.left,
    cast(({_HALVES} + {_TWICE} - 1) div {_TWICE} as bigint), cast({_HALVES} div {_TWICE} as bigint) + 1)) - 1"""


def as_table(spark: SparkSession, weights: Weights) -> DataFrame:
    """Weights as rows (of, weight)."""
    if isinstance(weights, DataFrame):
        return weights.select(F.col("source").cast("string").alias("of"), F.col("weight").cast("double"))
    return spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "of string, weight double")


def places(docs: DataFrame, weights: Weights, block: int = 16) -> DataFrame:
    """doc_id, row (a hash), source, block, slot and place (within the block) of every row.

    Sorting by slot and place gives the mix. `docs` needs doc_id and source; `weights` is a mapping or a table
    with the columns source and weight. A source may hold any share
    of the rows: ranges of the order, not sources, are what tasks work on.
    """
    spark = docs.sparkSession
    order = ["source", "doc_id", "row"]
    keys = docs.select(F.col("doc_id").cast("bigint"), row_hash(docs).alias("row"), F.col("source").cast("string"))
    keys = stored(keys, "mixing-keys")
    ranged = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mixing")
    counts = ranged.groupBy("part", "source").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")
    counts = counts.select(F.col("part").alias("p"), F.col("source").alias("s"), before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("part", "source").orderBy("doc_id", "row")) - 1
    same = (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    numbered = ranged.withColumn("inside", inside).join(counts, same)
    at = F.col("before") + F.col("inside")

    blocks = numbered.select(
        "doc_id", "row", "source", F.floor(at / block).alias("block"), (at % block).cast("int").alias("place")
    )
    steps = stored(paths(as_table(spark, weights)), "mixing-paths")
    dealt = blocks.join(steps, F.col("source").eqNullSafe(F.col("of")), "left")
    known = F.when(F.col("steps").isNull(), F.raise_error(F.lit("a source has no weight"))).otherwise(F.expr(SLOT))
    return dealt.select("doc_id", "row", "source", "block", known.cast("bigint").alias("slot"), "place")


def tempered(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """Target weights (source, weight) that flatten the sizes of the sources: their counts to a power below 1."""
    counted = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    return counted.select("source", F.pow("n", F.lit(power)).alias("weight"))


def placed(docs: DataFrame, weights: Weights, block: int = 16) -> DataFrame:
    """The documents with slot and place, in the order of the mix: file by file and row by row, if they are written."""
    of_id, of_row, own, spots, spot = (unused(c, docs.columns) for c in ("of_id", "of_row", "own_row", "spots", "spot"))
    where = places(docs, weights, block).select(F.col("doc_id").alias(of_id), F.col("row").alias(of_row), "slot", "place")
    found = where.groupBy(of_id, of_row).agg(F.collect_list(F.struct("slot", "place")).alias(spots))
    single = docs.withColumn(own, row_hash(docs)).dropDuplicates(["doc_id", own])
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_row))
    spread = single.join(found, same).withColumn(spot, F.explode(spots))
    ordered = spread.repartitionByRange(spot).sortWithinPartitions(spot)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("slot", "place")]
    return ordered.select(*kept, F.col(f"{spot}.slot").alias("slot"), F.col(f"{spot}.place").alias("place"))


def mixed(docs: DataFrame, weights: Weights, block: int = 16) -> DataFrame:
    """The documents in the order of the mix, with the columns they have."""
    renamed = {"slot": "_slot", "place": "_place"}
    found = placed(docs.withColumnsRenamed(renamed), weights, block)
    return found.select(*[F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns])
