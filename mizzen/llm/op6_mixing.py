"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Main path: DataFrame operations only.

1. Targets. Sources in code-point order, null last, weigh 5, 2, 1, repeating, and share 100% of all
   words. No target exceeds ``most`` times its source's size; the excess is shared among the others
   by weight until none is above. Each step of that is one aggregate over the sources.
2. Blocks. A source's documents are dealt by hash into at most ``MOST_BLOCKS`` blocks, which are
   disjoint and whose numbers, in the order of a second hash, are a random permutation. Whole
   passes over the source are taken while they fit; in the last pass whole blocks are drawn in
   permuted order while they fit, and the next block gives documents, in hash order, that fit
   in what is left. What is taken falls short of the target by less than one document.
3. Tree. The drawn blocks of all sources are exact quotas. A node of the tree splits its quotas
   between its two halves of the output shards: the left half's share is filled from the node's
   blocks without replacement, so the counts by source are multivariate hypergeometric: one
   hypergeometric draw a source after the other, from hashed uniforms, and so reruns agree. At the leaves each shard has a
   quota for every source, and takes that many of the source's blocks in permuted order.
4. Within a shard rows carry a hashed ``order`` to be sorted by locally.

A source may hold most rows: its words are summed before the shuffle, and its rows are spread by
block afterwards. One task at most sees one row per block or per source, never a source's rows.

Defined results: null or empty text has size 0 and is taken 0 words; a null id is mixed like any
other; repeated rows are documents of their own; a source of null is a source; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from math import ceil, lgamma, log, pi

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut, fits
from .text import let, words

WEIGHTS = (5, 2, 1)
#: Documents in a block, about, until a source has ``MOST_BLOCKS``.
BLOCK_DOCUMENTS = 128
MOST_BLOCKS = 65_536
#: Words in a shard, about, where there are more than ``LEAST_SHARDS`` of them.
SHARD_WORDS, LEAST_SHARDS = 50_000_000, 16
#: Sources up to which their table is broadcast.
BROADCAST_SOURCES = 100_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: shares by weight, at most ``most`` times the size."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = cut(sizes.withColumn("weight", weigh))
    cap, rate = F.col("source_size") * F.lit(float(most)), 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(rate)
        total, held, open_ = weighed.agg(F.sum("source_size"), F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not total or not open_ or (total - held) / open_ <= rate:
            break
        rate = (total - held) / open_
    return weighed.withColumn("target", F.least(cap, F.col("weight") * F.lit(rate)))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def _log_factorial(x: Column) -> Column:
    """Of a whole number that isn't negative: by table up to 9, beyond by Stirling's series."""
    table = F.array(*[F.lit(lgamma(k + 1)) for k in range(10)])
    large = (x + 0.5) * F.log(x) - x + 0.5 * log(2 * pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(x < 10, F.get(table, x.cast("int"))).otherwise(large)


def _drawn(n: Column, places: Column, blocks: Column, uniform: Column) -> Column:
    """How many of a source's ``n`` blocks are among ``places`` drawn from ``blocks``: hypergeometric, by inversion.

    The chances are gone through from the likeliest count outward, both ways at once, for ten standard deviations;
    a double has no room for what lies beyond.
    """

    def inverted(a: Column) -> Column:
        n, places, blocks, mode = (a[c] for c in ("n", "places", "blocks", "mode"))
        others = blocks - n - places
        ways = lambda x, k: _log_factorial(x) - _log_factorial(k) - _log_factorial(x - k)
        top = F.exp(ways(n, mode) + ways(blocks - n, places - mode) - ways(blocks, places))
        share = n / F.greatest(blocks, F.lit(1.0))
        spread = F.sqrt(F.greatest(places * share * (1 - share) * (blocks - places) / F.greatest(blocks - 1, F.lit(1.0)), F.lit(0.0)))
        steps = F.sequence(F.lit(1), F.least(F.ceil(10 * spread) + 10, a["n"] + 1).cast("int"))

        def step(s: Column, i: Column) -> Column:
            up = s["up"] * (n - s["high"]) * (places - s["high"]) / ((s["high"] + 1) * (others + s["high"] + 1))
            down = s["down"] * s["low"] * (others + s["low"]) / ((n - s["low"] + 1) * (places - s["low"] + 1))
            left = s["left"] - up
            found = F.when(left < 0, s["high"] + 1).when(left < down, s["low"] - 1)
            moved = F.struct((left - down).alias("left"), up.alias("up"), down.alias("down"), (s["high"] + 1).alias("high"), (s["low"] - 1).alias("low"), found.alias("found"))
            return F.when(s["found"].isNotNull(), s).otherwise(moved)

        first = F.struct((a["u"] - top).alias("left"), top.alias("up"), top.alias("down"), mode.alias("high"), mode.alias("low"), F.when(a["u"] < top, mode).alias("found"))
        return F.coalesce(F.aggregate(steps, first, step)["found"], mode).cast("bigint")

    low, high = F.greatest(places + n - blocks, F.lit(0)), F.least(n, places)
    mode = F.least(F.greatest(F.floor((places + 1) * (n + 1) / (blocks + 2)), low), high)
    given = F.struct(*[x.cast("double").alias(c) for c, x in (("n", n), ("places", places), ("blocks", blocks), ("mode", mode))], uniform.alias("u"))
    return F.when((n == 0) | (places == 0), F.lit(0).cast("bigint")).otherwise(let(given, inverted))


def _split(quotas: Column, left: Column, total: Column, node: Column, seed: int) -> Column:
    """How many of each source's blocks go left, when ``left`` of all ``total`` blocks do.

    One draw a source, each from the places and blocks that the sources before it have left.
    """

    def source(state: Column, q: Column) -> Column:
        drawn = _drawn(q["n"], state["places"], state["blocks"], _uniform(F.lit(seed), node, q["k"]))
        return let(drawn, lambda x: F.struct((state["places"] - x).alias("places"), (state["blocks"] - q["n"]).alias("blocks"), F.array_append(state["taken"], F.struct(q["k"].alias("k"), x.alias("n"))).alias("taken")))

    start = F.struct(left.alias("places"), total.alias("blocks"), F.array().cast("array<struct<k:bigint,n:bigint>>").alias("taken"))
    return F.aggregate(quotas, start, source, lambda s: s["taken"])


def split_quotas(quotas: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """Rows (shard, source_no, n) from exact ``quotas`` (source_no, n): the leaves of the splitting tree.

    Shards are numbered from 0 and get equal numbers of blocks, to one.
    """
    pack = F.array_sort(F.collect_list(F.struct(F.col("source_no").alias("k"), F.col("n").cast("bigint").alias("n"))))
    nodes = quotas.agg(pack.alias("quotas")).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "quotas")
    width = shards
    while width > 1:
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, q: a + q["n"])
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        # Blocks up to the middle, so that rounding never gives a shard two more than another.
        share = F.floor(total * (middle - F.col("low")) / (F.col("high") - F.col("low"))).cast("bigint")
        whole = nodes.select("low", "high", "quotas", middle.alias("mid"), total.alias("total"), share.alias("share")).where("high > low")
        taken = whole.withColumn("left", _split(F.col("quotas"), F.col("share"), F.col("total"), F.xxhash64("low", "high"), seed))
        rest = F.zip_with("quotas", "left", lambda q, t: F.struct(q["k"].alias("k"), (q["n"] - t["n"]).alias("n")))
        halves = F.array(
            F.struct(F.col("low").alias("low"), F.col("mid").alias("high"), F.col("left").alias("quotas")),
            F.struct(F.col("mid").alias("low"), F.col("high").alias("high"), rest.alias("quotas")),
        )
        split = F.when(F.col("high") - F.col("low") > 1, halves).otherwise(F.array(F.struct("low", "high", "quotas")))
        nodes = taken.select(F.explode(split).alias("h")).select("h.low", "h.high", "h.quotas")
        width = (width + 1) // 2
    leaves = cut(nodes)
    return leaves.select(F.col("low").alias("shard"), F.explode("quotas").alias("q")).select("shard", F.col("q.k").alias("source_no"), F.col("q.n").alias("n"))


def _filled(room: Column, block: list[str]) -> tuple[list[tuple], Column]:
    """Whether a row of a block is among those taken in hash order while they fit in ``room`` words.

    Twice more the rows left over are gone through for those that fit in what is left.
    """
    inside = Window.partitionBy(*block).orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*block)
    steps, taken, left = [], F.lit(False), room
    for k in range(3):
        able = ~taken & (F.col("size") <= left)
        reached = F.sum(F.when(able, F.col("size")).otherwise(F.lit(0))).over(inside)
        steps.append((f"__able{k}", able, f"__sum{k}", reached))
        fits_ = F.col(f"__able{k}") & (F.col(f"__sum{k}") <= left)
        used = F.max(F.when(fits_, F.col(f"__sum{k}"))).over(whole)
        steps.append((f"__took{k}", taken | fits_, f"__left{k}", left - F.coalesce(used, F.lit(0))))
        taken, left = F.col(f"__took{k}"), F.col(f"__left{k}")
    return steps, taken


def mixture(docs: DataFrame, shards: int | None = None, most: int = 3, seed: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, version, source, size, source_size, target, takes.

    ``takes`` lists the times the document is taken, as structs of pass, shard and order; a document's
    words in the mixture are ``size`` times the length of ``takes``. ``version`` is a hash of the text. The
    number of ``shards`` follows from the words to be taken unless it is given.
    """
    size = F.size(words(F.col("text"))).cast("bigint")
    version = F.xxhash64("text")
    sized = cut(docs.select("doc_id", version.alias("version"), "source", F.xxhash64(F.lit(seed), "doc_id", version).alias("draw"), size.alias("size")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint")
    n_blocks = F.least(F.ceil(F.col("n") / BLOCK_DOCUMENTS), F.lit(MOST_BLOCKS))
    plan = cut(targets(sources, most=most).withColumn("source_no", number).withColumn("n_blocks", n_blocks).drop("n", "weight"))
    if shards is None:
        shards = max(LEAST_SHARDS, ceil((plan.agg(F.sum("target")).first()[0] or 0) / SHARD_WORDS))
    # One row a source, of a few numbers: broadcast if it is proven small.
    of_source = plan.withColumnRenamed("source", "of_source")
    of_source = F.broadcast(of_source) if fits(of_source, BROADCAST_SOURCES) else of_source
    placed = sized.join(of_source, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.col("n_blocks")))

    # Blocks in permuted order, with the words before each: one row a block.
    sums = placed.groupBy("source_no", "block").agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("source_no").orderBy(F.xxhash64(F.lit(seed + 2), "source_no", "block"), "block")
    ranked = sums.join(plan.drop("source"), "source_no").withColumn("rank", F.row_number().over(permuted).cast("bigint") - 1)
    before = F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(F.lit(0)).cast("int")
    # ``room``: words that the last pass still has when it reaches this block.
    drawn = ranked.withColumn("full", full).withColumn("room", F.col("target") - F.col("full") * F.col("source_size") - before)
    drawn = cut(drawn.select("source_no", "block", "rank", "full", "room", F.count(F.lit(1)).over(Window.partitionBy("source_no")).alias("of")))
    counts = drawn.groupBy("source_no").agg(F.sum(F.col("full") + (F.col("room") > 0).cast("int")).alias("n"))

    # The i-th block that a source gives goes to the shard in whose quota i falls: a row for each block taken.
    up_to = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotas = split_quotas(counts, shards, seed).withColumn("high", F.sum("n").over(up_to)).where("n > 0")
    dealt = quotas.select("source_no", "shard", F.explode(F.sequence(F.col("high") - F.col("n"), F.col("high") - 1)).alias("at"))
    last = F.when(F.col("room") > 0, F.col("full")).otherwise(F.col("full") - 1)
    passes = F.filter(F.sequence(F.lit(0), F.col("full")), lambda p: p <= last)
    asked = drawn.select("source_no", "block", "rank", "full", "room", "of", F.explode_outer(passes).alias("pass")).withColumn("at", F.col("pass") * F.col("of") + F.col("rank"))
    given = F.collect_list(F.when(F.col("pass").isNotNull(), F.struct("pass", "shard")))
    plans = asked.join(dealt, ["source_no", "at"], "left").groupBy("source_no", "block", "full", "room").agg(F.sort_array(given).alias("plans"))

    rows = placed.join(plans, ["source_no", "block"])
    steps, taken = _filled(F.greatest("room", F.lit(0.0)), ["source_no", "block"])
    for name, value, name2, value2 in steps:
        rows = rows.withColumn(name, value).withColumn(name2, value2)
    mine = F.filter("plans", lambda p: (p["pass"] < F.col("full")) | taken)
    order = lambda p: F.xxhash64(F.lit(seed + 3), F.col("draw"), p["pass"], p["shard"])
    takes = F.transform(mine, lambda p: F.struct(p["pass"].alias("pass"), p["shard"].alias("shard"), order(p).alias("order")))
    return rows.select("doc_id", "version", "source", "size", "source_size", "target", takes.alias("takes"))


def shuffled_shards(mixed: DataFrame, docs: DataFrame) -> DataFrame:
    """The mixture itself: a row of ``docs`` for each time it is taken, with its shard, order, pass and words.

    Each shard is together and sorted by ``order``. ``mixed`` is ``mixture(docs)``; its columns come after those
    of ``docs``, where ``shard``, ``order``, ``pass`` and ``taken`` must not be in use. Rows with one id, source and
    text share out what each of them was given.
    """
    own, key = [F.col(c) for c in docs.columns], ["doc_id", "version", "source"]
    times = mixed.select(*[F.col(c).alias(f"__mizzen_{c}") for c in key], "size", "takes")
    given = times.groupBy(*[f"__mizzen_{c}" for c in key]).agg(F.first("size").alias("__mizzen_size"), F.flatten(F.collect_list("takes")).alias("__mizzen_takes"), F.count(F.lit(1)).alias("__mizzen_of"))
    given = cut(given)
    rows = docs.withColumn("__mizzen_text", F.xxhash64("text"))
    if not given.where("__mizzen_of > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "source", "__mizzen_text"])
    same = F.col("doc_id").eqNullSafe(F.col("__mizzen_doc_id")) & (F.col("__mizzen_text") == F.col("__mizzen_version")) & F.col("source").eqNullSafe(F.col("__mizzen_source"))
    taken = rows.join(given, same).select(*own, "__mizzen_size", F.explode("__mizzen_takes").alias("__mizzen_t"))
    out = taken.select(*own, *[F.col(f"__mizzen_t.{c}").alias(c) for c in ("shard", "order", "pass")], F.col("__mizzen_size").alias("taken"))
    return out.repartition("shard").sortWithinPartitions("shard", "order")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("takes")).cast("bigint").alias("taken"), "takes")
