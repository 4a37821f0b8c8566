"""Mixing sources to target weights.

The texts of a source are dealt over buckets by a hash of the id, laid end to end in a pseudorandom order
within each bucket, and cut into blocks of a fixed number of words (the last block of a bucket may be
shorter). Small sources are one bucket; a bucket has about ``BUCKET_WORDS`` words, so a source that holds
a third of all rows is cut like any other.

Output shards have a fixed number of slots, and each slot draws its source by weight: the counts of a shard
are a multinomial draw. Over all shards a source then has some slots more or less than its target asks for;
slots beyond it are handed to sources that lack some, so that totals equal the targets to a block. The
slots of a source are numbered over all shards and mapped to its blocks by a pseudorandom permutation of
the block indexes per pass over the source. Slots and words then meet in a join on (source, bucket, block),
which gives the text of each slot.

Texts are shuffled once, by (source, bucket): blocks are cut, put together and joined where their bucket
lies, and slots, which are numbers only, come to them. Everything is derived from hashes of values: a
rerun gives the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.session import settled, work_dir

WEIGHTS = (5, 2, 1)
MOST = 3  # times a source may be repeated
BLOCK = 64  # words
SLOTS = 65_536  # of a shard
FINE = 1 << 16  # buckets a source can have at most
BUCKET_WORDS = 1 << 18
CELLS = 1024  # of the range that slots draw from
WORD = r"[^\x20\x09-\x0D]+"
# Primes that multiply slot numbers; one that does not divide the number of blocks permutes them.
PRIMES = [2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497]
_BUCKET = ["rank", "bucket"]


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) with ``rank`` by code point (null last), ``weight`` and ``target``.

    Targets share the sum of all sizes by weight. A source's target stops at ``most`` times its size;
    the excess is shared by weight among the others until none is above. The table has one row per
    source.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_rank = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    df = sources.withColumn("rank", F.row_number().over(by_rank) - 1)
    df = df.withColumn("weight", F.get(cycle, F.col("rank") % len(weights))).withColumn("limit", (most * F.col("source_size")).cast("double"))
    # In the order in which sources reach their limit, the level at which the rest would share.
    by_level = Window.orderBy((F.col("limit") / F.col("weight")), "rank")
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    spent = F.coalesce(F.sum("limit").over(upto), F.lit(0.0))
    df = df.withColumn("level", (total - spent) / F.sum("weight").over(rest))
    free = F.col("limit") >= F.col("weight") * F.col("level")
    df = df.withColumn("share", F.min(F.when(free, F.struct(F.col("limit") / F.col("weight"), "rank", "level"))).over(everything)["level"])
    return df.select("source", "source_size", "rank", "weight", F.least("limit", F.coalesce(F.col("weight") * F.col("share"), F.col("limit"))).alias("target"))


def _with_wanted(plan: DataFrame, block: int) -> DataFrame:
    """``plan`` with the blocks of each source, as far as it has none yet, and the slots it is to get."""
    if "blocks" not in plan.columns:
        plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / block))
    return plan.withColumn("wanted", F.least(F.round(F.col("target") / block).cast("long"), MOST * F.col("blocks")))


def _drawn(plan: DataFrame, total: int, size: int, seed: int) -> DataFrame:
    """(rank, shard, slot): every slot of every shard draws a source, as likely as it has slots to get."""
    spark = plan.sparkSession
    width = -(-total // CELLS)
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    spans = plan.where("wanted > 0").withColumn("to", F.sum("wanted").over(upto)).withColumn("from", F.col("to") - F.col("wanted"))
    # Each source by the cells of the range it covers: a slot looks at those of its cell only.
    div = lambda c, n: F.call_function("div", c, F.lit(n))
    cells = F.sequence(div(F.col("from"), width), div(F.col("to") - 1, width))
    spans = settled(spans.select("rank", "from", "to", F.explode(cells).alias("cell")), "spans")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 20)
    rows = spark.range(0, total, 1, tasks).select(div(F.col("id"), size).alias("shard"), (F.col("id") % size).alias("slot"))
    rows = rows.withColumn("v", F.pmod(F.xxhash64(F.lit(seed), "shard", "slot"), F.lit(total))).withColumn("at", div(F.col("v"), width))
    met = rows.join(spans, (F.col("at") == F.col("cell")) & (F.col("v") >= F.col("from")) & (F.col("v") < F.col("to")))
    return met.select("rank", "shard", "slot")


def slots(plan: DataFrame, block: int = BLOCK, size: int = SLOTS, seed: int = 0) -> DataFrame:
    """(rank, shard, slot, block): the block of its source that each slot of each shard takes.

    ``plan`` is the result of ``targets``, perhaps with the number of ``blocks`` of each source; ``slot``
    counts within the shard.
    """
    spark = plan.sparkSession
    plan = settled(_with_wanted(plan, block).select("rank", "blocks", "wanted"), "wanted")
    total = plan.agg(F.sum("wanted")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], "rank int, shard long, slot long, block long")
    drawn = _drawn(plan, total, size, seed)
    # How many slots of a source each shard has, and those before; one row per source and shard.
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("rank", "shard").agg(F.count("*").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = settled(counts, "counts")
    got = plan.join(counts.groupBy("rank").agg(F.sum("n").alias("got")), "rank", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    # Slots beyond what a source is to get, and those that sources lack, are numbered alike over all sources.
    earlier = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    base = lambda c: F.coalesce(F.sum(F.greatest(c, F.lit(0))).over(earlier), F.lit(0))
    got = got.withColumns({"over": base(F.col("got") - F.col("wanted")), "under": base(F.col("wanted") - F.col("got"))})
    got = settled(got, "got")
    nth = F.row_number().over(Window.partitionBy("rank", "shard").orderBy("slot")) - 1
    rows = drawn.withColumn("nth", nth).join(counts.select("rank", "shard", "first"), ["rank", "shard"])
    rows = rows.withColumn("nth", F.col("first") + F.col("nth")).drop("first").join(got, "rank")
    own = rows.where("nth < wanted").select("rank", "shard", "slot", "nth", "blocks")
    free = rows.where("nth >= wanted").select("shard", "slot", (F.col("over") + F.col("nth") - F.col("wanted")).alias("free"))
    lacking = got.where("got < wanted").withColumn("nth", F.explode(F.sequence("got", F.col("wanted") - 1)))
    lacking = lacking.select("rank", "nth", "blocks", (F.col("under") + F.col("nth") - F.col("got")).alias("free"))
    rows = own.unionByName(free.join(lacking, "free").drop("free"))
    turn = F.floor(F.col("nth") / F.col("blocks"))
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("rank"), turn), F.lit(len(PRIMES)))
    # Eight primes in a row from a hashed start; a block count below 2 ** 62 cannot be divided by three of them.
    several = F.array(*[F.lit(p) for p in PRIMES + PRIMES[:2]])
    prime = F.filter(F.slice(several, start.cast("int") + 1, 3), lambda p: F.col("blocks") % p != 0)
    moved = (F.get(prime, F.lit(0)).cast("decimal(20,0)") * (F.col("nth") % F.col("blocks")).cast("decimal(18,0)")) + F.pmod(F.xxhash64(F.lit(seed), F.col("rank"), turn, F.lit("shift")), F.col("blocks"))
    return rows.select("rank", "shard", "slot", (moved % F.col("blocks")).cast("long").alias("block"))


def _counted(docs: DataFrame, id: str, text: str, source: str, seed: int) -> DataFrame:
    df = docs.select(F.col(id).alias("_id"), F.col(source).alias("_source"), F.col(text).alias("_text"))
    df = df.withColumn("size", F.coalesce(F.regexp_count("_text", F.lit(WORD)), F.lit(0)).cast("long"))
    return df.withColumn("fine", F.pmod(F.xxhash64(F.lit(seed), "_id", "size"), F.lit(FINE)))


def _bare(df: DataFrame) -> DataFrame:
    """Rows with their words counted and a hash of the text in its place, settled: words are counted here once."""
    return settled(df.withColumn("_hash", F.xxhash64("_text")).drop("_text"), "counted")


def _bucket(fine, n_buckets):
    return F.floor(fine * n_buckets / FINE).cast("int")


def _plan(df: DataFrame, block: int, bucket_words: int) -> tuple[DataFrame, DataFrame]:
    """The columns of ``targets`` with ``n_buckets`` and ``blocks``, a row per source; and (rank, bucket, first, blocks)."""
    fine = settled(df.groupBy("_source", "fine").agg(F.sum("size").alias("size")), "sizes")
    plan = targets(fine.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size")))
    buckets = F.least(F.lit(FINE), F.greatest(F.lit(1), F.ceil(F.col("source_size") / bucket_words)))
    plan = settled(plan.withColumn("n_buckets", buckets), "plan")
    cut = fine.join(plan, F.col("_source").eqNullSafe(F.col("source"))).select("rank", _bucket(F.col("fine"), F.col("n_buckets")).alias("bucket"), "size")
    cut = cut.groupBy(*_BUCKET).agg(F.ceil(F.sum("size") / block).alias("blocks")).where("blocks > 0")
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = settled(cut.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0))), "buckets")
    blocks = cut.groupBy(F.col("rank").alias("_rank")).agg(F.sum("blocks").alias("blocks"))
    plan = plan.join(blocks, F.col("rank") == F.col("_rank"), "left").drop("_rank").na.fill(0, ["blocks"])
    return settled(plan, "blocks"), cut


def _placed(df: DataFrame, plan: DataFrame, seed: int, more: list[str]) -> DataFrame:
    """(rank, bucket, start, size, more...): the place of each text among those of its bucket.

    Texts without words stay: to leave them out before the shuffle would count all words twice.
    """
    few = plan.select("source", "rank", "n_buckets")
    rows = df.withColumn("_hash", F.xxhash64("_text")) if "_text" in df.columns else df
    rows = rows.join(few, F.col("_source").eqNullSafe(F.col("source")))
    rows = rows.select("rank", _bucket(F.col("fine"), F.col("n_buckets")).alias("bucket"), "_id", "size", "_hash", *more)
    order = Window.partitionBy(*_BUCKET).orderBy(F.xxhash64(F.lit(seed + 1), "_id"), "_id", "size", "_hash")
    start = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("start", start).select(*_BUCKET, "start", "size", *more)


def _blocks(placed: DataFrame, block: int) -> DataFrame:
    """(rank, bucket, nth, text, parts): the words of each block of a bucket, joined by single spaces.

    ``parts`` has (start, words) of each text the block has words of, in order; (rank, bucket, start) names
    a text.
    """
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)

    def pieces(words):
        def piece(b):
            begin = F.greatest(F.lit(0), b * block - F.col("start"))
            end = F.least(F.col("size"), (b + 1) * block - F.col("start"))
            own = F.slice(words, begin.cast("int") + 1, (end - begin).cast("int"))
            return F.struct(b.alias("nth"), F.size(own).cast("long").alias("words"), F.array_join(own, " ").alias("text"))

        return F.transform(F.sequence(first.cast("long"), last.cast("long")), piece)

    # A list of one, so that a text is taken apart once and not for each piece.
    cut = F.transform(F.array(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))), pieces)
    spread = placed.select(*_BUCKET, "start", F.inline(F.get(cut, F.lit(0))))
    whole = spread.groupBy(*_BUCKET, "nth").agg(F.sort_array(F.collect_list(F.struct("start", "words", "text"))).alias("_pieces"))
    return whole.select(
        *_BUCKET, "nth", F.array_join("_pieces.text", " ").alias("text"),
        F.transform("_pieces", lambda p: F.struct(p["start"].alias("start"), p["words"].alias("words"))).alias("parts"),
    )


def _made(df: DataFrame, plan: DataFrame, cut: DataFrame, block: int, seed: int) -> DataFrame:
    """(shard, slot, rank, block, bucket, text, parts) of every slot."""
    taken = slots(plan, block, seed=seed)
    # Where each block lies. Both sides have a row per block; the planner cannot know.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lies = cut.repartition(tasks, *_BUCKET).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    lies = lies.select(*_BUCKET, "nth", (F.col("first") + F.col("nth")).alias("block"))
    wanted = taken.hint("merge").join(lies, ["rank", "block"])
    made = _blocks(_placed(df, plan, seed, ["_text"]).where("size > 0"), block).hint("merge").join(wanted, [*_BUCKET, "nth"])
    return made.select("shard", "slot", "rank", "block", "bucket", "text", "parts")


@contextmanager
def _by_bucket(spark: SparkSession) -> Iterator[None]:
    """While it lasts, rows that lie by (rank, bucket) are grouped and joined by more columns where they lie."""
    keys = ["spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.requireAllClusterKeysForDistribution"]
    had = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "false")
        yield
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)


def mixture(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    block: int = BLOCK, seed: int = 0, bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """The mix: (shard, slot, rank, block, source, text, parts), a row for each slot of each shard.

    ``text`` is the block of ``source`` that the slot takes: ``block`` words joined by single spaces, at
    the end of a bucket fewer. ``parts`` tells which texts they come from (see ``_blocks``). ``slot``
    counts within its shard over all sources. Nothing is in the mix of an empty table.
    """
    df = _counted(docs, id, text, source, seed)
    plan, cut = _plan(_bare(df), block, bucket_words)
    return _named(_made(df, plan, cut, block, seed), plan)


def _named(made: DataFrame, plan: DataFrame) -> DataFrame:
    return made.join(plan.select("rank", "source"), "rank").select("shard", "slot", "rank", "block", "bucket", "source", "text", "parts")


def mixed(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    block: int = BLOCK, seed: int = 0, folder: str | None = None, bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """(id, source, size, source_size, target, taken) of every row: words taken, repeats counted.

    The mix itself (see ``mixture``; sources by their rank) is written as parquet to ``folder``, by default
    a new one in the shared folder, and ``taken`` is counted in what was written. Null and blank texts have
    size 0 and are never taken. Rows without a source are a source of their own, last in order. Rows with
    equal or null ids are rows like any other. An empty table, or one without words, gives targets 0.
    """
    spark = docs.sparkSession
    df = _counted(docs, id, text, source, seed)
    bare = _bare(df)
    plan, cut = _plan(bare, block, bucket_words)
    folder = folder or work_dir(spark, "mix")
    made = _made(df, plan, cut, block, seed)
    with _by_bucket(spark):
        made.write.option("compression", "zstd").parquet(folder)
    mix = spark.read.schema(made.schema).parquet(folder)
    taken = mix.select(*_BUCKET, F.inline("parts")).groupBy(*_BUCKET, "start").agg(F.sum("words").alias("taken"))
    said = _placed(bare, plan, seed, ["_id"]).join(taken, [*_BUCKET, "start"], "left")
    # (rank, bucket, start) is unique among texts with words; others have the place of the next one.
    said = said.select("_id", "rank", "size", F.when(F.col("size") > 0, F.col("taken")).alias("taken"))
    rows = said.join(plan.select("rank", "source", "source_size", "target"), "rank")
    return rows.select(F.col("_id").alias(id), F.col("source").alias(source), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
