"""Two-pass external shuffle into shards.

Pass one scatters rows uniformly into buckets that fit a task's memory, by a seeded hash of key and row; equal rows
are numbered first, so that neither a repeated key nor a repeated row fills a bucket. Pass two gives each bucket
a Fisher-Yates permutation of its places: Spark's `shuffle` of the sequence of places, from a generator seeded by
the seed and the bucket range's task, over a fixed layout of tasks. The permutation depends on the seed and the buckets' sizes
only, so the same input gives the same order however often a task is run again. Buckets one after another are one
random order of all rows, which is cut into shards whose row counts differ by one at most (the law `rows`).

Defined cases: null ids and texts are hashed like other values; rows that repeat an id are told apart by the hash of
the row, and equal rows are interchangeable; more shards than rows leave shards empty; an empty table gives an empty
result; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import BROADCAST_ROWS, scratch, stored, without

#: Bytes of rows that one bucket may hold, and how many buckets one task permutes.
BUCKET_BYTES, BUCKETS_A_TASK = 64_000_000, 16
#: Equal rows that one task makes from a row and their number.
COPIES = 10_000
ADDED = ["shard", "slot"]


def permuted(sizes: DataFrame, buckets: int, seed: int) -> DataFrame:
    """(bucket, place, slot): a Fisher-Yates permutation of the places of each bucket, from sizes (bucket, n)."""
    spark = sizes.sparkSession
    every = spark.range(0, buckets, 1, -(-buckets // BUCKETS_A_TASK)).withColumnRenamed("id", "bucket")
    if buckets <= BROADCAST_ROWS:
        sized = every.join(F.broadcast(sizes), "bucket")
    else:  # the tasks of a range are a fixed layout too
        sized = every.join(sizes, "bucket").repartitionByRange(-(-buckets // BUCKETS_A_TASK), "bucket").sortWithinPartitions("bucket")
    order = F.shuffle(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), seed)
    return stored(sized.select("bucket", F.posexplode(order).alias("slot", "place")))


def row_bytes(docs: DataFrame) -> Column:
    """Bytes of a row: what its texts and nested values hold, and 8 for each column."""
    sizes = [F.lit(8 * len(docs.columns)).cast("long")]
    for f in docs.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0)))
    return sum(sizes[1:], sizes[0])


def scatter(docs: DataFrame, buckets: int, *, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """docs with _row (hash of the row) and _bucket. Rows that are equal are counted, and made again with a number each."""
    columns = [f"`{c}`" for c in docs.columns]
    rows = docs.withColumn("_row", F.xxhash64(*[F.col(c) for c in columns]))
    repeated = stored(rows.groupBy("_row").agg(F.count("*").alias("n")).where("n > 1").select(F.col("_row").alias("_again")))
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    same = F.col("_row") == F.col("_again")
    once = rows.join(repeated, same, "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    again = rows.join(repeated, same, "left_semi").groupBy(*columns, "_row").agg((F.count("*") - 1).alias("_last"))
    again = again.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(COPIES).cast("long"))))
    again = again.repartition("_row", "_from").withColumn("_copy", F.explode(F.sequence("_from", F.least("_last", F.col("_from") + COPIES - 1))))
    every = once.unionByName(again.select(*columns, "_row", "_copy"))
    return every.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("_row"), F.col("_copy")), F.lit(buckets))).drop("_copy")


def shuffled(docs: DataFrame, shards: int, *, key: str = "doc_id", size: str | None = None, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    size: a column with each row's bytes, from which the number of buckets follows; None counts the bytes of its values.
    """
    docs = without(docs, ADDED)
    total = docs.agg(F.count("*").alias("n"), F.sum(F.col(size) if size else row_bytes(docs)).alias("b")).first()
    n, buckets = total.n, max(1, -(-int(total.b or 0) // bucket_bytes))
    scattered = scatter(docs, buckets, key=key, seed=seed)
    sizes = stored(scattered.groupBy("_bucket").agg(F.count("*").alias("n")).withColumnRenamed("_bucket", "bucket"))
    # a row per bucket: the running sum over all buckets is small
    offsets = sizes.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("offset"))
    places = permuted(sizes, buckets, seed).join(F.broadcast(offsets) if buckets <= BROADCAST_ROWS else offsets, "bucket")
    places = places.select(F.col("bucket").alias("_b"), F.col("place").alias("_p"), (F.col("offset") + F.col("slot")).alias("_at"))
    in_order = Window.partitionBy("_bucket").orderBy(F.xxhash64(F.lit(seed + 1), F.col(key)), F.col(key), "_row")
    placed = scattered.withColumn("_place", (F.row_number().over(in_order) - 1).cast("long"))
    placed = placed.join(places, (F.col("_bucket") == F.col("_b")) & (F.col("_place") == F.col("_p")))
    shard = F.expr(f"(_at * {shards}L) div {max(n, 1)}L")
    first = F.expr(f"(((_at * {shards}L) div {max(n, 1)}L) * {n}L + {shards - 1}L) div {shards}L")
    return placed.select(*[f"`{c}`" for c in docs.columns], shard.cast("int").alias("shard"), (F.col("_at") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, **settings) -> None:
    """Writes each shard's rows in slot order below path/shard=<k>/. A shard is dealt to several tasks by slot range."""
    spark, setting = docs.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    # the rows lie by bucket already, so the join of their places needn't deal the texts again
    spark.conf.set(setting, "false")
    try:
        placed = shuffled(docs, shards, **settings)
        tasks = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
        placed.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    finally:
        spark.conf.set(setting, before)


def op8_shuffled_shards(spark, sf_dir: str) -> DataFrame:
    """The documents written as 40 shards, whole; size, checksum and place of each are read back from the shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch(spark, "shards")
    write_shards(docs, path, 40)
    back = spark.read.schema(T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])).parquet(path)
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size")
    return back.select("doc_id", size, F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
