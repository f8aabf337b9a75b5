"""Exact dedup through an extendible-hash index on shared files, in DataFrame operations only.

Texts are equal when identical after each run of white space (``[\\x20\\x09-\\x0D]+``) became one space; a
null text counts as empty. The index is built in three steps:

1. *Rows.* Every text is normalised and hashed once; id, key (its 64-bit hash), length and digest are written down.
2. *Directory.* The high bits of a key address buckets. From the depth that the number of keys asks for, a bucket of more than
   ``capacity`` keys is split by one more bit, round after round, up to ``MAX_DEPTH`` bits; then the capacity has to grow with the
   data, so the directory never has more than 2^16 slots, whatever the table, and can be sent to every task.
3. *Index.* Whole texts are dealt by the directory's address and their key; copies are combined inside map tasks first, so a text that
   holds a third of all rows reaches the shuffle once per task. The owner of a key compares the bytes of what comes with it: equal
   texts become one entry, whose row with the smallest id stays, different ones form a chain and are numbered along it.
   The index is written to the shared folder by ranges of address and key.
4. *Lookup.* A row finds its entry by address, key and chain; without a slot for its key it would find none.

Defined results: a null ``doc_id`` counts as larger than any other; rows that repeat both ``doc_id`` and
text are one document, with one decision in ``decide`` and one row after ``drop_copies``; an empty table gives an empty result;
other columns, of whatever name, pass through.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm import prefilter
from tremorlake.session import work_folder

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Keys a bucket holds before it splits.
CAPACITY = 2048
#: Bits of the key that can address a bucket: as many as number the directory's slots.
MAX_DEPTH = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def _prefix(depth: int, key: str = "key") -> Column:
    """The bucket number at a depth: that many high bits of the key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, folder: str, capacity: int = CAPACITY) -> DataFrame:
    """slot, address and depth: for each of the key's leading ``MAX_DEPTH`` bits that occurs, the bucket it belongs to.

    The driver sees one number a round.
    """
    spark = keys.sparkSession

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    slots = stored(keys.select("key").distinct().groupBy(_prefix(MAX_DEPTH).alias("slot")).agg(F.count(F.lit(1)).alias("load")), "slots")
    total = slots.agg(F.sum("load")).first()[0] or 0
    capacity = max(capacity, -(-total >> (MAX_DEPTH - 1)))
    depth = min(MAX_DEPTH, max(0, (total - 1).bit_length() - (capacity.bit_length() - 1))) if total else 0
    # A slot stays where the bucket of its leading bits isn't overfull; of the others one more bit counts.
    left, settled = slots, None
    while True:
        bucket = F.shiftright("slot", MAX_DEPTH - depth).alias("bucket")
        sized = left.withColumn("bucket", bucket).join(
            left.groupBy(bucket).agg(F.sum("load").alias("held")), "bucket")
        fits = F.col("held") <= capacity if depth < MAX_DEPTH else F.lit(True)
        done = stored(sized.filter(fits).select("slot", F.shiftleft("bucket", 64 - depth).alias("address") if depth else F.lit(0).cast(
            "long").alias("address"), F.lit(depth).alias("depth")), f"depth-{depth}")
        settled = done if settled is None else settled.unionByName(done)
        if depth == MAX_DEPTH:
            return settled
        left = stored(sized.filter(~fits).select("slot", "load"), f"overfull-{depth}")
        if left.isEmpty():
            return settled
        depth += 1


def _addressed(keyed: DataFrame, slots: DataFrame) -> DataFrame:
    """Rows with a key and, from the directory, the address of its bucket; at most 2^MAX_DEPTH slots are sent to the tasks."""
    return keyed.join(F.broadcast(slots.select("slot", "address", "depth")), _prefix(MAX_DEPTH) == F.col("slot")).drop("slot")


def _hashed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("norm"))
    return rows.select("doc_id", F.xxhash64("norm").alias("key"), F.length("norm").alias("chars"), F.sha2("norm", 256).alias("text_sha256"))


def _entries(docs: DataFrame, slots: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The index: one row per distinct normalised text, dealt by address and key, its bytes compared by the grouping."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(F.col(text)).alias("norm")).withColumn(
        "key", F.xxhash64("norm"))
    owned = _addressed(rows, slots).groupBy("address", "depth", "key", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return owned.select("address", "depth", "key", F.length("norm").alias("chars"), F.sha2("norm", 256).alias("text_sha256"),
                        "keep_id", "group_size")


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                directory_of=directory) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index of a table's texts, read back from the shared folder it was written to; its directory; and the hashed rows.

    Columns of the index: address and depth of the bucket, key, chain (place among entries of one key), chars,
    text_sha256, keep_id, group_size.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "exact-dedup")
    _hashed(docs, doc_id, text).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    slots = directory_of(rows, f"{folder}/directory", capacity)
    _entries(docs, slots, doc_id, text).write.parquet(f"{folder}/entries")
    chain = Window.partitionBy("address", "key").orderBy("chars", "text_sha256")
    owned = spark.read.parquet(f"{folder}/entries").repartitionByRange("address", "key").withColumn("chain", F.row_number().over(chain))
    owned.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index"), slots, rows


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           directory_of=directory) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``."""
    index, slots, rows = build_index(docs, doc_id, text, capacity, directory_of)
    found = _addressed(rows, slots).join(index.select("address", "key", "chars", "text_sha256", "keep_id", "group_size"),
                                         ["address", "key", "chars", "text_sha256"])
    return found.select(F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; one row for each distinct text."""
    index, slots, _ = build_index(docs, doc_id, text, capacity)
    # The whole row lies in one column, so no name of its own can clash with one of these.
    hashed = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(normalised(F.col(text))).alias("key"))
    copies = index.filter("group_size > 1")
    several, single = prefilter.split(hashed, F.col("key"), copies.select("key"))
    keep = index.select(F.col("keep_id").alias("k_id"), F.col("key").alias("k_key"), F.col("address").alias("k_address"))
    kept = _addressed(several, slots).hint("merge").join(
        keep, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("key") == F.col("k_key")) & (F.col("address") == F.col("k_address")), "left_semi")
    twins = Window.partitionBy("id", "key", "address").orderBy("id")  # the join has dealt and sorted them so
    once = kept.withColumn("twin", F.row_number().over(twins)).filter("twin = 1")
    return single.select("row.*").unionByName(once.select("row.*"))
