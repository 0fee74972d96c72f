"""Token-id files: an adaptive context-mixing range coder over blocks of ids.

An id's probability mixes what followed the two ids before it (order 2), the one before it (order 1) and how often it
stood in the block so far (order 0), with weights that adapt by the confidence of the contexts; arithmetic coding takes
that probability.  Blocks start from nothing and carry a checksum, so each can be read by itself.  The coder runs in
the executors' JVM (``java/RangeCoder.java``), and so do the vocabulary's merges for texts of Latin letters
(``java/ByteBpe.java``); Python has the library encode other texts and puts blocks together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jvm
from tidemark.llm.common import whole_text
from tidemark.llm.tokens import ByteBpe, TextCoder
from tidemark.plans.runtime import map_arrow

#: Ids of a block, 65,536 at most; blocks that a Python worker hands over at once.
BLOCK, AT_ONCE = 1 << 16, 8


def encoded(spark: SparkSession, ids: Column, vocab: int) -> Column:
    """A self-contained block of 1 to 65,536 ids below *vocab*, given as little-endian 32-bit integers."""
    return jvm.call(spark, "tidemark_range_encode", ids, F.lit(vocab))


def decoded(spark: SparkSession, block: Column) -> Column:
    """The ids of a block as little-endian 32-bit integers; a damaged block fails."""
    return jvm.call(spark, "tidemark_range_decode", block)


def latin_ids(spark: SparkSession, text: Column, path: str) -> Column:
    """The ids of texts of Latin letters and plain white space as little-endian 32-bit integers; null for the library's own."""
    spec = ByteBpe.open(path).merges()
    if spec is None:
        return F.lit(None).cast("binary")
    name = f"tidemark_bpe_{zlib.crc32(b''.join(spec[:2]))}"
    jvm.register(spark, name, "tidemark.ByteBpe", "binary", *spec)
    return F.call_udf(name, text)


_coders: dict[str, TextCoder] = {}


def _coder(path: str) -> TextCoder:
    if path not in _coders:
        bpe = ByteBpe.open(path)
        _coders[path] = TextCoder(bpe.words_ids, lambda t: np.array(bpe.ids(t), "<u4").tobytes(), b"".join, bpe.holds_added)
    return _coders[path]


#: part and seq order the blocks; piece is 0 for a block of whole documents, else counts the blocks of one longer document; at:
#: ids of the part before the block, or before that document; doc_from: where in the block each document starts.
FILE = "part int, seq long, piece int, at long, n_tokens long, doc_ids array<{kind}>, doc_from array<long>"


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, partitions: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the ids of all texts, each with *end_id* after it, in ascending order of (id, text hash) as a folder of token-id files.

    Files are Parquet with a coded block a row: any file system that Spark writes to serves, and a lost task leaves
    nothing behind.  A block holds whole documents, or a piece of one that is longer than a block.  Null ids come
    first, a null text is the empty text (its end id only), repeated rows each stay; an empty table gives a folder
    without blocks; other columns are not read.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).withColumn("h", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    order = [F.col("id").asc_nulls_first(), F.col("h")]
    tail = np.array([end_id], "<u4").tobytes()
    vocab = max(ByteBpe.open(tokenizer).size, end_id + 1)

    def stream(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, part, seq, before = _coder(tokenizer), TaskContext.get().partitionId(), 0, 0
        open_, n_open, ready, kinds = [], 0, [], None  # open_: (id, ids) of the documents of the block to come

        def close():
            nonlocal open_, n_open, seq, before
            if open_:
                sizes = [len(x) // 4 for _, x in open_]
                ready.append((part, seq, 0, before, n_open, [d for d, _ in open_], [0, *np.cumsum(sizes[:-1]).tolist()], b"".join(x for _, x in open_)))
                seq, before, open_, n_open = seq + 1, before + n_open, [], 0

        def out():
            types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(kinds), pa.list_(pa.int64()), pa.binary()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types)], [*(f.split()[0] for f in FILE.split(", ")), "ids"])
            ready.clear()
            return made

        for batch in batches:
            kinds = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for doc, text, ids in zip(*(c.to_pylist() for c in piece.columns)):
                    ids = (encode(text) if ids is None else ids) + tail
                    size = len(ids) // 4
                    if n_open + size > BLOCK:
                        close()
                    if size > BLOCK:
                        for k in range(0, size, BLOCK):
                            ready.append((part, seq, k // BLOCK + 1, before, min(BLOCK, size - k), [doc], [0], ids[4 * k : 4 * (k + BLOCK)]))
                            seq += 1
                            if len(ready) >= AT_ONCE:
                                yield out()
                        before += size
                    else:
                        open_.append((doc, ids))
                        n_open += size
                    if len(ready) >= AT_ONCE:
                        yield out()
        close()
        if ready:
            yield out()

    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text", latin_ids(spark, F.col("text"), tokenizer).alias("ids"))
    dealt = dealt.select("id", F.when(F.col("ids").isNull(), F.col("text")).alias("text"), "ids")
    made = map_arrow(dealt, stream, FILE.format(kind=kind) + ", ids binary")
    made.withColumn("block", encoded(spark, F.col("ids"), vocab)).drop("ids").write.parquet(path)


def read_packed(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, start, packed) for each document of a folder of token-id files: its ids as little-endian 32-bit integers.

    Blocks are decoded where they are read and whole documents are cut out of them there; only the pieces of documents
    longer than a block are shuffled.
    """
    files = spark.read.parquet(path)
    # One row a part.
    per = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    starts, total = {}, 0
    for r in sorted(per, key=lambda r: r["part"]):
        starts[r["part"]], total = total, total + r["n"]
    begin = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("part")) if starts else F.lit(0)
    at = (begin + F.col("at")).cast("long").alias("at")
    place = F.transform("doc_from", lambda a, k: F.struct(F.get("doc_ids", k).alias("id"), a.alias("a"), F.coalesce(F.get("doc_from", k + 1), F.col("n_tokens")).alias("b")))
    blocks = files.where("piece = 0").select(at, place.alias("places"), decoded(spark, F.col("block")).alias("ids"))
    cut = blocks.select("at", "ids", F.explode("places").alias("x"))
    whole = cut.select(F.col("x.id").alias(id_column), (F.col("at") + F.col("x.a")).alias("start"), F.substring("ids", (F.col("x.a") * 4 + 1).cast("int"), ((F.col("x.b") - F.col("x.a")) * 4).cast("int")).alias("packed"))
    pieces = files.where("piece > 0").select("part", at, "piece", F.get("doc_ids", F.lit(0)).alias("id"), decoded(spark, F.col("block")).alias("ids"))
    long_ = pieces.groupBy("at", "id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return whole.unionAll(long_.select(F.col("id").alias(id_column), F.col("at").alias("start"), joined.alias("packed")))


def read_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, start, ids) for each document of a folder of token-id files; start is the number of ids before it in the whole folder."""
    return read_packed(spark, path, id_column).select(id_column, "start", jvm.call(spark, "tidemark_ints", F.col("packed")).alias("ids"))


def read_digests(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) for each document of a folder of token-id files."""
    return read_packed(spark, path, id_column).select(id_column, "start", (F.octet_length("packed") / 4).cast("long").alias("n_tokens"), F.crc32("packed").alias("ids_crc32"))
