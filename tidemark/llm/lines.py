"""Line dedup: of each group of equal or similar lines in a corpus one stays.

Equal lines meet by digest with a partial aggregate before the shuffle.  Distinct lines get one-permutation MinHash
signatures of their character shingles (empty bins take values of bins drawn by hash) for each length of shingles that
suits the line, cut into bands.  Band keys are counted with a partial aggregate; only lines of keys that several share
are looked at again.  Lines of a bucket are compared by their exact Jaccard similarity, and the links join by
distributed union-find.  In a bucket all lines are compared to the first; where some aren't similar to it, the next of
them leads a group, and by the triangle inequality of the Jaccard distance only lines near an earlier group's first can
be similar to its other lines: those are compared.  In a bucket above a size each line is compared to the first where
it lies, and only the lines that aren't similar to it meet the bucket's lines, chunk by chunk of bounded bytes.
Shingles and comparisons run in the executors' JVM (``java/Lines.java``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jvm
from tidemark.llm.common import drop_tables, sides_by_size, whole_text, write_table
from tidemark.llm.components import components

#: Characters of a shingle; bands and rows of a band (a pair at similarity 0.8 is missed once in 1,600); the similarity that links.
SHINGLE, BANDS, ROWS, SIMILAR = 3, 14, 4, 0.8
#: (characters of a shingle, least and most characters of a line) by which lines are compared, similar by one being enough: a changed
#: character spoils as many shingles as they have characters, too many of a short line's; long lines of the same words share short ones.
KINDS = ((2, 18, 40), (SHINGLE, 0, 100), (5, 80, 200), (8, 0, (1 << 31) - 1))
#: Lines and bytes of a bucket that are compared in one call, and of a chunk of a larger one.
CHUNK, CHUNK_BYTES = 20_000, 4 << 20
#: Ids that may be sent to every task (8 bytes each).
SENT_IDS = 4_000_000
#: Bytes of first lines of large buckets that may be sent to every task.
SENT_BYTES = 32 << 20


_KINDS = ";".join(f"{w},{a},{b}" for w, a, b in KINDS)


def band_keys(spark: SparkSession, line: Column) -> Column:
    """64-bit keys of a line, BANDS for each kind of shingles that suits it; similar lines agree on one with high probability."""
    jvm.register(spark, "tidemark_band_keys", "tidemark.Lines$Bands", "array<bigint>", _KINDS, f"{BANDS},{ROWS}")
    return F.call_udf("tidemark_band_keys", line)


def likeness(spark: SparkSession, a: Column, b: Column, width: Column, least: float) -> Column:
    """The Jaccard similarity of two lines' shingles of *width* characters, or -1 where it is below *least*."""
    name = f"tidemark_likeness_{round(least * 1000)}"
    jvm.register(spark, name, "tidemark.Lines$Likeness", "double", str(least))
    return F.call_udf(name, a, b, width)


def bucket_links(spark: SparkSession, ids: Column, lines: Column, kinds: Column, similar: float = SIMILAR) -> Column:
    """Pairs, one id after the other, that connect all lines which similar pairs of a bucket connect by the kinds (bits); fewer pairs than lines."""
    name = f"tidemark_line_links_{round(similar * 1000)}"
    jvm.register(spark, name, "tidemark.Lines$Links", "array<bigint>", str(similar), _KINDS)
    return F.call_udf(name, ids, lines, kinds)


def _cross_links(spark: SparkSession, *columns: Column) -> Column:
    jvm.register(spark, "tidemark_cross_links", "tidemark.Lines$Cross", "array<bigint>", str(SIMILAR))
    return F.call_udf("tidemark_cross_links", *columns)


def _n_lines(spark: SparkSession, text: Column) -> Column:
    jvm.register(spark, "tidemark_n_lines", "tidemark.Lines$Count", "bigint")
    return F.call_udf("tidemark_n_lines", text)


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line_no, line) for each line with a visible character; h tells apart rows that share an id."""
    # h is made before the lines: beside them it would be made of the whole text once a line.
    base = docs.select("doc_id", whole_text().alias("text")).withColumn("h", F.xxhash64("text"))
    return base.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.trim("line") != "")


def _digest() -> list[Column]:
    """128 bits of a line: two hashes of different seeds."""
    return [F.xxhash64("line").alias("d"), F.xxhash64(F.lit(1), "line").alias("e")]


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line_no) of the lines that go: all but the first, by doc_id and line, of each component of equal or similar lines."""
    lines = occurrences(docs)
    first = F.min(F.struct("doc_id", "h", "line_no", "line")).alias("f")
    distinct = lines.groupBy(*_digest()).agg(first, F.count("*").alias("n")).select("d", "e", "f.doc_id", "f.h", "f.line_no", "f.line", "n", F.monotonically_increasing_id().alias("id"))
    distinct = write_table(distinct, "lines-distinct")
    tables: list[DataFrame] = []
    links = write_table(_links(distinct.select("id", "line"), tables=tables), "lines-links")
    drop_tables(*tables)
    reach = write_table(components(links).select(F.col("node").alias("id"), "root"), "lines-reach")
    narrow = distinct.select("d", "e", "doc_id", "h", "line_no", "n", "id")
    linked = reach.count()
    # Kept of each component: the line that comes first.
    of = narrow.join(sides_by_size(reach, linked, SENT_IDS // 2), "id")
    kept = of.groupBy("root").agg(F.min(F.struct("doc_id", "h", "line_no", "id"))["id"].alias("keeper"))
    gone = write_table(of.select("id", "root").join(kept, "root").where("id <> keeper").select("id", F.lit(True).alias("all_go")), "lines-linked")
    several = narrow.join(sides_by_size(gone, linked, SENT_IDS // 2), "id", "left").where("n > 1 or all_go")
    several = write_table(several.select("d", "e", F.col("doc_id").alias("first_doc"), F.col("h").alias("first_h"), F.col("line_no").alias("first_line"), "all_go"), "lines-several")
    drop_tables(distinct, links, reach, gone)
    at = lines.select("doc_id", "h", "line_no", *_digest()).join(sides_by_size(several, several.count(), SENT_IDS // 4), ["d", "e"])
    is_first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("h") == F.col("first_h")) & (F.col("line_no") == F.col("first_line"))
    return at.where(F.col("all_go").isNotNull() | ~is_first).select("doc_id", "h", "line_no").distinct()


def _links(distinct: DataFrame, chunk: int = CHUNK, chunk_bytes: int = CHUNK_BYTES, tables: list | None = None) -> DataFrame:
    """(a, b): ids of *distinct* (id, line) whose components are those of all similar pairs that share a band key.

    The tables that the result is read from are added to *tables*.
    """
    spark = distinct.sparkSession
    keyed = distinct.select("id", F.octet_length("line").alias("size"), F.explode(band_keys(spark, F.col("line"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.hash("id")).alias("x")).where("n > 1")
    # Buckets of the same lines, which similar lines make in most bands, are one: their members' hashes agree.
    kind = F.col("key").bitwiseAND(F.lit(3)).cast("int")
    shared = write_table(shared.select("key", F.xxhash64("n", "x").alias("bucket"), F.element_at(F.array(*[F.lit(1 << k) for k in range(len(KINDS))]), kind + 1).alias("kind")), "lines-keys")
    kinds = shared.groupBy("bucket").agg(F.bit_or("kind").alias("kinds"))
    members = write_table(keyed.join(sides_by_size(shared.select("key", "bucket"), shared.count(), SENT_IDS // 2), "key").select("bucket", "id", "size").distinct(), "lines-members")
    wanted = members.select("id").distinct()
    texts = write_table(distinct.join(sides_by_size(wanted, wanted.count(), SENT_IDS), "id", "left_semi"), "lines-texts")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("id").alias("first"))
    buckets = write_table(sizes.join(kinds, "bucket"), "lines-buckets")
    written, members = members, members.drop("size")
    tables = [] if tables is None else tables
    tables += [shared, written, texts, buckets]
    large = (F.col("n") > chunk) | (F.col("bytes") > chunk_bytes)
    n_large = buckets.where(large).count()
    rows = members.join(texts, "id")
    if n_large:
        rows = rows.join(sides_by_size(buckets.where(large).select("bucket"), n_large, SENT_IDS), "bucket", "left_anti")
    small = rows.groupBy("bucket").agg(F.collect_list(F.struct("id", "line")).alias("m")).join(kinds, "bucket")
    found = _pairs(small.select(bucket_links(spark, F.col("m.id"), F.col("m.line"), F.col("kinds")).alias("p")))
    if n_large:
        of = [F.when(F.col("kinds").bitwiseAND(F.lit(1 << k)) > 0, F.lit(w)) for k, (w, _, _) in enumerate(KINDS)]
        by_kind = buckets.where(large).withColumn("width", F.explode(F.array_compact(F.array(*of)))).drop("kinds")
        found = found.unionAll(_large_links(members, by_kind, texts, chunk, chunk_bytes, tables))
    return found


def _pairs(found: DataFrame) -> DataFrame:
    at = found.where(F.size("p") > 0).select("p", F.explode(F.sequence(F.lit(1), F.size("p") - 1, F.lit(2))).alias("k"))
    return at.select(F.element_at("p", F.col("k")).alias("a"), F.element_at("p", F.col("k") + 1).alias("b"))


def _large_links(members: DataFrame, buckets: DataFrame, texts: DataFrame, chunk: int, chunk_bytes: int, tables: list) -> DataFrame:
    """Links of large buckets: all lines to the first where they lie, then the lines that aren't similar to it to all, by chunks."""
    spark = members.sparkSession
    heads = write_table(buckets.join(texts.select(F.col("id").alias("first"), F.col("line").alias("head")), "first"), "lines-heads")
    rows = members.join(sides_by_size(heads, heads.agg(F.sum(F.octet_length("head") + 64)).first()[0], SENT_BYTES), "bucket").join(texts, "id")
    rows = write_table(rows.select("bucket", "width", "n", "bytes", "first", "id", "line", likeness(spark, F.col("line"), F.col("head"), F.col("width"), 2 * SIMILAR - 1).alias("j")), "lines-large")
    found = rows.where((F.col("j") >= SIMILAR) & (F.col("id") != F.col("first"))).select(F.col("first").alias("a"), F.col("id").alias("b"))
    parts = lambda n, size: F.ceil(F.greatest(F.col(n) / chunk, F.col(size) / chunk_bytes)).cast("int")
    others = rows.where(F.col("j") < SIMILAR)
    per = others.groupBy("bucket", "width").agg(F.count("*").alias("n_others"), F.sum(F.octet_length("line")).alias("size_others"))
    per = write_table(per.join(buckets.select("bucket", "width", "n", "bytes"), ["bucket", "width"]).select("bucket", "width", parts("n", "bytes").alias("c"), parts("n_others", "size_others").alias("o")), "lines-others")
    tables += [heads, rows, per]
    per = sides_by_size(per, per.count(), SENT_IDS // 4)
    place = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    asked = rows.join(per, ["bucket", "width"]).select("bucket", "width", place("c").alias("i"), every("o").alias("k"), F.lit(False).alias("asks"), "id", "line", "j")
    asking = others.join(per, ["bucket", "width"]).select("bucket", "width", every("c").alias("i"), place("o").alias("k"), F.lit(True).alias("asks"), "id", "line", "j")
    met = asked.unionAll(asking).groupBy("bucket", "width", "i", "k").agg(F.collect_list(F.struct("id", "line", "j", "asks")).alias("m"))
    return found.unionAll(_pairs(met.select(_cross_links(spark, *[F.col(f"m.{c}") for c in ("id", "line", "j", "asks")], F.col("width")).alias("p"))))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed_lines) for each row: the numbers from 0 of the lines that go, ascending.

    Lines are what line feeds separate; lines without visible characters always stay and link to nothing.  A null
    text is the empty text: one blank line.  Rows with equal id and text count as one document, so a repeated row
    keeps what its twin keeps; a null id comes first in order.  An empty table gives an empty result; columns other than
    doc_id and text are not read.
    """
    gone = write_table(removals(docs), "lines-gone").groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("line_no")).alias("removed_lines"))
    rows = docs.select("doc_id", whole_text().alias("text")).select("doc_id", F.xxhash64("text").alias("h"), _n_lines(docs.sparkSession, F.col("text")).alias("n_lines"))
    return _with(rows, gone).select("doc_id", "n_lines", F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines")


def _with(rows: DataFrame, gone: DataFrame) -> DataFrame:
    of = gone.select(F.col("doc_id").alias("_doc"), F.col("h").alias("_h"), "removed_lines")
    joined = rows.join(of, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h")), "left").drop("_doc", "_h")
    return joined.withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))


def dedup(docs: DataFrame) -> DataFrame:
    """*docs* with the lines of ``removed_lines`` cut out of text; rows of which no visible line is left go.

    Other columns stay as they are.  Rows that had no visible line to begin with stay.
    """
    gone = write_table(removals(docs), "lines-gone").groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("line_no")).alias("removed_lines"))
    rows = _with(docs.withColumn("h", F.xxhash64(whole_text())), gone)
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, k: ~F.array_contains("removed_lines", k)), "\n")
    cut = rows.withColumn("text", F.when(F.size("removed_lines") > 0, left).otherwise(F.col("text")))
    return cut.where((F.size("removed_lines") == 0) | (F.trim(F.replace("text", F.lit("\n"), F.lit(""))) != "")).select(*docs.columns)
