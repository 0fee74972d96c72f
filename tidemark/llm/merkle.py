"""Document fingerprints: Merkle trees over phrases, paragraphs and sections, in built-in expressions only.

Paragraphs are lines, and their nodes hash them whole.  A section ends after a paragraph whose digest starts with 0 or
1, so edits move no later boundary; its node hashes its paragraphs' digests, and the root those of the sections.  Equal
roots are equal texts; where roots differ, the sections whose nodes differ, and in those the paragraphs, locate the
edit.  Leaves are phrases, which end after a word whose hash says so, so one-line texts have branches too.  The
likeness of two trees counts their common leaves and common pairs of neighbouring leaves, each as often as both have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.llm.common import whole_text

#: Where a word ends: after white space, or after a mark of scripts without spaces; of how many words one ends a phrase.
WORD_END, PHRASE_WORDS = r"(?<=[\s。、！？])", 8
#: Where a section ends, in its paragraphs' digests joined by spaces.
SECTION_END = r"(?<=(?:^| )[01][0-9a-f]{63}) "
#: Digits of a section's node that a fingerprint shows, of 64.
SHOWN = 8

#: Ranges that quantiles of the ids part at most; finer ones are equal steps within them.
COARSE = 256


def paragraphs(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256))


def sections(nodes: Column) -> Column:
    """Sections of paragraph digests: each a text of digests joined by spaces."""
    return F.split(F.array_join(nodes, " "), SECTION_END)


def root(section_nodes: Column) -> Column:
    return F.sha2(F.array_join(section_nodes, " "), 256)


def leaves(text: Column) -> Column:
    """64-bit digests of the phrases of a text, in order."""
    ended = F.transform(F.split(text, WORD_END), lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(PHRASE_WORDS)) == 0, F.concat(w, F.lit("\0"))).otherwise(w))
    return F.transform(F.split(F.array_join(ended, ""), "\0"), lambda p: F.xxhash64(p))


def with_branches(df: DataFrame, name: str, text: Column) -> DataFrame:
    """*df* with a column of the leaves and neighbouring pairs of leaves of a text, the k-th of equal ones told apart by k.

    Sorted, equal digests stand together: their runs begin where one differs from the digest before it.
    """
    at = lambda k: F.get("_s", k)
    df = df.withColumn("_l", leaves(text))
    pairs = F.transform("_l", lambda x, k: F.when(k > 0, F.xxhash64(F.get("_l", k - 1), x)))
    df = df.withColumn("_s", F.sort_array(F.concat("_l", F.array_compact(pairs))))
    df = df.withColumn("_at", F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda k: (k == 0) | (at(k) != at(k - 1))))
    runs = F.transform("_at", lambda k, j: F.transform(F.sequence(F.lit(1), F.coalesce(F.get("_at", j + 1), F.size("_s")) - k), lambda n: F.when(n == 1, at(k)).otherwise(F.xxhash64(at(k), n))))
    return df.withColumn(name, F.flatten(runs)).drop("_l", "_s", "_at")


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: twice the common branches over the branches of both."""
    return (F.lit(2.0) * F.size(F.array_intersect(a, b))) / (F.size(a) + F.size(b))


def fingerprint(text: Column) -> Column:
    """The root, a colon, and the first SHOWN digits of each section's node."""
    nodes = F.transform(sections(paragraphs(text)), lambda s: F.sha2(s, 256))
    return F.transform(F.array(nodes), lambda s: F.concat(root(s), F.lit(":"), F.array_join(F.transform(s, lambda x: F.substring(x, 1, SHOWN)), "")))[0]


def tree(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, root, sections) for each row, sections of (node, paragraphs); a null text is the empty text: one empty paragraph."""
    made = docs.select(id_column, sections(paragraphs(whole_text(text_column))).alias("s"))
    made = made.select(id_column, F.transform("s", lambda s: F.struct(F.sha2(s, 256).alias("node"), F.split(s, " ").alias("paragraphs"))).alias("sections"))
    return made.select(id_column, root(F.col("sections.node")).alias("root"), "sections")


def edits(a: DataFrame, b: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, side, section, paragraph) of two trees with one id: paragraphs, numbered within their section, that only side a or b has.

    Where roots are equal nothing is looked at; else only sections whose node the other tree lacks are gone into.
    """
    both = a.select(id_column, F.col("root").alias("_ra"), F.col("sections").alias("_a")).join(b.select(id_column, F.col("root").alias("_rb"), F.col("sections").alias("_b")), id_column).where("_ra <> _rb")
    out = None
    for side, own, other in (("a", "_a", "_b"), ("b", "_b", "_a")):
        theirs = F.flatten(F.transform(F.filter(other, lambda s: ~F.array_contains(f"{own}.node", s["node"])), lambda s: s["paragraphs"]))  # noqa: B023
        at = both.select(id_column, F.col(f"{other}.node").alias("_nodes"), theirs.alias("_theirs"), F.posexplode(own).alias("section", "s")).where(~F.array_contains("_nodes", F.col("s.node")))
        at = at.select(id_column, "_theirs", "section", F.posexplode("s.paragraphs").alias("paragraph", "digest")).where(~F.array_contains("_theirs", F.col("digest")))
        made = at.select(id_column, F.lit(side).alias("side"), "section", "paragraph")
        out = made if out is None else out.unionAll(made)
    return out


def with_next(docs: DataFrame, buckets: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's text and branches with those of the next row by (id, text hash), after the last the first; ids are numbers.

    Rows are dealt into ranges of ids by quantiles; the first row of each range also goes to the range before it,
    so neighbours across ranges meet and no task sees more than a range.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_column].dataType, NumericType):
        raise TypeError(f"{id_column}: ranges need ids that are numbers")
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).withColumn("h", F.xxhash64("text"))
    coarse = min(n, COARSE)
    cuts = sorted({*base.where("id is not null").approxQuantile("id", [k / coarse for k in range(coarse + 1)], 0.001)})
    range_no = F.lit(0).cast("long")
    if len(cuts) > 1:
        # Quantiles part the ids coarsely, and equal steps between two quantiles finely: few literals make many ranges.
        ends, fine = F.array(*[F.lit(float(c)) for c in cuts]), -(-n // coarse)
        at = F.greatest(F.lit(1), F.least(F.lit(len(cuts) - 1), F.size(F.filter(ends, lambda c: c <= F.col("id")))))
        low, high = F.element_at(ends, at), F.element_at(ends, at + 1)
        step = F.least(F.lit(fine - 1), F.floor((F.col("id") - low) / (high - low) * fine))
        range_no = F.when(F.col("id").isNull(), 0).otherwise(at * fine + F.greatest(F.lit(0), step)).cast("long")
    base = base.withColumn("range", range_no)
    # One row a range: its first row, and the range before it (for the first range the last).
    firsts = base.groupBy("range").agg(F.min(F.struct("id", "h")).alias("f")).select("range", "f.id", "f.h")
    around = Window.orderBy("range")
    firsts = firsts.withColumn("before", F.coalesce(F.lag("range").over(around), F.max("range").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))).select(F.col("range").alias("_range"), F.col("id").alias("_id"), F.col("h").alias("_h"), "before")
    guests = base.join(F.broadcast(firsts), (F.col("range") == F.col("_range")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))).select("id", "text", "h", F.col("before").alias("range"), F.lit(1).alias("guest"))
    both = base.withColumn("guest", F.lit(0)).unionByName(guests)
    order = ["range", "guest", F.col("id").asc_nulls_first(), "h"]
    dealt = both.repartition("range").sortWithinPartitions(*order)
    dealt = with_branches(dealt, "branches", F.col("text"))
    w = Window.partitionBy("range").orderBy(*order[1:])
    return dealt.withColumn("next_text", F.lead("text").over(w)).withColumn("next_branches", F.lead("branches").over(w)).where("guest = 0").select(F.col("id").alias(id_column), "text", "branches", "next_text", "next_branches")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """For each row: the fingerprint of its text, and of the text with its last quarter replaced from the next row's.

    Null texts are empty texts; null ids come first; rows with one id follow each other by the hash of their text, and equal
    rows are each other's next.  A single row is its own next.  An empty table gives an empty result.  Columns other
    than doc_id and text are not read.
    """
    at = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = at.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring("next_text", F.lit(1), quarter)))
    edited = with_branches(edited, "edited_branches", F.col("edited"))
    return edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("branches"), F.col("edited_branches")).alias("near_edited"), likeness(F.col("branches"), F.col("next_branches")).alias("near_next"),
    )
