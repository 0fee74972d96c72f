"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents each get target/size copies, a fraction.  Pivotal rounding pairs two fractional copy
probabilities and randomly moves mass, in words, from one to the other until one is integral, so the words of both
and every document's expectation stay.  Documents are paired from the longest down within chunks of bounded rows
(a hot source has many chunks); what is left fractional, at most one document a chunk, goes up a reduction tree
until each source has one fraction, which is drawn.  All draws are hashes of the seed and the document, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, write_table
from tidemark.plans.runtime import ship

#: Weights of the sources in code-point order, repeating; a target is at most this many times its source's size.
WEIGHTS, MOST = (5, 2, 1), 3.0
#: Documents of a chunk, and residuals that meet in one node of the reduction tree.
CHUNK, FAN_IN = 4096, 1024


def source_targets(sized: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, size): shares of all sizes by weight, at most *most* times a source's size.

    What a source cannot take is shared again by weight among the rest until none is above: those whose limit a
    unit of weight reaches first are full, so one pass over the sources in order of limit/weight finds the level.
    One row a source is all that meets in one task.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    named = per.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = named.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy((F.col("limit") / F.col("weight")), "k")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumns({
        "left": F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    }).withColumn("level", F.col("left") / F.col("open")).withColumn("full", F.col("limit") < F.col("level") * F.col("weight"))
    # The level of the first source that isn't full holds for all from it on.
    level = levels.withColumn("last", F.min(F.when(~F.col("full"), F.struct((F.col("limit") / F.col("weight")).alias("r"), F.col("k"), F.col("level")))).over(everything)["level"])
    return level.select("source", "source_size", "n_docs", F.least("limit", F.coalesce(F.col("last") * F.col("weight"), F.col("limit"))).alias("target"))


def draw(*parts) -> float:
    """A number in [0, 1) from the hash of the parts."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest("|".join(map(str, parts)).encode("utf-8", "surrogatepass")) / 2.0**64


def pivot(names: list, sizes: list[int], ps: list[float], seed: int) -> list[float]:
    """The copy probabilities after pairing them in the order given: all but one at most are 0 or 1.

    A pair moves words, size x probability, from one to the other, so their sum stays; which of the two gets them
    is drawn so that each probability's expectation stays.  Rows without words are drawn one by one.
    """
    out = list(ps)
    held = None
    for k, (size, p) in enumerate(zip(sizes, ps)):
        if not 0.0 < p < 1.0:
            continue
        if not size:
            out[k] = float(draw(seed, names[k]) < p)
            continue
        if held is None:
            held = k
            continue
        q, other = out[held], sizes[held]
        up, down = min(size * (1.0 - p), other * q), min(size * p, other * (1.0 - q))
        if draw(seed, names[held], names[k]) < down / (up + down):
            here, there = p + up / size, q - up / other
        else:
            here, there = p - down / size, q + down / other
        out[k], out[held] = _snapped(here), _snapped(there)
        held = k if 0.0 < out[k] < 1.0 else held if 0.0 < out[held] < 1.0 else None
    return out


def _snapped(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1.0 - 1e-9 else p


def _round(rows: DataFrame, seed: int) -> DataFrame:
    """The rows with p integral, but for one row a (source, node) at most."""

    def step(_, table):
        import pyarrow as pa

        got = table.sort_by([("size", "descending"), ("key", "ascending")])
        keys = got.column("key").to_pylist()
        names = [(key, k) if k and keys[k - 1] == key else key for k, key in enumerate(keys)]  # repeated rows apart
        out = pivot(names, got.column("size").to_pylist(), got.column("p").to_pylist(), seed)
        return got.set_column(got.schema.get_field_index("p"), "p", pa.array(out, pa.float64()))

    ship(rows.sparkSession)
    return rows.groupBy("source", "node").applyInArrow(step, rows.schema)


def row_key(id_column: str = "doc_id", text_column: str = "text"):
    """A hash of a row's id and text, by which it is drawn."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def mix(docs: DataFrame, seed: int = 0, weights=WEIGHTS, most: float = MOST, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", keep: tuple = ()) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken, key) for each row: size counts words, taken is copies x size.

    Null texts have size 0 and so do wordless ones; they take nothing but may be copied.  A null source is a source
    of its own, last in order.  Repeated rows are drawn one by one; null ids keep their rows.  An empty table gives
    an empty result.  *keep* names columns that go with the rows; others are not read.
    """
    sized = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), *keep,
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_key(id_column, text_column).alias("key"),
    )
    sized = write_table(sized, "mix-sizes")
    targets = write_table(source_targets(sized, weights, most), "mix-targets")
    n_sources = targets.count()
    rows = sized.join(F.broadcast(targets) if n_sources <= 100_000 else targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    rows = rows.withColumn("share", share).withColumn("whole", F.floor(F.col("share") + F.lit(1e-12))).withColumn("p", F.greatest(F.lit(0.0), F.col("share") - F.col("whole")))
    nodes = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / CHUNK)).cast("long")
    state = rows.withColumn("node", F.pmod(F.xxhash64(F.lit(seed), "key"), nodes))
    most_nodes = max(1, -(-(targets.agg(F.max("n_docs")).first()[0] or 0) // CHUNK))
    settled, state = None, write_table(_round(state, seed), "mix-round")
    left = "p > 0.0 and p < 1.0"
    while True:
        done = state.where(f"not ({left})")
        settled = done if settled is None else settled.unionAll(done)
        if most_nodes == 1:
            break
        most_nodes = -(-most_nodes // FAN_IN)
        state = write_table(_round(state.where(left).withColumn("node", F.floor(F.col("node") / FAN_IN)), seed + 1), "mix-round")
    # One fraction a source is left: drawn, so that its document's expectation stays too.
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "key"), F.lit(1 << 40)) / float(1 << 40)
    everything = settled.unionAll(state.where(left).withColumn("p", F.when(drawn < F.col("p"), 1.0).otherwise(0.0)))
    copies = (F.col("whole") + F.col("p").cast("long")).alias("copies")
    return everything.select(F.col("id").alias(id_column), *keep, "source", "size", "source_size", "target", copies, (copies * F.col("size")).alias("taken"), "key")
