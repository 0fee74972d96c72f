"""SimHash fingerprints and near-duplicate groups by BK-trees.

Two fingerprints within the radius agree on at least (blocks - radius) of their bit blocks, so each fingerprint
joins the shards of every choice of so many blocks.  A shard's task builds its BK-tree (children keyed by the
integer Hamming distance to the parent), asks it for each fingerprint along the edges within the radius, and
returns a spanning forest of the links it found.  The trees reach their tasks by the shuffle of the shards, not
through the driver, which would have to collect the fingerprints of all documents.  Distinct fingerprints only are
searched; shards above a size are dealt out again by more and finer blocks, so no task grows with a hot value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text, write_table
from tidemark.llm.components import components
from tidemark.plans.runtime import map_arrow

#: Fingerprints of a shard at most, before it is dealt out again by finer blocks.
SHARD_ROWS = 4096
#: Numbers of blocks, from coarse to fine, with the distinct fingerprints up to which each starts.
BLOCKS = ((4, 2_000_000), (5, 1_000_000_000), (6, 1 << 62), (8, 1 << 62))

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text: A-Z lower-cased, shingles of words with repeats, XXH64 with seed 42, majority of each bit."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, 42)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes).tolist()
        hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + np.arange(8, dtype=np.int64) * 256).ravel(), minlength=2048).reshape(8, 256)
    bits = (seen @ _BITS).ravel() * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


class BkTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of the values within the radius: an edge is followed if it can lead to one."""
        found, todo = [], [0] if self.values else []
        while todo:
            k = todo.pop()
            d = (self.values[k] ^ value).bit_count()
            if d <= radius:
                found.append(k)
            todo += [c for e, c in self.children[k].items() if d - radius <= e <= d + radius]
        return found

    def add(self, value: int) -> None:
        k, new = 0, len(self.values)
        while new:
            d = (self.values[k] ^ value).bit_count()
            after = self.children[k].setdefault(d, new)
            if after == new:
                break
            k = after
        self.values.append(value)
        self.children.append({})


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever distinct values the radius connects, fewer than values."""
    tree, top, links = BkTree(), list(range(len(values))), []

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for k, value in enumerate(values):
        for other in tree.near(value, radius):
            a, b = root(k), root(other)
            if a != b:
                top[max(a, b)] = min(a, b)
                links.append((value, values[other]))
        tree.add(value)
    return links


def _keys(blocks: int, radius: int):
    """One key for each choice of (blocks - radius) blocks of the fingerprint: its number and its bits, the rest zero."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << cuts[c + 1] - cuts[c]) - 1) << cuts[c] for c in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("n", "bits")


def links(prints: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of *prints* (a column fp of distinct longs) within the radius."""
    total = prints.count()
    first = next(k for k, (b, most) in enumerate(BLOCKS) if b > radius and total <= most)
    members, made = prints.select("fp", F.array().cast("array<long>").alias("at")), None
    for level in range(first, len(BLOCKS)):
        dealt = members.select("fp", "at", _keys(BLOCKS[level][0], radius)).select("fp", F.concat("at", F.array(F.col("n").cast("long"), F.col("bits"))).alias("at"))
        sizes = dealt.groupBy("at").agg(F.count("*").alias("rows"))
        last = level + 1 == len(BLOCKS)
        hot = None if last else write_table(sizes.where(F.col("rows") > shard_rows).select("at"), "simhash-hot")
        n_hot = 0 if last else hot.count()
        cool = dealt if not n_hot else dealt.join(hot, "at", "left_anti").select("fp", "at")
        found = _search(cool, radius)
        made = found if made is None else made.unionAll(found)
        if not n_hot:
            return made
        members = dealt.join(hot, "at", "left_semi").select("fp", "at")
    return made


def _search(dealt: DataFrame, radius: int) -> DataFrame:
    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        shard, values, found = None, [], []
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        for batch in batches:
            for fp, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != shard:
                    found += forest(values, radius) if len(values) > 1 else ()
                    shard, values = at, []
                    if len(found) > 50_000:
                        yield out([(signed(a), signed(b)) for a, b in found])
                        found = []
                values.append(fp & (1 << 64) - 1)
        found += forest(values, radius) if len(values) > 1 else ()
        yield out([(signed(a), signed(b)) for a, b in found])

    return map_arrow(dealt.repartition(F.col("at")).sortWithinPartitions("at", "fp"), search, "a long, b long")


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp long) for each row; a null text, and one without words, has fingerprint 0."""

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64), pa.int64())], ["id", "fp"])

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return map_arrow(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, fp long").withColumnRenamed("id", id_column)


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for each row: component_id is the smallest id reachable over links.

    Rows with equal fingerprints are linked, null and wordless texts (fingerprint 0) included.  Null ids keep their
    rows and never name a component unless it has no other id (then null); repeated rows each stay.  Columns other
    than the two are not read; an empty table gives an empty result.
    """
    made = write_table(fingerprints(docs, shingle, id_column, text_column), "simhash")
    distinct = write_table(made.groupBy("fp").agg(F.min(id_column).alias("least")), "simhash-distinct")
    reach = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(reach.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return made.join(named, "fp").select(id_column, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
