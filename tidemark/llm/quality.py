"""Quality classifier: an interpolated modified Kneser-Ney model over bytes, trained on trusted text.

Counting: each task packs the n-grams of its trusted texts into integers and counts them itself; the partial
counts are summed by n-gram, and lower orders count distinct left neighbours.  Discounts, context totals and
interpolated probabilities come from joins of the count tables by context and by suffix.  Scoring: the model's
rows are dealt into shards by n-gram; while their counted rows stay within a bound each shard is sent to all
tasks as a hash table, and beyond it the documents' own n-gram counts are joined to the shards by shuffle.  Both
give a document's log probability, and a document passes if its perplexity is within its language's quantile of
trusted documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drop_tables, sides_by_size, whole_text, write_table
from tidemark.plans.runtime import map_arrow

#: Bytes of an n-gram, at most 7: with its length it fills a 64-bit integer.
ORDER = 5
#: The quantile of trusted documents' perplexity, by language, above which documents go; and a factor on it.
QUANTILE, SLACK = 0.995, 1.0
#: A text of n bytes may pass its limit by a factor of exp(SHORT / sqrt(n)): a byte's ln p has a deviation of about 1, its mean one of 1 / sqrt(n).
SHORT = 1.0
#: Width of the histogram bins of ln(perplexity) in which quantiles are found.
BIN = 1e-3
#: Trusted ids that may be sent to every task (8 bytes each), so that their texts are counted where they are read; more are joined by shuffle.
TRUSTED_IDS = 8_000_000
#: Bytes of a model that may be sent to every task, those of a row (key and two doubles), and rows of one shard of it.
SENT_BYTES, ROW_BYTES, SHARD_ROWS = 96 << 20, 24, 1_000_000


def grams(data: bytes, order: int) -> np.ndarray:
    """The n-gram that ends at each byte, packed with the last byte lowest; before the text stand line feeds."""
    padded = np.frombuffer(b"\n" * (order - 1) + data, np.uint8).astype(np.int64)
    out = np.zeros(len(data), np.int64)
    for k in range(order):
        out = out << 8 | padded[k : k + len(data)]
    return out


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(g, c): how often each n-gram stands in the column text; counted in each task before the shuffle."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, n = [], 0

        def merged():
            if not held:
                return []
            g = np.concatenate([x for x, _ in held])
            c = np.concatenate([x for _, x in held])
            kinds, place = np.unique(g, return_inverse=True)
            return [(kinds, np.bincount(place, c, len(kinds)).astype(np.int64))]

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                found = [grams(t.encode("utf-8"), order) for t in batch.column(0).slice(at, 200).to_pylist()]
                kinds, c = np.unique(np.concatenate(found), return_counts=True)
                held.append((kinds, c))
                n += len(kinds)
                if n > 3_000_000:
                    held = merged()
                    n = len(held[0][0])
                    if n > 2_000_000:  # a task's table is bounded: what it has goes to the shuffle
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], ["g", "c"])
                        held, n = [], 0
        for g, c in merged():
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], ["g", "c"])

    return map_arrow(texts.select(whole_text().alias("text")), count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _suffix(column: str, n: int):
    return F.col(column).bitwiseAND(F.lit((1 << 8 * n) - 1))


def train(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(n, g, lp, lb): ln p of the n-gram g (its last byte after the others), and for contexts the ln of what is left to shorter ones.

    Rows: every seen n-gram of each order up to *order*, lp set; every context (one byte fewer), lb set.
    """
    counts = {order: write_table(count_grams(texts, order), "kn-counts")}
    for n in range(order - 1, 0, -1):  # in how many distinct places to the left an n-gram continues
        counts[n] = write_table(counts[n + 1].groupBy(_suffix("g", n).alias("g")).agg(F.count("*").alias("c")), "kn-counts")
    lower, rows, tables = None, [], [*counts.values()]
    for n in range(1, order + 1):
        of = counts[n].groupBy().agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (max(1, x) for x in of)
        y = n1 / (n1 + 2 * n2)
        d1, d2, d3 = (min(max(d, 0.05), k - 0.05) for k, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), 1))
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        seen = counts[n].withColumn("d", discount).withColumn("h", F.shiftright("g", 8))
        contexts = seen.groupBy("h").agg(F.sum("c").alias("total"), F.sum("d").alias("freed")).withColumn("left", F.col("freed") / F.col("total"))
        own = seen.join(contexts, "h").select("g", "left", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"))
        if n == 1:
            p = own.select("g", (F.col("own") + F.col("left") / 256).alias("p"))
        else:
            p = own.withColumn("s", _suffix("g", n - 1)).join(lower.select(F.col("g").alias("s"), F.col("p").alias("q")), "s").select("g", (F.col("own") + F.col("left") * F.col("q")).alias("p"))
        lower = write_table(p, "kn-p")
        tables.append(lower)
        rows.append(lower.select(F.lit(n).alias("n"), "g", F.log("p").alias("lp"), F.lit(None).cast("double").alias("lb")))
        rows.append(contexts.select(F.lit(n - 1).alias("n"), F.col("h").alias("g"), F.lit(None).cast("double"), F.log("left")))
    made = rows[0]
    for r in rows[1:]:
        made = made.unionAll(r)
    model = write_table(made.groupBy("n", "g").agg(F.max("lp").alias("lp"), F.max("lb").alias("lb")), "kn-model")
    drop_tables(*tables)
    return model


class Shard:
    """A hash table from packed n-grams to (lp, lb), probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray, lp: np.ndarray, lb: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.place = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        left, slot = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = self.keys[slot[left]] == -1
            at, first = np.unique(slot[left[free]], return_index=True)
            won = left[free][first]
            self.keys[at], self.place[at] = keys[won], won
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & size - 1
        self.lp, self.lb = np.append(lp, np.nan), np.append(lb, np.nan)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys; the last place, of NaN values, for those that are missing."""
        slot = self.slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.place[slot], len(self.lp) - 1)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & len(self.keys) - 1
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.place[slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


def tagged(n: int, g: np.ndarray) -> np.ndarray:
    """An n-gram with its length in the top byte: one integer for all orders."""
    return g | np.int64(n) << np.int64(56)


def log_probabilities(g: np.ndarray, order: int, shards: list[Shard]) -> np.ndarray:
    """ln p of each n-gram's last byte: the longest seen suffix, and what its longer contexts leave."""
    out, todo = np.zeros(len(g)), np.arange(len(g))
    for n in range(order, 0, -1):
        lp = _look(tagged(n, g[todo] & (1 << 8 * n) - 1), shards, "lp")
        hit = ~np.isnan(lp)
        out[todo[hit]] += lp[hit]
        todo = todo[~hit]
        if not len(todo):
            return out
        lb = _look(tagged(n - 1, (g[todo] & (1 << 8 * n) - 1) >> 8), shards, "lb")
        out[todo] += np.nan_to_num(lb, nan=0.0)
    out[todo] += -np.log(256.0)
    return out


def _look(keys: np.ndarray, shards: list[Shard], what: str) -> np.ndarray:
    if len(shards) == 1:
        return getattr(shards[0], what)[shards[0].find(keys)]
    out, of = np.full(len(keys), np.nan), shard_of(keys, len(shards))
    for k, s in enumerate(shards):
        mine = np.flatnonzero(of == k)
        out[mine] = getattr(s, what)[s.find(keys[mine])]
    return out


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)).astype(np.int64) % n


_shards: dict[str, list[Shard]] = {}


def score(docs: DataFrame, model: DataFrame, order: int = ORDER, sent_rows: int = SENT_BYTES // ROW_BYTES, id_columns: tuple = ("doc_id", "lang")) -> DataFrame:
    """(id columns, n_bytes, log_prob) for each row of *docs*; a null or empty text has 0 bytes and log_prob 0."""
    n_rows = model.count()
    rows = docs.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(id_columns)], whole_text().alias("text"))
    ids = ", ".join(f"_{k} {rows.schema[f'_{k}'].dataType.simpleString()}" for k in range(len(id_columns)))
    names = [f"_{k}" for k in range(len(id_columns))]
    if n_rows <= sent_rows:
        made = _score_sent(rows, model, n_rows, order, names, ids)
    else:
        made = _score_joined(rows, model, order, names)
    return made.select(*[F.col(n).alias(c) for n, c in zip(names, id_columns)], "n_bytes", "log_prob")


def _score_sent(rows: DataFrame, model: DataFrame, n_rows: int, order: int, names: list[str], ids: str) -> DataFrame:
    import uuid

    table = model.toArrow()
    keys = tagged(1, table.column("g").to_numpy()) & ((1 << 56) - 1) | table.column("n").to_numpy().astype(np.int64) << 56
    lp, lb = (table.column(c).to_numpy(zero_copy_only=False) for c in ("lp", "lb"))
    n_shards = -(-n_rows // SHARD_ROWS) or 1
    of = shard_of(keys, n_shards)
    sent = [rows.sparkSession.sparkContext.broadcast((keys[of == k], lp[of == k], lb[of == k])) for k in range(n_shards)]
    name = uuid.uuid4().hex

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        if name not in _shards:
            while len(_shards) > 1:  # the models of both folds stay
                _shards.pop(next(iter(_shards)))
            _shards[name] = [Shard(*s.value) for s in sent]
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t.encode("utf-8") for t in part.column(len(names)).to_pylist()]
                sizes = np.array([len(t) for t in texts], np.int64)
                lps = log_probabilities(np.concatenate([grams(t, order) for t in texts]), order, _shards[name])
                ends = np.cumsum(sizes)
                total = np.append(0.0, np.cumsum(lps))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sizes), pa.array(total[ends] - total[ends - sizes])], [*names, "n_bytes", "log_prob"])

    return map_arrow(rows, work, f"{ids}, n_bytes long, log_prob double")


def _score_joined(rows: DataFrame, model: DataFrame, order: int, names: list[str]) -> DataFrame:
    """Each document's distinct n-grams with counts, joined to the model order by order; texts stay where they are."""
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    keyed = write_table(keyed, "kn-rows")

    def explode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 50):
                part = batch.slice(at, 50)
                for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    g, c = np.unique(grams(text.encode("utf-8"), order), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), row, np.int64)), pa.array(g), pa.array(c.astype(np.int64))], ["_row", "g", "c"])

    todo = map_arrow(keyed.select("_row", "text"), explode, "_row long, g long, c long").withColumn("s", F.lit(0.0))
    done = None
    for n in range(order, 0, -1):
        at = model.where(F.col("n") == n).where("lp is not null").select(F.col("g").alias("k"), "lp")
        back = model.where(F.col("n") == n - 1).where("lb is not null").select(F.col("g").alias("h"), "lb")
        looked = todo.withColumn("k", _suffix("g", n)).join(at, "k", "left")
        hit = looked.where("lp is not null").select("_row", "c", (F.col("s") + F.col("lp")).alias("s"))
        done = hit if done is None else done.unionAll(hit)
        missed = looked.where("lp is null").withColumn("h", F.shiftright("k", 8)).join(back, "h", "left")
        todo = missed.select("_row", "g", "c", (F.col("s") + F.coalesce("lb", F.lit(0.0))).alias("s"))
    done = done.unionAll(todo.select("_row", "c", (F.col("s") - float(np.log(256.0))).alias("s")))
    sums = done.groupBy("_row").agg(F.sum(F.col("c") * F.col("s")).alias("log_prob"))
    return keyed.join(sums, "_row", "left").select(*names, F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce("log_prob", F.lit(0.0)).alias("log_prob"))


def trusted_quantiles(scored: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """(lang, limit) and one row (null, limit, everyone = true) over all languages: from a histogram of ln(perplexity), one row a bin."""
    bins = scored.where("n_bytes > 0").withColumn("bin", F.floor(-F.col("log_prob") / F.col("n_bytes") / BIN))
    per = bins.groupBy("lang", "bin").agg(F.count("*").alias("rows")).withColumn("everyone", F.lit(False))
    per = per.unionByName(bins.groupBy("bin").agg(F.count("*").alias("rows")).select(F.lit(None).cast(scored.schema["lang"].dataType).alias("lang"), "bin", "rows", F.lit(True).alias("everyone")))
    w = Window.partitionBy("everyone", "lang")
    at = per.withColumn("below", F.sum("rows").over(w.orderBy("bin"))).withColumn("total", F.sum("rows").over(w))
    return at.where(F.col("below") >= F.lit(quantile) * F.col("total")).groupBy("everyone", "lang").agg((F.exp((F.min("bin") + 1) * BIN) * slack).alias("limit"))


def _fold():
    return F.pmod(F.xxhash64("doc_id"), F.lit(2))


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, limit, keep) for each row of *docs*.

    Trusted are documents labelled quality 1 and toxic 0.  Documents fall into two folds by their id, and each fold is
    scored by the model of the other's trusted documents: none by a model that has seen it, so limits hold for new ones.  perplexity is a byte's; keep means it is within the
    limit of the document's language (see SHORT), or of all trusted documents where the language (null included) has none.  A
    null or empty text has no perplexity and is not kept; without trusted documents everything else is kept.
    Repeated rows are scored one by one, repeated labels count once; columns besides those named are not read.
    """
    ids = labels.where("quality = 1 and coalesce(toxic, 0) = 0").where("doc_id is not null").select("doc_id").distinct()
    ids = write_table(ids, "kn-trusted")
    ids = sides_by_size(ids, ids.count(), TRUSTED_IDS)
    base = docs.select("doc_id", "lang", "text")
    trusted = base.join(ids, "doc_id", "left_semi")
    parts = []
    for k in (0, 1):
        model = train(trusted.where(_fold() != k), order)
        parts.append(score(base.where(_fold() == k), model, order))
    scored = write_table(parts[0].unionAll(parts[1]), "kn-scored")
    limits = trusted_quantiles(scored.join(ids, "doc_id", "left_semi"), quantile, slack)
    limits = write_table(limits, "kn-limits")
    per = limits.where("not everyone").select(F.col("lang").alias("_lang"), F.col("limit").alias("own"))
    everyone = limits.where("everyone").agg(F.max("limit").alias("common"))
    out = scored.join(F.broadcast(everyone)).join(per, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    perplexity = F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_prob") / F.col("n_bytes")))
    return out.select("doc_id", "lang", "n_bytes", perplexity.alias("perplexity"), (F.coalesce("own", "common", F.lit(float("inf"))) * F.exp(F.lit(SHORT) / F.sqrt(F.greatest(F.lit(1), "n_bytes")))).alias("limit")).withColumn("keep", F.coalesce(F.col("perplexity") <= F.col("limit"), F.lit(False)))
