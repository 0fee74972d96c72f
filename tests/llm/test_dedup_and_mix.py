"""SimHash groups, line dedup, mixing and components against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

pytest.importorskip("xxhash")
from xxhash import xxh64_intdigest  # noqa: E402

from tidemark.llm import lines as L  # noqa: E402
from tidemark.llm import mixing, simhash  # noqa: E402
from tidemark.llm.components import components  # noqa: E402


def joined(n, links):
    """Component's smallest member of each of range(n)."""
    top = list(range(n))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(500 + k, 501 + k) for k in range(60)] + [(900, k) for k in range(901, 980)]
    want = joined(1000, edges)
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {k: want[k] for e in edges if e[0] != e[1] for k in e}
    assert components(df.limit(0)).count() == 0


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \t", "one", "One  two", "a b c", "A b\nc", "é è ü ö", "the same words again " * 30, "the same words again " * 31, "x " * 4000, "ÀB c d e"]


def test_fingerprints_and_groups(spark):
    rng = random.Random(1)
    base = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(300))
    near = [base.replace(base.split()[k], "zz", 1) for k in range(0, 300, 10)]
    rows = [*TEXTS, base, *near, base]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(rows)] + [(None, base, "x")], "doc_id long, text string, fp string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t or "") for t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = joined(len(rows), links)
    for k in range(len(rows)):
        assert got[k]["fingerprint"] == f"{prints[k]:016x}" and got[k]["component_id"] == want[k]
    assert got[None]["component_id"] == want[len(TEXTS)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shard_rows", [4096, 20])
def test_links_lose_none(spark, shard_rows):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:60]:
        for _ in range(rng.randrange(1, 6)):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    hot = rng.getrandbits(64)
    prints |= {hot ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    place = {s: k for k, s in enumerate(signed)}
    found = [(place[r["a"]], place[r["b"]]) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), shard_rows=shard_rows).collect()]
    want = [(a, b) for a, b in combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert joined(len(prints), found) == joined(len(prints), want)
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in found)


def jaccard(a, b, width=L.SHINGLE):
    s = lambda t: {t.lower().ljust(width, "\0")[k : k + width] for k in range(max(1, len(t) - width + 1))}
    return len(s(a) & s(b)) / len(s(a) | s(b))


def similar(a, b, kinds=L.KINDS):
    """By any kind of shingles that suits both lines."""
    return any(least <= min(len(a), len(b)) and max(len(a), len(b)) <= most and jaccard(a, b, width) >= L.SIMILAR for width, least, most in kinds)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9)))
    own = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    out = []
    for line in own[:50]:
        words = line.split()
        for _ in range(rng.randrange(0, 4)):
            w = list(words)
            for _ in range(max(1, len(w) // 12)):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    return own + out


def lines_table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, line string")


def test_bucket_links_equal_all_pairs(spark):
    from pyspark.sql import functions as F

    texts = corpus()
    all_ = lines_table(spark, texts).agg(F.array_sort(F.collect_list(F.struct("id", "line"))).alias("m"))
    for bits in (1, 2, 4, 8, 15):
        kinds = [k for i, k in enumerate(L.KINDS) if bits >> i & 1]
        want = [(a, b) for a, b in combinations(range(len(texts)), 2) if similar(texts[a], texts[b], kinds)]
        p = all_.select(L.bucket_links(spark, F.col("m.id"), F.col("m.line"), F.lit(bits)).alias("p")).first()["p"]
        assert joined(len(texts), list(zip(p[::2], p[1::2]))) == joined(len(texts), want)


def test_likeness_is_exact(spark):
    from pyspark.sql import functions as F

    texts = corpus(11)
    pairs = [(a, b, w) for a, b in combinations(texts[:40] + texts[-40:], 2) for w in (3, 8)]
    df = spark.createDataFrame(pairs, "a string, b string, w int")
    got = {(r["a"], r["b"], r["w"]): r["j"] for r in df.withColumn("j", L.likeness(spark, F.col("a"), F.col("b"), F.col("w"), 0.6)).collect()}
    for (a, b, w), j in got.items():
        want = jaccard(a, b, w)
        assert j == (pytest.approx(want) if want >= 0.6 else -1.0)


def test_band_keys_recall(spark):
    texts = sorted({t for seed in (4, 5) for t in corpus(seed)})
    keys = [set(r["k"]) for r in lines_table(spark, texts).select("id", L.band_keys(spark, L.F.col("line")).alias("k")).orderBy("id").collect()]
    want = [(a, b) for a, b in combinations(range(len(texts)), 2) if similar(texts[a], texts[b])]
    hit = sum(bool(keys[a] & keys[b]) for a, b in want)
    assert len(want) > 30 and hit >= 0.98 * len(want)


@pytest.mark.parametrize("chunk, chunk_bytes", [(L.CHUNK, L.CHUNK_BYTES), (3, L.CHUNK_BYTES), (L.CHUNK, 150)])
def test_links_of_small_and_large_buckets(spark, chunk, chunk_bytes):
    rng = random.Random(6)
    base = "a line that very many documents share with small edits of their own, number "
    texts = sorted({*corpus(12), *(base + str(rng.randrange(10**6)) for _ in range(60)), *(base[k % 70 :] + base[: k % 70] for k in range(70))})
    found = [(r["a"], r["b"]) for r in L._links(lines_table(spark, texts), chunk, chunk_bytes).collect()]
    assert all(similar(texts[a], texts[b]) for a, b in found)
    want = [(a, b) for a, b in combinations(range(len(texts)), 2) if similar(texts[a], texts[b])]
    got, all_ = joined(len(texts), found), joined(len(texts), want)
    assert sum(x == y for x, y in zip(got, all_)) >= 0.99 * len(texts)


def test_removed_lines_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 3000")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    first, places = {}, []
    for doc, text in rows:
        for k, line in enumerate(text.split("\n")):
            if line.strip(" "):
                places.append((doc, k, line))
                first.setdefault(line, len(first))
    texts = list(first)
    root = joined(len(texts), [(a, b) for a, b in combinations(range(len(texts)), 2) if min(len(texts[a]), len(texts[b])) > 0.5 * max(len(texts[a]), len(texts[b])) and similar(texts[a], texts[b])])
    seen, want = set(), set()
    for doc, k, line in places:
        c = root[first[line]]
        if c in seen:
            want.add((doc, k))
        seen.add(c)
    got = {(r["doc_id"], k) for r in L.removed_lines(docs).collect() for k in r["removed_lines"]}
    assert len(want) > 20 and len(got ^ want) <= 0.02 * len(want)


def test_line_dedup(spark):
    long = "the quick brown fox jumps over the lazy dog and runs far away from here tonight"
    rows = [
        (3, f"{long}\nmine\n\n  \nlast of three"), (1, f"first\n{long.replace('tonight', 'tonigth')}\nmine"), (2, "mine\nmine"), (4, None), (5, ""), (None, "nobody\nmine"), (6, "mine\n" + long), (7, "x" * 70000), (8, "x" * 70001),
    ]
    docs = spark.createDataFrame([(d, t, "en", 5) for d, t in rows], "doc_id long, text string, line string, n long")
    got = {r["doc_id"]: (r["n_lines"], r["removed_lines"]) for r in L.removed_lines(docs).collect()}
    assert got[None] == (2, []) and got[1] == (3, [2]) and got[2] == (2, [0, 1]) and got[3] == (5, [0, 1]) and got[6] == (2, [0, 1]) and got[4] == (1, []) and got[5] == (1, []) and got[8] == (1, [0])
    kept = {r["doc_id"]: r["text"] for r in L.dedup(docs).collect()}
    assert kept == {None: "nobody\nmine", 1: "first\n" + long.replace("tonight", "tonigth"), 3: "\n  \nlast of three", 4: None, 5: "", 7: "x" * 70000}
    assert L.dedup(docs).columns == docs.columns and L.dedup(docs.limit(0)).count() == 0


def test_targets(spark):
    sizes = {"b": 100, "a": 1000, "Z": 10, None: 50, "c": 0, "aa": 400}
    total, order = sum(sizes.values()), sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(total)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    df = spark.createDataFrame([(s, n - n // 2) for s, n in sizes.items()] + [(s, n // 2) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(target)


def test_mix(spark):
    rng = random.Random(5)
    rows = [(k, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))), rng.choice(["a", "a", "a", "b", None])) for k in range(6000)] + [(7, None, "a"), (None, "x y", "b"), (None, "x y", "b")]
    docs = spark.createDataFrame([(d, t, s, 1) for d, t, s in rows], "doc_id long, text string, source string, p long")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    taken, target = defaultdict(int), {}
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pivot_keeps_words_and_expectations():
    sizes = [50, 40, 30, 20, 10, 5, 3, 2, 1, 1] * 3
    ps = [0.3] * len(sizes)
    means = np.zeros(len(sizes))
    for seed in range(600):
        out = mixing.pivot(list(range(len(sizes))), sizes, ps, seed)
        assert sum(0.0 < p < 1.0 for p in out) <= 1
        assert sum(s * p for s, p in zip(sizes, out)) == pytest.approx(sum(s * p for s, p in zip(sizes, ps)))
        means += out
    assert np.abs(means / 600 - 0.3).max() < 0.09
