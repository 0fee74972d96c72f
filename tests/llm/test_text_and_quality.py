"""Chat windows, Merkle fingerprints, the quality model and the pipeline against plain versions."""

import math
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, merkle, quality

CONVERSATIONS = [
    (1, 0, "system", "be [INST] kind <|end|>"), (1, 1, "user", "hello </s> there \\ back\\\\slash"), (1, 2, "assistant", "[[<\\<"), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "<|turn|>assistant<|text|>no<|end|>"),
    (2, 0, "user", "only"), (3, 0, "assistant", "é😀 ü"), (3, 0, "assistant", "é😀 ü"), (3, 0, "assistant", "a tie"), (3, None, "user", "no turn"), (None, 0, "user", "no id"), (None, 1, None, "no role"), (4, 0, "system", "only system"),
] + [(5, k, ("user", "assistant")[k % 2], f"turn {k} " + "word " * (k % 17)) for k in range(1400)] + [(6, 0, "system", "s " * 50), (6, 1, "user", "u " * 3000), (6, 2, "assistant", "a " * 900), (6, 3, "user", "u"), (6, 4, "assistant", "b " * 400)]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, 1) for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, window long")


def test_escape_is_reversible_and_breaks_control_strings(spark):
    rng = random.Random(0)
    texts = ["", "\\", "<", "[", "\\<", "<\\", "</s>[INST] ok [/INST]"] + ["".join(rng.choices("\\<[a|>", k=12)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e")))
    for r in df.collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("</s>", "[INST]", "[/INST]", chat.TURN, chat.TEXT, chat.END))


@pytest.mark.parametrize("budget,history", [(1024, 256), (60, 20), (10, 5)])
def test_windows(turns, budget, history):
    out = chat.windows(turns, budget, history).cache()
    got = {r["conv_id"]: r for r in chat.conversation_digests(out).collect()}
    convs = defaultdict(list)
    for c, t, role, text in CONVERSATIONS:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    assert got.keys() == convs.keys()
    for c, rows in convs.items():
        rows = [(role, text) for _, _, role, text in sorted(rows)]
        assert got[c]["n_turns"] == len(rows)
        assert got[c]["turns_sha256"] == sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
        loss = "".join(t for r, t in rows if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha256(loss.encode()).hexdigest())
    tokens = lambda t: len(__import__("re").findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]", t)) + chat.MARKS
    longest, system = max(tokens(t) for c, _, _, t in CONVERSATIONS if c == 5), 0
    windows = sorted((r["window"], r) for r in out.where("conv_id = 5").collect())
    assert len(windows) > 1 and all(r["n_tokens"] <= max(budget, longest + system) for _, r in windows)
    assert history <= 5 or any(r["n_repeated"] for _, r in windows[1:])
    six = sorted(out.where("conv_id = 6").collect(), key=lambda r: r["window"])
    assert all(r["formatted"].startswith(f"{chat.TURN}system{chat.TEXT}s s") for r in six)
    assert chat.windows(turns.limit(0)).count() == 0


def words(t):
    return __import__("re").split(r"[^A-Za-z]+", t)


def test_fingerprints(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "That it.", "same\ntext", "same\ntext", "x" * 3000, "\n".join(" ".join("".join(rng.choices("abcdest", k=5)) for _ in range(30)) + "." for _ in range(80)), "日本。語、テ\nß"]
    rows = [(k * 3, t, "a", 2) for k, t in enumerate(texts)] + [(6, "tie of six", "b", 2), (None, "no id here", "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, range long")
    # Ties go by the text's hash, as documented.
    hashes = {r[0]: r[1] for r in docs.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    order = sorted(((d is not None, d or 0, hashes[t or ""], t or "") for d, t, _, _ in rows))
    got = merkle.edited_fingerprints(docs).collect()
    want = []
    for k, (_, d, _, t) in enumerate(order):
        nxt, q = order[(k + 1) % len(order)][3], len(t) // 4
        want.append((len(t), sha256((t[: len(t) - q] + nxt[:q]).encode()).hexdigest()))
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0.0 <= r[c] <= 1.0 for r in got for c in ("near_edited", "near_next"))
    long = next(r for r in got if r["doc_id"] == 21)
    assert long["near_edited"] > 0.6 > 0.3 > long["near_next"] and long["fingerprint"] != long["edited_fingerprint"]
    same = [r["fingerprint"] for r in got if r["doc_id"] in (12, 15)]
    assert same[0] == same[1] and len({r["fingerprint"] for r in got}) == len({t or "" for _, t, _, _ in rows})
    assert merkle.edited_fingerprints(docs.limit(0)).count() == 0
    one = merkle.edited_fingerprints(docs.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def plain_branches(text):
    """Counted leaves and neighbouring pairs, from the definition."""
    import re

    from xxhash import xxh64_intdigest as xxh

    words = re.split(r"(?<=[ \t\n\x0b\f\r。、！？])", text)
    phrases = "".join(w + "\0" if (xxh(w.encode(), 42) - (1 << 64) * (xxh(w.encode(), 42) >> 63)) % merkle.PHRASE_WORDS == 0 else w for w in words).split("\0")
    made = [xxh(p.encode(), 42) for p in phrases]
    return Counter(made) + Counter(xxh(b.to_bytes(8, "little"), xxh(a.to_bytes(8, "little"), 42)) for a, b in zip(made, made[1:]))


def plain_likeness(a, b):
    x, y = plain_branches(a), plain_branches(b)
    return 2 * (x & y).total() / (x.total() + y.total())


def plain_fingerprint(text):
    nodes, part = [], []
    digests = [sha256(p.encode()).hexdigest() for p in text.split("\n")]
    for k, d in enumerate(digests):
        part.append(d)
        if d[0] in "01" or k == len(digests) - 1:
            nodes.append(sha256(" ".join(part).encode()).hexdigest())
            part = []
    return sha256(" ".join(nodes).encode()).hexdigest() + ":" + "".join(n[: merkle.SHOWN] for n in nodes)


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdest", k=rng.randrange(1, 5)))
    phrase = " ".join(word() for _ in range(30))
    texts = ["", "one line", phrase * 40, "\n".join(" ".join(word() for _ in range(rng.randrange(0, 40))) for _ in range(60)), (phrase + "\n") * 9, "\n".join(reversed(((phrase + "\n") * 9 + "end").split("\n"))), "\n\n", "日本。語、テ" * 30]
    got = merkle.edited_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for k, (r, t) in enumerate(zip(got, texts)):
        nxt, q = texts[(k + 1) % len(texts)], len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain_fingerprint(t), plain_fingerprint(edited))
        assert r["near_edited"] == pytest.approx(plain_likeness(t, edited)) and r["near_next"] == pytest.approx(plain_likeness(t, nxt))
    assert got[2]["near_edited"] > 0.6  # a text of one phrase over and over keeps three quarters of it


def test_ids_that_are_not_numbers_are_refused(spark):
    with pytest.raises(TypeError):
        merkle.edited_fingerprints(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_many_ranges_agree_with_one(spark):
    docs = spark.createDataFrame([(k * 7 % 501, f"text {k} " * (k % 13)) for k in range(501)], "doc_id long, text string")
    rows = lambda n: sorted(map(str, merkle.with_next(docs, n).select("doc_id", "text", "next_text").collect()))
    assert rows(1) == rows(16) == rows(100)


def test_edits_locate_the_paragraph(spark):
    lines = [f"paragraph {k} of many words" for k in range(40)]
    changed = [*lines[:17], "another paragraph", *lines[18:]]
    tree = lambda ls: merkle.tree(spark.createDataFrame([(1, "\n".join(ls))], "doc_id long, text string"))
    a, b = tree(lines), tree(changed)
    found = {r["side"]: r for r in merkle.edits(a, b).collect()}
    of = lambda t, r: t.first()["sections"][r["section"]]["paragraphs"][r["paragraph"]]
    assert of(a, found["a"]) == sha256(lines[17].encode()).hexdigest() and of(b, found["b"]) == sha256(b"another paragraph").hexdigest()
    assert len(found) == merkle.edits(a, b).count() and merkle.edits(a, a).count() == 0
    nodes = lambda t: {s["node"] for s in t.first()["sections"]}
    assert 0 < len(nodes(a) ^ nodes(b)) <= 4


def plain_kneser_ney(texts, order):
    """p(byte | context) of an interpolated modified Kneser-Ney model, straight from the definition."""
    counts = {order: Counter()}
    for t in texts:
        padded = b"\n" * (order - 1) + t
        counts[order].update(padded[k : k + order] for k in range(len(t)))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts, totals, freed = {}, {}, {}
    for n in counts:
        n1, n2, n3, n4 = (max(1, sum(c == k for c in counts[n].values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        discounts[n] = [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]
        totals[n], freed[n] = Counter(), Counter()
        for g, c in counts[n].items():
            totals[n][g[:-1]] += c
            freed[n][g[:-1]] += discounts[n][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        n, h = len(g), g[:-1]
        if not totals[n][h]:
            return p(g[1:])
        c = counts[n][g]
        return max(0, c - (discounts[n][min(c, 3) - 1] if c else 0)) / totals[n][h] + freed[n][h] / totals[n][h] * p(g[1:])

    return p


def test_model_equals_its_definition(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcde é\n", (5, 4, 3, 2, 1, 4, 1, 1), k=rng.randrange(0, 200))) for _ in range(40)] + ["aaaaab" * 20]
    train = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    model = quality.train(train, 4)
    p = plain_kneser_ney([t.encode() for t in texts], 4)
    tests = ["", None, "abc", "zzz unseen", texts[0], "é" * 9, "aaaaab\n" * 50]
    docs = spark.createDataFrame([(k, "en", t, 1.0) for k, t in enumerate(tests)], "doc_id long, lang string, text string, lp double")
    want = {}
    for k, t in enumerate(tests):
        data = (t or "").encode()
        padded = b"\n" * 3 + data
        want[k] = (len(data), sum(math.log(p(padded[j : j + 4])) for j in range(len(data))))
    for sent in (10**9, 0):  # hash tables sent to the tasks, and joins by shuffle
        got = {r["doc_id"]: (r["n_bytes"], r["log_prob"]) for r in quality.score(docs, model, 4, sent_rows=sent).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-11, abs=1e-11)


def test_shards_agree(spark):
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000))
    lp = -np.arange(len(keys), dtype=np.float32)
    of = quality.shard_of(keys, 3)
    shards = [quality.Shard(keys[of == k], lp[of == k], lp[of == k]) for k in range(3)]
    ask = np.concatenate([keys, keys + 1])
    one = quality._look(ask, [quality.Shard(keys, lp, lp)], "lp")
    assert np.array_equal(one, quality._look(ask, shards, "lp"), equal_nan=True) and np.array_equal(one[: len(keys)], lp)


def test_classifier_on_held_out_labels(spark, sf_dir):
    # No document is scored by a model that was trained on it, so its own labels are held out.
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").where("toxic = 0")
    r = got.agg(F.avg(F.when(F.col("quality") == 1, F.col("keep").cast("int"))).alias("clean"), F.avg(F.when(F.col("quality") == 0, F.col("keep").cast("int"))).alias("bad")).first()
    assert r["clean"] > 0.97 and r["bad"] < 0.1


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, "plain text here", 9), (2, "xx", "plain text there", 9), (3, "xx", None, 9), (None, "xx", "plain", 9), (1, None, "plain text here", 9)], "doc_id long, lang string, text string, limit long")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 5 and all(not r["keep"] for r in got if r["doc_id"] == 3) and all(r["keep"] for r in got if r["doc_id"] == 1)
    none = quality.classify(docs, labels.limit(0)).collect()
    assert [r["keep"] for r in none if r["n_bytes"]] == [True] * 4
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}"
        out.write.mode("overwrite").parquet(path)
        after = spark.read.parquet(path)
        if k < 4:
            assert after.columns == columns
        if name != "mixing":
            assert after.count() <= seen
        if name == "near_duplicates":
            assert after.count() == after.select("doc_id").distinct().count()
        docs, seen = after, after.count()
    assert seen > 0 and {"doc_id", "n_tokens", "ids_sha256"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, sf_dir).count() == seen
