"""Lines that differ in a character or a word are linked, at the lengths that lines have."""

import random

import pytest

from tidemark.llm import lines as L

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def line(rng, n):
    words = []
    while sum(map(len, words)) + len(words) < n + 1:
        words.append("".join(rng.choices(LETTERS, k=rng.randrange(2, 9))))
    return " ".join(words)[:n]


def pairs(n, edit, seed, count=60):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        a = line(rng, n)
        at = rng.randrange(3, n - 3)
        new = rng.choice(LETTERS.replace(a[at], ""))
        if edit == "word":  # a word in the middle is replaced by one of as many letters
            words = a.split()
            k = min(range(len(words)), key=lambda k: abs(k - len(words) // 2))
            words[k] = "".join(rng.choices(LETTERS, k=4))
            b = " ".join(words)
        else:
            b = {"change": a[:at] + new + a[at + 1 :], "insert": a[:at] + new + a[at:], "drop": a[:at] + a[at + 1 :]}[edit]
        out.append((a, b))
    return out


def linked(spark, cases):
    rows = [(k, f"{a}\n{b}") for k, (a, b) in enumerate(cases)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sum(r["n_removed"] == 1 for r in L.removed_lines(docs).collect())


@pytest.mark.parametrize("edit", ["change", "insert", "drop"])
def test_one_character(spark, edit):
    cases = [p for n in (24, 32, 40, 58, 78, 100) for p in pairs(n, edit, n)]
    assert linked(spark, cases) >= 0.98 * len(cases)


def test_one_word(spark):
    cases = [p for n in (90, 100) for p in pairs(n, "word", n)]
    assert linked(spark, cases) >= 0.95 * len(cases)


def test_line_lengths_around_the_bounds(spark):
    rng = random.Random(9)
    cases = [(a := line(rng, n), a[:-4]) for n in (98, 102, 104, 198, 202, 204, 600) for _ in range(10)]
    assert linked(spark, cases) == len(cases)


def test_long_lines_of_the_same_words_stay(spark):
    rng = random.Random(8)
    words = [line(rng, 5) for _ in range(150)]
    cases = [(" ".join(rng.choices(words, k=1500)), " ".join(rng.choices(words, k=1500))) for _ in range(3)]
    assert linked(spark, cases) == 0


def test_repeats_of_any_length_stay_linked(spark):
    assert linked(spark, [("-" * 60, "-" * 300), ("spam and eggs " * 6, "spam and eggs " * 40)]) == 2


def test_documents_are_hashed_once_not_once_a_line(spark):
    docs = spark.createDataFrame([(1, "a\nb\n"), (2, None), (3, "\n\nü 𝄞\n")], "doc_id long, text string")
    plan = L.occurrences(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and plan.index("Generate") < plan.index("xxhash64")
    assert {r["doc_id"]: r["n_lines"] for r in L.removed_lines(docs).collect()} == {1: 3, 2: 1, 3: 4}
