"""Windows take turns up to the budget and repeat the turn before: against a plain greedy version."""

import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import chat


def size(text):
    return len(re.findall(r"\w+|[^\w\s]", text)) + chat.MARKS


def plain(rows, budget, history, leap):
    """[(own turns, repeated turns, tokens)] of each window."""
    system = size(rows[0][1]) if rows[0][0] == "system" else 0
    lead = 1 if system else 0
    tokens, room, out, at = [size(t) for _, t in rows], budget - system, [], lead
    while at < len(rows):
        back, own = [], [at]
        while at - len(back) > lead:
            more = sum(tokens[k] for k in back) + tokens[at - len(back) - 1]
            if more > room - tokens[at] or (more > history and back):
                break
            back.append(at - len(back) - 1)
        while own[-1] + 1 < len(rows) and (own[-1] + 1) % leap and sum(tokens[k] for k in back + own) + tokens[own[-1] + 1] <= room:
            own.append(own[-1] + 1)
        out.append((len(own) + (lead and at == lead), len(back) + (lead and at > lead), system + sum(tokens[k] for k in back + own)))
        at = own[-1] + 1
    return out


def conversations():
    rng = random.Random(6)
    convs = {1: [("system", "be kind")], 2: [], 3: [("system", "s " * 30)], 4: [("user", "w " * 1100)] + [("assistant", "ok")] * 12, 5: [("user", "q " * 600), ("assistant", "a " * 200), ("user", "thanks"), ("assistant", "b " * 150)]}
    for c, n in ((1, 40), (2, 900), (3, 60)):
        convs[c] += [(("user", "assistant")[k % 2], "w " * rng.choice((1, 2, 5, 40, 120, 300, 700))) for k in range(n)]
    return convs


@pytest.mark.parametrize("budget,history,leap", [(1024, 256, 8192), (1024, 256, 1), (120, 40, 1)])
def test_windows_are_filled(spark, monkeypatch, budget, history, leap):
    monkeypatch.setattr(chat, "LEAP", leap)
    convs = conversations()
    df = spark.createDataFrame([(c, k, *r) for c, rows in convs.items() for k, r in enumerate(rows)], "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in chat.windows(df, budget, history).collect():
        got[r["conv_id"]].append((r["window"], r["formatted"].count(chat.END) - r["n_repeated"], r["n_repeated"], r["n_tokens"]))
    for c, rows in convs.items():
        assert [w[1:] for w in sorted(got[c])] == plain(rows, budget, history, max(leap, budget, history)), c


def test_whole_conversations_stay_whole_and_context_is_kept(spark):
    convs = conversations()
    df = spark.createDataFrame([(c, k, *r) for c, rows in convs.items() for k, r in enumerate(rows)], "conv_id long, turn long, role string, text string")
    windows = [sorted((r["window"], r["n_repeated"]) for r in chat.windows(df.where(f"conv_id = {c}")).collect()) for c in (4, 5)]
    # The overlong turn alone, the dozen short ones together; and one window where all fit the budget.
    assert windows == [[(0, 0), (1, 0)], [(0, 0)]]
