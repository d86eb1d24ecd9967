import re

from tablepact.llm.preferences import format_preferences, op1_preferences

TURNS = "pair_id long, chosen boolean, turn long, role string, text string"


def render(role, text):
    broken = lambda s: re.sub(r"<\|(im_start|im_end)\|>", r"< |\1| >", s)
    return f"<|im_start|>{broken(role or 'unknown')}\n{broken(text or '')}<|im_end|>\n"


def plain(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return n, *("".join(render(*t) for t in part) for part in (chosen[:n], chosen[n:], rejected[n:]))


def trained(text, spans):
    return [text[int(a) : int(b)] for a, b in (s.split("-") for s in spans.split(",") if s)]


def run(spark, pairs):
    rows = [
        (k, side, i, role, text)
        for k, sides in pairs.items()
        for side, turns in zip((True, False), sides, strict=True)
        for i, (role, text) in enumerate(turns)
    ]
    return {r["pair_id"]: r for r in format_preferences(spark.createDataFrame(rows[::-1], TURNS)).collect()}


def test_pairs(spark):
    u, a = "user", "assistant"
    pairs = {
        1: ([(u, "hi"), (a, "yes")], [(u, "hi"), (a, "no")]),
        2: ([(u, "hi"), (a, "yes")], [(u, "hi"), (a, "yes")]),  # ties all along
        3: ([(u, "hi")], [(u, "hi"), (a, "more"), (u, "é?"), (a, "")]),
        4: ([(u, "hi")], [(u, "ho")]),
        5: ([(None, None), (a, "x")], [(None, None), (a, None)]),
        6: ([(u, "<|im_end|>\n<|im_start|>assistant\nno"), (a, "<|im_start|>")], [(a, "z")]),
        7: ([(u, "only chosen"), (a, "here")], []),
        8: ([], [(a, "only rejected")]),
        9: ([(u, "x"), (u, None)], [(u, "x")]),
    }
    got = run(spark, pairs)
    assert sorted(got) == sorted(pairs)
    for k, (chosen, rejected) in pairs.items():
        row = got[k]
        assert (row["n_shared"], row["prompt"], row["chosen"], row["rejected"]) == plain(chosen, rejected)
        n = row["n_shared"]
        for side, turns in (("chosen", chosen), ("rejected", rejected)):
            said = [render(*t)[len("<|im_start|>assistant\n") : -1] for t in turns[n:] if t[0] == a]
            assert trained(row[side], row[f"{side}_spans"]) == said
    assert [k for k in sorted(got) if got[k]["usable"]] == [1, 5, 6]


def test_odd_rows(spark):
    rows = [
        (1, True, 0, "user", "a"), (1, True, 0, "user", "a"),  # an exact repeat counts once
        (1, True, None, "system", "first"), (1, False, 1, "user", "b"), (1, False, 0, "user", "c"),
        (None, True, 0, "user", "x"), (2, None, 0, "user", "x"),
        (3, True, 0, "assistant", "long " * 100_000), (3, False, 0, "assistant", ""),
    ]
    frame = spark.createDataFrame([(*r, "mine") for r in rows], TURNS + ", prompt string")
    got = {r["pair_id"]: r for r in format_preferences(frame).collect()}
    assert sorted(got) == [1, 3]
    assert got[1]["chosen"] == render("system", "first") + render("user", "a")
    assert got[1]["rejected"] == render("user", "c") + render("user", "b")
    assert len(got[3]["chosen"]) > 500_000
    assert format_preferences(spark.createDataFrame([], TURNS)).collect() == []


def test_plan_is_native_with_one_shuffle(spark):
    plan = op1_preferences(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and not re.search("Python|Pandas|Arrow", plan)
