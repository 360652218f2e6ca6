"""Chat windows against plain code that cuts them turn by turn."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from folioscope.llm import chat

ROWS = "conv_id long, turn long, role string, text string, window int, room string"
TOKEN = regex.compile(r"\\[slg]|\p{L}+|\p{N}+|[^ \t\n\x0b\f\r\p{L}\p{N}\\]+")


def escaped(text):
    return (text or "").replace("\\", "\\s").replace("<", "\\l").replace(">", "\\g")


def cost(role, text):
    return 6 + len(TOKEN.findall(role)) + len(TOKEN.findall(text))


def plain(turns, budget, history):
    """Formatted windows of one conversation; its turns are in order, at most a stretch long or cut there."""
    turns = [(escaped(role), escaped(text)) for role, text in turns]
    system = None
    if turns[0][0] == "system" and cost(*turns[0]) * 2 <= budget - history:
        system = turns[0]
    room = budget - history - (cost(*system) if system else 0)
    parts, at = [], 0
    for role, text in turns:
        marks = cost(role, "")
        step = max(room - marks, 1)
        ends = [m.end() for m in TOKEN.finditer(text)]
        cuts = [0, *ends[step - 1 : len(ends) - 1 : step], len(text)]
        pieces = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        for k, piece in enumerate(pieces):
            size = cost(role, piece)
            written = f"<{'part' if k else 'turn'} {role}>\n", piece, f"</{'turn' if k == len(pieces) - 1 else 'part'}>\n"
            parts.append((at, at + size, role, written))
            at += size
    windows = []
    for part in parts:
        begin = windows[-1][0][0] if windows else None
        held = begin is not None and part[1] <= begin + (room if begin else budget)
        if held and part[0] // (room * 64) == begin // (room * 64):
            windows[-1].append(part)
        else:
            windows.append([part])
    result = []
    for new in windows:
        begin = new[0][0]
        again = [p for p in parts if p[1] <= begin <= p[0] + history and not (system and p[0] == 0)]
        lead = [(0, 0, "system", ("<turn system>\n", system[1], "</turn>\n"))] if system and begin else []
        text, loss = "", []
        for p in lead + again + new:
            if p[2] == "assistant" and p in new:
                loss.append((len(text) + len(p[3][0]), len(p[3][1])))
            text += "".join(p[3])
        result.append((len(lead + again), text, loss))
    return result


def words(rng, n):
    signs = ["a", "bc", "42", "\\", "<turn x>", "é", "…", "\\l", "漢字", "x.y", "</turn>", "\n"]
    return "".join(rng.choice(signs) + rng.choice([" ", "", "\t", " "]) for _ in range(n))


def talks():
    rng = random.Random(3)
    made = {}
    for conv in range(12):
        count = rng.choice([1, 2, 7, 40, 400])
        longest = rng.choice([3, 12, 300])
        turns = [(("user", "assistant")[k % 2], words(rng, rng.randrange(longest))) for k in range(count)]
        if conv % 3 == 0:
            turns.insert(0, ("system", words(rng, 8 if conv % 2 else 90)))
        made[conv] = turns
    made[20] = [("user", words(rng, 5000)), ("assistant", "yes " * 2000), ("assistant", "")]
    made[21] = [("assistant", "one two three " * 7 + " " * 5)]
    made[22] = [("system", "only")]
    return made


@pytest.mark.parametrize("budget,history", [(120, 40), (64, 0)])
def test_windows_are_those_of_plain_code(spark, budget, history):
    talk = talks()
    rows = [(c, k, r, t, 1, "x") for c, turns in talk.items() for k, (r, t) in enumerate(turns)]
    found = chat.windows(spark.createDataFrame(rows, ROWS).repartition(5), budget, history)
    got = {}
    for w in found.withColumn("tokens", F.regexp_count("formatted", F.lit(chat.TOKEN))).orderBy("window").collect():
        got.setdefault(w.conv_id, []).append((w.repeated, w.formatted, [tuple(x) for x in w.loss]))
        assert w.tokens <= budget
        assert w.formatted.count("<turn ") + w.formatted.count("<part ") > w.repeated
    assert got == {c: plain(turns, budget, history) for c, turns in talk.items()}


def test_windows_are_as_full_as_turns_allow(spark):
    turns = [(1, k, ("user", "assistant")[k % 2], "word " * 20, 0, "") for k in range(3000)]
    found = chat.windows(spark.createDataFrame(turns, ROWS), 512, 128).collect()
    fresh = [w.formatted.count("<turn ") - w.repeated for w in found]
    assert sum(fresh) == 3000 and sum(n < 14 for n in fresh) <= len(fresh) / 32  # 14 turns of 27 tokens fit 384


def test_very_long_turns_and_equal_rows(spark):
    many = 300_000
    rows = [(1, 0, "assistant", "x" * 3_000_000, 0, ""), (2, 0, "user", "a b\n" * many, 0, "")]
    rows += [(3, 0, "assistant", "same words " * 50, 0, "")] * 5 + [(None, None, None, None, 0, "")] * 2
    found = chat.windows(spark.createDataFrame(rows, ROWS), 256, 64)
    read = {r.conv_id: r for r in chat.read_back(found).collect()}
    assert {c: r.n_turns for c, r in read.items()} == {1: 1, 2: 1, 3: 5, None: 2}
    assert read[1].loss_chars == 3_000_000 and read[3].loss_chars == 5 * len("same words " * 50)
    assert found.filter("conv_id = 2").count() == -(-2 * many // (192 - 7))
    assert found.select(F.max(F.regexp_count("formatted", F.lit(chat.TOKEN)))).head()[0] <= 256
