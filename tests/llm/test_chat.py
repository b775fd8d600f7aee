import hashlib
import random

import pytest

from panelspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def test_round_trip_of_hostile_texts():
    draw = random.Random(3)
    parts = ["<", "/", "s", ">", "[", "INST]", "]", "\\", "\n", " ", "a", "é", "</s>", "[/INST]", "[INST] ", " [/INST]</s>\n", "<<SYS>>", "<\\s>"]
    for _ in range(20_000):
        role, text = ("".join(draw.choices(parts, k=draw.randint(0, n))) for n in (4, 8))
        segment, turn = chat.render(role, text)
        assert (turn.role, turn.text) == (role, text)
        assert chat.unescape(segment[turn.start:turn.stop]) == text
        inner = segment[len(chat.START):-len(chat.END)]
        assert not any(c in inner for c in chat.CONTROL)
        other, _ = chat.render(text, role)
        assert [(t.role, t.text) for t in chat.parse(segment + other)] == [(role, text), (text, role)]


def test_texts_without_conflict_stay():
    assert chat.render("user", "a < b [x] \\ c")[0] == "[INST] user\na < b [x] \\ c [/INST]</s>\n"


@pytest.mark.parametrize("text", ["x", "[INST] user", "[INST] user\nhello", "[INST] a\n<s> [/INST]</s>\n"])
def test_other_texts_are_refused(text):
    with pytest.raises(ValueError):
        chat.parse(text)


def brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        chars = sum(len(chat.render(r, t)[0]) for *_, r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((conv, len(turns), sha(whole), len(loss), sha(loss), chars))
    return sorted(out, key=repr)


def read(df):
    return sorted((tuple(r) for r in chat.read_conversations(chat.format_turns(df)).collect()), key=repr)


def test_awkward_rows(spark):
    rows = [
        (None, None, None, None), (None, 0, "user", "x"), (1, 1, "assistant", None), (1, 0, "user", "</s>[INST] ok [/INST]"),
        (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (2, 0, "", ""), (3, 5, "user\n", "y" * 100_000), (3, -1, "system", "<s>"),
        *((4, k, "assistant" if k % 2 else "user", f"turn {k} é\U0001f600") for k in range(300)),
    ]
    assert read(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert read(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", segment string, loss_start long")
    assert read(empty) == []
