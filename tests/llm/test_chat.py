"""Round trips of conversations."""

import hashlib
import random

import pytest

from shelfcast.llm import chat

HARD = [
    "", "\\", "\\\\", "### ", "\\### Assistant: </turn> ok", " </turn>\n", "</turn>\n### user: x", ": ", "a: b",
    "\\</turn>", "\\\\</turn>\n", " ", "### user: hi </turn>\n", "x </turn>", "\\: \\", "\n\n", " \\",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_turns(text):
    for role in ["user", "assistant", "", "a: b", "### ", "\\"]:
        turns = [(role, text), ("assistant", text), (role, text + text)]
        assert chat.read_back(chat.render(turns)) == turns


def test_random_turns():
    rng = random.Random(7)
    parts = ["\\", "### ", ": ", " </turn>\n", "</turn>", "a", " ", "\n", "#", "é"]
    for _ in range(3000):
        turns = [
            ("".join(rng.choices(parts, k=rng.randrange(3))), "".join(rng.choices(parts, k=rng.randrange(9))))
            for _ in range(rng.randrange(1, 5))
        ]
        assert chat.read_back(chat.render(turns)) == turns


def test_plain_text_stays_plain():
    assert chat.render([("user", "C:\\dir\\file #1")]) == "### user: C:\\dir\\file #1 </turn>\n"


def test_rows(spark):
    rows = [
        (1, 1, "assistant", "### x", 0), (1, 0, "user", None, 0), (None, 0, "user", "lost", 0),
        (2, None, None, "b", 0), (2, 3, "assistant", "one", 0), (2, 3, "assistant", "one", 0),
        (2, 4, "assistant", "two " * 50_000, 0),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.format_conversations(frame).collect()}
    assert set(got) == {1, 2, None}
    n, said, chars, loss, length = chat.digests(got[1].formatted, got[1].loss_spans)
    assert (n, chars, length) == (2, 5, len(got[1].formatted))
    assert said == hashlib.sha256(b"user\n\nassistant\n### x\n").hexdigest()
    assert loss == hashlib.sha256(b"### x").hexdigest()
    n, _, chars, _, _ = chat.digests(got[2].formatted, got[2].loss_spans)
    assert (n, chars) == (4, 6 + 200_000)
    assert chat.format_conversations(frame.limit(0)).collect() == []
