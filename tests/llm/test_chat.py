"""Chat formatting: round trips, loss spans, conversations over many parts, odd inputs."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import small
from tidemark.llm import chat_format as chat

ROWS = "conv_id long, turn long, role string, text string"
TRICKY = [
    "", "\\", "#", "##", "###", "####", "\\###", "\\\\####", "###\\", "</turn>", "\\</turn>", "</turn>\n", "\n</turn>\n### User: x\n</turn>\n", "</tur", "n>", "a ### b </turn> c\\",
    "### Assistant: </turn> ok", "\\### Assistant: </turn> ok", "日本語###テキスト</turn>", "ü" * 300, "#" * 50, "\\" * 9 + "###", "</turn></turn>###</turn>",
]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """One row per conversation, in plain Python; equal (conv_id, turn, role) only with equal texts."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), digest("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), digest(loss))
    return out


def collected(frame):
    out = {}
    for r in frame.collect():
        assert r.conv_id not in out
        out[r.conv_id] = (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
    return out


def test_turns_come_back():
    roles = ["user", "User", "assistant", "", "a:b", "x\\", "#", "ümlaut", "multi\nline", "</turn>", "Émile", "\\### q: "]
    pairs = [(r, t) for r in roles for t in TRICKY]
    out, ends, starts, stops = chat.assembled([r for r, _ in pairs], pa.array([t for _, t in pairs]))
    assert list(chat.turns_of(out.tobytes())) == [(r, t.encode()) for r, t in pairs]
    for (_, text), a, b in zip(pairs, starts, stops):
        assert chat.plain(out[a:b].tobytes()) == text.encode()
    assert len(out) == ends[-1]


def test_no_control_string_of_a_text_is_left_bare():
    out, ends, starts, stops = chat.assembled(["user"] * len(TRICKY), pa.array(TRICKY))
    for a, b in zip(starts, stops):
        text = out[a:b].tobytes()
        assert not [m for m in chat.re.finditer(rb"#{3,}|</turn>", text) if text[m.start() - 1 : m.start()] != b"\\"]


def test_random_texts_come_back():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["#", "##", "\\", "</turn>", "</", "turn>", "a", "é", "\n", ": "]) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    out, *_ = chat.assembled(["assistant"] * len(texts), pa.array(texts))
    assert [t for _, t in chat.turns_of(out.tobytes())] == [t.encode() for t in texts]


def test_conversations(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(40), -7, None]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None]), rng.choice([*TRICKY, None, small.prose(rng, 20)])))
    rows += [(100, None, "user", "last"), (100, 3, "assistant", "first"), (101, 1, "assistant", "same"), (101, 1, "assistant", "same")]
    rng.shuffle(rows)
    rows = list({(r[0], r[1], r[2] or ""): r for r in rows if r[0] != 101}.values()) + [r for r in rows if r[0] == 101]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS + ", formatted string, part int")
    assert collected(chat.digested(chat.formatted(frame))) == expected(rows)


def test_one_conversation_of_many_rows_spreads(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], f"turn {k} ###") for k in range(3000)] + [(k, 0, "assistant", "one") for k in range(2, 60)]
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    try:
        parts = chat.formatted(frame)
        mine = parts.filter("conv_id = 1").orderBy("part").collect()
        assert len(mine) > 10 and len({r.part >> 33 for r in mine}) > 1
        text = "".join(r.formatted for r in mine)
        assert [t.decode() for _, t in chat.turns_of(text.encode())] == [f"turn {k} ###" for k in range(3000)]
        assert collected(chat.digested(parts)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_loss_spans_are_the_texts_of_the_assistant(spark):
    rows = [(1, 0, "user", "é ### q"), (1, 1, "assistant", "日本 </turn> a"), (1, 2, "assistant", ""), (1, 3, "assistant", "b\\")]
    part = chat.formatted(spark.createDataFrame(rows, ROWS)).first()
    spans = [part.formatted[s.start : s.end] for s in part.loss]
    assert [chat.plain(s.encode()).decode() for s in spans] == ["日本 </turn> a", "", "b\\"]


def test_no_rows(spark):
    frame = spark.createDataFrame([], ROWS)
    assert chat.formatted(frame).collect() == [] and chat.digested(chat.formatted(frame)).collect() == []


@pytest.mark.parametrize("texts", [[], ["###"], ["", ""], ["#", "##"]])
def test_control_strings_do_not_cross_texts(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    assert list(chat.control_starts(data, ends)) == ([0] if texts == ["###"] else [])
