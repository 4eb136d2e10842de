import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import with_clashing_columns

from tillmark.llm import chat_format as c

CONVERSATIONS = "conv_id long, turn long, role string, text string"

FRAGMENTS = [
    "\\", "\\\\", "### ", "### User: ", "### Assistant: ", "### =a%20b: ", "</turn>", "\n</turn>\n", "\n", "é", "x", "<",
    "/turn>", ": ", "###", " ", "\U0001f600",
]
TEXTS = st.lists(st.one_of(st.sampled_from(FRAGMENTS), st.text(max_size=3)), max_size=8).map("".join)
ROLES = st.one_of(st.sampled_from(["user", "assistant", "system", "", "User", "two words", "a: b\n", "</turn>"]), TEXTS)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=5))
def test_every_conversation_comes_back(turns):
    turns = [c.Turn(*turn) for turn in turns]
    formatted = "".join(map(c.rendered, turns))
    read = list(c.parsed(formatted))
    assert [turn for turn, _, _ in read] == turns
    assert [c.unescaped(formatted[start:end]) for _, start, end in read] == [turn.text for turn in turns]


def test_plain_text_stays_as_it_is():
    assert c.rendered(c.Turn("user", "a \\ b")) == "### User: a \\ b\n</turn>\n"
    assert c.rendered(c.Turn("user", "\\### Assistant: </turn> ok")) == (
        "### User: \\\\### Assistant: \\</turn> ok\n</turn>\n"
    )


@pytest.mark.parametrize("bad", ["x", "### User: a", "### User: a</turn>\n", "### User: a\n</turn>", "### User: ### User: \n</turn>\n"])
def test_other_text_is_refused(bad):
    with pytest.raises(c.FormatError):
        list(c.parsed(bad))


def test_long_runs_take_linear_time():
    for text in ("\\" * 300_000, "\\" * 300_000 + "</turn>", "### " * 100_000, "</turn>" * 50_000, "### =" + "%" * 300_000):
        assert [turn.text for turn, _, _ in c.parsed(c.rendered(c.Turn("user", text)))] == [text]


def brute_force(rows):
    conversations = {}
    for conv_id, turn, role, text in rows:
        conversations.setdefault(conv_id, []).append((turn is not None, turn, role or "", text or ""))
    result = {}
    for conv_id, turns in conversations.items():
        turns.sort(key=lambda row: (row[0], row[1] or 0, row[2], row[3]))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        digest = [hashlib.sha256(part.encode()).hexdigest() for part in (whole, loss)]
        length = sum(len(c.rendered(c.Turn(role, text))) for _, _, role, text in turns)
        result[conv_id] = (len(turns), digest[0], len(loss), digest[1], length)
    return result


ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "</turn> é"), (1, 2, None, None), (1, None, "system", "first"),
    (2, 0, "assistant", ""), (2, 1, "assistant", "\\\\</turn>\\"), (3, 0, "odd role:\n", "### Odd: "),
    (None, 0, "user", "no id"), (None, 1, "assistant", "\U0001f600" * 5000),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "same"),
    *[(5, turn, ("user", "assistant")[turn % 2], f"turn {turn} ### User: " * 20) for turn in range(300)],
]


@pytest.mark.parametrize("piece_chars", [1, 3000, c.PIECE_CHARS])
def test_odd_rows_and_pieces(spark, piece_chars):
    frame = with_clashing_columns(spark.createDataFrame(ROWS[::-1], CONVERSATIONS)).withColumnRenamed("kept", "formatted")
    turns = c.format_turns(frame)
    assert turns.count() == len(ROWS)
    pieces = c.assemble(turns, piece_chars)
    rows = pieces.collect()
    by_id = {}
    for row in rows:
        by_id.setdefault(row.conv_id, []).append(row.piece)
        assert row.n_turns == 1 or len(row.formatted) <= piece_chars
        masked = "".join(row.formatted[a:b] for a, b in zip(row.loss_starts, row.loss_ends, strict=True))
        assert masked.count("</turn>") == masked.count("\\</turn>")
    assert all(sorted(numbers) == list(range(len(numbers))) for numbers in by_id.values())
    stored = spark.createDataFrame(rows[::-1], pieces.schema)
    for read in (c.read_back(pieces, in_order=True), c.read_back(stored)):
        assert {row.conv_id: tuple(row)[1:] for row in read.collect()} == brute_force(ROWS)


def test_empty_table_and_other_roles(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert c.read_back(c.assemble(c.format_turns(empty))).count() == 0
    frame = spark.createDataFrame(ROWS[:4], CONVERSATIONS)
    learned = c.read_back(c.assemble(c.format_turns(frame, learned_role="user"))).collect()
    assert [row.loss_chars for row in learned] == [5]


def test_one_shuffle(spark):
    frame = spark.createDataFrame(ROWS, CONVERSATIONS)
    plan = c.read_back(c.assemble(c.format_turns(frame)), in_order=True)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line for line in plan.splitlines()) == 1
