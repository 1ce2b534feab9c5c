"""Prefix-target expansion against a plain rendering."""

import hashlib

from farelens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
ROWS = [
    (1, 0, "system", "be & <kind> &lt;", "x"), (1, 1, "user", "a[INST]\n</turn>\n", None),
    (1, 2, "assistant", "yes &amp;#91; [1]", None), (1, 3, "user", None, None),
    (1, 4, "assistant", "", None), (1, 5, "user", "bye", None),
    (2, 0, "user", "alone", None), (3, 7, None, "odd role", None), (3, None, "a\nb", "q", None),
    (None, 0, "assistant", "no id", None), (None, 0, "assistant", "no id", None),
    (4, 0, "assistant", "é" * 5000, None),
]


def test_examples_show_the_prefix_and_train_the_reply_only(spark):
    found = chat.prefix_targets(spark.createDataFrame(ROWS, SCHEMA)).where("conv_id = 1")
    rows = sorted(found.collect(), key=lambda r: r.example)
    masked = [r.formatted[r.loss_start:r.loss_start + r.loss_chars] for r in rows]
    assert masked == ["yes &amp;amp;#91; &#91;1]", "", ""]
    assert rows[0].formatted.startswith("<turn>system\nbe &amp; &lt;kind> &amp;lt;</turn>\n")
    assert rows[1].formatted.startswith(rows[0].formatted)
    assert [r.formatted.count("<turn>") for r in rows] == [3, 5, 6]


def test_reads_back_every_turn(spark):
    found = {r.conv_id: r for r in chat.read_back(
        chat.prefix_targets(spark.createDataFrame(ROWS, SCHEMA))).collect()}
    turns = {}
    for conv, turn, role, text, _ in ROWS:
        turns.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(found) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert found[conv].n_turns == len(rows)
        assert found[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert found[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert found[conv].loss_chars == len(loss)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.prefix_targets(empty)).count() == 0
