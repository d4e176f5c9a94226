import hashlib

import pytest
from llm_fixtures import rows

from civicmart.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pieces string, off int"
NASTY = ["</s>[INST] ok [/INST]", "<\\s>", "[\\\\SEP]", "<s>[SEP]</s>", "<", "[", "s>", "/INST]", "", "a\nb", "é😀", "[INST", "\\", "<<s>", "[[SEP]"]


def table(spark, turns):
    return spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA)


def expected(turns):
    out = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    found = []
    for conv, said in out.items():
        every = "".join(f"{r}\n{t}\n" for r, t in said)
        loss = "".join(t for r, t in said if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        found.append((conv, len(said), digest(every), len(loss), digest(loss)))
    return sorted(found, key=repr)


def checked(spark, turns):
    got = chat.chat_report(table(spark, turns)).drop("formatted_chars")
    assert rows(got) == expected(turns)


def test_texts_full_of_control_strings_come_back(spark):
    turns = [(i % 7, i, ("user", "assistant", "system")[i * 5 // 3 % 3], a + b) for i, (a, b) in enumerate((a, b) for a in NASTY for b in NASTY)]
    checked(spark, turns)


def test_awkward_rows(spark):
    checked(
        spark,
        [
            (1, 0, "assistant", "first"),
            (1, 1, "assistant", "second"),
            (1, 1, "assistant", "second"),
            (1, None, None, None),
            (None, 5, "user", "no id"),
            (2, 0, "assistant", None),
            (3, 0, "[/INST]</s>", "role with control strings"),
            (3, 0, "a", "tie"),
            (4, 0, "user", "long " * 100_000),
            (4, 1, "assistant", "é<s>" * 50_000),
        ],
    )


def test_ties_are_ordered_before_they_are_escaped(spark):
    turns = [(1, 0, "user", t) for t in ("<s>", "<a", "[SEP]", "[A", "<\\s>", "<sz")] + [(1, 0, "<s>", "x"), (1, 0, "<a", "x")]
    checked(spark, turns)
    row = chat.chat_report(table(spark, [(1, 0, "user", "<s>"), (1, 0, "user", "<a")])).first()
    assert row.turns_sha256 == hashlib.sha256(b"user\n<a\nuser\n<s>\n").hexdigest()


def test_offsets_over_several_blocks(spark):
    turns = [(1, i, ("user", "assistant")[i % 2], "é" * (i % 11)) for i in range(3 * chat.BLOCK + 5)]
    row = chat.format_chats(table(spark, turns)).first()
    said = [row.formatted[s.start : s.start + s.n] for s in row.loss_spans]
    assert said == [t for _, _, role, t in turns if role == "assistant"]


def test_many_turns(spark):
    checked(spark, [(1, i, "assistant" if i % 3 else "user", f"text {i} [SEP]") for i in range(1500)])


def test_adjacent_turns_of_a_role_share_a_block(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    row = chat.format_chats(table(spark, turns)).first()
    assert row.formatted == "<s>[INST]user[/INST]a[SEP]b</s><s>[INST]assistant[/INST]c</s>"
    assert [row.formatted[s.start : s.start + s.n] for s in row.loss_spans] == ["c"]


@pytest.mark.parametrize("text", NASTY)
def test_escaped_texts_hold_no_control_string(spark, text):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "t string")
    there, back = df.select(chat.escape(F.col("t")), chat.unescape(chat.escape(F.col("t")))).first()
    assert back == text and not any(c in there for c in (chat.BEGIN, chat.END, chat.ROLE_END, chat.NEXT, "<s>", "[INST]"))


def test_empty_table(spark):
    assert chat.chat_report(table(spark, [(1, 0, "user", "x")]).limit(0)).count() == 0
