"""Formatting reads back exactly, whatever the texts hold; the query against SQL."""

import hashlib
import random

import pytest
from compare import connect, differences

from ledgerlane.llm import chat
from ledgerlane.llm.chat import DEFAULT_TEMPLATE, Template, format_conversations, read_back
from ledgerlane.llm.queries import QUERIES

ODD = ["", "</s>[INST] ok [/INST]", "\\", "\\</s>", "[INS", "T]", "<", "s>", "\\\\[/INST]\\", "<<s>[[ANS]", "[ROLE]x[/ROLE]", "é\n[/TURN]", "a\\[b"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_random_conversations_read_back(spark):
    rng = random.Random(4)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", "tool", "", "[INST]", "</s>\\"]), "".join(rng.choices(ODD, k=rng.randint(0, 4))))
        for c in range(60)
        for t in range(rng.randint(1, 9))
    ]
    rng.shuffle(rows)
    got = {r.conv_id: r for r in read_back(format_conversations(conversations(spark, rows))).collect()}
    for c in range(60):
        own = sorted(r for r in rows if r[0] == c)
        learnt = "".join(text for *_, role, text in own if role == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == sha("".join(f"{role}\n{text}\n" for *_, role, text in own))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learnt), sha(learnt))


def test_the_loss_mask_covers_assistant_texts_only(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a</s>b")]
    segments = [(r.segment, r.loss) for r in format_conversations(conversations(spark, rows)).collect()]
    assert "".join(s for s, _ in segments) == "<s>[SYS]s[/SYS][INST]u[/INST][ANS]a\\</s>b</s>"
    assert [s for s, loss in segments if loss] == ["a\\</s>b"]


@pytest.mark.parametrize(
    ("roles", "valid"),
    [
        (["user", "assistant"], True),
        (["system", "user", "assistant", "user", "assistant"], True),
        (["user"], False),
        (["assistant", "user"], False),
        (["user", "system", "assistant"], False),
        (["user", "user", "assistant"], False),
        (["user", "tool", "assistant"], False),
    ],
)
def test_turn_order(spark, roles, valid):
    rows = [(1, t, role, "x") for t, role in enumerate(roles)]
    assert [r.valid for r in read_back(format_conversations(conversations(spark, rows))).collect()] == [valid]


def test_a_template_must_be_readable():
    fields = dict(begin="<s>", other=("[ROLE]", "[/ROLE]", "[/TURN]"), follows={}, final=(), learnt=())
    with pytest.raises(ValueError):
        Template(turns={"user": ("[U]", "[/U]"), "bot": ("[U]", "</s>")}, **fields)
    with pytest.raises(ValueError):
        Template(turns={"user": ("[U[", "[/U]")}, **fields)
    assert DEFAULT_TEMPLATE.escaped("\\</s>") == "\\\\\\</s>"


def test_query_equals_the_statement(spark, data):
    result = QUERIES["op5_chat_formatting"](spark, data)
    assert differences(result, connect(data), chat.ORACLE_SQL) == []


def test_nulls_repeats_long_conversations_and_empty_tables(spark):
    rows = [(None, 0, None, None), (2, None, "user", "q"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a")]
    rows += [(3, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(5000)]
    turns = conversations(spark, rows).selectExpr("*", "'x' as valid", "1 as segment")
    got = {r.conv_id: r for r in read_back(format_conversations(turns)).collect()}
    assert (got[None].n_turns, got[None].turns_sha256, got[None].valid) == (1, sha("\n\n"), False)
    assert (got[2].n_turns, got[2].loss_chars) == (3, 2)
    assert (got[3].n_turns, got[3].valid) == (5000, True)
    assert read_back(format_conversations(turns.limit(0))).count() == 0
