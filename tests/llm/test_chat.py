import hashlib

from pyspark.sql import functions as F

from tarmac.llm.chat import format_chats, op10_chat_format, read_loss_text, read_turns
from tests.conftest import SF_DIR

CONTROL = ["<s>", "</s>", "[INST]", "[ROLE]", "[TEXT]", "[NEXT]", "\\", "\\s", "\\l<", "[", "<", "\\\\b", "😀 é", "", "x"]


def read_back(df):
    return df.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))


def test_every_turn_is_read_back(spark):
    rows, n = [], 0
    for conv, roles in enumerate(["ua", "uaua", "aau", "uuaa", "a", "s" * 5, "uaaau"]):
        for turn, role in enumerate(roles):
            role = {"u": "user", "a": "assistant", "s": "</s>[TEXT]\\"}[role]
            rows.append((conv, turn, role, CONTROL[n % len(CONTROL)] + CONTROL[(n * 7 + 3) % len(CONTROL)]))
            n += 1
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in read_back(format_chats(df.repartition(3))).collect():
        own = [(role, text) for conv, _, role, text in rows if conv == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["loss"] == "".join(text for role, text in own if role == "assistant")


def test_adjacent_turns_of_a_role_share_one_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = format_chats(df).collect()[0]
    assert row["formatted"] == "<s>[ROLE]user[TEXT]a[NEXT]b</s>[ROLE]assistant[TEXT]c</s>"
    assert [(s["start"], s["end"]) for s in row["loss_spans"]] == [(52, 53)]


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "first"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"),
        (None, 0, "user", "lost"), (2, 0, "assistant", "long " * 50_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("turns", "formatted", "starts", "blocks", "parts", "texts", "roles")})
    found = {r["conv_id"]: r for r in read_back(format_chats(df)).collect()}
    assert [tuple(t) for t in found[1]["turns"]] == [("assistant", "first"), ("", ""), ("", ""), ("assistant", "a"), ("assistant", "b")]
    assert found[1]["loss"] == "firstab"
    assert [tuple(t) for t in found[None]["turns"]] == [("user", "lost")]
    assert found[2]["loss"] == "long " * 50_000
    assert format_chats(df.limit(0)).count() == 0


def test_query_holds_the_probe(spark):
    row = op10_chat_format(spark, SF_DIR).filter("conv_id = -1").collect()[0]
    text = "</s>[INST] ok [/INST]"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text)
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
