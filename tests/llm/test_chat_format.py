from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywork.llm.chat_format import Template, digests, format_chats, loss_text, read_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NASTY = st.text(alphabet="\\#</turn>: \nehlc", max_size=12)


@settings(max_examples=15, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "a: b", "</turn>", "#x"]), NASTY), min_size=1, max_size=20))
def test_round_trip(spark, turns):
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], SCHEMA)
    out = format_chats(df).select(
        read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"), "formatted", "segments"
    ).first()
    assert [(x.role, x.text) for x in out.turns] == turns
    assert out.loss == "".join(t for r, t in turns if r == "assistant")
    assert out.formatted == "".join(s.text for s in out.segments)


def test_machine(frame):
    chats = {
        1: ["user", "assistant"], 2: ["system", "user", "assistant", "user"], 3: ["assistant"], 4: ["user", "user", "assistant"],
        5: ["user", "assistant", "tool", "tool", "assistant"], 6: ["user", "Assistant"],
    }
    df = frame([(c, i, r, "t") for c, rs in chats.items() for i, r in enumerate(rs)], SCHEMA).repartition(3)
    assert rows(format_chats(df), "conv_id", "state", "valid") == [
        (1, "assistant", True), (2, "user", False), (3, "invalid", False), (4, "invalid", False), (5, "assistant", True), (6, "invalid", False)
    ]


def test_other_template(frame):
    template = Template(
        turn_open="[", role_end="|", turn_close="]", escapes=(("\\", "\\e"), ("[", "\\o"), ("]", "\\c")),
        role_escapes=(("|", "\\p"),), loss_roles=("bot",), transitions={"start": {"bot": "done"}}, final_states=("done",),
    )
    out = format_chats(frame([(1, 0, "bot", "a]b|c[\\")], SCHEMA), template=template)
    row = out.select("formatted", "valid", read_turns(F.col("formatted"), template).alias("t")).first()
    assert row.formatted == "[bot|a\\cb|c\\o\\e]" and row.valid and row.t[0].text == "a]b|c[\\"


def test_ties_nulls_and_clashing_columns(frame):
    df = frame(
        [(1, 1, "user", "b", "x"), (1, 1, "user", "a", "x"), (1, None, None, None, "x"), (None, 0, "user", "q", "x"), (None, 0, "user", "q", "x")],
        SCHEMA + ", turns string",
    )
    got = {r.conv_id: [(t.role, t.text) for t in r.t] for r in format_chats(df).select("conv_id", read_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("user", "b")], None: [("user", "q"), ("user", "q")]}
    assert digests(format_chats(df.limit(0))).count() == 0
