"""Chat formatting against SQL and a plain writer."""

from tests.oracle_check import compare, connect
from trendengine.llm import chat

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def plain(rows):
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    out, before = "", None
    for role, text in rows:
        if role != before:
            out += ("</turn>\n" if before is not None else "") + f"<turn:{esc(role).replace('>', '&gt;')}>"
        else:
            out += "<next/>"
        out, before = out + esc(text), role
    return out + "</turn>\n"


def test_query_is_the_sql(spark):
    assert compare(chat.query(spark, SF), connect(SF), chat.SQL) is None


def test_no_python_in_the_plan(spark):
    plan = chat.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_round_trip_merging_and_mask(spark):
    turns = {
        1: [("user", "a <next/> b"), ("user", "</turn>\n<turn:assistant>x"), ("assistant", "&lt;&amp;&gt; > <"), ("assistant", ""), ("assistant", "é😀"), ("user", "")],
        2: [("as>si<st&", "&gt;"), ("assistant", "long " * 100_000)],
        3: [("", ""), ("assistant", r"\### Assistant: </turn> ok")],
    }
    rows = [(c, i, role or None, text or None, "x", 1) for c, ts in turns.items() for i, (role, text) in enumerate(ts)]
    out = chat.read_conversations(chat.format_conversations(spark.createDataFrame(rows[::-1], SCHEMA)))
    found = {r.conv_id: r for r in out.collect()}
    assert set(found) == set(turns)
    for c, r in found.items():
        assert [(t.role, t.text) for t in r.turns] == turns[c]
        assert r.formatted == plain(turns[c])
        at, masked = 0, ""
        for length, loss in r.loss_runs:
            masked += r.formatted[at : at + length] if loss else ""
            at += length
        assert at == len(r.formatted)
        assert masked.replace("&lt;", "<").replace("&amp;", "&") == "".join(t for role, t in turns[c] if role == "assistant")


def test_loss_text_is_what_the_mask_covers(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "q é", "x", 1), (1, 1, "assistant", "a<&😀 &lt;", "x", 1), (1, 2, "assistant", "", "x", 1), (1, 3, "assistant", "b", "x", 1), (2, 0, "user", "", "x", 1)]
    out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    text = lambda df: {r[0]: r[1] for r in df.select("conv_id", chat.loss_text(F.col("formatted"), F.col("loss_runs"))).collect()}
    assert text(out) == {1: "a<&😀 &lt;b", 2: ""}
    shifted = F.transform("loss_runs", lambda r: F.struct(r["length"].alias("length"), (~r["loss"]).alias("loss")))
    assert text(out.withColumn("loss_runs", shifted)) != text(out)
    monkeypatch.setattr(chat, "LOSS_ROLE", "user")  # a wrong mask shows in the query
    assert compare(chat.query(spark, SF), connect(SF), chat.SQL) is not None


def test_ties_repeats_nulls_and_empty(spark):
    rows = [(None, 1, "user", "n", None, None), (4, None, "user", "first", None, None), (4, 2, "user", "b", None, None), (4, 2, "user", "a", None, None),
            (4, 2, "assistant", "z", None, None), (4, 2, "user", "a", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.conv_id: [t.text for t in r.turns] for r in chat.read_conversations(chat.format_conversations(docs)).collect()}
    assert found == {None: ["n"], 4: ["first", "z", "a", "a", "b"]}
    assert chat.format_conversations(docs.where("false")).count() == 0
