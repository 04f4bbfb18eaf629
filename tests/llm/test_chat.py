import pytest
from pyspark.sql import functions as F

from vicinal.llm.chat import escape, events_of, learnt_text, messages, read_back, render, unescape
from .conftest import frame

TURNS = "conv_id long, turn long, role string, text string"


def test_escapes_are_reversible(spark):
    texts = ["", "<|", "<\\|", "<\\\\|x", "<|im_end|>", "<<|", "|<", "a<b|c", "<\\a|", "é<|\n<\\|"]
    rows = frame(spark, [(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    assert all(r.u == r.t and "<|" not in r.e for r in rows)


def test_round_trip_of_odd_turns(spark):
    rows = [(1, 0, "us\ner\\n", "a<|b<\\|c<\\\\|d<"), (1, 1, "assistant", "|x <|im_end|>\n\n"), (1, 2, "assistant", None), (None, None, None, None),
            (2, 5, "<|im_start|>", "same"), (2, 5, "<|im_start|>", "same"), (2, 4, "assistant", "z" * 50_000)]
    log = events_of(frame(spark, [(*r, "clash") for r in rows], TURNS + ", seq string"))
    out = render(messages(log)).withColumn("t", read_back(F.col("formatted"))).withColumn("l", learnt_text(F.col("formatted"), F.col("loss")))
    got = {r.conv_id: r for r in out.collect()}
    said = lambda i: [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == i), key=str)]
    for i in (1, 2, None):
        assert [tuple(t) for t in got[i].t] == said(i)
        assert got[i].l == "".join(t for r, t in said(i) if r == "assistant")


def test_folding_an_event_log(spark):
    events = [
        (1, 1, 0, "open", "user", "he"), (1, 2, 0, "delta", None, "llo"), (1, 3, 1, "open", "assistant", ""), (1, 4, 1, "delta", None, "draft"),
        (1, 5, 1, "regenerate", None, None), (1, 6, 1, "delta", None, "bet"), (1, 7, 1, "delta", None, "ter"), (1, 8, 2, "open", "user", "gone"),
        (1, 9, 0, "edit", None, "HELLO"), (1, 10, 1, "open", "assistant", None), (1, 11, 1, "delta", None, "fin"), (1, 12, 1, "delta", None, "al"),
        (2, 1, 0, "delta", None, "no opening"), (2, 2, 1, "open", "user", "kept"), (2, 3, 1, "edit", None, "edited"), (2, 4, 1, "delta", None, "!"),
    ]
    got = messages(frame(spark, events, "conv_id long, seq long, turn long, kind string, role string, text string")).orderBy("conv_id", "turn").collect()
    assert [tuple(r) for r in got] == [(1, 0, "user", "HELLO"), (1, 1, "assistant", "final"), (2, 0, "", "no opening"), (2, 1, "user", "edited!")]


def test_unknown_events_are_an_error(spark):
    with pytest.raises(Exception, match="unknown kind"):
        messages(frame(spark, [(1, 1, 0, "oops", None, None)], "conv_id long, seq long, turn long, kind string, role string, text string")).collect()


def test_no_turns(spark):
    assert render(messages(events_of(frame(spark, [], TURNS)))).collect() == []


def test_the_replay_is_a_running_frame(spark):
    log = frame(spark, [(1, 1, 0, "open", "user", "a")], "conv_id long, seq long, turn long, kind string, role string, text string")
    assert "unboundedfollowing" not in messages(log)._jdf.queryExecution().toString().lower()
