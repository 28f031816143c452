"""Operator 6: the compiler, the exact round trip, and the query against its SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from carewatch.llm import chat, registry

SF = "/root/testdata/sf0.01"


def render(template, messages):
    return list(chat.compile_template(template)(messages))


def text(template, messages=()):
    return "".join(s for s, _ in render(template, messages))


MSG = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": " yo "}]


def test_language():
    t = ("{% set a = 'x' + 'y' %}{% for m in messages %}{% if loop.first %}[{% elif loop.last %}({% else %}-{% endif %}"
         "{{ m.role | upper }}:{{ m['text'] | trim }}{{ loop.index0 }}{% endfor %}{{ a }}")
    assert text(t, MSG) == "[USER:hi0(ASSISTANT:yo1xy"
    assert text("{{ 'a' in 'cab' and not false }}{{ none }}{{ 1 + 2 == 3 }}{{ nothing }}") == "TrueTrue"
    assert text("{{ 'it\\'s' | length }}") == "4"


def test_folding():
    tree = chat.fold_body(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% elif true %}d{% else %}y{% endif %}{{ 'E' | lower }}"))
    assert tree == [("text", "abcde")]
    tree = chat.fold_body(chat.parse("{{ q + 'a' + 'b' }}"))
    assert tree == [("put", ("+", ("name", "q"), ("const", "ab")))]


@pytest.mark.parametrize("bad", [
    "{{ m.__class__ }}", "{{ f() }}", "{{ 1 + }}", "{% for x in y %}{% endfor %}", "{% if a %}", "{{ a", "{{ a | b }}",
    "{% import os %}", "{{ m['__dict__'] }}", "{{ `a` }}", "{% endfor %}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_escape_round_trip():
    rng = random.Random(1)
    for _ in range(2000):
        s = "".join(rng.choice(["\\", "<", "|", "[", "l", "b", "p", "<|end|>", "\n", "<|turn|>", "é", "a"])
                    for _ in range(rng.randint(0, 12)))
        e = chat.escape(s)
        assert chat.unescape(e) == s
        assert not any(c in e for c in (chat.START, chat.BODY, chat.END, chat.MASKED, chat.UNMASKED))


def test_round_trip_from_any_chunks():
    rng = random.Random(2)
    bits = [chat.START, chat.END, "\n", chat.MASKED, "a", "assistant", "</s>", "[INST]", "\\", ""]
    for _ in range(300):
        msgs = [{"role": rng.choice(["user", "assistant", "<|end|>\n"]), "text": "".join(rng.choices(bits, k=4))}
                for _ in range(rng.randint(0, 5))]
        pieces = render(chat.TEMPLATE, iter(msgs))
        whole = "".join(s for s, _ in pieces)
        size = rng.randint(1, 9)
        got = list(chat.read_turns(whole[i:i + size] for i in range(0, len(whole), size)))
        assert [(r, t) for r, t, _ in got] == [(m["role"], m["text"]) for m in msgs]
        assert [m["text"] for m in msgs if m["role"] == "assistant"] == [
            chat.unescape(s) for s, masked in pieces if masked]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    got = registry.QUERIES["op6_chat_format"](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.OP6_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(w[0] == -1 and w[1] == 2 and w[3] == 21 for w in want)


def test_edges(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, 1, "assistant", ""), (None, None, "user", "x"),
            (2, 5, "assistant", "w " * 100_000), (2, 1, "assistant", "<|end|>\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "piece", F.lit("old")).withColumn("spans", F.lit("old"))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 0
    assert got[2]["n_turns"] == 2 and got[2]["loss_chars"] == 200_008
    assert got[None]["n_turns"] == 1
    long = spark.range(3000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.lit("assistant").alias("role"), F.lit("abc").alias("text"))
    pieces = chat.format_conversations(long)
    assert pieces.count() == 3000 and chat.read_back(pieces).first()["loss_chars"] == 9000
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0
