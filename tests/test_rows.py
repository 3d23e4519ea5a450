import pytest
from pyspark.sql import functions as F

from tests import plain
from tokenloom.constants import CHAT_TEMPLATE
from tokenloom.functions import chat, sequences
from tokenloom.functions.codec import Encoder
from tokenloom.operators import chat as chat_ops, columns, training_rows

L = 8
LENGTHS = [0, 1, L - 2, L - 1, L, L + 1, 3 * L]


def arrays(spark, lengths=LENGTHS):
    return spark.createDataFrame([(n, list(range(10, 10 + n))) for n in lengths], "n int, ids array<int>")


def test_bos_eos(spark):
    assert [r[0] for r in arrays(spark, [0, 2]).select(sequences.add_bos_eos(F.col("ids"))).collect()] == [[0, 1], [0, 10, 11, 1]]


def test_pad_truncate(spark):
    for r in arrays(spark).select("ids", sequences.pad_truncate(F.col("ids"), L).alias("out")).collect():
        assert r.out == (r.ids + [-100] * L)[:L]


@pytest.mark.parametrize("compat", [False, True])
def test_shifted_rows(spark, compat):
    rows = arrays(spark).select("ids", *sequences.pretrain_columns(F.col("ids"), L, compat)).collect()
    for r in rows:
        labels = r.output_ids if compat else r.labels
        assert len(r.input_ids) == len(labels) == L - 1
        assert r.input_ids == (r.ids + [-100 if compat else 2] * L)[: L - 1]
        assert labels == (r.ids + [-100] * L)[1:L]


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("label_pad", [1, -100])
def test_instruct_columns(spark, compat, label_pad):
    pairs = [(p, a) for p in LENGTHS for a in LENGTHS]
    df = spark.createDataFrame(
        [(list(range(10, 10 + p)), list(range(50, 50 + a))) for p, a in pairs], "p array<int>, a array<int>"
    )
    out = df.select("p", "a", *sequences.instruct_columns(F.col("p"), F.col("a"), L, compat, label_pad=label_pad))
    for r in out.collect():
        # the literal rule: prompt longer than the row cuts both, else pad or cut each
        labels = [-100] * len(r.p) + r.a
        inputs = r.p if compat else r.p + r.a
        assert r.input_ids == (inputs + [1] * L)[:L]
        assert r.labels == (labels + [label_pad] * L)[:L]


def test_supervised_count_and_domain(spark):
    df = spark.createDataFrame([([-100, 5, 1],), ([-100, -100],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(sequences.supervised_count(F.col("ids"))).collect()] == [2, 0, 0]
    good, bad = training_rows.split_domain(df, 5, "ids")
    assert [r.ids for r in good.collect()] == [[]] and bad.count() == 2
    assert [r.ids for r in training_rows.split_domain(df, 6, "ids")[1].collect()] == [[-100, 5, 1], [-100, -100]]


EDGES = [
    ("sys", "hi", "yo"), ("", "hi", "yo"), (None, "hi", "yo"), ("sys", "", "yo"), ("sys", None, "yo"), ("", "", "yo"),
    (None, None, "yo"), ("sys", "hi", None), ("sys", "hi", ""), (None, None, None),
]


def instruct(spark):
    return spark.createDataFrame([(i, *e) for i, e in enumerate(EDGES)], "id int, instruct string, input string, output string")


def expected_prompt(instruct, input_):
    out = [{"role": "system", "content": instruct}] if instruct else []
    return out + ([{"role": "user", "content": input_}] if input_ else [])


def test_messages_and_text(spark):
    messages = chat.prompt_messages(F.col("instruct"), F.col("input"))
    rows = instruct(spark).select("*", messages.alias("m"), chat.render_messages(messages).alias("t"))
    for r in rows.collect():
        expected = expected_prompt(r.instruct, r.input)
        assert [m.asDict() for m in r.m] == expected
        assert r.t == (plain.render(expected) if expected else "")


def test_message_lists(spark):
    lists = [
        [("system", "S"), ("user", "a"), ("assistant", "b"), ("system", "later"), ("user", "c")],
        [("user", "a"), ("system", "later"), ("assistant", "b")],
        [("tool", "x"), ("user", "a")],
    ]
    df = spark.createDataFrame([(m,) for m in lists], "m array<struct<role:string,content:string>>")
    for r, m in zip(df.select(chat.render_messages(F.col("m")).alias("t")).collect(), lists):
        assert r.t == plain.render([{"role": a, "content": b} for a, b in m])


def test_template_text_gives_the_same(spark):
    jinja2 = pytest.importorskip("jinja2")
    template = jinja2.Template(CHAT_TEMPLATE, keep_trailing_newline=True)
    messages = [{"role": "system", "content": "S"}, {"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]
    assert template.render(messages=messages) == plain.render(messages)


def test_long_conversation_in_segments(spark):
    """One conversation holds most turns; its text comes in bounded pieces that follow each other."""
    turns = [(1, t, ("system" if t % 7 == 0 else "user" if t % 2 else "assistant"), f"t{t}") for t in range(100)]
    turns += [(2, 3, "user", "x"), (2, 5, "assistant", "y"), (3, 0, "system", "only")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    rows = chat_ops.render_conversations(df, segment_turns=16).collect()
    found = {}
    for r in sorted(rows):
        found[r.conv_id] = found.get(r.conv_id, "") + r.text
    for conv in (1, 2, 3):
        ordered = sorted(t for t in turns if t[0] == conv)
        assert found[conv] == plain.render([{"role": t[2], "content": t[3]} for t in ordered])
    assert sum(r.conv_id == 1 for r in rows) == 7


def test_rejects(spark):
    reason = columns.instruct_reject(F.col("instruct"), F.col("input"), F.col("output"))
    good, bad = columns.split_rejects(instruct(spark), reason)
    assert sorted(r.id for r in good.collect()) == [0, 1, 2, 3, 4, 8]
    assert {r.id: r.reject_reason for r in bad.collect()} == {5: "no_prompt", 6: "no_prompt", 7: "no_output", 9: "no_prompt"}


def test_columns_are_strict(spark):
    df = instruct(spark)
    with pytest.raises(ValueError):
        columns.drop_columns(df, "absent")
    with pytest.raises(ValueError):
        columns.rename_columns(df, {"absent": "x"})
    with pytest.raises(Exception):
        columns.union_sources(df, df.drop("input"))
    assert columns.union_sources(df, df).count() == 2 * len(EDGES)


def test_title(spark):
    df = spark.createDataFrame([("T", "x"), (None, "x"), ("", "x")], "title string, text string")
    assert [r[0] for r in df.select(columns.title_text(F.col("title"), F.col("text"))).collect()] == ["T x", " x", " x"]


def test_map_batches(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "", "yy")], "id long, text string, other string").repartition(2)
    out = columns.map_batches(df, lambda b: {"n": b["text"].str.len(), "text": b["text"].str.upper()}, "text string, n long", ["other"])
    assert out.columns == ["id", "text", "n"]
    assert sorted(out.collect()) == [(1, "A", 1), (2, "B", 1), (3, "", 0)]


@pytest.mark.parametrize("compat", [False, True])
def test_pretrain_rows(spark, compat):
    """Begin and end once by default, twice with compat."""
    df = spark.createDataFrame([("",), ("ab",), ("a" * 40,)], "text string")
    rows = training_rows.pretrain_rows(df, Encoder(spark, []), 12, compat=compat).collect()
    starts = [r.input_ids[: 2 if compat else 1] for r in rows]
    assert starts == [[0, 0] if compat else [0]] * 3
    pad = -100 if compat else 2
    assert rows[0].input_ids == ([0, 0, 1, 1] if compat else [0, 1]) + [pad] * (7 if compat else 9)
    assert all(len(r.input_ids) == 11 for r in rows)


def test_wrapped_text_encodes_like_the_template(spark, docs):
    encoder = Encoder(spark, [])
    text = F.col("text")
    same = encoder.encode(columns.wrap_text(text), template=False) == encoder.encode(text)
    assert docs.filter(~same).count() == 0


@pytest.mark.parametrize("compat", [False, True])
def test_instruct_rows(spark, compat):
    encoder = Encoder(spark, [])
    usable, _ = columns.split_rejects(instruct(spark), columns.instruct_reject(F.col("instruct"), F.col("input"), F.col("output")))
    ids = {r.id: r for r in training_rows.chat_ids(usable, encoder).collect()}
    for r in training_rows.instruct_rows(usable, encoder, 48, compat, keep=("id",)).collect():
        prompt, answer = ids[r.id].prompt, ids[r.id].answer
        assert prompt.count(0) == (2 if EDGES[r.id][1] else 0) and answer.count(1) == 1
        assert r.input_ids == ((prompt if compat else prompt + answer) + [1] * 48)[:48]
        assert r.labels == ([-100] * len(prompt) + answer + [1] * 48)[:48]
