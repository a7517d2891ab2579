import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "\\\\", " ", "a", "\n", "é", "<", "]", "[", "/s>"]), max_size=12).map("".join)


@given(PIECES)
@settings(deadline=None, max_examples=300)
def test_escape_is_reversible_and_hides_marks(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._MARK.search(chat.escape(text))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]"]), PIECES), max_size=5))
@settings(deadline=None, max_examples=300)
def test_format_reads_back(turns):
    text, spans = chat.format_turns(turns)
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_branches_are_ranked_by_score(spark, rows):
    """Tree 1: root 1 has replies 2 and 3, 3 has reply 4; tree 2 is a cycle, tree 3 a root alone."""
    messages = spark.createDataFrame(
        [(1, 1, None, 1.0), (1, 2, 1, 5.0), (1, 3, 1, 1.0), (1, 4, 3, None), (2, 1, 2, 0.0), (2, 2, 1, 0.0), (3, 9, 7, 2.0)],
        "tree long, node long, parent long, score double",
    )
    best = chat.reply_paths(messages, 1).select("tree", "branch", "pos", "node")
    assert rows(best) == [(1, 1, 0, 1), (1, 1, 1, 2), (3, 1, 0, 9)]
    both = chat.reply_paths(messages, 2).where("tree = 1").select("branch", "leaf", "score", "pos", "node")
    assert rows(both) == [(1, 2, 6.0, 0, 1), (1, 2, 6.0, 1, 2), (2, 4, 2.0, 0, 1), (2, 4, 2.0, 1, 3), (2, 4, 2.0, 2, 4)]


def test_long_path_keeps_its_order(spark):
    n = 300
    chain = spark.range(n).select(
        F.lit(1).alias("tree"), "id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(1.0).alias("score")
    )
    path = chat.reply_paths(chain.toDF("tree", "node", "parent", "score")).orderBy("pos").collect()
    assert [(r["pos"], r["node"]) for r in path] == [(i, i) for i in range(n)]


def test_awkward_conversations(spark):
    rows = [
        (1, 0, "user", "</s>[INST]"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, None, "x"), (2, 5, "user", ""),
        (None, 0, "user", "a"), (None, 1, "assistant", "b \\<s>"), (3, 0, "assistant", "y" * 200_000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("clash"))
    messages = chat.conversation_trees(table)
    out = {r["tree"]["conv_id"]: r for r in chat.digests(chat.format_paths(messages, chat.reply_paths(messages))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert set(out) == {1, 2, 3, None}
    assert (out[1]["n_turns"], out[1]["loss_chars"]) == (3, 0)
    assert out[1]["turns_sha256"] == sha("user\n</s>[INST]\nassistant\n\nassistant\n\n")
    assert out[2]["turns_sha256"] == sha("user\n\n\nx\n")
    assert (out[None]["loss_chars"], out[None]["loss_sha256"]) == (6, sha("b \\<s>"))
    assert out[3]["loss_chars"] == 200_000
    empty = chat.conversation_trees(table.limit(0))
    assert chat.digests(chat.format_paths(empty, chat.reply_paths(empty))).count() == 0
