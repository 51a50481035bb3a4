"""What chat formatting does with messages that have no id."""

from virotide.llm import chat


def test_messages_without_an_id_are_left_out(spark):
    rows = [(1, 10, None, "user", "hi", 0.0), (1, 11, 10, "assistant", "yes", 0.0), (1, None, 10, "user", "lost", 0.0), (2, None, None, "user", "lost", 0.0)]
    frame = spark.createDataFrame(rows, "tree_id long, msg_id long, parent_id long, role string, text string, score double")
    got = [(r.tree_id, chat.read_back(r.formatted)) for r in chat.conversations(frame).collect()]
    assert got == [(1, [("user", "hi"), ("assistant", "yes")])]
