from barloom.llm import quotes

MESSAGES = [
    (1, 0, "user", "Shall we meet on Monday?\nI have time after ten."),
    (1, 1, "assistant", "On Monday A wrote:\n> Shall we meet on Monday?\n> I have time after ten.\nYes, let us do that."),
    (1, 2, "user", "> I have time AFTER ten!\nMe too, then."),
    (1, 3, "user", ">> Shall we meet on Monday? I have time after ten.\n> Yes, let us do that.\n\nGood."),
    (1, 4, "user", "> nobody said this\nHm."),
    (1, 5, "user", "> Good.\nSee you."),
    (1, 6, "user", "> Later words.\nQuotes the future."),
    (1, 7, "user", "Later words."),
    (2, 0, "user", "> Shall we meet on Monday?\nOther conversation."),
    (3, 0, None, None),
    (3, 1, "user", ""),
    (3, 1, "user", "the same turn twice"),
    (3, 2, "user", " > > the same turn twice\n  kept as it is\n"),
    (None, 0, "user", "> a\nb"),
    (None, None, "user", "c"),
    (4, None, "user", "> c"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def answers(df):
    return {(r.conv_id, r.turn, r.text): (r.parent_turn, r.root_turn, r.reply_depth, r.seq) for r in df.collect()}


def test_links_threads_and_own_words(spark):
    df = spark.createDataFrame(MESSAGES, SCHEMA).selectExpr("*", "1 AS conv", "2 AS place", "'x' AS passages").repartition(3)
    got = answers(quotes.threaded(df))
    assert len(got) == len(MESSAGES)
    assert got == {
        (1, 0, "Shall we meet on Monday?\nI have time after ten."): (None, 0, 0, 0),
        (1, 1, "Yes, let us do that."): (0, 0, 1, 1),
        (1, 2, "Me too, then."): (0, 0, 1, 2),
        (1, 3, "\nGood."): (1, 0, 2, 3),
        (1, 5, "See you."): (3, 0, 3, 4),
        (1, 4, "Hm."): (None, 4, 0, 5),
        (1, 6, "Quotes the future."): (None, 6, 0, 6),
        (1, 7, "Later words."): (None, 7, 0, 7),
        (2, 0, "Other conversation."): (None, 0, 0, 0),
        (3, 0, None): (None, 0, 0, 0),
        (3, 1, ""): (None, 1, 0, got[(3, 1, "")][3]),
        (3, 1, "the same turn twice"): (None, 1, 0, 3 - got[(3, 1, "")][3]),
        (3, 2, "  kept as it is\n"): (1, 1, 1, 3),
        (None, 0, "b"): (None, 0, 0, 1),
        (None, None, "c"): (None, None, 0, 0),
        (4, None, ""): (None, None, 0, 0),
    }


def test_long_chain(spark):
    rows = [(1, 0, "user", "word0")] + [(1, i, "user", f"> word{i - 1}\nword{i}") for i in range(1, 40)]
    got = answers(quotes.threaded(spark.createDataFrame(rows, SCHEMA)))
    assert got == {(1, i, f"word{i}"): (i - 1 if i else None, 0, i, i) for i in range(40)}


def test_the_common_line_of_a_hot_conversation_makes_no_pairs(spark):
    rows = [(1, i, "user", "thanks" if i % 2 else "> thanks\nagain") for i in range(200)]
    found = quotes.threaded(spark.createDataFrame(rows, SCHEMA))
    assert {r.parent_turn for r in found.collect() if r.turn % 2 == 0 and r.turn} == {1}


def test_empty_table(spark):
    assert quotes.threaded(spark.createDataFrame([], SCHEMA)).collect() == []
