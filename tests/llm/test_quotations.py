from weftline.llm import quotations as Q


def test_thread(spark):
    rows = [
        (1, 0, "Hello there\nhow are you today"),
        (1, 1, "On Monday, A wrote:\n> Hello   THERE\n> how are you today\nFine, thanks"),
        (1, 2, ">> Hello there\n> Fine, thanks\n\nGood to hear"),
        (1, 3, "> Hello there\nMe too"),
        (1, 4, "> nobody said this\nHm"),
        (1, 5, None), (1, 5, None), (2, 0, "> Good to hear\n>\nquoted from elsewhere"), (None, 3, "> x\nbody"), (2, None, "")]
    out = {(r.conv, r.turn): r for r in Q.link_conversations(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert len(out) == 9
    assert [out[1, t].reply_to for t in range(6)] == [None, 0, 1, 0, None, None]
    # Replies follow what they answer: 0, 1, 2 (to 1), 3 (to 0), then the loose ones.
    assert [out[1, t].position for t in range(6)] == [0, 1, 2, 3, 4, 5] and [out[1, t].depth for t in range(6)] == [0, 1, 2, 1, 0, 0]
    assert out[1, 1].body == "Fine, thanks" and out[1, 2].body == "Good to hear" and out[1, 5].body == ""
    assert (out[1, 2].quote_levels, out[1, 2].n_quoted, out[1, 2].n_linked) == (2, 2, 2)
    assert (out[1, 4].n_quoted, out[1, 4].n_linked) == (1, 0)
    assert (out[2, 0].n_linked, out[2, 0].reply_to) == (1, None)
    assert out[None, 3].body == "body" and out[None, 3].position is None and out[2, None].reply_to is None


def test_ties_and_deep_threads(spark):
    rows = [(7, 0, "same line"), (7, 1, "same line"), (7, 2, "> same line\nto the later one")]
    rows += [(8, t, (f"> message {t - 1}\n" if t else "") + f"message {t}") for t in range(40)]
    rows += [(9, t, "> root text\nx" + str(t) if t else "root text") for t in range(30)]
    out = {(r.conv, r.turn): r for r in Q.link_conversations(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert out[7, 2].reply_to == 1
    assert all(out[8, t].depth == out[8, t].position == t for t in range(40))
    assert all((out[9, t].depth, out[9, t].position) == (min(t, 1), t) for t in range(30))


def test_empty(spark):
    assert Q.link_conversations(spark.createDataFrame([], "conv_id long, turn long, text string")).count() == 0
