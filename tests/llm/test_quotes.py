"""Quotation linking on conversations that quote: derived from the given table, with known answers."""

import random

from strandlake.llm import quotes

D = "/root/testdata/sf0.001"


def quoting(spark):
    """The given conversations, where most messages quote an earlier one and its quotes; (conv_id, turn) to what each answers."""
    rng, by_conv = random.Random(12), {}
    for r in spark.read.parquet(f"{D}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by_conv.setdefault(r.conv_id, []).append(r)
    rows, answers, own = [], {}, {}
    for conv, messages in by_conv.items():
        shown = {}
        for k, r in enumerate(messages):
            text = " ".join((r.text or "").split()) + f" said {conv} {r.turn} in words of its own"
            own[conv, r.turn] = text
            to = rng.choice(messages[:k]).turn if k and rng.random() < 0.8 else None
            head = ""
            if to is not None:
                head = rng.choice(["On Monday, A. B. wrote:\n", "", "Am 3. Mai schrieb C:\n", "On " + "x " * 300 + "wrote:\n"]) + "".join(f"> {line}\r\n" if rng.random() < 0.5 else f">{line}\n" for line in shown[to].split("\n")) + "\n"
            shown[r.turn] = head.replace("\r", "") + text
            answers[conv, r.turn] = to
            rows.append((conv, r.turn, r.role, head + text))
    return rows, answers, own


def test_replies_are_found(spark):
    rows, answers, own = quoting(spark)
    assert sum(x is not None for x in answers.values()) > 20
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.reply_to == answers[r.conv_id, r.turn] and r.text == own[r.conv_id, r.turn]
        root, depth = r.turn, 0
        while answers[r.conv_id, root] is not None:
            root, depth = answers[r.conv_id, root], depth + 1
        assert (r.thread_root, r.depth) == (root, depth)
    for r in got:
        assert r.position == sum((x.conv_id, x.thread_root) == (r.conv_id, r.thread_root) and x.turn < r.turn for x in got)


def test_conversations_are_built_in_reply_order(spark):
    rows, answers, own = quoting(spark)
    role = {(c, t): x for c, t, x, _ in rows}
    linked = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    threads = {}
    for r in linked.collect():
        threads.setdefault((r.conv_id, r.thread_root), []).append(r.turn)
    for part in (2, 1000):
        built = {(r.conv_id, r.thread_root, r.part): r for r in quotes.build_conversations(linked, part).collect()}
        assert max(r.n_messages for r in built.values()) <= part
        for (conv, root), turns in threads.items():
            turns = sorted(turns)
            for k in range(0, len(turns), part):
                want = "\n".join(f"<|{role[conv, t]}|>\n{own[conv, t]}" for t in turns[k : k + part])
                assert built[conv, root, k // part].text == want and ">" not in built[conv, root, k // part].text.replace("|>", "")


def test_query_holds_every_message(spark):
    given = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{D}/conversations.parquet").collect()}
    got = quotes.op5_quotes(spark, D).collect()
    assert sorted((r.conv_id, t) for r in got for t in r.turns) == sorted(given)
    for r in got:
        assert r.n_messages == len(r.turns) == len(r.replies) <= quotes.PART
        said = [f"<|{given[r.conv_id, t].role}|>\n" for t in r.turns]
        assert [x for x in said if x in r.text] == said and (r.part or r.turns[0] == r.thread_root)


def test_a_quoting_table_becomes_conversations(spark, tmp_path):
    """The query on a table whose messages quote: every reply stands under the message it answers, once, without the quote."""
    rows, answers, own = quoting(spark)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = quotes.op5_quotes(spark, str(tmp_path)).collect()
    assert {(r.conv_id, t): to for r in got for t, to in zip(r.turns, r.replies, strict=True)} == answers
    assert sum(r.n_linked > 0 for r in got) > 5 and sum(r.n_quotes for r in got) >= sum(x is not None for x in answers.values())
    for r in got:
        at = {t: k for k, t in enumerate(r.turns)}
        assert all(to is None or at[to] < at[t] for t, to in zip(r.turns, r.replies, strict=True))
        assert r.text.split("\n")[1::2] == [own[r.conv_id, t] for t in r.turns]


def test_messages_without_a_place_are_records(spark):
    frame = spark.createDataFrame([(None, 1, "a", "x"), (1, None, None, "y"), (1, 0, "u", "z"), (1, 0, "u", "z")], "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id or -1, r.part is None, r.n_messages, r.text) for r in quotes.build_conversations(quotes.link_quotes(frame)).collect())
    assert got == [(-1, True, 1, "<|a|>\nx"), (1, False, 2, "<|u|>\nz\n<|u|>\nz"), (1, True, 1, "<||>\ny")]


def test_nulls_repeats_and_long_threads(spark):
    rows = [(None, 1, "a", "x"), (1, None, "a", "y"), (1, 0, "u", "z"), (1, 0, "u", "z"), (2, 0, None, None)] + [(9, t, "u", f"message number {t} of a long thread" if not t else f"> message number {t - 1} of a long thread\nmessage number {t} of a long thread") for t in range(3000)]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(r.position for r in got if r.conv_id == 9) == list(range(3000)) and {r.thread_root for r in got if r.conv_id == 9} == {0}
    assert sorted((r.conv_id, r.position) for r in got if r.conv_id in (1, 2) and r.turn is not None) == [(1, 0), (1, 1), (2, 0)]
    assert [r.position for r in got if r.conv_id is None or r.turn is None] == [None, None]
