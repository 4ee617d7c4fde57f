from pyspark.sql import functions as F

from tidegauge.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"


def talk(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_depth_and_normal_form(spark):
    lines = ["plain", "> one", ">> two", "> > two", "  >x", "a > b", ">"]
    rows = spark.createDataFrame([(x,) for x in lines], "x string").select(quotes.depth_of(F.col("x")).alias("d"), quotes.normalised(F.col("x")).alias("n")).collect()
    assert [r.d for r in rows] == [0, 1, 2, 2, 1, 0, 1]
    assert [r.n for r in rows] == ["plain", "one", "two", "two", "x", "a > b", ""]


def test_quotes_link_to_their_messages(spark):
    rows = [
        (1, 0, "a", "First question\nwith two lines\n\nand a second part"),
        (1, 1, "b", "An answer"),
        (1, 2, "a", "> FIRST   question\n> with two lines\nI meant this"),
        (1, 3, "c", "Unrelated"),
        (1, 4, "b", ">> first question\n>> with two lines\n> I meant this\nNested reply"),
        (1, 5, "b", "> nowhere to be found\nno link"),
        (1, 6, "c", "> an answer\n> that was changed\nby line"),
        (2, 0, "x", "An answer"),
        (2, 1, "y", "> First question\nother conversation"),
    ]
    got = {(r.conv_id, r.turn): r for r in quotes.conversations(talk(spark, rows)).collect()}
    assert {k: r.reply_to for k, r in got.items()} == {
        (1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 2, (1, 4): 2, (1, 5): 4, (1, 6): 1, (2, 0): None, (2, 1): 0,
    }
    assert got[(1, 4)].body == "Nested reply" and got[(1, 4)].n_quotes == 2 and got[(1, 4)].n_linked == 2
    assert got[(1, 5)].n_linked == 0 and got[(2, 1)].n_linked == 0
    order = [k[1] for k in sorted((k for k in got if k[0] == 1), key=lambda k: (got[k].thread, k[1]))]
    place = {t: i for i, t in enumerate(order)}
    assert all(r.reply_to is None or place[r.reply_to] < place[t] for (c, t), r in got.items() if c == 1)
    assert got[(1, 2)].thread == "0" * 10 + "0000000002" and got[(1, 3)].thread == got[(1, 2)].thread


def test_sql_gives_the_same(spark, tmp_path):
    import random

    import duckdb

    from tidegauge.llm.oracles import QUOTES

    rng = random.Random(4)
    said, rows = ["Alpha beta", "gamma", "alpha  BETA\n\ngamma delta", "x\ny", "", None], []
    for c in range(12):
        before: list[str] = []
        for t in range(rng.randint(1, 25)):
            own = rng.choice(said)
            parts = [] if own is None else [own]
            for _ in range(rng.choice([0, 0, 1, 2])):
                if before:
                    marks = rng.choice(["> ", ">", ">> ", "> > "])
                    parts.insert(rng.randint(0, len(parts)), "\n".join(marks + x for x in rng.choice(before).split("\n")))
            text = None if own is None else "\n".join(parts)
            rows.append((c, t * rng.choice([1, 1, 2]) + 100 * t, "u", text))
            before.append(text or "")
    rows += [(None, 1, "u", "> Alpha beta"), (3, None, "u", "lost")]
    path = str(tmp_path / "conversations.parquet")
    talk(spark, rows).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/*.parquet'")
    names = ["conv_id", "turn", "role", "body", "n_quotes", "n_linked", "reply_to", "thread"]
    wanted = con.execute(f"select {', '.join(names)} from ({QUOTES})").fetchall()
    got = quotes.conversations(spark.read.parquet(path)).select(*names).collect()
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in got)
    assert len({r.thread for r in got}) > 12 and sum(r.n_linked for r in got) > 30


def test_latest_of_equal_messages_and_long_conversations(spark):
    rows = [(7, t, "a", "the common line" if t % 2 == 0 else f"> the common line\nreply {t}") for t in range(400)]
    got = {r.turn: r for r in quotes.conversations(talk(spark, rows)).collect()}
    assert all(got[t].reply_to == t - 1 for t in range(1, 400)) and len({r.thread for r in got.values()}) == 1


def slow_latest(rows):
    return {(k, t): max((own for k2, _, own in rows if k2 == k and own is not None and own < t), default=None) for k, t, _ in rows}


def test_latest_before(spark):
    import random

    rng = random.Random(1)
    rows = [(k, t, t if rng.random() < 0.1 else None) for k in range(3) for t in rng.sample(range(1000), 120)]
    df = spark.createDataFrame(rows, "k int, turn long, own long")
    got = {(r.k, r.turn): r.found for r in quotes.latest_before(df, ["k"], "turn", "own", "found").collect()}
    assert got == slow_latest(rows)


def test_edge_rows(spark):
    rows = [
        (1, 0, None, None), (1, 1, "a", ""), (1, 1, "a", ""), (1, 2, "a", ">\n> \n>>"), (None, 0, "a", "> x"), (2, None, "a", "> x\ny"),
        (None, None, None, None), (3, 5, "a", "word " * 50_000), (3, 6, "b", "> " + "word " * 50_000), (1, 0, "b", "again turn 0"),
    ]
    df = talk(spark, rows).withColumn("hash", F.lit("own")).withColumn("depth", F.lit("own"))
    got = quotes.conversations(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[(3, 6)].reply_to == 5 and by[(3, 6)].n_linked == 1 and by[(3, 6)].body == ""
    assert by[(None, 0)].reply_to is None and by[(2, None)].body == "y"
    assert by[(1, 2)].body == "" and by[(1, 1)].reply_to == 0
    assert quotes.conversations(df.limit(0)).count() == 0
