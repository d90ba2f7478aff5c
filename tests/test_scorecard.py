from __future__ import annotations

from pyspark.sql import functions as F

from rewardtables.functions.tokens import zip_shortest
from rewardtables.operators import scorecard

TEXT = "<reasoning>\nr\n</reasoning>\n<answer>\n1\n</answer>\n"


def frame(spark):
    return spark.createDataFrame([(1, TEXT, "1"), (2, "1", "1"), (3, None, "1")], "id INT, completion STRING, answer STRING")


def nested(spark):
    message = F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content"))
    return frame(spark).withColumn("completion", F.array(message))


def rows(df):
    return [
        tuple(r) for r in df.orderBy("id").select("id", *[c for c in df.columns if c.startswith("reward")]).collect()
    ]


def test_both_shapes_score_alike(spark):
    names = ["correctness", "strict_format", "length"]
    plain = rows(scorecard.scorecard(frame(spark), names))
    assert plain == rows(scorecard.scorecard(nested(spark), names))
    assert plain[0][1:] == (2.0, 0.5, -28.0, -25.5)
    assert plain[1][1:] == (2.0, 0.0, -19.0, -17.0)
    assert plain[2][1:4] == (0.0, 0.0, None)


def test_renamed_inputs(spark):
    df = frame(spark).withColumnsRenamed({"completion": "text", "answer": "gold"})
    got = rows(scorecard.scorecard(df, ["correctness"], completion="text", answer="gold"))
    assert [r[1] for r in got] == [2.0, 2.0, 0.0]


def test_python_reward_protocol(spark):
    def share(completions, answer, **kwargs):
        assert len(completions) == len(answer)
        return [len(c[0]["content"] or "") + len(a) for c, a in zip(completions, answer)]

    scorecard.register("share", scorecard.python_reward(share, {"completions": "raw_completion", "answer": "answer"}))
    assert "share" in scorecard.registered()
    got = rows(scorecard.scorecard(nested(spark), ["share"]))
    assert [r[1] for r in got] == [float(len(TEXT) + 1), 2.0, 1.0]


def test_native_user_reward(spark):
    scorecard.register("twice", lambda c: F.char_length(c["completion"]) * F.lit(2.0))
    assert [r[1] for r in rows(scorecard.scorecard(frame(spark), ["twice"]))] == [len(TEXT) * 2.0, 2.0, None]


def test_pair_drops_the_unpaired(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, completion STRING")
    right = spark.createDataFrame([(2, "x"), (3, "y")], "k INT, answer STRING")
    assert [tuple(r) for r in scorecard.pair(left, right, "k").collect()] == [(2, "b", "x")]


def test_zip_stops_at_the_shorter(spark):
    df = spark.sql("select array(1,2,3) a, array('x','y') b union all select array(1), cast(array() as array<string>)")
    got = df.select(zip_shortest(F.col("a"), F.col("b")).alias("z")).collect()
    assert [[tuple(p) for p in r["z"]] for r in got] == [[(1, "x"), (2, "y")], []]
