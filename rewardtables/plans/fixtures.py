"""Derived tables: each turns whole given tables into the inputs that the operators take.

The given tables hold none of the answer markers, so texts get them here, with
faults chosen by key. ``oracles.py`` states the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardtables.functions.hashing import key_hash
from rewardtables.functions.text import message, render_cot
from rewardtables.operators import labels, prompts
from rewardtables.sources.tables import read_table


# schemas of the given tables in use; declared, so that no job reads footers to infer them
_SCHEMAS = {
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", _SCHEMAS[name])


def _choose(selector: Column, *values: Column) -> Column:
    """``values[selector]``; the last value for any greater selector."""
    out = F.when(selector == 0, values[0])
    for i, value in enumerate(values[1:-1], start=1):
        out = out.when(selector == i, value)
    return out.otherwise(values[-1])


def _one_line(c: Column) -> Column:
    return F.translate(c, "\n", " ")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold answer of each assistant turn."""
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    return turns.select(
        "conv_id", "turn", (F.col("conv_id") * 10 + F.col("turn")).cast("string").alias("answer")
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One completion per assistant turn that follows a user turn, in eight variants."""
    turns = table(spark, sf_dir, "conversations")
    user = turns.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt")
    )
    reply = turns.where(F.col("role") == "assistant").select("conv_id", "turn", "text")
    # joined on (conversation, turn): even one giant conversation spreads
    joined = reply.join(user, ["conv_id", "turn"])
    answer = (F.col("conv_id") * 10 + F.col("turn")).cast("string")
    line, raw = _one_line(F.col("text")), F.col("text")
    good = render_cot(line, answer)
    variant = ((F.col("conv_id") + F.col("turn")) % 8).cast("int")
    completion = _choose(
        variant,
        good,
        render_cot(raw, answer),
        F.concat(F.lit("<reasoning>\n"), line, F.lit("\n</reasoning>\n<answer>\n"), answer),
        F.concat(F.lit("<answer>7</answer><answer>  "), answer, F.lit("\t</answer>")),
        raw,
        F.concat(render_cot(line, F.lit("wrong")), F.lit("\n")),
        F.concat(
            F.lit("<reasoning>\n"), line, F.lit("\n</reasoning>\n<answer>\n"), answer,
            F.lit("\n</answer>"),
        ),
        F.concat(F.lit("junk "), good),
    )
    return joined.select(
        "conv_id", "turn", variant.alias("variant"), "prompt", answer.alias("answer"),
        completion.alias("completion"), raw.alias("text"),
    )


def nested_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same completions as message lists, without their answers."""
    return completions(spark, sf_dir).select(
        "conv_id", "turn", "variant",
        F.array(message("assistant", F.col("completion"))).alias("completion"),
    )


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with raw answers in five variants around the ``####`` mark."""
    items = table(spark, sf_dir, "benchmark")
    key = F.col("item_id").cast("string")
    answer = _choose(
        F.col("item_id") % 5,
        F.col("text"),
        F.concat("text", F.lit("\n#### "), key),
        F.concat(F.col("text"), F.lit(" ####"), key, F.lit(" #### tail")),
        F.concat(F.lit("####\t"), (F.col("item_id") * 1000).cast("string"), F.lit(",500\n")),
        F.concat(F.lit("#####"), key),
    )
    return items.select("item_id", F.col("text").alias("question"), answer.alias("answer"))


def bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items with a generated text in three variants."""
    docs = table(spark, sf_dir, "documents")
    hit = F.concat("lang", F.lit("-"), (F.col("doc_id") % 4).cast("string"))
    generated = _choose(
        F.col("doc_id") % 3,
        F.concat(F.lit("[INST] q [/INST] "), hit, F.lit(" ")),
        F.concat(F.lit("x[/INST]y[/INST]\n"), hit),
        F.concat("lang", F.lit("-"), (F.col("doc_id") % 5).cast("string")),
    )
    return docs.select(
        F.col("doc_id").alias("item_key"), F.col("lang").alias("instruction"),
        F.col("source").alias("input"), F.upper(hit).alias("output"), generated.alias("generated"),
    )


def _predicted(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", *extra)
    joined = marks.join(docs, "doc_id")
    n, key = F.col("n_chars"), F.col("doc_id")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    none = F.lit(None).cast("string")
    ret_1y = F.when(toxic, "bad").when(good & (key % 4 != 0), "good").otherwise("neutral")
    ret_5y = F.when(good & (key % 3 != 0), "good").when(toxic, "bad").otherwise("neutral")
    vol_1y = F.when(n < 300, "low").when(n < 1500, "medium").otherwise("high")
    vol_5y = F.when(n < 600, "low").when(n < 2500, "medium").otherwise("high")
    return joined.select(
        "doc_id", "n_chars", *extra,
        ret_1y.alias("gt_ret_1y"),
        F.when(key % 13 != 0, vol_1y).alias("gt_vol_1y"),
        F.when(n % 11 == 0, none).when(n % 5 == 0, "bad").when(n % 3 == 0, "neutral")
        .otherwise(ret_1y).alias("pred_ret_1y"),
        F.when(n % 7 == 0, none).when(n < 500, "low").when(n < 1000, "medium")
        .otherwise("high").alias("pred_vol_1y"),
        ret_5y.alias("gt_ret_5y"),
        vol_5y.alias("gt_vol_5y"),
        F.when(n % 13 == 0, none).when(n % 4 == 0, "good").otherwise(ret_5y).alias("pred_ret_5y"),
        F.when(n % 9 == 0, none).when(n < 800, "low").when(n < 2000, "medium")
        .otherwise("high").alias("pred_vol_5y"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and predicted bands per labelled document, both horizons."""
    return _predicted(spark, sf_dir)


def band_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financial examples whose predictions of both horizons are text, in three layouts."""
    rows = _predicted(spark, sf_dir, "text")
    key = F.col("doc_id")
    ret = F.coalesce("pred_ret_1y", F.lit("up"))
    vol = F.coalesce("pred_vol_1y", F.lit("huge"))
    ret_5y, vol_5y = F.coalesce("pred_ret_5y", F.lit("up")), F.coalesce("pred_vol_5y", F.lit("huge"))
    later = F.concat(
        F.lit("<returns_5y>"), ret_5y, F.lit("</returns_5y>\n<volatility_5y>"), vol_5y, F.lit("</volatility_5y>\n")
    )
    risk = _choose(
        key % 4, F.lit("low risk"), F.lit("Moderate Risk"), F.lit("very high risk"), F.lit("none")
    )
    shouted = F.concat(
        F.lit("<answer>\n<returns_1y>bad</returns_1y>\n</answer>\n<answer>\n<returns_1y>  "),
        F.upper(ret), F.lit("  </returns_1y>\n<volatility_1y>\t"), F.upper(vol),
        F.lit("\n</volatility_1y>\n"), F.upper(later), later, F.lit("</answer>"),
    )
    plain = F.concat(
        F.lit("<returns_1y>"), ret, F.lit("</returns_1y>\n<volatility_1y>"), vol,
        F.lit("</volatility_1y>\n"), later, F.lit("<risk_level>"), risk, F.lit("</risk_level>"),
    )
    completion = _choose(
        key % 5, ret, F.concat("text", F.lit("\n"), shouted), render_cot(F.col("text"), plain)
    )
    return rows.select(
        "doc_id",
        F.when(key % 7 != 0, key % 6 != 0).alias("is_grpo_task"),
        F.col("text").alias("prompt"),
        F.col("gt_ret_1y").alias("ground_truth_returns_1y"),
        F.col("gt_vol_1y").alias("ground_truth_volatility_1y"),
        F.col("gt_ret_5y").alias("ground_truth_returns_5y"),
        F.col("gt_vol_5y").alias("ground_truth_volatility_5y"),
        completion.alias("completion"),
    )


def fold_records(spark: SparkSession, sf_dir: str, missing: int | None = None) -> DataFrame:
    """Wide metrics of five folds, or of all but the missing one."""
    fold = (key_hash(42, F.col("doc_id")) % 5).cast("int")
    hit = (F.col("gt_ret_1y") == F.col("pred_ret_1y")).cast("double")
    wide = predictions(spark, sf_dir).groupBy(fold.alias("fold")).agg(
        F.avg(hit).alias("accuracy"),
        F.avg(F.when(F.col("gt_ret_1y") == "good", hit)).alias("accuracy_good"),
        F.count(F.lit(1)).cast("double").alias("n_rows"),
    )
    return wide if missing is None else wide.where(F.col("fold") != missing)


def fold_metrics(spark: SparkSession, sf_dir: str, missing: int | None = None) -> DataFrame:
    """The same in long form, with one metric missing in fold 0 and NaN in fold 1."""
    nan = F.lit(float("nan"))
    value = F.when((F.col("fold") == 1) & (F.col("metric") == "accuracy_good"), nan)
    return (
        fold_records(spark, sf_dir, missing)
        .unpivot("fold", ["accuracy", "accuracy_good", "n_rows"], "metric", "value")
        .where((F.col("fold") != 0) | (F.col("metric") != "accuracy_good"))
        .withColumn("value", value.otherwise(F.col("value")))
    )


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts in groups of seven, with a completion text, its answer and a time."""
    events = table(spark, sf_dir, "events")
    return rollouts_from_events(events)


def rollout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollouts as a stream over the events, a file or a folder of parts."""
    # a stream's source must be a folder or a pattern; this one matches either form
    reader = spark.readStream.schema(_SCHEMAS["events"])
    return rollouts_from_events(reader.parquet(f"{sf_dir.rstrip('/')}/events.parquet*"))


def rollouts_from_events(events: DataFrame) -> DataFrame:
    """The rollout columns for an events table or stream."""
    tagged = render_cot(F.col("props"), F.col("event_type"))
    completion = F.when(F.col("event_id") % 3 == 1, F.concat(F.lit("> "), tagged)).otherwise(tagged)
    answer = F.when(F.col("user_id") % 4 == 0, F.lit("click")).otherwise(F.col("event_type"))
    ts = F.col("ts")
    if events.isStreaming:
        # a watermark needs a zoned time: the zone-less one as UTC, whatever the session's zone
        ts = F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")
    return events.select(
        "event_id",
        F.expr("event_id div 7").alias("grp"),
        F.col("value").alias("reward"),
        ts.alias("ts"),
        completion.alias("completion"),
        answer.alias("answer"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged responses in both layouts, some without tokens, in batches of eight."""
    events = table(spark, sf_dir, "events")
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    response = _choose(
        key % 4,
        F.concat(
            F.lit('{"completion_ids":[['), user, F.lit(","), (key % 97 + 1).cast("string"),
            F.lit("],[]]}"),
        ),
        F.concat(F.lit('{"outputs":[{"token_ids":['), user, F.lit(",7,8]}]}")),
        F.concat(
            F.lit('{"completion_ids":[],"outputs":[{"token_ids":['), (key % 13).cast("string"),
            F.lit("]}]}"),
        ),
        F.lit('{"completion_ids":[],"outputs":[]}'),
    )
    return events.select(
        "event_id",
        F.expr("event_id div 8").alias("batch_id"),
        F.sequence(F.lit(1), (key % 4 + 1).cast("int")).alias("prompt_ids"),
        response.alias("response"),
    )


def response_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses as log lines, some of them broken."""
    df, key = responses(spark, sf_dir), F.col("event_id")
    whole = F.col("response")
    line = _choose(
        key % 11,
        F.expr("left(response, length(response) - 3)"),
        F.lit('{"completion_ids":"lost"}'),
        F.lit("  "),
        F.lit("[1,2]"),
        F.lit("timed out"),
        whole,
    )
    return df.select("event_id", line.alias("line"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory listings of training runs, with near-miss names and plain files."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    name = F.concat(F.lit("checkpoint-"), key.cast("string"))
    return orders.select(
        F.col("o_custkey").alias("run"),
        F.when(key % 6 == 4, F.concat(name, F.lit("x")))
        .when(key % 6 == 5, F.concat(F.lit("my-"), name))
        .otherwise(name).alias("name"),
        (key % 7 != 3).alias("is_dir"),
    ).select(
        "run", F.concat(F.lit("runs/"), F.col("run"), F.lit("/"), F.col("name")).alias("path"),
        "name", "is_dir",
    )


def series(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Monthly prices per ticker; with gaps, one ticker lacks some months."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").alias("month"),
        F.col("o_totalprice").alias("price"),
    )
    gap = (F.year("month") * 12 + F.month("month")) % 17 == 0
    if gaps:
        orders = orders.where(~((F.col("ticker") == "5-LOW") & gap))
    return labels.monthly_prices(orders, "ticker", "month", "price")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices per ticker without weekends; one ticker has a third of all rows."""
    hot = F.col("o_orderkey") % 3 == 0
    orders = table(spark, sf_dir, "orders").select(
        F.when(hot, "HOT").otherwise(F.col("o_orderpriority")).alias("ticker"),
        F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"),
    )
    weekday = F.dayofweek("day").between(2, 6)
    return labels.daily_prices(orders.where(weekday), "ticker", "day", "price")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat prompts of all questions and of all user turns, with their gold answers."""
    questions = prompts.prepare_qa(qa(spark, sf_dir)).select(
        F.lit("qa").alias("src"), F.col("item_id").alias("id"), F.lit(0).cast("bigint").alias("turn"),
        "prompt", "answer",
    )
    users = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    turns = users.select(
        F.lit("conversation").alias("src"), F.col("conv_id").alias("id"), "turn",
        prompts.chat_messages(F.col("text")).alias("prompt"),
        F.lit(None).cast("string").alias("answer"),
    )
    return questions.unionByName(turns)
