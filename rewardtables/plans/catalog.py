"""Registered queries: name to a function of (spark, data directory).

Each runs over the whole of its tables. Rounding to six decimals happens here,
where results are compared; the operators do not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardtables.constants import BAND_ORDINALS, BENCHMARK_ROWS, MAX_PROMPT_TOKENS, RISK_LEVELS
from rewardtables.functions import bands, chat, rewards, text, tokens
from rewardtables.operators import (
    evaluation,
    folds,
    labels,
    metrics,
    predictions,
    prompts,
    risk,
    rollouts,
    scorecard,
    splits,
)
from rewardtables.plans import fixtures
from rewardtables.sources import fold_files, positions, quarantine, scratch, tables
from rewardtables.sources.schemas import PREDICTIONS, QA
from rewardtables.streaming import periodic

Query = Callable[[SparkSession, str], DataFrame]

REWARDS = ["correctness", "strict_format", "length"]
PAIRS = {
    "returns": ("gt_ret_1y", "pred_ret_1y"),
    "volatility": ("gt_vol_1y", "pred_vol_1y"),
}
HORIZON_PAIRS = {
    ("returns", "1y"): ("gt_ret_1y", "pred_ret_1y"),
    ("volatility", "1y"): ("gt_vol_1y", "pred_vol_1y"),
    ("returns", "5y"): ("gt_ret_5y", "pred_ret_5y"),
    ("volatility", "5y"): ("gt_vol_5y", "pred_vol_5y"),
}
EOS, PAD = 9, 0

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# --- text and rewards ---------------------------------------------------------


@_query
def xml_answer_extract(spark, sf_dir):
    df = fixtures.completions(spark, sf_dir)
    return df.select("conv_id", "turn", text.xml_answer(F.col("completion")).alias("extracted"))


@_query
def hash_answer_extract(spark, sf_dir):
    return prompts.prepare_qa(fixtures.qa(spark, sf_dir)).drop("prompt")


@_query
def reward_correctness(spark, sf_dir):
    paired = scorecard.pair(
        fixtures.nested_completions(spark, sf_dir), fixtures.answers(spark, sf_dir),
        ["conv_id", "turn"],
    )
    reward = rewards.correctness(text.first_content(F.col("completion")), F.col("answer"))
    return paired.select("conv_id", "turn", "answer", reward.alias("reward"))


@_query
def reward_strict_format(spark, sf_dir):
    df = fixtures.completions(spark, sf_dir)
    return df.select("conv_id", "turn", rewards.strict_format(F.col("completion")).alias("reward"))


@_query
def reward_length(spark, sf_dir):
    df = fixtures.completions(spark, sf_dir)
    return df.select("conv_id", "turn", rewards.length(F.col("completion")).alias("reward"))


@_query
def reward_scorecard(spark, sf_dir):
    scored = scorecard.scorecard(fixtures.completions(spark, sf_dir), REWARDS)
    summary = scorecard.scorecard_summary(scored, "variant", REWARDS)
    return _rounded(summary, *[f"mean_{n}" for n in [*REWARDS, "total"]])


@_query
def reward_scorecard_rows(spark, sf_dir):
    scored = scorecard.scorecard(fixtures.completions(spark, sf_dir), REWARDS)
    return scored.select(
        "conv_id", "turn", *[f"reward_{n}" for n in REWARDS], "reward_total"
    )


@_query
def python_reward(spark, sf_dir):
    """A user's Python reward: the number of closing tags in a completion."""

    # local functions travel to the executors by value
    def closing_tags(completions, **kwargs):
        return [float(c[0]["content"].count("</")) for c in completions]

    reward = scorecard.python_reward(closing_tags, {"completions": "raw_completion"})
    scored = scorecard.scorecard(
        fixtures.nested_completions(spark, sf_dir), ["closing_tags"], own={"closing_tags": reward}
    )
    return scored.select("conv_id", "turn", F.col("reward_closing_tags").alias("reward"))


@_query
def cot_render_roundtrip(spark, sf_dir):
    rendered = text.render_cot(F.translate("text", "\n", " "), F.col("answer"))
    df = fixtures.completions(spark, sf_dir).withColumn("rendered", rendered)
    extracted = text.xml_answer(F.col("rendered"))
    return df.select(
        "conv_id", "turn", extracted.alias("extracted"),
        rewards.strict_format(F.col("rendered")).alias("reward"),
        (extracted == F.col("answer")).alias("same"),
    )


# --- prompts ------------------------------------------------------------------


@_query
def chat_prompt_build(spark, sf_dir):
    return fixtures.chats(spark, sf_dir).select(
        "src", "id", "turn", chat.render_chat(F.col("prompt")).alias("chat"), "answer",
        text.last_user_text(F.col("prompt")).alias("last_user"),
    )


@_query
def prompt_tail_truncate(spark, sf_dir):
    words = chat.whitespace_tokens(F.col("text"))
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", words.alias("words"))
    return docs.select(
        "doc_id", F.size("words").alias("n_tokens"),
        F.array_join(chat.keep_last(F.col("words"), 64), " ").alias("tail"),
    )


@_query
def format_prompts(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents").withColumnRenamed("text", "prompt")
    return prompts.format_prompts(docs, MAX_PROMPT_TOKENS, keep=("doc_id",))


@_query
def tokenizer_tail_truncate(spark, sf_dir):
    """The same with a tokenizer plugged in: one token per character, the last 500 kept."""

    class Characters:
        def encode_batch(self, texts):
            return [list(text) for text in texts]

        def decode_batch(self, ids):
            return ["".join(x) for x in ids]

    docs = fixtures.table(spark, sf_dir, "documents").withColumnRenamed("text", "prompt")
    return prompts.format_prompts(
        docs, 500, tokenizer=Characters(), keep=("doc_id",)
    )


@_query
def word_tokenizer_tail(spark, sf_dir):
    """Prompts cut to the last 2,048 tokens of a public word tokenizer."""
    import public_tokenizers

    tokenizer = prompts.FileTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    docs = fixtures.table(spark, sf_dir, "documents").withColumnRenamed("text", "prompt")
    return prompts.format_prompts(docs, MAX_PROMPT_TOKENS, tokenizer=tokenizer, keep=("doc_id",))


@_query
def instruction_concat_first_n(spark, sf_dir):
    bench = fixtures.bench(spark, sf_dir)
    first = prompts.instruction_prompt(bench, "item_key", limit=BENCHMARK_ROWS)
    return first.select("item_key", "prompt")


@_query
def first_rows_in_source_order(spark, sf_dir):
    """The first benchmark prompts of a folder of parts without a key column, in the order of the files."""
    path = scratch.scratch_dir(spark, "parts")
    bench = fixtures.bench(spark, sf_dir)
    bench.repartitionByRange(8, "item_key").sortWithinPartitions("item_key").drop("item_key").write.parquet(path)
    schema = bench.drop("item_key").schema
    first = positions.first_rows(tables.read_table(spark, path, schema), BENCHMARK_ROWS)
    return prompts.instruction_prompt(first).select("prompt", "output", "generated")


@_query
def benchmark_result_rows(spark, sf_dir):
    every = prompts.instruction_prompt(fixtures.bench(spark, sf_dir), "item_key")
    return metrics.exact_match_rows(every).select(
        "item_key", "prompt", "prediction", F.col("output").alias("answer"), "correct"
    )


@_query
def benchmark_exact_match(spark, sf_dir):
    every = prompts.instruction_prompt(fixtures.bench(spark, sf_dir), "item_key")
    return _rounded(metrics.exact_match(every), "accuracy")


@_query
def benchmark_exact_match_all(spark, sf_dir):
    every = prompts.instruction_prompt(fixtures.bench(spark, sf_dir), "item_key")
    return _rounded(metrics.exact_match(every, by=["instruction"]), "accuracy")


# --- predictions and band metrics ---------------------------------------------


FIELDS = {
    "pred_ret_1y": ("returns_1y", BAND_ORDINALS["returns"]),
    "pred_vol_1y": ("volatility_1y", BAND_ORDINALS["volatility"]),
    "pred_ret_5y": ("returns_5y", BAND_ORDINALS["returns"]),
    "pred_vol_5y": ("volatility_5y", BAND_ORDINALS["volatility"]),
}


def _parsed(df: DataFrame, *keep: str) -> DataFrame:
    truth = [
        F.col(f"ground_truth_{band}_{horizon}").alias(f"gt_{band[:3]}_{horizon}")
        for horizon in ("1y", "5y")
        for band in ("returns", "volatility")
    ]
    return predictions.parse_predictions(df, FIELDS, keep=["doc_id", *keep, *truth])


@_query
def parse_band_prediction(spark, sf_dir):
    return _parsed(fixtures.band_texts(spark, sf_dir))


@_query
def parse_risk_level(spark, sf_dir):
    df = fixtures.band_texts(spark, sf_dir)
    fields = {"risk_level": ("risk_level", RISK_LEVELS)}
    return predictions.parse_predictions(df, fields, keep=["doc_id"])


@_query
def grpo_task_filter(spark, sf_dir):
    return metrics.only_task(fixtures.band_texts(spark, sf_dir)).select(
        "doc_id", "ground_truth_returns_1y", "ground_truth_volatility_1y"
    )


def _pairs(spark, sf_dir) -> DataFrame:
    return metrics.long_pairs(fixtures.predictions(spark, sf_dir), PAIRS)


def _band_metrics(spark, sf_dir, *names: str) -> DataFrame:
    out = metrics.band_metrics(_pairs(spark, sf_dir), groups=list(PAIRS)).select("band_type", *names)
    return _rounded(out, *[n for n in names if not n.startswith("n")])


@_query
def confusion_counts(spark, sf_dir):
    return metrics.confusion(_pairs(spark, sf_dir))


@_query
def band_ordinals(spark, sf_dir):
    df = fixtures.predictions(spark, sf_dir)
    stacked = F.stack(
        F.lit(2), F.lit("returns"), F.col("pred_ret_1y"), F.lit("volatility"), F.col("pred_vol_1y")
    ).alias("band_type", "band")
    return metrics.ordinal(df.select("doc_id", stacked), "band", "band_type", "ord")


@_query
def band_accuracy(spark, sf_dir):
    return _band_metrics(spark, sf_dir, "n", "accuracy")


@_query
def band_mse(spark, sf_dir):
    return _band_metrics(spark, sf_dir, "n", "n_unmapped", "mse")


@_query
def band_f1_weighted(spark, sf_dir):
    return _band_metrics(spark, sf_dir, "n", "f1_weighted")


@_query
def band_r2(spark, sf_dir):
    return _band_metrics(spark, sf_dir, "n", "n_unmapped", "r2")


@_query
def band_metrics_all(spark, sf_dir):
    return _band_metrics(
        spark, sf_dir, "n", "n_unmapped", "accuracy", "mse", "f1_weighted", "r2"
    )


@_query
def band_metrics_by_horizon(spark, sf_dir):
    by = ["band_type", "horizon"]
    pairs = metrics.long_pairs(fixtures.predictions(spark, sf_dir), HORIZON_PAIRS, by=by)
    out = metrics.band_metrics(pairs, by=by, groups=list(HORIZON_PAIRS))
    return _rounded(out, "accuracy", "mse", "f1_weighted", "r2")


@_query
def evaluation_metric_map(spark, sf_dir):
    """From financial examples with completions to the metric map: filter, parse, measure.

    Both horizons. The result rows are written once; metrics and risk read that narrow table.
    """
    parsed = _examples(spark, sf_dir)
    long = [x for h in ("1y", "5y") for x in (F.lit(h), F.col(f"pred_ret_{h}"))]
    returns = parsed.select("doc_id", F.stack(F.lit(2), *long).alias("horizon", "predicted"))
    tails = risk.var_cvar_by(returns, ["horizon"], "predicted", "doc_id")
    return _rounded(_band_map(parsed).unionByName(evaluation.tail_rows(tails)), "value")


def _band_map(parsed: DataFrame) -> DataFrame:
    by = ["band_type", "horizon"]
    pairs = metrics.long_pairs(parsed, HORIZON_PAIRS, by=by)
    return metrics.metric_map(metrics.band_metrics(pairs, by=by, groups=list(HORIZON_PAIRS)), by=by)


@_query
def metric_sink_roundtrip(spark, sf_dir):
    """The band metrics of the evaluation, written as JSON lines and read back."""
    path = scratch.scratch_dir(spark, "metrics")
    tables.write_metrics(_band_map(_examples(spark, sf_dir)), path)
    return _rounded(tables.read_table(spark, path, "metric STRING, value DOUBLE", fmt="json"), "value")


@_query
def confusion_state_stream(spark, sf_dir):
    """Band metrics from a state that micro-batches add to, every batch delivered twice."""
    base = scratch.scratch_dir(spark, "confusion")
    # several files, a few of which make a batch
    _pairs(spark, sf_dir).repartition(4).write.parquet(f"{base}/pairs")
    write = evaluation.state_writer(f"{base}/state", ["band_type"])

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    reader = spark.readStream.schema("band_type STRING, gt STRING, pred STRING").option("maxFilesPerTrigger", 1)
    query = (
        reader.parquet(f"{base}/pairs").writeStream.foreachBatch(twice)
        .option("checkpointLocation", f"{base}/offsets").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    cells = evaluation.read_state(spark, f"{base}/state", ["band_type"])
    return _rounded(metrics.metrics_from_confusion(cells), "accuracy", "mse", "f1_weighted", "r2")


def _examples(spark, sf_dir) -> DataFrame:
    """Parsed examples of the task with their fold, written once: texts are scanned and parsed a single time."""
    examples = splits.kfold(metrics.only_task(fixtures.band_texts(spark, sf_dir)), "doc_id", 5)
    return scratch.staged(_parsed(examples, "fold"), "evaluation")


def _evaluated(spark, sf_dir) -> DataFrame:
    return evaluation.evaluate(_examples(spark, sf_dir), HORIZON_PAIRS, "doc_id", 5)


@_query
def kfold_evaluation(spark, sf_dir):
    """Every metric of every fold and of all folds together, both horizons, one scan of the examples."""
    return _rounded(_evaluated(spark, sf_dir), "value")


@_query
def kfold_summary(spark, sf_dir):
    """The evaluation's folds published as files, read back as the current version, and summarised."""
    base = scratch.scratch_dir(spark, "kfold")
    by_fold = _evaluated(spark, sf_dir).where("fold IS NOT NULL")
    fold_files.publish_fold_metrics(by_fold, base)
    return _rounded(folds.summarise(fold_files.read_fold_metrics(spark, base, 5)), "mean", "std_dev")


# --- risk ---------------------------------------------------------------------


@_query
def var_cvar_simulated(spark, sf_dir):
    out = risk.var_cvar(fixtures.predictions(spark, sf_dir), "pred_ret_1y", "doc_id")
    return _rounded(out, "var", "cvar")


@_query
def var_cvar_by_fold(spark, sf_dir):
    """Simulated risk of every fold and horizon, and of each horizon as a whole, in one pass."""
    df = splits.kfold(fixtures.predictions(spark, sf_dir), "doc_id", 5)
    long = [x for h in ("1y", "5y") for x in (F.lit(h), F.col(f"pred_ret_{h}"))]
    df = scratch.staged(df.select("doc_id", "fold", F.stack(F.lit(2), *long).alias("horizon", "predicted")), "returns")
    sets = [["horizon", "fold"], ["horizon"]]
    return _rounded(risk.var_cvar_by(df, ["horizon", "fold"], "predicted", "doc_id", sets=sets), "var", "cvar")


@_query
def var_cvar_unusable(spark, sf_dir):
    """Risk of predictions none of which has a distribution: one row without values."""
    out = risk.var_cvar(fixtures.predictions(spark, sf_dir), "pred_vol_1y", "doc_id")
    return _rounded(out, "var", "cvar")


@_query
def var_cvar_mixture(spark, sf_dir):
    out = risk.var_cvar_mixture(fixtures.predictions(spark, sf_dir), "pred_ret_1y")
    return _rounded(out, "var", "cvar")


# --- splits and folds ---------------------------------------------------------


@_query
def kfold_assign(spark, sf_dir):
    return splits.kfold(fixtures.predictions(spark, sf_dir), "doc_id", 5).select("doc_id", "fold")


@_query
def holdout_split(spark, sf_dir):
    return splits.holdout(fixtures.predictions(spark, sf_dir), "doc_id").select("doc_id", "split")


@_query
def load_fold_sides(spark, sf_dir):
    df = fixtures.predictions(spark, sf_dir)
    return splits.fold_sides(df, "doc_id", k_folds=5, fold_index=2).select("doc_id", "side")


@_query
def fold_metric_summary(spark, sf_dir):
    return _rounded(folds.summarise(fixtures.fold_metrics(spark, sf_dir)), "mean", "std_dev")


@_query
def append_fold_records(spark, sf_dir):
    """Wide fold records with differing keys, appended and put in long form."""
    wide = scratch.staged(fixtures.fold_records(spark, sf_dir), "records")
    first = wide.where(F.col("fold") == 0).drop("accuracy_good")
    return _rounded(folds.to_long(folds.append_folds(first, wide.where(F.col("fold") != 0))), "value")


@_query
def fold_file_summary(spark, sf_dir):
    """The same through one JSON file per fold."""
    base = scratch.scratch_dir(spark, "folds")
    fold_files.write_fold_metrics(fixtures.fold_metrics(spark, sf_dir, missing=3), base)
    read = fold_files.read_fold_metrics(spark, base, 5)
    return _rounded(folds.summarise(read), "mean", "std_dev")


@_query
def missing_folds(spark, sf_dir):
    return folds.missing_folds(fixtures.fold_metrics(spark, sf_dir, missing=3), 5)


@_query
def fold_status(spark, sf_dir):
    return folds.fold_status(fixtures.fold_metrics(spark, sf_dir, missing=3), 5)


@_query
def result_sink_roundtrip(spark, sf_dir):
    path = scratch.scratch_dir(spark, "results")
    columns = ["doc_id", "gt_ret_1y", "gt_vol_1y", "pred_ret_1y", "pred_vol_1y"]
    tables.write_results(fixtures.predictions(spark, sf_dir).select(*columns), path)
    return tables.read_table(spark, path, f"doc_id BIGINT, {PREDICTIONS}")


@_query
def split_table_scan(spark, sf_dir):
    """Questions written by split, one split read back: only its directory is scanned."""
    path = scratch.scratch_dir(spark, "qa")
    split = splits.holdout(fixtures.qa(spark, sf_dir), "item_id")
    split.select("question", "answer", "split").write.partitionBy("split").parquet(path)
    return tables.read_table(spark, path, QA, split="test")


# --- rollouts -----------------------------------------------------------------


@_query
def group_relative_advantage(spark, sf_dir):
    df = fixtures.rollouts(spark, sf_dir).select("event_id", "grp", "reward")
    return _rounded(rollouts.group_advantage(df, "grp", "reward"), "advantage")


@_query
def rollout_scoring(spark, sf_dir):
    """Rollouts to training signal: every reward, their sum, its advantage within the group."""
    scored = scorecard.scorecard(fixtures.rollouts(spark, sf_dir), REWARDS)
    # written once: the advantage reads its input twice
    narrow = scratch.staged(scored.select("event_id", "grp", "reward_total"), "scored")
    return _rounded(rollouts.group_advantage(narrow, "grp", "reward_total"), "advantage")


def _ids(c: Column) -> Column:
    return F.array_join(c.cast("array<string>"), ",")


def _sequences(spark, sf_dir) -> DataFrame:
    df = rollouts.normalise_responses(fixtures.responses(spark, sf_dir), "response", EOS)
    return rollouts.explode_sequences(df.drop("response"))


def _padded(spark, sf_dir) -> DataFrame:
    # parsed and exploded once; padding reads its input twice
    return rollouts.pad_batch(scratch.staged(_sequences(spark, sf_dir), "sequences"), "seq", "batch_id", PAD)


@_query
def response_normalise(spark, sf_dir):
    return _sequences(spark, sf_dir).select("event_id", "pos", _ids(F.col("seq")).alias("ids"))


@_query
def response_log_scan(spark, sf_dir):
    """Responses logged as JSON lines, read back and normalised; how often each sequence occurs."""
    path = scratch.scratch_dir(spark, "responses")
    fixtures.responses(spark, sf_dir).select("response").write.text(path)
    logged = rollouts.normalise_responses(tables.read_responses(spark, path), "response", EOS)
    sequences = rollouts.explode_sequences(logged.drop("response"))
    return sequences.groupBy(_ids(F.col("seq")).alias("ids")).agg(F.count(F.lit(1)).alias("n"))


@_query
def response_log_quarantine(spark, sf_dir):
    """A log with broken lines: how often each sequence of the good ones and each broken line occurs."""
    path = scratch.scratch_dir(spark, "lines")
    fixtures.response_lines(spark, sf_dir).select("line").write.text(path)
    log = quarantine.read_log(spark, path, tokens.RESPONSE_SCHEMA)
    ids = tokens.response_ids(F.col("parsed"), EOS)
    good = rollouts.explode_sequences(log.good.select(ids.alias("completion_ids")))
    good = good.select(F.lit("good").alias("kind"), _ids(F.col("seq")).alias("content"))
    every = good.unionByName(log.broken.select(F.col("reason").alias("kind"), F.col("line").alias("content")))
    return every.groupBy("kind", "content").agg(F.count(F.lit(1)).alias("n"))


@_query
def log_pairing(spark, sf_dir):
    """Two logs without a key, completions and answers, the latter longer: paired by place and scored."""
    base = scratch.scratch_dir(spark, "logs")
    order = ["conv_id", "turn"]
    scored = fixtures.completions(spark, sf_dir)
    flat = scored.select(*order, F.translate("completion", "\n", " ").alias("value"))
    flat.orderBy(*order).select("value").write.text(f"{base}/completions")
    more = fixtures.table(spark, sf_dir, "benchmark").select(
        F.lit(None).cast("bigint").alias("conv_id"), F.col("item_id").alias("turn"), F.lit("none").alias("answer")
    )
    answers = scored.select(*order, "answer").unionByName(more)
    answers.orderBy(F.col("conv_id").asc_nulls_last(), "turn").select("answer").write.text(f"{base}/answers")
    paired = positions.pair_rows(
        spark.read.text(f"{base}/completions").withColumnRenamed("value", "completion"),
        spark.read.text(f"{base}/answers").withColumnRenamed("value", "answer"),
    )
    reward = rewards.correctness(F.col("completion"), F.col("answer"))
    return paired.select("position", "answer", reward.alias("reward"))


@_query
def positional_pairing(spark, sf_dir):
    pairs = tokens.zip_shortest(F.col("prompt_ids"), F.col("seq"))
    shown = F.transform(pairs, lambda p: F.concat_ws(":", p["left"], p["right"]))
    return _sequences(spark, sf_dir).select("event_id", "pos", F.array_join(shown, ",").alias("pairs"))


@_query
def pad_batch(spark, sf_dir):
    padded = _padded(spark, sf_dir)
    return padded.select("event_id", "batch_id", "pos", _ids(F.col("padded_ids")).alias("ids"))


@_query
def concat_prompt_completion(spark, sf_dir):
    padded = _padded(spark, sf_dir)
    joined = tokens.append_ids(F.col("prompt_ids"), F.col("padded_ids"))
    return padded.select("event_id", "pos", _ids(joined).alias("ids"))


@_query
def ensure_new_token(spark, sf_dir):
    # a response of the end token alone stands for an output without new tokens
    ended = F.col("seq") == F.array(F.lit(EOS))
    prompt = F.col("prompt_ids")
    out = F.when(ended, prompt).otherwise(tokens.append_ids(prompt, F.col("seq")))
    safe = tokens.ensure_new_token(prompt, out, EOS, PAD)
    return _sequences(spark, sf_dir).select("event_id", "pos", _ids(safe).alias("ids"))


@_query
def latest_checkpoint(spark, sf_dir):
    return rollouts.latest_checkpoint(fixtures.checkpoints(spark, sf_dir))


@_query
def checkpoint_steps(spark, sf_dir):
    df = fixtures.checkpoints(spark, sf_dir)
    return df.select("run", "path", "name", "is_dir", tokens.checkpoint_step(F.col("name")).alias("step"))


# --- periodic evaluation ------------------------------------------------------

_MEANS = ["accuracy", *[f"mean_{n}" for n in REWARDS]]


@_query
def periodic_eval(spark, sf_dir):
    df = fixtures.rollouts(spark, sf_dir)
    return _rounded(periodic.periodic_eval(df, "event_id"), *_MEANS)


@_query
def windowed_eval(spark, sf_dir):
    """The streaming evaluation's plan over the batch table: one-day windows."""
    df = fixtures.rollouts(spark, sf_dir)
    out = periodic.periodic_eval_stream(df, "ts", "1 day", "1 hour")
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return _rounded(out, *_MEANS).select(day, "n", *_MEANS)


@_query
def streaming_eval(spark, sf_dir):
    """The same evaluation as a stream over the events, run to its end."""
    base = scratch.scratch_dir(spark, "windows")
    stream = fixtures.rollout_stream(spark, sf_dir)
    windows = periodic.periodic_eval_stream(stream, "ts", "1 day", "1 hour")
    query = periodic.start_windows(windows, f"{base}/out", f"{base}/state", availableNow=True)
    query.awaitTermination()
    out = periodic.read_windows(spark, f"{base}/out", windows.schema)
    epoch_day = F.floor(F.unix_seconds("window_start") / 86400).cast("int")
    day = F.date_format(F.date_from_unix_date(epoch_day), "yyyy-MM-dd").alias("day")
    return _rounded(out, *_MEANS).select(day, "n", *_MEANS)


@_query
def streaming_sample(spark, sf_dir):
    """The exact sample per bucket, gathered by a stream over the events."""
    base = scratch.scratch_dir(spark, "samples")
    write = periodic.sample_writer(f"{base}/out", "event_id", "event_id")
    stream = fixtures.rollout_stream(spark, sf_dir)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    sampled = periodic.sampled_eval(spark, f"{base}/out", stream.schema, "event_id", "event_id")
    return _rounded(sampled, *_MEANS)


# --- price labels -------------------------------------------------------------

def _month() -> Column:
    return labels.month_index(F.col("month")).alias("month_no")


@_query
def forward_return(spark, sf_dir):
    df = fixtures.series(spark, sf_dir)
    horizons = {"return_1y": 12, "return_5y": 60}
    both = labels.forward_returns(df, "ticker", "month", "price", horizons)
    return _rounded(both, "return_1y", "return_5y").select(
        "ticker", _month(), "return_1y", "return_5y"
    )


@_query
def forward_return_gaps(spark, sf_dir):
    """A month without its counterpart has no return; it borrows none from a neighbour."""
    df = fixtures.series(spark, sf_dir, gaps=True)
    out = labels.forward_return(df, "ticker", "month", "price", 12)
    return _rounded(out, "forward_return").select("ticker", _month(), "forward_return")


@_query
def forward_return_asof(spark, sf_dir):
    """Daily prices without weekends: the last price of up to a week before the day counts."""
    df = fixtures.daily_series(spark, sf_dir)
    df = scratch.staged(df, "daily")  # read twice: as rows and as their later prices
    out = labels.forward_return_asof(df, "ticker", "day", "price", 12, 7, "return_1y")
    day = F.date_format("day", "yyyy-MM-dd").alias("day")
    return _rounded(out, "return_1y").select("ticker", day, "return_1y")


@_query
def forward_volatility(spark, sf_dir):
    df = fixtures.series(spark, sf_dir)
    out = labels.forward_volatility(df, "ticker", "month", "price", 12, "volatility_1y")
    out = labels.forward_volatility(out, "ticker", "month", "price", 60, "volatility_5y")
    names = ["volatility_1y", "volatility_5y"]
    return _rounded(out, *names).select("ticker", _month(), *names)


@_query
def return_band(spark, sf_dir):
    horizons = {"r1": 12, "r5": 60}
    df = labels.forward_returns(fixtures.series(spark, sf_dir), "ticker", "month", "price", horizons)
    one = bands.band(F.col("r1"), [-0.05, 0.05], ["bad", "neutral", "good"])
    five = bands.band(F.col("r5"), [-0.1, 0.1], ["bad", "neutral", "good"])
    return df.select("ticker", _month(), one.alias("band_1y"), five.alias("band_5y"))


@_query
def volatility_band(spark, sf_dir):
    df = labels.forward_volatility(fixtures.series(spark, sf_dir), "ticker", "month", "price", 12, "v1")
    df = labels.forward_volatility(df, "ticker", "month", "price", 60, "v5")
    one, five = (bands.band(F.col(v), [0.1, 0.2], ["low", "medium", "high"]) for v in ("v1", "v5"))
    return df.select("ticker", _month(), one.alias("band_1y"), five.alias("band_5y"))


@_query
def history_window(spark, sf_dir):
    series = fixtures.series(spark, sf_dir)
    orders = fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").alias("month"),
        F.col("o_orderkey").alias("n_orders"),
    )
    volume = labels.monthly_prices(orders, "ticker", "month", "n_orders", how=F.count)
    history = labels.history(series, "ticker", "month", ["price"], years=20)
    merged = labels.merge(history, volume, ["ticker", "month"])
    months = F.transform("history", lambda h: F.date_format(h["month"], "yyyyMM"))
    total = F.aggregate("history", F.lit(0.0), lambda acc, h: acc + h["price"])
    return merged.select(
        "ticker", _month(), F.array_join(months, ",").alias("months"),
        F.size("history").alias("n_months"), F.round(total, 2).alias("price_sum"), "n_orders",
    )
