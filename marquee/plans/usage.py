"""Usage statistics as table jobs.

The chat front end kept per-session counters in memory; here usage records
are rows, and every statistic is a grouped aggregation.  Records are derived
from a conversation log: the role stands for the model, user/system text is
input, assistant text is output, tokens are estimated as characters // 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.numeric import int_div
from marquee.functions.scalar import human_count, token_estimate

INPUT_ROLES = ("user", "system")
OUTPUT_ROLES = ("assistant",)


def usage_records(conversations: DataFrame) -> DataFrame:
    """One usage record per message: (conv_id, turn, model, question, tokens...)."""
    est = token_estimate("text")
    role = F.col("role")
    return conversations.select(
        "conv_id", "turn", role.alias("model"),
        F.when(role == "user", F.col("text")).alias("question"),
        F.when(role.isin(*INPUT_ROLES), est).otherwise(F.lit(0)).cast("bigint").alias("input_tokens"),
        F.when(role.isin(*OUTPUT_ROLES), est).otherwise(F.lit(0)).cast("bigint").alias("output_tokens"),
    )


def question_records(log: DataFrame) -> DataFrame:
    """One usage record per question of a log (conv_id, turn, role, text, ts, model, sql).

    A question is a user turn with the turns up to the next one; turns before
    the first question (instructions) count as input of the first.  The record
    has the question's time and text, the model asked, the estimated tokens
    of its input and output turns, and whether an answer executed SQL (an
    output turn with ``sql``).  Conversations without a question give none.
    """
    est = token_estimate("text")
    asked = F.col("role") == "user"
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    numbered = log.withColumn("question_no", F.greatest(F.count_if(asked).over(by_turn), F.lit(1)).cast("bigint"))

    def tokens(roles):
        return F.coalesce(F.sum(F.when(F.col("role").isin(*roles), est)), F.lit(0)).cast("bigint")

    return (numbered.groupBy("conv_id", "question_no")
            .agg(F.max(F.when(asked, F.col("ts"))).alias("timestamp"),
                 F.max(F.when(asked, F.col("text"))).alias("question"),
                 F.max(F.when(asked, F.col("model"))).alias("model"),
                 tokens(INPUT_ROLES).alias("input_tokens"), tokens(OUTPUT_ROLES).alias("output_tokens"),
                 F.coalesce(F.bool_or(F.col("role").isin(*OUTPUT_ROLES) & F.col("sql").isNotNull()), F.lit(False))
                  .alias("sql_executed"),
                 F.count_if(asked).alias("_asked"))
            .filter("_asked > 0").drop("_asked"))


def question_summary(records: DataFrame) -> DataFrame:
    """Per session, from question records alone: questions, tokens, questions that
    executed SQL, minutes from the first to the last, and uses of each model
    (``model=uses`` by model, comma-joined)."""
    per_model = records.groupBy("conv_id", "model").agg(
        F.count(F.lit(1)).alias("uses"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"),
        F.count_if("sql_executed").alias("q"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"))
    use = F.concat_ws("=", F.coalesce("model", F.lit("")), F.col("uses").cast("string"))
    tenths = int_div((F.unix_micros(F.max("t1")) - F.unix_micros(F.min("t0"))) * 2 + F.lit(6_000_000), F.lit(12_000_000))
    return per_model.groupBy("conv_id").agg(
        F.sum("uses").cast("bigint").alias("total_questions"),
        F.sum(F.col("i") + F.col("o")).cast("bigint").alias("total_tokens"),
        F.sum("i").cast("bigint").alias("input_tokens"), F.sum("o").cast("bigint").alias("output_tokens"),
        F.sum("q").cast("bigint").alias("sql_questions"),
        (tenths / F.lit(10.0)).alias("session_duration_minutes"),
        F.array_join(F.array_sort(F.collect_list(use)), ",").alias("model_usage"))


def session_summary(records: DataFrame) -> DataFrame:
    """Per session: questions asked and input / output / total tokens."""
    return (records.groupBy("conv_id")
            .agg(F.count_if(F.col("model") == "user").cast("bigint").alias("total_questions"),
                 F.sum("input_tokens").cast("bigint").alias("input_tokens"),
                 F.sum("output_tokens").cast("bigint").alias("output_tokens"))
            .withColumn("total_tokens", F.col("input_tokens") + F.col("output_tokens")))


def uses_by_model(records: DataFrame) -> DataFrame:
    """Keyed counter: number of uses per model."""
    return records.groupBy("model").agg(F.count(F.lit(1)).alias("uses"))


def session_duration(events: DataFrame, session: str = "user_id", ts: str = "ts") -> DataFrame:
    """Per session: events and minutes between first and last event, to 1 decimal
    (half up, computed on integer microseconds)."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    s = events.groupBy(session).agg(F.count(F.lit(1)).alias("events"),
                                    (F.max(us) - F.min(us)).alias("_dur_us"))
    tenths = int_div(F.col("_dur_us") * 2 + F.lit(6_000_000), F.lit(12_000_000))
    return s.select(session, "events",
                    (tenths / F.lit(10.0)).alias("session_duration_minutes"))


def token_estimates(conversations: DataFrame) -> DataFrame:
    """Per message: characters and the characters // 4 token estimate."""
    return conversations.select("conv_id", "turn", "role",
                                F.length("text").cast("bigint").alias("n_chars"),
                                token_estimate("text").alias("est_tokens"))


def display_totals(records: DataFrame) -> DataFrame:
    """Per session total tokens and its human-readable form (1.2K, 3.45M)."""
    s = session_summary(records)
    return s.select("conv_id", "total_tokens", human_count("total_tokens").alias("display"))
