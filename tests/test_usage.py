from datetime import datetime

from marquee.plans import usage


def test_records_summary_and_display(spark):
    conv = spark.createDataFrame(
        [(1, 0, "system", "x" * 40), (1, 1, "user", "y" * 9), (1, 2, "assistant", "z" * 4003),
         (2, 0, "user", "hi")], "conv_id bigint, turn bigint, role string, text string")
    rec = usage.usage_records(conv)
    s = {r.conv_id: r for r in usage.session_summary(rec).collect()}
    assert (s[1].total_questions, s[1].input_tokens, s[1].output_tokens, s[1].total_tokens) == \
        (1, 12, 1000, 1012)
    assert s[2].total_tokens == 0
    d = {r.conv_id: r.display for r in usage.display_totals(rec).collect()}
    assert d == {1: "1.0K", 2: "0"}
    assert {r.model: r.uses for r in usage.uses_by_model(rec).collect()} == \
        {"system": 1, "user": 2, "assistant": 1}


def test_session_duration_rounding(spark):
    ev = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 0, 0, 0)), (1, datetime(2024, 1, 1, 0, 1, 27)),
         (2, datetime(2024, 1, 1, 0, 0, 0)), (2, datetime(2024, 1, 1, 0, 0, 3))],
        "user_id bigint, ts timestamp_ntz")
    got = {r.user_id: r.session_duration_minutes for r in usage.session_duration(ev).collect()}
    assert got == {1: 1.5, 2: 0.1}   # 87 s = 1.45 min -> 1.5 (half up); 3 s = 0.05 -> 0.1


def test_display_follows_binary_doubles(spark):
    ns = [0, 999, 1000, 1001, 1049, 1050, 1250, 1350, 1450, 2250, 999_949, 999_950, 999_951, 1_000_000, 1_000_001,
          1_004_999, 1_005_000, 1_015_000, 1_125_000, 1_995_000, 123_456_785_000, 9_007_199_254_740_991]
    ns += [1050 + 100 * i for i in range(500)] + [1_005_000 + 10_000 * i for i in range(500)]

    def plain(n):
        return f"{n / 1_000_000:.2f}M" if n > 1_000_000 else f"{n / 1_000:.1f}K" if n > 1_000 else str(n)

    from marquee.functions.scalar import human_count
    df = spark.createDataFrame([(n,) for n in ns], "n bigint")
    assert {r.n: r.d for r in df.select("n", human_count("n").alias("d")).collect()} == {n: plain(n) for n in ns}


def test_question_records(spark):
    t = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(1, 0, "system", "x" * 40, t, "a", None), (1, 1, "user", "y" * 9, t, "a", None),
         (1, 2, "assistant", "z" * 40, t, "a", "SELECT 1"), (1, 3, "assistant", "z" * 4, t, "a", None),
         (1, 4, "user", "w", datetime(2024, 1, 1, 0, 1, 27), "b", None),
         (2, 0, "assistant", "no question", t, "a", None), (3, 0, "user", None, t, None, None)],
        "conv_id bigint, turn bigint, role string, text string, ts timestamp, model string, sql string")
    rec = usage.question_records(log)
    got = {(r.conv_id, r.question_no): (r.question, r.model, r.input_tokens, r.output_tokens, r.sql_executed)
           for r in rec.collect()}
    assert got == {(1, 1): ("y" * 9, "a", 12, 11, True), (1, 2): ("w", "b", 0, 0, False),
                   (3, 1): (None, None, 0, 0, False)}
    s = {r.conv_id: r for r in usage.question_summary(rec).collect()}
    assert (s[1].total_questions, s[1].total_tokens, s[1].sql_questions, s[1].session_duration_minutes,
            s[1].model_usage) == (2, 23, 1, 1.5, "a=1,b=1")
    assert (s[3].total_questions, s[3].model_usage) == (1, "=1")
