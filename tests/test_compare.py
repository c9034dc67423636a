import json
from pathlib import Path

from pyspark.sql import functions as F

from wattmill.operators import compare, conversations
from wattmill.plans.questions import days_of_rank


def verdict(spark, left, right, schema_left="a string, b double", schema_right=None, **kw):
    r = compare.compare_results(
        spark.createDataFrame(left, schema_left), spark.createDataFrame(right, schema_right or schema_left), **kw
    ).first()
    return r.verdict, r.missing_rows, r.extra_rows


def test_order_names_and_extra_columns_do_not_matter(spark):
    left = [("x", 1.0), ("y", None), ("y", None)]
    assert verdict(spark, left, left[::-1]) == ("GOOD", 0, 0)
    assert verdict(spark, left, left, schema_right="p string, q double") == ("GOOD", 0, 0)
    swapped = [("note", b, a) for a, b in left]
    assert verdict(spark, left, swapped, schema_right="n string, val double, key string") == ("GOOD", 0, 0)
    assert verdict(spark, [("x", 1.0)], [("x", 1)], schema_right="a string, b int") == ("GOOD", 0, 0)
    assert verdict(spark, [("x", -0.0)], [("x", 1e-12)]) == ("GOOD", 0, 0)


def test_rows_and_counts_must_agree(spark):
    left = [("x", 1.0), ("x", 1.0), ("y", 2.0)]
    assert verdict(spark, left, left[1:]) == ("BAD", 1, 0)
    assert verdict(spark, left, [*left, ("y", 2.0)]) == ("BAD", 0, 1)
    assert verdict(spark, left, [("x", 1.0), ("y", 1.0), ("x", 2.0)]) == ("BAD", 2, 2)
    assert verdict(spark, left, [("x",), ("x",), ("y",)], schema_right="a string")[0] == "BAD"
    assert verdict(spark, [], [("x", 1.0)]) == ("BAD", 0, 1)
    assert verdict(spark, [], []) == ("GOOD", 0, 0)


def test_count_and_set_is_not_the_rows(spark):
    left = [("NSW1",), ("QLD1",)]
    got = verdict(spark, left, [(2, ["NSW1", "QLD1"])], "r string", "n long, regions array<string>")
    assert got == ("BAD", 2, 1)


def test_cap_is_only_flagged(spark):
    df = spark.range(60).selectExpr("id AS a")
    r = compare.compare_results(df, df, row_cap=50).first()
    assert (r.verdict, r.over_cap, r.expected_rows) == ("GOOD", True, 60)


def run(name, *assessments):
    return {
        "space_id": "s", "eval_run_id": name, "eval_run_status": "DONE", "created_timestamp": 1, "num_questions": len(assessments),
        "results": [{"result_id": f"r{i}", "benchmark_question_id": f"{i:02d}", "question": "?", "status": "DONE", "assessment": a,
                     "manual_assessment": False, "generated_sql": None} for i, a in enumerate(assessments)],
    }


def test_scores_of_stored_runs(spark, rows):
    files = [run("one", "BAD", "GOOD", "NEEDS_REVIEW", "BAD"), run("two", "GOOD", "BAD", "GOOD", "BAD")]
    raw = spark.createDataFrame([(json.dumps(f),) for f in files], "raw_json string")
    results = compare.run_results(raw)
    assert rows(compare.score_run(results)) == [("one", 4, 1, 1, 2), ("two", 4, 2, 0, 2)]
    parts = [results.where(F.col("eval_run_id") == n) for n in ("one", "two")]
    assert rows(compare.score_delta(*parts)) == [
        ("BAD", "BAD", 1, "same"),
        ("BAD", "GOOD", 1, "up"),
        ("GOOD", "BAD", 1, "down"),
        ("NEEDS_REVIEW", "GOOD", 1, "up"),
    ]


def test_usage_of_messages(spark, rows):
    query = {"attachment_id": "a", "query": {"query": "SELECT 1", "instruction_id": "i"}}
    free = {"attachment_id": "a", "query": {"query": "SELECT 2"}}
    text = {"attachment_id": "t", "text": {"content": "hello"}}
    lines = [
        {"id": "1", "conversation_id": "c", "status": "COMPLETED", "content": "q1", "created_timestamp": 5, "last_updated_timestamp": 9, "attachments": [text, query]},
        {"id": "2", "conversation_id": "c", "status": "COMPLETED", "content": "q2", "created_timestamp": 5, "last_updated_timestamp": 6, "attachments": [free]},
        {"id": "3", "conversation_id": "c", "status": "FAILED", "content": "q3", "created_timestamp": 5},
    ]
    raw = spark.createDataFrame([(json.dumps(x),) for x in lines], "j string")
    messages = raw.select(F.from_json("j", conversations.MESSAGES).alias("m")).select("m.*")
    usage = conversations.conversation_usage(messages)
    assert rows(usage, "message_id", "sql", "trusted", "latency_ms", "status") == [
        ("1", "SELECT 1", True, 4, "COMPLETED"),
        ("2", "SELECT 2", False, 1, "COMPLETED"),
        ("3", None, False, None, "FAILED"),
    ]
    assert rows(conversations.usage_summary(usage), "status", "trusted", "questions", "with_sql") == [
        ("COMPLETED", False, 1, 1),
        ("COMPLETED", True, 1, 1),
        ("FAILED", False, 1, 0),
    ]


def test_columns_are_matched_as_rows(spark):
    expected = spark.createDataFrame([("a", 1, 2), ("b", 2, 1)], "k string, x int, y int")
    actual = spark.createDataFrame([(1, "b", 2, "n"), (2, "a", 1, "m")], "p int, q string, r int, note string")
    assert compare.compare_results(expected, actual).first().verdict == "GOOD"
    swapped = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, x int, y int")
    assert compare.compare_results(expected, swapped).first().verdict == "BAD"
    twice = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "a int, b int, c int")
    assert compare.compare_results(twice, twice.toDF("c", "a", "b")).first().verdict == "GOOD"


def test_turns_pair_with_the_next_turn(spark, rows):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"), (1, 4, "user", "d"), (1, 6, "assistant", "late")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert rows(conversations.pair_turns(df), "turn", "question", "answer") == [(1, "a", "b"), (3, "c", None), (4, "d", "late")]
    assert rows(conversations.pair_turns(df, block=2), "turn", "question", "answer") == [(1, "a", "b"), (3, "c", None), (4, "d", "late")]


def test_fractions_of_a_second_count(spark, rows):
    df = spark.sql(
        """SELECT * FROM VALUES ('old', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-01 12:00:00.1'),
        ('kept', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-01 12:00:00.5') AS t(conversation_id, created, last_updated)"""
    )
    gone, _ = conversations.split_stale(df, "2024-01-02 12:00:00.5")
    assert rows(gone, "conversation_id") == [("old",)]


def test_stale_conversations(spark, rows):
    df = spark.sql(
        """SELECT * FROM VALUES ('old', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-01 11:59:59'),
        ('edge', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-01 12:00:00'),
        ('never', TIMESTAMP'2024-01-02 00:00:00', NULL), ('blank', NULL, NULL) AS t(conversation_id, created, last_updated)"""
    )
    gone, kept = conversations.split_stale(df, "2024-01-02 12:00:00")
    assert rows(gone, "conversation_id") == [("blank",), ("old",)]
    assert rows(kept, "conversation_id") == [("edge",), ("never",)]


def test_rank_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 5.0), ("b", 9.0), ("c", 9.0), ("d", 5.0), ("e", None)], "d string, v double")
    assert rows(days_of_rank(df, "v", 1), "d") == [("b",), ("c",)]
    assert rows(days_of_rank(df, "v", 3), "d") == [("a",), ("b",), ("c",), ("d",)]


def test_whole_numbers_and_decimals_are_exact(spark):
    big = 1 << 53
    assert verdict(spark, [("x", big + 1)], [("x", big)], "a string, b long")[0] == "BAD"
    assert verdict(spark, [("x", big + 1)], [("x", big + 1)], "a string, b long")[0] == "GOOD"
    decimal = lambda *values: spark.sql(f"SELECT * FROM VALUES {', '.join(f'({v})' for v in values)} AS t(v)")
    same = lambda a, b: compare.compare_results(a, b).first().verdict
    wide = "CAST('12345678901234567890.0000000001' AS DECIMAL(38,10))"
    assert same(decimal(wide), decimal("CAST('12345678901234567890.0000000002' AS DECIMAL(38,10))")) == "BAD"
    assert same(decimal(wide), decimal(wide)) == "GOOD"
    assert same(decimal("CAST(1.50 AS DECIMAL(10,2))", "CAST(0 AS DECIMAL(10,2))"), decimal("CAST(1.5 AS DECIMAL(20,9))", "CAST(0 AS DECIMAL(20,9))")) == "GOOD"
    assert same(decimal("CAST(7 AS DECIMAL(10,2))"), decimal("7L")) == "GOOD"
    assert same(decimal("CAST(100 AS DECIMAL(10,0))"), decimal("CAST(100 AS DECIMAL(12,2))")) == "GOOD"
    assert same(decimal("CAST(0.1 AS DECIMAL(10,1))"), decimal("0.1D")) == "GOOD"


def test_an_edge_of_rounding_is_no_difference(spark):
    edge = 0.0000005
    left = [("x", 1 + edge), ("x", 1 + edge), ("y", -2.0), ("z", None), ("w", float("nan"))]
    moved = [("x", 1 + edge - 1e-12), ("x", 1 + edge + 1e-12), ("y", -2.0), ("z", None), ("w", float("nan"))]
    assert verdict(spark, left, moved) == ("GOOD", 0, 0)
    assert verdict(spark, left, [("x", 1 + 3e-6), *moved[1:]]) == ("BAD", 1, 1)
    assert verdict(spark, left, [*moved[1:], ("z", 0.0)])[0] == "BAD"
    assert verdict(spark, [("x", 1.0)], [("x", 1.0009)], tolerance=1e-3) == ("GOOD", 0, 0)
    assert verdict(spark, [("x", 1.0)], [("y", 1.0)], tolerance=1e-3)[0] == "BAD"
    # counts of near rows must agree as well
    assert verdict(spark, [("x", 1 + edge)], [("x", 1 + edge - 1e-12)] * 2)[0] == "BAD"


def test_near_values_in_several_columns(spark):
    edge = 0.0000005
    left = [(i, i + edge, -i - edge) for i in range(50)]
    moved = [(i, i + edge + (-1) ** i * 1e-11, -i - edge + (-1) ** i * 1e-11) for i in range(50)]
    schema = "k int, x double, y double"
    assert verdict(spark, left, moved, schema) == ("GOOD", 0, 0)
    assert verdict(spark, left, [(k, x, y) for y, x, k in [(a, b, c) for c, b, a in moved]], schema, "p int, q double, r double") == ("GOOD", 0, 0)
    crossed = [(i, moved[i][1], moved[(i + 1) % 50][2]) for i in range(50)]
    assert verdict(spark, left, crossed, schema) == ("BAD", 50, 50)
    assert verdict(spark, [(1, 1e300, float("inf"))], [(1, 1e300, float("inf"))], schema)[0] == "GOOD"
    assert verdict(spark, [(1, 1e25, 0.0)], [(1, 2e25, 0.0)], schema)[0] == "BAD"


def test_comparison_leaves_nothing_on_disk(spark, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before, settings = set(shared.glob("*")), spark.conf.getAll
    source = str(tmp_path / "in")
    spark.range(1000).selectExpr("id", "id % 10 AS g", "id + 5e-7 AS x").write.parquet(source)
    files = spark.read.parquet(source)
    summed = files.groupBy("g").agg(F.sum("x").alias("x"))
    assert compare._reads_again(files.where("id > 5")) and not compare._reads_again(summed)
    assert not compare._reads_again(files.withColumn("t", F.current_timestamp())) and not compare._reads_again(files.withColumn("t", F.rand()))
    for frame in (files, summed):
        moved = frame.withColumn("x", F.col("x") - 1e-9)
        result = compare.compare_results(frame, moved)
        assert tuple(result.first())[:5] == ("GOOD", frame.count(), frame.count(), 0, 0)
    assert set(shared.glob("*")) == before and spark.conf.getAll == settings


def test_near_values_beyond_the_border_of_a_cell(spark):
    """Values on both sides of every border between cells of the search, in one column and in two."""
    step = 5e-7
    spots = [k * compare.CELL * 2 * step + step * shift for k in range(-3, 4) for shift in range(-20, 21)]
    left = [(i, v + 0.4 * step) for i, v in enumerate(spots)]
    right = [(i, v + 1.3 * step) for i, v in left]
    assert verdict(spark, left, [(i, v - 0.45 * step) for i, v in right], "k int, x double") == ("GOOD", 0, 0)
    pairs = [(i, v, 1e6 - v) for i, v in left]
    near = [(i, v + 0.9 * step, w + 0.9 * step) for i, v, w in pairs]
    assert verdict(spark, pairs, near, "k int, x double, y double") == ("GOOD", 0, 0)
    far = verdict(spark, pairs, [(i, v + 3 * step, w) for i, v, w in pairs], "k int, x double, y double")
    assert far == ("BAD", len(spots), len(spots))


def test_numbers_meet_texts(spark):
    assert verdict(spark, [("x", 7)], [("x", "7")], "a string, b int", "a string, b string") == ("GOOD", 0, 0)
    assert verdict(spark, [("x", 1.5)], [("x", "1.5")], "a string, b double", "a string, b string") == ("GOOD", 0, 0)
    assert verdict(spark, [("x", 7.25)], [("x", "7.26")], "a string, b double", "a string, b string") == ("BAD", 1, 1)
