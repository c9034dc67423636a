"""Result comparison and scoring of evaluation runs."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.session import scratch, shuffles_dropped

# Fixed value: beyond this many rows the reference scorer no longer sees the whole answer.
ROW_CAP = 5_000

VERDICT = "verdict STRING NOT NULL, expected_rows BIGINT, actual_rows BIGINT, missing_rows BIGINT, extra_rows BIGINT, over_cap BOOLEAN NOT NULL"

ASSESSMENTS = ("GOOD", "BAD", "NEEDS_REVIEW")

RUN_RESULTS = """
    space_id STRING, eval_run_id STRING, eval_run_status STRING, created_timestamp BIGINT,
    num_questions INT, num_correct INT, num_needs_review INT,
    results ARRAY<STRUCT<
        result_id: STRING, benchmark_question_id: STRING, question: STRING, status: STRING,
        assessment: STRING, manual_assessment: BOOLEAN, generated_sql: STRING>>
"""


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
EXACT = (*WHOLE, T.DecimalType)
FLOATING = (T.DoubleType, T.FloatType)


def _exact(column: Column, kind: T.DataType) -> Column:
    """Whole numbers and decimals as text without loss; 1 and 1.00 are one number."""
    text = column.cast("string")
    if isinstance(kind, T.DecimalType) and kind.scale:
        text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(column == 0, "0").otherwise(text)


def _on_grid(column: Column, kind: T.DataType, decimals: int) -> Column:
    """A number as the double nearest to it on a grid of ``decimals``. Numbers have the same ``_rounded`` text if and only if they have the same one."""
    value = column.cast("double")
    return (value if isinstance(kind, WHOLE) else F.round(value, decimals)) + F.lit(0.0)


def _rounded(column: Column, kind: T.DataType, decimals: int) -> Column:
    """Floating numbers on a grid of ``decimals``, in the text that an exact number of that value has."""
    value = _on_grid(column, kind, decimals)
    wide = F.abs(value) < 10.0 ** (34 - decimals)
    digits = F.when(wide, value).try_cast(f"decimal(38,{decimals})")
    return F.coalesce(_exact(digits, T.DecimalType(38, decimals)), value.cast("string"))


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, (*EXACT, *FLOATING))


def _forms(df: DataFrame) -> DataFrame:
    """Columns by position: ``x<i>``, a number as it is, or ``c<i>``, anything else as text."""
    columns = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if _numeric(f.dataType):
            columns.append(c.alias(f"x{i}"))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            columns.append(F.to_json(c).alias(f"c{i}"))
        else:
            columns.append(c.cast("string").alias(f"c{i}"))
    return df.select(*columns)


class _Result:
    """A result to compare: its columns by position and what one pass over its rows tells of them."""

    def __init__(self, rows: DataFrame, decimals: int):
        self.rows = rows
        self.decimals = decimals
        self.kinds = [f.dataType for f in rows.schema.fields]
        self.numbers = [i for i, kind in enumerate(self.kinds) if _numeric(kind)]
        self.count, self.sums, self.moments = 0, [], {}

    def floating(self, i: int) -> bool:
        return isinstance(self.kinds[i], FLOATING)

    def number(self, i: int) -> Column:
        return F.col(f"x{i}").cast("double")

    def grid(self, i: int) -> Column:
        return _on_grid(F.col(f"x{i}"), self.kinds[i], self.decimals)

    def text(self, i: int) -> Column:
        return _rounded(F.col(f"x{i}"), self.kinds[i], self.decimals) if i in self.numbers else F.col(f"c{i}")

    def exact(self, i: int) -> Column:
        return _exact(F.col(f"x{i}"), self.kinds[i])

    def form(self, i: int, as_text: bool) -> Column:
        """What column ``i`` is compared by: the text, or for numbers that meet numbers only the place on the grid."""
        return self.text(i) if as_text or i not in self.numbers else self.grid(i)

    def measure(self, as_text: bool) -> None:
        """Rows, an order-free checksum of each column, and of numeric ones count, sum and greatest size, which a difference within the
        tolerance hardly moves: one row to the driver, whatever the result's size."""
        known = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
        parts = [f(self.number(i)) for i in self.numbers for f in (F.count, lambda c: F.sum(known(c)), lambda c: F.max(F.abs(known(c))))]
        forms = [_checksum([self.form(i, as_text)]) for i in range(len(self.kinds))]
        self.count, *found = self.rows.agg(F.count(F.lit(1)), *[c.alias(f"f{k}") for k, c in enumerate([*forms, *parts])]).first()
        self.sums = found[: len(forms)]
        self.moments = {i: tuple(found[len(forms) + 3 * k :][:3]) for k, i in enumerate(self.numbers)}


def _checksum(columns: Sequence[Column]) -> Column:
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def _checksums(result: _Result, groups: Sequence[Sequence[int]], as_text: bool) -> list:
    """Order-free checksum of each group of columns."""
    sums = [_checksum([result.form(i, as_text) for i in group]).alias(f"s{k}") for k, group in enumerate(groups)]
    return list(result.rows.agg(*sums).first())


def _close(a: tuple, b: tuple, tolerance: float) -> bool:
    (n, sum_a, top_a), (m, sum_b, top_b) = a, b
    if n != m or (sum_a is None) != (sum_b is None):
        return False
    return sum_a is None or abs(sum_a - sum_b) <= n * (tolerance + 1e-12 * max(top_a, top_b))


def _copies(result: _Result, columns: Sequence[int], as_text: bool) -> set[tuple[int, int]]:
    """Pairs of columns that agree in every row."""
    pairs = list(combinations(columns, 2))
    if not pairs:
        return set()
    mixed = lambda a, b: as_text or (a in result.numbers) != (b in result.numbers)
    same = [result.form(a, mixed(a, b)).eqNullSafe(result.form(b, mixed(a, b))) for a, b in pairs]
    differ = [F.count_if(~s).alias(f"d{i}") for i, s in enumerate(same)]
    return {pair for pair, n in zip(pairs, result.rows.agg(*differ).first(), strict=True) if not n}


def _fits(expected: _Result, actual: _Result, tolerance: float) -> tuple[list[list[int]], list[list[int]]]:
    """For each expected column the actual ones that may be it, and among them those that agree in every text."""
    equal = [[i for i, found in enumerate(actual.sums) if found == wanted] for wanted in expected.sums]
    near: dict[int, list[int]] = {}
    if any(not equal[n] for n in expected.numbers):
        either = lambda n, i: expected.floating(n) or actual.floating(i)
        near = {n: [i for i in actual.numbers if either(n, i) and _close(expected.moments[n], actual.moments[i], tolerance)] for n in expected.numbers}
    return [own or near.get(n, []) for n, own in enumerate(equal)], equal


def _match_columns(expected: _Result, actual: _Result, names: Sequence[str], found_names: Sequence[str], tolerance: float) -> list[int] | None:
    """Position in ``actual`` of each expected column, so that whole rows agree if they can.

    Columns of equal content are candidates; a floating column that has no equal takes those whose count and sum agree within the
    tolerance. Where a column has several, the columns of equal content matched so far are compared
    together with each, as rows, and only assignments that still agree go on. Columns that agree in every row are
    interchangeable and tried in one order. Among what remains, most equal names wins.
    """
    # a number may stand against a text, which only its own text equals
    as_text = any(len(side.numbers) < len(side.kinds) for side in (expected, actual))
    expected.measure(as_text)
    actual.measure(as_text)
    fits, equal = _fits(expected, actual, tolerance)
    if not all(fits):
        return None
    copies = _copies(actual, sorted({i for options in fits if len(options) > 1 for i in options}), as_text)
    assignments: list[tuple[int, ...]] = [()]
    for n, options in enumerate(fits):
        grown = [
            (*chosen, i)
            for chosen in assignments
            for i in options
            if i not in chosen and not any((j, i) in copies and j not in chosen for j in options if j < i)
        ]
        if len(grown) > 1:
            sure = [m for m in range(n + 1) if equal[m]]
            [want] = _checksums(expected, [sure], as_text) if sure else [None]
            got = _checksums(actual, [[chosen[m] for m in sure] for chosen in grown], as_text) if sure else [None] * len(grown)
            grown = [chosen for chosen, p in zip(grown, got, strict=True) if p == want]
        if not grown:
            return None
        assignments = grown
    named = lambda chosen: sum(found_names[i].lower() == name.lower() for i, name in zip(chosen, names, strict=True))
    return list(max(assignments, key=named))


# Steps that read files again as cheaply as they would read a written copy, and with the same rows.
_NARROW = ("Project", "Filter", "LogicalRelation", "Union", "LocalRelation", "Range")


def _reads_again(df: DataFrame) -> bool:
    """Whether a result is files read, filtered and projected, without randomness, the time of day, subqueries or Python."""
    if not hasattr(df, "_jdf"):
        return False
    steps = df._jdf.queryExecution()
    time_of_day = df.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern.CURRENT_LIKE()
    if steps.analyzed().containsPattern(time_of_day):
        return False
    plans = [steps.optimizedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        files = kind != "LogicalRelation" or plan.relation().getClass().getSimpleName() == "HadoopFsRelation"
        if kind not in _NARROW or not files or not plan.deterministic() or not plan.subqueries().isEmpty():
            return False
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return True


def _aligned(left: _Result, right: _Result, order: Sequence[int]) -> tuple[DataFrame, list[str], list[str]]:
    """Both sides under one set of columns: their union with ``side``, the key columns and the floating ones.

    Keys stay as narrow as they exactly can: a whole number is no text, and a floating one is its place on the grid.
    """
    ours, theirs, keys, floats = [], [], [], []
    for n in range(len(left.kinds)):
        i = order[n] if n < len(order) else None
        if i is None:  # nothing to compare with: no value equals this text
            pair = left.text(n), F.lit("\u0000absent")
        elif n not in left.numbers or i not in right.numbers:
            pair = left.text(n), right.text(i)
        elif left.floating(n) or right.floating(i):
            pair = left.grid(n), right.grid(i)
            ours.append(left.number(n).alias(f"v{n}"))
            theirs.append(right.number(i).alias(f"v{n}"))
            floats.append(f"v{n}")
        elif isinstance(left.kinds[n], WHOLE) and isinstance(right.kinds[i], WHOLE):
            pair = F.col(f"x{n}").cast("bigint"), F.col(f"x{i}").cast("bigint")
        elif left.kinds[n] == right.kinds[i]:
            pair = F.col(f"x{n}"), F.col(f"x{i}")
        else:
            pair = left.exact(n), right.exact(i)
        ours.append(pair[0].alias(f"c{n}"))
        theirs.append(pair[1].alias(f"c{n}"))
        keys.append(f"c{n}")
    one = F.lit(1).cast("bigint")
    both = left.rows.select(*ours, one.alias("side")).unionByName(right.rows.select(*theirs, (-one).alias("side")))
    return both, keys, floats


# A cell is so many times as wide as values near to each other can lie apart: few rows are near a border and looked for beyond it.
CELL = 16


def _within_tolerance(surplus: DataFrame, keys: Sequence[str], floats: Sequence[str], tolerance: float) -> DataFrame:
    """Rows that have no equal, gathered with those that differ from them by no more than the tolerance in floating columns.

    Each floating value has a step of the tolerance's width, so near values are in the same or the next step, and the sums of a row's
    steps differ by no more than the number of columns. Rows meet by their other columns and the cell of this sum, those near the border of a cell
    in the one beyond as well; then the values themselves decide. A row takes the least values on the grid among the rows near it as its name, which is
    the same for rows that are all near to each other. Rows cross the shuffle once: both sides of the join read the same one.
    """
    known = lambda c: ~F.isnan(c) & (F.abs(c) < 1e20)
    number = {c: F.when(known(F.col(c)), F.col(c)) for c in floats}
    grid = [f"c{c[1:]}" for c in floats]
    exact = [k for k in keys if k not in grid]
    # what has no place on a grid (null, NaN, infinite, very large) must agree as text
    odd = [F.when(number[c].isNull(), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in floats]
    steps = [F.coalesce(F.floor((number[c] / tolerance).cast("decimal(38,6)")).cast("decimal(36,0)"), F.lit(0)) for c in floats]
    apart = len(floats) + 1
    width = CELL * apart
    # numbers that people write fall on whole steps; half a cell keeps them off its borders
    total = (functools.reduce(lambda a, b: a + b, steps) + width // 2).cast("decimal(36,0)")
    cell = F.floor(total / width).cast("decimal(36,0)")
    rows = surplus.select(*floats, *grid, "n", F.xxhash64(*exact, *odd).alias("same"), cell.alias("cell"), (total - cell * width).cast("int").alias("at"))
    # equal places are what counts, so a number may start over
    place = lambda step: ((F.col("cell") + step) % 10**15).cast("bigint")
    beyond = F.when(F.col("at") < apart, place(-1)).when(F.col("at") >= width - apart, place(1))
    places = F.array_compact(F.array(place(0), beyond))
    spread = rows.select(*floats, *grid, "n", "same", F.posexplode(places).alias("guest", "place"))
    a, b = spread.alias("a"), spread.alias("b")
    near = (F.col("a.same") == F.col("b.same")) & (F.col("a.place") == F.col("b.place"))
    for c in floats:
        x, y = (F.when(known(F.col(f"{side}.{c}")), F.col(f"{side}.{c}")) for side in "ab")
        near &= F.coalesce(F.abs(x - y) <= tolerance, F.lit(True))
    # the columns that only one side needs are named on both, so that both read one shuffle
    least = F.min(F.struct(*[F.col(f"b.{c}").alias(c) for c in grid], "b.n", "b.guest"))
    named = a.join(b, near).groupBy("a.same", "a.place", *[f"a.{c}" for c in grid])
    named = named.agg(least.alias("least"), F.first("a.n").alias("n"), F.first("a.guest").alias("guest")).where("guest = 0")
    names = ["same", *[f"as{i}" for i in range(len(grid))]]
    named = named.select("same", "place", *[F.col("least")[c].alias(f"as{i}") for i, c in enumerate(grid)], "n")
    # what cancels out where it lies is not shuffled
    met = named.groupBy("same", "place", *names[1:]).agg(F.sum("n").alias("n")).where("n <> 0")
    return met.groupBy(*names).agg(F.sum("n").alias("n"))


# Rows of the two sides that a task holds in a hash table, and the bytes they take in a shuffle at most.
ROWS_PER_TASK, BYTES_PER_TASK = 1_000_000, 16 * 1024**2


def compare_results(expected: DataFrame, actual: DataFrame, decimals: int = 6, row_cap: int = ROW_CAP, tolerance: float | None = None) -> DataFrame:
    """Compare two results as multisets of rows: one row with verdict and counts.

    Order and column names do not matter, further columns of ``actual`` are ignored, row counts must
    agree. Whole numbers and decimals are compared exactly. Where one side is floating, values agree if they round alike to ``decimals`` or differ by
    at most ``tolerance`` (half a unit of the last decimal), so a value on the edge of rounding is no difference. Copies of a row are counted
    before the two sides meet, so a row repeated a million times is one row in the shuffle, and only rows without an equal
    look for near ones. ``over_cap`` only tells that a capped scorer would not have seen all.

    The verdict is reached here and not when the row is read, so that nothing of the comparison stays on disk: a result that takes more than reading files is
    computed once and compared from its written copy, which goes afterwards, and so do the shuffles.
    """
    spark = expected.sparkSession
    tolerance = tolerance if tolerance is not None else 0.5 * 10.0**-decimals
    with scratch(spark) as stored, shuffles_dropped(spark, ROWS_PER_TASK, BYTES_PER_TASK) as expect_rows:
        left, right = (
            _Result(forms if _reads_again(forms) else stored(forms, name), decimals)
            for name, forms in (("expected", _forms(expected)), ("actual", _forms(actual)))
        )
        order = _match_columns(left, right, expected.columns, actual.columns, tolerance)
        if order is None:  # no column assignment fits: line up by position and let the rows tell
            order = list(range(min(len(expected.columns), len(actual.columns))))
        expect_rows(left.count + right.count)
        sides, keys, floats = _aligned(left, right, order)
        counted = sides.groupBy(*keys).agg(F.sum("side").alias("n"), *(F.min(c).alias(c) for c in floats))
        surplus = counted.where("n <> 0")
        left_over = _within_tolerance(surplus, keys, floats, tolerance) if floats else surplus
        zero = F.lit(0).cast("long")
        missing, extra = left_over.agg(*(F.coalesce(F.sum(F.greatest(n, zero)), zero) for n in (F.col("n"), -F.col("n")))).first()
    verdict = "BAD" if missing or extra else "GOOD"
    over = max(left.count, right.count) > row_cap
    return spark.createDataFrame([(verdict, left.count, right.count, missing, extra, over)], VERDICT)


def run_results(raw: DataFrame, column: str = "raw_json") -> DataFrame:
    """One row per question of each stored run."""
    run = raw.select(F.from_json(column, RUN_RESULTS).alias("run")).select("run.*")
    return run.select("space_id", "eval_run_id", "created_timestamp", F.inline("results"))


def score_run(results: DataFrame, run_key: str = "eval_run_id") -> DataFrame:
    """Questions, correct ones and ones to review, by run."""
    of = F.col("assessment")
    return results.groupBy(run_key).agg(
        F.count(F.lit(1)).alias("num_questions"),
        F.count_if(of == "GOOD").alias("num_correct"),
        F.count_if(of == "NEEDS_REVIEW").alias("num_needs_review"),
        F.count_if(of == "BAD").alias("num_wrong"),
    )


def score_delta(before: DataFrame, after: DataFrame, question: str = "benchmark_question_id") -> DataFrame:
    """How assessments moved between two runs: a row per (before, after) pair with its direction."""
    rank = {"BAD": 0, "NEEDS_REVIEW": 1, "GOOD": 2}
    level = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    pairs = before.select(question, F.col("assessment").alias("before")).join(
        after.select(question, F.col("assessment").alias("after")), question, "full"
    )
    moved = F.try_element_at(level, "after") - F.try_element_at(level, "before")
    counts = pairs.groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))
    direction = F.when(moved > 0, "up").when(moved < 0, "down").when(moved == 0, "same").otherwise("unmatched")
    return counts.withColumn("direction", direction)
