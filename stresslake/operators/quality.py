"""Data-quality profile of one table.

NULLs, bad formats and type evidence of all columns come from one pass that reads
each value once. Copies of rows and of keys and the violations of business rules share
a second pass with one exchange, of digests. Results are
DataFrames; the pre-load gate reads one summary row.

Raw drops are profiled as text (see ``sources.readers.read_text_columns``), so the
checks see what is in the file. Typed frames work too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresslake.functions.columns import (
    FRACTION, MIDNIGHT, WHOLE, WORDS, as_number, as_timestamp, literal_frame, percent, text_kind,
    total,
)
from stresslake.operators.cleaning import missing_columns, run_date
from stresslake.operators.validate import null_counts
from stresslake.specs import TableSpec, spec_for

# Report limits, grades and texts.
GOOD, ATTENTION, POOR = "GOOD", "NEEDS ATTENTION", "POOR"
GOOD_FROM, ATTENTION_FROM = 95.0, 85.0
PROCEED = "Proceed to ingestion"
REPAIR = "Fix schema / validity issues and deduplicate before ingestion"
NO_ISSUES = "No major issues detected"


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number; decimals and integers keep their exact type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return _ref(name)
    return as_number(_ref(name).cast("string"))


def _timestamp(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _ref(name).cast("timestamp")
    return as_timestamp(_ref(name).cast("string"))


# --- NULLs and duplicates -------------------------------------------------------


def null_metrics(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column."""
    rows = F.count(F.lit(1)).alias("_rows")
    nulls = [_count(_ref(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    per_column = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_n{i}").alias("null_count"),
            percent(F.col(f"_n{i}"), F.col("_rows")).alias("null_pct"),
        )
        for i, c in enumerate(df.columns)
    ])
    return df.agg(rows, *nulls).select(F.inline(per_column))


def worst_null_column(df: DataFrame) -> DataFrame:
    """The column with most NULLs; the first in schema order on a tie."""
    return (
        null_counts(df).orderBy(F.desc("null_count"), "position").limit(1)
        .select("column_name", "null_count")
    )


def _digest(columns: list[Column], names: tuple[str, str]) -> list[Column]:
    """128 bits that stand for a row of values: two hashes with different seeds.

    The hash leaves NULLs out, so a flag per column tells where they are.
    """
    flags = [c.isNull() for c in columns]
    return [
        F.xxhash64(*columns, *flags).alias(names[0]), F.xxhash64(F.lit(1), *columns, *flags).alias(names[1]),
    ]


def _surplus(groups: DataFrame) -> DataFrame:
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def _copies_of(df: DataFrame, columns: list[str], suspects: DataFrame) -> DataFrame:
    """Rows beyond the first of each group, compared value by value.

    Only rows whose digest (``_1``, ``_2``) occurs more than once are looked at.
    """
    own = [_ref(c) for c in columns]
    digests = dict(zip(("_1", "_2"), _digest(own, ("_1", "_2")), strict=True))
    rows = df.select(*own, *digests.values()).join(suspects, ["_1", "_2"], "left_semi")
    return _surplus(rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n")))


def surplus_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows beyond the first of each group of equal values in ``columns`` (default all).

    Digests are counted, and travel, in place of the rows; where one occurs more than
    once, its rows are compared value by value.
    """
    names = list(columns) or df.columns
    groups = df.select(*_digest([_ref(c) for c in names], ("_1", "_2"))).groupBy("_1", "_2").agg(
        F.count(F.lit(1)).alias("_n")
    )
    total_rows = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.lit(0).alias("surplus_rows"))
    copies = _copies_of(df, names, groups.where("_n > 1")).withColumn("total_rows", F.lit(0))
    return total_rows.unionByName(copies).agg(
        F.sum("total_rows").alias("total_rows"), F.sum("surplus_rows").alias("surplus_rows")
    )


def _copies_and_violations(
    df: DataFrame, spec: TableSpec, key: tuple[str, ...], rules: list[Rule], exact: bool
) -> DataFrame:
    """Row copies, key copies and rule violations of a table as one row.

    Rows travel as digests of the row and of its key and the number of rules they break,
    counted before the exchange; the table is read once. With ``exact`` rows and keys
    whose digest is repeated are read again and compared value by value. Without it two
    different rows would have to agree in 128 bits of hash to count as copies.
    """
    label, zero = F.lit(spec.name).alias("table_name"), F.lit(0).cast("bigint")
    has_key = not missing_columns(df, key)
    key_digest = _digest([_ref(c) for c in key], ("k1", "k2")) if has_key else []
    broken = total([F.when(r.violated, 1).otherwise(0).cast("bigint") for r in rules]).alias("broken")
    digests = df.select(*_digest([_ref(c) for c in df.columns], ("_1", "_2")), *key_digest, broken)
    groups = digests.groupBy(*digests.columns).agg(F.count(F.lit(1)).alias("_n"))

    def part(copies: Column = zero, keys: Column = zero, rows: Column = zero, violations: Column = zero) -> list[Column]:
        return [label, rows.alias("total_rows"), copies.alias("_copies"), keys.alias("_keys"),
                violations.alias("rule_violations")]

    sums = {"_n": F.sum("_n"), "surplus_rows": F.sum(F.col("_n") - 1), "broken": F.sum(F.col("_n") * F.col("broken"))}
    # Keys are counted over the groups of rows, so one chain of exchanges serves both.
    by = ["k1", "k2"] if has_key and not exact else []
    by_key = groups.groupBy(*by).agg(*[s.alias(c) for c, s in sums.items()])
    counted = by_key.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in sums],
        F.coalesce(F.sum(F.col("_n") - 1), zero).alias("surplus_keys"),
    )
    own, own_keys = (zero, zero) if exact else (F.col("surplus_rows"), F.col("surplus_keys"))
    parts = [counted.select(part(own, own_keys if by else zero, F.col("_n"), F.col("broken")))]
    if exact:
        copies = _copies_of(df, df.columns, groups.where("_n > 1"))
        parts.append(copies.select(part(copies=F.col("surplus_rows"))))
        if has_key:
            suspects = groups.groupBy(F.col("k1").alias("_1"), F.col("k2").alias("_2")).agg(sums["_n"].alias("_n"))
            keys = _copies_of(df, list(key), suspects.where("_n > 1"))
            parts.append(keys.select(part(keys=F.col("surplus_rows"))))
    return (
        reduce(DataFrame.unionByName, parts).groupBy("table_name")
        .agg(*[F.sum(c).alias(c) for c in ("total_rows", "_copies", "_keys", "rule_violations")])
        .select(
            "table_name", "total_rows",
            F.col("_copies").alias("duplicate_rows"),
            percent(F.col("_copies"), F.col("total_rows")).alias("duplicate_pct"),
            F.col("_keys").alias("pk_duplicate_count"),
            "rule_violations",
        )
    )


def duplicate_metrics(
    df: DataFrame, table: str | TableSpec, key: tuple[str, ...] = (), exact: bool = True
) -> DataFrame:
    """Surplus rows, their percentage, and surplus rows by primary key.

    ``exact`` compares rows with equal digests value by value, in a further scan.
    """
    spec = spec_for(table)
    return _copies_and_violations(df, spec, key or spec.key, [], exact).drop("rule_violations")


# --- one-pass counts ------------------------------------------------------------


def _declared(dtype: T.DataType) -> str:
    """Semantic type that a column's declared type settles, or ``text``."""
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, T.NumericType):
        return "float"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "date" if isinstance(dtype, T.DateType) else "text"


def _column_list(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Found and expected columns as rows, in schema order, missing ones last."""
    names = [*df.columns, *missing_columns(df, expected)]
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(_declared(df.schema[c].dataType) if c in df.columns else None)
            .cast("string").alias("declared"),
            F.lit(expected.get(c)).cast("string").alias("expected_type"),
        )
        for i, c in enumerate(names)
    ]
    return literal_frame(df.sparkSession, F.array(*rows))


def describe_columns(df: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    """One row per column: NULLs, values, what the values read as, semantic type.

    The columns are stacked into (position, value) rows inside the task, each value is
    read once, and rows are counted per position and kind before the exchange. One small
    expression thus serves any number of columns. ``expected`` adds registry
    columns that the frame lacks; their ``declared`` is NULL.
    """
    value = F.array(*[
        _ref(c).cast("string") if _declared(df.schema[c].dataType) == "text"
        else F.when(_ref(c).isNotNull(), F.lit(""))
        for c in df.columns
    ])
    kind, n = F.col("kind"), F.col("_n")

    def held(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    counts = (
        df.select(F.posexplode(value).alias("position", "v"))
        .groupBy("position", text_kind(F.col("v")).alias("kind"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("position")
        .agg(
            held(kind.isNull()).alias("null_count"),
            held(kind.isNotNull()).alias("filled"),
            held(kind == WHOLE).alias("whole"),
            held(kind.isin(WHOLE, FRACTION)).alias("number"),
            held(kind == MIDNIGHT).alias("midnight"),
            held(kind == WORDS).alias("words"),
        )
    )
    # The list leads, so that columns of an empty table are described too.
    joined = _column_list(df, expected or {}).join(counts, "position", "left")
    zero = F.lit(0).cast("bigint")
    filled = joined.select(
        "position", "column_name", "declared", "expected_type",
        *[F.coalesce(c, zero).alias(c) for c in counts.columns if c != "position"],
    )
    return filled.withColumn("semantic_type", _semantic_type())


def _semantic_type() -> Column:
    """Type name from the declared type or, for text, from the counts.

    A text column of whole numbers is ``int`` only without NULLs, and an entirely
    empty one is ``float``: that is how a typed reader of the file would see it.
    """
    declared, filled, number = F.col("declared"), F.col("filled"), F.col("number")
    whole = (F.col("whole") == filled) & (F.col("null_count") == 0)
    all_dates = (number == 0) & (F.col("words") == 0)
    of_text = (
        F.when(filled == 0, "float")
        .when(number == filled, F.when(whole, "int").otherwise("float"))
        .when(all_dates, F.when(F.col("midnight") == filled, "date").otherwise("datetime"))
        .otherwise("string")
    )
    return (
        F.when(declared == "text", of_text)
        .when((declared == "date") & (filled == 0), "unknown")
        .otherwise(declared)
    )


def _accepted(actual: Column, expected: Column) -> Column:
    """``float`` accepts ``int`` and ``datetime`` accepts ``date``."""
    return (
        (actual == expected)
        | ((expected == "float") & (actual == "int"))
        | ((expected == "datetime") & (actual == "date"))
    )


def _issue() -> Column:
    expected, actual = F.col("expected_type"), F.col("semantic_type")
    return (
        F.when(expected.isNull(), "extra")
        .when(F.col("declared").isNull(), "missing")
        .when(_accepted(actual, expected), "ok")
        .otherwise("type_mismatch")
    )


def _invalid_count() -> Column:
    """Values of a text column that do not read as its expected number or date."""
    expected = F.col("expected_type")
    bad = F.when(
        expected.isin("float", "int"), F.col("filled") - F.col("number")
    ).when(expected.isin("date", "datetime"), F.col("number") + F.col("words"))
    return F.when(F.col("declared") == "text", bad)


# Labels of the format checks.
FORMAT_LABELS = {
    "float": "Invalid numeric values",
    "int": "Invalid numeric values",
    "date": "Invalid date format",
    "datetime": "Invalid datetime format",
}


@dataclass(frozen=True)
class Rule:
    """A row-level business rule: where ``violated`` is true the row breaks it."""

    label: str
    violated: Column


def business_rules(df: DataFrame, table: str | TableSpec, as_of: str | None = None) -> list[Rule]:
    """The table's rules whose columns are all present.

    A comparison with a NULL or unreadable value does not count as a violation.
    """
    name = spec_for(table).name

    def num(column: str) -> Column:
        return _number(df, column)

    def money(column: str) -> Column:
        return num(column).try_cast("decimal(38,10)")

    # Labels of the rules.
    catalogue = [
        ("transactions", "Negative transaction amount", ["transaction_amount"],
         lambda: num("transaction_amount") < 0),
        ("transactions", "Future transaction date", ["transaction_date"],
         lambda: _timestamp(df, "transaction_date") > run_date(as_of)),
        ("fx_rates", "FX rate <= 0", ["fx_rate_to_usd"], lambda: num("fx_rate_to_usd") <= 0),
        ("intraday", "Net position mismatch (inflow - outflow)",
         ["inflow_amount", "outflow_amount", "net_position"],
         lambda: F.round(money("inflow_amount") - money("outflow_amount"), 2)
         != F.round(money("net_position"), 2)),
        ("cash", "Available liquidity > closing balance",
         ["opening_balance", "closing_balance", "available_liquidity"],
         lambda: num("available_liquidity") > num("closing_balance")),
        ("loans", "Outstanding balance > loan amount", ["outstanding_balance", "loan_amount"],
         lambda: num("outstanding_balance") > num("loan_amount")),
    ]
    return [
        Rule(label, violated())
        for owner, label, needed, violated in catalogue
        if owner == name and not missing_columns(df, needed)
    ]


def business_rule_checks(
    df: DataFrame, table: str | TableSpec, as_of: str | None = None
) -> DataFrame:
    """Violations per rule with PASS or FAIL."""
    rules = business_rules(df, table, as_of)
    schema = "rule_name string, violations bigint, status string"
    if not rules:
        return df.sparkSession.createDataFrame([], schema)
    one_row = df.agg(*[_count(r.violated).alias(f"_r{i}") for i, r in enumerate(rules)])
    return one_row.select(F.inline(F.array(*[
        F.struct(
            F.lit(r.label).alias("rule_name"),
            F.col(f"_r{i}").alias("violations"),
            F.when(F.col(f"_r{i}") > 0, "FAIL").otherwise("PASS").alias("status"),
        )
        for i, r in enumerate(rules)
    ])))


def semantic_types(df: DataFrame) -> DataFrame:
    """Detected type per column: int, float, date, datetime, string or unknown."""
    return describe_columns(df).select("column_name", "semantic_type")


def schema_check(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Expected and found columns: ``ok``, ``missing``, ``extra`` or ``type_mismatch``."""
    expected = spec_for(table).columns
    known = F.col("expected_type").isNotNull()
    return describe_columns(df, expected).select(
        "column_name", "expected_type",
        F.when(known, F.col("semantic_type")).alias("actual_type"),
        _issue().alias("issue"),
    )


def format_validity(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Values that do not parse, for each number or date column that has values."""
    kinds = spec_for(table).columns
    checked = [c for c in df.columns if kinds.get(c) in FORMAT_LABELS]
    labels = [F.when(F.col("expected_type") == k, v) for k, v in FORMAT_LABELS.items()]
    described = describe_columns(df.select([_ref(c) for c in checked]), {c: kinds[c] for c in checked})
    return described.where("filled > 0").select(
        "column_name", F.coalesce(*labels).alias("check_name"),
        F.coalesce(_invalid_count(), F.lit(0).cast("bigint")).alias("invalid_count"),
    )


# --- column statistics ----------------------------------------------------------


def _fits_exactly(dtype: T.DataType) -> bool:
    """Whether values fit decimal(28,8), in which means are summed without rounding."""
    if isinstance(dtype, T.DecimalType):
        return dtype.scale <= 8 and dtype.precision - dtype.scale <= 20
    return isinstance(dtype, T.IntegralType)


def column_statistics(
    df: DataFrame, max_columns: int | None = None, columns: list[str] | None = None,
    distinct: str = "exact", rsd: float = 0.02,
) -> DataFrame:
    """Range, mean and distinct count of number columns; top value of the others.

    All columns that hold a value, in schema order, or the first ``max_columns`` of
    them. An empty table gives an empty frame. Building the frame runs no job.

    * Counts, extremes and sums of all columns come from one pass that exchanges a row
      per column and task.
    * Values are told apart by 128 bits of hash, counted before the exchange; texts do
      not travel. With ``distinct="sketch"`` the distinct counts of number columns come
      from HyperLogLog sketches of the first pass (relative error ``rsd``), and number
      columns by type do not take part in this exchange at all.
    * The top value is exact. Of the values that occur most often the text is looked up
      by hash in a further pass, which keeps the smallest per task.

    Spellings of one number in a text column (``1``, ``01``) are one value of a numeric
    column. On a tie the smaller text is the top value.
    """
    if distinct not in ("exact", "sketch"):
        raise ValueError(f"unknown way to count distinct values {distinct!r}")
    names = columns or df.columns
    typed = [c for c in names if isinstance(df.schema[c].dataType, T.NumericType)]
    exact = [c for c in names if _fits_exactly(df.schema[c].dataType)]
    place = F.create_map(*[F.lit(x) for i, c in enumerate(names) for x in (c, i)])
    text = df.select([_ref(c).cast("string").alias(c) for c in names])
    stacked = (
        text.unpivot([], [_ref(c) for c in names], "column_name", "v").where(F.col("v").isNotNull())
        .withColumn("number", as_number(F.col("v")))
    )

    number, here = F.col("number"), F.col("column_name")
    # The number itself stands for its spellings; typed numbers have one spelling each.
    value = F.when(here.isin(*typed), F.col("v")).otherwise(F.coalesce(number.cast("string"), F.col("v")))
    whole = F.when(here.isin(*exact), F.col("v").try_cast("decimal(28,8)"))
    sketch = [F.approx_count_distinct(value, rsd).alias("sketched")] if distinct == "sketch" else []
    measured = stacked.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("filled"), F.count(number).alias("numbers"),
        F.min(number).alias("lo"), F.max(number).alias("hi"),
        F.sum(number).alias("plain_sum"), F.sum(whole).alias("whole_sum"), *sketch,
    )

    hashed = stacked.where(~here.isin(*typed)) if distinct == "sketch" else stacked
    # Two hashes of the text, two of the value.
    keys = ["column_name", "t1", "t2", "v1", "v2"]
    spelt = hashed.select(
        here, *_digest([F.col("v")], ("t1", "t2")), *_digest([value], ("v1", "v2"))
    ).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = spelt.groupBy("column_name", "v1", "v2").agg(
        F.count(F.lit(1)).alias("spellings"), F.max("n").alias("n")
    ).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.sum("spellings").alias("spellings"), F.max("n").alias("top_n"),
    )
    known = measured.join(counted, "column_name", "left")

    texts = known.where("numbers < filled").select("column_name", "top_n")
    leaders = spelt.join(texts, "column_name").where("n = top_n").select("column_name", "t1", "t2")
    tops = (
        stacked.select("column_name", "v", *_digest([F.col("v")], ("t1", "t2")))
        .join(leaders, ["column_name", "t1", "t2"], "left_semi")
        .groupBy("column_name").agg(F.min("v").alias("top"))
    )
    numeric = F.col("numbers") == F.col("filled")
    mean = F.coalesce(
        (F.col("whole_sum") / F.col("filled").cast("decimal(20,0)")).cast("double"),
        F.col("plain_sum") / F.col("filled"),
    )
    count = F.coalesce("sketched", "distinct_values") if sketch else F.col("distinct_values")
    rows = known.join(tops, "column_name", "left").select(
        "column_name", F.element_at(place, F.col("column_name")).alias("place"),
        F.when(numeric, "numeric").otherwise("categorical").alias("kind"),
        F.when(numeric, F.round("lo", 4)).alias("min_value"),
        F.when(numeric, F.round("hi", 4)).alias("max_value"),
        F.when(numeric, F.round(mean, 4)).alias("mean_value"),
        F.when(numeric, count).otherwise(F.col("spellings")).alias("distinct_count"),
        F.col("top").alias("top_value"),
        F.when(~numeric, percent(F.col("top_n"), F.col("filled"))).alias("top_pct"),
    )
    # One row per column of the table: numbered among those that hold a value.
    found = rows.withColumn("position", F.row_number().over(W.orderBy("place")) - 1).select(
        "position", "column_name", "kind", "min_value", "max_value", "mean_value", "distinct_count",
        "top_value", "top_pct",
    )
    return found if max_columns is None else found.where(F.col("position") < max_columns)


# --- record count, score and report ---------------------------------------------


def record_count_status(actual: Column, expected: int | None) -> Column:
    """PASS within ``max(5, 5 %)`` of the expected rows; PASS without expectation."""
    if expected is None:
        return F.lit("PASS")
    allowed = max(5, expected * 5 // 100)
    return F.when(F.abs(actual - F.lit(expected)) <= allowed, "PASS").otherwise("FAIL")


def record_count_check(df: DataFrame, expected: int | None = None) -> DataFrame:
    text = "Not enforced" if expected is None else f"~{expected}"
    return df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        F.lit(text).alias("expected_rows"), "actual_rows",
        record_count_status(F.col("actual_rows"), expected).alias("status"),
    )


def quality_score(
    completeness: Column, duplicate_pct: Column, invalid: Column, schema_issues: Column, rows: Column
) -> dict[str, Column]:
    """Completeness, uniqueness, validity, their mean and a grade."""
    uniqueness = F.greatest(F.lit(0.0), F.lit(100.0) - duplicate_pct)
    share = (invalid + schema_issues) / F.greatest(rows, F.lit(1)) * 100.0
    validity = F.greatest(F.lit(0.0), F.lit(100.0) - share)
    score = F.round((completeness + uniqueness + validity) / 3.0, 2)
    grade = F.when(score >= GOOD_FROM, GOOD).when(score >= ATTENTION_FROM, ATTENTION).otherwise(POOR)
    return {
        "completeness": F.round(completeness, 2),
        "uniqueness": F.round(uniqueness, 2),
        "validity": F.round(validity, 2),
        "final_score": score,
        "grade": grade,
    }


def profile_counts(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """NULLs, type mismatches and unreadable values of a table as one row."""
    spec = spec_for(table)
    mismatch = F.when(_issue() == "type_mismatch", F.lit(1)).otherwise(0)
    worst = F.max(F.struct("null_count", (-F.col("position")).alias("p"), "column_name"))
    described = describe_columns(df, spec.columns).where(F.col("declared").isNotNull())
    return described.agg(
        F.sum("null_count").alias("overall_nulls"),
        worst["column_name"].alias("worst_column"),
        F.sum(mismatch).alias("type_mismatches"),
        F.coalesce(F.sum(_invalid_count()), F.lit(0)).alias("invalid_formats"),
    ).select(F.lit(spec.name).alias("table_name"), "*")


def quality_report(
    df: DataFrame, table: str | TableSpec, expected_rows: int | None = None,
    as_of: str | None = None, key: tuple[str, ...] = (),
) -> DataFrame:
    """The whole report of a table as one row.

    Nine pass/fail checks, the score, the major issues and the recommendation.
    """
    spec = spec_for(table)
    key = key or spec.key
    absent = missing_columns(df, spec.columns)
    extra = [c for c in df.columns if c not in spec.columns]
    # One-row results with other columns each, folded into one row.
    parts = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            profile_counts(df, spec),
            _copies_and_violations(df, spec, key, business_rules(df, spec, as_of), exact=False),
        ],
    )
    joined = parts.groupBy("table_name").agg(
        *[F.max(c).alias(c) for c in parts.columns if c != "table_name"]
    )

    cells = F.col("total_rows") * len(df.columns)
    missing_n, extra_n = F.lit(len(absent)), F.lit(len(extra))
    completeness = F.when(
        cells > 0, F.round((1 - F.col("overall_nulls") / cells) * 100.0, 2)
    ).otherwise(F.lit(100.0))
    score = quality_score(
        completeness,
        F.col("duplicate_pct"),
        F.col("invalid_formats") + F.col("rule_violations"),
        missing_n + extra_n + F.col("type_mismatches"),
        F.col("total_rows"),
    )
    count_status = record_count_status(F.col("total_rows"), expected_rows)
    passed = [
        F.col("overall_nulls") == 0,
        F.col("duplicate_rows") == 0,
        F.col("pk_duplicate_count") == 0,
        missing_n == 0,
        extra_n == 0,
        F.col("type_mismatches") == 0,
        F.col("invalid_formats") == 0,
        F.col("rule_violations") == 0,
        count_status == "PASS",
    ]
    passed_n = total([F.when(p, 1).otherwise(0) for p in passed])
    issues = F.concat_ws(
        "; ",
        F.when(F.col("overall_nulls") > 0, F.concat(F.col("worst_column"), F.lit(" has nulls"))),
        F.when(F.col("pk_duplicate_count") > 0, F.lit(f"duplicate {', '.join(key)} found")),
        F.when(missing_n > 0, F.lit(f"missing column(s): {', '.join(absent)}")),
        F.when(extra_n > 0, F.lit(f"extra column(s): {', '.join(extra)}")),
    )
    failed_n = F.lit(len(passed)) - passed_n
    return joined.select(
        "table_name", "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        cells.alias("total_cells"),
        "overall_nulls", "duplicate_rows", "duplicate_pct", "pk_duplicate_count",
        missing_n.alias("missing_columns"), extra_n.alias("extra_columns"),
        "type_mismatches", "invalid_formats", "rule_violations",
        *[c.alias(name) for name, c in score.items()],
        count_status.alias("record_count_status"),
        passed_n.cast("int").alias("passed_checks"),
        failed_n.cast("int").alias("failed_checks"),
        F.when(issues == "", NO_ISSUES).otherwise(issues).alias("major_issues"),
        F.when(failed_n == 0, PROCEED).otherwise(REPAIR).alias("recommendation"),
    )
