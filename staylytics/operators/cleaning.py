"""Booking cleaning steps. Each step is ``DataFrame -> DataFrame`` and narrow unless stated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions.keys import lookup
from staylytics.operators.ordering import exact_quantile
from staylytics.session import options, settle

RATE = "adr_cents"
_SPACE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE))


def dedupe_full_row(df: DataFrame) -> DataFrame:
    """Keep one of each group of identical rows (NULLs equal); copies collapse map-side before the shuffle."""
    return df.dropDuplicates(df.columns)


def replace_undefined_with_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("Undefined")) for c in C.SENTINEL_COLUMNS})


def impute_constants(df: DataFrame) -> DataFrame:
    return df.na.fill({"children": 0, "country": "UNK"})


def fix_country_code(df: DataFrame) -> DataFrame:
    return df.na.replace({"CN": "CHN"}, subset=["country"])


def drop_negative_rates(df: DataFrame) -> DataFrame:
    return df.where(F.col(RATE) >= 0)


def winsorize_rates(df: DataFrame, q: float = 0.995) -> DataFrame:
    """Cap rates at the exact q-quantile of the given rows; the cap is a one-row scalar subquery."""
    cap = exact_quantile(df, RATE, q).scalar()
    return df.withColumn("winsor_cap", cap).withColumn(
        "adr", F.least(F.col(RATE).cast("double"), F.col("winsor_cap")) / 100
    )


def flag_adults_outliers(df: DataFrame, threshold: int = 10) -> DataFrame:
    return df.withColumn("is_adults_outlier", F.coalesce(F.col("adults") > threshold, F.lit(False)))


def cancellation_mismatch() -> Column:
    """Status and flag disagree; a NULL on either side counts as 'not canceled'."""
    status = F.coalesce(F.col("reservation_status") == "Canceled", F.lit(False))
    flag = F.coalesce(F.col("is_canceled") == 1, F.lit(False))
    return status != flag


def normalize_categoricals(df: DataFrame) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in C.CATEGORICAL_COLUMNS})


def _whole(c: str, low: int | Column, high: int | Column) -> Column:
    """The number in a column whose text is that number between ``low`` and ``high`` and nothing else."""
    number = F.col(c).try_cast("int")
    exact = F.typeof(c).isin("int", "bigint") | (number.cast("string") == F.col(c).cast("string"))
    return F.when(number.between(low, high) & exact, number)


def _arrival_date() -> Column:
    """The parser costs a row more than all other steps, so days that a month has in every year are put together from their parts."""
    parts = F.concat_ws("-", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month")
    name = F.col("arrival_date_month").cast("string")
    month, days = (F.element_at(lookup(m), name) for m in ({m: i + 1 for i, m in enumerate(C.MONTH_DAYS)}, C.MONTH_DAYS))
    plain = F.make_date(_whole("arrival_date_year", 1000, 9999), month, _whole("arrival_date_day_of_month", 1, days))
    return F.coalesce(plain, F.try_to_date(parts, "yyyy-MMMM-d"))


def _status_date() -> Column:
    """As above: ISO dates are cast, what is left is parsed."""
    text = F.col("reservation_status_date")
    plain = F.when(text.cast("string").rlike(r"\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"), text.cast("string").try_cast("date"))
    return F.coalesce(plain, F.try_to_date(text, "yyyy-MM-dd"))


def build_arrival_date(df: DataFrame) -> DataFrame:
    return df.withColumn("arrival_date", _arrival_date())


def convert_types(df: DataFrame) -> DataFrame:
    """Coercing conversion: what does not parse becomes NULL."""
    ints = {c: F.col(c).try_cast("bigint") for c in C.NULLABLE_INT_COLUMNS}
    return df.withColumns({**ints, "reservation_status_date": _status_date()})


def changed_types(before: DataFrame, after: DataFrame) -> list[str]:
    old = dict(before.dtypes)
    return [n for n, t in after.dtypes if n in old and old[n] != t]


def hits(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def total(conditions: list[Column]) -> Column:
    return F.sum(sum((F.coalesce(c, F.lit(False)).cast("long") for c in conditions), F.lit(0).cast("long")))


class CleanAudit:
    """Counts of the cleaning steps, observed while their rows are written; ``table`` reads them once both writes are done."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.conversions = spark, 0
        self.raw, self.unique, self.final = (Observation(name) for name in ("raw rows", "unique rows", "rated rows"))

    def on_raw(self, df: DataFrame) -> DataFrame:
        return df.observe(self.raw, F.count("*").alias("raw"))

    def on_unique(self, df: DataFrame) -> DataFrame:
        return df.observe(
            self.unique, F.count("*").alias("unique"), total([F.col(c) == "Undefined" for c in C.SENTINEL_COLUMNS]).alias("undefined"),
            hits(F.col("children").isNull()).alias("children"), hits(F.col("country").isNull()).alias("country"), hits(F.col("country") == "CN").alias("cn"),
        )

    def on_rated(self, df: DataFrame) -> DataFrame:
        """Rows behind the rate cap, before categoricals are trimmed."""
        parsed = build_arrival_date(df)
        self.conversions = len(changed_types(parsed, convert_types(parsed)))
        trimmed = [F.col(c) != strip(F.col(c)) for c in C.CATEGORICAL_COLUMNS]
        return df.observe(
            self.final, F.count("*").alias("kept"), hits(F.col(RATE) > F.col("winsor_cap")).alias("capped"), hits(F.col("adults") > 10).alias("outliers"),
            hits(cancellation_mismatch()).alias("mismatch"), total(trimmed).alias("trimmed"), hits(_arrival_date().isNull()).alias("unparseable"),
        )

    def table(self) -> DataFrame:
        """(step_no, step, rows_before, rows_after, values_changed, extra) of the 11 steps."""
        u, k = self.unique.get, self.final.get
        unique, kept = u["unique"], k["kept"]
        raw = self.raw.get["raw"] if unique else 0  # an empty shuffle is planned away, and with it what was to be observed before it
        steps = [
            ("dedupe_full_row", raw, unique, raw - unique, None),
            ("replace_undefined_with_null", unique, unique, u["undefined"] or 0, None),
            ("impute_missing_children", unique, unique, u["children"], None),
            ("impute_missing_country", unique, unique, u["country"], None),
            ("fix_country_code_cn", unique, unique, u["cn"], None),
            ("clean_adr", unique, kept, k["capped"], unique - kept),
            ("flag_adults_outliers", kept, kept, k["outliers"], None),
            ("check_cancellation_consistency", kept, kept, 0, k["mismatch"]),
            ("normalize_categoricals", kept, kept, k["trimmed"] or 0, None),
            ("build_arrival_date", kept, kept, kept, k["unparseable"]),
            ("convert_dtypes", kept, kept, self.conversions, None),
        ]
        schema = "step_no int, step string, rows_before long, rows_after long, values_changed long, extra long"
        return self.spark.createDataFrame([(i + 1, *step) for i, step in enumerate(steps)], schema)


def clean(df: DataFrame, audit: CleanAudit | None = None, parts: int | None = None) -> DataFrame:
    """All steps in order: one shuffle for the dedupe, one small one for the rate cap, the rest fused.

    The deduplicated rows are settled, so that the rate cap reads one column of them and not the whole input again. With
    ``audit`` the steps are counted on the way, without a pass of their own. ``parts``: tasks that the rows are dealt over to
    find copies, where the session's shuffles have fewer.
    """
    unique = dedupe_full_row(audit.on_raw(df) if audit else df)
    with options(df.sparkSession, **({} if parts is None else {"spark__sql__shuffle__partitions": str(parts)})):
        stored = settle(audit.on_unique(unique) if audit else unique)
    rated = (
        stored
        .transform(replace_undefined_with_null)
        .transform(impute_constants)
        .transform(fix_country_code)
        .transform(drop_negative_rates)
        .transform(winsorize_rates)
    )
    return (
        (audit.on_rated(rated) if audit else rated)
        .transform(flag_adults_outliers)
        .transform(normalize_categoricals)
        .transform(build_arrival_date)
        .transform(convert_types)
    )
