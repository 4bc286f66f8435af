"""QA checks over groups, and the clean / issue split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions import flags
from casebind.functions.text import occurs
from casebind.operators.frames import columns_matching, keep_one, quote, union_diagonal
from casebind.operators.history import not_yet_rostered
from casebind.operators.skew import HotKeys, lookup_join

KEY = "submission_number"


def _subtype_code(summary: str, label: str, result: str) -> Column:
    """The result code where it names a subtype of a positive, non-control row; else null.

    As its place among the subtypes: least and greatest numbers are kept in a hash aggregate,
    where those of text would need every task to sort its rows.
    """
    return F.when(
        F.col(summary).contains(S.POSITIVE)
        & ~F.col(label).contains(S.CONTROL_RESULT)
        & F.col(result).isin(S.SUBTYPE_CODES),
        F.array_position(F.array(*map(F.lit, S.SUBTYPE_CODES)), F.col(result)),
    )


def _with_several(df: DataFrame, code: Column) -> DataFrame:
    """Keys with more than one distinct code: their least and greatest code differ."""
    return (
        df.select(KEY, code.alias("code"))
        .groupBy(KEY).agg(F.min("code").alias("low"), F.max("code").alias("high"))
        .filter(F.col("low") != F.col("high"))
    )


def _join_back(df: DataFrame, several: DataFrame, hot: HotKeys | None) -> DataFrame:
    return lookup_join(
        df, several.select(KEY, F.lit(True).alias("qa_multiple_subtypes")), [KEY], "inner", hot)


def multiple_subtypes(df: DataFrame, summary: str = "WDRS_RESULT_SUMMARY",
                      label: str = "TEST_RESULT", result: str = "WDRS_RESULT",
                      hot: HotKeys | None = None) -> DataFrame:
    """All rows of the submissions that are positive for more than one subtype."""
    return _join_back(df, _with_several(df, _subtype_code(summary, label, result)), hot)


def multiple_subtypes_v1(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The earlier rule: any two codes that are neither untyped A nor any B."""
    summary, label, result = (F.col(c) for c in ("WDRS_RESULT_SUMMARY", "TEST_RESULT", "WDRS_RESULT"))
    code = F.when(
        ~(summary.contains("G_POS") & label.contains(S.CONTROL_RESULT))
        & ~occurs(result, "G_FLU_A_D|G_FLU_B") & result.contains("G_"),
        result,
    )
    return _join_back(df, _with_several(df, code), hot)


def subtype_counts(df: DataFrame) -> DataFrame:
    """Submissions with several subtypes and how many, most first."""
    code = _subtype_code("WDRS_RESULT_SUMMARY", "TEST_RESULT", "WDRS_RESULT")
    return (
        df.select(KEY, code.alias("code")).groupBy(KEY)
        .agg(F.countDistinct("code").alias("count")).filter(F.col("count") > 1)
        .orderBy(F.desc("count"), KEY)
    )


def with_history_and_subtypes(df: DataFrame, rostered: DataFrame, hot: HotKeys | None = None,
                              by_date: bool = False) -> DataFrame:
    """Drop rostered submissions and add ``qa_multiple_subtypes``.

    ``by_date`` drops only the rows of a rostered collection date.
    """
    if by_date:
        df, rostered = not_yet_rostered(df, rostered, with_date=True), rostered.limit(0)
    return with_facts(df, submission_facts(df, rostered), hot)


def submission_facts(df: DataFrame, rostered: DataFrame) -> DataFrame:
    """Whether a submission is rostered (``_done``) and has several subtypes, for the submissions
    of which one is true: what keeps any of its rows from being clean.

    A narrow shuffle of the codes. A submission has several subtypes exactly when its least and
    greatest code differ.
    """
    code = _subtype_code("WDRS_RESULT_SUMMARY", "TEST_RESULT", "WDRS_RESULT")
    done = rostered.filter(F.col("CASE_ID").isNotNull()).select(KEY, F.lit(True).alias("done"))
    return (
        union_diagonal(df.select(KEY, code.alias("code")), done)
        .groupBy(KEY)
        .agg(F.max("done").alias("_done"),
             (F.min("code") != F.max("code")).alias("qa_multiple_subtypes"))
        .filter(F.col("_done") | F.col("qa_multiple_subtypes"))
    )


def with_facts(df: DataFrame, facts: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Rows of submissions that are not rostered, with ``qa_multiple_subtypes``.

    ``facts`` has a key and two flags, so it is hashed: the rows of ``df`` are not sorted.
    """
    return (
        lookup_join(df, facts, [KEY], "left", hot, "shuffle_hash")
        .filter(F.col("_done").isNull()).drop("_done")
        .withColumn("qa_multiple_subtypes", F.coalesce("qa_multiple_subtypes", F.lit(False)))
    )


def add_flags(df: DataFrame, strict_dob_rule: bool = False) -> DataFrame:
    """The row-level checks, then ``qa_flag`` over all of them."""
    checked = row_flags(df, strict_dob_rule)
    return checked.withColumn("qa_flag", flags.any_flag(checked))


def row_flags(df: DataFrame, strict_dob_rule: bool = False) -> DataFrame:
    """The checks that a row alone decides."""
    return df.withColumns({
        "qa_wdrs_result": flags.unknown_result(F.col("WDRS_RESULT")),
        "qa_wdrs_result_summary": flags.unknown_summary(F.col("WDRS_RESULT_SUMMARY")),
        "qa_missing_dob": flags.missing_dob(
            F.col("PatientFirstName"), F.col("PatientLastName"), F.col("PatientBirthDate"),
            strict_dob_rule),
    })


def _not_negative() -> Column:
    return ~F.col("WDRS_RESULT_SUMMARY").eqNullSafe(S.NEGATIVE)


def unflagged(df: DataFrame, strict_dob_rule: bool = False) -> DataFrame:
    """Positive rows that no check of a row alone flags: of submissions without facts, the clean ones."""
    checked = add_flags(df, strict_dob_rule)
    return checked.filter(
        ~F.col("qa_flag") & _not_negative() & (F.col("WDRS_RESULT") != S.NOT_DETECTED_CODE)
    ).select(*map(quote, df.columns))


def without_facts(df: DataFrame, facts: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    return lookup_join(df, facts.select(KEY), [KEY], "left_anti", hot)


def issues(df: DataFrame, facts: DataFrame, hot: HotKeys | None = None,
           strict_dob_rule: bool = False) -> DataFrame:
    """Flagged rows to look at; negatives go nowhere.

    Negatives and the columns that only the checks read stay behind before the rows meet the facts.
    """
    columns = [KEY, "internal_create_date", *S.STANDARD_COLUMNS]
    rows = row_flags(df.filter(_not_negative()), strict_dob_rule)
    marks = columns_matching(rows, "^qa_")
    rows = with_facts(rows.select(*columns, *marks), facts, hot)
    return rows.withColumn("qa_flag", flags.any_flag(rows)).filter("qa_flag").select(
        *columns, "qa_multiple_subtypes", *marks, "qa_flag")


def link_input(clean: DataFrame) -> DataFrame:
    """The demographics of each clean submission, one row per submission."""
    return keep_one(clean.select(*S.FUZZY_INPUT_COLUMNS), [KEY])
