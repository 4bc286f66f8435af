"""Free text and local codes to registry codes and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebind import settings as S
from casebind.functions.text import lookup, occurs, strip

ALT_RULES = [
    (S.ALT_RESULT_PATTERNS.get(code, pattern), code, label)
    for pattern, code, label in S.RESULT_RULES
]


def _specimen(position: int) -> dict[str, str]:
    return {text: row[position] for text, row in S.SPECIMENS.items() if row[position]}


def first_rule(text: Column, rules: list[tuple[str, str, str]]) -> Column:
    """1-based position of the first rule whose pattern occurs in the text, else null."""
    picked = F
    for position, (pattern, _, _) in enumerate(rules, 1):
        picked = picked.when(occurs(text, pattern), position)
    return picked


def rule_value(position: Column, text: Column, rules: list[tuple[str, str, str]],
               labels: bool = False) -> Column:
    """Code (or label) of the rule at that position; without one, the text without outer space."""
    values = F.array(*[F.lit(label if labels else code) for _, code, label in rules])
    return F.coalesce(F.try_element_at(values, position), strip(text))


def result_code(text: Column) -> Column:
    return rule_value(first_rule(text, S.RESULT_RULES), text, S.RESULT_RULES)


def result_label(text: Column) -> Column:
    return rule_value(first_rule(text, S.RESULT_RULES), text, S.RESULT_RULES, labels=True)


def alt_result_code(text: Column) -> Column:
    return rule_value(first_rule(text, ALT_RULES), text, ALT_RULES)


def alt_result_label(text: Column) -> Column:
    return rule_value(first_rule(text, ALT_RULES), text, ALT_RULES, labels=True)


def label_of_code(code: Column) -> Column:
    """Registry label of a result code; a code without one stands for itself."""
    return F.coalesce(lookup(code, {c: label for _, c, label in S.RESULT_RULES}), code)


def result_summary(text: Column) -> Column:
    return (
        F.when(text.contains(S.POSITIVE_MARK), S.POSITIVE)
        .when(text.contains(S.NEGATIVE_MARK), S.NEGATIVE)
    )


def is_pcr(text: Column) -> Column:
    """A PCR test that was not inconclusive."""
    text = F.upper(text)
    return ~occurs(text, S.TEST_EXCLUDE_PATTERN) & text.contains(S.TEST_PCR_PATTERN)


def test_performed(text: Column) -> Column:
    return F.when(is_pcr(text), S.TEST_PCR_CODE)


def test_performed_label(text: Column) -> Column:
    return F.when(is_pcr(text), S.TEST_PCR_LABEL)


# not unit tests, whatever their names look like to a collector
test_performed.__test__ = False
test_performed_label.__test__ = False


def specimen_type_label(text: Column) -> Column:
    return lookup(text, _specimen(0))


def specimen_type_code(text: Column) -> Column:
    return lookup(text, _specimen(1))


def specimen_site_label(text: Column) -> Column:
    return lookup(text, _specimen(2))


def specimen_site_code(text: Column) -> Column:
    return lookup(text, _specimen(3))


def performing_lab() -> Column:
    return F.lit(S.PERFORMING_LAB_CODE)


def submitter_code(lab_name: Column) -> Column:
    return lookup(lab_name, S.SUBMITTER_CODES, S.OTHER_SUBMITTER_CODE)


def submitter_other(code: Column, lab_name: Column) -> Column:
    return F.when(code.contains(S.OTHER_SUBMITTER_CODE), lab_name)


def form_test_code(code: Column) -> Column:
    return lookup(code, S.FORM_TEST_CODES)


def form_result_code(code: Column, additions: bool = True) -> Column:
    extra = S.FORM_RESULT_ADDITIONS if additions else {}
    return lookup(code, S.FORM_RESULT_CODES | extra)


def roster_note(run_date) -> Column:
    return F.lit(S.ROSTER_NOTE.format(run_date=run_date))
