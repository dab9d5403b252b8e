"""Ordered keyword cascades: notice categories and attachment kinds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T


@dataclass(frozen=True)
class Rule:
    """``label`` applies when the field holds one of ``words`` (if any are given)
    and every column in ``equals`` has one of its values."""

    label: str
    field: str
    words: tuple[str, ...] = ()
    equals: dict[str, tuple[str, ...]] = field(default_factory=dict)


NOTICE_RULES = (
    Rule(fixed.CATEGORY_REJECTED, "title", fixed.TITLE_REJECT_RESULT),
    Rule(fixed.CATEGORY_REJECTED, "title", fixed.TITLE_REJECT_COMPETITION),
    Rule(fixed.CATEGORY_REJECTED, "title", fixed.TITLE_REJECT_CONTRACT),
    Rule(fixed.CATEGORY_REJECTED, "title", fixed.TITLE_REJECT_SYSTEM),
    Rule(fixed.CATEGORY_REJECTED, "body", fixed.BODY_REJECT_SYSTEM),
    Rule(fixed.CATEGORY_RECRUITMENT, "title", fixed.TITLE_ACCEPT),
    Rule(fixed.CATEGORY_RECRUITMENT, "body", fixed.BODY_ACCEPT),
)

ATTACHMENT_RULES = (
    Rule(fixed.KIND_APPLICANT, "name", fixed.ATTACH_APPLICANT),
    Rule(fixed.KIND_FORM, "name", fixed.ATTACH_FORM),
    Rule(fixed.KIND_SHEET, "name", fixed.ATTACH_SHEET, {"ext": fixed.ATTACH_SHEET_EXT}),
    Rule(fixed.KIND_SCHEDULE_PDF, "name", fixed.ATTACH_PDF_SCHEDULE, {"ext": fixed.ATTACH_PDF_EXT}),
    Rule(fixed.KIND_NOTICE_PDF, "name", fixed.ATTACH_PDF_NOTICE, {"ext": fixed.ATTACH_PDF_EXT}),
    Rule(fixed.KIND_NOTICE_HWP, "name", fixed.ATTACH_HWP_NOTICE, {"ext": fixed.ATTACH_HWP_EXT}),
)


def cascade(rules: tuple[Rule, ...], fields: dict[str, Column], default: str) -> Column:
    """Label of the first rule that applies."""
    out = None
    for rule in rules:
        hit = T.contains_any(fields[rule.field], rule.words) if rule.words else F.lit(True)
        for name, values in rule.equals.items():
            hit = hit & fields[name].isin(*values)
        out = F.when(hit, rule.label) if out is None else out.when(hit, rule.label)
    return out.otherwise(default)


def notice_category(title, body, rules: tuple[Rule, ...] = NOTICE_RULES) -> Column:
    """Rejecting rules come before accepting ones, and the title before the body."""
    return cascade(rules, {"title": T._col(title), "body": T._col(body)}, fixed.CATEGORY_UNKNOWN)


def attachment_kind(name, rules: tuple[Rule, ...] = ATTACHMENT_RULES, default: str = fixed.KIND_UNSUPPORTED) -> Column:
    lowered = F.lower(T.trim_ws(name))
    return cascade(rules, {"name": lowered, "ext": T.file_extension(lowered)}, default)


def split_persistable(notices: DataFrame, title: str, rules: tuple[Rule, ...] = NOTICE_RULES,
                      accept: str = fixed.CATEGORY_RECRUITMENT) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused), judged on the title alone. Refused rows go to their own output."""
    category = notice_category(title, F.lit(""), rules)
    return notices.where(category == accept), notices.where(category != accept)


def is_listed(title, hidden: tuple[str, ...] = fixed.NOTICE_LIST_HIDDEN) -> Column:
    """Whether the notice list shows this title."""
    return ~T.contains_any(title, hidden)
