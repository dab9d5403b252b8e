"""Row predicates used for filtering and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import text as T


def within_age(posted, now, max_age_days: int) -> Column:
    """Unknown dates pass; 0 days switches the check off."""
    if max_age_days <= 0:
        return F.lit(True)
    return T._col(posted).isNull() | (T._col(posted) >= now - F.make_dt_interval(F.lit(max_age_days)))


def agency_is(agency, wanted: str) -> Column:
    """Case-insensitive, trimmed; a blank filter passes everything."""
    wanted = wanted.strip()
    return F.lower(T.trim_ws(agency)) == wanted.lower() if wanted else F.lit(True)


def is_active(status, active: tuple[str, ...] = (fixed.APP_OPEN, fixed.APP_PENDING)) -> Column:
    return T._col(status).isin(*active)


def needs_detail(detail_url="detail_url", house_sn="house_sn", contract="contract_payment_krw",
                 balance="balance_payment_krw", count="supply_count", supply_type="supply_type",
                 deposit="deposit_krw", rent="monthly_rent_krw",
                 money_types: tuple[str, ...] = fixed.ENRICH_SUPPLY_TYPES) -> Column:
    """Whether an item must be looked up: its count is missing, or its money is
    missing for the supply types that publish it on the detail page only."""
    has_page = ~T.is_blank(detail_url)
    paid_in_steps = (T._col(house_sn) > 0) & T._col(contract).isNotNull() & T._col(balance).isNotNull()
    no_count = F.coalesce(T._col(count), F.lit(0)) <= 0
    no_money = T._col(deposit).isNull() | T._col(rent).isNull()
    money_on_page = T.trim_ws(supply_type).isin(*money_types)
    return F.coalesce(has_page & ~paid_in_steps & (no_count | (no_money & money_on_page)), F.lit(False))


def needs_file(file_count, deposit_text="deposit_condition_text", rent_text="monthly_rent_condition_text") -> Column:
    """Files exist and either condition text is blank."""
    return (T._col(file_count) > 0) & (T.is_blank(deposit_text) | T.is_blank(rent_text))


def availability_matches(agency, status, agency_filter: str = "", statuses: tuple[str, ...] = ()) -> Column:
    ok = F.lit(True)
    if agency_filter.strip():
        ok = ok & (T._col(agency) == agency_filter.strip())
    if statuses:
        ok = ok & T._col(status).isin(*[s.strip() for s in statuses])
    return ok


def row_search(query: str, *cols) -> Column:
    """Case-insensitive contains over the given columns joined by spaces."""
    return F.lower(F.concat_ws(" ", *[T._col(c) for c in cols])).contains(query.strip().lower())


def is_repair_target(notice_id="notice_id", attachment_id="attachment_id") -> Column:
    return F.coalesce((T._col(notice_id) > 0) & (T._col(attachment_id) > 0), F.lit(False))


def within_budget(candidates: DataFrame, order: list[Column], attempts: int, cap: int = fixed.REPAIR_CAP) -> DataFrame:
    """As many candidates as the attempt budget still allows, best first."""
    if not 1 <= cap <= fixed.REPAIR_CAP:
        raise ValueError(f"cap must be in 1..{fixed.REPAIR_CAP}")
    return candidates.orderBy(*order).limit(max(cap - attempts, 0))


def has_schedule_text(artifact_type, types: tuple[str, ...] = fixed.SCHEDULE_TEXT_TYPES) -> Column:
    return T._col(artifact_type).isin(*types)


def is_clean_text(*cols) -> Column:
    """No replacement character in any of the columns."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & (F.instr(F.coalesce(T._col(c), F.lit("")), fixed.CORRUPT_CHAR) == 0)
    return ok
