"""Application periods read from document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom import fixed
from noticeloom.functions import dates as D
from noticeloom.functions import text as T
from noticeloom.functions.arrays import at, g, let, printable, scan
from noticeloom.operators.dedupe import first_row
from noticeloom.operators.predicates import has_schedule_text
from noticeloom.operators.staging import explode_rows, hold

PERIOD = ("struct<label:string,starts_at:timestamp,ends_at:timestamp,date_text:string,confidence:double>")


def range_periods(text: Column, pattern: str = fixed.SCHEDULE_RANGE, confidence: float = fixed.CONF_TEXT_SCHEDULE) -> Column:
    """``label: date ~ date`` sentences → periods; both ends must be real dates."""
    def one(m):
        starts = D.parts_to_timestamp(*[g(m, i) for i in range(2, 7)])
        ends = D.parts_to_timestamp(*[g(m, i) for i in range(7, 12)], end_of_day=True)
        return F.struct(F.trim(g(m, 1)).alias("label"), starts.alias("starts_at"), ends.alias("ends_at"),
                        F.trim(m["match"]).alias("date_text"), F.lit(confidence).alias("confidence"))
    found = F.transform(scan(text, pattern, 11), one)
    return F.filter(found, lambda p: p["starts_at"].isNotNull() & p["ends_at"].isNotNull())


def procedure_period(text: Column, starts=fixed.PROCEDURE_STARTS, stop: str = fixed.PROCEDURE_STOP,
                     separators: str = fixed.PROCEDURE_SEPARATORS, wanted: str = fixed.APPLY_LABEL,
                     pattern: str = fixed.PROCEDURE_DATE, first_date: str = fixed.FIRST_DATE,
                     confidence: float = fixed.CONF_PROCEDURE_SCHEDULE) -> Column:
    """Labels in a row, then dates in a row: the first wanted label takes the date at its position."""
    start_at = F.lit(0)
    for marker in reversed(starts):
        start_at = F.when(F.instr(text, marker) > 0, F.instr(text, marker)).otherwise(start_at)
    section = F.when(start_at > 0, F.substring(text, start_at, F.length(text)))
    cut = F.instr(section, stop)
    section = F.when(cut > 1, F.substring(section, F.lit(1), cut - 1)).otherwise(section)

    def from_section(s):
        dated = F.regexp_instr(s, F.lit(first_date))
        head = F.trim(F.substring(s, F.lit(1), dated - 1))
        for marker in starts:
            head = F.trim(F.regexp_replace(head, f"^{marker}", ""))
        labels = F.filter(F.transform(F.split(head, separators), lambda x: F.trim(x)), lambda x: x != "")
        days = scan(F.substring(s, dated, F.length(s)), pattern, 10)

        def pair(found, dates):
            hits = F.filter(F.transform(found, lambda label, i: F.struct(label.alias("label"), i.alias("i"))),
                            lambda x: x["label"].contains(wanted) & (x["i"] < F.size(dates)))

            def period(hit):
                def bounds(m):
                    day = [g(m, 1), g(m, 2), g(m, 3)]
                    one_day = (g(m, 7) == "") | (g(m, 8) == "")
                    last_of_day = D.parts_to_timestamp(*day, F.lit(""), F.lit(""), end_of_day=True)
                    end_year = F.when(g(m, 6) == "", g(m, 1)).otherwise(g(m, 6))
                    end = D.parts_to_timestamp(end_year, *[g(m, i) for i in range(7, 11)], end_of_day=True)
                    return F.struct(hit["label"].alias("label"), D.parts_to_timestamp(*day, g(m, 4), g(m, 5)).alias("starts_at"),
                                    F.when(one_day, last_of_day).otherwise(end).alias("ends_at"),
                                    F.trim(m["match"]).alias("date_text"), F.lit(confidence).alias("confidence"))
                return let(at(dates, hit["i"]), bounds)
            return F.transform(F.slice(hits, 1, 1), period)
        return F.when(dated > 0, let(labels, lambda found: let(days, lambda dates: pair(found, dates))))

    found = F.coalesce(let(section, from_section), F.array().cast(f"array<{PERIOD}>"))
    return F.filter(found, lambda p: p["starts_at"].isNotNull() & p["ends_at"].isNotNull())


def text_schedules(artifacts: DataFrame, keep: list[str], text: str = "raw_text", artifact_type: str = "artifact_type",
                   span: str = "source_span", **procedure) -> DataFrame:
    """Periods of each text artifact in text order, range sentences before the procedure table."""
    staged = hold(artifacts.where(has_schedule_text(artifact_type)),
                  _t=T.collapse_ws(printable(F.col(text)))).where(F.col("_t") != "")
    both = F.concat(range_periods(F.col("_t")).cast(f"array<{PERIOD}>"),
                    procedure_period(F.col("_t"), **procedure).cast(f"array<{PERIOD}>"))
    rows = explode_rows(staged, [*keep, span], both, "position", "_p")
    return rows.select(*keep, "position", F.lit("application").alias("schedule_type"), "_p.*",
                       F.lit("source_text").alias("channel"), F.col("_p.date_text").alias("source_text"),
                       T.schedule_span(span).alias("source_span"))


def dedupe_schedules(schedules: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One schedule per (keys, type, date text); the first artifact wins."""
    return first_row(schedules, [*keys, "schedule_type", "date_text"], order)
