"""Date text as the source systems and their users write it, read by one table of forms.

The text runs through one chain of replacements: the clock time is set apart by ``~``, each form turns the day in front
of it into ``year|month|day`` (what several forms could read belongs to the first), and parts get their zeros. No value is
referred to twice, so the expression stays small. One checked cast ends it: days that don't exist are NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, weekday names, and the forms of a clock time.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
          "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:[.:]\d{1,9})?)?(?: ?[ap]\.?m\.?)?|\d{1,2} ?[ap]\.?m\.?"

_NAME = "(" + "|".join("sept?(?:ember)?" if m == "september" else f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + ")"
_WEEKDAY = "^(?:" + "|".join(f"{d[:3]}(?:{d[3:]})?" for d in WEEKDAYS) + r")\.?,? "
_YEAR = r"(\d{4}|\d{2})"


@dataclass(frozen=True)
class Form:
    """A way to write a day: its pattern, and where year, month and day stand in it. ``by_order`` marks days that are
    two plain numbers, which of them is the month being a matter of custom."""

    shape: str
    year: int
    month: int
    day: int | None
    by_order: bool = False

    def pattern(self) -> str:
        return f"^{self.shape}~"

    def parts(self, day_first: bool) -> str:
        month, day = (self.day, self.month) if self.by_order and day_first else (self.month, self.day)
        return f"${self.year}|${month}|" + (f"${day}" if day else "1") + "~"


# The forms, in the order in which they are tried. Names and letters are in lower case by then.
FORMS = (
    Form(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})", 1, 3, 4),                        # 2020-1-5, 2020/01/05
    Form(r"(\d{4})(\d{2})(\d{2})", 1, 2, 3),                                     # 20200105
    Form(rf"(\d{{1,2}})([-/.])(\d{{1,2}})\2{_YEAR}", 4, 1, 3, by_order=True),    # 1/5/2020, 01-05-20
    Form(rf"{_NAME}\.? (\d{{1,2}})(?:st|nd|rd|th)?(?:, ?| ){_YEAR}", 3, 1, 2),   # jan 5 2020, january 5, 2020
    Form(rf"(\d{{1,2}})(?:st|nd|rd|th)?([- ]){_NAME}\.?,?\2{_YEAR}", 4, 3, 1),   # 5 jan 2020, 5-jan-20
    Form(rf"(\d{{4}})([- ]){_NAME}\.?\2(\d{{1,2}})", 1, 3, 4),                   # 2020 jan 5
    Form(rf"{_NAME}\.?,? (\d{{4}})", 2, 1, None),                                # january 2020: its first day
)
# What follows the forms: short years, months without the rest of their names, and clock times as 24 hours less the mark.
_YEARS = ((r"^([5-9]\d)\|", "19$1|"), (r"^(\d{2})\|", "20$1|"), (r"\|([a-z]{3})[a-z]+\|", "|$1|"))
_CLOCKS = (
    (r"~(\d+) ?([ap])\.?m\.?$", "~$1:00$2"),
    (r" ?([ap])\.?m\.?$", "$1"),
    (r"~(\d+:\d\d:\d\d):(\d)(?=[ap]?$)", "~$1.00$2"),
    (r"~(\d+:\d\d:\d\d):(\d\d)(?=[ap]?$)", "~$1.0$2"),
    (r"~(\d+:\d\d:\d\d):(\d{3})(?=[ap]?$)", "~$1.$2"),
    (r"~12(:[\d:.]+)[ap]$", "~00$1"),
    (r"~(0?[1-9]|1[01])(:[\d:.]+)[ap]$", "~$1$2"),
    (r"~$", "~00:00"),
    (r"([|~])(\d)(?!\d)", "$10$2"),
)
_WHOLE = r"^(\d{4})\|(\d{2})\|(\d{2})~(\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)$"


def written_instant(trimmed: Column, day_first: bool = False) -> Column:
    """Instant of a day in one of ``FORMS``, with or without a clock time behind it; NULL for anything else.

    Where only custom says which number is the month, the first is, or the second with ``day_first``; a number above 12
    in the month's place makes the text no date, as one column would else follow two customs. Two-digit years end in
    2049. Hours with a mark run from 1 to 12. A year alone and a clock time alone are no dates.
    """
    chain = [(r"\s+", " "), (_WEEKDAY, ""), (rf"(?s)^(.+?)(?:(?:t|,? )({CLOCK}))?$", "$1~$2")]
    chain += [(form.pattern(), form.parts(day_first)) for form in FORMS]
    text = F.translate(F.lower(trimmed), "|~", "??")
    for pattern, put in (*chain, *_YEARS):
        text = F.regexp_replace(text, pattern, put)
    for number, month in enumerate(MONTHS, 1):
        text = F.replace(text, F.lit(f"|{month[:3]}|"), F.lit(f"|{number}|"))
    for pattern, put in _CLOCKS:
        text = F.regexp_replace(text, pattern, put)
    # What no form has read still has its mark, and so is no timestamp.
    stamp = F.regexp_replace(text, _WHOLE, "$1-$2-$3 $4").try_cast("timestamp")
    afternoon = F.when(trimmed.rlike(r"(?i)\d ?p\.?m\.?$"), F.lit(12)).otherwise(F.lit(0))
    return stamp + F.make_dt_interval(hours=afternoon)
