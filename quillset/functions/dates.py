"""Publication dates: text in, UTC timestamps without zone out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillset.functions.text import bound

# The accepted spellings.
DATE_FORMAT = "%Y-%m-%d"
ISO_DATE = r"(\d{4})(-?)(\d{2})\2(\d{2})"
ISO_TIME = r"(\d{2})(?:(:?)(\d{2})(?:\6(\d{2}))?)?(?:[.,](\d+))?"
ISO_ZONE = r"Z|([+-])(\d{2})(?:(:?)(\d{2})(?:\12(\d{2}))?)?(?:[.,]\d+)?"
ISO_MOMENT = rf"^{ISO_DATE}(?:[\s\S]{ISO_TIME}(?:{ISO_ZONE})?)?\z"
PLAIN_DATE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
TIME_WITH_ZONE = r"(T[\d:.]+)(Z|[+-]\d{2}:?\d{2})$"
RANGE_SEPARATOR = ".."


def parse_published(text: Column) -> Column:
    """ISO text to a UTC ``timestamp_ntz``; else the date before the first space; else null.

    With or without signs between the parts of the date, the time and the zone, any one sign between date and time, hours
    alone, fractions of any length (cut to microseconds). Text without a zone is taken as UTC whatever the zone of the
    session; an offset is taken off. One pattern takes a text apart.
    """
    parts = F.split(F.regexp_replace(text, ISO_MOMENT, r"$1-$3-$4|$5|$7|$8|$9|$10|$11|$13|$14"), r"\|")

    def moment(p: Column) -> Column:
        def part(i: int) -> Column:
            return F.when(p[i] != "", p[i]).otherwise(F.lit("00"))

        clock = F.concat_ws(":", part(1), part(2), part(3))
        spelled = F.concat(p[0], F.lit(" "), clock, F.lit("."), F.rpad(F.substring(p[4], 1, 6), 6, "0"))
        sign = F.when(p[5] == "-", -1).otherwise(1)
        offset = [sign * part(i).cast("int") for i in (6, 7, 8)]
        real = ~p[0].startswith("0000") & (part(6) < "24") & (part(7) < "60") & (part(8) < "60")
        shift = F.make_dt_interval(F.lit(0), *offset[:2], offset[2].cast("decimal(18,6)"))
        return F.when(real, spelled.try_cast("timestamp_ntz") - shift)

    head = F.split_part(text, F.lit(" "), F.lit(1))
    plain = F.when(head.rlike(PLAIN_DATE) & ~head.startswith("0000"), head)
    return F.coalesce(
        F.when(text.rlike(ISO_MOMENT), bound(parts, moment)), plain.try_cast("date").cast("timestamp_ntz")
    )


def naive_iso(text: Column) -> Column:
    """Drop the zone of an ISO text without shifting the clock."""
    return F.regexp_replace(text, TIME_WITH_ZONE, "$1")


def parse_range(text: str | None) -> tuple[datetime | None, datetime | None] | None:
    """Bounds of ``A..B``, either side open. None without a separator; a bad date raises."""
    if not text or RANGE_SEPARATOR not in text:
        return None
    bounds = (side.strip() for side in text.split(RANGE_SEPARATOR, 1))
    first, last = (datetime.strptime(side, DATE_FORMAT) if side else None for side in bounds)
    return first, last
