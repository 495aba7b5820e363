"""Send date of a message: instant, month, hour and quarter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweave.functions.text import trim_blanks

# English names as they stand in a Date header.
WEEKDAYS = [
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Zone names and their offset from UTC in minutes. Some names are used in
# several places; here AST is Atlantic, BST British summer, CST and EST North American, IST
# Indian, ECT Ecuadorian, GST Gulf and SST Samoan time.
ZONE_MINUTES = {
    "GMT": 0, "UTC": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60,
    "CET": 60, "CEST": 120, "MET": 60, "MEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "TRT": 180,
    "WAT": 60, "CAT": 120, "SAST": 120, "EAT": 180, "MUT": 240, "RET": 240, "SCT": 240,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "PMST": -180, "PMDT": -120, "WGT": -180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "HDT": -540, "SST": -660,
    "BRT": -180, "BRST": -120, "ART": -180, "UYT": -180, "GFT": -180, "SRT": -180, "FNT": -120,
    "CLT": -240, "CLST": -180, "BOT": -240, "VET": -240, "GYT": -240, "PYT": -240, "PYST": -180,
    "COT": -300, "PET": -300, "ECT": -300, "GALT": -360, "EAST": -360, "EASST": -300,
    "CVT": -60, "AZOT": -60, "AZOST": 0, "EGT": -60, "MART": -570, "TAHT": -600, "CKT": -600, "NUT": -660,
    "IRST": 210, "IRDT": 270, "GST": 240, "GET": 240, "AZT": 240, "SAMT": 240, "AFT": 270,
    "PKT": 300, "UZT": 300, "TMT": 300, "TJT": 300, "MVT": 300, "YEKT": 300, "IST": 330, "NPT": 345,
    "BDT": 360, "BTT": 360, "KGT": 360, "ALMT": 360, "IOT": 360, "OMST": 360, "MMT": 390, "CCT": 390,
    "ICT": 420, "WIB": 420, "CXT": 420, "NOVT": 420, "KRAT": 420, "SGT": 480, "HKT": 480, "MYT": 480,
    "PHT": 480, "BNT": 480, "WITA": 480, "ULAT": 480, "IRKT": 480, "AWST": 480, "ACWST": 525,
    "JST": 540, "KST": 540, "WIT": 540, "YAKT": 540, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660,
    "PGT": 600, "CHST": 600, "VLAT": 600, "LHST": 630, "LHDT": 660, "NCT": 660, "SBT": 660, "VUT": 660,
    "NFT": 660, "MAGT": 660, "SRET": 660, "NZST": 720, "NZDT": 780, "FJT": 720, "TVT": 720, "MHT": 720,
    "GILT": 720, "WAKT": 720, "PETT": 720, "ANAT": 720, "CHAST": 765, "CHADT": 825, "TOT": 780,
    "PHOT": 780, "TKT": 780, "LINT": 840,
}

# Where "... Standard Time" is so many minutes from UTC, and "... Daylight Time"
# an hour more; and zones whose whole names go otherwise.
STANDARD_MINUTES = {
    "Pacific": -480, "Mountain": -420, "Central": -360, "Eastern": -300, "Atlantic": -240,
    "Newfoundland": -210, "Alaska": -540, "Hawaii": -600, "Samoa": -660, "Australian Western": 480,
    "Australian Central": 570, "Australian Eastern": 600, "New Zealand": 720, "India": 330,
    "Japan": 540, "Korean": 540, "China": 480, "Singapore": 480, "South Africa": 120, "Moscow": 180,
}
WHOLE_MINUTES = {
    "Greenwich Mean Time": 0, "Coordinated Universal Time": 0, "British Summer Time": 60,
    "Western European Time": 0, "Western European Summer Time": 60, "Central European Time": 60,
    "Central European Summer Time": 120, "Eastern European Time": 120, "Eastern European Summer Time": 180,
    "Hong Kong Time": 480, "Pakistan Time": 300, "Brasilia Time": -180, "Argentine Time": -180,
}


def _zone_table() -> dict[str, int]:
    """All zone names in upper case."""
    long = {f"{name} Standard Time": m for name, m in STANDARD_MINUTES.items()}
    long |= {f"{name} Daylight Time": m + 60 for name, m in STANDARD_MINUTES.items()}
    return {name.upper(): m for name, m in (ZONE_MINUTES | long | WHOLE_MINUTES).items()}


ZONES_READ = _zone_table()

# Month value of a mail whose date cannot be read or is out of range.
NO_MONTH = "NA"


def _names(words: list[str]) -> str:
    """Regex for full or three-letter names, longest form first."""
    return "|".join(f"{word}|{word[:3]}" for word in words)


# Weekday, day, month, year, time and zone; anything after the zone is ignored.
# The weekday must be there but is not checked against the date.
_DATE = (
    rf"(?is)^(?:{_names(WEEKDAYS)}), [ \t]*(\d++) [ \t]*({_names(MONTHS)})"
    r" [ \t]*(\d++) [ \t]*(\d++):[ \t]*(\d++):[ \t]*(\d++) [ \t]*"
    r"([+-](?:[01]\d|2[0-3])[0-5]\d"
    r"|GMT[+-](?:[01]?\d|2[0-3]):[0-5]\d"
    rf"|{'|'.join(sorted(ZONES_READ, key=len, reverse=True))}).*$"
)


def _month_number(name: Column) -> Column:
    names = F.lit("".join(month[:3].lower() for month in MONTHS))
    return ((F.instr(names, F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("int")


def _zone_seconds(zone: Column) -> Column:
    named = F.create_map(*[F.lit(item) for pair in ZONES_READ.items() for item in pair])
    clock = F.lpad(F.regexp_replace(zone, "[^0-9]", ""), 4, "0").try_cast("int")
    minutes = (clock / 100).cast("int") * 60 + clock % 100
    sign = F.when(zone.contains("-"), -1).otherwise(1)
    return F.when(zone.rlike("[0-9]"), sign * minutes).otherwise(named[F.upper(zone)]) * 60


#: What a timestamp can hold: seconds on either side of 1970, and years up to there. A part
#: beyond `MOST_PART` takes any sum out of it, since no part is negative.
MOST_SECONDS, MOST_YEAR, MOST_PART = 9_200_000_000_000, 290_000, 10_000_000_000_000


def _instant(parts: Column) -> Column:
    """Instant from day, month name, year, hour, minute, second, zone at 1 to 7.

    The parts are added up exactly, so each may be as large as the sum may: only what lies
    outside the range of a timestamp is NULL.
    """

    def number(position: int, most: int = MOST_PART) -> Column:
        value = parts[position].try_cast("bigint")
        return F.when(value <= most, value)

    first = F.make_date(number(3, MOST_YEAR).cast("int"), _month_number(parts[2]), F.lit(1))
    days = F.unix_date(first) - 1 + number(1)
    clock = number(4) * 3600 + number(5) * 60 + number(6) - _zone_seconds(parts[7])
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")

    def instant(total: Column) -> Column:
        seconds = F.when(F.abs(total) <= MOST_SECONDS, total)
        day = F.floor(seconds / 86400)
        rest = (seconds - day * 86400).cast("decimal(18,6)")
        return epoch + F.make_dt_interval(day.cast("int"), F.lit(0), F.lit(0), rest)

    # bound as the element of an array, the sum is computed once and not for each of its uses
    return F.get(F.transform(F.array(days * 86400 + clock), instant), F.lit(0))


def sent_at(date: Column) -> Column:
    """UTC wall-clock instant of a Date header, NULL if it cannot be read.

    The zone is an offset (``-0700``, ``GMT-7:00``) or a short or long name of `ZONES_READ` in
    any case. Region identifiers such as ``Europe/Paris`` are no zone names: unreadable.
    Days, hours, minutes and seconds beyond their range roll over ("31 Feb" is
    early March), as a lenient calendar does.
    """
    # A match is marked with a control character, which trimmed text cannot start
    # with; the array of one binds the parts to a name. So the pattern is applied
    # once, and not for the test and for every field.
    fields = "\x02".join(f"${i}" for i in range(1, 8))
    marked = F.regexp_replace(trim_blanks(date), _DATE, f"\x01\x02{fields}")
    found = F.filter(F.array(F.split(marked, "\x02")), lambda parts: parts[0] == "\x01")
    return F.get(F.transform(found, _instant), F.lit(0))


def _in_zone(instant: Column, tz: str) -> Column:
    return instant if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), instant)


def sent_month(instant: Column, tz: str = "UTC", lo: int = 1998, hi: int = 2002) -> Column:
    """``yyyy-MM`` in the given zone; ``NA`` if unreadable or outside the years."""
    local = _in_zone(instant, tz)
    month = F.substring(local.cast("string"), 1, 7)
    return F.when(F.year(local).between(lo, hi), month).otherwise(F.lit(NO_MONTH))


def sent_hour(instant: Column, tz: str = "UTC") -> Column:
    """Hour 0 to 23 in the given zone, NULL if the date is unreadable."""
    return F.hour(_in_zone(instant, tz))


def quarter_of(month: Column) -> Column:
    """``yyyy-Qn`` of a ``yyyy-MM`` month; NULL for ``NA`` or anything malformed."""
    parts = F.split(month, "-")
    number = F.get(parts, F.lit(1)).try_cast("int")
    quarter = ((number - 1) / 3).cast("int") + 1
    return F.when(number.isNotNull(), F.concat(parts[0], F.lit("-Q"), quarter.cast("string")))
