"""player height text -> centimetres as one JVM-side expression.

Rule 1: ``6'11''`` -- feet (digits), a single quote, inches (one or two
digits, 0..11), two single quotes.  Rule 2: ``D-MMM`` (also ``/`` or a
blank between): the day is the inches (0..11) and the month is the feet,
the month being recognised by its first three letters (so ``Sept`` and
even ``Junk`` parse).  Anything else is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: unit conversion
CM_PER_FOOT = 30.48
CM_PER_INCH = 2.54

# fixed values: the two accepted notations
FEET_INCHES = r"^\s*(\d+)'\s*(\d{1,2})''\s*$"
DAY_MONTH = r"^\s*(\d{1,2})\s*[-/\s]\s*([A-Za-z]{3,9})\s*$"

# fixed values: month abbreviations in calendar order (month number = feet)
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun",
          "jul", "aug", "sep", "oct", "nov", "dec"]


def height_to_cm(c: Column | str) -> Column:
    s = F.trim(F.col(c) if isinstance(c, str) else c)
    fi = s.rlike(FEET_INCHES)
    feet1 = F.regexp_extract(s, FEET_INCHES, 1).try_cast("double")
    inch1 = F.regexp_extract(s, FEET_INCHES, 2).try_cast("double")
    dm = s.rlike(DAY_MONTH)
    inch2 = F.regexp_extract(s, DAY_MONTH, 1).try_cast("double")
    mon = F.lower(F.substring(F.regexp_extract(s, DAY_MONTH, 2), 1, 3))
    feet2 = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), mon).cast("double")
    cm = lambda ft, inch: ft * CM_PER_FOOT + inch * CM_PER_INCH
    return (F.when(fi, F.when(inch1 <= 11, cm(feet1, inch1)))
             .when(dm, F.when((feet2 > 0) & (inch2 <= 11), cm(feet2, inch2)))
             .otherwise(F.lit(None).cast("double")))
