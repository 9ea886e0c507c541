"""Label names and label lines as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import CORNERS


#: White space at the ends: Unicode's, and the four separators U+001C to U+001F.
BLANKS = r"[\s\x1C-\x1F]+"
ENDS = rf"(?U)^{BLANKS}|{BLANKS}$"


def clean_label(label: Column) -> Column:
    """Lower case without white space at either end."""
    return F.lower(F.regexp_replace(label, ENDS, ""))


def six_decimals(value: Column) -> Column:
    """The number with six decimals, rounded half to even."""
    return F.format_string("%.6f", F.bround(value, 6))


def format_label_line(class_id: Column, corners: Column) -> Column:
    """`class x1 y1 x2 y2 x3 y3 x4 y4` with six decimals; null if the class or the corners are."""
    numbers = F.flatten(F.transform(corners, lambda p: F.array(six_decimals(p["x"]), six_decimals(p["y"]))))
    line = F.concat_ws(" ", class_id.cast("string"), F.array_join(numbers, " "))
    return F.when(class_id.isNotNull() & corners.isNotNull(), line)


def parse_label_line(line: Column) -> Column:
    """struct<class_id:long, corners:CORNERS, ok:boolean, blank:boolean> of a label line.

    blank: nothing, or not nine tokens. ok: nine numbers; the class is truncated, and
    one beyond 64 bits is not ok. A line that is neither blank nor ok belongs with the
    rejects. Null counts as blank.
    """
    tokens = F.split(F.regexp_replace(F.coalesce(line, F.lit("")), ENDS, ""), rf"(?U){BLANKS}")
    numbers = F.transform(tokens, lambda t: t.try_cast("double"))

    def build(n: Column) -> Column:
        nine = F.size(n) == 9
        class_id = F.get(n, F.lit(0)).try_cast("long")
        ok = nine & F.forall(n, lambda v: v.isNotNull() & ~F.isnan(v)) & class_id.isNotNull()
        at = lambda k: F.struct(F.get(n, F.lit(k)).alias("x"), F.get(n, F.lit(k + 1)).alias("y"))
        corners = F.array(*[at(k) for k in (1, 3, 5, 7)]).cast(CORNERS)
        return F.struct(F.when(ok, class_id).alias("class_id"), F.when(ok, corners).alias("corners"), ok.alias("ok"), (~nine).alias("blank"))

    return F.transform(F.array(numbers), build)[0]
