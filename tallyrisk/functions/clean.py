"""Column-level cleaning: blanks, type coercion, period parsing, clipping.

Every function returns a ``Column`` so callers compose them in one
``select`` and Catalyst keeps the whole projection in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANK = r"^\s*$"


def blank_to_null(c: Column) -> Column:
    """``^\\s*$`` → NULL (P-1)."""
    return F.when(c.rlike(_BLANK), F.lit(None).cast("string")).otherwise(c)


def normalize_blanks(df: DataFrame) -> DataFrame:
    """Apply :func:`blank_to_null` to every string column (P-1)."""
    return df.select([
        blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def to_double(c: Column) -> Column:
    """Lenient numeric coercion: unparsable → NULL, never NaN (P-2, §1.4)."""
    # nanvl keeps one reference to the parsed value: the expression tree stays linear.
    return F.nanvl(F.trim(c.cast("string")).try_cast("double"), F.lit(None).cast("double"))


def to_long(c: Column) -> Column:
    """Integer coercion through double, so '720.0' becomes 720 (§1.2)."""
    d = to_double(c)
    return F.when(d == F.floor(d), d.try_cast("long"))


def coerce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Coerce the listed columns to ``double`` / ``long`` / ``string`` (P-2)."""
    conv = {"double": to_double, "long": to_long, "string": lambda c: c.cast("string")}
    return df.select([
        conv[types[n]](F.col(n)).alias(n) if n in types else F.col(n) for n in df.columns
    ])


def clip(c: Column, lo: float | None, hi: float | None) -> Column:
    """Clip keeping NULL as NULL (``greatest(NULL, 1)`` is 1 in Spark) (P-4)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def _ym(y: Column, m: Column) -> Column:
    ok = y.between(1900, 2100) & m.between(1, 12)
    return F.when(ok, F.make_date(y, m, F.lit(1)))


def parse_six_digits(s: Column) -> Column:
    """Six digits → first of month: YYYYMM when the year is plausible, else MMYYYY (T1)."""
    six = s.rlike(r"^\d{6}$")
    a_y = F.substring(s, 1, 4).try_cast("int")
    a_m = F.substring(s, 5, 2).try_cast("int")
    b_m = F.substring(s, 1, 2).try_cast("int")
    b_y = F.substring(s, 3, 4).try_cast("int")
    return F.when(six, F.coalesce(_ym(a_y, a_m), _ym(b_y, b_m)))


def parse_period(c: Column) -> Column:
    """Any of YYYYMM / MMYYYY / YYYYMMDD / ISO text → first day of the month (P-5).

    Decided per row, never per column: a tape may mix layouts (T1).
    """
    s = F.trim(c.cast("string"))
    eight = F.when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd"))
    iso_ym = F.when(s.rlike(r"^\d{4}-\d{2}$"),
                    _ym(F.substring(s, 1, 4).try_cast("int"), F.substring(s, 6, 2).try_cast("int")))
    iso_d = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$"),
                   F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))
    d = F.coalesce(parse_six_digits(s), eight, iso_ym, iso_d)
    return F.trunc(d, "MM")


def period_text(d: Column) -> Column:
    """DATE → ``'YYYY-MM'`` text (the reference's period string)."""
    return F.date_format(d, "yyyy-MM")


def tape_period_text(c: Column) -> Column:
    """P-7, first half: number → integer → zero-padded six-digit text."""
    return F.lpad(to_long(c).cast("string"), 6, "0")


def parse_tape_period(c: Column) -> Column:
    """Numeric period (leading zero possibly lost) → month (P-7).

    number → integer → zero-pad to 6 → YYYYMM, else MMYYYY; NULL when neither.
    Prefer :func:`with_tape_period` on frames: it materialises the padded text once
    instead of repeating it inside every branch of the date rule.
    """
    return parse_six_digits(tape_period_text(c))


def with_tape_period(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ``out`` = P-7 month of ``src``, computing the padded text in its own projection."""
    tmp = f"__{out}_txt"
    return (df.withColumn(tmp, tape_period_text(F.col(src)))
            .withColumn(out, parse_six_digits(F.col(tmp))).drop(tmp))


def with_period(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ``out`` = P-5 month of ``src`` with the trimmed text materialised once."""
    tmp = f"__{out}_txt"
    return (df.withColumn(tmp, F.trim(F.col(src).cast("string")))
            .withColumn(out, parse_period(F.col(tmp))).drop(tmp))


def add_months_text(mmyyyy: Column, months: int | Column) -> Column:
    """``MMYYYY`` text plus ``months`` → ``YYYYMM`` text (P-16)."""
    d = F.try_to_date(mmyyyy, "MMyyyy")
    m = months if isinstance(months, Column) else F.lit(months)
    return F.date_format(F.add_months(d, m), "yyyyMM")
