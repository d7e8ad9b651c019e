"""Column-expression builders (JVM-side, codegen'd; no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.schema import BENIGN_PREFIX, ZEEK_NULLS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")


def is_benign(label: str | Column = "label") -> Column:
    """Trimmed, lower-cased label starts with ``benign``."""
    return F.startswith(F.lower(py_strip(label)), F.lit(BENIGN_PREFIX))


def binary_label(label: str | Column = "label") -> Column:
    """y = 1 when the label is not benign."""
    return F.when(is_benign(label), F.lit(0)).otherwise(F.lit(1))


def null_if_marker(c: str | Column, markers=tuple(ZEEK_NULLS)) -> Column:
    """Zeek null markers (``-``, ``(empty)``) and empty strings become NULL."""
    c = col(c)
    return F.when(c.isin(*markers) | (c == ""), F.lit(None)).otherwise(c)


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den as DOUBLE, ``default`` when den is 0 (ANSI division by zero raises)."""
    return F.when(den == 0, F.lit(float(default))).otherwise(F.try_divide(num.cast("double"), den.cast("double")))


def service_from_ports(sport: str | Column = "sport", dport: str | Column = "dport",
                       missing: str = "-") -> Column:
    """Either side's port, precedence 80 http > 53 dns > 443 ssl."""
    s, d = col(sport), col(dport)
    return (F.when((d == 80) | (s == 80), F.lit("http"))
            .when((d == 53) | (s == 53), F.lit("dns"))
            .when((d == 443) | (s == 443), F.lit("ssl"))
            .otherwise(F.lit(missing)))


def conn_state(has_s: Column, has_a: Column) -> Column:
    """P10: state from the untruncated history: s and a -> SF, s -> S0, else OTH."""
    return (F.when(has_s & has_a, F.lit("SF"))
            .when(has_s, F.lit("S0"))
            .otherwise(F.lit("OTH")))


def threshold(score: str | Column, t: float) -> Column:
    """Inclusive decision ``score >= t`` as INT."""
    return (col(score) >= F.lit(float(t))).cast("int")


def imbalance_ratio(benign: Column, attack: Column) -> Column:
    """A2 ratio text ``1:%.2f``; minority 0 -> ``1:inf``; empty -> ``N/A``."""
    major = F.greatest(benign, attack)
    minor = F.least(benign, attack)
    return (F.when((benign + attack) == 0, F.lit("N/A"))
            .when(minor == 0, F.lit("1:inf"))
            .otherwise(F.format_string("1:%.2f", major.cast("double") / minor.cast("double"))))


def imbalance_severity(benign: Column, attack: Column) -> Column:
    """A2 band on ratio = majority / minority, strict: >10 Extreme, >4 Severe, >1.5 Moderate."""
    ratio = F.try_divide(F.greatest(benign, attack).cast("double"), F.least(benign, attack).cast("double"))
    return (F.when((benign + attack) == 0, F.lit("N/A"))
            .when(F.least(benign, attack) == 0, F.lit("Extreme Imbalance"))
            .when(ratio > F.lit(10.0), F.lit("Extreme Imbalance"))
            .when(ratio > F.lit(4.0), F.lit("Severe Imbalance"))
            .when(ratio > F.lit(1.5), F.lit("Moderate Imbalance"))
            .otherwise(F.lit("Low Imbalance")))


def ntz_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session time
    zone (a cast to TIMESTAMP would read the wall time in the session's zone)."""
    epoch = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.timestamp_diff("MICROSECOND", epoch, col(c))


def epoch_micros(c: str | Column, dtype) -> Column:
    """Microseconds since the epoch of a TIMESTAMP (an instant) or TIMESTAMP_NTZ (read as
    UTC wall time, like Zeek and DuckDB do)."""
    from pyspark.sql import types as T
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(c)
    return F.unix_micros(col(c))
