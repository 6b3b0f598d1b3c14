"""Per-packet scalar functions (F1-F5, F7-F9, L4) as native Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES, PORT_PATTERN, PROTOCOL_MAP


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def proto_num(protocol="protocol") -> Column:
    """exact-case protocol name -> number, unknown/null -> 0 (smallint)."""
    return F.coalesce(_literal_map(PROTOCOL_MAP)[_col(protocol)], F.lit(0)).cast("smallint")


def _port(info, group: int) -> Column:
    s = F.regexp_extract(F.coalesce(_col(info), F.lit("nan")), PORT_PATTERN, group)
    # no match gives '' and an overflow gives null under try_cast; both become -1
    return F.coalesce(s.try_cast("int"), F.lit(-1))


def src_port(info="info") -> Column:
    """first port before '>' in Info, -1 when absent."""
    return _port(info, 1)


def dst_port(info="info") -> Column:
    """first port after '>' in Info, -1 when absent."""
    return _port(info, 2)


def flag(name: str, info="info") -> Column:
    """case-sensitive substring test of a TCP flag name in Info (tinyint 0/1)."""
    return F.coalesce(_col(info), F.lit("nan")).contains(name).cast("tinyint")


def flow_id(source="source", destination="destination", dport="dst_port", proto="proto_num") -> Column:
    """directional flow key ``src->dst:dport/proto``; null source prints as 'nan'."""
    return F.concat(
        F.coalesce(_col(source), F.lit("nan")), F.lit("->"),
        F.coalesce(_col(destination), F.lit("nan")), F.lit(":"),
        _col(dport).cast("string"), F.lit("/"),
        _col(proto).cast("string"),
    )


def time_label(t="time_start") -> Column:
    """HH:MM:SS (UTC) for epoch seconds, else seconds with two decimals and 's'."""
    c = _col(t)
    # clock time from epoch seconds by arithmetic: independent of the session time zone
    secs = F.floor(c).cast("bigint")
    hms = F.format_string("%02d:%02d:%02d", (F.floor(secs / 3600) % 24).cast("int"),
                          (F.floor(secs / 60) % 60).cast("int"), (secs % 60).cast("int"))
    # format_number rounds the exact binary value (as Python's "%.2f"); format_string does not
    rel = F.regexp_replace(F.format_number(c, 2), ",", "")
    return F.when(c > 1e8, hms).otherwise(F.concat(rel, F.lit("s")))


def time_bin(t="global_time") -> Column:
    """whole second (truncation toward zero)."""
    return _col(t).cast("bigint")


def clip(c, lo=None, hi=None) -> Column:
    """F8: clamp to [lo, hi]; either bound may be omitted."""
    x = _col(c)
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    return x


def class_name(label="label") -> Column:
    """L4: class id -> name, unknown id -> 'Class_<id>'."""
    c = _col(label)
    return F.coalesce(_literal_map(CLASS_NAMES)[c], F.concat(F.lit("Class_"), c.cast("string")))


def exact_avg(c) -> Column:
    """Mean with an exact decimal sum: the result does not depend on how rows are
    partitioned or combined (float sums of values near 1e11 do)."""
    x = _col(c)
    return F.sum(x.cast("decimal(38,10)")).cast("double") / F.count(x)


def np_round(c, digits: int) -> Column:
    """numpy's ``round``/pandas ``.round``: rint(x * 10^d) / 10^d (half-even on the scaled
    double, so 2.675 -> 2.68)."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def py_round(c, digits: int) -> Column:
    """Python's ``round(x, d)``: the exact binary value is rounded (2.675, stored a little below, -> 2.67;
    0.12345, stored a little above, -> 0.1235). Spark's ``bround`` rounds the shortest decimal form instead."""
    x = _col(c).cast("double")
    finite = F.abs(x) < F.lit(float("inf"))  # NaN sorts above every number
    text = F.call_function("format_number", F.when(finite, x), F.lit("0." + "0" * digits))
    return F.when(finite, text.cast("double")).otherwise(x)
