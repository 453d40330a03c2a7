"""Scalar expressions: ids, paths, lenient numbers, sizes, JSON."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def account(global_id: Column, accounts: Sequence[str]) -> Column:
    """The account a number falls to, in turn."""
    return F.element_at(F.array(*[F.lit(a) for a in accounts]), (F.pmod(global_id, F.lit(len(accounts))) + 1).cast("int"))


def task_id(account_: Column, global_id: Column, resolution: Column) -> Column:
    """``A_g0007_720p``; numbers above 9999 keep all digits."""
    return F.format_string("%s_g%04d_%s", account_, global_id, resolution)


def shard_name(number: Column) -> Column:
    return F.format_string("shards/train-%05d.tar", number)


def first_part(id_: Column) -> Column:
    """What precedes the first underscore; null or empty is ``?``."""
    return F.coalesce(F.nullif(F.split_part(id_, F.lit("_"), F.lit(1)), F.lit("")), F.lit("?"))


def last_part(id_: Column) -> Column:
    return F.coalesce(F.nullif(F.split_part(id_, F.lit("_"), F.lit(-1)), F.lit("")), F.lit("?"))


def owner(account_: Column, id_: Column) -> Column:
    """The account field, else the prefix of the id."""
    return F.coalesce(F.nullif(account_, F.lit("")), first_part(id_))


def file_stem(path: Column, ending: str = r"[^./]+") -> Column:
    """The last part of a path without its ending."""
    return F.regexp_extract(path, rf"([^/]*?)(?:\.{ending})?$", 1)


def rounded(x: Column) -> Column:
    return F.round(x, 6)


def lenient_int(text: Column) -> Column:
    """A whole number, null for anything else (also ``169.0``)."""
    return text.try_cast("bigint")


def lenient_float(text: Column) -> Column:
    return rounded(text.try_cast("double"))


def frame_rate(text: Column) -> Column:
    """A rate given as ``a/b`` or as a number, 6 places; null where it is blank, unreadable or over zero. Keep the text beside it."""
    over = F.try_divide(F.split_part(text, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(text, F.lit("/"), F.lit(2)).try_cast("double"))
    return rounded(F.when(F.contains(text, F.lit("/")), over).otherwise(text.try_cast("double")))


def duration(frames: Column, rate: Column) -> Column:
    return rounded(F.try_divide(frames, rate))


def percent(part: Column, whole: Column) -> Column:
    """One decimal place; zero of nothing."""
    return F.round(F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0)), 1)


def kib(n: Column) -> Column:
    return n / F.lit(1024.0)


def gib(n: Column) -> Column:
    return n / F.lit(float(1 << 30))


def whole_mean(total: Column, count: Column) -> Column:
    """The mean rounded down."""
    return F.floor(F.try_divide(total, count)).cast("bigint")


def u32(data: Column, at: int | Column) -> Column:
    """The big-endian number in the four bytes from ``at`` (counted from 1)."""
    return F.conv(F.hex(F.substring(data, at, 4)), 16, 10).cast("bigint")


def tag(data: Column, at: int) -> Column:
    return F.decode(F.substring(data, at, 4), "ISO-8859-1")


_UNITS = {"": 0, "k": 1, "m": 2, "g": 3, "t": 4}
_SIZE = re.compile(r"\s*([0-9]*\.?[0-9]+)\s*(?:([kmgt])b?)?\s*", re.IGNORECASE)


def parse_size(text: str) -> int:
    """Bytes of a size such as ``2g``, ``1.5 MB`` or ``4096``; units are powers of 1024. Raises ValueError for anything else."""
    m = _SIZE.fullmatch(text)
    if not m or (not m[2] and "." in m[1]):
        raise ValueError(f"not a size: {text!r}")
    return int(float(m[1]) * 1024 ** _UNITS[(m[2] or "").lower()])


def size_bytes(text: Column) -> Column:
    """The same over a column; null for what is no size."""
    low = F.lower(F.btrim(text))
    pattern = r"^([0-9]*\.?[0-9]+)\s*(?:([kmgt])b?)?$"
    number, unit = F.regexp_extract(low, pattern, 1), F.regexp_extract(low, pattern, 2)
    power = F.when(unit == "k", 1024).when(unit == "m", 1 << 20).when(unit == "g", 1 << 30).when(unit == "t", 1 << 40).otherwise(1).cast("bigint")
    valid = F.rlike(low, F.lit(pattern)) & ((unit != "") | ~F.contains(number, F.lit(".")))
    return F.when(valid, F.floor(number.try_cast("double") * power).cast("bigint"))


def json_array(values: Column) -> Column:
    """A JSON array of strings; other than ASCII letters are kept."""
    return F.to_json(values)
