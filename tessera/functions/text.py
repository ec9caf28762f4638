"""Column functions with the text rules of the JVM: splits, strict numbers, trimming, parts of paths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_JVM_SPACE = "".join(map(chr, range(33)))
_REGEX_SPACE = " \t\n\x0b\f\r"
INTEGER = r"\A[+-]?[0-9]+\z"
DECIMAL = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def worked_out(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with further columns that are worked out once for each row: later filters are not pushed below them, which would repeat the work."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def split_kept(text: Column, sep: str) -> Column:
    """Parts between one-character separators; trailing empty parts are dropped, the empty text is one empty part."""
    return _split(text, sep, rf"\Q{sep}\E")


def _split(text: Column, trim: str, regex: str) -> Column:
    def parts(t):
        rest = F.rtrim(t, F.lit(trim))
        return F.when((t != "") & (rest == ""), F.array().cast("array<string>")).otherwise(F.split(rest, regex))

    return bound(text, parts)


def split_spaces(text: Column) -> Column:
    """Parts between runs of white space; a leading run gives one empty part, trailing ones none."""
    return _split(text, _REGEX_SPACE, r"[ \t\n\x0B\f\r]+")


def part(parts: Column, i: int) -> Column:
    """Element i from 0; null beyond the end."""
    return F.get(parts, i)


def strict(text: Column, kind: str) -> Column:
    """The number a text is (int, bigint or double), with no blank around it; else null, as for one out of range."""
    return bound(text, lambda t: F.when(t.rlike(DECIMAL if kind == "double" else INTEGER), t.try_cast(kind)))


def trimmed(text: Column) -> Column:
    """Text without the characters up to U+0020 at its ends."""
    return F.btrim(text, F.lit(_JVM_SPACE))


def before_last(text: Column, sep: str) -> Column:
    """What stands before the last separator; null without one."""
    return bound(text, lambda t: F.when(F.contains(t, F.lit(sep)), F.substring(t, F.lit(1), F.length(t) - F.length(F.substring_index(t, sep, -1)) - len(sep))))


def at_first(text: Column, sep: str) -> tuple[Column, Column]:
    """Text before and behind the first separator; both null without one."""
    found = F.contains(text, F.lit(sep))
    head = F.substring_index(text, sep, 1)
    return F.when(found, head), F.when(found, F.substring(text, F.length(head) + 1 + len(sep), F.length(text)))


def referer_host(referer: Column) -> Column:
    """Host of a referer that has a path; the empty text for others."""
    parts = split_kept(F.replace(referer, F.lit("//"), F.lit("/")), "/")
    return bound(parts, lambda p: F.when(F.size(p) > 2, part(p, 1)).otherwise(""))


def strict_time(text: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd HH:mm:ss``; null for anything else."""
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def compact_time(time: Column) -> Column:
    """``yyyyMMddHHmmss``."""
    return F.date_format(time, "yyyyMMddHHmmss")


def epoch_millis(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def log2(x: Column) -> Column:
    return F.log(2.0, x)
