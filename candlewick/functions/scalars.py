"""Scalar helpers: safe casts, time texts and symbol names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: Column | str) -> Column:
    """Double, or null for text that is no number and for NaN (NaN sorts above every number in Spark)."""
    number = _col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_time(value: Column | str) -> Column:
    """Timestamp, or null for text that is none."""
    return _col(value).try_cast("timestamp")


def ms_to_time(value: Column | str) -> Column:
    return F.timestamp_millis(_col(value).cast("long"))


def ms_to_iso(value: Column | str) -> Column:
    """Epoch milliseconds as ``2026-03-09T11:21:59Z``: whole seconds, cut, not rounded."""
    return F.date_format(ms_to_time(value), ISO_SECONDS)


def iso_to_ms(value: Column | str) -> Column:
    """Epoch milliseconds of an ISO text with ``Z`` or an offset; null for other text."""
    return F.unix_millis(to_time(value))


def time_to_iso(value: Column | str) -> Column:
    return F.date_format(_col(value), ISO_MILLIS)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def time_of_seconds(value: Column | str) -> Column:
    """Timestamp of epoch seconds, with or without a fraction; null for other text."""
    return F.timestamp_seconds(_col(value).try_cast("double"))


def number_text(value: Column | str) -> Column:
    """A double as the shortest text that reads back as it: ``12345678.9``, ``0.0001``, ``2.0``; from 1e16 and below 1e-4 ``1e+16``, ``1.5e-05``.

    A plain cast without exponent and of at most 15 digits is that text already; only other numbers are written anew, once each.
    """
    value = _col(value).cast("double")
    plain, size = value.cast("string"), F.abs(value)
    finite = ~F.isnan(value) & (size < float("inf"))
    short = finite & ~F.contains(plain, F.lit("E")) & (F.length(plain) <= 16)
    written = [F.format_string(f"%.{digits}e", size) for digits in (14, 15, 16)]
    exact = F.coalesce(*[F.when(text.cast("double") == size, text) for text in written[:2]], written[2])

    def layout(parts: Column) -> Column:
        digits, exponent = parts["digits"], parts["exponent"].cast("int")
        padded = F.rpad(digits, F.greatest(F.length(digits), exponent + 2), F.lit("0"))
        large = F.concat(F.substr(padded, F.lit(1), exponent + 1), F.lit("."), F.substr(padded, exponent + 2))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
        point = F.when(F.length(digits) > 1, F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.lit("."), F.substr(digits, F.lit(2)))).otherwise(digits)
        far = F.concat(point, F.lit("e"), parts["exponent"])
        return F.when(exponent.between(0, 15), large).when(exponent.between(-4, -1), small).otherwise(far)

    def split(text: Column) -> Column:
        digits = F.regexp_replace(F.replace(F.split_part(text, F.lit("e"), F.lit(1)), F.lit("."), F.lit("")), "(?<=.)0+$", "")
        return F.struct(digits.alias("digits"), F.split_part(text, F.lit("e"), F.lit(2)).alias("exponent"))

    # A step over a list of one value is worked out once, however often it is used.
    anew = F.get(F.transform(F.transform(F.array(exact), split), layout), F.lit(0))
    text = F.when(F.isnan(value), "nan").when(size == float("inf"), "inf").otherwise(anew)
    negative = ~F.isnan(value) & (value < 0)
    return F.when(short, plain).when(value.isNotNull(), F.concat(F.when(negative, "-").otherwise(""), text))


def format_symbol(symbol: Column | str, exchange: Column | str, contract: Column | str | None = None) -> Column:
    """``EXCHANGE:TICKER``, or ``EXCHANGE:TICKER<n>!`` for futures contract ``n``.

    A symbol that already names its exchange stays as it is. A contract that is
    no whole number raises an error.
    """
    symbol, exchange = _col(symbol), _col(exchange)
    plain = F.concat(exchange, F.lit(":"), symbol)
    named = F.contains(symbol, F.lit(":"))
    if contract is None:
        return F.when(named, symbol).otherwise(plain)
    text = _col(contract).cast("string")
    future = F.concat(exchange, F.lit(":"), symbol, text, F.lit("!"))
    return (
        F.when(named, symbol)
        .when(text.isNull(), plain)
        .when(text.rlike("^-?[0-9]+$"), future)
        .otherwise(F.raise_error(F.lit("not a valid contract")).cast("string"))
    )
