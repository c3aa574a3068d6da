"""Scalar column expressions: units, dates, addresses, hex, defaults.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gasledger.constants import UINT64_MAX, UINT_DECIMAL, WEI_PER_ETH, WEI_PER_GWEI


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _uint_max() -> Column:
    return F.lit(str(UINT64_MAX)).cast(UINT_DECIMAL)


def to_uint(col: Column | str) -> Column:
    """``toUInt64(text)``: exact unsigned integer, as ``decimal(20,0)``.

    Empty, non-numeric, negative or > 2^64-1 values fail the query, as the SQL
    engine of the original ledger does, whether the session is in ANSI mode or
    not.  Use :func:`try_to_uint` where bad rows must be set aside instead.
    """
    d = try_to_uint(col)
    return F.when(d.isNotNull() | _c(col).isNull(), d).otherwise(
        F.raise_error(F.concat(F.lit("not an unsigned 64-bit integer: "), _c(col).cast("string")))
    ).cast(UINT_DECIMAL)


def try_to_uint(col: Column | str) -> Column:
    """Like :func:`to_uint` but NULL for text that is not a uint64."""
    d = _c(col).try_cast(UINT_DECIMAL)
    return F.when(d.between(F.lit(0).cast(UINT_DECIMAL), _uint_max()), d)


def wei(gas_used: Column | str, gas_price: Column | str) -> Column:
    """``gas_used * effective_gas_price`` in wei, exact (``decimal(38,0)``).

    Two uint64 factors need at most 40 digits, but real gas costs are far below
    1e38; an overflow is an error in either ANSI mode, never a wrap or a lost row.
    """
    gas, price = to_uint(gas_used), to_uint(gas_price)
    product = (gas * price).cast("decimal(38,0)")
    return F.coalesce(product, F.when(gas.isNotNull() & price.isNotNull(), _too_large()))


def _too_large() -> Column:
    return F.raise_error(F.lit("an amount of wei exceeds 38 digits")).cast("decimal(38,0)")


def wei_sum(col: Column | str) -> Column:
    """Sum of exact wei; a sum beyond 38 digits is an error in either ANSI mode (NULL only without values)."""
    return F.coalesce(F.sum(_c(col)).cast("decimal(38,0)"), F.when(F.count(_c(col)) > 0, _too_large()))


def wei_to_eth(wei_col: Column | str) -> Column:
    """wei -> ETH as double (the exact value is divided once, at the end)."""
    return _c(wei_col).cast("double") / F.lit(WEI_PER_ETH)


def wei_to_gwei(wei_col: Column | str) -> Column:
    return _c(wei_col).cast("double") / F.lit(WEI_PER_GWEI)


def exact_mean(sum_col: Column, count_col: Column) -> Column:
    """Mean of exact integers as double: ``double(sum) / count``.

    ``avg(decimal)`` would keep only four decimals; the original engine returns
    a double mean.
    """
    # no values -> NULL, as SQL avg() gives (and no division by zero under ANSI)
    return F.when(count_col > 0, sum_col.cast("double") / count_col.cast("double"))


def utc_date(ts: Column | str) -> Column:
    """``toDate(timestamp)`` of a UTC wall-clock timestamp."""
    return F.to_date(_c(ts))


def year_month(ts: Column | str) -> Column:
    """``toYYYYMM(timestamp)`` as int, e.g. 202401."""
    t = _c(ts)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def epoch_seconds_to_ts(seconds: Column | str) -> Column:
    """Block time (epoch seconds) -> UTC wall-clock ``timestamp_ntz``.

    Independent of the session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", _c(seconds).cast("long"), epoch)


def utc_instant(ts_ntz: Column | str) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> ``timestamp`` instant (for watermarks).

    Computed from microseconds since the epoch, so the session time zone plays
    no part.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, _c(ts_ntz)))


def utc_now() -> Column:
    """Current UTC wall-clock time as ``timestamp_ntz``, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), epoch)


def iso_text(ts: Column | str) -> Column:
    """Zone-less ISO text with milliseconds, the ledger's insert format."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def hex_quantity(col: Column | str) -> Column:
    """``0x``-prefixed hex quantity (block numbers, indexes) -> long."""
    return F.conv(F.substring(_c(col), 3, 64), 16, 10).cast("long")


def address_from_topic(topic: Column | str) -> Column:
    """Indexed ``address`` argument: the last 20 bytes of a 32-byte topic."""
    return F.concat(F.lit("0x"), F.lower(F.substring(_c(topic), -40, 40)))


def uint256_text(data: Column | str) -> Column:
    """Decimal text of the first 32-byte word of hex ``data`` (``0x`` + digits), exact up to 2^256 - 1.

    Shorter words are read as if padded on the left; empty data and text that
    is not hex give NULL.  Words below 2^120 (nearly all amounts) take two
    ``conv`` pieces and decimal arithmetic, larger ones a long division by limbs.
    """
    given = F.lower(F.substring(_c(data), 3, 64))
    digits = F.lpad(given, 64, "0")
    mid = F.conv(F.substring(digits, 35, 14), 16, 10).cast("decimal(38,0)")
    low = F.conv(F.substring(digits, 49, 16), 16, 10).cast("decimal(38,0)")
    small = (mid * F.lit(str(2**64)).cast("decimal(38,0)") + low).cast("decimal(38,0)")
    return F.when(
        given.rlike("^[0-9a-f]+$"),
        F.when(F.substring(digits, 1, 34) == F.lit("0" * 34), small.cast("string")).otherwise(_decimal_of_hex(digits)),
    )


def _decimal_of_hex(digits: Column) -> Column:
    """Decimal text of 64 hex digits: five limbs of 56 bits, recombined in base 1e18 with carries.

    Plain decimal arithmetic (products and sums stay below 38 digits), so the
    expression stays inside whole-stage codegen.
    """
    wide, base = "decimal(38,0)", 10**18
    number = lambda n: F.lit(str(n)).cast(wide)
    limbs = [F.conv(F.substring(digits, max(1, 51 - 14 * i), 14 if i < 4 else 8), 16, 10).cast("decimal(20,0)") for i in range(5)]
    parts, carry = [], None
    for j in range(5):
        total = carry
        for i, limb in enumerate(limbs):
            factor = 2 ** (56 * i) // base**j % base
            if factor:
                term = (limb * F.lit(str(factor)).cast("decimal(18,0)")).cast(wide)
                total = term if total is None else (total + term).cast(wide)
        parts.append((total % number(base)).cast(wide))
        carry = F.call_function("div", total, number(base)).cast(wide)
    text = F.concat(*[F.lpad(p.cast("string"), 18, "0") for p in reversed(parts)])
    return F.regexp_replace(text, "^0+(?=.)", "")


def js_default(col: Column | str, default: str) -> Column:
    """``String(x || default)``: NULL and empty text fall back to ``default``."""
    c = _c(col).cast("string")
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def normalize_address(col: Column | str) -> Column:
    return F.lower(_c(col))


def double_text(col: Column | str) -> Column:
    """Plain (non-scientific) text of a double with all its digits, e.g. 3823681772.9782143 or 20.

    Spark prints doubles in plain notation between 1e-3 and 1e7 and in
    scientific notation outside; there the decimal point is shifted in the text.
    """
    c = _c(col)
    text = c.cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), "^-", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.", ""), "0+$", "")
    below = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    whole = F.rpad(digits, F.greatest(F.length(digits), power + 1), F.lit("0"))
    above = F.regexp_replace(
        F.concat(F.substr(whole, F.lit(1), power + 1), F.lit("."), F.substr(whole, power + 2)), r"\.$", "")
    return F.when(F.instr(text, "E") == 0, F.regexp_replace(text, r"\.0$", "")).otherwise(
        F.concat(sign, F.when(power < 0, below).otherwise(above)))
