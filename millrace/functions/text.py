"""Column expressions for strings: recognisers, parsing, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide how text is read.
TRUE_WORDS = ["true", "yes", "1", "y", "t", "on"]
FALSE_WORDS = ["false", "no", "0", "n", "f", "off"]
NULL_TOKENS = ["nan", "None", "null", "NULL", "NA", "N/A", ""]
NULL_WORDS_LOWER = ["none", "nan"]
DATE_ANYWHERE = (
    r"\d{4}[-/]\d{1,2}[-/]\d{1,2}"
    r"|\d{1,2}[-/]\d{1,2}[-/]\d{2,4}"
    r"|\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"
)
DATE_PREFIX = r"^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{4}/\d{2}/\d{2}|\d{2}-\d{2}-\d{4})"
ID_NAME_WORDS = ["id", "uuid", "guid", "key", "index", "idx", "pk", "sk"]


def normal(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string")))


def is_bool_word(c: Column) -> Column:
    return normal(c).isin(TRUE_WORDS + FALSE_WORDS)


def bool_to_int(c: Column) -> Column:
    word = normal(c)
    return F.when(word.isin(TRUE_WORDS), 1).when(word.isin(FALSE_WORDS), 0)


def parse_number(c: Column) -> Column:
    """Double, or null when the text is no number (NaN words count as null)."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def parse_timestamp(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(text, F.lit("yyyy/MM/dd")),
        F.try_to_timestamp(text, F.lit("MM/dd/yyyy")),
        F.try_to_timestamp(text, F.lit("dd-MM-yyyy")),
    )


def null_tokens(c: Column, tokens: list[str] | None = None) -> Column:
    words = NULL_TOKENS if tokens is None else tokens
    return F.when(~c.isin(words), c)


def tags(c: Column, sep: str = ",") -> Column:
    """Trimmed, non-empty pieces of a separated list."""
    pieces = F.transform(F.split(c, "\\Q" + sep + "\\E"), lambda t: F.trim(t))
    return F.filter(pieces, lambda t: t != "")


def truncate(c: Column, limit: int = 50, suffix: str = "...") -> Column:
    keep = max(limit - len(suffix), 0)
    return F.when(F.length(c) <= limit, c).otherwise(
        F.concat(F.substring(c, 1, keep), F.lit(suffix))
    )


def exact_round(x: Column, decimals: int) -> Column:
    """Round the binary value itself, ties to even.

    ``format_string`` rounds the shortest decimal form half up, so 186.065
    (really 186.06499...) would gain a digit.  The product with 10^d is split
    to learn on which side of a tie the value lies.
    """
    b = F.lit(float(10**decimals))
    split = F.lit(134217729.0)  # 2^27 + 1
    x_hi = x * split - (x * split - x)
    x_lo = x - x_hi
    p = x * b
    error = x_lo * b + (x_hi * b - p)
    low = F.floor(p).cast("double")
    part = p - low
    even = low % 2 == 0
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & ~even)))
    return F.when(up, low + 1).otherwise(low) / b


def format_number(c: Column, decimals: int = 2) -> Column:
    x = c.cast("double")
    fmt = f"%.{decimals}f"
    size = F.abs(x)
    show = lambda v, unit="": F.format_string(fmt + unit, exact_round(v, decimals))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(size >= 1e6, show(x / 1e6, "M"))
        .when(size >= 1e3, show(x / 1e3, "K"))
        .otherwise(show(x))
    )


def format_integer(c: Column) -> Column:
    return F.format_string("%,d", c.cast("bigint"))


def format_percentage(c: Column, decimals: int = 1) -> Column:
    x = c.cast("double")
    fmt = f"%.{decimals}f%%"
    return F.when(F.abs(x) > 1, F.format_string(fmt, exact_round(x, decimals))).when(
        x.isNotNull(), F.format_string(fmt, exact_round(x * 100, decimals))
    )


def format_bytes(c: Column) -> Column:
    x = c.cast("double")
    out = F.when(x < 1024, F.format_string("%d B", x.cast("bigint")))
    units = ["KB", "MB", "GB", "TB", "PB"]
    for i, unit in enumerate(units, start=1):
        scaled = x / float(1024**i)
        text = F.format_string("%.2f " + unit, exact_round(scaled, 2))
        out = out.otherwise(text) if unit == units[-1] else out.when(scaled < 1024, text)
    return F.when(x.isNotNull(), out)


def format_duration(c: Column, detailed: bool = False) -> Column:
    total = F.floor(F.greatest(c.cast("double"), F.lit(0.0))).cast("bigint")
    hours = F.floor(total / 3600).cast("bigint")
    minutes = F.floor((total % 3600) / 60).cast("bigint")
    secs = (total % 60).cast("bigint")
    h, m, s = (F.format_string(f, x) for f, x in (("%dh", hours), ("%dm", minutes), ("%ds", secs)))
    if detailed:
        parts = F.concat_ws(
            " ",
            F.when(hours > 0, h),
            F.when(minutes > 0, m),
            F.when((secs > 0) | ((hours == 0) & (minutes == 0)), s),
        )
        return F.when(c.isNotNull(), parts)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(hours > 0, F.concat_ws(" ", h, m))
        .when(minutes > 0, F.concat_ws(" ", m, s))
        .otherwise(s)
    )
