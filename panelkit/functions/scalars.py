"""Column functions. Every function takes and returns columns and stays in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def case_when(branches: list[tuple[Column, object]], default: object = None) -> Column:
    """First value whose condition holds."""
    out = reduce(lambda acc, b: acc.when(b[0], b[1]), branches[1:], F.when(*branches[0]))
    return out.otherwise(default)


def case_of(col: Column | str, mapping: dict[object, list], default: object = None) -> Column:
    """Value whose list holds ``col``: ``{"Console": [29, 40, 27]}``."""
    return case_when([(_c(col).isin(list(keys)), F.lit(value)) for value, keys in mapping.items()], default)


def first_non_null(*cols: Column | str) -> Column:
    return F.coalesce(*[_c(c) for c in cols])


def null_if(col: Column | str, value: object) -> Column:
    return F.nullif(_c(col), F.lit(value))


def cast_to(col: Column | str, type_name: str) -> Column:
    """Cast; text that does not fit becomes NULL."""
    return _c(col).try_cast(type_name)


def shift_months(d: Column | str, n: int) -> Column:
    return F.add_months(_c(d), n)


def shift_days(d: Column | str, n: int) -> Column:
    return F.date_add(_c(d), n)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_c(later), _c(earlier))


def month_window_start(rd: Column | str, n: int) -> Column:
    """The month end ``n`` months before month end ``rd``."""
    return F.date_add(F.add_months(F.date_add(_c(rd), 1), -n), -1)


def month_index(d: Column | str) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(_c(d)) * 12 + F.month(_c(d))


def months_diff(later: Column | str, earlier: Column | str, truncate: bool = True) -> Column:
    """Months from ``earlier`` to ``later``; whole months, cut toward zero, by default."""
    diff = F.months_between(_c(later), _c(earlier))
    return diff.cast("int") if truncate else diff


def period_label(d: Column | str) -> Column:
    """``YYYY_Q``."""
    return F.concat_ws("_", F.year(_c(d)), F.quarter(_c(d)))


def band(col: Column | str, k: int) -> Column:
    """Lower edge of the band of width ``k``."""
    return (F.floor(_c(col) / k) * k).cast("int")


def tenor_band(months: Column | str) -> Column:
    """Half-year bands up to 11 months, yearly bands above."""
    return F.when(_c(months) <= 11, band(months, 6)).otherwise(band(months, 12))


def age_years(birth: Column | str, as_of: Column | str) -> Column:
    """Completed years at ``as_of``."""
    return (F.months_between(_c(as_of), _c(birth)) / 12).cast("int")


def join_text(*cols: Column | str, sep: str = "") -> Column:
    return F.concat_ws(sep, *[F.trim(_c(c).cast("string")) for c in cols])


def clean_name(col: Column | str) -> Column:
    """Trimmed text with blanks as underscores."""
    return F.regexp_replace(F.trim(_c(col)), r"\s+", "_")


def extract(col: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match; NULL when nothing matches."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def words(col: Column | str, stop_words: list[str] | None = None) -> Column:
    """Lower-case words of letters only, stop words removed, repeats kept."""
    tokens = F.array_remove(F.split(F.lower(F.regexp_replace(_c(col), "[^a-zA-Z]+", " ")), " "), "")
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(stop_words))


def list_mean(*cols: Column | str) -> Column:
    """Mean of the values that are present."""
    values = F.filter(F.array(*[_c(c).cast("double") for c in cols]), lambda v: v.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.try_divide(total, F.size(values))


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den``; NULL when ``den`` is zero."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def sum_if(cond: Column, value: Column | str) -> Column:
    return F.sum(F.when(cond, _c(value)))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def count_distinct_if(cond: Column, col: Column | str) -> Column:
    return F.count_distinct(F.when(cond, _c(col)))


def margin(rate: Column | str, commission: Column | str, instalments: Column | str) -> Column:
    """Yearly margin of an offer: rate plus the commission spread over the instalments."""
    return _c(rate) + _c(commission) / 0.6 / _c(instalments) * 12


def payment_type(atm: Column | str, branch: Column | str, transfers: Column | str) -> Column:
    """How an account is fed, from its recent counts."""
    cash = (_c(atm) > 0) | (_c(branch) > 0)
    no_cash = (_c(atm) == 0) & (_c(branch) == 0)
    return case_when([
        (cash & (_c(transfers) == 0), F.lit("CashOnlyPayment")),
        (no_cash & (_c(transfers) > 0), F.lit("TransferOnlyPayment")),
        (cash & (_c(transfers) > 0), F.lit("MixedPayment")),
    ], F.lit("LackOfTransfer"))


def zscore(col: Column | str, mean: Column | float, sd: Column | float) -> Column:
    """Standardised value; a fixed ``sd`` must be positive, a computed one gives NULL when it is not."""
    if isinstance(sd, (int, float)) and sd <= 0:
        raise ValueError("standard deviation must be positive")
    mean_col = F.lit(mean) if isinstance(mean, (int, float)) else mean
    sd_col = F.lit(sd) if isinstance(sd, (int, float)) else sd
    return F.when(sd_col > 0, (_c(col) - mean_col) / sd_col)
