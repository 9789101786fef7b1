"""Scalar functions as Spark Column expressions.

Everything here compiles to built-in Catalyst expressions, so it stays inside
whole-stage codegen; none of it calls back into Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fingerprint(key: ColumnOrName, price: ColumnOrName, sep: str = "-") -> Column:
    """``id-price`` change fingerprint.

    The price is cast to a whole number before it becomes text, so ``570000``
    and ``570000.0`` give the same fingerprint. ``concat`` (not ``concat_ws``)
    is used on purpose: a null price (or one beyond a bigint) gives a null
    fingerprint, which change detection treats as "always changed"."""
    return F.concat(_c(key).cast("string"), F.lit(sep), _c(price).try_cast("bigint").cast("string"))


def search_key(*parts: ColumnOrName) -> Column:
    """``city_rentOrBuy_type_radius`` key, ``-`` to ``_``, lower case."""
    return F.lower(F.replace(F.concat_ws("_", *[_c(p).cast("string") for p in parts]),
                             F.lit("-"), F.lit("_")))


def digits_only(c: ColumnOrName) -> Column:
    """Remove every non-digit character."""
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def first_digit_run(c: ColumnOrName) -> Column:
    """First run of digits, null when there is none (I4)."""
    return F.nullif(F.regexp_extract(_c(c), r"(\d+)", 1), F.lit(""))


# Currency markers recognised in result pages.
CURRENCIES = ("CHF", "EUR")


def price_after_currency(c: ColumnOrName, currencies: Sequence[str] = CURRENCIES) -> Column:
    """Digits of the amount written after a currency marker.

    Takes the run of digits and thousands separators that follows the marker
    and stops at the decimal point (``CHF 570,000.—`` → 570000); an amount
    without the ``.—`` suffix keeps all its digits. A space separates
    thousands only before three digits (``CHF 1 234 000``, not ``CHF 5 20``);
    null when no digit follows the marker, or more than a bigint holds."""
    pat = "(?:" + "|".join(currencies) + r")\s*([0-9](?:[0-9]|[,'’][0-9]|[ \u00a0][0-9]{3}(?![0-9]))*)"
    run = F.regexp_extract(_c(c), pat, 1)
    return F.nullif(F.regexp_replace(run, r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def run_date_text(ts: ColumnOrName) -> Column:
    """``yymmdd``."""
    return F.date_format(_c(ts), "yyMMdd")


def run_datetime_text(ts: ColumnOrName) -> Column:
    """``yymmdd_HHMMSS``."""
    return F.date_format(_c(ts), "yyMMdd_HHmmss")


def ln_or_null(c: ColumnOrName) -> Column:
    """Natural log; null for values <= 0."""
    x = _c(c)
    return F.when(x > 0, F.ln(x))


def zero_aware_log(c: ColumnOrName) -> Column:
    """Log where the value is positive, the value itself otherwise (I8)."""
    x = _c(c)
    return F.when(x > 0, F.ln(x)).otherwise(x)


def json_path(c: ColumnOrName, path: str) -> Column:
    """Value at a JSON path or null at any missing level."""
    return F.get_json_object(_c(c), path)


def bin_right_closed(c: ColumnOrName, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin ``(e[i], e[i+1]]`` holding the value,
    0-based; null outside ``(e[0], e[-1]]`` (I10, same rule as ``pd.cut``)."""
    x = _c(c)
    expr = None
    for i in range(len(edges) - 1):
        cond = (x > F.lit(edges[i])) & (x <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def escape_quotes(c: ColumnOrName) -> Column:
    """``'`` → ``\\'``."""
    return F.replace(_c(c), F.lit("'"), F.lit("\\'"))


def name_part(c: ColumnOrName, sep: str, n: int) -> Column:
    """n-th (1-based) part of a delimited text."""
    return F.split_part(_c(c), F.lit(sep), F.lit(n))


def indicator(cond: Column) -> Column:
    """0/1 flag from a condition; null counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null instead of failing on a zero denominator (C17)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def money_avg(c: ColumnOrName, decimals: int = 2) -> Column:
    """Average of money amounts written with ``decimals`` decimals, summed in
    exact integer minor units (cents): the result does not depend on the
    order of summation, so it is the same for any partitioning (a floating
    sum is not, which matters when the exact mean sits on a rounding tie)."""
    scale = float(10 ** decimals)
    x = _c(c)
    return (F.sum(F.round(x * F.lit(scale)).cast("bigint")).cast("double") / F.count(x)) / F.lit(scale)


def dround(c: ColumnOrName, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(x·10^d) / 10^d``.

    Spark's ``round(x, d)`` rounds the shortest decimal text of ``x`` while
    other engines scale first; scaling by an exact power of ten first gives
    the same double everywhere, ties included."""
    x = _c(c).cast("double")
    if digits >= 0:
        p = float(10 ** digits)
        return F.round(x * F.lit(p)) / F.lit(p)
    p = float(10 ** -digits)
    return F.round(x / F.lit(p)) * F.lit(p)


def sig_round(c: ColumnOrName, digits: int = 6) -> Column:
    """Round to ``digits`` significant digits.

    Statistics computed by different algorithms agree to many digits but not
    bit for bit; rounding on significant digits makes them comparable across
    engines whatever their magnitude. (The same expression is written in the
    oracle SQL.) Only exact powers of ten are used as factors."""
    x = _c(c).cast("double")
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    up = F.pow(F.lit(10.0), k)
    down = F.pow(F.lit(10.0), -k)
    return (F.when(x == 0, F.lit(0.0))
            .when(k >= 0, F.round(x * up) / up)
            .otherwise(F.round(x / down) * down))


def inv_norm_cdf(p: ColumnOrName) -> Column:
    """Inverse of the standard normal CDF as a Column expression.

    Rational approximation by P. J. Acklam (relative error < 1.2e-9), which is
    ample for probability plots; written with built-in arithmetic so it runs
    in codegen."""
    q = _c(p).cast("double")
    # Coefficients of the published approximation.
    a = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
    b = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00)
    lo, hi = 0.02425, 1 - 0.02425

    def poly(coefs, x):
        acc = F.lit(coefs[0])
        for k in coefs[1:]:
            acc = acc * x + F.lit(k)
        return acc

    ql = F.sqrt(-2 * F.ln(q))
    qh = F.sqrt(-2 * F.ln(1 - q))
    r_mid = (q - 0.5) * (q - 0.5)
    low = poly(c, ql) / (poly(d, ql) * ql + 1)
    high = -poly(c, qh) / (poly(d, qh) * qh + 1)
    mid = poly(a, r_mid) * (q - 0.5) / (poly(b, r_mid) * r_mid + 1)
    return F.when(q < lo, low).when(q > hi, high).otherwise(mid)
