"""Cleaning helpers: every function returns a native Spark ``Column``.

No Python UDFs: each helper is a composition of built-in expressions so it stays
inside whole-stage codegen and is pushed through Catalyst like any other column.
Lenient parsers use the ``try_*`` family so malformed text becomes null instead
of failing the query under ANSI mode.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed values shared with the source data contract -------------------------
ISO_DATE_RE = r"^\d{4}-\d{2}-\d{2}$"
US_DATE_RE = r"^\d{2}/\d{2}/\d{4}$"
US_DATE_LOOSE_RE = r"^\d{1,2}/\d{1,2}/\d{4}$"
MON_YEAR_RE = r"^[A-Za-z]{3}-\d{4}$"
ISO_TS_RE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?$"
US_TS_RE = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}(:\d{2})?$"
STRICT_NUMBER_RE = r"^-?\d+(\.\d+)?$"

# Money is exact from the parser to the sum. Amounts hold 14 digits before the point; text or a typed value beyond that is
# null, like any other malformed amount. Sums hold 24 digits before the point and raise beyond them (ANSI mode).
MONEY = "decimal(18,4)"
SUM = "decimal(38,4)"


def exact(c: ColumnOrName, dtype: str = MONEY) -> Column:
    """A number as an exact amount (half up at the last digit); beyond its range null."""
    return _c(c).try_cast(dtype)


# C1 -------------------------------------------------------------------------
def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, or null when the trimmed text is empty."""
    t = F.trim(_c(c))
    return F.when(t != F.lit(""), t)


# C2 / C3 / C4 / C5 ----------------------------------------------------------
def parse_date(typed: ColumnOrName | None, raw: ColumnOrName) -> Column:
    """Typed column first, else ``YYYY-MM-DD`` or ``MM/DD/YYYY`` text, else null."""
    r = F.trim(_c(raw))
    from_text = (F.when(r.rlike(ISO_DATE_RE), F.try_to_date(r, "yyyy-MM-dd"))
                 .when(r.rlike(US_DATE_RE), F.try_to_date(r, "MM/dd/yyyy")))
    return from_text if typed is None else F.coalesce(_c(typed).cast("date"), from_text)


def parse_month(raw: ColumnOrName) -> Column:
    """First day of month from ``YYYY-MM-DD``, ``Mon-YYYY`` or ``M/D/YYYY`` text."""
    r = F.trim(_c(raw))
    d = (F.when(r.rlike(ISO_DATE_RE), F.try_to_date(r, "yyyy-MM-dd"))
         .when(r.rlike(MON_YEAR_RE), F.try_to_date(F.initcap(r), "MMM-yyyy"))
         .when(r.rlike(US_DATE_LOOSE_RE), F.try_to_date(r, "M/d/yyyy")))
    return F.trunc(d, "month")


def parse_ts(typed: ColumnOrName | None, raw: ColumnOrName) -> Column:
    """Typed timestamp first, else ISO or US formatted text (seconds optional)."""
    r = F.trim(_c(raw))
    iso = F.regexp_replace(r, "T", " ")
    from_text = (
        F.when(r.rlike(ISO_TS_RE),
               F.coalesce(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd HH:mm:ss")),
                          F.try_to_timestamp(iso, F.lit("yyyy-MM-dd HH:mm"))))
        .when(r.rlike(US_TS_RE),
              F.coalesce(F.try_to_timestamp(r, F.lit("MM/dd/yyyy HH:mm:ss")),
                         F.try_to_timestamp(r, F.lit("MM/dd/yyyy HH:mm"))))
    )
    from_text = from_text.cast("timestamp_ntz")
    return from_text if typed is None else F.coalesce(_c(typed).cast("timestamp_ntz"), from_text)


def date_from_ts_prefix(raw: ColumnOrName) -> Column:
    """Date parsed from the first 10 characters of timestamp text."""
    return parse_date(None, F.left(F.trim(_c(raw)), F.lit(10)))


# C6 / C7 / C8 / C9 / C10 ----------------------------------------------------
def lenient_int(typed: ColumnOrName | None, raw: ColumnOrName) -> Column:
    """Typed first; else text stripped to digits and ``-``; blank or bad → null."""
    # try_cast of empty text is null; testing for it would put the pattern into the generated code twice.
    parsed = F.regexp_replace(F.trim(_c(raw)), r"[^0-9\-]+", "").try_cast("int")
    return parsed if typed is None else F.coalesce(_c(typed).cast("int"), parsed)


def lenient_decimal(typed: ColumnOrName | None, raw: ColumnOrName) -> Column:
    """Typed first; else text stripped to digits, ``.`` and ``-``, as an exact amount."""
    parsed = exact(F.regexp_replace(F.trim(_c(raw)), r"[^0-9.\-]+", ""))
    return parsed if typed is None else F.coalesce(exact(typed), parsed)


def strict_decimal(c: ColumnOrName, precision: int = 18, scale: int = 6) -> Column:
    """Cast only when the whole trimmed text is a plain signed decimal number."""
    t = F.trim(_c(c))
    return F.when(t.rlike(STRICT_NUMBER_RE), t.try_cast(f"decimal({precision},{scale})"))


def cast_trim(c: ColumnOrName, dtype: str) -> Column:
    """Trimmed text cast to ``dtype``; malformed text → null (``try_cast``)."""
    return blank_to_null(c).try_cast(dtype)


def money(c: ColumnOrName) -> Column:
    """Money text such as ``$1,234.50`` → exact amount."""
    return exact(F.trim(F.regexp_replace(_c(c), r"[$,]", "")))


# C11 / C12 ------------------------------------------------------------------
# Fixed vocabularies (must match the source contract).
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")
TRUE_WORDS_UPPER = ("TRUE", "T", "YES", "Y", "1")


def parse_bool3(c: ColumnOrName) -> Column:
    """True / false from a vocabulary; anything else null."""
    v = F.lower(F.trim(_c(c)))
    return F.when(v.isin(*TRUE_WORDS), F.lit(True)).when(v.isin(*FALSE_WORDS), F.lit(False))


def parse_bool2(c: ColumnOrName) -> Column:
    """True from a vocabulary; anything else (null included) false."""
    return F.coalesce(F.upper(F.trim(_c(c))).isin(*TRUE_WORDS_UPPER), F.lit(False))


# C13 / C14 / C15 / C16 ------------------------------------------------------
def canon(c: ColumnOrName, mode: str = "upper") -> Column:
    """Trim, then case-fold to ``upper`` / ``lower`` / ``initcap``; blank → null."""
    fold = {"upper": F.upper, "lower": F.lower, "initcap": F.initcap}[mode]
    return fold(blank_to_null(c))


def norm_code(c: ColumnOrName) -> Column:
    """Upper case code with whitespace and ``-`` removed; blank → null."""
    return blank_to_null(F.upper(F.regexp_replace(F.trim(_c(c)), r"[\s\-]", "")))


def alnum_code(c: ColumnOrName) -> Column:
    """Upper case code keeping only ``A-Z0-9``; blank → null."""
    return blank_to_null(F.upper(F.regexp_replace(_c(c), r"[^A-Za-z0-9]", "")))


def digits(c: ColumnOrName) -> Column:
    """Digits only; blank → null."""
    return blank_to_null(F.regexp_replace(_c(c), r"[^0-9]", ""))


def norm_postal(c: ColumnOrName) -> Column:
    """Postal code with all whitespace removed."""
    return blank_to_null(F.regexp_replace(_c(c), r"\s", ""))


def norm_state(c: ColumnOrName) -> Column:
    """State code: first two letters, upper case."""
    letters = F.regexp_replace(_c(c), r"[^A-Za-z]", "")
    return blank_to_null(F.upper(F.substring(letters, 1, 2)))


# C17 / C18 / C19 / C20 / C21 / C22 -----------------------------------------
def classify_like(c: ColumnOrName, rules: Sequence[tuple[str, str]],
                  default: Column | None = None) -> Column:
    """First matching ``LIKE`` pattern wins (rule order matters).

    ``rules`` is a list of (like_pattern, label) applied to lower(trim(c)).
    Without ``default`` an unmatched non-blank value is returned as-is
    (lower/trimmed); null stays null.
    """
    v = F.lower(F.trim(_c(c)))
    expr = None
    for pattern, label in rules:
        cond = v.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = blank_to_null(v) if default is None else default
    expr = fallback if expr is None else expr.otherwise(fallback)
    return F.when(_c(c).isNotNull(), expr)


# Fixed rule lists (order is part of the semantics).
ACCOUNT_STATUS_RULES = (
    ("%inactive%", "inactive"),
    ("%suspend%", "suspended"),
    ("%pending%", "pending"),
    ("%active%", "active"),
)
CHANNEL_RULES = (
    ("%retail%", "retail"),
    ("%wholesale%", "wholesale"),
    ("%distrib%", "distributor"),
)
METRIC_RULES = (
    ("%gross%sales%", "gross_sales"),
    ("%net%sales%", "net_sales"),
    ("%cogs%", "cogs"),
    ("%cost%of%goods%", "cogs"),
    ("%gross%margin%", "gross_margin"),
    ("%labor%cost%", "labor_cost"),
)
ACTION_SYNONYMS = {
    "IN": "IN", "CLOCKIN": "IN", "CLOCK_IN": "IN", "START": "IN", "PUNCHIN": "IN", "PUNCH_IN": "IN",
    "OUT": "OUT", "CLOCKOUT": "OUT", "CLOCK_OUT": "OUT", "END": "OUT", "PUNCHOUT": "OUT", "PUNCH_OUT": "OUT",
}
FUEL_UNIT_SYNONYMS = {"gal": "gallon", "gallon": "gallon", "gallons": "gallon", "therm": "therm", "therms": "therm"}
FUEL_SYNONYMS = {"natural gas": "natural_gas"}
TEAM_SYNONYMS = {"fulfilment": "fulfillment"}
# Fuel and unit → factor type; the unit that each fuel is measured in.
FUEL_FACTOR_TYPES = {("natural_gas", "therm"): "natural_gas_therm", ("diesel", "gallon"): "diesel_gallon",
                     ("gasoline", "gallon"): "gasoline_gallon"}
# Distribution status groups: canonical value → group.
COVERAGE_GROUPS = {
    "carried": ("carried", "listed", "active", "in_distribution", "available"),
    "pending": ("pending", "pending_launch", "onboarding"),
    "not_carried": ("not_carried", "not_listed", "inactive"),
    "discontinued": ("discontinued", "retired"),
}


def classify_channel(c: ColumnOrName) -> Column:
    return classify_like(c, CHANNEL_RULES)


def account_status(c: ColumnOrName) -> Column:
    return classify_like(c, ACCOUNT_STATUS_RULES)


def map_metric(c: ColumnOrName) -> Column:
    """Finance label → KPI category; null or unmatched → ``unknown``."""
    return F.coalesce(classify_like(c, METRIC_RULES, default=F.lit("unknown")), F.lit("unknown"))


def map_synonyms(c: ColumnOrName, mapping: dict[str, str], fold: str = "upper",
                 keep_unmapped: bool = True) -> Column:
    """Dictionary lookup after trim + case fold; unmapped values kept (or null)."""
    v = canon(c, fold)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = m[v]
    return F.coalesce(looked, v) if keep_unmapped else looked


def coverage_status(c: ColumnOrName) -> dict[str, Column]:
    """Distribution status → coverage group (unlisted statuses pass through) plus one flag per group."""
    v = _c(c)
    grp = None
    for g, members in COVERAGE_GROUPS.items():
        cond = v.isin(*members)
        grp = F.when(cond, F.lit(g)) if grp is None else grp.when(cond, F.lit(g))
    out = {"coverage_status": grp.otherwise(v)}
    for g, members in COVERAGE_GROUPS.items():
        out[f"is_{g}"] = v.isin(*members)
    return out


def factor_type(fuel: ColumnOrName, unit: ColumnOrName) -> tuple[Column, Column]:
    """(factor_type, has_invalid_fuel_unit) of canonical fuel and unit; no factor type (null) for other combinations."""
    f, u = _c(fuel), _c(unit)
    ftype, mismatch = F.lit(None).cast("string"), F.lit(False)
    for (fuel_name, unit_name), label in FUEL_FACTOR_TYPES.items():
        ftype = F.when((f == fuel_name) & (u == unit_name), F.lit(label)).otherwise(ftype)
        mismatch = mismatch | F.coalesce((f == fuel_name) & (u != unit_name), F.lit(False))
    return ftype, mismatch


# C23 / C24 / C25 / C26 / C27 ------------------------------------------------
def snake(name: str) -> str:
    import re
    s = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip())
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return s.strip("_").lower()


def normalise_headers(df: DataFrame, aliases: dict[str, str] | None = None,
                      required: Iterable[str] = ()) -> DataFrame:
    """snake_case headers, rename known aliases, add missing required columns as null.

    Schema-only work on the driver; no data is touched.
    """
    aliases = aliases or {}
    renamed = []
    for c in df.columns:
        s = snake(c)
        renamed.append(F.col(f"`{c}`").alias(aliases.get(s, s)))
    out = df.select(*renamed)
    missing = [r for r in required if r not in out.columns]
    if missing:
        out = out.withColumns({m: F.lit(None).cast("string") for m in missing})
    return out


def coalesce_headers(df: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    """Row-wise coalesce of whichever alternate header columns exist."""
    present = [F.col(n) for n in names if n in df.columns]
    value = F.coalesce(*present) if present else F.lit(None)
    return df.withColumn(target, value)


def derive_measures(qty: ColumnOrName, unit_price: ColumnOrName, discount_rate: ColumnOrName,
                    gross: ColumnOrName, discount: ColumnOrName, net: ColumnOrName) -> dict[str, Column]:
    """Fill gross / discount / net from the others when missing."""
    q, p, r = _c(qty), _c(unit_price), _c(discount_rate)
    g = F.coalesce(_c(gross), q * p, _c(net) + _c(discount))
    d = F.coalesce(_c(discount), g * r, g - _c(net))
    n = F.coalesce(_c(net), g - d)
    unit_net = F.try_divide(n, F.when(q != 0, q))
    return {"gross_sales": g, "discount_amount": d, "net_sales": n, "unit_net_price": unit_net}


def gl_net(debit: ColumnOrName, credit: ColumnOrName, null_as_zero: bool = True) -> Column:
    """Debit − credit; nulls treated as 0 unless ``null_as_zero`` is False."""
    if null_as_zero:
        return F.coalesce(_c(debit), F.lit(0)) - F.coalesce(_c(credit), F.lit(0))
    return _c(debit) - _c(credit)


# C28 / C29 ------------------------------------------------------------------
def nonneg(c: ColumnOrName) -> Column:
    """Clamp to ≥ 0; null stays null."""
    x = _c(c)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0)))


def period_start(c: ColumnOrName, unit: str = "month") -> Column:
    """Start date of the week (Monday), month, quarter or year containing ``c``."""
    return F.date_trunc(unit, _c(c)).cast("date")


# C30 / C31 / C32 / C33 ------------------------------------------------------
NULL_MARKER = "<null>"


def hash_key(*cols: ColumnOrName) -> Column:
    """md5 over pipe-joined fields; null fields are skipped (as the source does)."""
    return F.md5(F.concat_ws("|", *[_c(c).cast("string") for c in cols]))


def hash_key_nullsafe(*cols: ColumnOrName) -> Column:
    """md5 over pipe-joined fields with an explicit marker for nulls."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]))


def record_key(*cols: ColumnOrName, missing: str = "MISSING", sep: str = "|") -> Column:
    """Display key: fields joined by ``sep`` with ``missing`` for nulls."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(missing)) for c in cols])


def first_null_label(cols: Sequence[tuple[ColumnOrName, str]]) -> Column:
    """Label of the first null column in order, else null."""
    return F.coalesce(*[F.when(_c(c).isNull(), F.lit(label)) for c, label in cols])


# C34 / C35 / C36 / C37 / C38 / C39 / C40 ------------------------------------
def ratio(n: ColumnOrName, d: ColumnOrName) -> Column:
    """n / d as double; null when d is 0 or null."""
    den = _c(d).cast("double")
    return F.try_divide(_c(n).cast("double"), F.when(den != 0, den))


def sym_rel_diff(a: ColumnOrName, b: ColumnOrName) -> Column:
    """|a − b| / max(|a|, |b|), 0 when both are 0."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    den = F.greatest(F.abs(x), F.abs(y))
    return F.when(den == 0, F.lit(0.0)).otherwise(F.abs(x - y) / den)


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minutes from ``start`` to ``end`` (double; negative when end < start)."""
    return (F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))) / F.lit(6.0e7)


def days_in_month(c: ColumnOrName) -> Column:
    return F.dayofmonth(F.last_day(_c(c)))


def date_labels(c: ColumnOrName) -> dict[str, Column]:
    """Calendar labels for a date column."""
    d = _c(c).cast("date")
    return {
        "year_num": F.year(d),
        "quarter_num": F.quarter(d),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_abbr": F.date_format(d, "MMM"),
        "day_name": F.date_format(d, "EEEE"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")),
        "iso_year": F.extract(F.lit("YEAROFWEEK"), d).cast("int"),
        "iso_week": F.weekofyear(d),
        "iso_year_week": F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
                                  F.lpad(F.weekofyear(d).cast("string"), 2, "0")),
        "day_of_week": ((F.dayofweek(d) + 5) % 7 + 1),  # Monday = 1 … Sunday = 7
        "date_key": (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)),
    }


def distinct_from(a: ColumnOrName, b: ColumnOrName) -> Column:
    """SQL ``a IS DISTINCT FROM b``."""
    return ~_c(a).eqNullSafe(_c(b))


# Quotients and other derived numbers are rounded as decimals of ten digits, so that 1183.8753 / 6 is the tie 197.31255.
QUOTIENT = "decimal(38,10)"


def round_to(c: ColumnOrName, digits_: int = 2) -> Column:
    """Half-up decimal rounding, as a double; beyond the range of :data:`QUOTIENT` null."""
    return F.round(exact(c, QUOTIENT), digits_).cast("double")


def any_true(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda x, y: x | y, conds) if conds else F.lit(False)
