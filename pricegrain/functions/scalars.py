"""Text, number, date and unit functions of the price pipeline, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.constants import CURRENCY_OF_UNIT, LITRES_PER_US_GALLON

#: White space to strip, with the no-break and the ideographic space, which trim() leaves.
_EDGE = "^[\\s\u00a0\u3000]+|[\\s\u00a0\u3000]+$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text ----


def clean(c) -> Column:
    """Text without white space at its edges; empty text is null."""
    return F.nullif(F.regexp_replace(col(c), _EDGE, ""), F.lit(""))


def parse_price(c) -> Column:
    """The number in a posted price such as ``NT$ 28.9``, ``.959`` or ``1,234.5``; null if there is none."""
    text = F.regexp_replace(F.regexp_replace(col(c), _EDGE, ""), "NT\\$|[$¥£€,\u00a0\u3000]", "")
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def split_labels(c) -> Column:
    """Distinct non-empty labels of a ``|``-joined text, sorted; null text has none."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\|"), lambda x: x != "")))


def join_labels(labels: Column) -> Column:
    return F.array_join(labels, "|")


def union_labels(a, b) -> Column:
    return join_labels(F.array_sort(F.array_union(split_labels(a), split_labels(b))))


def station_key(country, brand, station) -> Column:
    return F.concat(col(country), F.lit("-"), col(brand), F.lit("-"), col(station))


def feed_id(country, brand) -> Column:
    return F.concat(col(country), F.lit("-"), col(brand))


def feed_country(feed) -> Column:
    """The part of a feed id before its first hyphen."""
    return F.substring_index(col(feed), "-", 1)


def feed_brand(feed) -> Column:
    return F.regexp_replace(col(feed), "^[^-]*-", "")


def strip_prefix(c, prefix: str) -> Column:
    return F.regexp_replace(col(c), f"^{prefix}", "")


def trailing_number(c) -> Column:
    return F.nullif(F.regexp_extract(col(c), r"(\d+)$", 1), F.lit(""))


def numeric_first(c) -> list[Column]:
    """Sort keys: numeric ids by value, then the others as text."""
    c = col(c)
    number = c.rlike("^[0-9]+$")
    return [number.desc(), F.when(number, c.try_cast("decimal(38,0)")).asc(), c.asc()]


def ids_in_text(c, pattern: str = r"/club/(\d+)") -> Column:
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(pattern), F.lit(1)))


def url_parameter(c, name: str) -> Column:
    return F.parse_url(col(c), F.lit("QUERY"), F.lit(name))


# ---- regions ----

#: State codes, and the state of a postcode's first digit.
AU_STATES = ("NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT")
AU_FIRST_DIGIT = {"2": "NSW", "3": "VIC", "4": "QLD", "5": "SA", "6": "WA", "7": "TAS"}
#: Fixed patterns: prefecture at the start, municipality after it, region after a postcode.
JP_PREFECTURE = r"^(北海道|東京都|(?:京都|大阪)府|\S{2,3}県)"
JP_MUNICIPALITY = r"^(?:\S+?郡)?(\S+?[市区町村])(?![市区町村])"
TW_REGION = r"^\d{3,5}\s*(\S{2}[市縣])"


def first_group(c, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit(""))


def au_region_from_postcode(c) -> Column:
    """State of a four-digit postcode: the ACT's ranges, then 08, then the first digit."""
    c = col(c)
    n = c.try_cast("int")
    first = F.create_map(*[F.lit(x) for kv in AU_FIRST_DIGIT.items() for x in kv])
    state = F.when(n.between(2600, 2618) | n.between(2900, 2920), "ACT").when(c.startswith("08"), "NT").otherwise(first[F.substring(c, 1, 1)])
    return F.when(c.rlike(r"^\d{4}$"), state)


def au_region(town, address, postcode) -> Column:
    """The first state code that stands alone in the town, then in the address, else by postcode."""
    words = rf"(?<![A-Za-z])({'|'.join(AU_STATES)})(?![A-Za-z])"
    of = lambda c: first_group(F.upper(F.coalesce(col(c), F.lit(""))), words)
    return F.coalesce(of(town), of(address), au_region_from_postcode(postcode))


def au_city(town) -> Column:
    """The town without the state codes at its end."""
    words = F.filter(F.split(F.trim(F.regexp_replace(col(town), r"\s+", " ")), " "), lambda w: w != "")
    last = F.array_max(F.transform(words, lambda w, i: F.when(~F.upper(w).isin(*AU_STATES), i + 1)))
    return F.nullif(F.array_join(F.slice(words, 1, F.coalesce(last, F.lit(0))), " "), F.lit(""))


def jp_region(line) -> Column:
    return first_group(line, JP_PREFECTURE)


def jp_city(line) -> Column:
    """The municipality after the prefecture; an optional district is skipped."""
    return F.when(jp_region(line).isNotNull(), first_group(F.regexp_replace(col(line), JP_PREFECTURE, ""), JP_MUNICIPALITY))


def tw_region(address) -> Column:
    return first_group(address, TW_REGION)


# ---- dates ----


def capture_id(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HHmm'Z'")


def capture_time(c) -> Column:
    """The instant that a capture id names; null if it isn't one."""
    c = col(c)
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{4}Z$"), F.try_to_timestamp(F.regexp_replace(F.regexp_replace(c, "Z$", ""), "T(..)(..)$", " $1:$2:00")))


def local_date(ts, zone) -> Column:
    """Date of an instant in a zone, given as a column of valid zone names."""
    return F.to_date(F.from_utc_timestamp(col(ts), col(zone)))


def iso_date(c) -> Column:
    """Date in the first ten characters; null if there is none."""
    return F.try_to_date(F.substring(col(c), 1, 10), "yyyy-MM-dd")


def iso_time(c) -> Column:
    """Instant in ISO text with ``Z`` or an offset, or in plain ``date time`` text."""
    c = F.regexp_replace(col(c), r"Z$", "+00:00")
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(col(c), F.lit("yyyy-MM-dd HH:mm:ss")))


_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


#: Fixed format: month name, optional dot, day, optional comma, year; casing aside.
OPEN_DATE = r"^([a-z]{3,})\.?\s+(\d{1,2})\s*,?\s*(\d{4})$"


def open_date(c) -> Column:
    """Date such as ``Aug 23, 1995``: any casing, months by their first three letters, dot and comma optional."""
    c, pattern = F.lower(clean(c)), OPEN_DATE
    months = F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS, 1) for x in (m, f"{i:02d}")])
    month = months[F.substring(F.regexp_extract(c, pattern, 1), 1, 3)]
    text = F.concat_ws("-", F.regexp_extract(c, pattern, 3), month, F.lpad(F.regexp_extract(c, pattern, 2), 2, "0"))
    return F.when(c.rlike(pattern) & month.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def older_than(ts, at, days) -> Column:
    """Whether more than ``days`` whole days lie between two instants; exactly as many isn't more."""
    return F.unix_micros(col(at)) - F.unix_micros(col(ts)) > col(days) * F.lit(86_400_000_000)


# ---- numbers ----


def round_price(c) -> Column:
    return F.round(col(c), 4)


def significant(c, digits: int = 10) -> Column:
    """A double to so many significant digits, by its decimal text."""
    return F.when(col(c).isNotNull(), F.format_string(f"%.{digits - 1}e", col(c)).try_cast("double"))


def positive(c) -> Column:
    """The value if it is finite and above zero, else null."""
    c = col(c)
    return F.when((c > 0) & ~F.isnan(c) & (c < float("inf")), c)


def reciprocal(c) -> Column:
    return F.lit(1.0) / positive(c)


def fixed3(c) -> Column:
    return F.format_string("%.3f", col(c))


def moved(a, b, epsilon: float = 5e-5) -> Column:
    """Whether two prices differ by more than a rounding artifact; null if either is null."""
    return F.abs(col(a) - col(b)) > epsilon


# ---- units ----


def currency_of(unit) -> Column:
    return F.create_map(*[F.lit(x) for kv in CURRENCY_OF_UNIT.items() for x in kv])[col(unit)]


def local_per_litre(price, unit) -> Column:
    price, unit = col(price), col(unit)
    return F.when(unit == "USD/gal", price / LITRES_PER_US_GALLON).when(unit == "GBp/L", price / 100.0).otherwise(price)


def usd_per_litre(litre, rate) -> Column:
    return col(litre) * col(rate)


def usd_per_gallon(price, unit, usd_litre) -> Column:
    """The posted price itself where it is in dollars a gallon; null where the litre price is."""
    usd_litre = col(usd_litre)
    return F.when(usd_litre.isNull(), None).when(col(unit) == "USD/gal", col(price)).otherwise(usd_litre * LITRES_PER_US_GALLON)
