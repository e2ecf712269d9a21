"""Scalar text and number rules as pure Column expressions (SCL-1..4, 10..13, 16, 18..25)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "strip_ws", "domain_of", "topic_of", "slug", "safe_ident", "account_name",
    "csv_list", "preview", "iso_utc", "parse_iso", "record_id", "join_list", "line_count",
    "fmt_money", "fmt_pct", "fmt_pct1", "fmt_score", "normalise_choice", "normalise_upper",
    "is_truthy", "annualise", "range_label", "money_range_label", "enum_rank",
    "head_of_array", "default_if_missing",
]

UNKNOWN_DOMAIN = "unknown"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def domain_of(namespace) -> Column:
    """SCL-1: text before the first '.'; NULL or '' → 'unknown'."""
    ns = F.coalesce(F.nullif(col_(namespace), F.lit("")), F.lit(UNKNOWN_DOMAIN))
    return F.substring_index(ns, ".", 1)


def topic_of(subject, strict: bool = False) -> Column:
    """SCL-2: subject → topic.

    Default mode removes '-value' then '-key' anywhere in the text (so
    'my-keyboard-value' → 'myboard'); ``strict`` removes only a trailing suffix.
    """
    s = col_(subject)
    if strict:
        return F.regexp_replace(s, r"-(key|value)$", "")
    return F.replace(F.replace(s, F.lit("-value"), F.lit("")), F.lit("-key"), F.lit(""))


def slug(title, keep_slash: bool = False) -> Column:
    """SCL-3: lower case, spaces (and '/' unless ``keep_slash``) → '-'."""
    low = F.lower(col_(title))
    return F.translate(low, " ", "-") if keep_slash else F.translate(low, " /", "--")


def safe_ident(name) -> Column:
    """SCL-4: '.' and '-' → '_' (resource identifiers)."""
    return F.translate(col_(name), ".-", "__")


def account_name(name) -> Column:
    """SCL-4 variant: '_' → '-' (account names)."""
    return F.translate(col_(name), "_", "-")


def csv_list(text, drop_empty: bool = True) -> Column:
    """SCL-10: split on ',', trim each item; listing mode drops empties, edit mode keeps them."""
    items = F.transform(F.split(col_(text), ","), lambda x: strip_ws(x))
    return F.filter(items, lambda x: x != "") if drop_empty else items


def preview(text, n: int, ellipsis: bool = False) -> Column:
    """SCL-11: first n characters; with ``ellipsis`` add '...' when longer."""
    t = col_(text)
    cut = F.substring(t, 1, n)
    if not ellipsis:
        return cut
    return F.when(F.length(t) > n, F.concat(cut, F.lit("..."))).otherwise(t)


def iso_utc(ts) -> Column:
    """SCL-12: timestamp → ISO-8601 UTC text with microseconds (session time zone = UTC)."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def parse_iso(text) -> Column:
    """SCL-12: ISO-8601 text → TIMESTAMP (NULL when unparsable)."""
    return F.try_to_timestamp(col_(text))


def record_id(*cols, prefix: str = "") -> Column:
    """SCL-13: reproducible record id = SHA-256 of the identifying columns.

    The reference draws a random UUID per record; a content hash keeps reruns
    idempotent (same input → same id), which keyed overwrite and oracle checks need.
    Use ``F.uuid()`` where a fresh id per run is wanted.
    """
    h = F.sha2(F.concat_ws("\u0001", *[col_(c).cast("string") for c in cols]), 256)
    return F.concat(F.lit(prefix), h) if prefix else h


def join_list(arr, sep: str = ", ") -> Column:
    """SCL-16: ', '.join(list)."""
    return F.array_join(col_(arr), sep)


def line_count(text) -> Column:
    """SCL-18: number of '\\n'-separated lines ("a\\nb\\n" → 3)."""
    return F.size(F.split(col_(text), "\n", -1))


def fmt_money(x) -> Column:
    """SCL-19: thousands separators, no decimals: 1234.4 → '1,234'."""
    return F.format_number(col_(x), 0)


def fmt_pct(x) -> Column:
    """SCL-19: fraction → whole percent: 0.85 → '85%'."""
    return F.concat(F.format_string("%.0f", F.bround(col_(x) * 100, 0)), F.lit("%"))


def fmt_pct1(x) -> Column:
    """SCL-19: fraction → percent with one decimal: 0.002 → '0.2%'."""
    return F.concat(F.format_string("%.1f", F.bround(col_(x) * 100, 1)), F.lit("%"))


def fmt_score(x) -> Column:
    """SCL-19: two decimals: 0.5 → '0.50' (ties to even first, as Python's format does for
    exactly representable ties; Java's formatter alone would round them up)."""
    return F.format_string("%.2f", F.bround(col_(x), 2))


def normalise_choice(x) -> Column:
    """SCL-22: trim + lower (menu choices)."""
    return F.lower(strip_ws(x))


def normalise_upper(x) -> Column:
    """SCL-22: trim + upper (complexity edits)."""
    return F.upper(strip_ws(x))


def is_truthy(x, kind: str = "array") -> Column:
    """SCL-23: NULL, empty array/map and '' all count as missing."""
    c = col_(x)
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind == "map":
        return c.isNotNull() & (F.size(F.map_keys(c)) > 0)
    return c.isNotNull() & (F.size(c) > 0)


def annualise(monthly, years: int = 1) -> Column:
    """SCL-24: monthly amount → total over ``years`` (500/month → 6000 / 30000 over 5 years)."""
    return col_(monthly) * F.lit(12 * years)


def range_label(lo, hi, unit: str = "weeks") -> Column:
    """SCL-25: '4.0-10.0 weeks' (numbers rendered as text, as Python prints floats)."""
    return F.concat(col_(lo).cast("string"), F.lit("-"), col_(hi).cast("string"),
                    F.lit(" " + unit) if unit else F.lit(""))


def money_range_label(lo, hi) -> Column:
    """SCL-25: '$20,000 - $50,000'."""
    return F.concat(F.lit("$"), fmt_money(lo), F.lit(" - $"), fmt_money(hi))


def enum_rank(x, symbols: list[str]) -> Column:
    """SRT-9 helper: 1-based rank of an enum symbol in declaration order, 0 when unknown."""
    return F.array_position(F.array(*[F.lit(s) for s in symbols]), col_(x))


def head_of_array(arr, n: int, ellipsis: str | None = None) -> Column:
    """SRT-6: first n elements; with ``ellipsis`` append it when the array was longer."""
    a = col_(arr)
    head = F.slice(a, 1, n)
    if ellipsis is None:
        return head
    return F.when(F.size(a) > n, F.concat(head, F.array(F.lit(ellipsis)))).otherwise(head)


def default_if_missing(x, default) -> Column:
    """SCL-20: ``.get(k, default)``; NULL counts as missing."""
    return F.coalesce(col_(x), default if isinstance(default, Column) else F.lit(default))
