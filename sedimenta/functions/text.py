"""Text rules: trimming, closed domains, canonical forms and personal-data protection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode text handling counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The closed domains of the business rules and their fallback.
UNKNOWN = "NO DETERMINADO"
COUNTRY = "COLOMBIA"
TIERS = ("BRONZE", "SILVER", "GOLD")
STATUSES = ("COMPLETED", "PENDING", "CANCELLED", "RETURNED")
PAYMENTS = ("CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "CASH")
TRUTHY = ("1", "TRUE", "T", "YES", "SI")
SUPPLIER_PREFIX = "PROVEEDOR "
PHONE_MASK = "****"


def trim_text(text: Column) -> Column:
    """Strip white space of every kind from both ends (`F.trim` alone strips blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def upper_text(text: Column) -> Column:
    return trim_text(F.upper(text))


def in_domain(value: Column, domain: Iterable[str], default: str = UNKNOWN) -> Column:
    """Keep a value of the domain; anything else, null included, becomes the default."""
    return F.when(value.isin(*domain), value).otherwise(F.lit(default))


def payment_code(text: Column) -> Column:
    """Upper-case code with every blank turned into an underscore."""
    return F.replace(upper_text(text), F.lit(" "), F.lit("_"))


def canonical_supplier(text: Column) -> Column:
    """`proveedor_a` -> `PROVEEDOR A`: the last letter is the supplier's code."""
    code = F.regexp_substr(F.rtrim(F.upper(text), F.lit(WHITESPACE)), F.lit(r"[A-Z]\z"))
    return F.coalesce(F.concat(F.lit(SUPPLIER_PREFIX), code), F.lit(UNKNOWN))


def to_boolean(text: Column) -> Column:
    return F.coalesce(upper_text(text).isin(*TRUTHY), F.lit(False))


def full_name(first: Column, last: Column) -> Column:
    """First and last name with missing parts left out; both missing gives ''."""
    blank = F.lit("")
    return trim_text(F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(last, blank)))


def email_token(email: Column) -> Column:
    """One-way token of an address: lower-case hexadecimal SHA-256."""
    return F.sha2(F.lower(trim_text(email)), 256)


def mask_phone(phone: Column) -> Column:
    """Show the last four digits only; a missing phone stays null."""
    digits = F.regexp_replace(phone, r"\D", "")
    return F.concat(F.lit(PHONE_MASK), F.right(digits, F.lit(4)))
