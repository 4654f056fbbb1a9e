"""Column masks. The role is an argument; nothing here is a security boundary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.hashing import pseudonym

# Role names and replacement texts.
ADMIN, ENGINEER, ANALYST, VIEWER = "RETAIL_ADMIN", "RETAIL_ENGINEER", "RETAIL_ANALYST", "RETAIL_VIEWER"
ACCOUNT_ADMIN = "ACCOUNTADMIN"
PLAIN_ROLES = (ADMIN, ENGINEER)
HIDDEN_EMAIL, HIDDEN_TEXT, SHORT_EMAIL = "****@****.***", "****", "***@***"
VIP = "VIP"


def _two_letters_and_domain(email: Column) -> Column:
    return F.concat(F.substring(email, 1, 2), F.lit("****@"), F.split_part(email, F.lit("@"), F.lit(2)))


def mask_email(email: Column, role: str) -> Column:
    if role in PLAIN_ROLES:
        return email
    return _two_letters_and_domain(email) if role == ANALYST else F.lit(HIDDEN_EMAIL)


def mask_phone(phone: Column, role: str) -> Column:
    return phone if role in PLAIN_ROLES else F.regexp_replace(phone, "[0-9]", "*")


def mask_name(name: Column, role: str) -> Column:
    if role in PLAIN_ROLES:
        return name
    if role != ANALYST:
        return F.lit(HIDDEN_TEXT)
    return F.concat(F.substring(name, 1, 1), F.repeat(F.lit("*"), F.greatest(F.length(name) - 1, F.lit(0))))


def mask_card(number: Column, role: str) -> Column:
    if role == ADMIN:
        return number
    length = F.length(number)
    shown = F.concat(F.repeat(F.lit("*"), F.greatest(length - 4, F.lit(0))), F.right(number, F.lit(4)))
    return F.when(length >= 4, shown).otherwise(HIDDEN_TEXT)


def mask_email_by_segment(email: Column, segment: Column, role: str) -> Column:
    if role == ADMIN:
        return email
    return F.when(segment == VIP, HIDDEN_EMAIL).otherwise(_two_letters_and_domain(email))


def mask_sha2(value: Column, role: str) -> Column:
    return value if role == "ADMIN" else pseudonym(value)


def initial_only(name: Column, role: str) -> Column:
    return name if role in PLAIN_ROLES else F.concat(F.substring(name, 1, 1), F.lit(HIDDEN_TEXT))


def email_for_reader(email: Column, role: str) -> Column:
    return email if role in PLAIN_ROLES else _two_letters_and_domain(email)


def shorten_email(email: Column) -> Column:
    """First two letters and the domain; a fixed text if the @ comes too early."""
    at = F.position(F.lit("@"), email)
    long_enough = F.concat(F.substring(email, 1, 2), F.lit("***"), F.substr(email, at))
    return F.when(email.isNull(), None).when(at > 2, long_enough).otherwise(SHORT_EMAIL)
