"""Checksum tests for taxpayer numbers and bank cards, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the taxpayer number's check digits, and the lengths of card numbers.
INN_10 = (2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_12_FIRST = (7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
INN_12_SECOND = (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
CARD_DIGITS = (13, 19)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _digit(digits: Column, position: int) -> Column:
    return F.substring(digits, position, 1).try_cast("int")


def _check_digit(digits: Column, weights: tuple[int, ...]) -> Column:
    """True where the digit after the weighted ones equals ``sum % 11 % 10``."""
    total = F.lit(0)
    for position, weight in enumerate(weights, start=1):
        total = total + _digit(digits, position) * weight
    return total % 11 % 10 == _digit(digits, len(weights) + 1)


def inn_digits_valid(digits: Column) -> Column:
    """Right check digits in a string of nothing but digits; 10 or 12 of them."""
    return F.coalesce(
        F.when(F.length(digits) == 10, _check_digit(digits, INN_10)).when(
            F.length(digits) == 12,
            _check_digit(digits, INN_12_FIRST) & _check_digit(digits, INN_12_SECOND),
        ),
        F.lit(False),
    )


def luhn_digits_valid(digits: Column) -> Column:
    """Luhn test on a string of nothing but digits; 13 to 19 of them."""
    return F.coalesce(
        F.length(digits).between(*CARD_DIGITS) & F.call_function("luhn_check", digits),
        F.lit(False),
    )


def inn_valid(value: Column) -> Column:
    """Taxpayer number with right check digits; other characters are skipped."""
    return inn_digits_valid(digits_of(value))


def luhn_valid(value: Column) -> Column:
    """Card number that passes the Luhn test; other characters are skipped."""
    return luhn_digits_valid(digits_of(value))


def card_match_valid(match: Column) -> Column:
    """Luhn test on a match of the card pattern, which holds digits, blanks and dashes."""
    return luhn_digits_valid(F.translate(match, " -", ""))
