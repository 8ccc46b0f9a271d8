"""Page-quality classes of a fetch: challenge page, blocked, ok, retryable."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Texts that mark a challenge page, and response codes.
CHALLENGE_SIGNALS = [
    "robot check",
    "type the characters you see",
    "sorry, we just need to make sure",
    "please complete the captcha",
    "solve the captcha",
    "captcha to continue",
    "api-services.amazon",
    "site maintenance",
    "oops! something went wrong",
]
BLOCK_SIGNALS = [
    "access denied",
    "403 forbidden",
    "blocked",
    "please verify you are a human",
    "checking your browser",
    "just a moment",
    "cf-browser-verification",
    "ddos-guard",
    "perimeterx",
    "datadome",
    "enable javascript and cookies to continue",
    "please enable cookies",
    "ray id",
    "captcha",
]
BLOCK_STATUSES = [403, 407, 429, 503]
MIN_PAGE_LENGTH = 500
RETRY_STATUSES = [429, 500, 502, 503, 504]


def _any_of(signals: Sequence[str]) -> str:
    """One pattern for all texts, branched on the first character so that most positions fail at once."""
    by_first: dict[str, list[str]] = {}
    for s in signals:
        by_first.setdefault(s[0], []).append(re.escape(s[1:]))
    firsts = "".join(re.escape(c) for c in by_first)
    return f"(?=[{firsts}])(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")"


def strip_space(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\n\r\f\x0b"))


def is_challenge_page(html: Column, sample: int | None = None) -> Column:
    """One of nine texts anywhere in the page; compat: `sample=8000` looks at the first 8000 characters only."""
    return F.coalesce(F.lower(html if sample is None else F.substring(html, 1, sample)).rlike(_any_of(CHALLENGE_SIGNALS)), F.lit(False))


def block_reason(status: Column, html: Column, min_len: int) -> Column:
    """Why a page is no use: `status`, a blocking one; of a 200, `short`, fewer than `min_len` characters, or `block text`, such a text anywhere in it. NULL if it is
    not blocked."""
    body = F.coalesce(html, F.lit(""))
    page = F.when(F.length(strip_space(body)) < min_len, "short").when(F.lower(body).rlike(_any_of(BLOCK_SIGNALS)), "block text")
    return F.when(status.isin(BLOCK_STATUSES), "status").when(status == 200, page)


def is_blocked(status: Column, html: Column, min_len: int) -> Column:
    return block_reason(status, html, min_len).isNotNull()


def is_ok(status: Column, html: Column) -> Column:
    return F.coalesce((status == 200) & html.rlike(r"\S"), F.lit(False))


def retryable(status: Column) -> Column:
    return F.coalesce(status.isin(RETRY_STATUSES), F.lit(False))


def backoff_s(attempt: Column) -> Column:
    return F.pow(F.lit(2.0), attempt)


def error_type(status: Column, blocked: Column) -> Column:
    """Label for error counts; NULL for a successful fetch."""
    return (
        F.when(blocked, "blocked")
        .when(status.isNull(), "no_response")
        .when(status == 200, F.lit(None).cast("string"))
        .when(retryable(status), "retryable")
        .when(status >= 500, "server_error")
        .when(status >= 400, "client_error")
        .otherwise("other")
    )
