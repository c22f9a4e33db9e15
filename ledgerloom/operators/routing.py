"""Routing of a written question to a label by keywords; the first rule that holds wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, first_number, route_text, strip, without_punctuation

# Keywords of each label, in the order the labels are tried.
KEYWORDS = [
    ("TOP_PRIORITY_ACCOUNTS", [
        "who to call", "top priority", "who should i call", "first accounts", "call today", "best accounts", "who first", "whom to contact",
        "priority list", "highest priority", "start today", "start with", "which account", "weti account", "who i go call", "who i fit call",
        "top account", "call who", "best to call"]),
    ("TOTAL_EXPECTED_RECOVERY", [
        "how much money", "total cash", "expected recovery", "total value", "how much can we recover", "portfolio value", "total overdue",
        "book value", "money we fit recover", "how much we go get", "how much we fit make", "recovery forecast", "recovery total",
        "total balance", "total debt", "collect how much", "how much collectible", "recoverable"]),
    ("COBAC_REGULATORY_REPORT", [
        "cobac", "regulation", "statutory reserve", "capital shield", "compliance", "par30", "par 30", "par 15", "par15", "provision",
        "mandatory reserve", "audit", "r-2017", "2017/07", "legal"]),
    ("CHANNEL_BREAKDOWN", ["sms", "whatsapp", "call", "momo", "mobile money", "channel", "best way to contact", "how to contact", "reach client"]),
    ("VULNERABLE_ACCOUNTS", ["vulnerable", "hardship", "shield", "senior", "elderly", "sick", "medical", "hospital", "restructure", "waivers"]),
    ("DEMO_PIDGIN_OUTREACH", ["speak pidgin", "script", "outreach call", "demo call", "pidgin script", "pidgin message", "voice script", "call script", "bilingual"]),
    ("HELP", ["help", "what can you do", "what can you say", "commands", "options", "how do i", "what do i ask", "example", "assist", "guide"]),
]
ACCOUNT_WORDS = ["client", "account", "loan", "borrower", "check", "find", "#", "show", "open"]
SHORTEST = 4
ACCOUNT, DEFAULT = "ACCOUNT_LOOKUP", "DEFAULT"


def label_of(text: Column) -> Column:
    """An account number with an account word comes first, a bare number last."""
    clean = without_punctuation(strip(text))
    number = first_number(clean)
    rules = [(ACCOUNT, number.isNotNull() & contains_any(clean, ACCOUNT_WORDS))]
    rules += [(label, contains_any(clean, words)) for label, words in KEYWORDS]
    label, cond = rules[-1]
    rules[-1] = (label, cond | (F.length(strip(clean)) < SHORTEST))
    rules.append((ACCOUNT, number.isNotNull()))
    return route_text(clean, rules, DEFAULT)


def route(df: DataFrame, text: str, name: str = "label") -> DataFrame:
    """Label and the first four-to-nine-digit number of each whole text."""
    c = F.col(text)
    return df.withColumns({name: label_of(c), "number": first_number(without_punctuation(strip(c)))})
