"""Keyword dictionaries: category -> terms. Terms are matched lower-case as substrings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The default evidence dictionary (17 categories, 100 terms), in its
# published order. It is meant to be edited per case; pass your own ``terms`` table.
DEFAULT_TERMS = {
    "credential_requests": [
        "verify your account", "confirm your password", "click here to login",
        "your account will be suspended", "unusual sign-in", "password reset required",
        "validate your credentials"],
    "executive_impersonation": [
        "are you at your desk", "i'm in a meeting", "i need this done quickly",
        "purchase gift cards", "send me your number", "wire transfer request"],
    "payment_fraud_indicators": [
        "updated banking details", "new account number", "wire instructions",
        "urgent payment", "invoice attached", "overdue invoice"],
    "external_share_requests": [
        "share via dropbox", "google drive link", "wetransfer", "personal email",
        "send to gmail", "send to my home email", "outside the company"],
    "sensitive_data_requests": [
        "send me the spreadsheet", "employee list", "password list", "customer database",
        "export the data", "full dataset"],
    "credential_sharing": [
        "here's my password", "use my login", "my credentials are",
        "service account password", "shared account"],
    "unauthorized_tools": [
        "i installed", "downloaded from", "personal device", "bypass", "workaround",
        "unapproved tool"],
    "confidentiality_concerns": [
        "confidential", "do not forward", "nda", "trade secret", "proprietary",
        "internal only"],
    "shadow_it": [
        "signed up for", "created an account", "new saas", "without it approval"],
    "compromise_indicators": [
        "unauthorized access", "suspicious activity", "breach", "compromised", "incident",
        "leaked", "exposed"],
    "malware_indicators": [
        "ransomware", "encrypted my files", "ransom note", "malware detected",
        "antivirus alert", "endpoint protection"],
    "investigation_terms": [
        "forensic", "preserve evidence", "chain of custody", "soc ticket", "incident ticket",
        "triage"],
    "urgency_language": [
        "urgent", "asap", "immediately", "right now", "time sensitive", "emergency",
        "do not delay"],
    "external_link_lures": [
        "click the link", "follow this url", "log in here", "open the attachment",
        "enable macros", "view document online"],
    "follow_ups": [
        "following up", "still waiting", "haven't heard", "any update", "checking in"],
    "deadline_commitments": [
        "by friday", "by monday", "this week", "next week", "by end of"],
    "attachment_promises": [
        "attached", "here is", "i'm sending", "supporting documentation", "see file"],
}

# The test dictionary used against the driver corpus, which contains no
# mail and almost none of the default terms (see FIXTURES.md section 3).
FIXTURE_TERMS = {
    "license": ["licensed under", "mit license", "general public license"],
    "secret": ["token ="],
    "abuse": ["disgusting", "worthless", "idiot reouha"],
    "wrapped": ["was the", "auf nicht"],
    "common": ["to thanedble", "of the"],
    "sub": ["nda", "here is"],
    "punct": ["a. the"],
}

TERMS_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("category_ord", T.IntegerType(), False),
    T.StructField("term", T.StringType(), False),
    T.StructField("term_ord", T.IntegerType(), False),
])


def term_rows(terms: dict[str, list[str]]) -> list[tuple[str, int, str, int]]:
    rows = []
    for c_ord, (category, words) in enumerate(terms.items(), start=1):
        for t_ord, word in enumerate(words, start=1):
            rows.append((category, c_ord, word.lower(), t_ord))
    return rows


def terms_df(spark: SparkSession, terms: dict[str, list[str]] | None = None) -> DataFrame:
    """The ``terms`` dimension table (category, category_ord, term, term_ord)."""
    rows = term_rows(terms or DEFAULT_TERMS)
    return spark.createDataFrame(rows, TERMS_SCHEMA)


def terms_values_sql(terms: dict[str, list[str]]) -> str:
    """The same table as a SQL VALUES list, for the DuckDB oracle."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({q(c)}, {co}, {q(t)}, {to})" for c, co, t, to in term_rows(terms))
    return f"(VALUES {rows}) AS terms(category, category_ord, term, term_ord)"
