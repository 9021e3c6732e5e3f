"""Keyword scan: sentence x term matching, subject handling, large dictionaries."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from mailsift.functions.terms import DEFAULT_TERMS, FIXTURE_TERMS, terms_df
from mailsift.operators import scan as S
from mailsift.plans import scan as PS
from mailsift.sources.ingest import mime_of
from tests.conftest import SF_SMALL, leaf, mail_frame, multipart, plain


def scan_mail(spark, raws, terms=None):
    m = mime_of(mail_frame(spark, raws))
    return PS.hits_of(PS.scan_frame(m), terms_df(spark, terms or DEFAULT_TERMS)).collect()


def test_wrapped_term_is_found(spark):
    """A term split by a line break is still one hit, quoted from the normalized text."""
    hits = scan_mail(spark, [plain(body="Please use the updated banking\ndetails below.")])
    body = [h for h in hits if h.location == "body" and h.matched_term == "updated banking details"]
    assert [h.exact_text for h in body] == ["Please use the updated banking details below."]


def test_case_is_kept_in_quote(spark):
    """Matching is case-insensitive but the quote keeps the original case."""
    hits = scan_mail(spark, [plain(body="Updated Banking Details attached")])
    assert any(h.exact_text == "Updated Banking Details attached" for h in hits)


def test_subject_quoted_whole_and_both_locations(spark):
    """A subject is one quote even with punctuation; body and subject give two rows."""
    hits = scan_mail(spark, [plain(subject="Urgent payment. Please act today.",
                                   body="This is an urgent payment.")])
    up = sorted((h.location, h.exact_text) for h in hits if h.matched_term == "urgent payment")
    assert up == [("body", "This is an urgent payment."),
                  ("subject", "Urgent payment. Please act today.")]


def test_encoded_subject_is_decoded(spark):
    """An RFC 2047 subject is matched after decoding."""
    subj = "=?utf-8?B?VXJnZW50IHBheW1lbnQgbmVlZGVkIOKAkyBhY3Q=?="
    hits = scan_mail(spark, [plain(subject=subj, body="nothing here")])
    assert [h.subject for h in hits if h.location == "subject"][0].startswith("Urgent payment")


def test_html_only_and_odd_text_subtype(spark):
    """HTML-only bodies are scanned via their text; text/enriched counts as plain."""
    html = multipart("h", "alternative", [leaf('text/html; charset="utf-8"',
                                                "<p>Send the wire instructions today</p>")])
    odd = multipart("e", "mixed", [leaf('text/enriched; charset="utf-8"', "an overdue invoice")],
                    boundary="E1")
    terms = {t for h in scan_mail(spark, [html, odd]) for t in [h.matched_term]}
    assert {"wire instructions", "overdue invoice"} <= terms


def test_term_across_sentence_end_gives_no_row(spark):
    """A term spanning a sentence boundary is in the body but in no sentence."""
    hits = scan_mail(spark, [plain(body="It is a. The end")], {"p": ["a. the"]})
    assert hits == []


def _brute(texts, terms):
    rows = []
    for doc_id, text in texts:
        flat = re.sub(r"\s+", " ", text)
        if not flat:
            continue
        for i, s in enumerate(re.split(r"(?<=[.!?])\s+", flat), start=1):
            for cat, words in terms.items():
                for w in words:
                    if w in s.lower():
                        rows.append((doc_id, cat, w, i, s.strip()))
    return sorted(rows)


def test_hits_equal_brute_force_on_corpus(spark):
    """Spark hits equal a plain Python scan of the same documents."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = S.scan_hits(docs, ["doc_id"], F.col("text"), terms_df(spark, FIXTURE_TERMS), "body")
    got = sorted((r.doc_id, r.category, r.matched_term, r.sentence_ord, r.exact_text)
                 for r in got.collect())
    assert got == _brute([(r.doc_id, r.text) for r in docs.collect()], FIXTURE_TERMS)


def test_large_dictionary_in_several_parts(spark, monkeypatch):
    """A dictionary beyond one automaton gives the same hits."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    terms = dict(FIXTURE_TERMS, tiny=["a", "ab"], odd=["line\nbreak"])
    small = S.scan_hits(docs, ["doc_id"], F.col("text"), terms_df(spark, terms), "body").collect()
    monkeypatch.setattr(S, "PART_CHARS", 30)
    big = S.scan_hits(docs, ["doc_id"], F.col("text"), terms_df(spark, terms), "body").collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, big))


class _Terms:
    def __init__(self, *value):
        self.value = list(value)


@pytest.mark.parametrize("seed", range(5))
def test_placing_of_hits(seed):
    """Overlapping terms, terms over sentence ends, texts whose lower case is longer: as a plain
    search of every sentence."""
    rng = random.Random(seed)
    words = ["aa", "a", "b. a", "b.", " a", "i\u0307x", "\u0130", "ss. ", "?"]
    automaton = S._automaton(f"test{seed}", _Terms(*words))
    for _ in range(300):
        flat = "".join(rng.choice(["a", "A", "b", ". ", "! ", ".", " ", "\u0130", "x", "?"]) for _ in range(rng.randint(0, 30)))
        flat = re.sub(r"\s+", " ", flat)
        want = {(i, s, w) for i, s in enumerate(re.split(r"(?<=[.!?]) ", flat)) for w in words if w in s.lower()}
        got = S._sentence_hits(flat, automaton)
        assert len(got) == len(set(got)) and set(got) == want


def test_cost_does_not_grow_with_the_dictionary():
    """One pass per text: 20,000 terms take about as long as 100."""
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200_000))
    times = []
    for n in (100, 20_000):
        automaton = S._automaton(f"size{n}", _Terms(*(f"{i:06d} none" for i in range(n))))
        began = time.perf_counter()
        assert S._sentence_hits(text, automaton) == []
        times.append(time.perf_counter() - began)
    assert times[1] < 5 * times[0] + 0.2


def test_blank_terms_match_nothing(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "doc_id long, text string")
    terms = spark.createDataFrame([("c", 1, "", 1), ("c", 1, None, 2), ("c", 1, "TEXT", 3), ("d", 2, "text", 1)],
                                  "category string, category_ord int, term string, term_ord int")
    got = S.scan_hits(docs, ["doc_id"], F.col("text"), terms, "body").collect()
    assert sorted((r.doc_id, r.category, r.matched_term) for r in got) == [(1, "c", "text"), (1, "d", "text")]


def test_empty_dictionary(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = terms_df(spark, FIXTURE_TERMS).where("false")
    assert S.scan_hits(docs, ["doc_id"], F.col("text"), none, "body").collect() == []
