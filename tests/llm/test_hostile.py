"""Inputs that once took quadratic time or lost text: no tag end, many spans, null ids, long texts."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from mailsift.llm import bpe, exact, mincut, secrets_scan
from mailsift.llm.common import prepare


@pytest.mark.parametrize("page", ["<a " * 60_000, '<a" ' * 40_000, '<a" ' * 40_000 + ">", "<div>" * 40_000 + "</p>" * 40_000, "<!-- " * 60_000,
                                  "<" * 200_000, "<td><div>" * 30_000, "<span class=x>a" * 20_000, "<p><a " + "x " * 100_000])
def test_pages_are_linear(page):
    began = time.perf_counter()
    mincut.main_text(page)
    assert time.perf_counter() - began < 1.5


ARTICLE = "<article><p>A first paragraph with many words, enough of them to be the text of an article.</p>%s<p>A last paragraph with as many words, enough of them to be the text of an article.</p></article>"


@pytest.mark.parametrize("middle,kept", [
    ('<div class="related-work"><p>More text about the related work, with enough words to be a paragraph.</p></div>', True),
    ('<p class="form-of-government">The form of government is a republic, with enough words to be a paragraph.</p>', True),
    ('<p>Please <b id=share>share</b> this text with others, it has enough words.</p>', True),
    ('<div class="related-links"><p>More links</p></div>', False), ('<div class="socialShare">Share this</div>', False),
    ('<div class="ad-slot-2">Buy now</div>', False), ('<div><span class="ad">Buy now</span></div>', False)])
def test_one_word_of_a_name_is_no_proof(middle, kept):
    lines = mincut.main_text(ARTICLE % middle).split("\n")
    assert len(lines) == 2 + kept
    if "share</b>" in middle:
        assert lines[1] == "Please share this text with others, it has enough words."


def test_deep_pages_keep_their_labels():
    """Elements far above the text still count, at any depth."""
    inner = "<div>" * 5000 + "words of a text that is long enough to be content, surely." + "</div>" * 5000
    assert mincut.main_text(f"<nav>{inner}<p>More navigation, here and there, again.</p></nav>") == ""
    assert mincut.main_text(f"<article>{inner}</article>") == "words of a text that is long enough to be content, surely."


def test_text_after_the_last_tag():
    assert mincut.main_text("<p>A text that goes on, with enough words for it.</p><!-- no end, a < b") == "A text that goes on, with enough words for it."
    assert mincut.main_text("<p>A text that goes on, with enough words for it <b c") == "A text that goes on, with enough words for it"


def test_redaction_of_many_spans(spark):
    prepare(spark)
    text = "token=abcdefgh12 x " * 100_000
    spans = secrets_scan.find_spans(text)
    assert len(spans) == 100_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    assert secrets_scan.redact(df).first().text.count("[SECRET]") == 100_000
    assert time.perf_counter() - began < 20


def test_many_null_and_shared_ids(spark):
    """100,000 rows without an id, or with one id: linear, and grouped by text."""
    prepare(spark)
    for key in ("cast(null as long)", "cast(7 as long)"):
        df = spark.range(100_000).selectExpr(f"{key} as doc_id", "concat('text ', id % 1000) as text").repartition(8)
        began = time.perf_counter()
        got = exact.row_groups(df).groupBy("group_size").count().collect()
        assert [(r.group_size, r["count"]) for r in got] == [(100, 100_000)]
        assert time.perf_counter() - began < 60


FRAGMENTS = ["the ", " of", "\n\n", "  ", "\t", "é", "İstanbul ", "日本語", "🙂", "<|endoftext|>", "<|startoftext|>", "12345", "it's", "###", "　y", "\x85z", " \x1c",
             " ̈a", "ﬁ ", "ABC", " ", "  x", " 中", " Ā", " \xa0", "x" * 30]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("step", [5, 17, 64, 1 << 20])
def test_slices_and_decoding_equal_the_library(name, step, monkeypatch):
    """Texts cut into slices of any size give the library's ids, and the ids its text."""
    path = bpe.vocabulary_path(name)
    coder, library = bpe.Bpe(path), Tokenizer.from_file(path)
    monkeypatch.setattr(bpe, "STEP_BYTES", step)
    monkeypatch.setattr(bpe, "STEP_TOKENS", min(step, 1 << 10))
    rng = random.Random(step)
    for _ in range(40):
        texts = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 60))) for _ in range(5)] + [None, ""]
        ids = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all(texts)]
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids == want
        ends = np.cumsum([0, *map(len, ids)])
        assert coder.decode_all(np.array([i for x in ids for i in x], "i8"), ends).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in want]


def test_long_text_in_bounded_memory():
    """100 MB in one text: the encoder takes little more than the text and its ids."""
    import subprocess
    import sys
    code = """
import resource, sys
from mailsift.llm import bpe
coder = bpe.Bpe(bpe.vocabulary_path("word_bpe_49k.json"))
text = "some words of a text that goes on and on, without an end. " * (100_000_000 // 58)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
ids = coder.encode_all([text])[0]
print(len(ids), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    size, extra = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert size > 80_000_000 and extra < 700_000         # KB: raw bytes, ids twice, slices
