"""A gram with many distinct segments, as a large family of near copies brings them."""

from __future__ import annotations

import random

import pytest

from mailsift.llm import fmindex, segments, suffixes
from mailsift.llm.common import prepare
from tests.llm import brute


@pytest.fixture(scope="module")
def family():
    rng = random.Random(11)
    template = ["w%d" % rng.randrange(10 ** 6) for _ in range(70)]
    texts = []
    for i in range(150):
        words = list(template)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(70)] = "changed%d" % rng.randrange(10 ** 6)
        texts.append(" ".join(words[rng.randint(0, 5):]))
    return list(enumerate(texts))


@pytest.mark.parametrize("operator, want", [(fmindex, brute.substring_dedup), (suffixes, brute.byte_dedup)])
def test_hot_gram_is_divided(spark, family, monkeypatch, operator, want):
    prepare(spark)
    monkeypatch.setattr(segments, "SHARD_BYTES", 4000)
    index = operator.index

    def bounded(grams, contents, *rest):
        held = sum(map(len, contents))
        if held > 20_000:
            raise ValueError(f"a shard of {held} bytes")
        return index(grams, contents, *rest)

    monkeypatch.setattr(operator, "index", bounded)
    docs = spark.createDataFrame(family, "doc_id long, text string")
    got = operator.remove_repeats(docs).collect()
    total = "n_words" if operator is fmindex else "n_bytes"
    kept = [(r.doc_id, (r[total], r.n_removed, *([r.n_spans] if operator is suffixes else []),
                        brute.sha(r.kept if isinstance(r.kept, str) else bytes(r.kept)))) for r in got]
    assert dict(kept) == want(family) and len(kept) == len(family)
