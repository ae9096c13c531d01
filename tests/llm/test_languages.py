"""Rejection of languages that weren't learned, and the scores against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewright.llm import language_id
from galewright.llm.frames import remainder

FOREIGN = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "pt": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve kardeşlik zihniyeti.",
}


@pytest.fixture(scope="module")
def learned(docs):
    part = remainder(F.col("doc_id"), 3)

    def fit(*languages):
        some = docs.where(F.col("lang").isin(*languages))
        return language_id.fit(some.where(part != 1)), some.where(part == 1)

    return fit


@pytest.mark.parametrize("languages", [("en", "de"), ("en", "fr"), ("de", "en", "es", "fr")])
def test_unlearned_latin_text_is_rejected_and_learned_text_kept(spark, docs, learned, languages):
    model, held_out = learned(*languages)
    own = language_id.identify(held_out, model).collect()
    assert np.mean([not r.rejected for r in own]) >= 0.98
    strange = spark.createDataFrame(list(enumerate(FOREIGN.values())), "doc_id long, text string")
    found = language_id.identify(strange, model).collect()
    assert all(r.rejected and r.score < 0.7 for r in found)
    others = docs.where(~F.col("lang").isin(*languages))
    if others.count():
        rejected = [r.rejected for r in language_id.identify(others, model).collect()]
        assert np.mean(rejected) >= 0.9


def mixed(h):
    whole = (1 << 64) - 1
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & whole
    h ^= h >> 29
    h = h * 0xA0761D6478BD642F & whole
    return h ^ (h >> 32)


def plain(text, model):
    """Language, score and rejection by loops over bytes."""
    settings = model.settings
    raw = " ".join(["", *"".join(c.lower() if c < "\xdf" and c != "\xd7" else c for c in text).split("\0"), ""]).encode()
    letters = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in raw)
    total, count, seen, of = np.zeros(len(model.languages)), 0, 0, 0
    by_bucket = model.logits_by_bucket()
    for size in settings.sizes:
        for at in range(len(letters) - size + 1):
            gram = letters[at : at + size]
            if b" " in gram[1:-1] or gram == b"  ":
                continue
            hashed = mixed(int.from_bytes(gram, "little") + (size << 56))
            total += by_bucket[hashed % settings.buckets]
            count += 1
            if size == max(settings.sizes):
                bit = hashed % (8 * len(model.known))
                seen, of = seen + (int(model.known[bit >> 3]) >> (bit & 7) & 1), of + 1
    if not any(c.isalpha() for c in text):
        return "und", 0.0, True
    logits = total / count / model.temperature
    odds = [math.exp(z - max(logits)) for z in logits]
    best = max(odds) / sum(odds)
    share = 1.0
    if of:
        p, z = seen / of, settings.doubt
        share = (p + z * z / of / 2 + z * math.sqrt(p * (1 - p) / of + z * z / of / (4 * of))) / (1 + z * z / of)
    score = best * min(1.0, share / model.least_known)
    return model.languages[int(np.argmax(odds))], score, best < settings.reject_below or share < model.least_known


def test_scores_equal_plain_python(spark, docs, learned):
    model, held_out = learned("de", "en", "es", "fr")
    short = held_out.where(F.length("text").between(1, 1500)).orderBy("doc_id").limit(60)
    extra = [(-1, "Ä"), (-2, "a"), (-3, "… 12"), (-4, "ÀÉ×ß œ"), *((-10 - i, t) for i, t in enumerate(FOREIGN.values()))]
    rows = short.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    text = {r.doc_id: r.text for r in rows.collect()}
    for row in language_id.identify(rows, model).collect():
        name, score, rejected = plain(text[row.doc_id], model)
        assert (row.lang_pred, row.rejected) == (name, rejected) and row.score == pytest.approx(score, abs=1e-4), row


def test_one_learned_language(spark, learned):
    model, held_out = learned("en")
    assert np.mean([r.rejected for r in language_id.identify(held_out, model).collect()]) <= 0.02
    strange = spark.createDataFrame(list(enumerate(FOREIGN.values())), "doc_id long, text string")
    assert all(r.rejected for r in language_id.identify(strange, model).collect())
